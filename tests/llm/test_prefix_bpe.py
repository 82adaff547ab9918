"""Prefix tables against the public library, on odd texts, appends and edits."""

import random

import pytest
import tiktoken

from patronage.llm import prefix_bpe

import public_tokenizers as public

ODD = [
    "", " ", "  ", "it's we'll I'd  they've", "x" * 300, "=" * 700, " \n\n \t a", "naïve café — ünï", "日本語のテキスト", "🙂🙃 👩‍👩‍👧", "<|endoftext|>",
    "12345 678 9", "  x", "aaaa'lll 'l 'll", "a" * 5000, " " * 900, "https://a.b/c?d=e&f=%20", "\\### \r\n\x00\x7f",
]


@pytest.fixture(scope="module")
def ranks():
    return prefix_bpe.load_ranks(public.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder(ranks):
    return prefix_bpe.Encoder(ranks, public.PATTERN)


def some_text(rng, n):
    return "".join(rng.choice(["the ", "and", "ing", " ", "'", "l", "ll", "é", "日", "\n", "1", "##", "token", "ization", "  "]) for _ in range(n))


def test_texts_equal_the_library(encoder, library):
    rng = random.Random(3)
    for text in ODD + [some_text(rng, rng.randint(1, 60)) for _ in range(400)]:
        (ids,) = encoder.encode([text])
        assert [int.from_bytes(ids[k : k + 4], "little") for k in range(0, len(ids), 4)] == library.encode_ordinary(text), text
        assert encoder.decode(ids) == text.encode()


def test_prefixes_hold_the_encoding_of_every_prefix(encoder):
    v = encoder.vocabulary
    data = b"internationalisation'sesquipedalian  ~~~~ aaaaaaa"
    table = prefix_bpe.Prefixes(v)
    for k in range(len(data)):
        table.append(data[k : k + 1])
        assert table.ids() == v.merged(data[: k + 1])


def test_tables_of_texts_are_bounded(encoder, library, monkeypatch):
    monkeypatch.setattr(prefix_bpe, "KEPT_PIECES", 50)
    monkeypatch.setattr(prefix_bpe, "KEPT_PAIRS", 20)
    rng = random.Random(8)
    for _ in range(20):
        texts = [some_text(rng, 30) for _ in range(5)] + ["é" * 90]
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            assert [int.from_bytes(ids[k : k + 4], "little") for k in range(0, len(ids), 4)] == library.encode_ordinary(text)


def test_edits_of_a_piece_compute_few_entries(encoder):
    rng, v = random.Random(5), encoder.vocabulary
    table = prefix_bpe.Prefixes(v, bytes(rng.choice(b"abcdetion") for _ in range(3000)))
    for _ in range(60):
        a = rng.randint(0, len(table.data))
        b = min(len(table.data), a + rng.randint(0, 5))
        put = bytes(rng.choice(b"abcdetion") for _ in range(rng.randint(0, 6)))
        left = len(table.data) - b
        computed = table.replace(a, b, put)
        assert table.last == prefix_bpe.Prefixes(v, table.data).last
        assert computed <= len(put) + min(left, 12 * v.longest)
    # An edit at the end and one that empties the piece.
    table.replace(len(table.data) - 2, len(table.data), b"")
    assert table.last == prefix_bpe.Prefixes(v, table.data).last
    table.replace(0, len(table.data), b"")
    assert table.ids() == []


def test_edits_of_a_text_encode_few_pieces(encoder, library):
    rng = random.Random(6)
    text = some_text(rng, 500)
    held = prefix_bpe.TextIds(encoder, text)
    for _ in range(300):
        a = rng.randint(0, len(text))
        b = min(len(text), a + rng.randint(0, 4))
        put = some_text(rng, rng.randint(0, 3))
        text = text[:a] + put + text[b:]
        n = held.replace(a, b, put)
        assert held.text == text and held.ids == library.encode_ordinary(text)
        assert n < 60
    held.append(" and so on")
    assert held.ids == library.encode_ordinary(text + " and so on")


def test_a_vocabulary_with_unreachable_tokens():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"cd": 257, b"abc": 258, b"bc": 259, b"xyz": 260}
    library = tiktoken.Encoding("few", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = prefix_bpe.Encoder(ranks, public.PATTERN)
    rng = random.Random(7)
    for text in ["xyz", "xyza", "abcd", "bcd"] + ["".join(rng.choice("abcdxyz ") for _ in range(30)) for _ in range(300)]:
        (ids,) = encoder.encode([text])
        assert [int.from_bytes(ids[k : k + 4], "little") for k in range(0, len(ids), 4)] == library.encode_ordinary(text), text


def test_documents_of_every_kind(spark, ranks, library):
    texts = [*ODD, None, "same", "same", "long " * 60000]
    rows = [(k if k % 5 else None, t, "clash", k) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, N_Tokens string, k int").repartition(3)
    got = {r["k"]: r for r in prefix_bpe.encode_documents(docs, ranks, public.PATTERN).collect()}
    assert len(got) == len(rows)
    for k, text in enumerate(texts):
        want = library.encode_ordinary(text or "")
        assert got[k]["n_tokens"] == len(want) and bytes(got[k]["decoded"]) == (text or "").encode()
        assert bytes(got[k]["ids"]) == b"".join(i.to_bytes(4, "little") for i in want)
        assert got[k]["doc_id"] == rows[k][0]
    assert prefix_bpe.encode_documents(docs.limit(0), ranks, public.PATTERN).count() == 0
