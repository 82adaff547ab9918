"""The corpus operators on small fixtures: brute force, round trips and the defined edge cases."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from patronage.llm import chat, embedding, features, jaccard, language, mixing, packing, quality, sharding, substring, tokens
from patronage.llm.automaton import SuffixAutomaton
from patronage.llm.graph import components
from patronage.llm.queries import ORACLES, QUERIES, tokenizer_file
from patronage.llm.words import slices, text_bytes
from tests.compare import connect, difference

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string"
WORDS = [f"w{k}" for k in range(400)]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies, shared passages, repeats inside a text, nulls, empty and long texts, repeated rows."""
    rng = random.Random(4)
    passage = sentence(rng, 60)
    texts = [sentence(rng, rng.randint(5, 150)) for _ in range(60)]
    texts += [texts[k] for k in (0, 0, 1, 2)]
    for k in range(3, 9):
        words = texts[k].split()
        words[len(words) // 2] = "changed"
        texts.append(" ".join(words))
    texts += [f"{sentence(rng, 10)} {passage} {sentence(rng, 7)}" for _ in range(12)]
    texts += ["go " * 70, "a b c " * 30, "x", "", "   ", None, sentence(rng, 6000), "é ü ß  ñ\tq\n\nr"]
    rows = [(k, t, "en", f"src{k % 4}", len(t or ""), "clash") for k, t in enumerate(texts)]
    return rows + [rows[5], (None, passage, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def split(text):
    return [w.decode() for w in (text or "").encode().split()]


def test_automaton_finds_first_places():
    rng = random.Random(1)
    text = [rng.choice("abc") for _ in range(300)]
    a = SuffixAutomaton()
    a.add(text, 0)
    ends = a.first_ends(4)
    probe = [rng.choice("abc") for _ in range(200)]
    got = dict(a.matches(probe, 4, ends))
    for i in range(3, 200):
        at = next((k for k in range(3, 300) if text[k - 3 : k + 1] == probe[i - 3 : i + 1]), None)
        assert got.get(i) == at


@pytest.mark.parametrize("hot", [substring.HOT, 3])
def test_substring_dedup_against_brute_force(docs, corpus, nothing, hot):
    clashing = docs.select("doc_id", "text", *(F.lit(7).alias(c) for c in ("_id", "_cuts", "_VERSION", "version", "anchor", "N_words")))
    got = {r["doc_id"]: r for r in substring.remove_repeats(clashing, hot).collect()}
    assert all((r["_id"], r["_cuts"], r["_VERSION"]) == (7, 7, 7) for r in got.values())
    seen, rows = {}, {r[0]: r[1] for r in corpus if r[0] is not None}
    for doc in sorted(rows):
        words = split(rows[doc])
        gone = set()
        for s in range(len(words) - 19):
            key = tuple(words[s : s + 20])
            if key in seen:
                gone.update(range(s, s + 20))
            seen.setdefault(key, doc)
        assert (got[doc]["n_words"], got[doc]["n_removed"]) == (len(words), len(gone)), doc
        assert split(got[doc]["text"]) == [w for k, w in enumerate(words) if k not in gone]
    assert got[None]["n_removed"] == 0
    assert substring.remove_repeats(nothing.select("doc_id", "text")).count() == 0


def test_jaccard_against_brute_force(docs, corpus, nothing):
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.similar_documents(docs).collect() if r["doc_id"] is not None}
    sets = {}
    for doc, text, *_ in corpus:
        w = split(text)
        sets[doc] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    copies = Counter(r[0] for r in corpus)
    links, parent = defaultdict(int), {d: d for d in sets}
    ids = [d for d in sets if d is not None]
    for a in ids:
        links[a] += copies[a] - 1 if sets[a] else 0
        for b in ids:
            if a != b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                links[a] += copies[b]
                x, y = parent[a], parent[b]
                for d in ids:
                    if parent[d] in (x, y):
                        parent[d] = min(x, y)
    # The row with the null id shares no text with others.
    assert got == {d: (parent[d], links[d]) for d in ids}
    assert jaccard.similar_documents(nothing).count() == 0


def test_posterior_keeps_likely_pairs():
    assert all(few <= 0.8 * n for few, n in zip(jaccard.least_matches(0.8), range(16, 97, 16), strict=True))


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(20)] + [(100, 100 + k) for k in range(1, 30)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()}
    assert got == {k: 0 for k in range(21)} | {k: 100 for k in range(100, 130)}


def test_packing_round_trip(docs, corpus, nothing):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(tokenizer_file())
    pieces = packing.pack(docs, tokenizer_file(), 64).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"] > 0
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    texts = {r[0]: r[1] for r in corpus}
    times = Counter(r[0] for r in corpus)
    for doc, text in texts.items():
        ids = encoder.encode(text or "", add_special_tokens=False).ids + [0]
        assert sum(p["length"] for p in by_doc[doc]) == times[doc] * len(ids)
        for p in by_doc[doc]:
            assert p["doc_tokens"] == len(ids)
            assert np.frombuffer(p["ids"], "<u4").tolist() == ids[p["start"] : p["start"] + p["length"]]
    for sequence in by_sequence.values():
        sequence.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in sequence] == np.cumsum([0, *[p["length"] for p in sequence]])[:-1].tolist()
        assert sum(p["length"] for p in sequence) <= 64
    assert packing.pack(nothing, tokenizer_file()).count() == 0


def test_added_tokens_match_as_in_the_library():
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(tokenizer_file()), tokens.Tokenizer(tokenizer_file())
    special = "<|endoftext|>"
    texts = [special, f"a{special}b", f"a {special} b", f"a  {special}  b\n", f"{special}{special}x", f"it'{special}s", f"<|endoftext{special}|>", "<|endoftext |>", f"é{special}\u3000{special} "]
    rng = random.Random(3)
    texts += ["".join(rng.choice([special, " ", "  ", "word", "'s", "<|", "|>", "\n"]) for _ in range(12)) for _ in range(200)]
    ids, first = own.encode(*text_bytes(pa.array(texts)))
    for k, text in enumerate(texts):
        assert ids[first[k] : first[k + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_hilbert_neighbours_touch():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij")).reshape(3, -1)
    path = grid[:, np.argsort(packing.hilbert_key(grid, 3))]
    assert (np.abs(np.diff(path, axis=1)).sum(axis=0) == 1).all()


def test_sharding_is_minimax(docs, corpus, nothing):
    rows = sharding.shard(docs, 6).collect()
    assert len(rows) == len(corpus)
    sizes, shard_of = Counter(), {}
    for r in rows:
        sizes[r["digest"]] += r["size"]
        assert shard_of.setdefault(r["digest"], r["shard"]) == r["shard"]
    left, total = 6, sum(sizes.values())
    for g in sorted(sizes, key=lambda g: (-sizes[g], g)):
        if left == 1 or sizes[g] * left < total:
            break
        assert sum(sizes[x] for x in sizes if shard_of[x] == shard_of[g]) == sizes[g] and shard_of[g] == 6 - left
        left, total = left - 1, total - sizes[g]
    order = [g for g in sorted(sizes) if shard_of[g] >= 6 - left]

    def fits(capacity):
        used, load = 1, 0
        for g in order:
            if sizes[g] > capacity:
                return False
            if load + sizes[g] > capacity:
                used, load = used + 1, 0
            load += sizes[g]
        return used <= left

    best = next(c for c in range(max(sizes[g] for g in order), total + 1) if fits(c))
    loads = Counter()
    for g in order:
        loads[shard_of[g]] += sizes[g]
    assert max(loads.values()) == best and len(loads) == left
    assert [shard_of[g] for g in order] == sorted(shard_of[g] for g in order)
    for g in sizes:
        loads.setdefault(shard_of[g], 0)
    for s in loads:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    texts = {r[0]: (r[1] or "").encode() for r in corpus}
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]]) and r["size"] == len(texts[r["doc_id"]]) + 1 for r in rows)
    assert sharding.shard(nothing).count() == 0


def test_sharding_splits_prefixes_until_exact():
    rng = np.random.default_rng(2)
    groups = {f"{k:06x}": int(v) for k, v in zip(rng.choice(16**6, 900, replace=False), rng.integers(1, 500, 900), strict=True)}
    names = sorted(groups)
    exact = sharding.least_capacity(np.array([groups[g] for g in names]), 7)

    def summed(digits):
        by = defaultdict(list)
        for g in names:
            by[g[:digits]].append(groups[g])
        return [sharding.Piece(p, sum(v), len(v)) for p, v in sorted(by.items())]

    pieces = summed(1)
    while open_ := sharding.undecided(pieces, 7, max(groups.values())):
        split_ = {pieces[k].prefix for k in open_}
        finer = [q for p in split_ for q in summed(len(p) + 1) if q.prefix.startswith(p)]
        pieces = sorted([p for p in pieces if p.prefix not in split_] + finer, key=lambda p: p.prefix)
    assert sharding.least_capacity(np.array([p.size for p in pieces]), 7) == exact


@pytest.mark.parametrize("share", [0.1, 0.33, 0.5])
def test_sharding_is_even_beside_a_hot_text(spark, share):
    """Rows without an id among the copies; all 16 shards are used and the others are near equal."""
    n = 3000
    texts = F.when(F.col("id") < int(share * n), F.lit("hot " * 40)).otherwise(F.concat(F.lit("t" * 60), F.col("id").cast("string"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int") * 4)))
    docs = spark.range(n).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("doc_id"), texts.alias("text"))
    rows = sharding.shard(docs).collect()
    loads, slots = Counter(), defaultdict(list)
    for r in rows:
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert len(rows) == n and sorted(loads) == list(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    others = [v for k, v in loads.items() if k > 0]
    assert max(others) / min(others) < 1.1 and loads[0] >= max(others)


def test_even_cuts_keep_the_capacity():
    rng = np.random.default_rng(3)
    for _ in range(300):
        sizes, n_shards = rng.integers(1, rng.choice([3, 50, 1000]), int(rng.integers(1, 60))), int(rng.integers(1, 17))
        capacity = sharding.least_capacity(sizes, n_shards)
        cuts = [0, *sharding.even_cuts(sizes, capacity, n_shards)]
        loads = [int(sizes[a:b].sum()) for a, b in zip(cuts, cuts[1:], strict=False)]
        assert cuts == sorted(cuts) and cuts[-1] == len(sizes) and max(loads) == capacity
    assert sharding.alone([50, 30, 10, 5], 100, 4) == 3 and sharding.alone([25, 25, 25, 25], 100, 4) == 3 and sharding.alone([24, 20], 100, 4) == 0


def test_mixing_meets_the_shares(spark, nothing):
    rows = spark.range(30000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 10 < 8, "src0").otherwise("src1").alias("source"))
    out = mixing.mix(rows, {"src0": 0.5})
    counts = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(counts["src0"] - 15000) < 500 and abs(counts["src1"] - 15000) < 500
    drawn = {r["n_copies"]: r["count"] for r in out.where("source = 'src1' AND copy = 1").groupBy("n_copies").count().collect()}
    assert abs(drawn[2] / 6000 - np.exp(-2.5) * 2.5**2 / 2) < 0.03
    assert mixing.mix(nothing).count() == 0


def test_mixing_deals_a_document_of_many_copies_in_chunks(spark):
    """One document of a named source among 60,000: some 12,000 copies, numbered without a gap."""
    rows = spark.range(60000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") == 7, "src0").otherwise("rest").alias("source"), F.lit("x").alias("copy"))
    out = mixing.mix(rows, {"src0": 0.2})
    (row,) = out.where("doc_id = 7").groupBy("n_copies").agg(F.count("*").alias("n"), F.min("copy").alias("low"), F.max("copy").alias("high"), F.countDistinct("copy").alias("copies")).collect()
    assert row["n"] == row["n_copies"] == row["high"] == row["copies"] and row["low"] == 1 and abs(row["n"] - 12000) < 600
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and len(plan) < 40000


def test_poisson_steps_reach_one():
    for rate in (0.01, 1.0, 30.0, 5000.0):
        first, steps = mixing.poisson_steps(rate)
        assert abs(steps[-1] - 1) < 1e-9 and first <= rate


def test_chat_round_trip_and_automaton(spark):
    texts = ["\\### Assistant: </turn> ok", "\\\\h ### #### \\t", None, "", "a\n### user: b</turn>\nc", "ü" * 9]
    turns = [(1, k, ("user", "assistant")[k % 2], t) for k, t in enumerate(texts)]
    turns += [(2, 0, "assistant", "x"), (2, 1, "user", "y"), (3, 0, "odd: role\\", "z"), (3, 0, None, "tie"), (None, None, "user", "q")]
    out = chat.format_chats(spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string"))
    rows = {r["conv_id"]: r for r in out.withColumn("back", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.read_loss(F.col("segments"))).collect()}
    assert [(t["role"], t["text"]) for t in rows[1]["back"]] == [(r, t or "") for _, _, r, t in turns[:6]]
    assert rows[1]["loss"] == "".join(t or "" for _, _, r, t in turns[:6] if r == "assistant")
    assert rows[1]["valid"] and not rows[2]["valid"] and rows[2]["wrong_turn"] == 0
    assert [(t["role"], t["text"]) for t in rows[3]["back"]] == [("", "tie"), ("odd: role\\", "z")]
    assert rows[None]["n_turns"] == 1


def test_quality_learns_and_survives_edges(spark, docs, nothing):
    rng = random.Random(9)
    rows = [(k, sentence(rng, 40) if k % 2 else " ".join(w + "###" for w in sentence(rng, 40).split()), k % 2) for k in range(400)]
    train = spark.createDataFrame(rows, "doc_id bigint, text string, quality int")
    model = quality.train_classifier(train, train, quality.train_fold(F.col("doc_id")))
    held = [(r["score"] >= 0.5) == (r["quality"] == 1) for r in quality.score_quality(train.where(features.fold(F.col("doc_id"), 5) == 0), model).collect()]
    assert np.mean(held) > 0.97
    rules = quality.train_rules(train, train)
    out = quality.apply_rules(docs, rules)
    assert out.count() == docs.count() and "score" in out.columns
    verdicts = {r["doc_id"]: r for r in quality.apply_rules(train, rules).collect()}
    assert np.mean([verdicts[k]["kept"] == (q == 1) for k, _, q in rows]) > 0.97
    assert quality.score_quality(docs, quality.train_classifier(docs, nothing.selectExpr("doc_id", "1 AS quality"), F.lit(True))).where("score != 0.5").count() == 0
    assert quality.apply_rules(nothing, rules).count() == 0


def test_base_counts_against_brute_force(corpus):
    import re

    texts = [r[1] for r in corpus] + ["#a $b\n\n x y\nx y\n x y\n", "a b c d e f a b c d e g", "é" * 12 + " |<>"]
    for text in texts:
        ((_, _, data, starts),) = slices(pa.array([text], pa.string()))
        c, t = features.base_counts(data, starts), text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        count = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        cover = {k + i for k in range(len(w) - 4) if count[tuple(w[k : k + 5])] > 1 for i in range(5)}
        want = len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover)
        assert (c.n_words[0], c.word_chars[0], c.n_symbols[0], c.n_dup_lines[0], c.n_repeat_words[0]) == want


def test_language_gradient_and_labels(spark, docs, nothing):
    rng = np.random.default_rng(0)
    d = language.Direction.new(rng)
    x = rng.integers(97, 105, (7, 5)).astype(np.uint8)
    target = rng.normal(size=(7, language.HIDDEN, 5)).astype(np.float32)
    trace = []
    d.run(x, trace)
    grad, _ = d.gradient(x, trace, target)
    at = (2 * language.HIDDEN + 1, int(x[0, 0]))
    d.enter = d.enter.astype(np.float64)
    losses = []
    for step in (1e-3, -1e-3):
        d.enter[at] += step
        losses.append(float((d.run(x) * target).sum()))
        d.enter[at] -= step
    assert abs((losses[0] - losses[1]) / 2e-3 - grad[at]) < 2e-2 * (1 + abs(grad[at]))
    r = random.Random(5)
    rows = [(k, " ".join(r.choice(("the and of", "der die und")[k % 2].split()) for _ in range(60)), ("en", "de")[k % 2]) for k in range(200)]
    train = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    net = language.learn(train, language.train_fold(F.col("doc_id")))
    assert np.mean([x["lang"] == x["lang_pred"] for x in language.identify(train, net).collect()]) > 0.97
    out = {x["doc_id"]: x["lang_pred"] for x in language.identify(docs, net).collect()}
    assert len(out) == docs.select("doc_id").distinct().count() and "und" in out.values()
    assert language.identify(docs, language.learn(nothing, F.lit(True))).where("lang_pred != 'und'").count() == 0


def test_language_reads_whole_texts_with_their_neighbours(monkeypatch):
    rng = np.random.default_rng(2)
    net = language.Network(["a", "b"], language.Direction.new(rng), language.Direction.new(rng), rng.normal(size=(2, 2 * language.HIDDEN + 1)).astype(np.float32))
    texts = ["", "x", "é" * 500, "plain words " * 40, "日本語" * 70, "y" * language.STRIDE, "z" * (language.STRIDE + 1)]
    data, starts = text_bytes(pa.array(texts))
    begin, low, high, end, owner = language.stretches(data, starts)
    covered = np.zeros(len(data), int)
    for a, b in zip(low, high, strict=True):
        covered[a:b] += 1
    assert (covered == 1).all() and (end - begin <= language.CHUNK).all() and ((data[begin] & 0xC0) != 0x80).all()
    # Position by position: the mean over every byte of the probabilities of the stretch it counts in.
    got = net.pooled(data, starts)
    for k, text in enumerate(texts):
        raw, total = text.encode(), np.zeros(2)
        for i in np.flatnonzero(owner == k):
            window = data[begin[i] : end[i]].tobytes().ljust(language.CHUNK)
            p = net.probabilities(np.frombuffer(window, np.uint8)[:, None])[:, :, 0]
            total += p[:, low[i] - begin[i] : high[i] - begin[i]].sum(axis=1)
        assert np.allclose(got[k], total / max(1, len(raw)), atol=1e-5)
    assert b"".join(language.pieces(b"q" * 50)) == b"q" * 50 + b" " * (language.CHUNK - 50)
    long = bytes(rng.integers(97, 122, 777).astype(np.uint8))
    assert len(language.pieces(long)) == 8 and language.pieces(long)[-1] == long[-language.CHUNK :] and language.pieces(long)[0] == long[: language.CHUNK]


def test_language_samples_rare_labels(spark, monkeypatch):
    """A label on one row in a thousand is learned, and as many rows reach the driver whatever the size."""
    monkeypatch.setattr(language, "SAMPLE_DOCS", 200)
    seen = []
    monkeypatch.setattr(language, "train", lambda excerpts, labels: seen.append(labels))
    rows = spark.range(20000).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"), F.when(F.col("id") % 1000 == 0, "rare").otherwise("often").alias("lang"))
    language.learn(rows, F.lit(True))
    assert Counter(seen[0]) == {"often": 100, "rare": 20}


def test_embeddings_of_a_large_group_of_copies(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=8)
    near = x + rng.normal(size=8) * 0.01
    rows = [(k, x.tolist(), 1) for k in range(10, 4010)] + [(5, near.tolist(), 1), (6, (-x).tolist(), 1), (7, x.tolist(), 2), (8, x.tolist(), 3), (8, near.tolist(), 3)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = {tuple(r) for r in embedding.near_duplicates(frame).collect()}
    assert got == {(k, 4000, 5, k == 5) for k in (5, *range(10, 4010))} | {(k, 0, k, True) for k in (6, 7, 8)}
    _, classes = embedding.copy_classes(embedding.usable(frame))
    assert classes.count() == 6


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 16))
    x = centres[rng.integers(0, 12, 300)] + rng.normal(size=(300, 16)) * rng.choice([0.05, 0.2, 0.6], 300)[:, None]
    rows = [(k, [float(v) for v in row], int(k % 3)) for k, row in enumerate(x)]
    odd = [(900, None, 1), (901, [0.0] * 16, 1), (902, [None, 1.0], 1), (903, [float("nan")] * 16, 1), (904, rows[0][1], None), (905, [1.0, 2.0], 1)]
    got = {r["vec_id"]: r for r in embedding.near_duplicates(spark.createDataFrame(rows + odd + [rows[7]], "vec_id bigint, embedding array<double>, label int")).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.93) & ((np.arange(300) % 3)[:, None] == (np.arange(300) % 3)[None, :])
    np.fill_diagonal(linked, False)
    reach = linked | np.eye(300, dtype=bool)
    for _ in range(9):
        reach = reach @ reach
    for k in range(300):
        assert (got[k]["n_links"], got[k]["component_id"], got[k]["kept"]) == (linked[k].sum(), reach[k].argmax(), reach[k].argmax() == k)
    assert all(got[k]["n_links"] == 0 and got[k]["component_id"] == k for k in range(900, 906))


def test_embeddings_recall_on_diffuse_vectors_and_borderline_pairs(spark, monkeypatch):
    """2,500 vectors of one label, more than 100 keys a band, and 500 pairs just above the threshold."""
    monkeypatch.setattr(embedding, "BLOCK", 64)
    rng = np.random.default_rng(12)
    x = rng.normal(size=(2500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for k in range(0, 1000, 2):
        across = x[k + 1] - (x[k + 1] @ x[k]) * x[k]
        c = 0.9301 + 0.0001 * (k % 90)
        x[k + 1] = c * x[k] + np.sqrt(1 - c * c) * across / np.linalg.norm(across)
    # A large group of near copies that share most keys, larger than a block.
    x[1000:1300] = x[1000] + rng.normal(size=(300, 64)) * 0.02
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.93
    np.fill_diagonal(linked, False)
    frame = spark.createDataFrame([(k, row.tolist(), 1, "clash") for k, row in enumerate(x)], "vec_id bigint, embedding array<double>, label int, no string")
    got = {r["vec_id"]: r for r in embedding.near_duplicates(frame).collect()}
    found = np.array([got[k]["n_links"] for k in range(len(x))])
    assert (found <= linked.sum(axis=1)).all()
    assert found.sum() >= 0.997 * linked.sum()
    assert (found[1000:1300] == linked[1000:1300].sum(axis=1)).mean() > 0.99
    assert {got[k]["component_id"] for k in range(1000, 1300)} == {1000}


def test_codes_estimate_inner_products_without_bias():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = x * 0.8 + 0.6 * rng.normal(size=x.shape) / np.sqrt(48)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    bits, factor, entries, step = embedding.code(x)
    signs = np.unpackbits(bits, axis=1, count=48) * 2.0 - 1
    estimate = np.einsum("pd,pd->p", signs, y @ embedding.rotation(48)) / (np.sqrt(48) * factor)
    exact = np.einsum("pd,pd->p", x, y)
    error = np.sqrt((1 - factor**2) / 47) / factor * np.sqrt(1 - exact**2)
    assert abs((estimate - exact).mean()) < 4 * error.mean() / np.sqrt(4000)
    assert 0.8 < ((estimate - exact) / error).std() < 1.2
    assert np.abs(entries * step[:, None] - x @ embedding.rotation(48)).max() < 0.005
    assert embedding.bands(1000, 0.93)[0] == 10 and embedding.bands(10**6, 0.93)[0] == 17


def test_embeddings_of_nothing(spark):
    assert embedding.near_duplicates(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int, extra string")).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    assert difference(QUERIES[name](spark, sf), connect(sf), ORACLES[name]) is None


def test_pipeline_keeps_the_columns(spark, docs, tmp_path):
    import corpus_pipeline

    d = str(tmp_path)
    docs.drop("score").where("doc_id IS NOT NULL").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(k, k % 2, 0) for k in range(20)], "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    rows = spark.read.parquet(f"{d}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, d)
        assert out.columns == rows.columns
        rows = spark.createDataFrame(out.collect(), rows.schema)
    assert corpus_pipeline.run(spark, d).count() > 0


def test_text_bytes_of_slices_and_nulls():
    data, starts = text_bytes(pa.array(["ab", None, "é"]).slice(1))
    assert bytes(data).decode() == "é" and starts.tolist() == [0, 0, 2]
