"""The five stages of the corpus pipeline, each against a plain computation on its own input."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from patronage.llm import mixing, quality
from patronage.llm.queries import tokenizer_file

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Clean texts, junk, copies, near copies, a passage in many texts, null and repeated ids, null and empty texts."""
    rng, d = random.Random(11), str(tmp_path_factory.mktemp("tables"))
    words = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("a", "en", "il", "ora", "une", "as", "it")]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = text(50)
    clean = [text(rng.randint(30, 120)) for _ in range(80)]
    near = [" ".join(["swapped" if k == 9 else w for k, w in enumerate(t.split())]) for t in clean[:6]]
    shared = [f"{text(30)} {passage} {text(20)}" for _ in range(8)]
    junk = [" ".join(w + "#$%" for w in text(40).split()) for _ in range(60)]
    texts = clean + clean[10:14] + near + shared + junk + ["go " * 80, "short", "", None]
    rows = [(k, t, "en", f"src{k % 5}") for k, t in enumerate(texts)]
    rows += [(None, clean[20], "en", None), (None, clean[20], "en", None), (None, text(60), "en", "src0"), (3, text(70), "en", "src1"), rows[4], rows[4]]
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA).repartition(4).write.parquet(f"{d}/documents.parquet")
    marked = [(k, int("#" not in t), 0) for k, t, *_ in rows if k is not None and t and k % 4]
    spark.createDataFrame(marked, "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


@pytest.fixture(scope="module")
def stages(spark, tables):
    """Input and output of every stage."""
    docs, out = spark.read.parquet(f"{tables}/documents.parquet").cache(), []
    for _, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, tables).collect()
        out.append((docs.collect(), after))
        if len(out) < len(corpus_pipeline.STAGES):
            docs = spark.createDataFrame(after, docs.schema).cache()
    return out


def split(text):
    return [w.decode() for w in (text or "").encode().split()]


def test_quality_rules_drop_what_they_reject(spark, tables, stages):
    before, after = stages[0]
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    verdicts = quality.apply_rules(docs, quality.train_rules(docs, spark.read.parquet(f"{tables}/labels.parquet"))).where("kept").select(docs.columns).collect()
    assert Counter(after) == Counter(verdicts) and not Counter(after) - Counter(before)
    for r in before:
        w = split(r["text"])
        grams = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        cover = {k + i for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for i in range(5)}
        if len(w) < 10 or 100 * len(cover) > 20 * len(w):
            assert r not in after
    kept = {r["text"] for r in after}
    clean = [r["text"] for r in before if r["text"] and "#" not in r["text"] and len(split(r["text"])) >= 30 and "go go" not in r["text"]]
    assert np.mean([t in kept for t in clean]) > 0.97 and np.mean(["#" in t for t in kept]) < 0.03


def test_one_row_of_each_class_stays(stages):
    before, after = stages[1]
    keys = sorted({(r["doc_id"] is None, r["doc_id"] or 0, hashlib.md5((r["text"] or "").encode()).hexdigest(), r["text"]) for r in before})
    sets = [{tuple(split(k[3])[i : i + 5]) for i in range(max(1, len(split(k[3])) - 4))} for k in keys]
    parent = list(range(len(keys)))
    for a in range(len(keys)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) and parent[a] != parent[b]:
                low, high = sorted((parent[a], parent[b]))
                parent = [low if p == high else p for p in parent]
    want = Counter((None if keys[p][0] else keys[p][1], keys[p][3]) for p in set(parent))
    assert Counter((r["doc_id"], r["text"]) for r in after) == want and len(after) < len(before)


def test_repeated_passages_go(stages):
    before, after = stages[2]
    seen, want = {}, Counter()
    first = {}
    for r in sorted((r for r in before if r["doc_id"] is not None), key=lambda r: r["doc_id"]):
        w = split(r["text"])
        for s in range(len(w) - 19):
            first.setdefault(tuple(w[s : s + 20]), (r["doc_id"], s))
    for r in before:
        w, gone = split(r["text"]), set()
        if r["doc_id"] is not None:
            for s in range(len(w) - 19):
                if first[tuple(w[s : s + 20])] < (r["doc_id"], s):
                    gone.update(range(s, s + 20))
        want[r["doc_id"], tuple(x for k, x in enumerate(w) if k not in gone)] += 1
    assert Counter((r["doc_id"], tuple(split(r["text"]))) for r in after) == want
    assert sum(len(split(r["text"])) for r in after) < sum(len(split(r["text"])) for r in before) and not seen


def test_sources_are_drawn_at_their_rates(stages):
    before, after = stages[3]
    name = [r["source"] if r["source"] in mixing.SHARES else None for r in before]
    count, ids = Counter(name), Counter(r["doc_id"] for r in before)
    rest = 1 - sum(mixing.SHARES.values())
    drawn = Counter(r for r in after)
    for r, own in zip(before, name, strict=True):
        if r["doc_id"] is None or ids[r["doc_id"]] > 1:
            continue  # drawn by more than the id: tested with the operator
        rate = (rest if own is None else mixing.SHARES[own]) * len(before) / count[own]
        u = int(hashlib.md5(f"{r['doc_id']}:{mixing.SEED}".encode()).hexdigest()[:13], 16) / 16**13
        k, p, total = 0, np.exp(-rate), np.exp(-rate)
        while total <= u:
            k += 1
            p *= rate / k
            total += p
        assert drawn[r] == k
    assert set(after) <= set(before)


def test_all_tokens_are_packed(stages):
    from tokenizers import Tokenizer

    before, after = stages[4]
    encoder, want, got = Tokenizer.from_file(tokenizer_file()), Counter(), defaultdict(list)
    for r in before:
        want[r["doc_id"], tuple([*encoder.encode(r["text"] or "", add_special_tokens=False).ids, 0])] += 1
    for p in sorted(after, key=lambda p: (p["sequence_id"], p["offset"])):
        got[p["sequence_id"]].append(p)
    whole, ids = Counter(), []
    doc = None
    for sequence in sorted(got):
        at = 0
        for p in got[sequence]:
            assert p["offset"] == at
            at += p["length"]
            doc, ids = (p["doc_id"], []) if p["start"] == 0 else (doc, ids)
            ids += np.frombuffer(p["ids"], "<u4").tolist()
            if len(ids) == p["doc_tokens"]:
                whole[doc, tuple(ids)] += 1
        assert at <= corpus_pipeline.WIDTH
    assert whole == want


def test_run_is_the_stages_and_empty_tables_pass(spark, tables, stages, tmp_path):
    got = corpus_pipeline.run(spark, tables).collect()
    key = lambda p: (p["doc_id"], p["start"], p["length"], bytes(p["ids"]))
    assert Counter(p["doc_id"] for p in got if p["start"] == 0) == Counter(p["doc_id"] for p in stages[4][1] if p["start"] == 0)
    assert sum(p["length"] for p in got) == sum(p["length"] for p in stages[4][1]) and key(got[0])
    nothing = spark.createDataFrame([], SCHEMA + ", extra map<string,string>")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, nothing, tables)
        assert out.count() == 0 and (name == "packing" or out.columns == nothing.columns)
