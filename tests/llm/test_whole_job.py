"""Cases in which the corpus operators once did less than the whole job."""

import random

import numpy as np
from pyspark.sql import functions as F

from patronage.llm import embedding, jaccard, mixing, sharding

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_sharding_splits_few_prefixes_beside_a_hot_group():
    rng = np.random.default_rng(6)
    names = np.unique(rng.integers(0, 16**8, 200_000))
    sizes = rng.integers(1, 3000, len(names))
    sizes[len(names) // 3] = sizes.sum() // 2
    exact = sharding.least_capacity(sizes, 16)

    def summed(digits, prefix=""):
        low = int(prefix.ljust(8, "0"), 16)
        here = slice(*np.searchsorted(names, [low, low + 16 ** (8 - len(prefix))]))
        by, at, n = np.unique(names[here] >> 4 * (8 - digits), return_inverse=True, return_counts=True)
        return [sharding.Piece(f"{p:0{digits}x}", int(s), int(k)) for p, s, k in zip(by, np.bincount(at, sizes[here]), n, strict=True)]

    pieces, rounds = summed(4), 0
    while open_ := sharding.undecided(pieces, 16, int(sizes.max())):
        assert len(open_) <= 16 and rounds < 12
        finer = [q for k in open_ for q in summed(len(pieces[k].prefix) + 1, pieces[k].prefix)]
        pieces = sorted([p for k, p in enumerate(pieces) if k not in open_] + finer, key=lambda p: p.prefix)
        rounds += 1
    assert sharding.least_capacity(np.array([p.size for p in pieces]), 16) == exact


def test_mixing_draws_rows_without_a_clear_id_one_by_one(spark):
    rows = spark.range(12000).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).when(F.col("id") % 3 == 1, F.lit(7)).alias("doc_id"),
        F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).otherwise("same").alias("text"),
        F.lit("src9").alias("source"),
        F.lit(1).alias("row"),
    )
    outs = [mixing.mix(rows.repartition(n), {"src0": 0.3, "src1": 0.1}).collect() for n in (3, 7)]
    assert sorted(map(str, outs[0])) == sorted(map(str, outs[1]))
    assert len({r["order_key"] for r in outs[0]}) == len(outs[0])
    for doc, text in ((None, "same"), (7, "same"), (None, None), (7, None)):
        got = [r for r in outs[0] if r["doc_id"] == doc and (r["text"] == "same") == (text == "same")]
        # 2,000 draws at 0.6: the mean is 1,200 with a deviation of 35.
        assert abs(len(got) - 1200) < 175, (doc, text, len(got))
        assert {r["n_copies"] for r in got} >= {1, 2, 3}


def test_embeddings_over_many_keys_against_brute_force(spark):
    rng = np.random.default_rng(12)
    base = rng.normal(size=(1800, 6))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.normal(size=base.shape)
    side -= (side * base).sum(axis=1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = rng.uniform(0.92, 0.95, 1800)[:, None]
    x = np.concatenate([base, cosine * base + np.sqrt(1 - cosine**2) * side])
    rows = [(k, row.tolist(), 1) for k, row in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    assert 2 ** embedding.bands(len(x), 0.93)[0] >= 200
    got = {r["vec_id"]: r["n_links"] for r in embedding.near_duplicates(frame).collect()}
    linked = x @ x.T >= 0.93
    np.fill_diagonal(linked, False)
    assert linked.sum() > 2000
    assert got == dict(enumerate(linked.sum(axis=1).tolist()))


def test_pipeline_keeps_every_text_of_an_id_and_compares_null_ids(spark, tmp_path):
    import corpus_pipeline

    words = [" ".join(f"{name}{k}" for k in range(40)) for name in "abcde"]
    rows = [(1, words[0]), (2, words[0] + " end"), (2, words[1]), (2, words[1]), (3, words[2]), (None, words[2]), (None, words[3]), (None, words[3]), (4, words[4])]
    frame = spark.createDataFrame([(k, t, "en", "src0", len(t)) for k, t in rows], SCHEMA)
    for n in (1, 5):
        got = corpus_pipeline.near_duplicates(spark, frame.repartition(n), str(tmp_path)).collect()
        want = {(1, words[0]), (2, words[1]), (3, words[2]), (None, words[3]), (4, words[4])}
        assert len(got) == len(want) and {(r["doc_id"], r["text"]) for r in got} == want


def test_classes_without_link_counts_equal_those_of_all_links(spark):
    rng = random.Random(5)
    rows = []
    for group in range(2):  # chains of near copies, with steps between some that are too long for a link
        text = [f"g{group}w{k}" for k in range(120)]
        for k in range(80):
            for at in rng.sample(range(120), 4 if k % 16 == 15 else 1):
                text[at] = f"x{rng.random()}"
            rows.append(" ".join(text))
    rows += ["", None, "few words", rows[0], rows[0]]
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string").repartition(3)
    want = {r["doc_id"]: r["class_id"] for r in jaccard.similar_documents(frame).collect()}
    assert 5 < len(set(want.values())) < 100
    for block in (2, 5, 768):
        assert {r["doc_id"]: r["class_id"] for r in jaccard.similar_classes(frame, block=block).collect()} == want
    assert jaccard.similar_classes(frame.limit(0)).count() == 0


def test_open_pairs_grow_with_what_is_outside_the_largest_component(spark):
    members = spark.range(4000).selectExpr("id AS doc_id", "7L AS key", "4000L AS size")
    joined = members.select(F.col("doc_id").alias("id"), F.lit(0).cast("bigint").alias("component"))
    assert jaccard._open_pairs(members, joined, 100).count() == 0
    work = jaccard._open_pairs(members, joined.where("id % 400 != 3"), 100)
    rows = work.collect()
    assert len(rows) <= 10 * 41 + 3990
    pieces = {(r["i"], r["j"]) for r in rows}
    assert all(i == 0 for i, _ in pieces)
    strays = {r["doc_id"] for r in rows if r["blk"] == 0}
    assert strays == {k for k in range(4000) if k % 400 == 3} and {r["doc_id"] for r in rows} == set(range(4000))


def test_one_of_equal_rows_stays_beside_a_map_column(spark):
    rows = [(1, "a b c d e f", {"k": 1}), (1, "a b c d e f", {"k": 2}), (None, "g h i j k l", None), (None, "g h i j k l", {"k": 0})]
    got = jaccard.one_of_each_class(spark.createDataFrame(rows, "doc_id bigint, text string, more map<string,int>")).collect()
    assert sorted(r["text"] for r in got) == ["a b c d e f", "g h i j k l"]
