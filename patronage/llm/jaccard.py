"""N-gram Jaccard join with Bayesian candidate pruning.

Texts with the same word sequence form one class, of which one document stands for all.
Representatives get HASHES MinHash values of their SHINGLE-word shingles; those that
agree on all values of one of HASHES / BAND bands meet in a bucket.  In a bucket,
MinHash values are compared STEP at a time, and a pair is dropped as soon as the
posterior probability (uniform prior) that it reaches the threshold is below TOLERANCE.
What is left is verified exactly on the sets of shingles.

A pair is compared in the first band it shares only, and never becomes a row: tasks
report, per document, the links found and one connected document (llm.blocks).  Pairs
with a similarity of exactly the threshold are missed with a probability of
(1 - least**BAND) ** (HASHES / BAND), 3e-6 at 0.8, and less above it.

Where classes are wanted without link counts (similar_classes), a large bucket is first
compared with one block of its members, in proportion to its size.  Only members outside
the largest component so found are then compared with all others of the bucket, and a
pair of one component never: what is skipped is known to be connected.

Defined cases: a text of fewer than SHINGLE words has one shingle, all of its words; a
text without words (null, empty, white space) links with nothing and is its own class;
fully repeated rows count as copies; rows of one id with different texts are one document
with the links of all; a null id never stands for a class; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import Window as W

from patronage.functions.stages import cut
from patronage.llm.blocks import block_pairs, candidate_pairs, star, whole_groups
from patronage.llm.graph import components
from patronage.llm.words import grams, mix, signed, slices, starts_inside, words_of

SHINGLE, LEAST = 5, 0.8
HASHES, BAND, STEP = 96, 4, 16
TOLERANCE = 1e-7
BLOCK = 768
_U = np.uint64
_PAIRS_AT_ONCE = 1 << 16
_MULTIPLIERS = np.random.default_rng(11).integers(1, 2**63, HASHES, dtype=np.uint64) * _U(2) + _U(1)


def shingles_of(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each joined text end to end and sorted, their bounds, and a 128-bit hash of each word sequence."""
    words = words_of(data, starts)
    n_texts, counts = len(starts) - 1, words.counts
    at = np.flatnonzero(starts_inside(words.first, SHINGLE, max(0, len(words.hashes) - SHINGLE + 1)))
    owner, value = words.text_of()[at], grams(words.hashes, SHINGLE)[at]
    whole = np.zeros((2, n_texts), np.uint64)
    place = np.arange(len(words.hashes)) - np.repeat(words.first[:-1], counts)
    filled = np.flatnonzero(counts)
    for k in range(2):
        term = mix(words.hashes + mix(place.astype(_U) + _U(k << 40)))
        if len(filled):
            whole[k, filled] = np.add.reduceat(term, words.first[:-1][filled])
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    owner, value = np.concatenate([owner, short]), np.concatenate([value, mix(whole[0, short])])
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    owner, value = owner[new], value[new]
    return value, np.searchsorted(owner, np.arange(n_texts + 1)), whole


def minhash(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """HASHES MinHash values (32 bits) of each set; (sets, HASHES), zero for an empty set."""
    out = np.zeros((len(first) - 1, HASHES), np.uint32)
    filled = np.flatnonzero(np.diff(first))
    if len(filled):
        at = first[:-1][filled]
        for k in range(HASHES):
            out[filled, k] = np.minimum.reduceat(value * _MULTIPLIERS[k], at) >> _U(32)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key of the values in each band; (rows, bands)."""
    parts = signature.reshape(len(signature), HASHES // BAND, BAND).astype(_U)
    key = np.broadcast_to(np.arange(HASHES // BAND, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(BAND):
        key = mix(key * _U(0x9E3779B97F4A7C15) + parts[:, :, k])
    return key


def least_matches(least: float) -> list[int]:
    """For STEP, 2 * STEP, ... compared values, the fewest matches that keep a pair.

    With m of n matches the posterior of the similarity is Beta(m + 1, n - m + 1), and it
    reaches `least` with the probability that n + 1 trials succeed at most m times.
    """
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        total = 0.0
        for m in range(n + 1):
            total += comb(n + 1, m) * least**m * (1 - least) ** (n + 1 - m)
            if total >= TOLERANCE:
                out.append(m)
                break
    return out


def _signatures(docs: DataFrame) -> DataFrame:
    """doc_id, h1, h2 (of the word sequence), n (shingles), sig, bands: one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, to, data, starts in slices(batch["text"]):
                value, first, whole = shingles_of(data, starts)
                sig = minhash(value, first)
                bands = pa.ListArray.from_arrays(
                    pa.array(np.arange(to - lo + 1, dtype=np.int32) * (HASHES // BAND)), pa.array(signed(band_keys(sig)).ravel())
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(lo, to - lo),
                        pa.array(signed(whole[0])),
                        pa.array(signed(whole[1])),
                        pa.array(np.diff(first)),
                        pa.array([row.tobytes() for row in sig], pa.binary()),
                        bands,
                    ],
                    ["doc_id", "h1", "h2", "n", "sig", "bands"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(run, "doc_id bigint, h1 bigint, h2 bigint, n bigint, sig binary, bands array<bigint>")


def _sets(docs: DataFrame) -> DataFrame:
    """doc_id, n, sig, shingles (sorted, 64 bits each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, to, data, starts in slices(batch["text"]):
                value, first, _ = shingles_of(data, starts)
                raw = value.tobytes()
                bounds = zip((8 * first[:-1]).tolist(), (8 * first[1:]).tolist(), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(lo, to - lo),
                        pa.array(np.diff(first)),
                        pa.array([row.tobytes() for row in minhash(value, first)], pa.binary()),
                        pa.array([raw[a:b] for a, b in bounds], pa.binary()),
                    ],
                    ["doc_id", "n", "sig", "shingles"],
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, n bigint, sig binary, shingles binary")


def _kept_pairs(group: pa.Table, band: int, same: bool, fewest: list[int], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a piece of work that meet here first, are not known to be connected, are near in size and survive the pruning."""
    ids, n = group["doc_id"].to_numpy(), group["n"].to_numpy()
    known = group[_KNOWN].to_numpy() if _KNOWN in group.column_names else ids
    sig = np.frombuffer(b"".join(group["sig"].to_pylist()), np.uint32).reshape(len(ids), HASHES)
    keys = band_keys(sig)[:, :band]
    all_a, all_b = candidate_pairs(group["blk"].to_numpy(), same)
    kept_a, kept_b = [], []
    for lo in range(0, len(all_a), _PAIRS_AT_ONCE):
        a, b = all_a[lo : lo + _PAIRS_AT_ONCE], all_b[lo : lo + _PAIRS_AT_ONCE]
        near = (known[a] != known[b]) & (np.minimum(n[a], n[b]) >= least * np.maximum(n[a], n[b]))
        a, b = a[near], b[near]
        for k in range(band):
            new = keys[a, k] != keys[b, k]
            a, b = a[new], b[new]
        matches = np.zeros(len(a), np.int32)
        for step, few in enumerate(fewest):
            part = slice(step * STEP, (step + 1) * STEP)
            matches += (sig[a, part] == sig[b, part]).sum(axis=1, dtype=np.int32)
            stay = matches >= few
            a, b, matches = a[stay], b[stay], matches[stay]
        kept_a.append(a)
        kept_b.append(b)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *kept_a]), np.concatenate([none, *kept_b])


def _common(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sorted sets."""
    if len(a) < 2 * len(sets):
        return np.array([len(np.intersect1d(sets[p], sets[q], assume_unique=True)) for p, q in zip(a.tolist(), b.tolist(), strict=True)], np.int64)
    # Many pairs among few sets: count with a matrix of the shingles that two sets or more hold, some columns at a time.
    sizes = np.array([len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    owner = np.repeat(np.arange(len(sets)), sizes)
    use = shared[column]
    owner, column = owner[use], number[column[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    width = max(256, (1 << 21) // len(sets))
    for lo in range(0, int(shared.sum()), width):
        p, q = np.searchsorted(column, [lo, lo + width])
        holds = np.zeros((len(sets), width), np.float32)
        holds[owner[p:q], column[p:q] - lo] = 1
        total += holds @ holds.T
    return np.rint(total[a, b]).astype(np.int64)


_WORK = ["key", "i", "j"]
_KNOWN = "component"  # optional column: members of one component need no comparison


def _fields(work: DataFrame) -> list[str]:
    return [*_WORK, "band", "blk", "doc_id", "weight", *(c for c in work.columns if c == _KNOWN)]


def _survivors(work: DataFrame, least: float) -> DataFrame:
    """The members of each piece of work that have a pair left after pruning."""
    fewest, kept = least_matches(least), _fields(work)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, _WORK):
            bands, i, j = (table[c].to_numpy() for c in ("band", "i", "j"))
            take = []
            for lo, to in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if to - lo > 1:
                    a, b = _kept_pairs(table.slice(lo, to - lo), int(bands[lo]), i[lo] == j[lo], fewest, least)
                    take.append(lo + np.unique(np.concatenate([a, b])))
            if take:
                out = table.select(kept).take(pa.array(np.concatenate(take)))
                yield from out.combine_chunks().to_batches()

    dealt = work.select(*kept, "n", "sig").repartition(*_WORK).sortWithinPartitions(*_WORK)
    return dealt.mapInArrow(run, work.select(*kept).schema)


def _links(work: DataFrame, least: float) -> DataFrame:
    """doc_id, links, root: verified links of each member of a piece of work, counted with the copies of its partners."""
    fewest = least_matches(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, _WORK):
            bands, i, j = (table[c].to_numpy() for c in ("band", "i", "j"))
            ids, weight, n = (table[c].to_numpy() for c in ("doc_id", "weight", "n"))
            found: list[list[np.ndarray]] = [[], [], []]
            for lo, to in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if to - lo < 2:
                    continue
                group = table.slice(lo, to - lo)
                a, b = _kept_pairs(group, int(bands[lo]), i[lo] == j[lo], fewest, least)
                if not len(a):
                    continue
                common = _common([np.frombuffer(s, np.uint64) for s in group["shingles"].to_pylist()], a, b)
                size, own, ident = n[lo:to], weight[lo:to], ids[lo:to]
                similar = common >= least * (size[a] + size[b] - common) - 1e-9
                a, b = a[similar], b[similar]
                links = np.bincount(a, own[b], to - lo) + np.bincount(b, own[a], to - lo)
                order = np.argsort(ident, kind="stable")
                rank = np.argsort(order, kind="stable")
                root = ident[order[star(to - lo, rank[a], rank[b])[rank]]]
                linked = np.flatnonzero(links)
                for out, part in zip(found, (ident[linked], links[linked].astype(np.int64), root[linked]), strict=True):
                    out.append(part)
            if found[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in found], ["doc_id", "links", "root"])

    dealt = work.select(*_fields(work), "n", "sig", "shingles").repartition(*_WORK).sortWithinPartitions(*_WORK)
    return dealt.mapInArrow(run, "doc_id bigint, links bigint, root bigint")


def _buckets(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """Signatures of all documents, classes of equal word sequences, their representatives, these by bucket, and the sizes of shared buckets."""
    sigs = cut(_signatures(docs), "signatures")
    classes = cut(
        sigs.where("n > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("weight")).where("rep IS NOT NULL"), "classes"
    )
    reps = cut(
        sigs.join(classes.withColumnRenamed("rep", "doc_id"), ["h1", "h2", "doc_id"]).groupBy("doc_id", "h1", "h2", "weight", "n").agg(
            F.first("sig").alias("sig"), F.first("bands").alias("bands")
        ),
        "representatives",
    )
    keyed = reps.select("doc_id", "n", "weight", F.posexplode("bands").alias("band", "key"))
    met = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return sigs, classes, reps, keyed, met


def _compared(work: DataFrame, reps: DataFrame, docs: DataFrame, least: float) -> DataFrame:
    """doc_id, links, root of the members of pieces of work, pruned and then verified; stored."""
    near = cut(_survivors(work.join(reps.select("doc_id", "sig"), "doc_id"), least), "survivors")
    wanted = near.select("doc_id").distinct()
    sets = _sets(docs.select(F.col("doc_id").cast("bigint"), "text").join(wanted, "doc_id", "left_semi")).distinct()
    return cut(_links(near.join(sets, "doc_id"), least), "links")


def similar_documents(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, class_id (least doc_id reachable by links), n_links (documents linked directly): one row per document."""
    sigs, classes, reps, keyed, met = _buckets(docs)
    found = _compared(block_pairs(keyed.join(met, "key"), F.col("size"), F.col("doc_id"), BLOCK), reps, docs, least)
    counts = found.groupBy("doc_id").agg(F.sum("links").alias("links"))
    reach = components(found, "doc_id", "root")
    known = (
        classes.join(counts, F.col("rep") == counts["doc_id"], "left")
        .join(reach, F.col("rep") == reach["id"], "left")
        .select("h1", "h2", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("class_id"))
    )
    return (
        sigs.select("doc_id", "h1", "h2", "n")
        .join(known, ["h1", "h2"], "left")
        .select(
            "doc_id",
            F.when(F.col("n") > 0, F.coalesce("class_id", "doc_id")).otherwise(F.col("doc_id")).alias("class_id"),
            F.when(F.col("n") > 0, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("bigint").alias("n_links"),
        )
    )


def _open_pairs(members: DataFrame, reach: DataFrame, block: int) -> DataFrame:
    """Pieces of work on large buckets in which several components are left.

    Members outside a bucket's largest component fill its first blocks, those inside the
    others, and every pair of blocks that has one of the first is a piece of work.
    """
    component = F.coalesce("component", "doc_id")
    large = members.join(reach, members["doc_id"] == reach["id"], "left").withColumn(_KNOWN, component).drop("id")
    tops = (
        large.groupBy("key", _KNOWN)
        .agg(F.count(F.lit(1)).alias("n_in"))
        .groupBy("key")
        .agg(F.max_by(_KNOWN, F.struct("n_in", _KNOWN)).alias("top"), F.max("n_in").alias("inside"), F.sum("n_in").alias("all"))
        .where("inside < all")
    )
    blocks = lambda size: F.ceil(size / F.lit(float(block))).cast("int")
    left, right = blocks(F.col("all") - F.col("inside")), blocks(F.col("inside"))
    spread = F.xxhash64("doc_id", F.lit("open"))
    outside = F.col(_KNOWN) != F.col("top")
    own = F.when(outside, F.pmod(spread, left)).otherwise(left + F.pmod(spread, right)).cast("int")
    return (
        large.join(tops, "key")
        .withColumn("blk", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.when(outside, left + right).otherwise(left) - 1)))
        .withColumn("i", F.least("blk", "other"))
        .withColumn("j", F.greatest("blk", "other"))
        .drop("other", "top", "inside", "all")
    )


def similar_classes(docs: DataFrame, least: float = LEAST, block: int = BLOCK) -> DataFrame:
    """doc_id, class_id as similar_documents has them, without counting the links inside a class."""
    sigs, classes, reps, keyed, met = _buckets(docs)
    met = cut(met, "buckets")
    first = block_pairs(keyed.join(met, "key"), F.col("size"), F.col("doc_id"), block).where("i = 0")
    found = _compared(first, reps, docs, least)
    large = met.where(F.col("size") > block)
    if not large.isEmpty():
        reach = cut(components(found, "doc_id", "root"), "reach")
        rest = _compared(_open_pairs(keyed.join(large, "key"), reach, block), reps, docs, least)
        # A document that is already in a component brings it along.
        found = reach.select(F.col("id").alias("doc_id"), F.col("component").alias("root")).unionByName(rest.select("doc_id", "root"))
    reach = components(found, "doc_id", "root")
    known = classes.join(reach, F.col("rep") == reach["id"], "left").select("h1", "h2", F.coalesce("component", "rep").alias("class_id"))
    with_words = (F.col("n") > 0) & F.col("class_id").isNotNull()
    return sigs.join(known, ["h1", "h2"], "left").select("doc_id", F.when(with_words, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"))


def one_of_each_class(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """One row, of the least id, of each class of similar texts; a null or repeated id is compared by its text."""
    unclear = cut(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL").select("doc_id"), "unclear-ids")
    if unclear.isEmpty():
        first = similar_classes(docs, least).where("doc_id = class_id").select("doc_id")
        return docs.join(first, "doc_id", "left_semi").select(docs.columns)
    # A row is numbered by the place of its id, null last, and its text, so equal ones are one document.
    digest = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    texts = cut(docs.select("doc_id", digest.alias("digest")).distinct(), "texts")
    along = (F.col("doc_id").asc_nulls_last(), F.col("digest").asc())
    ranged = cut(texts.repartitionByRange(*along).sortWithinPartitions(*along).withColumn("part", F.spark_partition_id()), "ranged-texts")
    sizes = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    # One row per partition.
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(W.partitionBy("part").orderBy(*along))
    numbers = cut(ranged.withColumn("inside", inside).join(F.broadcast(offsets), "part").select(F.col("doc_id").alias("id"), "digest", (F.col("offset") + F.col("inside")).alias("number")), "numbers")
    rows = docs.select(F.struct("*").alias("row"), digest.alias("digest"))
    same = (F.col("row.doc_id").eqNullSafe(F.col("id"))) & (rows["digest"] == numbers["digest"])
    numbered = cut(rows.join(numbers, same).select("row", "number"), "numbered")
    classes = similar_classes(numbered.select(F.col("number").alias("doc_id"), "row.text"), least)
    first = classes.where("doc_id = class_id").select(F.col("doc_id").alias("number")).distinct()
    # Of rows that differ in other columns alone, the least as JSON: maps have no order of their own.
    one = numbered.join(first, "number", "left_semi").groupBy("number").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return one.select("row.*").select(docs.columns)
