"""Near-duplicate vectors by randomised-rotation binary codes with error bounds.

Every vector is rotated at random.  Stored are its sign bits with the correction factor
that makes their inner products unbiased, its rotated entries in bytes, and the keys of
`bands`: groups of sign bits along further random directions.  Vectors of one label that share the key
of a band are compared by the stored codes alone: the estimates of their inner product, one
from either side's bits, and the bound of their error decide which may reach the threshold.
The original vectors are fetched for these only, and each pair is recomputed in double
precision in the first band it shares.

A pair is found if it shares a band.  Bits of vectors with cosine c agree with probability
1 - arccos(c) / pi, so the number of bands follows from MISS, the probability that a pair at
the threshold shares none (pairs above it are missed more rarely); the length of the keys
grows with the largest label, so that keys hold few vectors by chance.  Tests measure the
recall.  Rows of one label with the same vector form a class first, of which one stands for
all and counts with its copies; keys of any size are compared block by block, and pairs
never become rows.

Defined cases: vectors that are null, zero or hold null or non-finite components, and
rows with a null label or id, link with nothing and stand for themselves; vectors of
different lengths are never compared; fully repeated rows are one vector, of which each
row carries the result; rows of one id with different vectors share its links, and of
several ids that tie for a component the least names it; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from patronage.functions.stages import cut
from patronage.llm.blocks import block_pairs, star, whole_groups
from patronage.llm.graph import components

MISS = 1e-4  # probability that a pair exactly at the threshold shares no band
LEAST_BITS, CROWD = 10, 3  # bits of a key: at least, and by how many fewer than the largest label's size has
BLOCK = 1024
PAIRS_AT_ONCE = 1 << 16
CONFIDENCE = 4.0  # standard errors of the estimate that the bound allows
_ROUNDING = 0.01  # of entries kept in bytes


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label, embedding of distinct vectors that can be compared."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    nonzero = F.exists("embedding", lambda x: x != 0)
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.where(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite & nonzero).distinct()


def copy_classes(good: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The usable vectors, and their numbered classes of copies (label, embedding, own, vec_id, weight, no) with the least id and the number of ids.

    An id with several vectors is in no class with others (own is its id, else null).
    """
    several = good.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("vec_id", F.col("vec_id").alias("own"))
    rows = cut(good.join(several, "vec_id", "left"), "vectors")
    classes = rows.groupBy("label", "embedding", "own").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("weight"))
    return rows, cut(classes.withColumn("no", F.monotonically_increasing_id()), "classes")


def unit(rows: list) -> np.ndarray:
    """Vectors divided by their length, scaled first so that no square overflows."""
    x = np.asarray(rows, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@lru_cache(maxsize=16)
def rotation(d: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(d).standard_normal((d, d)))[0]


@lru_cache(maxsize=16)
def directions(d: int, n: int) -> np.ndarray:
    return np.random.default_rng([d, n]).standard_normal((d, n))


def bands(largest: int, least: float) -> tuple[int, int]:
    """Bits of a key, and number of bands, for labels of at most so many vectors."""
    bits = max(LEAST_BITS, math.ceil(math.log2(max(2, largest))) - CROWD)
    agree = (1 - math.acos(min(1.0, max(-1.0, least))) / math.pi) ** bits
    return bits, 1 if agree >= 1 else math.ceil(math.log(MISS) / math.log1p(-agree))


def band_keys(x: np.ndarray, bits: int, n_bands: int) -> np.ndarray:
    """Keys of unit vectors, (vectors, bands): sign bits along independent directions."""
    signs = x @ directions(x.shape[1], bits * n_bands) >= 0
    return signs.reshape(len(x), n_bands, bits) @ (1 << np.arange(bits))


def code(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sign bits (packed), correction factor, entries in bytes and their unit, of unit vectors in the rotation."""
    d = x.shape[1]
    turned = x @ rotation(d)
    unit_ = np.abs(turned).max(axis=1) / 127
    return np.packbits(turned >= 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(d), np.rint(turned / unit_[:, None]).astype(np.int8), unit_


def may_link(signs: np.ndarray, factor: np.ndarray, entries: np.ndarray, a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Which pairs' upper bound reaches `least`.  signs are -1 and 1, entries the rotated vectors.

    The sign bits' product with a vector, over the factor, estimates the inner product without
    bias; its error is that of the bits times the vector's part across, which is small for likely pairs.
    """
    d = signs.shape[1]
    scaled = signs / (np.sqrt(d) * factor[:, None])
    estimate = (np.einsum("pd,pd->p", scaled[a], entries[b]) + np.einsum("pd,pd->p", scaled[b], entries[a])) / 2
    error = np.sqrt(np.maximum(1 - factor**2, 0) / max(d - 1, 1)) / factor * np.sqrt(max(0.0, 1 - least**2))
    return estimate >= least - CONFIDENCE * (error[a] + error[b]) / 2 - _ROUNDING


def pairs_of(bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows within the groups that begin at the bounds, in slices."""
    end = np.repeat(bounds[1:], np.diff(bounds))
    count = end - np.arange(len(end)) - 1
    total = np.append(0, np.cumsum(count))
    row = 0
    while row < len(end):
        to = max(row + 1, int(np.searchsorted(total, total[row] + PAIRS_AT_ONCE, side="right")) - 1)
        a = np.repeat(np.arange(row, to), count[row:to])
        yield a, a + 1 + np.arange(len(a)) - np.repeat(total[row:to] - total[row], count[row:to])
        row = to


def coded(classes: DataFrame, least: float) -> DataFrame:
    """no, vec_id, weight, grp (a number per label and length), code, factor, entries, unit, keys."""
    sizes = cut(classes.groupBy("label", F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n")).withColumn("grp", F.monotonically_increasing_id()), "labels")
    largest = sizes.agg(F.max("n")).first()[0] or 1
    bits, n_bands = bands(largest, least)
    schema = "no bigint, vec_id bigint, weight bigint, grp bigint, code binary, factor float, entries binary, unit float, keys array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch["embedding"].value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == d))
                for lo in range(0, part.num_rows, BLOCK):
                    rows = part.slice(lo, BLOCK)
                    x = unit(rows["embedding"].flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, d))
                    bits_, factor, entries, unit_ = code(x)
                    keys = band_keys(x, bits, n_bands).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(rows[c] for c in ("no", "vec_id", "weight", "grp")),
                            pa.array([c.tobytes() for c in bits_], pa.binary()),
                            pa.array(factor.astype(np.float32)),
                            pa.array([e.tobytes() for e in entries], pa.binary()),
                            pa.array(unit_.astype(np.float32)),
                            pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * n_bands, pa.int32()), pa.array(keys.ravel())),
                        ],
                        ["no", "vec_id", "weight", "grp", "code", "factor", "entries", "unit", "keys"],
                    )

    numbered = classes.join(sizes.drop("n"), (classes["label"] == sizes["label"]) & (F.size("embedding") == F.col("d")))
    return cut(numbered.select("no", "vec_id", "weight", "grp", "embedding").mapInArrow(run, schema), "codes")


_BUCKET = ["grp", "band", "key"]


def _dealt(members: DataFrame) -> DataFrame:
    """Members (no, grp, band, key, ..) of keys that others have too, sorted so that a task gets whole pieces of work."""
    sizes = members.groupBy(*_BUCKET).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    work = block_pairs(members.join(sizes, _BUCKET), F.col("size"), F.col("no"), BLOCK).drop("size")
    return work.repartition(*_BUCKET, "i", "j").sortWithinPartitions(*_BUCKET, "i", "j")


def _work(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, Iterator[tuple[np.ndarray, np.ndarray]]]]:
    """Rows of whole pieces of work and the pairs to compare in them."""
    for table, bounds in whole_groups(batches, [*_BUCKET, "i", "j"]):
        blk, mixed = table["blk"].to_numpy(), table["i"].to_numpy() != table["j"].to_numpy()

        def wanted(bounds=bounds, blk=blk, mixed=mixed):
            for a, b in pairs_of(bounds):
                keep = ~mixed[a] | (blk[a] != blk[b])
                yield a[keep], b[keep]

        yield table, wanted()


def likely(codes: DataFrame, least: float) -> DataFrame:
    """(no, grp, band, key) of vectors that a vector with the same key may be linked with, by the codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, pairs in _work(batches):
            size = pc.binary_length(table["entries"]).to_numpy()
            hit = np.zeros(table.num_rows, bool)
            factor, unit_ = table["factor"].to_numpy(), table["unit"].to_numpy()
            raw, bits = table["entries"].to_pylist(), table["code"].to_pylist()
            # Groups hold one length each, batches may hold several.
            width = int(size.max())
            rows = np.zeros((len(raw), width), np.float32)
            signs = np.zeros((len(raw), width), np.float32)
            for d in np.unique(size).tolist():
                at = np.flatnonzero(size == d)
                rows[at, :d] = np.frombuffer(b"".join(raw[k] for k in at), np.int8).reshape(-1, d) * unit_[at, None]
                packed = np.frombuffer(b"".join(bits[k] for k in at), np.uint8).reshape(len(at), -1)
                signs[at, :d] = np.unpackbits(packed, axis=1, count=d).astype(np.float32) * 2 - 1
            for a, b in pairs:
                for d in np.unique(size[a]).tolist() if len(a) else ():
                    own = size[a] == d
                    p, q = a[own], b[own]
                    near = may_link(signs[:, :d], factor, rows[:, :d], p, q, least)
                    hit[p[near]] = hit[q[near]] = True
            yield pa.RecordBatch.from_arrays([table[c].filter(pa.array(hit)).combine_chunks() for c in ("no", *_BUCKET)], ["no", *_BUCKET])

    members = codes.select("no", "grp", "code", "factor", "entries", "unit", F.posexplode("keys").alias("band", "key"))
    found = _dealt(members).mapInArrow(run, "no bigint, grp bigint, band int, key int")
    return cut(found.distinct(), "likely")


def linked(members: DataFrame, least: float) -> DataFrame:
    """(vec_id, links, root): links of each vector in one piece of work, and a vector it is connected with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, pairs in _work(batches):
            ids, weight, band = (table[c].to_numpy() for c in ("vec_id", "weight", "band"))
            lengths = table["embedding"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
            x = np.zeros((len(ids), int(lengths.max())))
            for d in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == d)
                x[at, :d] = unit(table["embedding"].take(pa.array(at)).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(at), d))
            keys = np.array(table["keys"].to_pylist(), np.int32)
            links, one, two = np.zeros(len(ids), np.int64), [], []
            for a, b in pairs:
                first = (keys[a] == keys[b]).argmax(axis=1) == band[a]
                a, b = a[first & (ids[a] != ids[b])], b[first & (ids[a] != ids[b])]
                near = np.einsum("pd,pd->p", x[a], x[b]) >= least
                a, b = a[near], b[near]
                np.add.at(links, a, weight[b])
                np.add.at(links, b, weight[a])
                root = star(len(ids), a, b)
                some = np.unique(np.concatenate([a, b]))
                one.append(some)
                two.append(root[some])
            # Slices of one piece of work are joined by the roots they share.
            one, two = np.concatenate([[], *one]).astype(np.int64), np.concatenate([[], *two]).astype(np.int64)
            root, found = star(len(ids), one, two), np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(ids[found]), pa.array(links[found]), pa.array(ids[root[found]])], ["vec_id", "links", "root"])

    return _dealt(members).mapInArrow(run, "vec_id bigint, links bigint, root bigint")


def near_duplicates(vectors: DataFrame, least: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per input row."""
    rows, classes = copy_classes(usable(vectors))
    codes = coded(classes, least)
    members = (
        likely(codes, least)
        .join(codes.select("no", "vec_id", "weight", "keys"), "no")
        .join(classes.select("no", "embedding"), "no")
    )
    found = cut(linked(members, least), "links")
    counts = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    reach = components(found, "vec_id", "root").withColumnRenamed("id", "vec_id")
    known = (
        classes.join(counts, "vec_id", "left")
        .join(reach, "vec_id", "left")
        .select(
            *(F.col(c).alias(f"_{c}") for c in ("label", "embedding", "own")),
            (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        )
    )
    same = (F.col("label") == F.col("_label")) & (F.col("embedding") == F.col("_embedding")) & F.col("own").eqNullSafe(F.col("_own"))
    members = rows.join(known, same).select("vec_id", "n_links", "component_id").distinct()
    component = F.coalesce("component_id", "vec_id")
    return (
        vectors.select("vec_id")
        .join(members, "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            component.alias("component_id"),
            F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
        )
    )
