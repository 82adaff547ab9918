"""Sharding by a minimax contiguous partition of groups of equal texts.

Groups too large for an even share of what is left come first and get a shard each,
largest first; the others follow by the digest of their text and share the shards that
remain.  For these, the smallest capacity with which a greedy walk needs at most that many
shards is found by binary search, and of the cuts that keep within it each shard takes the
one nearest to an even share of the rest.  The walk sees sums over digest prefixes (at most
16**PREFIX rows on the driver).  A walk that may cut anywhere in a prefix of several
groups gives a lower bound of the capacity; the prefixes that it cuts, at most one per
shard, are split further (at most 16**PREFIX more rows, or 16 per shard) until it cuts
between groups only, so the bound is reached and the result is exact however many groups
there are and however large one of them is.  Only DataFrame functions.

Defined cases: a null text counts as the empty text; groups are never split, so a
group larger than an even share is a shard of its own; texts of any length count by their
bytes; repeated rows and rows without an id keep a slot each; with fewer groups than
shards, the last shards are empty; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import Window as W

from patronage.functions.stages import cut

PREFIX = 4  # hex digits of the first sums; no further split of a round gives more rows, but for 16 per split prefix
SLOT_BUCKETS = 256  # per shard; rows are numbered within a bucket, so this many times n_shards windows share the work


@dataclass
class Piece:
    """Consecutive groups with one digest prefix."""

    prefix: str
    size: int
    groups: int


def walk(ends: np.ndarray, capacity: int, n_shards: int) -> list[int]:
    """Indices of the pieces after each shard's last, as far as the greedy walk comes."""
    cuts, at = [], 0
    for _ in range(n_shards):
        before = int(ends[at - 1]) if at else 0
        at = max(at, int(np.searchsorted(ends, before + capacity, side="right")))
        cuts.append(at)
        if at == len(ends):
            break
    return cuts


def least_capacity(sizes: np.ndarray, n_shards: int) -> int:
    """The smallest capacity with which whole pieces fit into n_shards shards."""
    ends = np.cumsum(sizes)
    low, high = max(int(sizes.max()), -(-int(ends[-1]) // n_shards)), int(ends[-1])
    while low < high:
        mid = (low + high) // 2
        if walk(ends, mid, n_shards)[-1] == len(sizes):
            high = mid
        else:
            low = mid + 1
    return low


def loose_walk(ends: np.ndarray, single: np.ndarray, capacity: int, n_shards: int) -> list[int]:
    """Sizes up to each shard's end, where pieces of several groups may be cut anywhere; no walk over the groups comes farther."""
    found, at = [], 0
    for _ in range(n_shards):
        at = min(at + capacity, int(ends[-1]))
        k = int(np.searchsorted(ends, at, side="right"))
        if k < len(ends) and single[k]:
            at = int(ends[k - 1]) if k else 0
        found.append(at)
    return found


def undecided(pieces: list[Piece], n_shards: int, largest: int) -> list[int]:
    """Pieces of several groups that the loose walk of the least capacity cuts, at most n_shards; without any, that walk is the best one."""
    ends = np.cumsum([p.size for p in pieces])
    single = np.array([p.groups == 1 for p in pieces])
    low, high = max(largest, -(-int(ends[-1]) // n_shards)), int(ends[-1])
    while low < high:
        mid = (low + high) // 2
        if loose_walk(ends, single, mid, n_shards)[-1] == ends[-1]:
            high = mid
        else:
            low = mid + 1
    cut_at = np.array(loose_walk(ends, single, low, n_shards))
    inside = np.searchsorted(ends, cut_at, side="left")
    return sorted({int(k) for k, at in zip(inside, cut_at, strict=True) if at < ends[k]})


def split_digits(n_open: int) -> int:
    """Hex digits by which so many prefixes are split in one round."""
    digits = PREFIX
    while digits > 1 and n_open * 16**digits > 16**PREFIX:
        digits -= 1
    return digits


def even_cuts(sizes: np.ndarray, capacity: int, n_shards: int) -> list[int]:
    """Index of each shard's end, within the capacity and as near to even shares of the rest as it allows."""
    ends = np.cumsum(sizes)
    total, n = int(ends[-1]), len(sizes)
    # The least end of each shard after which the rest fits into the shards that follow.
    least = [n]
    for _ in range(n_shards - 1):
        left = total - (int(ends[least[-1] - 1]) if least[-1] else 0)
        least.append(int(np.searchsorted(ends, total - left - capacity, side="left")) + 1 if total - left > capacity else 0)
    least.reverse()
    cuts, at = [], 0
    for shard in range(n_shards):
        before = int(ends[at - 1]) if at else 0
        most = int(np.searchsorted(ends, before + capacity, side="right"))
        share = before + (total - before) / (n_shards - shard)
        near = int(np.searchsorted(ends, share, side="left")) + 1
        if near > at + 1 and near <= n and share - ends[near - 2] <= ends[near - 1] - share:
            near -= 1
        # A shard takes a piece at least while there are any, and leaves one for each that follows.
        near = min(max(near, at + 1), max(at + 1, n - (n_shards - shard - 1)))
        at = min(max(near, least[shard]), most)
        cuts.append(at)
    return cuts


def alone(largest: list[int], total: int, n_shards: int) -> int:
    """How many of the largest groups (falling sizes) get shards of their own: those of at least an even share of what is left."""
    count = 0
    while count < min(len(largest), n_shards - 1) and largest[count] * (n_shards - count) >= total:
        total -= largest[count]
        count += 1
    return count


def shard_cuts(groups: DataFrame, n_shards: int) -> tuple[list[str], list[str], int]:
    """Digests of the groups with shards of their own, the digest prefix at which each shard after the first of the others begins, and the capacity of these; groups: (digest, size)."""
    # As many rows as there are shards.
    top = groups.orderBy(F.desc("size"), "digest").limit(n_shards).collect()
    if not top:
        return [], [], 0
    own = alone([r["size"] for r in top], groups.agg(F.sum("size")).first()[0], n_shards)
    hot = [r["digest"] for r in top[:own]]
    if own == len(top):
        return hot, [], 0
    others, left, largest = (groups.where(~F.col("digest").isin(*hot)) if hot else groups), n_shards - own, top[own]["size"]

    def sums(digits: int, within: list[str] | None = None) -> list[Piece]:
        rows = others if within is None else others.where(F.substring("digest", 1, len(within[0])).isin(*within))
        summed = rows.groupBy(F.substring("digest", 1, digits).alias("p")).agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n"))
        return [Piece(r["p"], r["s"], r["n"]) for r in summed.collect()]

    pieces = sorted(sums(PREFIX), key=lambda p: p.prefix)
    while open_ := undecided(pieces, left, largest):
        by_length: dict[int, list[str]] = {}
        for k in open_:
            by_length.setdefault(len(pieces[k].prefix), []).append(pieces[k].prefix)
        split = {p for names in by_length.values() for p in names}
        step = split_digits(len(open_))
        pieces = [p for p in pieces if p.prefix not in split]
        for length, names in by_length.items():
            pieces += sums(length + step, names)
        pieces.sort(key=lambda p: p.prefix)
    sizes = np.array([p.size for p in pieces])
    capacity = least_capacity(sizes, left)
    cuts = even_cuts(sizes, capacity, left)
    return hot, [pieces[k].prefix for k in sorted(set(cuts[:-1])) if k < len(pieces)], capacity


def shard(docs: DataFrame, n_shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, digest, shard, slot: every document with its shard and a gapless place in it."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = cut(
        docs.select(
            "doc_id",
            (F.octet_length(text) + F.lit(1)).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.md5(text.cast("binary")).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    groups = cut(rows.groupBy("digest").agg(F.sum("size").alias("size")), "groups")
    hot, begins, _ = shard_cuts(groups, n_shards)
    number = F.lit(len(hot))
    for begin in begins:
        number = number + (F.col("digest") >= begin).cast("int")
    for k, digest in enumerate(hot):
        number = F.when(F.col("digest") == digest, k).otherwise(number)
    # By the stored row, so that neither equal texts nor equal ids share a bucket.
    placed = rows.withColumn("shard", number).withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(SLOT_BUCKETS)))
    counts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    # n_shards * SLOT_BUCKETS rows at most, whatever the input.
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(W.partitionBy("shard", "bucket").orderBy("row"))
    return (
        placed.withColumn("inside", inside)
        .join(F.broadcast(offsets), ["shard", "bucket"])
        .select("doc_id", "size", "text_crc32", "digest", "shard", (F.col("offset") + F.col("inside") - 1).alias("slot"))
    )
