"""Mixing sources to target shares by Poisson replication.

A source with share w of the target has the mean repetition rate w * total / count.
Each document's repetition is the Poisson quantile of a uniform number seeded by a
hash of its id, so it does not depend on partitions or reruns; where the id is null or
repeated, the seed is the id, a digest of the row and its number among equal rows, so
that every row has a draw of its own.  Documents are exploded
by it and the copies dealt out and sorted by a hash, a uniform global order.
A document with more than CHUNK copies is dealt out in chunks of them first, so its copies
are not one task's work.  Only DataFrame functions; nothing but one count per named source
reaches the driver, and the distribution functions, one row per named source, are broadcast.

Defined cases: sources without a share of their own, the null source among them, form
one pool that gets what the named shares leave; a named source without documents gets
nothing; rows without an id or with one that others have too are drawn each on their own,
fully equal ones included; null and empty texts are kept as they are; an empty table
gives no rows; other columns are carried along, except that copy, n_copies and order_key
are overwritten.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import Window as W

from patronage.functions.stages import cut

# Target shares of the production mix; every other source shares the rest.
SHARES: Mapping[str, float] = {"src0": 0.20, "src1": 0.10, "src2": 0.05}
SEED = 20240607
CHUNK = 1024  # copies of a document that one task makes
_HEX = 13  # hex digits of a hash that make a uniform number: 52 bits, exact in a double


def uniform(*parts: Column | str) -> Column:
    """A uniform number in [0, 1) from a hash of the parts."""
    digest = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(digest, 1, _HEX), 16, 10).cast("bigint") / F.lit(float(16**_HEX))


def poisson_steps(rate: float) -> tuple[int, list[float]]:
    """First count with weight and the distribution function from there until it is 1 in double precision."""
    first = max(0, math.floor(rate - 9 * math.sqrt(rate) - 9))
    total, steps, k = 0.0, [], first
    while True:
        p = math.exp(-rate + (k * math.log(rate) if k else 0.0) - math.lgamma(k + 1))
        total += p
        if k > rate and p < 2.0**-56:
            return first, steps
        steps.append(total)
        k += 1


def repetition_rates(docs: DataFrame, shares: Mapping[str, float]) -> dict[str | None, float]:
    """Mean repetitions by source; None stands for the pool of the other sources."""
    rest = 1.0 - sum(shares.values())
    if rest < 0 or any(w < 0 for w in shares.values()):
        raise ValueError("shares must be at least 0 and sum to at most 1")
    named = F.when(F.col("source").isin(*shares), F.col("source"))
    counts = {r["s"]: r["n"] for r in docs.groupBy(named.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    return {s: (rest if s is None else shares[s]) * total / n for s, n in counts.items()}


def with_repetitions(docs: DataFrame, u: Column, rates: Mapping[str | None, float]) -> DataFrame:
    """The documents with n_copies, the Poisson quantile of u at the rate of the row's source."""
    named = [name for name in rates if name is not None]
    rows = []
    for name, rate in rates.items():
        if rate > 0:
            first, steps = poisson_steps(rate)
            rows.append(F.struct(F.lit(name).cast("string").alias("_name"), F.lit(first).alias("_first"), F.lit(",".join(map(repr, steps))).alias("_steps")))
    if not rows:
        return docs.withColumn("n_copies", F.lit(0))
    # One row per named source and one for the others, each with some 20 times the root of its rate numbers; stored, not part of later plans.
    table = docs.sparkSession.range(1).select(F.inline(F.array(*rows)))
    steps = cut(table.withColumn("_steps", F.split("_steps", ",").cast("array<double>")), "steps")
    own = F.when(F.col("source").isin(*named), F.col("source")) if named else F.lit(None).cast("string")
    met = docs.join(F.broadcast(steps), own.eqNullSafe(F.col("_name")), "left")
    count = F.col("_first") + F.size(F.filter("_steps", lambda c: c <= u))
    return met.withColumn("n_copies", F.coalesce(count, F.lit(0))).drop("_name", "_first", "_steps")


def seeded(docs: DataFrame) -> DataFrame:
    """The documents with the text that seeds their draw as order_key: the id, and where it is null or repeated more of the row."""
    id_text = F.col("doc_id").cast("string")
    unclear = cut(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL").select("doc_id"), "unclear-ids")
    if unclear.isEmpty():
        return docs.withColumn("order_key", id_text)
    repeated = unclear.where("doc_id IS NOT NULL")
    plain = docs.where("doc_id IS NOT NULL").join(repeated, "doc_id", "left_anti").select(docs.columns)
    odd = docs.where("doc_id IS NULL").unionByName(docs.join(repeated, "doc_id", "left_semi").select(docs.columns))
    # Equal rows are numbered within the partition they were stored by, so a large group of them is not one task's work.
    rows = cut(odd.select(F.struct("*").alias("row"), F.md5(F.to_json(F.struct("*"))).alias("same"), F.spark_partition_id().alias("part")), "unclear-rows")
    counts = rows.groupBy("same", "part").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("same").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("same", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(W.partitionBy("same", "part").orderBy("same"))
    numbered = rows.withColumn("inside", inside).join(offsets, ["same", "part"])
    own = F.concat_ws(":", F.coalesce(F.col("row.doc_id").cast("string"), F.lit("null")), "same", (F.col("offset") + F.col("inside")).cast("string"))
    drawn = numbered.select("row", own.alias("order_key")).select("row.*", "order_key")
    return plain.withColumn("order_key", id_text).unionByName(drawn)


def mix(docs: DataFrame, shares: Mapping[str, float] = SHARES, seed: int = SEED) -> DataFrame:
    """The documents with their copies, globally shuffled; adds copy (from 1), n_copies and order_key."""
    rates = repetition_rates(docs, shares)
    docs = docs.drop("copy", "n_copies", "order_key")
    counted = with_repetitions(seeded(docs), uniform("order_key", F.lit(str(seed))), rates)
    few = counted.where(F.col("n_copies").between(1, CHUNK)).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    chunks = counted.where(F.col("n_copies") > CHUNK).withColumn("_from", F.explode(F.sequence(F.lit(1), F.greatest(F.col("n_copies"), F.lit(1)), F.lit(CHUNK))))
    last = F.least(F.col("_from") + F.lit(CHUNK - 1), F.col("n_copies"))
    # A given number, since rows that are few before they are copied would be merged into one task.
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = chunks.repartition(spread, "order_key", "_from").withColumn("copy", F.explode(F.sequence(F.col("_from"), last))).drop("_from")
    copies = few.unionByName(many)
    keyed = copies.withColumn("order_key", F.md5(F.concat_ws(":", "order_key", F.col("copy").cast("string"), F.lit(f"order{seed}"))))
    return keyed.select(*docs.columns, "n_copies", "copy", "order_key").repartition("order_key").sortWithinPartitions("order_key", "doc_id")
