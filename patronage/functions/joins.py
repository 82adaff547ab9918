"""Joins whose left key is often null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_SPREAD = 4096


def deal(rows: DataFrame, *keys: str | Column) -> DataFrame:
    """The rows dealt by the keys into as many parts as spark.sql.shuffle.partitions says.

    For wide rows that are sorted next: adaptive execution merges parts by their compressed
    size, which for repetitive rows is a small share of what the sort takes in memory.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def left_join_nullable(left: DataFrame, right: DataFrame, key: str, spread_by: list[str] | None = None, also: tuple[str, ...] = ()) -> DataFrame:
    """Left join on `key` (and the columns of `also`) that keeps rows with a null key out of one another's way.

    Null keys match nothing, yet a shuffled join sends all of them to one task.  A
    second key, 0 wherever the key is known and a hash of the row where it is not,
    spreads them.  On the right it is computed from the key, since a literal would be
    folded away.
    """
    other = spread_by or [c for c in left.columns if c != key]
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*other), F.lit(_SPREAD))).otherwise(F.lit(0))
    return (
        left.withColumn("_spread", spread.cast("bigint"))
        .join(right.withColumn("_spread", F.pmod(F.xxhash64(key), F.lit(1)).cast("bigint")), [key, *also, "_spread"], "left")
        .drop("_spread")
    )
