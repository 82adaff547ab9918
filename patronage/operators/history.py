"""Per-user history: arrays of dated score and category records.

Two forms with the same content: one row per user with arrays (`upsert_history`),
and one row per user and date in date partitions (`append_snapshot`), where a day is
written without touching the others and the arrays are assembled when asked for.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from patronage.functions.scalars import day
from patronage.sources.readers import folders, history_versions, write_version
from patronage.sources.schemas import CATEGORY_SNAPSHOT, score_snapshot, slow_columns
from patronage.sources.store import BucketedTable

_SUFFIX = {"affiliate": "byshop", "mall": "shop"}


def _source_name(field: str, track: str) -> str:
    """Column of the scored snapshot behind a history field."""
    sfx = _SUFFIX[track]
    special = {
        "r_data": f"r_{sfx}",
        "f_data": f"f_{sfx}",
        "m_data": f"m_{sfx}",
        "ar_data": f"ar_{sfx}",
        "survival_prob": f"suvival_prob_{sfx}",
    }
    if field in special:
        return special[field]
    per_channel = {
        "risk_level", "cycle_length", "current_trailing_term", "prev_trailing_term",
        "term_diff", "cycle_stddev", "predicted_survival_time",
    }
    return f"{field}_{sfx}" if field in per_channel else field


def _record(schema: T.StructType, name_of) -> Column:
    fields = [f"'{f.name}', cast({name_of(f.name)} as {f.dataType.simpleString()})" for f in schema.fields]
    return F.expr(f"named_struct({', '.join(fields)})")


def pack_snapshot(scored: DataFrame, track: str) -> DataFrame:
    """One row per user: slow attributes and the two dated records."""
    return scored.where(F.col("user_id").isNotNull()).select(
        "user_id",
        *[F.col(n).cast(t).alias(n) for n, t in slow_columns(track)],
        _record(score_snapshot(track), lambda f: _source_name(f, track)).alias("score"),
        _record(CATEGORY_SNAPSHOT, lambda f: f).alias("category"),
    )


def upsert_history(history: DataFrame, scored: DataFrame, track: str) -> DataFrame:
    """History with the snapshot added.

    Known users get a record put in date order into both arrays, and their slow
    attributes overwritten unless a later date is there already; new users are
    inserted, others stay.  A record of the same date is replaced, so running a day
    again changes nothing.
    """
    slow = [n for n, _ in slow_columns(track)]
    snap = pack_snapshot(scored, track).select(
        "user_id", *[F.col(c).alias(f"new_{c}") for c in slow], "score", "category"
    )
    seen = F.col("score").isNotNull()

    def extended(array: str, record: str, schema: T.StructType) -> Column:
        empty = F.array().cast(T.ArrayType(schema))
        kept = F.filter(
            F.coalesce(F.col(array), empty), lambda r: ~r["snapshot_dt"].eqNullSafe(F.col(record)["snapshot_dt"])
        )
        dated = F.array_sort(F.concat(kept, F.array(record)), lambda a, b: F.coalesce(F.datediff(a["snapshot_dt"], b["snapshot_dt"]), F.lit(0)))
        return F.when(seen, dated).otherwise(F.col(array)).alias(array)

    last = F.array_max(F.transform("score_history", lambda r: r["snapshot_dt"]))
    newest = seen & (last.isNull() | (F.col("score")["snapshot_dt"] >= last))

    return history.join(snap, "user_id", "full").select(
        "user_id",
        *[F.when(newest, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) for c in slow],
        extended("score_history", "score", score_snapshot(track)),
        extended("category_history", "category", CATEGORY_SNAPSHOT),
    )


def upsert_bucketed(history: BucketedTable, scored: DataFrame, track: str, keep: int | None = None) -> list[int]:
    """`upsert_history` on a bucketed history: only the buckets of the snapshot's users are read and written; gives these."""
    known = scored.where(F.col("user_id").isNotNull())
    return history.upsert(known, lambda rows, snap: upsert_history(rows, snap, track), keep)


def history_at(history: DataFrame, on: date | str, array: str = "score_history") -> DataFrame:
    """The records of one date, beside the slow attributes."""
    keep = [c for c in history.columns if not c.endswith("_history")]
    return history.select(*keep, F.inline(array)).where(F.col("snapshot_dt") == day(on))


# --- dated form ------------------------------------------------------------------


def append_snapshot(scored: DataFrame, path: str, track: str, snapshot_dt: date | str) -> None:
    """Write the records of one date; that date's partition is replaced, no other is read.

    The partition gets a new version, and the one before stays for those who read it.
    """
    packed = pack_snapshot(scored, track).where(F.col("score.snapshot_dt") == day(snapshot_dt))
    write_version(packed, f"{path}/snapshot_dt={snapshot_dt}", keep=2)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """All dated records, each date's last complete version; a filter on snapshot_dt prunes to its partition."""
    latest = []
    for on in folders(spark, path, "snapshot_dt"):
        latest += [f"{path}/snapshot_dt={on}/version={v}" for v in history_versions(spark, f"{path}/snapshot_dt={on}")[-1:]]
    return spark.read.option("basePath", path).parquet(*latest).drop("version")


def assemble_history(snapshots: DataFrame, track: str) -> DataFrame:
    """The array form: records in date order, slow attributes of the latest date.

    A group holds one record per run date, so it is bounded by the calendar.
    """
    slow = [n for n, _ in slow_columns(track)]
    rows = snapshots.groupBy("user_id").agg(
        F.max(F.struct("snapshot_dt", *slow)).alias("latest"),
        F.array_sort(F.collect_list("score")).alias("score_history"),
        F.array_sort(F.collect_list("category")).alias("category_history"),
    )
    return rows.select("user_id", *[F.col(f"latest.{c}").alias(c) for c in slow], "score_history", "category_history")
