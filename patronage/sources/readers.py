"""Readers, stage tables and the stored history."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import fields
from datetime import date
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from patronage.functions import labels
from patronage.functions.scalars import day, first_of
from patronage.sources.schemas import Sources, history_schema

if TYPE_CHECKING:
    from patronage.sources.store import FactTable


def read_dim(spark: SparkSession, path: str) -> DataFrame:
    """A table as it is stored: a dimension, or facts that a run reads whole."""
    return spark.read.parquet(path)


def read_sources(spark: SparkSession, base: str) -> Sources:
    """Every source table as Parquet under `base`, one folder per field of Sources."""
    return Sources(**{f.name: read_dim(spark, f"{base}/{f.name}") for f in fields(Sources)})


def order_window(events: DataFrame, start: date | str, as_of: date | str) -> DataFrame:
    """Affiliate order events of a date window, without payment, shopping and internal rows.

    `^PAY` holds no wildcard, so only that exact action is dropped; a null action,
    label or user is dropped too.
    """
    return events.where(
        F.col("event_dt").between(day(start), day(as_of))
        & ~F.col("event_action").like(labels.PAY_ACTION)
        & (F.col("event_label") != labels.SHOPPING_LABEL)
        & ~F.col("user_id").like(labels.INTERNAL_USER_PATTERN)
        & F.col("user_id").isNotNull()
    )


def read_orders(events: FactTable, start: date | str, as_of: date | str) -> DataFrame:
    """Scan of affiliate order events stored by period: only the folders of the window are read."""
    return order_window(events.read(start, as_of).drop("period"), start, as_of)


def order_status() -> Column:
    return first_of(F.col("product_option"), "order_status_type")


def mall_orders_in(
    orders: DataFrame, statuses, start: date | str | None = None, as_of: date | str | None = None
) -> DataFrame:
    """Mall orders whose first line has one of `statuses`, in the date window if given."""
    out = orders.where(order_status().isin(*statuses))
    if start is not None:
        out = out.where(F.col("order_dt").between(day(start), day(as_of)))
    return out


def write_stage(df: DataFrame, store: str, name: str) -> DataFrame:
    """Replace the stage table `name` under `store` and continue from the stored rows.

    The rows are written beside the table, which stays until they are complete.
    """
    spark, path = df.sparkSession, f"{store}/{name}"
    beside = f"{store}/_{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(f"{beside}/new")
    fs, place = _fs(spark, path)
    new, old = (spark._jvm.org.apache.hadoop.fs.Path(f"{beside}/{part}") for part in ("new", "old"))
    if fs.exists(place):
        _move(fs, place, old)
    else:
        fs.mkdirs(place.getParent())
    _move(fs, new, place)
    remove(spark, beside)
    return spark.read.parquet(path)


def _move(fs, place, to) -> None:
    if not fs.rename(place, to):
        raise OSError(f"{place} could not be moved to {to}")


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def remove(spark: SparkSession, path: str) -> None:
    """Delete a stored folder."""
    fs, place = _fs(spark, path)
    fs.delete(place, True)


def folders(spark: SparkSession, path: str, key: str, complete: bool = False) -> list[str]:
    """The values of the `key=value` folders under a path, or of those a write has completed."""
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return []
    found = []
    for entry in fs.listStatus(root):
        name = entry.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS")
        if name.startswith(f"{key}=") and (not complete or fs.exists(done)):
            found.append(name.split("=", 1)[1])
    return sorted(found)


def history_versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of a stored table, oldest first."""
    return sorted(map(int, folders(spark, path, "version", complete=True)))


def write_version(df: DataFrame, path: str, keep: int | None = None) -> str:
    """Add a version of a table and return its path; with `keep`, only so many stay.

    Readers and failed runs never see a table half written or gone: the versions before
    stay until the new one is complete.
    """
    spark = df.sparkSession
    before = history_versions(spark, path)
    new = f"{path}/version={(before[-1] if before else -1) + 1}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(new)
    for old in before[: max(0, len(before) + 1 - keep)] if keep else []:
        remove(spark, f"{path}/version={old}")
    return new


def kept_stage(spark: SparkSession, store: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The stage table `name` under `store` as it was stored last; built and stored where there is none."""
    path = f"{store}/{name}"
    done = history_versions(spark, path)
    return spark.read.parquet(f"{path}/version={done[-1]}" if done else write_version(build(), path))


def ensure_history(spark: SparkSession, path: str, track: str) -> None:
    """Create an empty history (version 0) unless one is there."""
    if not history_versions(spark, path):
        spark.createDataFrame([], history_schema(track)).write.mode("overwrite").parquet(f"{path}/version=0")


def read_history(spark: SparkSession, path: str, track: str) -> DataFrame:
    latest = history_versions(spark, path)[-1]
    return spark.read.schema(history_schema(track)).parquet(f"{path}/version={latest}")


def write_history(history: DataFrame, path: str) -> None:
    """Add a version.  Readers keep the old one until the new one is complete."""
    write_version(history, path)
