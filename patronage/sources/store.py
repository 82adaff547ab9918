"""Stored tables of which a write touches a part: keyed tables in buckets, facts by period.

Both write new folders beside the old ones and name the valid ones in a small manifest,
which is written last.  A reader sees the state of one manifest, and a write that fails
leaves the one before in force.  One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from patronage.functions.scalars import day
from patronage.sources.readers import folders, history_versions, remove, write_version


class BucketedTable:
    """A table with one row per key, in buckets by a hash of the key; an upsert rewrites the buckets it touches.

    Take more buckets than an upsert has keys if it should leave most of the table alone.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = 64):
        self.spark, self.path, self.schema, self.key, self.buckets = spark, path, schema, key, buckets

    def create(self) -> None:
        """An empty table unless one is there."""
        if not history_versions(self.spark, f"{self.path}/manifest"):
            self._publish({})

    def places(self) -> dict[int, str]:
        """Folder of each bucket that has rows, as of the last manifest: at most `buckets` entries."""
        versions = history_versions(self.spark, f"{self.path}/manifest")
        if not versions:
            return {}
        rows = self.spark.read.parquet(f"{self.path}/manifest/version={versions[-1]}").collect()
        if {r["buckets"] for r in rows} != {self.buckets}:
            raise ValueError(f"the table has another number of buckets than {self.buckets}")
        return {r["bucket"]: r["place"] for r in rows if r["place"] is not None}

    def _publish(self, places: dict[int, str], keep: int | None = None) -> None:
        rows = [(None, None, self.buckets), *[(b, place, self.buckets) for b, place in sorted(places.items())]]
        manifest = self.spark.createDataFrame(rows, "bucket int, place string, buckets int").coalesce(1)
        write_version(manifest, f"{self.path}/manifest", keep)

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def read(self, only: list[int] | None = None) -> DataFrame:
        """The rows, or those of some buckets."""
        found = [place for b, place in sorted(self.places().items()) if only is None or b in only]
        if not found:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{place}" for place in found])

    def upsert(self, changes: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], keep: int | None = None) -> list[int]:
        """Replace the buckets of the changes' keys by merge(their rows, changes); gives these buckets.

        `merge` returns rows of the table for keys of both arguments alone.  `changes` is read
        twice: pass a stored table.  With `keep`, folders that the last so many manifests don't name go.
        """
        before = self.places()
        touched = sorted(r[0] for r in changes.select(self._bucket(F.col(self.key))).distinct().collect())
        if not touched:
            return []
        commit = f"data/commit={1 + max([-1, *map(int, folders(self.spark, f'{self.path}/data', 'commit'))])}"
        merged = merge(self.read(touched), changes).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        (
            merged.withColumn("_bucket", self._bucket(F.col(self.key)))
            .repartition(len(touched), "_bucket")
            .write.partitionBy("_bucket")
            .parquet(f"{self.path}/{commit}")
        )
        written = set(map(int, folders(self.spark, f"{self.path}/{commit}", "_bucket")))
        if not written <= set(touched):
            raise ValueError("the merge returned keys of other buckets")
        after = {b: place for b, place in before.items() if b not in touched}
        self._publish(after | {b: f"{commit}/_bucket={b}" for b in written}, keep)
        if keep:
            self._clean()
        return touched

    def _clean(self) -> None:
        """Drop the folders that no manifest names."""
        named = set()
        for version in history_versions(self.spark, f"{self.path}/manifest"):
            rows = self.spark.read.parquet(f"{self.path}/manifest/version={version}").where("place IS NOT NULL").collect()
            named |= {r["place"] for r in rows}
        for commit in folders(self.spark, f"{self.path}/data", "commit"):
            own = {f"data/commit={commit}/_bucket={b}" for b in folders(self.spark, f"{self.path}/data/commit={commit}", "_bucket")}
            if not own & named:
                remove(self.spark, f"{self.path}/data/commit={commit}")
                continue
            for place in own - named:
                remove(self.spark, f"{self.path}/{place}")


PERIODS = {"day": "yyyy-MM-dd", "month": "yyyy-MM"}


class FactTable:
    """Facts by the period (day or month) of their date; a write replaces whole periods.

    The period is a partition column, so a window of dates prunes folders before a scan, also
    where it comes from a join.  Rows without a date have a period of their own, which no window reads.
    """

    def __init__(self, spark: SparkSession, path: str, on: str, period: str = "day"):
        self.spark, self.path, self.on, self.format = spark, path, on, PERIODS[period]

    def _commits(self) -> set[str]:
        return set(folders(self.spark, f"{self.path}/manifest", "commit", complete=True))

    def write(self, facts: DataFrame) -> None:
        """Replace the periods that the facts are of; the others stay as they are."""
        commit = 1 + max([-1, *map(int, folders(self.spark, f"{self.path}/manifest", "commit"))])
        period = F.coalesce(F.date_format(self.on, self.format), F.lit("none"))
        dated = facts.withColumns({"period": period, "commit": F.lit(commit)})
        # The manifest's folder comes first, unfinished, so that no other write takes its number.
        place = f"{self.path}/manifest/commit={commit}"
        dated.limit(0).write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(place)
        dated.repartition("period").write.mode("append").partitionBy("period", "commit").parquet(f"{self.path}/facts")
        self.spark.range(1).write.mode("overwrite").parquet(place)

    def read(self, first: date | str | None = None, last: date | str | None = None) -> DataFrame:
        """The facts of a window of dates, each period's as they were written last."""
        done, base = self._commits(), f"{self.path}/facts"
        texts = [None if d is None else str(d)[: len(self.format)] for d in (first, last)]
        found = []
        for period in folders(self.spark, base, "period"):
            if (period == "none" and (first or last)) or (texts[0] and period < texts[0]) or (texts[1] and period > texts[1]):
                continue
            commits = [c for c in folders(self.spark, f"{base}/period={period}", "commit") if c in done]
            if commits:
                found.append(f"{base}/period={period}/commit={max(commits, key=int)}")
        if not found:
            raise FileNotFoundError(f"no facts between {first} and {last} under {self.path}")
        rows = self.spark.read.option("basePath", base).parquet(*found).drop("commit")
        rows = rows.withColumn("period", F.col("period").cast("string"))
        if first is not None:
            rows = rows.where((F.col("period") >= texts[0]) & (F.col(self.on) >= day(first)))
        if last is not None:
            rows = rows.where((F.col("period") <= texts[1]) & (F.col(self.on) <= day(last)))
        return rows
