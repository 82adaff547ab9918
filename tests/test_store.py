"""Tables of which a write touches a part: buckets of a history, periods of facts, replaced stages."""

import pytest
from pyspark.sql import functions as F

from patronage.operators import history
from patronage.sources import readers
from patronage.sources.schemas import history_schema
from patronage.sources.store import BucketedTable, FactTable
from tests.test_history_segments_study import scored


def content(rows):
    return sorted(map(repr, rows.collect()))


@pytest.fixture
def snapshots(spark):
    users = [(f"u{k}", float(k), "IRON", "p1") for k in range(400)]
    return [scored(spark, users + [(None, 1.0, "VIP", "p")], "2025-01-01"), scored(spark, users[100:104] + [("new", 9.0, "VIP", "p2")], "2025-01-02")]


def test_upsert_of_few_users_rewrites_their_buckets_alone(spark, snapshots, tmp_path):
    path, expected = str(tmp_path / "h"), spark.createDataFrame([], history_schema("affiliate"))
    table = BucketedTable(spark, path, history_schema("affiliate"), "user_id", 64)
    table.create()
    table.create()
    assert table.read().count() == 0
    for snap in snapshots:
        before, old = table.places(), {str(f): f.stat().st_mtime_ns for f in tmp_path.rglob("*.parquet")}
        touched = history.upsert_bucketed(table, snap, "affiliate")
        expected = history.upsert_history(expected, snap, "affiliate")
        assert content(table.read().select(*expected.columns)) == content(expected)
        after = table.places()
        assert {b for b in after if after[b] != before.get(b)} == set(touched)
        assert {f: t for f, t in old.items() if (tmp_path / f).stat().st_mtime_ns == t} == old
    assert len(touched) <= 5 and len(list(tmp_path.glob("h/data/commit=1/*/*.parquet"))) == len(touched)
    # Read alone, a bucket holds its own keys.
    assert table.read(touched).count() < 60
    with pytest.raises(ValueError):
        BucketedTable(spark, path, history_schema("affiliate"), "user_id", 32).read()


def test_a_failed_upsert_leaves_the_version_before(spark, snapshots, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "h"), history_schema("affiliate"), "user_id", 16)
    history.upsert_bucketed(table, snapshots[0], "affiliate")
    before = content(table.read())
    late = F.when(F.col("user_id") == "u102", F.raise_error(F.lit("lost"))).otherwise(F.col("platform"))

    def merge(rows, snap):
        return history.upsert_history(rows, snap, "affiliate").withColumn("platform", late.cast("string"))

    with pytest.raises(Exception, match="lost"):
        table.upsert(snapshots[1].where("user_id IS NOT NULL"), merge)
    assert content(table.read()) == before
    for k in range(3):
        history.upsert_bucketed(table, snapshots[1], "affiliate", keep=1)
    assert table.read().count() == 401
    # What no manifest names is gone: one folder per bucket is left.
    assert len(list((tmp_path / "h" / "data").glob("commit=*/_bucket=*"))) == len(table.places())


def test_facts_by_period_are_pruned_and_replaced(spark, tmp_path):
    rows = [(f"2025-{m:02d}-{d:02d}", m * 100 + d) for m in range(1, 7) for d in (1, 15, 28)] + [(None, 7)]
    facts = spark.createDataFrame(rows, "on_dt string, v int").withColumn("on_dt", F.col("on_dt").cast("date"))
    for period, folders in (("month", 7), ("day", 19)):
        table = FactTable(spark, str(tmp_path / period), "on_dt", period)
        with pytest.raises(FileNotFoundError):
            table.read()
        table.write(facts)
        assert len(readers.folders(spark, str(tmp_path / period / "facts"), "period")) == folders
        assert sorted(r.v for r in table.read().collect()) == sorted(v for _, v in rows)
        window = table.read("2025-02-15", "2025-03-01")
        assert sorted(r.v for r in window.collect()) == [215, 228, 301]
        plan = window._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "period" in plan.split("PartitionFilters: [")[1].split("]")[0]
        assert all("period=2025-02" in f or "period=2025-03-01" in f or "period=2025-03/" in f for f in window.inputFiles())
        table.write(facts.where("on_dt = '2025-02-28'").withColumn("v", F.lit(-1)))
        kept = {"month": [-1, 301], "day": [-1, 215, 301]}[period]
        assert sorted(r.v for r in table.read("2025-02-15", "2025-03-01").collect()) == kept
        broken = facts.where("on_dt >= '2025-02-01'").withColumn("v", F.when(F.col("v") == 628, F.raise_error(F.lit("lost")).cast("int")).otherwise(0))
        with pytest.raises(Exception, match="lost"):
            table.write(broken)
        assert sorted(r.v for r in table.read("2025-02-15", "2025-03-01").collect()) == kept


def test_a_window_of_a_join_prunes_periods(spark, tmp_path):
    table = FactTable(spark, str(tmp_path / "f"), "on_dt")
    days = spark.sql("SELECT explode(sequence(DATE'2025-01-01', DATE'2025-02-28')) AS on_dt").withColumn("v", F.rand(1))
    table.write(days)
    wanted = spark.createDataFrame([("2025-02-03", "x"), ("2025-02-04", "y")], "period string, kind string").where("kind = 'x'")
    joined = table.read().join(F.broadcast(wanted), "period")
    assert joined.count() == 1
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString()


def test_a_failed_stage_keeps_the_one_before(spark, tmp_path):
    store = str(tmp_path / "stages")
    assert readers.write_stage(spark.range(5), store, "s").count() == 5
    with pytest.raises(Exception, match="lost"):
        readers.write_stage(spark.range(9).withColumn("id", F.when(F.col("id") == 8, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("id"))), store, "s")
    assert spark.read.parquet(f"{store}/s").count() == 5
    assert readers.write_stage(spark.range(7), store, "s").count() == 7
    # A stage may be made of the one it replaces.
    assert readers.write_stage(spark.read.parquet(f"{store}/s").where("id > 2"), store, "s").count() == 4
