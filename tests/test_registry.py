"""A quick part of the oracle comparison; `python -m tests.compare <sf_dir>` runs all of it."""

import pytest

from __spark_entry__ import QUERIES, entry, oracle_sql, queries
from tests.compare import connect, difference

QUICK = [
    "rfm_affiliate", "rfm_mall", "mall_refund_flag", "category_rank", "category_or_join", "survival_base_grouped",
    "reward_balance", "campaign_funnel", "cash_band_profile", "snapshot_series", "scalar_null", "scalar_text",
]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", QUICK)
def test_matches_oracle(spark, sf, name):
    assert difference(queries()[name](spark, sf), connect(sf), oracle_sql()[name]) is None


def test_series_equals_the_run_of_each_date(spark, sf):
    """No date knows of refunds that come after it."""
    from pyspark.sql import functions as F

    from patronage.operators import revenue, rfm, segments
    from patronage.sources.star_schema import StarSchema

    src, columns = StarSchema(spark, sf), ["user_id", "recency", "frequency", F.round("monetary", 4).alias("monetary")]
    first, last = "2001-07-26", "2001-08-01"
    series = segments.rfm_series(revenue.purchase_changes(src, "1995-01-01", last), first, last)
    rows = {tuple(r) for r in series.select(F.col("snapshot_dt").cast("string"), *columns).collect()}
    for k in range(7):
        at = f"2001-07-{26 + k}" if k < 6 else last
        want = {(at, *r) for r in rfm.rfm_affiliate(src, "1995-01-01", at).select(*columns).collect()}
        assert {r for r in rows if r[0] == at} == want and want
        rows -= want
    assert not rows


def test_purchase_facts_serve_all_stages(spark, sf):
    """The one table of affiliate purchases holds the revenue of the purchases and the names of all days."""
    from patronage.operators import revenue
    from patronage.sources.star_schema import StarSchema

    src, window = StarSchema(spark, sf), ("1995-01-01", "2001-08-01")
    facts = revenue.purchase_facts(src, *window).cache()
    cols = ["user_id", "event_dt", "revenue"]
    want = revenue.affiliate_purchases(src, *window).select(*cols)
    assert want.exceptAll(facts.select(*cols)).count() == 0 == facts.select(*cols).exceptAll(want).count() and facts.count() > 0
    names = revenue.purchase_names(src, *window)
    assert facts.select(*names.columns).distinct().exceptAll(names.distinct()).count() == 0
    assert names.distinct().exceptAll(facts.select(*names.columns).distinct()).count() == 0


def test_stages_are_read_once_stored_and_not_after_a_change(spark, tmp_path):
    import os

    from patronage.sources.readers import history_versions, kept_stage, write_version
    from patronage.sources.star_schema import _TABLES, StarSchema

    store, built = str(tmp_path / "store"), []

    def build():
        built.append(1)
        return spark.range(3)

    assert [kept_stage(spark, store, "s", build).count() for _ in range(2)] == [3, 3] and built == [1]
    for _ in range(3):
        write_version(spark.range(5), f"{store}/s", keep=2)
    assert history_versions(spark, f"{store}/s") == [2, 3] and kept_stage(spark, store, "s", build).count() == 5
    for name, schema in _TABLES.items():
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    before = StarSchema(spark, str(tmp_path)).state()
    assert StarSchema(spark, str(tmp_path)).state() == before
    os.utime(tmp_path / "part.parquet", (1, 1))
    assert StarSchema(spark, str(tmp_path)).state() != before


def test_survival_lookups_shuffle_no_user_rows(spark, sf):
    """With adaptive execution off, the curve and the rates are broadcast to the stored users."""
    from patronage.operators.survival import SurvivalAnalysis, mall_days
    from patronage.sources.star_schema import StarSchema

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        analysis = SurvivalAnalysis(mall_days(StarSchema(spark, sf), "1995-01-01", "2001-08-01"), "2001-08-01", grouped=True)
        plan = analysis.individual._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert all("gender" in line and "user_id" not in line for line in shuffled) and len(shuffled) <= 1


def test_mall_orders_hold_all_their_lines(spark, sf):
    from pyspark.sql import functions as F

    from patronage.sources.star_schema import StarSchema

    orders = StarSchema(spark, sf).mall_orders.select(F.size("product_option").alias("n"))
    n_lines = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert orders.agg(F.sum("n"), F.max("n") > 1).first() == (n_lines, True)


def test_series_into_dated_history(spark, sf, tmp_path):
    """The day loop over two dates, the later one run again: dated records equal the scored snapshots."""
    from datetime import date

    from patronage.operators.history import read_snapshots
    from patronage.plans.snapshot import run_series
    from patronage.sources.star_schema import StarSchema

    hist, stages = str(tmp_path / "hist"), str(tmp_path / "stages")
    first, last = date(2001, 7, 31), date(2001, 8, 1)
    for begin in (first, last):
        run_series(StarSchema(spark, sf), date(1995, 1, 1), begin, last, hist, stages, tracks=("mall",))
    stored = read_snapshots(spark, f"{hist}/mall")
    assert "version" not in stored.columns
    for on in (first, last):
        want = spark.read.parquet(f"{stages}/{on}/scored_mall").where("user_id is not null")
        assert stored.where(f"snapshot_dt = '{on}'").count() == want.count() > 0
