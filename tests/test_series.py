"""The chain from stored states: equal to the run of each date, from the facts of new days alone."""

from dataclasses import fields
from datetime import date

import pytest
from pyspark.sql import functions as F

from patronage.operators import history
from patronage.plans.series import TABLES, ChainStore, StateSnapshot, chain_rows, run_daily
from patronage.plans.snapshot import TRACKS, Snapshot, Window
from patronage.sources import readers
from patronage.sources.schemas import Sources
from patronage.sources.star_schema import StarSchema

START, CHURN_START = "1995-01-01", "1996-01-01"
DATES = ["2001-07-20", "2001-07-24", "2001-07-25"]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    base, star = str(tmp_path_factory.mktemp("sources")), StarSchema(spark, "/root/testdata/sf0.001")
    for f in fields(Sources):
        readers.write_stage(getattr(star, f.name), base, f.name)
    return readers.read_sources(spark, base)


def only(src, after, upto):
    """The sources with the facts of some days alone."""
    text = upto.replace("-", "")

    def between(column, low, high):
        rows = column <= high
        return rows if low is None else rows & (column > low)

    days = {"affiliate_events": "event_dt", "partner_orders": "date", "mall_orders": "order_dt"}
    cut_ = {t: getattr(src, t).where(between(F.col(c), F.lit(after).cast("date"), F.lit(upto).cast("date")) if after else F.col(c) <= F.lit(upto).cast("date")) for t, c in days.items()}
    cut_["partner_cancels"] = src.partner_cancels.where(between(F.col("date"), after and after.replace("-", ""), text))
    return Sources(**{f.name: cut_.get(f.name, getattr(src, f.name)) for f in fields(Sources)})


def rounded(rows):
    return sorted(repr([round(v, 4) if isinstance(v, float) else v for v in r]) for r in rows.collect())


def test_states_of_new_facts_alone_equal_the_run_of_each_date(spark, stored, tmp_path):
    states, last = ChainStore(spark, str(tmp_path / "chain"), START, CHURN_START), None
    for on in DATES:
        states.advance(only(stored, last, on), on)
        last = on
    assert states.dates() == DATES
    want, got = Snapshot(only(stored, None, DATES[-1]), Window(START, START, DATES[-1], CHURN_START)), states.snapshot(stored, DATES[-1])
    for track in TRACKS:
        assert rounded(chain_rows(got, track)) == rounded(chain_rows(want, track)) != []
    merged = [snap.merged("mall") for snap in (got, want)]
    assert rounded(merged[0].select(merged[1].columns)) == rounded(merged[1]) != []
    with pytest.raises(ValueError):
        states.advance(stored, DATES[1][:-1] + "3")


def test_refunds_change_money_on_their_own_day(spark, tmp_path):
    """Two refunds of one order on later days, one of an order that comes after it, and a refund of no order."""
    order, cancel = "Order Complete (App)", "Order Cancel (App)"
    rows = [
        ("2025-01-01", "u", "t1", order, 1000.0), ("2025-01-02", "u", "t1", cancel, 400.0), ("2025-01-03", "u", "t1", cancel, 2000.0),
        ("2025-01-01", "v", "t2", cancel, 500.0), ("2025-01-02", "v", "t2", order, 2000.0), ("2025-01-02", "w", "t3", cancel, 100.0),
        ("2025-01-03", "v", None, order, 1000.0), ("2025-01-03", "v", None, cancel, 1000.0),
    ]
    events = spark.createDataFrame(rows, "event_dt string, user_id string, transaction_id string, event_category string, price double").selectExpr(
        "CAST(event_dt AS date) AS event_dt", "CAST(event_dt AS timestamp_ntz) AS event_dttm", "user_id", "'d' AS airbridge_device_id", "'p' AS platform",
        "transaction_id", "event_category", "'x' AS event_label", "'other' AS event_action", "'n' AS name", "price",
    )
    empty = {
        "partner_orders": "date date, subParam string, productName string, commission double",
        "partner_cancels": "date string, orderDate date, subParam string, commission double",
        "product_keywords": "name string, category1 string, category2 string",
        "app_members": "user_id string, platform string, join_dt date, total_accumulate_cash bigint, current_cash bigint, terms_agree_yn string",
        "mall_orders": "order_dt date, member_no bigint, category_no bigint, first_pay_amt double, product_option array<struct<commission_rate:double,order_status_type:string>>",
        "mall_members": "member_no bigint, wk_id string, gender string, birth_year string",
        "mall_categories": "depth1_category_no bigint, depth1_category_name string, depth2_category_name string, depth3_category_no bigint, depth4_category_no bigint",
        "reward_ledger": "member_no bigint, amt bigint, accumulation_status string, register_dttm date",
        "offerwall_rfm": "user_id string, recency bigint, frequency bigint, monetary double",
        "app_events": "user_id string",
    }
    tables = {name: spark.createDataFrame([], schema) for name, schema in empty.items()}
    tables["app_members"] = spark.createDataFrame([(u, "p", date(2024, 1, 1), 0, 0, "Y") for u in "uvw"], empty["app_members"])
    src = Sources(affiliate_events=events, **tables)
    states = ChainStore(spark, str(tmp_path / "chain"), "2025-01-01")
    money = {}
    for k in (1, 2, 3):
        on = f"2025-01-0{k}"
        states.advance(src, on)
        money[k] = {r.user_id: r.monetary for r in states.table("affiliate_users", on).collect() if r.monetary}
        want = {r.user_id: r.monetary for r in Snapshot(src, Window("2025-01-01", "2025-01-01", on)).rfm("affiliate").collect()}
        assert {r.user_id: r.monetary for r in states.snapshot(src, on).rfm("affiliate").collect()} == want
    # 4.6 % of the price, rounded; a second refund repeats the order, floored at 0.
    assert money == {1: {"u": 46.0}, 2: {"u": 28.0, "v": 69.0}, 3: {"u": 28.0, "v": 115.0}}


def test_a_failed_advance_leaves_the_states(spark, stored, tmp_path):
    path = str(tmp_path / "chain")
    states = ChainStore(spark, path, START, CHURN_START)
    states.advance(stored, DATES[0])
    broken = Sources(**{f.name: getattr(stored, f.name) for f in fields(Sources)} | {"mall_orders": stored.mall_orders.withColumn("member_no", F.raise_error(F.lit("lost")).cast("bigint"))})
    with pytest.raises(Exception, match="lost"):
        states.advance(broken, DATES[1])
    assert states.dates() == DATES[:1]
    before = {name: states.table(name, DATES[0]).count() for name in TABLES}
    states.advance(stored, DATES[1], keep=1)
    assert states.dates() == DATES[:2] and before["affiliate_users"] > 0
    assert isinstance(states.snapshot(stored, DATES[1]), StateSnapshot) and readers.folders(spark, f"{path}/state", "upto") == [DATES[1]]


def test_days_run_into_the_history(spark, stored, tmp_path):
    paths = [str(tmp_path / name) for name in ("state", "history", "stages")]
    run_daily(stored, date(1995, 1, 1), date(2001, 7, 30), date(2001, 7, 31), *paths, tracks=("mall",), partner_churn_start=CHURN_START)
    records = history.read_snapshots(spark, f"{paths[1]}/mall")
    for on in ("2001-07-30", "2001-07-31"):
        want = spark.read.parquet(f"{paths[2]}/{on}/scored_mall").where("user_id IS NOT NULL").count()
        assert records.where(f"snapshot_dt = '{on}'").count() == want > 0
