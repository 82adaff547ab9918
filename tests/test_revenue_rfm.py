from datetime import date, datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from patronage.functions import labels
from patronage.operators import revenue, rfm
from patronage.sources import readers

EVENT = (
    "event_dt date, event_dttm timestamp_ntz, user_id string, airbridge_device_id string, platform string, "
    "transaction_id string, event_category string, event_label string, event_action string, name string, price double"
)
D = date


def event(user, tx, price, day=1, second=0, cancel=False, label="x", action="balso1sr2", name="n"):
    dt = D(2025, 1, day)
    category = labels.ORDER_CANCEL if cancel else labels.ORDER_COMPLETE
    return (dt, datetime(2025, 1, day, 0, 0, second), user, "d", "iOS", tx, category, label, action, name, price)


def test_order_window_filters(spark):
    keep = [event("u", "1", 1.0), event("u", "2", 1.0, action="^PAYx"), event("IU", "3", 1.0)]
    drop = [
        event("IU_1", "4", 1.0),
        event("IUab", "5", 1.0),
        event("u", "6", 1.0, action="^PAY"),
        event("u", "7", 1.0, label="쇼핑"),
        event("u", "8", 1.0, label=None),
        event("u", "9", 1.0, action=None),
        event(None, "10", 1.0),
        event("u", "11", 1.0, day=9),
    ]
    df = spark.createDataFrame(keep + drop, EVENT)
    got = readers.order_window(df, "2025-01-01", "2025-01-08").select("transaction_id").collect()
    assert sorted(r[0] for r in got) == ["1", "2", "3"]


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(
        [
            # 11 x 0.046 = 0.506 -> 1 per second; summed first it would be 1.012 -> 1
            event("a", "1", 11.0, second=0), event("a", "1", 11.0, second=1),
            event("a", "2", 1000.0), event("a", "2", 2000.0, day=3, cancel=True),
            event("b", "3", 1000.0), event("b", "3", 100.0, day=2, cancel=True), event("b", "3", 200.0, day=3, cancel=True),
            event("c", None, 500.0), event("c", None, 300.0, day=2, cancel=True),
            event("d", "4", 100.0, name="z"), event("d", "4", 100.0, name="y", action="other"),
        ],
        EVENT,
    ).cache()


def test_rounding_grain_floor_and_repeated_orders(spark, events):
    orders = revenue.revenue_rollup(events, labels.ORDER_COMPLETE)
    refunds = revenue.revenue_rollup(events, labels.ORDER_CANCEL)
    net = sorted((r.user_id, r.transaction_id or "", r.revenue) for r in revenue.net_orders(orders, refunds).collect())
    assert net == [
        ("a", "1", 2.0), ("a", "2", 0.0), ("b", "3", 37.0), ("b", "3", 41.0), ("c", "", 23.0), ("d", "4", 5.0), ("d", "4", 5.0),
    ]
    once = revenue.net_orders(orders, refunds, floor=False, sum_refunds=True)
    assert sorted(r.revenue for r in once.where("user_id in ('a', 'b')").collect()) == [-46.0, 2.0, 32.0]


@pytest.mark.parametrize("floor", [True, False])
def test_one_scan_equals_join(spark, events, floor):
    joined = revenue.net_orders(
        revenue.revenue_rollup(events, labels.ORDER_COMPLETE, by_name=True),
        revenue.revenue_rollup(events, labels.ORDER_CANCEL),
        floor,
    )
    single = revenue.net_purchases(events, floor, by_name=True)
    cols = revenue.PURCHASE_COLUMNS + ["name"]
    assert sorted(map(repr, single.select(*cols).collect())) == sorted(map(repr, joined.select(*cols).collect()))


def test_purchase_names_equal_those_of_the_purchases(spark, events):
    src = SimpleNamespace(
        affiliate_events=events,
        partner_orders=spark.createDataFrame(
            [(D(2025, 1, 2), "a", "p2", 5.0), (D(2025, 1, 2), "a", "p1", 5.0), (D(2025, 1, 2), None, "p0", 5.0)],
            "date date, subParam string, productName string, commission double",
        ),
        partner_cancels=spark.createDataFrame(
            [("20250103", D(2025, 1, 2), "a", -20.0)], "date string, orderDate date, subParam string, commission double"
        ),
    )
    args = (src, "2025-01-01", "2025-01-31")
    names = {tuple(r) for r in revenue.purchase_names(*args).distinct().collect()}
    full = revenue.affiliate_purchases(*args, by_name=True)
    assert names == {tuple(r) for r in full.select("user_id", "event_dt", "name").distinct().collect()}
    partner = full.where("event_label = 'coin'").collect()
    assert [(r.user_id, r.name, r.revenue) for r in partner] == [("a", "p1", 0.0)]


def test_members_without_and_with_only_later_purchases(spark):
    members = spark.createDataFrame(
        [(u, "p", D(2024, 1, 1), 1, 1) for u in ("none", "later", "both")],
        "user_id string, platform string, join_dt date, total_accumulate_cash bigint, current_cash bigint",
    )
    purchases = spark.createDataFrame(
        [("later", D(2025, 2, 1), 5.0), ("both", D(2025, 1, 1), 3.0), ("both", D(2025, 1, 1), 4.0), ("both", D(2025, 2, 1), 9.0)],
        "user_id string, event_dt date, revenue double",
    )
    got = {r.user_id: (r.recency, r.frequency, r.monetary) for r in rfm.member_activity(members, purchases, "2025-01-11").collect()}
    assert got == {"none": (None, 0, 0.0), "both": (10, 1, 7.0)}


MALL = "member_no bigint, order_dt date, first_pay_amt double, product_option array<struct<commission_rate: double, order_status_type: string>>"


def test_mall_refunds_by_counts_equal_the_fan_out_join(spark):
    ok, back = [(2.0, "BUY_CONFIRM")], [(1.0, "CANCEL DONE")]
    orders = spark.createDataFrame(
        [
            (1, D(2025, 1, 1), 10.0, ok), (1, D(2025, 5, 1), 20.0, ok), (1, D(2025, 5, 1), 5.0, ok),
            (1, D(2025, 3, 1), 0.0, back),                     # 59 days after the first, before the second
            (1, D(2025, 4, 5), 0.0, back),                     # 94 days after the first
            (2, D(2025, 1, 1), 7.0, ok), (2, D(2025, 9, 1), 0.0, back),  # after as_of
            (3, D(2025, 1, 1), 8.0, ok), (3, D(2025, 1, 2), 9.0, []),
            (4, D(2025, 1, 1), 8.0, [(1.0, "PAY_WAIT")]),
        ],
        MALL,
    )
    members = spark.createDataFrame(
        [(1, "a", "F", "1990"), (2, None, None, "x"), (3, "c", None, None)], "member_no bigint, wk_id string, gender string, birth_year string"
    )
    apps = spark.createDataFrame(
        [("a", "ios", D(2024, 1, 1), 5, 6)], "user_id string, platform string, join_dt date, total_accumulate_cash bigint, current_cash bigint"
    )
    src = SimpleNamespace(mall_orders=orders, mall_members=members, app_members=apps)
    as_of = "2025-06-01"
    valid = readers.mall_orders_in(orders, labels.MALL_VALID_STATUSES, "2025-01-01", as_of)
    refunds = readers.mall_orders_in(orders, labels.MALL_REFUND_STATUSES).select("member_no", F.col("order_dt").alias("refund_dt"))
    hit = F.coalesce((F.datediff("refund_dt", "order_dt") <= 90) & (F.col("refund_dt") <= as_of), F.lit(False))
    pairs = valid.join(refunds, "member_no", "left").withColumn("hit", hit)
    want = {
        r.member_no: (r.f, r.m, r.n, r.b)
        for r in pairs.groupBy("member_no").agg(
            F.countDistinct(F.when(~F.col("hit"), F.col("order_dt"))).alias("f"),
            F.sum(F.when(~F.col("hit"), F.col("first_pay_amt")).otherwise(0)).alias("m"),
            F.count(F.lit(1)).alias("n"), F.count_if("hit").alias("b"),
        ).collect()
    }
    got = {r.member_no: r for r in rfm.rfm_mall(src, "2025-01-01", as_of).collect()}
    assert {k: (r.frequency, r.monetary, r.total_purchases, r.total_refunds) for k, r in got.items()} == want
    assert got[2].user_id is None and got[3].refund_rate == 0.0
    once = {r.member_no: r for r in rfm.rfm_mall(src, "2025-01-01", as_of, fan_out=False).collect()}
    assert (once[1].total_purchases, once[1].total_refunds, once[1].monetary, once[1].recency) == (3, 3, 0.0, None)


def test_orders_without_a_member_are_kept_unrefunded(spark):
    from patronage.operators import rfm

    orders = spark.sql("SELECT 1 AS order_no, CAST(NULL AS BIGINT) AS member_no, DATE '2001-01-01' AS order_dt UNION ALL SELECT 2, 7, DATE '2001-01-01'")
    refunds = spark.sql("SELECT CAST(NULL AS BIGINT) AS member_no, DATE '2001-01-02' AS order_dt UNION ALL SELECT 7, DATE '2001-01-02'")
    got = {r.order_no: (r.hits, r.refunds, r.is_refunded) for r in rfm.refund_flags(orders, refunds, "2001-02-01").collect()}
    assert got == {1: (0, 0, False), 2: (1, 1, True)}
