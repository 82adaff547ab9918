"""Steps that group by the same user again and again deal their rows out once."""

import datetime as dt

from pyspark.sql import functions as F

from patronage.functions import labels
from patronage.functions.scalars import nested_label
from patronage.operators import category, revenue
from patronage.plans.snapshot import Snapshot, Window
from patronage.sources.readers import folders, order_window
from patronage.sources.star_schema import StarSchema

DAY = dt.date(2000, 1, 3)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def events(spark):
    second = dt.datetime(2000, 1, 3, 4, 5, 6)
    action = next(iter(labels.ENTRY_LABELS))
    rows = [
        (DAY, second, user, "D1", "iOS", order, kind, "x", action, name, 1000.0)
        for user, order, kind, name in [
            ("u1", "t1", labels.ORDER_COMPLETE, "b"),
            ("u1", "t1", labels.ORDER_COMPLETE, "a"),
            ("u1", "t1", labels.ORDER_CANCEL, "0"),
            ("u2", None, labels.ORDER_COMPLETE, "c"),
            ("u2", None, labels.ORDER_CANCEL, "d"),
        ]
    ]
    return spark.createDataFrame(
        rows,
        "event_dt date, event_dttm timestamp_ntz, user_id string, airbridge_device_id string, platform string, "
        "transaction_id string, event_category string, event_label string, event_action string, name string, price double",
    )


def test_net_purchases_deal_events_once(spark):
    net = revenue.net_purchases(events(spark), with_name=True)
    assert exchanges(net) == 1
    full = round(1000.0 * labels.COMMISSION_SHARE)
    # The cancel meets its order by the transaction, never without one.
    assert sorted((r.user_id, r.revenue, r.name) for r in net.collect()) == [
        ("u1", float(round(2000.0 * labels.COMMISSION_SHARE) - full), "a"),
        ("u2", float(full), "c"),
    ]


def test_partner_cancels_are_dealt_as_they_are_joined(spark):
    joined = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = spark.createDataFrame([(DAY, "u1", "a", 5.0), (DAY, "u1", "b", 4.0)], "date date, subParam string, productName string, commission double")
        cancels = spark.createDataFrame([("20000104", DAY, "u1", -2.0)], "date string, orderDate date, subParam string, commission double")
        net = revenue.net_partner(
            revenue.partner_daily(orders, "2000-01-01", "2000-02-01"), revenue.partner_cancel_daily(cancels, "2000-01-01", "2000-02-01")
        )
        assert exchanges(net) == 2  # one for each feed
        assert [(r.user_id, r.revenue, r.name) for r in net.collect()] == [("u1", 7.0, "a")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", joined)


def test_category_power_deals_days_once_a_level(spark):
    days = spark.createDataFrame(
        [("u1", DAY, "a", "x"), ("u1", dt.date(2000, 1, 4), "a", "y"), ("u1", dt.date(2000, 1, 4), "b", None)],
        "user_id string, event_dt date, depth1 string, depth2 string",
    )
    power = category.category_power(category.affiliate_depth1(days), category.affiliate_depth2(days), "user_id", "2000-01-31")
    assert exchanges(power) == 2
    (row,) = power.collect()
    assert (row.ranking_1_1, row.ranking_1_2, row.ranking_1_3) == ("a", "b", None)


def test_both_category_levels_read_days_dealt_once(spark):
    later = dt.date(2000, 1, 4)
    rows = [("u1", DAY, "a", "x"), ("u1", DAY, "a", "x"), ("u1", later, "a", "y"), ("u1", later, "b", None), ("u2", DAY, "b", " "), (None, DAY, "a", "x")]
    days = spark.createDataFrame(rows, "user_id string, event_dt date, depth1 string, depth2 string")
    label = nested_label(F.col("depth1"), F.trim("depth2"))
    power = category.category_power_of_days(days, "user_id", "event_dt", F.col("depth1"), label, F.col("depth1") != "b", "2000-01-31")
    assert exchanges(power) == 1
    second = days.where("depth1 <> 'b'")
    apart = category.category_power(category.affiliate_depth1(days), category.affiliate_depth2(second), "user_id", "2000-01-31")
    assert power.columns == apart.columns
    got = {r.user_id: r for r in power.collect()}
    assert got == {r.user_id: r for r in apart.collect()}
    assert (got["u1"].ranking_1_1, got["u1"].ranking_2_2, got["u2"].ranking_2_1) == ("a", "a(y)", None)
    assert (got[None].ranking_1_1, got[None].ranking_2_1) == ("a", None)


def test_events_are_dealt_into_all_parts(spark):
    # Parts merged by their compressed size would be sorted whole.
    plan = revenue.net_purchases(events(spark), with_name=True)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_stored_orders_give_the_same_fields_without_further_joins(spark, tmp_path):
    at = dt.datetime(2000, 1, 3, 4, 5, 6)
    orders = [(1, 7, "F", 9.0, at, "1-URGENT"), (1, 8, "O", 8.0, at, "5-LOW"), (2, 7, "P", 7.0, at, None), (3, None, "O", 6.0, at, "2-HIGH"), (None, 7, "O", 5.0, at, "2-HIGH")]
    spark.createDataFrame(
        orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    ).write.parquet(f"file://{tmp_path}/orders.parquet")
    lines = [(1, 5, 3, 2, 4.0, 0.1, "R", "F"), (1, 6, 3, 1, 4.0, 0.2, "N", "O"), (1, 6, 3, 1, 4.0, 0.2, "N", "O"), (2, 6, 4, None, None, None, "A", "O"), (None, 6, 3, 1, 4.0, 0.2, "R", "O"), (9, 6, 3, 1, 4.0, 0.2, "R", "O")]
    spark.createDataFrame(
        [(o, p, s, n, 1.0, price, d, 0.0, r, st, at) for o, p, s, n, price, d, r, st in lines],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
        "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    ).write.parquet(f"file://{tmp_path}/lineitem.parquet")
    plain, stored = StarSchema(spark, f"file://{tmp_path}"), StarSchema(spark, f"file://{tmp_path}", f"file://{tmp_path}/all")
    for name, n in (("affiliate_events", 7), ("partner_orders", 5), ("partner_cancels", 2), ("mall_orders", 5)):
        want, got = getattr(plain, name), getattr(stored, name)
        assert got.schema.simpleString() == want.schema.simpleString()
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        assert got.count() == n
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert folders(spark, f"file://{tmp_path}/all/orders_with_lines", "version") == ["0"]


def test_dates_share_the_stage_of_mall_orders(spark, tmp_path):
    class Source:
        mall_orders = spark.createDataFrame(
            [(DAY, 1, 2, 3.0, [(1.0, "BUY_CONFIRM")])],
            "order_dt date, member_no long, category_no long, first_pay_amt double, product_option array<struct<commission_rate double, order_status_type string>>",
        )

        def __getattr__(self, _):
            return None

    for as_of in ("2000-01-31", "2000-02-29"):
        window = Window("2000-01-01", "2000-01-01", as_of)
        snap = Snapshot(Source(), window, f"file://{tmp_path}/{as_of}", reuse=True, common=f"file://{tmp_path}/all")
        assert snap.orders().mall_orders.count() == 1
        assert not (tmp_path / as_of / "orders_mall").exists()
    assert folders(spark, f"file://{tmp_path}/all/orders_mall", "version") == ["0"]


def test_events_of_stored_orders_are_dealt_by_order(spark, tmp_path):
    day, cols = dt.datetime(1995, 1, 3), "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    orders = [(1, 7, "F", 9.0, day, "1-URGENT"), (1, 7, "F", 9.0, day, "1-URGENT"), (2, 8, "O", 8.0, day, "2-HIGH"), (3, None, "O", 6.0, day, "2-HIGH"), (None, 7, "O", 5.0, day, "2-HIGH")]
    spark.createDataFrame(orders, cols).write.parquet(f"file://{tmp_path}/orders.parquet")
    lines = [(1, 5, 3, 1, 4000.0, 0.1, "N", "F"), (1, 6, 3, 2, 1000.0, 0.1, "R", "F"), (2, 6, 4, 1, 3000.0, None, "A", "O"), (2, 6, None, 2, None, 0.1, "N", None), (3, 6, 3, 1, 4.0, 0.2, "N", "O")]
    spark.createDataFrame(
        [(o, p, s, n, 1.0, price, d, 0.0, r, st, day + dt.timedelta(hours=5)) for o, p, s, n, price, d, r, st in lines],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
        "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    ).write.parquet(f"file://{tmp_path}/lineitem.parquet")
    plain, stored = StarSchema(spark, f"file://{tmp_path}"), StarSchema(spark, f"file://{tmp_path}", f"file://{tmp_path}/all")
    assert plain.dealt_events is None
    assert stored.dealt_events.schema.simpleString() == plain.affiliate_events.schema.simpleString()
    assert sorted(map(repr, stored.dealt_events.collect())) == sorted(map(repr, plain.affiliate_events.collect()))
    window = ("1995-01-01", "1995-02-01")
    direct = revenue.net_purchases(order_window(stored.dealt_events, *window), with_name=True, dealt=True)
    plan = direct._jdf.queryExecution().executedPlan().toString()
    assert exchanges(direct) == 1 and plan.index("Generate inline") < plan.index("REPARTITION_BY_NUM")  # taken apart after it
    facts = [sorted(map(repr, revenue.purchase_facts(src, *window).collect())) for src in (plain, stored)]
    assert facts[0] == facts[1] and len(facts[0]) > 3
    assert dict(stored.orders_with_lines.dtypes)["lines"].endswith("l_shipdate:date>>")


def test_events_of_stored_orders_move_keys_as_numbers(spark, tmp_path):
    day = dt.datetime(1995, 1, 3)
    # One transaction of one user in two rows of different days, another user's with the same number, and keys that are null.
    orders = [(1, 7, day, "1-URGENT"), (1, 7, day + dt.timedelta(days=1), "1-URGENT"), (1, 8, day, "2-HIGH"), (2, None, day, "2-HIGH"), (None, 7, day, "2-HIGH")]
    spark.createDataFrame(
        [(o, c, "F", 9.0, at, p) for o, c, at, p in orders],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    ).write.parquet(f"file://{tmp_path}/orders.parquet")
    spark.createDataFrame(
        [(1, 5, 3, 1, 1.0, 4000.0, 0.1, 0.0, "N", "F", day), (1, 6, 4, 2, 1.0, 1000.0, 0.1, 0.0, "R", "F", day), (2, 6, 3, 1, 1.0, 9000.0, 0.1, 0.0, "N", "O", day)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
        "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    ).write.parquet(f"file://{tmp_path}/lineitem.parquet")
    plain, stored = StarSchema(spark, f"file://{tmp_path}"), StarSchema(spark, f"file://{tmp_path}", f"file://{tmp_path}/all")
    window = ("1995-01-01", "1995-02-01")
    net = [
        revenue.net_purchases(order_window(events, *window), with_name=True, dealt=dealt)
        for events, dealt in ((plain.affiliate_events, False), (stored.dealt_events, True))
    ]
    plan = net[1]._jdf.queryExecution().executedPlan().toString()
    assert exchanges(net[1]) == 1 and "Exchange hashpartitioning(cast(o_custkey" in plan
    rows = [sorted(map(repr, n.collect())) for n in net]
    assert rows[0] == rows[1] and len(rows[0]) == 5  # both orders of a transaction meet both its refunds
