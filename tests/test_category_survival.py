from datetime import date, timedelta

from pyspark.sql import functions as F

from patronage.operators import category, survival

D = date
CATEGORIES = (
    "depth1_category_no bigint, depth1_category_name string, depth2_category_name string, "
    "depth3_category_no bigint, depth4_category_no bigint"
)


def test_or_join_equals_brute_force_without_a_nested_loop(spark):
    orders = spark.createDataFrame([(1, 10), (2, 20), (3, None), (4, 99)], "order_no bigint, category_no bigint")
    cats = spark.createDataFrame(
        [(1, "a", "x", 10, 20), (1, "a", "y", 10, 10), (2, "b", None, None, 20), (3, "c", "", 30, None)], CATEGORIES
    )
    fast = category.category_or_join(orders, cats)
    match = (cats.depth4_category_no == orders.category_no) | (cats.depth3_category_no == orders.category_no)
    slow = orders.join(cats, match, "left")
    cols = ["order_no", "category_no", *cats.columns]
    assert sorted(map(repr, fast.select(*cols).collect())) == sorted(map(repr, slow.select(*cols).collect()))
    assert "NestedLoop" not in fast._jdf.queryExecution().executedPlan().toString()


def test_null_and_blank_subcategories_stay_apart(spark):
    days = spark.createDataFrame(
        [("u", D(2025, 1, 1), "a-b", None), ("u", D(2025, 1, 2), "a-b", ""), ("u", D(2025, 1, 2), "a-b", " c ")],
        "user_id string, event_dt date, depth1 string, depth2 string",
    )
    assert sorted(r.label for r in category.affiliate_depth2(days).collect()) == ["a-b(c)", "a-b(없음)", "a-b(없음)"]


def test_shares_ties_and_top(spark):
    stats = spark.createDataFrame(
        [("u", c, D(2025, 1, 1), 1) for c in "dbca"] + [("v", "x", D(2025, 1, 1), 3)],
        "user_id string, label string, latest_dt date, order_count bigint",
    )
    shares = category.interest_shares(stats, "user_id", "2025-01-11")
    ranked = category.rank_interest(shares, "user_id", 3)
    got = {r.user_id: r.asDict() for r in category.pivot_top(ranked, "user_id", 1, 3).collect()}
    assert [got["u"][f"ranking_1_{i}"] for i in (1, 2, 3)] == ["a", "b", "c"]
    assert got["u"]["power_1_1"] == 0.25 and got["v"]["power_1_1"] == 1.0 and got["v"]["ranking_1_2"] is None


def days_of(spark, gaps: dict):
    rows = []
    for user, steps in gaps.items():
        at = D(2025, 1, 1)
        rows.append((user, at))
        for step in steps:
            at += timedelta(days=step)
            rows.append((user, at))
    return spark.createDataFrame(rows, "user_id string, order_dt date")


def test_cycles_use_the_first_gaps_and_fifteen_days(spark):
    days = days_of(spark, {"a": [1, 2, 4, 10], "b": [5], "c": [], "d": [1] * 14 + [100]})
    got = {r.user_id: r for r in survival.cycle_stats(survival.purchase_intervals(days)).collect()}
    assert (got["a"].current_trailing_term, got["a"].prev_trailing_term) == (2.3, 5.3)
    assert (got["b"].current_trailing_term, got["b"].prev_trailing_term, got["b"].cycle_stddev) == (5.0, None, None)
    assert "c" not in got and got["d"].cycle_stddev == 0.0
    late = {r.user_id: r for r in survival.cycle_stats(survival.purchase_intervals(days, latest=True), latest=True).collect()}
    assert (late["a"].current_trailing_term, late["a"].prev_trailing_term) == (5.3, 2.3)


def test_latest_terms_see_the_last_of_many_days(spark):
    """30 purchase days with gaps 1, 3, 5, ... 57: the last three are 53, 55, 57."""
    days = days_of(spark, {"a": [2 * k + 1 for k in range(29)]})
    late = survival.cycle_stats(survival.purchase_intervals(days, latest=True), latest=True).first()
    assert (late.current_trailing_term, late.prev_trailing_term) == (55.0, 53.0)


def test_rank_limit_is_applied_before_the_shuffle(spark):
    plan = survival.purchase_intervals(days_of(spark, {"a": [1]}))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_survival_table_with_equal_terms(spark):
    """All terms equal: MAD 0, so nobody is an outlier and the z-score is null."""
    days = days_of(spark, {"a": [10], "b": [10, 10], "c": []})
    a = survival.SurvivalAnalysis(days, "2025-02-09")
    rows = {r.user_id: r for r in a.table.collect()}
    assert rows["a"].modified_zscore is None and rows["a"].days_since_last_purchase == 30
    assert (rows["a"].churn_flag, rows["b"].churn_flag, rows["c"].churn_flag) == (1, 0, None)
    assert rows["c"].cycle_length == "신규" and rows["b"].cycle_length == "단기"
    assert all(0 <= r.survival_prob <= 1 for r in rows.values())
    points = [r.cumulative_survival_prob for r in a.curve.orderBy("time_point").collect()]
    assert points == sorted(points, reverse=True)


def test_grid_takes_the_mean_of_known_neighbours(spark):
    buckets = spark.createDataFrame(
        [(0, "F", 4, 1), (14, "F", 2, 1), (35, "F", 3, 0), (7, None, 9, 9)], "time_point bigint, gender string, n_risk bigint, n_events bigint"
    )
    got = {r.time_point: (r.n_risk, r.n_events) for r in survival.interpolate_grid(buckets).collect()}
    assert got == {0: (4.0, 1.0), 7: (3.0, 1.0), 14: (2.0, 1.0), 21: (None, None), 28: (None, None), 35: (3.0, 0.0)}


def test_null_user_meets_nobody(spark):
    """Members without a user id: one nameless user whose own figures are not looked up."""
    data = [(1, None, D(2025, 1, 1), "F", "1990"), (2, None, D(2025, 1, 5), "F", "1990"), (3, "c", D(2025, 1, 1), "M", "x"), (3, "c", D(2025, 1, 9), "M", "x")]
    days = spark.createDataFrame(data, "member_no bigint, user_id string, order_dt date, gender string, birth_year string")
    rows = survival.SurvivalAnalysis(days, "2025-01-31", grouped=True).table.collect()
    nameless = sorted((r for r in rows if r.user_id is None), key=lambda r: r.cycle_length)
    assert [r.cycle_length for r in nameless] == ["신규", "초단기"]
    assert nameless[0].gender == "F" and nameless[1].gender is None and nameless[1].survival_prob is None
    assert nameless[1].risk_level == "Safe"
    assert [r.age_group for r in rows if r.user_id == "c"] == [None]


def test_null_keys_are_spread_and_match_nothing(spark):
    from patronage.functions.joins import left_join_nullable

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(400).select("id", F.when(F.col("id") % 4 == 0, F.col("id")).alias("k"))
        right = spark.createDataFrame([(0, "a"), (4, "b"), (None, "c")], "k bigint, v string")
        out = left_join_nullable(left, right, "k")
        keys = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [k" in keys and "_spread" in keys.split("SortMergeJoin")[1].splitlines()[0]
        rows = out.collect()
        assert len(rows) == 400 and {r.id: r.v for r in rows if r.v} == {0: "a", 4: "b"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
