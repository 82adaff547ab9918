"""The registered queries: every operator over the whole star-schema tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import fields
from functools import reduce
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from patronage.functions import labels
from patronage.functions import scalars as sc
from patronage.functions.joins import left_join_nullable
from patronage.functions.stages import cut, new_path, shared_folder
from patronage.operators import category, history, profile, revenue, rfm, scoring, segments, study, survival
from patronage.plans.series import ChainStore, chain_rows
from patronage.plans.snapshot import TRACKS, SharedStages, Snapshot, Window, run_series, scored_side_by_side
from patronage.sources import readers
from patronage.sources.schemas import Sources, history_schema
from patronage.sources.store import BucketedTable, FactTable
from patronage.sources.star_schema import ORDERS_AS_OF, ORDERS_START, StarSchema

# The partner feed enters the churn input later than the revenue.
PARTNER_CHURN_START = "1996-01-01"
# Earlier date for the queries that compare two.
EARLIER = "2001-06-30"
SERIES = ("2001-07-26", ORDERS_AS_OF)
CHAIN_DATES = ("2001-07-28", "2001-07-29", "2001-07-30", "2001-07-31", ORDERS_AS_OF)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def present(df: DataFrame, places: int = 6, **by_column: int) -> DataFrame:
    """Plain result types: dates as text, whole numbers as bigint, doubles rounded."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double"), by_column.get(f.name, places))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _src(spark: SparkSession, d: str) -> StarSchema:
    return StarSchema(spark, d)


def _snapshots(spark: SparkSession, d: str, *dates: str) -> list[Snapshot]:
    """The chains of some dates, whose stages are stored as a daily run stores them: later queries
    read what earlier ones wrote, and the dates share what they read of the facts.  The place is
    named by the files of the tables, so stages of changed tables are never read."""
    src = _src(spark, d)
    store = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/tables-{src.state()}"
    stored, shared = StarSchema(spark, d, f"{store}/all"), SharedStages(dates, f"{store}/all", reuse=True)
    windows = [Window(ORDERS_START, ORDERS_START, as_of, PARTNER_CHURN_START) for as_of in dates]
    return [Snapshot(stored, w, f"{store}/{w.as_of}", reuse=True, common=shared) for w in windows]


def _snapshot(spark: SparkSession, d: str) -> Snapshot:
    return _snapshots(spark, d, ORDERS_AS_OF)[0]


# --- scans and filters --------------------------------------------------------


@query
def order_window_scan(spark, d):
    return present(readers.order_window(StarSchema(spark, d).affiliate_events, ORDERS_START, ORDERS_AS_OF))


STORED_WINDOW = ("2001-05-15", "2001-07-20")


@query
def order_window_stored(spark, d):
    """Events stored by month, those of some months written again, and the window read from its months alone."""
    events = StarSchema(spark, d).affiliate_events
    facts = FactTable(spark, new_path(spark, "events"), "event_dt", "month")
    facts.write(events)
    facts.write(events.where(F.col("event_dt").between(sc.day("2001-06-01"), sc.day("2001-06-30"))))
    return present(readers.read_orders(facts, *STORED_WINDOW))


@query
def order_entry_label(spark, d):
    events = StarSchema(spark, d).affiliate_events
    entry = revenue.entry_label(F.col("event_action"))
    return present(
        events.groupBy("event_action", entry.alias("entry")).agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("price")),
        places=2,
    )


@query
def mall_valid_orders(spark, d):
    src = _src(spark, d)
    orders = readers.mall_orders_in(src.mall_orders, labels.MALL_VALID_STATUSES, ORDERS_START, ORDERS_AS_OF)
    people = src.mall_members.select("member_no", F.col("wk_id").alias("user_id"), "gender", "birth_year")
    apps = src.app_members.select("user_id", "join_dt", "platform", "total_accumulate_cash", "current_cash")
    first = F.col("product_option")
    out = left_join_nullable(orders.join(people, "member_no", "left"), apps, "user_id", ["order_no"])
    return present(
        out.select(
            "order_no", "order_dt", "member_no", "user_id", "join_dt", "platform", "total_accumulate_cash",
            "current_cash", "gender", "birth_year", "first_pay_amt",
            sc.first_of(first, "commission_rate").alias("commission_rate"),
            sc.first_of(first, "order_status_type").alias("order_status_type"),
        )
    )


# --- scalar functions ------------------------------------------------------------


@query
def scalar_null(spark, d):
    c = StarSchema(spark, d).table("customer")
    bal, nation = F.col("c_acctbal"), F.col("c_nationkey")
    return present(
        c.select(
            "c_custkey",
            F.coalesce(F.nullif(nation, F.lit(13)), F.lit(-1)).alias("nation_or_default"),
            F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("segment_or_null"),
            sc.safe_divide(bal, nation.cast("double")).alias("ratio"),
            sc.greatest_or_null(F.nullif(nation, F.lit(7)).cast("double"), F.lit(5.0)).alias("greatest_or_null"),
            sc.floor_at_zero(bal).cast("double").alias("floored"),
        )
    )


@query
def scalar_math(spark, d):
    c = StarSchema(spark, d).table("customer")
    bal = F.col("c_acctbal")
    return present(
        c.select(
            "c_custkey",
            F.round(bal).alias("whole"),
            F.round(bal, 1).alias("tenth"),
            sc.round_half_up(bal / 7, 2).alias("half_up"),
            F.floor(bal / 7).alias("week_floor"),
            F.abs(bal).alias("magnitude"),
            (-bal).alias("negated"),
            F.exp(-F.abs(bal) / 1000).alias("decay"),
            F.ln(F.nullif(F.abs(bal), F.lit(0.0))).alias("log"),
            F.log1p(F.abs(bal)).alias("log1p"),
            F.sqrt(F.abs(bal)).alias("root"),
            F.pow(F.abs(bal) / 1000, F.lit(1.5)).alias("power"),
            F.least(F.greatest(bal, F.lit(0.0)), F.lit(5000.0)).alias("clipped"),
            sc.round_to_long(bal).alias("as_long"),
        )
    )


@query
def scalar_date(spark, d):
    o = StarSchema(spark, d).table("orders")
    dt = F.to_date("o_orderdate")
    return present(
        o.select(
            "o_orderkey",
            dt.alias("day"),
            F.date_format(dt, "yyyyMMdd").alias("compact"),
            F.to_date(F.date_format(dt, "yyyyMMdd"), "yyyyMMdd").alias("parsed"),
            F.date_sub(dt, 1).alias("day_before"),
            F.datediff(sc.day(ORDERS_AS_OF), dt).alias("days_ago"),
            F.year(dt).alias("year"),
        )
    )


@query
def scalar_text(spark, d):
    p = StarSchema(spark, d).table("part")
    outer = sc.clean_label(F.concat("p_type", F.lit("/"), F.col("p_size")))
    inner = F.when(F.col("p_size") > 40, F.lit(" ")).when(F.col("p_size") < 5, F.lit(None)).otherwise(F.col("p_brand"))
    return present(
        p.select(
            "p_partkey",
            outer.alias("cleaned"),
            sc.nested_label(outer, inner).alias("nested"),
            F.trim(F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))).alias("trimmed"),
            F.col("p_name").like("small%").alias("is_small"),
            sc.has_label(inner).alias("has_inner"),
        )
    )


@query
def numeric_coerce(spark, d):
    e = StarSchema(spark, d).table("part")
    text = F.when(F.col("p_size") % 3 == 0, F.col("p_brand")).otherwise(F.col("p_retailprice").cast("string"))
    return present(e.select("p_partkey", sc.safe_double(text).alias("number"), sc.safe_int(F.col("p_brand")).alias("whole")))


@query
def age_group(spark, d):
    members = StarSchema(spark, d).mall_members
    return present(
        members.select("member_no", "birth_year", sc.age_group(F.col("birth_year"), sc.day(ORDERS_AS_OF)).alias("age_group"))
    )


@query
def join_group(spark, d):
    members = StarSchema(spark, d).app_members
    return present(members.select("user_id", "join_dt", sc.join_group(F.col("join_dt")).alias("join_group")))


# --- affiliate revenue -----------------------------------------------------------


def _window_events(src):
    return readers.order_window(src.affiliate_events, ORDERS_START, ORDERS_AS_OF)


@query
def order_revenue_rollup(spark, d):
    return present(revenue.revenue_rollup(_window_events(_src(spark, d)), labels.ORDER_COMPLETE))


@query
def order_revenue_rollup_by_name(spark, d):
    return present(revenue.revenue_rollup(_window_events(_src(spark, d)), labels.ORDER_COMPLETE, by_name=True))


@query
def refund_revenue_rollup(spark, d):
    return present(revenue.revenue_rollup(_window_events(_src(spark, d)), labels.ORDER_CANCEL))


def _net(spark, d, **kw):
    events = _window_events(_src(spark, d))
    return revenue.net_orders(
        revenue.revenue_rollup(events, labels.ORDER_COMPLETE), revenue.revenue_rollup(events, labels.ORDER_CANCEL), **kw
    )


@query
def net_order_revenue(spark, d):
    return present(_net(spark, d))


@query
def net_order_revenue_refunds_summed(spark, d):
    return present(_net(spark, d, sum_refunds=True))


@query
def partner_daily(spark, d):
    return present(revenue.partner_daily(_src(spark, d).partner_orders, ORDERS_START, ORDERS_AS_OF), places=4)


@query
def partner_cancel_daily(spark, d):
    return present(revenue.partner_cancel_daily(_src(spark, d).partner_cancels, ORDERS_START, ORDERS_AS_OF), places=4)


@query
def net_partner_revenue(spark, d):
    src = _src(spark, d)
    return present(
        revenue.net_partner(
            revenue.partner_daily(src.partner_orders, ORDERS_START, ORDERS_AS_OF),
            revenue.partner_cancel_daily(src.partner_cancels, ORDERS_START, ORDERS_AS_OF),
        ),
        places=4,
    )


@query
def combined_purchases(spark, d):
    return present(revenue.affiliate_purchases(_src(spark, d), ORDERS_START, ORDERS_AS_OF), places=4)


@query
def purchase_log(spark, d):
    return present(_snapshot(spark, d).purchase_log(), places=4)


# --- RFM -------------------------------------------------------------------------


@query
def rfm_affiliate(spark, d):
    return present(rfm.rfm_affiliate(_src(spark, d), ORDERS_START, ORDERS_AS_OF), places=4)


@query
def member_activity(spark, d):
    src = _src(spark, d)
    purchases = revenue.affiliate_purchases(src, "2001-01-01", "2001-08-01")
    return present(rfm.member_activity(src.app_members, purchases, "2001-03-31"), places=4)


@query
def rfm_mall(spark, d):
    return present(rfm.rfm_mall(_src(spark, d), ORDERS_START, ORDERS_AS_OF), monetary=2)


@query
def rfm_mall_orders_once(spark, d):
    return present(rfm.rfm_mall(_src(spark, d), ORDERS_START, ORDERS_AS_OF, fan_out=False), monetary=2)


@query
def mall_refund_flag(spark, d):
    src = _src(spark, d)
    orders = readers.mall_orders_in(src.mall_orders, labels.MALL_VALID_STATUSES, ORDERS_START, ORDERS_AS_OF)
    refunds = readers.mall_orders_in(src.mall_orders, labels.MALL_REFUND_STATUSES)
    flagged = rfm.refund_flags(orders, refunds, ORDERS_AS_OF)
    return present(flagged.select("order_no", "member_no", "order_dt", "hits", "refunds", "is_refunded"))


@query
def reward_balance(spark, d):
    src = _src(spark, d)
    return present(profile.reward_balance(src.reward_ledger, src.mall_members, ORDERS_AS_OF))


# --- categories --------------------------------------------------------------------


def _affiliate_category_days(spark, d):
    return category.affiliate_category_days(_src(spark, d), ORDERS_START, ORDERS_AS_OF)


def _mall_category_days(spark, d):
    return category.mall_category_days(_src(spark, d), ORDERS_START, ORDERS_AS_OF)


@query
def category_interest_depth1(spark, d):
    stats = category.affiliate_depth1(_affiliate_category_days(spark, d))
    return present(category.interest_shares(stats, "user_id", ORDERS_AS_OF))


@query
def category_interest_depth2(spark, d):
    stats = category.affiliate_depth2(_affiliate_category_days(spark, d))
    return present(category.interest_shares(stats, "user_id", ORDERS_AS_OF))


@query
def category_rank(spark, d):
    stats = category.affiliate_depth2(_affiliate_category_days(spark, d))
    return present(category.rank_interest(category.interest_shares(stats, "user_id", ORDERS_AS_OF), "user_id", 6))


@query
def category_power(spark, d):
    return present(category.category_power_affiliate(_src(spark, d), ORDERS_START, ORDERS_AS_OF))


@query
def category_or_join(spark, d):
    src = _src(spark, d)
    joined = category.category_or_join(src.mall_orders, src.mall_categories)
    return present(
        joined.select(
            "order_no", "order_dt", "member_no", "category_no", "depth1_category_no", "depth1_category_name",
            "depth2_category_name", "depth3_category_no", "depth4_category_no",
        )
    )


@query
def mall_category_interest_depth1(spark, d):
    stats = category.mall_depth1(_mall_category_days(spark, d))
    return present(category.interest_shares(stats, "member_no", ORDERS_AS_OF))


@query
def mall_category_interest_depth2(spark, d):
    stats = category.mall_depth2(_mall_category_days(spark, d))
    return present(category.interest_shares(stats, "member_no", ORDERS_AS_OF))


@query
def mall_category_power(spark, d):
    return present(category.category_power_mall(_src(spark, d), ORDERS_START, ORDERS_AS_OF))


# --- survival ------------------------------------------------------------------------


def _days(spark, d):
    return survival.affiliate_days(_src(spark, d), ORDERS_START, ORDERS_AS_OF, PARTNER_CHURN_START)


def _analysis(spark, d):
    return survival.SurvivalAnalysis(_days(spark, d), ORDERS_AS_OF)


def _mall_analysis(spark, d):
    days = survival.mall_days(_src(spark, d), ORDERS_START, ORDERS_AS_OF)
    return survival.SurvivalAnalysis(days, ORDERS_AS_OF, grouped=True)


@query
def purchase_ranks(spark, d):
    return present(survival.purchase_ranks(_days(spark, d)))


@query
def purchase_intervals(spark, d):
    return present(survival.purchase_intervals(_days(spark, d)))


@query
def cycle_stats(spark, d):
    return present(survival.cycle_stats(survival.purchase_intervals(_days(spark, d))))


@query
def cycle_stats_latest(spark, d):
    return present(survival.cycle_stats(survival.purchase_intervals(_days(spark, d), latest=True), latest=True))


@query
def survival_base(spark, d):
    return present(survival.survival_base(_days(spark, d), ORDERS_AS_OF))


@query
def survival_base_grouped(spark, d):
    return present(
        survival.survival_base(survival.mall_days(_src(spark, d), ORDERS_START, ORDERS_AS_OF), ORDERS_AS_OF, grouped=True)
    )


@query
def first_time_buyers(spark, d):
    return present(survival.first_time_buyers(_days(spark, d), ORDERS_AS_OF))


@query
def term_stats(spark, d):
    return present(survival.term_stats(_analysis(spark, d).base))


@query
def term_median_mad(spark, d):
    return present(survival.term_median_mad(_analysis(spark, d).base))


GAP_RANGE = ("2000-01-01", "2000-12-31")


@query
def term_median_approx(spark, d):
    """Quantiles of the gaps that ended in a year, from sketches stored by day, and whether their true ranks keep the bound."""
    gaps = cut(survival.purchase_intervals(_days(spark, d)))
    stored = FactTable(spark, new_path(spark, "sketches"), "next_order_date", "month")
    stored.write(survival.gap_sketches(gaps))
    probs = [0.25, 0.5, 0.9]
    found = cut(survival.merged_quantiles(stored.read(*GAP_RANGE), probs))
    gap, at = F.col("days_between_orders"), F.col("quantiles")
    inside = gaps.where(gap.isNotNull() & F.col("next_order_date").between(*map(sc.day, GAP_RANGE))).crossJoin(F.broadcast(found))
    ranks = inside.agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("counted"), *[F.count_if(c).alias(f"{side}{i}") for i in range(len(probs)) for side, c in (("below", gap < at[i]), ("upto", gap <= at[i]))])
    kept = F.lit(True)
    for i, p in enumerate(probs):
        error = survival.SKETCH_ERROR * F.col("counted")
        kept = kept & (F.col(f"below{i}") <= p * F.col("counted") + error) & (F.col(f"upto{i}") >= p * F.col("counted") - error)
    return present(ranks.select("n", "counted", kept.alias("within_bound")))


@query
def robust_zscore(spark, d):
    a = _analysis(spark, d)
    return present(
        survival.robust_zscore(a.base, a.pop).select("user_id", "current_trailing_term", "pop_mean", "modified_zscore")
    )


@query
def churn_flag(spark, d):
    return present(_analysis(spark, d).flagged.select("user_id", "current_trailing_term", "churn_flag"))


def _rates(a):
    # A mean of values with one decimal can lie halfway between two sixth decimals.
    return a.rates.withColumn("avg_group_term", sc.round_half_up(F.col("avg_group_term"), 6))


@query
def churn_rate(spark, d):
    return present(_rates(_analysis(spark, d)))


@query
def churn_rate_by_group(spark, d):
    return present(_rates(_mall_analysis(spark, d)))


@query
def survival_buckets(spark, d):
    return present(_analysis(spark, d).buckets)


@query
def survival_curve(spark, d):
    return present(_analysis(spark, d).curve)


@query
def survival_grid_interpolate(spark, d):
    return present(_mall_analysis(spark, d).buckets)


@query
def survival_curve_grouped(spark, d):
    return present(_mall_analysis(spark, d).curve)


def _individual(a, extra=()):
    return a.individual.select(
        "user_id", *extra, "days_since_last_purchase", "current_trailing_term", "churn_flag", "modified_zscore",
        "avg_churn_rate", "avg_group_term", "survival_prob",
    )


@query
def survival_individual(spark, d):
    return present(_individual(_analysis(spark, d)))


@query
def survival_individual_grouped(spark, d):
    return present(_individual(_mall_analysis(spark, d), ("age_group", "gender")))


@query
def survival_table(spark, d):
    return present(_analysis(spark, d).table)


@query
def survival_table_grouped(spark, d):
    return present(_mall_analysis(spark, d).table)


# --- merged profile and scores ----------------------------------------------------


@query
def user_profile_fill(spark, d):
    m = _snapshot(spark, d).merged("affiliate")
    return present(
        m.select(
            "user_id", "platform", "join_dt", "cum_lifetime", "gender", "birth_year", "terms_agree_yn",
            "total_accumulate_cash", "total_accumulate_shoji", "current_cash", "current_shoji",
            "last_purchase_shop", "last_purchase_byshop", "ranking_1_1_sp", "ranking_2_6_sp", "power_2_6_sp",
            "ranking_1_1_bs", "ranking_2_6_bs", "power_2_6_bs",
        )
    )


@query
def merged_affiliate(spark, d):
    return present(_snapshot(spark, d).merged("affiliate"), places=4)


@query
def merged_mall(spark, d):
    return present(_snapshot(spark, d).merged("mall"), places=4)


def _score(name: str) -> Query:
    def run(spark, d):
        users = _snapshot(spark, d).merged("affiliate").where(F.col("f_byshop") > 0)
        return present(scoring.add_scores(users, "byshop", [name]).select("user_id", name))

    return run


for _key, _name in {
    "score_recency": "r_score",
    "score_frequency": "f_score",
    "score_monetary": "m_score",
    "score_term": "term_score",
    "score_term_diff": "term_diff_score",
    "score_volatility": "volatility_score",
}.items():
    QUERIES[_key] = _score(_name)


@query
def rfm_scores(spark, d):
    scored = _snapshot(spark, d).scored("affiliate")
    return present(scored, places=4)


@query
def rfm_scores_mall(spark, d):
    return present(_snapshot(spark, d).scored("mall"), places=4)


@query
def grade_cuts(spark, d):
    users = _snapshot(spark, d).scored("affiliate").select("total_score")
    return present(scoring.score_cuts(users))


@query
def grade_assign(spark, d):
    records = _mall_records(spark, d)
    return present(scoring.grade_by_quantiles(records.select("user_id", "total_score"), "total_score"))


@query
def grade_fixed(spark, d):
    records = _mall_records(spark, d)
    return present(scoring.grade_by_thresholds(records.select("user_id", "total_score")))


# --- history -------------------------------------------------------------------------


def _scored(spark, d, track: str, *dates: str) -> dict[str, DataFrame]:
    """A channel's scored rows of some dates, whose chains run side by side."""
    snaps = _snapshots(spark, d, *sorted(set(dates)))
    return {str(snap.window.as_of): rows for snap, rows in zip(snaps, scored_side_by_side(snaps, track), strict=True)}


def _history(spark, d, track: str, *dates: str) -> DataFrame:
    """A channel's history built up over the given dates."""
    scored = _scored(spark, d, track, *dates)
    out = spark.createDataFrame([], history_schema(track))
    for as_of in dates:
        out = history.upsert_history(out, scored[as_of], track)
    return out


def _mall_records(spark, d) -> DataFrame:
    """The latest records read back out of the history, stored because studies read them often."""
    return _snapshot(spark, d).stage(
        "records_mall", lambda: history.history_at(_history(spark, d, "mall", ORDERS_AS_OF), ORDERS_AS_OF)
    )


@query
def history_pack(spark, d):
    packed = history.pack_snapshot(_snapshot(spark, d).scored("mall"), "mall")
    return present(packed.select("user_id", "gender", "age_group", "join_group", "first_order_dt", "score.*"), places=4)


@query
def history_pack_affiliate(spark, d):
    packed = history.pack_snapshot(_snapshot(spark, d).scored("affiliate"), "affiliate")
    return present(packed.select("user_id", "gender", "age_group", "join_group", "score.*"), places=4)


def _records_of(hist: DataFrame) -> DataFrame:
    """One row per user and record of the array form."""
    return hist.select(
        "user_id",
        "age_group",
        F.size("score_history").alias("records"),
        F.size("category_history").alias("category_records"),
        F.inline("score_history"),
    ).select("user_id", "age_group", "records", "category_records", "snapshot_dt", "total_score", "grade", "r_data", "f_data", "m_data")


@query
def history_upsert(spark, d):
    return present(_records_of(_history(spark, d, "mall", EARLIER, ORDERS_AS_OF, ORDERS_AS_OF)))


@query
def history_upsert_bucketed(spark, d):
    """The history in buckets: two dates, and the later one again for one user in a hundred, which touches few buckets."""
    table = BucketedTable(spark, new_path(spark, "history"), history_schema("mall"), "user_id", 256)
    table.create()
    scored = _scored(spark, d, "mall", EARLIER, ORDERS_AS_OF)
    some = cut(scored[ORDERS_AS_OF].where(F.crc32(F.col("user_id").cast("binary")) % 100 == 0))
    for snap in (scored[EARLIER], scored[ORDERS_AS_OF], some):
        history.upsert_bucketed(table, snap, "mall", keep=2)
    return present(_records_of(table.read()))


@query
def history_upsert_affiliate(spark, d):
    """With the earlier date run again at the end."""
    return present(_records_of(_history(spark, d, "affiliate", EARLIER, ORDERS_AS_OF, EARLIER)))


@query
def series_history(spark, d):
    """Stored sources, the day loop over two dates and both channels, and the assembled histories."""
    base = new_path(spark, "series")
    star = StarSchema(spark, d, f"{base}/all")
    with ThreadPoolExecutor(4) as pool:
        for done in [pool.submit(readers.write_stage, getattr(star, f.name), f"{base}/sources", f.name) for f in fields(Sources)]:
            done.result()
    last = date.fromisoformat(ORDERS_AS_OF)
    run_series(
        readers.read_sources(spark, f"{base}/sources"), date.fromisoformat(ORDERS_START), last - timedelta(days=1), last,
        f"{base}/history", f"{base}/stages", partner_churn_start=PARTNER_CHURN_START,
    )
    parts = [
        _records_of(history.assemble_history(history.read_snapshots(spark, f"{base}/history/{track}"), track)).withColumn("track", F.lit(track))
        for track in TRACKS
    ]
    return present(parts[0].unionByName(parts[1]))


@query
def history_at(spark, d):
    hist = _history(spark, d, "mall", EARLIER, ORDERS_AS_OF)
    return present(history.history_at(hist, EARLIER), places=4)


@query
def history_categories_at(spark, d):
    hist = _history(spark, d, "mall", EARLIER, ORDERS_AS_OF)
    return present(history.history_at(hist, ORDERS_AS_OF, "category_history").drop("age_group", "join_group"), places=4)


@query
def history_long_cycle(spark, d):
    records = history.history_at(_history(spark, d, "mall", ORDERS_AS_OF), ORDERS_AS_OF)
    return present(
        records.where(F.col("cycle_length") == labels.CYCLE_LONGEST).select("user_id", "cycle_length", "r_score", "f_score", "m_score")
    )


# --- weight study ---------------------------------------------------------------------


def _study_rows(spark, d) -> DataFrame:
    return cut(study.preprocess_fill(_mall_records(spark, d)))


def _valued(spark, d) -> DataFrame:
    rows = study.train_test_split(_study_rows(spark, d))
    keep = ["user_id", "split", *labels.SCORE_NAMES, "f_data", "m_data", "current_trailing_term", "predicted_survival_time"]
    return cut(study.adjusted_ltv(rows.select(*keep), by="split"))


@query
def preprocess_fill(spark, d):
    cols = ["user_id", "current_trailing_term", "m_data", "predicted_survival_time", *labels.SCORE_NAMES]
    return present(study.preprocess_fill(_mall_records(spark, d)).select(*cols))


@query
def train_test_split(spark, d):
    members = StarSchema(spark, d).app_members
    return present(study.train_test_split(members).select("user_id", "split"))


@query
def adjusted_ltv(spark, d):
    return present(study.adjusted_ltv(_study_rows(spark, d)).select("user_id", "f_data", "m_data", "adjusted_ltv"), places=2)


@query
def weighted_score(spark, d):
    rows = _study_rows(spark, d)
    return present(rows.select("user_id", study.weighted_score(labels.STUDY_START_WEIGHTS).alias("score")))


@query
def score_ltv_corr(spark, d):
    valued = study.adjusted_ltv(_study_rows(spark, d))
    start = [F.lit(w) for w in labels.STUDY_START_WEIGHTS]
    return present(
        study.moments(valued).select(
            "n",
            study.score_corr(start).alias("correlation"),
            study.objective(start, importance=None).alias("objective_plain"),
            study.objective(start).alias("objective_importance"),
        )
    )


def _found(valued: DataFrame) -> DataFrame:
    return study.weight_search(study.moments(valued.where(F.col("split") == "train")))


@query
def weight_search(spark, d):
    return present(_found(_valued(spark, d)))


@query
def weight_search_starts(spark, d):
    train = _valued(spark, d).where(F.col("split") == "train")
    return present(study.gradient_search(study.moments(train)), 4, objective=6)


@query
def weight_compare(spark, d):
    valued = _valued(spark, d)
    return present(study.weight_compare(study.moments(valued, "split"), _found(valued)))


@query
def bootstrap_corr(spark, d):
    valued = _valued(spark, d)
    return present(study.bootstrap_corr(valued.where(F.col("split") == "test"), _found(valued)))


# --- segments ---------------------------------------------------------------------------


def _funnel(spark, d) -> DataFrame:
    src = _src(spark, d)
    steps = [
        segments.funnel_step(src.app_events, "2024-01-05", "click", action_prefix='{"k": 1'),
        segments.funnel_step(src.app_events, "2024-01-10", "purchase"),
        segments.funnel_step(src.app_events, "2024-01-20", "view", event_labels=["", "popup"]),
        segments.funnel_step(src.app_events, "2024-01-01", "signup"),
    ]
    return segments.campaign_funnel(src.app_members, steps[:1] + steps[3:]).withColumn("funnel", F.lit("coupon")).unionByName(
        segments.campaign_funnel(src.app_members, steps[1:3]).withColumn("funnel", F.lit("exchange"))
    )


@query
def campaign_funnel(spark, d):
    return present(_funnel(spark, d))


@query
def cash_band_profile(spark, d):
    return present(segments.cash_band_profile(StarSchema(spark, d).app_members))


@query
def balance_summary(spark, d):
    return present(segments.balance_summary(StarSchema(spark, d).app_members))


@query
def grade_profile(spark, d):
    return present(segments.group_profile(_mall_records(spark, d), "grade"))


@query
def cycle_profile(spark, d):
    means = ("predicted_survival_time", "r_score", "f_score", "m_score")
    return present(segments.group_profile(_mall_records(spark, d), "cycle_length", means, ()))


@query
def grade_counts(spark, d):
    return present(segments.grade_counts(_mall_records(spark, d)))


@query
def score_histogram(spark, d):
    return present(segments.score_histogram(_mall_records(spark, d), below=1_500_000))


@query
def score_density(spark, d):
    """The curves behind the density charts: recency, frequency, money and money a purchase, by grade."""
    out = segments.density(_mall_records(spark, d), "grade", ["r_data", "f_data", "m_data", "ar_data"])
    return present(out, places=3, density=12)


def _two_periods(spark, d):
    """Affiliate RFM of two dates from one roll-up, scored against the earlier one's quintiles."""
    src = _src(spark, d)

    def build() -> DataFrame:
        members = src.app_members.select("user_id")
        changes = revenue.purchase_changes(src, ORDERS_START, ORDERS_AS_OF).join(members, "user_id", "left_semi")
        return segments.rfm_series(changes, EARLIER, ORDERS_AS_OF, every=False)

    both = _snapshot(spark, d).stage("two_periods", build)
    past, now = (both.where(F.col("snapshot_dt") == sc.day(on)).drop("snapshot_dt") for on in (EARLIER, ORDERS_AS_OF))
    cuts = cut(segments.past_quantiles(past))
    return past, segments.period_scores(past, cuts), segments.period_scores(now, cuts), cuts


@query
def past_quantiles(spark, d):
    _, _, _, cuts = _two_periods(spark, d)
    names = ("recency", "frequency", "monetary")
    return present(
        cuts.select(F.explode(F.sequence(F.lit(0), F.lit(3))).alias("i"), *names).select(
            ((F.col("i") + 1) * 20).alias("percent"), *[F.get(n, F.col("i")).alias(n) for n in names]
        ),
        places=4,
    )


@query
def period_scores(spark, d):
    _, past, now, _ = _two_periods(spark, d)
    return present(
        past.withColumn("period", F.lit("past")).unionByName(now.withColumn("period", F.lit("current"))), places=4
    )


@query
def vip_movement(spark, d):
    _, past, now, _ = _two_periods(spark, d)
    return present(segments.vip_movement(past, now))


@query
def vip_new(spark, d):
    _, past, now, _ = _two_periods(spark, d)
    return present(segments.vip_new(past, now), places=4)


@query
def vip_churned(spark, d):
    _, past, now, _ = _two_periods(spark, d)
    return present(segments.vip_new(now, past), places=4)


@query
def snapshot_series(spark, d):
    first, last = SERIES
    src = _src(spark, d)
    members = src.app_members.select("user_id")
    changes = revenue.purchase_changes(src, ORDERS_START, last)
    return present(segments.rfm_series(changes.join(members, "user_id", "left_semi"), first, last), places=4)


@query
def chain_series(spark, d):
    """RFM, categories and cycles of both channels on each of five dates, from a state that is advanced day by day."""
    place = new_path(spark, "chain")
    src = StarSchema(spark, d, f"{place}/sources")
    states = ChainStore(spark, place, ORDERS_START, PARTNER_CHURN_START)
    for on in CHAIN_DATES:
        states.advance(src, on)
    snaps = states.snapshots(src, CHAIN_DATES)
    with ThreadPoolExecutor(len(snaps)) as pool:
        parts = list(pool.map(lambda snap: [chain_rows(snap, track) for track in TRACKS], snaps))
    return present(reduce(DataFrame.unionByName, [rows for part in parts for rows in part]), monetary=4)
