"""Repurchase cycle, churn flag and survival probability per user.

Both channels share the steps; the mall adds gender strata with an interpolated
time grid and churn rates per age group and gender.  Users are reduced to one row
early on (`survival_base`); everything global is a one-row or per-week table that
is broadcast back to those rows.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window, functions as F

from patronage.functions import labels
from patronage.functions.scalars import (
    age_group,
    day,
    greatest_or_null,
    ladder,
    round_half_up,
    safe_divide,
)
from patronage.functions.stages import cut
from patronage.operators.revenue import purchase_names
from patronage.sources.schemas import Sources

FIRST_PURCHASES = 15
OUTLIER_LIMIT = 3.5
WEEK = 7
LEAST_STEP = 0.0001


# --- purchase days, ranks and gaps -----------------------------------------


def affiliate_days(
    src: Sources, start: date | str, as_of: date | str, partner_start: date | str | None = None, names: DataFrame | None = None
) -> DataFrame:
    """Distinct (user_id, order_dt) of the affiliate purchases; refunds do not matter here.

    `names` are the purchases of the window where they are stored already.
    """
    bought = purchase_names(src, start, as_of, partner_start) if names is None else names
    return bought.select("user_id", F.col("event_dt").alias("order_dt")).distinct()


def mall_days(src: Sources, start: date | str, as_of: date | str) -> DataFrame:
    """Distinct (member, day) with the member's user, gender and birth year.

    Members without a user id share the null user, which can be large.
    """
    days = src.mall_orders.where(F.col("order_dt").between(day(start), day(as_of))).select("member_no", "order_dt").distinct()
    people = src.mall_members.select("member_no", F.col("wk_id").alias("user_id"), "gender", "birth_year")
    return days.join(people, "member_no", "left")


def purchase_ranks(days: DataFrame) -> DataFrame:
    """Rank of each purchase day from the latest and from the first."""
    user = Window.partitionBy("user_id")
    return days.select(
        "user_id",
        "order_dt",
        F.row_number().over(user.orderBy(F.desc("order_dt"))).alias("recency_rank"),
        F.row_number().over(user.orderBy("order_dt")).alias("purchase_rank"),
    )


def purchase_intervals(days: DataFrame, first: int = FIRST_PURCHASES, latest: bool = False) -> DataFrame:
    """Gaps between the first (or, with `latest`, the last) `first` purchase days of each user.

    The rank limit is applied before the shuffle, so a user id with very many rows
    sends only `first` rows per task.  With `latest` the ranks count up to -1, the last day.
    """
    by_date = Window.partitionBy("user_id").orderBy("order_dt")
    if latest:
        back = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("order_dt")))
        early = days.select("user_id", "order_dt").withColumn("purchase_rank", back).where(F.col("purchase_rank") <= first)
        early = early.withColumn("purchase_rank", -F.col("purchase_rank"))
    else:
        early = days.select("user_id", "order_dt").withColumn("purchase_rank", F.row_number().over(by_date)).where(
            F.col("purchase_rank") <= first
        )
    following = F.lead("order_dt").over(by_date)
    return early.withColumns(
        {"next_order_date": following, "days_between_orders": F.datediff(following, F.col("order_dt"))}
    )


def cycle_stats(intervals: DataFrame, latest: bool = False) -> DataFrame:
    """Mean gap now and before, and the spread of the gaps, per user.

    "Now" is the mean of gaps 1-3, "before" that of gaps 2-4, counted from the
    first purchase; `latest` counts them from the last gap instead, and its spread is that
    of the gaps between the last FIRST_PURCHASES days (take `latest` intervals for it).
    """
    gap = F.col("days_between_orders")
    rank = F.col("purchase_rank")
    gaps = intervals.where(gap.isNotNull())
    if latest:
        back = Window.partitionBy("user_id").orderBy(F.desc("purchase_rank"))
        gaps = gaps.withColumn("purchase_rank", F.row_number().over(back))
    return (
        gaps.groupBy("user_id")
        .agg(
            round_half_up(F.avg(F.when(rank <= 3, gap)), 1).alias("current_trailing_term"),
            round_half_up(F.avg(F.when(rank.between(2, 4), gap)), 1).alias("prev_trailing_term"),
            F.stddev_samp(gap).alias("cycle_stddev"),
        )
        .where(F.col("current_trailing_term").isNotNull())
    )


def _latest(days: DataFrame, ref: Column, grouped: bool, first_time: bool = False) -> DataFrame:
    """Days since the last purchase (and the buyer's gender and age group), of all or of the first-time buyers."""
    row = ["order_dt"] + (["member_no", "gender", "birth_year"] if grouped else [])
    last = days.groupBy("user_id").agg(F.max(F.struct(*row)).alias("last"), F.count(F.lit(1)).alias("purchases"))
    if first_time:
        last = last.where((F.col("purchases") == 1) | F.col("user_id").isNull())
    cols = ["user_id", F.datediff(ref, F.col("last.order_dt")).alias("days_since_last_purchase")]
    if grouped:
        cols += [F.col("last.gender").alias("gender"), age_group(F.col("last.birth_year"), ref).alias("age_group")]
    return last.select(*cols)


def _known(value: Column) -> Column:
    """The null user meets no other row by its id, so what others look up is null there."""
    return F.when(F.col("user_id").isNotNull(), value)


def survival_base(days: DataFrame, as_of: date | str, grouped: bool = False, latest: bool = False) -> DataFrame:
    """One row per user with at least one gap.  The reference day is as_of + 1.

    The null user keeps its term, but nothing that is looked up by user id.
    """
    ref = F.date_add(day(as_of), 1)
    current, prev = F.col("current_trailing_term"), F.col("prev_trailing_term")
    return (
        cycle_stats(purchase_intervals(days, latest=latest), latest)
        .withColumns({c: _known(F.col(c)) for c in ("prev_trailing_term", "cycle_stddev")})
        .join(_latest(days, ref, grouped), "user_id", "left")
        .withColumns(
            {
                "cycle_change_rate": round_half_up(safe_divide(current - prev, prev) * 100, 1),
                "cycle_variation_rate": F.round(safe_divide(F.col("cycle_stddev"), current) * 100, 1),
            }
        )
    )


def first_time_buyers(days: DataFrame, as_of: date | str, grouped: bool = False) -> DataFrame:
    """Users without a second purchase (the null user always counts as one)."""
    ref = F.date_add(day(as_of), 1)
    return _latest(days, ref, grouped, first_time=True)


# --- population statistics ---------------------------------------------------


def _term() -> Column:
    return F.col("current_trailing_term")


def term_stats(base: DataFrame) -> DataFrame:
    """Mean and spread of the term and of its logarithm over the users; one row."""
    return base.where(_term() > 0).agg(
        F.stddev_samp(F.ln(_term())).alias("log_stddev"),
        F.avg(F.ln(_term())).alias("log_mean"),
        F.stddev_samp(_term()).alias("pop_stddev"),
        F.avg(_term()).alias("pop_mean"),
    )


def _lower_median(sql: str) -> Column:
    """Terms have one decimal and are bounded by the calendar, so the value counts
    this aggregate keeps stay small however many users there are."""
    return F.expr(f"percentile_disc(0.5) within group (order by {sql})")


def term_median_mad(base: DataFrame) -> DataFrame:
    """Lower median and median absolute deviation of the term and its logarithm; one row."""
    terms = base.where(_term() > 0).select("current_trailing_term")
    med = terms.agg(
        _lower_median("current_trailing_term").alias("median_term"),
        _lower_median("ln(current_trailing_term)").alias("log_median_term"),
    )
    return (
        terms.crossJoin(F.broadcast(med))
        .agg(
            F.max("median_term").alias("median_term"),
            F.max("log_median_term").alias("log_median_term"),
            _lower_median("abs(current_trailing_term - median_term)").alias("mad"),
            _lower_median("abs(ln(current_trailing_term) - log_median_term)").alias("log_mad"),
        )
    )


SKETCH_K = 400  # of the quantile sketches: ranks are off by less than SKETCH_ERROR with a probability of 99 %
SKETCH_ERROR = 0.01


def gap_sketches(intervals: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """(next_order_date, n, sketch): the gaps that end on a day as a quantile sketch, to be stored by day.

    Sketches of days merge, so quantiles of any range of dates need one small row a day.
    """
    ended = intervals.where("days_between_orders IS NOT NULL").groupBy("next_order_date")
    return ended.agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col("days_between_orders").cast("double"), k).alias("sketch"))


def merged_quantiles(sketches: DataFrame, probs: list[float], k: int = SKETCH_K) -> DataFrame:
    """Number of values and their approximate quantiles, from the sketches of a range of days; one row."""
    merged = sketches.agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch"))
    return merged.select("n", F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for p in probs]).alias("quantiles"))


def population(base: DataFrame) -> DataFrame:
    """term_stats and term_median_mad side by side; one row."""
    return term_stats(base).crossJoin(F.broadcast(term_median_mad(base)))


def robust_zscore(base: DataFrame, pop: DataFrame) -> DataFrame:
    """Users with the distance of their term's logarithm from the median, in MADs.

    Null for users whose term is 0 and for all when the MAD is 0.
    """
    z = safe_divide(0.6745 * (F.ln(_term()) - F.col("log_median_term")), F.col("log_mad"))
    return base.crossJoin(F.broadcast(pop.select("pop_mean", "log_median_term", "log_mad"))).withColumn(
        "modified_zscore", F.when(_term() > 0, z)
    )


def _outlier() -> Column:
    return F.abs("modified_zscore") > OUTLIER_LIMIT


def churn_flags(scored: DataFrame) -> DataFrame:
    """1 when the user is away for more than two terms (two mean terms for outliers)."""
    limit = F.when(_outlier(), F.col("pop_mean")).otherwise(_term()) * 2
    flag = F.when(F.col("days_since_last_purchase") > limit, 1).otherwise(0)
    return scored.withColumn("churn_flag", F.when(_term() > 0, flag))


def churn_rate(flagged: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Churn rate, mean term and size, over all users or per group."""
    counted = flagged.where(_term() > 0)
    return counted.groupBy(*(by or [])).agg(
        safe_divide(F.sum("churn_flag"), F.count(F.lit(1))).alias("avg_churn_rate"),
        F.avg(_term()).alias("avg_group_term"),
        F.count(F.lit(1)).alias("group_user_count"),
    )


# --- survival curve ----------------------------------------------------------


def _week(days: Column) -> Column:
    return (F.floor(days / WEEK) * WEEK).cast("bigint")


def survival_buckets(flagged: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Users and churned users per week since the last purchase."""
    return flagged.groupBy(_week(F.col("days_since_last_purchase")).alias("time_point"), *(by or [])).agg(
        F.count(F.lit(1)).alias("n_risk"),
        F.sum(_known(F.col("churn_flag"))).alias("n_events"),
    )


def interpolate_grid(buckets: DataFrame) -> DataFrame:
    """Every week from 0 to the last, per gender; a missing week takes the mean of its
    neighbours, or null when one of them is missing too.  Null genders are left out.

    All inputs are week tables, bounded by the calendar.
    """
    last = buckets.agg(F.max("time_point").alias("last"))
    weeks = last.select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last"), F.lit(WEEK).cast("bigint"))).alias("time_point"))
    genders = buckets.where(F.col("gender").isNotNull()).select("gender").distinct()
    grid = genders.crossJoin(F.broadcast(weeks))
    around = Window.partitionBy("gender").orderBy("time_point")

    def filled(name: str) -> Column:
        c = F.col(name)
        return F.coalesce(c.cast("double"), (F.lag(c).over(around) + F.lead(c).over(around)) / 2).alias(name)

    return grid.join(buckets, ["time_point", "gender"], "left").select(
        "time_point", "gender", filled("n_risk"), filled("n_events")
    )


def survival_curve(buckets: DataFrame, rates: DataFrame, by: str | None = None) -> DataFrame:
    """Weekly, churn-weighted and running survival probability.

    rates(avg_churn_rate[, by]).  The running product is a sum of logarithms over
    the week table, with each factor held at or above 0.0001.
    """
    rate = rates.select("avg_churn_rate") if by is None else rates.groupBy(by).agg(F.avg("avg_churn_rate").alias("avg_churn_rate"))
    rated = buckets.crossJoin(F.broadcast(rate)) if by is None else buckets.join(rate, by, "left")
    at_risk = F.col("n_risk") > 0
    step = 1 - safe_divide(F.col("n_events"), F.col("n_risk"))
    base = F.when(at_risk, step).otherwise(1.0)
    weighted = F.when(at_risk, step * (1 - F.coalesce(F.col("avg_churn_rate"), F.lit(0.0)))).otherwise(1.0)
    run = Window.partitionBy(*([by] if by else [])).orderBy("time_point")
    running = F.exp(F.sum(F.ln(greatest_or_null(base, F.lit(LEAST_STEP)))).over(run))
    return rated.select(
        "time_point",
        *([by] if by else []),
        "n_risk",
        "n_events",
        round_half_up(base, 4).alias("base_survival_prob"),
        round_half_up(weighted, 4).alias("weighted_survival_prob"),
        round_half_up(running, 4).alias("cumulative_survival_prob"),
    )


# --- users ---------------------------------------------------------------------


def _with_curve(users: DataFrame, curve: DataFrame, by: str | None) -> DataFrame:
    """Attach the user's week of the curve and the least probability of the curve."""
    keys = ["time_point"] + ([by] if by else [])
    point = curve.select(*keys, "cumulative_survival_prob")
    least_rows = curve if by is None else curve.groupBy(by)
    least = least_rows.agg(F.min("cumulative_survival_prob").alias("least_survival_prob"))
    out = users.withColumn("time_point", _week(F.col("days_since_last_purchase"))).join(point, keys, "left")
    out = out.crossJoin(F.broadcast(least)) if by is None else out.join(least, by, "left")
    return out.drop("time_point")


def _survival_prob(term: Column, by: str | None) -> Column:
    """0.7 x decay over the term + 0.3 x curve; users outside every stratum decay only."""
    decay = F.exp(safe_divide(-F.col("days_since_last_purchase"), term))
    mixed = 0.7 * decay + 0.3 * F.coalesce("cumulative_survival_prob", "least_survival_prob")
    return mixed if by is None else F.when(F.col(by).isNull(), decay).otherwise(mixed)


def survival_individual(flagged: DataFrame, curve: DataFrame, rates: DataFrame, by: str | None = None) -> DataFrame:
    """Survival probability per repeat buyer."""
    out = _with_curve(flagged, curve, by)
    rate = rates.select(*(["age_group", "gender"] if by else []), "avg_churn_rate", "avg_group_term")
    # Null groups meet no rate: plain equality.
    out = out.join(rate, ["age_group", "gender"], "left") if by else out.crossJoin(F.broadcast(rate))
    term = F.when(_outlier(), F.col("pop_mean")).otherwise(_term())
    # Only users with a positive term and an id have statistics of their own.
    own = (_term() > 0) & F.col("user_id").isNotNull()
    return out.withColumns(
        {
            "survival_prob": F.when(own, _survival_prob(term, by)),
            "modified_zscore": F.when(own, F.col("modified_zscore")),
            "churn_flag": F.when(own, F.col("churn_flag")),
        }
    )


def _table_columns(by: str | None) -> list[str]:
    return (
        ["user_id", "days_since_last_purchase"]
        + (["age_group", "gender"] if by else [])
        + [
            "current_trailing_term", "prev_trailing_term", "cycle_stddev", "modified_zscore",
            "demographic_churn_rate", "churn_flag", "survival_prob", "predicted_survival_time",
            "cycle_length", "risk_level", "cur",
        ]
    )


def repeat_buyers(individual: DataFrame, as_of: date | str, by: str | None = None) -> DataFrame:
    term = F.when(_outlier(), F.col("pop_mean")).otherwise(_term())
    left = F.round(-term * F.ln(F.lit(0.5)) - F.col("days_since_last_purchase"))
    return individual.select(
        *[
            {
                "cycle_stddev": F.round("cycle_stddev"),
                "demographic_churn_rate": F.col("avg_churn_rate"),
                "survival_prob": round_half_up(F.col("survival_prob"), 2),
                "predicted_survival_time": greatest_or_null(left, F.lit(0.0)),
                "cycle_length": ladder(_term(), labels.CYCLE_CLASSES, labels.CYCLE_LONGEST),
                "risk_level": ladder(F.col("survival_prob"), labels.RISK_CLASSES, labels.RISK_NONE),
                "cur": F.date_add(day(as_of), 1),
            }.get(c, F.col(c)).alias(c)
            for c in _table_columns(by)
        ]
    )


def new_buyers(buyers: DataFrame, pop: DataFrame, curve: DataFrame, as_of: date | str, by: str | None = None) -> DataFrame:
    """First-time buyers, with the population's term in place of their own."""
    out = _with_curve(buyers, curve, by).crossJoin(F.broadcast(pop.select("pop_mean")))
    out = out.withColumn("survival_prob", _survival_prob(F.col("pop_mean"), by))
    left = -F.col("pop_mean") * F.ln(F.lit(0.5)) - F.col("days_since_last_purchase")
    none = F.lit(None).cast("double")
    return out.select(
        *[
            {
                "current_trailing_term": none,
                "prev_trailing_term": none,
                "cycle_stddev": none,
                "modified_zscore": none,
                "demographic_churn_rate": none,
                "churn_flag": F.lit(None).cast("int"),
                "predicted_survival_time": greatest_or_null(left, F.lit(0.0)),
                "cycle_length": F.lit(labels.CYCLE_NEW),
                "risk_level": ladder(F.col("survival_prob"), labels.RISK_CLASSES, labels.RISK_NONE),
                "cur": F.date_add(day(as_of), 1),
            }.get(c, F.col(c)).alias(c)
            for c in _table_columns(by)
        ]
    )


class SurvivalAnalysis:
    """The steps of one channel over its purchase days, each a DataFrame.

    The days, the per-user base, the population row, the rates and the curve are read by
    several later steps and therefore cut; days that are `stored` already are read from there.
    """

    def __init__(self, days: DataFrame, as_of: date | str, grouped: bool = False, latest: bool = False, stored: bool = False):
        self._days, self.as_of, self.latest, self._stored = days, as_of, latest, stored
        self.by = "gender" if grouped else None

    @cached_property
    def days(self) -> DataFrame:
        return self._days if self._stored else cut(self._days)

    @cached_property
    def base(self) -> DataFrame:
        return cut(survival_base(self.days, self.as_of, self.by is not None, self.latest))

    @cached_property
    def pop(self) -> DataFrame:
        return cut(population(self.base))

    @cached_property
    def flagged(self) -> DataFrame:
        return churn_flags(robust_zscore(self.base, self.pop))

    @cached_property
    def rates(self) -> DataFrame:
        # Stored, so that its true size is known and no user row is shuffled to meet it.
        return cut(churn_rate(self.flagged, ["age_group", "gender"] if self.by else None))

    @cached_property
    def buckets(self) -> DataFrame:
        weeks = survival_buckets(self.flagged, [self.by] if self.by else None)
        return interpolate_grid(weeks) if self.by else weeks

    @cached_property
    def curve(self) -> DataFrame:
        return cut(survival_curve(self.buckets, self.rates, self.by))

    @property
    def individual(self) -> DataFrame:
        return survival_individual(self.flagged, self.curve, self.rates, self.by)

    @property
    def first_timers(self) -> DataFrame:
        return first_time_buyers(self.days, self.as_of, self.by is not None)

    @property
    def table(self) -> DataFrame:
        """Repeat and first-time buyers."""
        return new_buyers(self.first_timers, self.pop, self.curve, self.as_of, self.by).unionByName(
            repeat_buyers(self.individual, self.as_of, self.by)
        )
