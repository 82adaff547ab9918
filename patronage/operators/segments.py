"""Segments: grade profiles, balance bands, campaign funnel, period scores, VIP movement."""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from patronage.functions import labels
from patronage.functions.order_stats import percentiles
from patronage.functions.scalars import day, safe_divide, safe_double

_PROFILE_MEANS = (
    "total_score", "cut1", "cut2", "cut3", "r_data", "f_data", "term_score", "term_diff_score",
    "volatility_score", "refund_rate", "survival_prob", "predicted_survival_time",
    "total_accumulate_cash", "total_accumulate_shoji", "current_cash", "current_shoji",
)
_PROFILE_MEDIANS = ("m_data", "ar_data")
_QUINTILES = [0.2, 0.4, 0.6, 0.8]


def group_profile(
    records: DataFrame, by: str, means=_PROFILE_MEANS, medians=_PROFILE_MEDIANS, id_col: str = "user_id"
) -> DataFrame:
    """Means, exact medians and size per group (grade, cycle class, ...)."""
    out = records.groupBy(by).agg(*[F.avg(c).alias(f"{c}_mean") for c in means], F.count(F.lit(1)).alias("n"))
    if medians:
        mid = percentiles(records, {c: F.col(c) for c in medians}, [0.5], id_col, by)
        mid = mid.select(F.col(by).alias("_by"), *[F.col(c)[0].alias(f"{c}_median") for c in medians])
        out = out.join(mid, F.col(by).eqNullSafe(F.col("_by")), "left").drop("_by")
    return out


def grade_counts(records: DataFrame, by: str = "grade") -> DataFrame:
    return records.groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def score_histogram(records: DataFrame, below: float = 100000, width: int = 1) -> DataFrame:
    """Users per grade and frequency bin, among those with money below `below`."""
    return (
        records.where(F.col("m_data") < below)
        .groupBy("grade", (F.floor(F.col("f_data") / width) * width).alias("f_bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def density(records: DataFrame, by: str, measures: list[str], points: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density of each measure per group, on `points` points; groups are normalised apart.

    The bandwidth is Scott's, n**(-1/5) standard deviations, and the points reach `cut`
    bandwidths past the least and greatest value.  A value is dealt to its two neighbouring
    points in proportion to its nearness (linear binning), so the rows are read twice, for
    moments and for weights, and the kernel runs over points x points a group.  Groups of one
    value alone have no density.
    """
    values = records.select(
        F.col(by).alias("_by"), F.inline(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures]))
    ).where("value IS NOT NULL")
    moments = values.groupBy("_by", "measure").agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp("value").alias("spread"), F.min("value").alias("least"), F.max("value").alias("most")
    )
    width = F.col("spread") * F.pow(F.col("n"), F.lit(-0.2))
    # One row per group and measure.
    grids = moments.where("spread > 0").select(
        F.col("_by").alias("_grp"), F.col("measure").alias("_measure"), "n", width.alias("width"), (F.col("least") - cut * width).alias("first"),
        ((F.col("most") - F.col("least") + 2 * cut * width) / (points - 1)).alias("step"),
    )
    same = F.col("_by").eqNullSafe(F.col("_grp")) & (F.col("measure") == F.col("_measure"))
    at = (F.col("value") - F.col("first")) / F.col("step")
    low = F.floor(at)
    ends = F.array(F.struct(low.alias("bin"), (1 - (at - low)).alias("weight")), F.struct((low + 1).alias("bin"), (at - low).alias("weight")))
    weights = values.join(F.broadcast(grids), same).select("_by", "measure", F.inline(ends)).groupBy("_by", "measure", "bin").agg(F.sum("weight").alias("weight"))
    points_ = F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    away = (F.col("point") - F.col("bin")) * F.col("step") / F.col("width")
    return (
        weights.join(F.broadcast(grids), same)
        .withColumn("point", points_)
        .groupBy("_by", "measure", "point", "first", "step")
        .agg((F.sum(F.col("weight") * F.exp(-away * away / 2)) / (F.first("n") * F.first("width") * math.sqrt(2 * math.pi))).alias("density"))
        .select(F.col("_by").alias(by), "measure", "point", (F.col("first") + F.col("point") * F.col("step")).alias("x"), "density")
    )


# --- campaign funnel and balances ---------------------------------------------


def funnel_step(
    events: DataFrame,
    since: date | str,
    category: str,
    action_prefix: str | None = None,
    event_labels: list[str] | None = None,
) -> DataFrame:
    """Distinct users with such an event that carries at least one detail."""
    hit = events.where((F.col("event_dt") >= day(since)) & (F.col("event_category") == category))
    if action_prefix is not None:
        hit = hit.where(F.col("event_action").startswith(action_prefix))
    if event_labels is not None:
        hit = hit.where(F.col("event_label").isin(*event_labels))
    # Unnesting the details and taking distinct users keeps those with a detail.
    return hit.where(F.size("event_detail") > 0).select("user_id").distinct()


def campaign_funnel(members: DataFrame, steps: list[DataFrame]) -> DataFrame:
    """Members who took any of the steps, with their balance."""
    reached = steps[0]
    for step in steps[1:]:
        reached = reached.unionByName(step)
    return members.join(reached.distinct(), "user_id", "left_semi").select("user_id", "current_cash")


def cash_band(value: Column, bands=labels.CASH_BANDS) -> Column:
    """Band label, upper bounds included; 0 and less fall in no band."""
    out = None
    for low, high, label in bands:
        inside = value > low if high is None else (value > low) & (value <= high)
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def cash_band_profile(members: DataFrame) -> DataFrame:
    """Users and balance per band, bands without users included."""
    cash = safe_double(F.col("current_cash").cast("string"))
    found = (
        members.select(cash_band(cash).alias("band"), cash.alias("cash"))
        .where(F.col("band").isNotNull())
        .groupBy("band")
        .agg(F.count(F.lit(1)).alias("users"), F.sum("cash").alias("total_cash"))
    )
    bands = members.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(label) for _, _, label in labels.CASH_BANDS])).alias("band")
    )
    return bands.join(found, "band", "left").select(
        "band", F.coalesce("users", F.lit(0)).alias("users"), F.coalesce("total_cash", F.lit(0.0)).alias("total_cash")
    )


def balance_summary(members: DataFrame) -> DataFrame:
    """Sum, greatest, unreadable, positive count and mean over the positive balances; one row."""
    cash = safe_double(F.col("current_cash").cast("string"))
    total = F.sum(cash)
    positive = F.count_if(cash > 0)
    return members.agg(
        total.alias("total_cash"),
        F.max(cash).alias("max_cash"),
        F.count_if(cash.isNull()).alias("missing"),
        positive.alias("positive_users"),
        safe_divide(total, positive).alias("cash_per_positive_user"),
    )


# --- two periods ---------------------------------------------------------------


def past_quantiles(past: DataFrame, id_col: str = "user_id") -> DataFrame:
    """Quintile cuts of recency, frequency and monetary; one row of arrays."""
    return percentiles(past, {c: F.col(c) for c in ("recency", "frequency", "monetary")}, _QUINTILES, id_col)


def period_scores(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Scores 1-5 against given quintiles: recency loses, the others gain one per cut exceeded."""

    def passed(c: str) -> Column:
        return sum([F.when(F.col(c) > F.col(f"_cuts.{c}")[i], 1).otherwise(0) for i in range(1, 4)],
                   F.when(F.col(c) > F.col(f"_cuts.{c}")[0], 1).otherwise(0))

    boxed = cuts.select(F.struct("recency", "frequency", "monetary").alias("_cuts"))
    return (
        rows.crossJoin(F.broadcast(boxed))
        .withColumns(
            {
                "r_score": 5 - passed("recency"),
                "f_score": 1 + passed("frequency"),
                "m_score": 1 + passed("monetary"),
            }
        )
        .drop("_cuts")
    )


def vip_segment(scored: DataFrame) -> DataFrame:
    return scored.where((F.col("r_score") >= 4) & (F.col("f_score") >= 4) & (F.col("m_score") >= 4))


def vip_new(past: DataFrame, current: DataFrame) -> DataFrame:
    """VIPs of now who were none before; swap the arguments for those who are none any more."""
    return vip_segment(current).join(vip_segment(past).select("user_id"), "user_id", "left_anti")


def vip_movement(past: DataFrame, current: DataFrame) -> DataFrame:
    """VIP counts of both periods and the net change; one row."""
    both = vip_segment(past).select(F.lit(1).alias("p"), F.lit(0).alias("c")).unionByName(
        vip_segment(current).select(F.lit(0).alias("p"), F.lit(1).alias("c"))
    )
    past_n, now_n = F.coalesce(F.sum("p"), F.lit(0)), F.coalesce(F.sum("c"), F.lit(0))
    return both.agg(
        past_n.alias("past_vips"), now_n.alias("current_vips"), (now_n - past_n).alias("net_change")
    )


# --- dated series ----------------------------------------------------------------


def rfm_series(changes: DataFrame, first: date | str, last: date | str, every: bool = True) -> DataFrame:
    """RFM of every user on every date from `first` to `last` (or only on these two) in one plan, each as if run on that date.

    changes(user_id, at, amount, is_order) are those of `purchase_changes`: a refund
    counts from its own day on, never before.  Running totals are taken along each
    user's days, and each total is spread over the dates until the next change: the work
    grows with the result, not with the dates times the purchases.
    """
    upto = day(last)
    along = Window.partitionBy("user_id").orderBy("at")
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    days = changes.where(F.col("at") <= upto).groupBy("user_id", "at").agg(
        F.sum("amount").alias("amount"), F.max("is_order").cast("int").alias("bought")
    )
    states = days.select(
        "user_id",
        "at",
        F.sum("bought").over(so_far).alias("frequency"),
        # Amounts taken back leave no rest of a rounding.
        F.round(F.sum("amount").over(so_far), 6).alias("monetary"),
        F.max(F.when(F.col("bought") == 1, F.col("at"))).over(so_far).alias("last_dt"),
        F.lead("at").over(along).alias("next_at"),
    )
    begin = F.greatest(F.col("at"), day(first))
    end = F.coalesce(F.date_sub("next_at", 1), upto)
    dates = F.sequence(begin, end) if every else F.filter(F.array_distinct(F.array(day(first), upto)), lambda d: d.between(begin, end))
    return (
        states.where((begin <= end) & (F.col("monetary") > 0))
        .withColumn("snapshot_dt", F.explode(dates))
        .select(
            "user_id",
            "snapshot_dt",
            F.datediff("snapshot_dt", "last_dt").alias("recency"),
            "frequency",
            "monetary",
        )
    )
