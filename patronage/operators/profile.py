"""One wide row per user: both channels, the offer wall, balances, survival, categories."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from patronage.functions import labels
from patronage.functions.scalars import day, round_to_long
from patronage.sources.schemas import RANKING_COLUMNS, Sources

# Survival column -> column of the merged row, before the channel suffix.
_SURVIVAL_NAMES = {
    "days_since_last_purchase": "last_purchase",
    "current_trailing_term": "current_trailing_term",
    "prev_trailing_term": "prev_trailing_term",
    "cycle_stddev": "cycle_stddev",
    "survival_prob": "suvival_prob",  # spelled so in the table this one replaces
    "predicted_survival_time": "predicted_survival_time",
    "risk_level": "risk_level",
    "cycle_length": "cycle_length",
}
_FILLED = ["platform", "join_dt", "cum_lifetime", "gender", "birth_year", "total_accumulate_cash"]


def reward_balance(ledger: DataFrame, members: DataFrame, as_of: date | str) -> DataFrame:
    """Credits and credits less debits per user, up to `as_of`.

    The default 0 is for the whole difference: credits without any debit give 0.
    """
    status, amt = F.col("accumulation_status"), F.col("amt")
    per_member = (
        ledger.where(F.to_date("register_dttm") <= day(as_of))
        .groupBy("member_no")
        .agg(
            F.sum(F.when(status.isin(*labels.LEDGER_CREDITS), amt)).alias("credits"),
            F.sum(F.when(status.isin(*labels.LEDGER_DEBITS), amt)).alias("debits"),
        )
    )
    people = members.select("member_no", F.col("wk_id").alias("user_id"))
    return (
        per_member.join(people, "member_no", "left")
        .groupBy("user_id")
        .agg(
            F.sum("credits").alias("accumulate_shoji"),
            F.coalesce(F.sum("credits") - F.sum("debits"), F.lit(0)).alias("current_shoji"),
        )
    )


def channel_rfm(rfm: DataFrame, channel: str) -> DataFrame:
    """RFM of a channel squashed to one row per user (a user may own several members).

    Besides the extremes it keeps whether an attribute was missing in some row, so
    that filling it afterwards gives what filling each row first would give.
    """
    have = [c for c in _FILLED if c in rfm.columns]
    extra = [c for c in ("first_order_dt", "refund_rate") if c in rfm.columns]
    aggs = [f"max({c}) as {c}_{channel}" for c in have]
    aggs += [f"bool_or({c} is null) as {c}_{channel}_missing" for c in have]
    aggs += [f"max({c}) as {c}" for c in extra]
    aggs += [f"min(recency) as recency_{channel}"]
    aggs += [f"max({c}) as {c}_{channel}" for c in ("frequency", "monetary")]
    return rfm.groupBy("user_id").agg(*map(F.expr, aggs))


def _one_row_per_user(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(*[F.expr(f"max({c}) as {c}") for c in cols])


def _survival_side(table: DataFrame, suffix: str) -> DataFrame:
    return table.where("user_id is not null").selectExpr(
        "user_id", *[f"{c} as {out}_{suffix}" for c, out in _SURVIVAL_NAMES.items()]
    )


def _category_side(power: DataFrame, suffix: str) -> DataFrame:
    side = _one_row_per_user(power, RANKING_COLUMNS)
    return side.selectExpr("user_id", *[f"{c} as {c}_{suffix}" for c in RANKING_COLUMNS])


def member_profile(src: Sources) -> DataFrame:
    """App member attributes with the mall member's gender and birth year."""
    people = _one_row_per_user(
        src.mall_members.select(F.col("wk_id").alias("user_id"), "gender", "birth_year"), ["gender", "birth_year"]
    )
    app = ["platform", "join_dt", "total_accumulate_cash", "current_cash", "terms_agree_yn"]
    return _one_row_per_user(src.app_members, app).join(people, "user_id", "left").selectExpr(
        "user_id",
        *[f"{c} as {c}_member" for c in ("platform", "join_dt", "total_accumulate_cash", "gender", "birth_year")],
        "current_cash",
        "terms_agree_yn",
    )


def user_profile(
    base: DataFrame,
    src: Sources,
    balance: DataFrame,
    survival_mall: DataFrame,
    survival_affiliate: DataFrame,
    power_mall: DataFrame,
    power_affiliate: DataFrame,
) -> DataFrame:
    """Attach everything known about a user to the channel rows in `base`.

    All sides are reduced to one row per user and keyed by it, so the joins share
    one partitioning and never multiply rows.
    """
    out = base
    for side in (
        src.offerwall_rfm.where("user_id IS NOT NULL").groupBy("user_id").agg(
            F.min("recency").alias("recency_wall"),
            F.max("frequency").alias("frequency_wall"),
            F.max("monetary").alias("monetary_wall"),
        ),
        member_profile(src),
        balance.where(F.col("user_id").isNotNull()),
        _survival_side(survival_mall, "shop"),
        _survival_side(survival_affiliate, "byshop"),
        _category_side(power_mall, "sp"),
        _category_side(power_affiliate, "bs"),
    ):
        out = out.join(side, "user_id", "left")
    return out


def _filled(name: str, have: list[str], order: list[str]) -> Column:
    """First known value along `order`; where some rows of a user lacked a channel's
    value, the greatest of it and its stand-in."""
    chain = [f"{name}_{channel}" for channel in order if f"{name}_{channel}" in have]
    out = F.col(chain[-1])
    for c in reversed(chain[:-1]):
        lacking = F.coalesce(F.col(f"{c}_missing"), F.lit(True))
        out = F.when(lacking, F.greatest(F.col(c), out)).otherwise(F.col(c))
    return out


def merged_snapshot(profile: DataFrame, track: str, as_of: date | str) -> DataFrame:
    """The wide per-user row of a track: three-channel RFM with defaults, totals, tgt."""
    first, second = ("mall", "affiliate") if track == "mall" else ("affiliate", "mall")
    have = profile.columns
    order = {
        "platform": [first, second, "member"],
        "join_dt": [first, second, "member"],
        "cum_lifetime": [first, second],
        "gender": ["mall", "member"],
        "birth_year": ["mall", "member"],
        "total_accumulate_cash": [first, second, "member"],
    }

    def long_or_zero(c: str) -> Column:
        return F.coalesce(round_to_long(F.col(c)), F.lit(0)).cast("bigint")

    def total(measure: str) -> Column:
        parts = [F.coalesce(F.col(f"{measure}_{ch}"), F.lit(0)) for ch in ("wall", "mall", "affiliate")]
        return parts[0] + parts[1] + parts[2]

    cols: dict[str, Column | None] = {"user_id": None}  # None: kept as it is
    for name in ("platform", "join_dt", "cum_lifetime", "gender", "birth_year"):
        cols[name] = _filled(name, have, order[name])
    if track == "mall":
        cols |= {"first_order_dt": None, "refund_rate": None}
    cols["terms_agree_yn"] = None
    cash = _filled("total_accumulate_cash", have, order["total_accumulate_cash"])
    cols["total_accumulate_cash"] = F.coalesce(cash.cast("bigint"), F.lit(0)).cast("bigint")
    cols["total_accumulate_shoji"] = F.coalesce(F.col("accumulate_shoji"), F.lit(0)).cast("bigint")
    cols["current_cash"] = F.coalesce(F.col("current_cash").cast("bigint"), F.lit(0)).cast("bigint")
    cols["current_shoji"] = F.coalesce(F.col("current_shoji"), F.lit(0)).cast("bigint")
    for suffix in ("shop", "byshop"):
        for out in _SURVIVAL_NAMES.values():
            cols[f"{out}_{suffix}"] = None
    for suffix, channel in (("shop", "mall"), ("byshop", "affiliate"), ("noncommerce", "wall")):
        recency = F.coalesce(F.col(f"recency_{channel}"), F.lit(labels.NO_PURCHASE_RECENCY))
        cols[f"r_{suffix}"] = recency.cast("bigint")
        cols[f"f_{suffix}"] = long_or_zero(f"frequency_{channel}")
        cols[f"m_{suffix}"] = long_or_zero(f"monetary_{channel}")
    cols["m_total"] = total("monetary")
    cols["f_total"] = total("frequency")
    for suffix in ("sp", "bs"):
        for c in RANKING_COLUMNS:
            cols[f"{c}_{suffix}"] = None
    wide = profile.select(*[n if c is None else c.alias(n) for n, c in cols.items()])
    return wide.select(
        F.when(F.col("f_shop") > 0, "shopping").otherwise("non-shopping").alias("tgt"),
        "*",
        day(as_of).alias("snapshot_dt"),
    )


def track_base(rfm_mall: DataFrame, rfm_affiliate: DataFrame, track: str, least: float = 1) -> DataFrame:
    """Users of a track with money of at least `least`, with the other channel beside it."""
    if track == "mall":
        lead = channel_rfm(rfm_mall.where(F.col("monetary") >= least), "mall")
        other = channel_rfm(rfm_affiliate, "affiliate")
    else:
        lead = channel_rfm(rfm_affiliate.where(F.col("monetary") >= least), "affiliate")
        # Order date and refund rate belong to the mall snapshot only.
        other = channel_rfm(rfm_mall.where(F.col("user_id").isNotNull()), "mall").drop("first_order_dt", "refund_rate")
    return lead.join(other, "user_id", "left")
