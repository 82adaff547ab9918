"""Recency, frequency and monetary value per user and channel."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from patronage.functions import labels
from patronage.functions.joins import left_join_nullable
from patronage.functions.scalars import day, first_of, round_half_up, safe_divide
from patronage.operators.revenue import affiliate_purchases
from patronage.sources.readers import order_status
from patronage.sources.schemas import Sources


def user_days(purchases: DataFrame) -> DataFrame:
    """Revenue per (user, day).  At most one row per calendar day, however hot the user."""
    return purchases.groupBy("user_id", "event_dt").agg(
        F.sum(F.coalesce(F.col("revenue"), F.lit(0.0))).alias("revenue")
    )


def member_activity(members: DataFrame, purchases: DataFrame, as_of: date | str) -> DataFrame:
    """RFM of every member.

    Members without any purchase stay with frequency 0 and no recency; members
    whose purchases all lie after `as_of` are left out.
    """
    past = F.col("event_dt") <= day(as_of)
    activity = (
        user_days(purchases)
        .groupBy("user_id")
        .agg(
            F.max(F.when(past, F.col("event_dt"))).alias("last_dt"),
            F.count_if(past).alias("frequency"),
            F.sum(F.when(past, F.col("revenue"))).alias("monetary"),
            F.lit(True).alias("bought"),
        )
    )
    return members_with_activity(members, activity, as_of)


def members_with_activity(members: DataFrame, activity: DataFrame, as_of: date | str) -> DataFrame:
    """Members beside activity(user_id, last_dt, frequency, monetary, bought) as of a date."""
    return (
        members.join(activity, "user_id", "left")
        .where(F.col("bought").isNull() | (F.col("frequency") > 0))
        .select(
            "user_id",
            "platform",
            "join_dt",
            F.datediff(day(as_of), F.col("join_dt")).cast("bigint").alias("cum_lifetime"),
            "total_accumulate_cash",
            "current_cash",
            F.datediff(day(as_of), F.col("last_dt")).cast("bigint").alias("recency"),
            F.coalesce(F.col("frequency"), F.lit(0)).alias("frequency"),
            F.coalesce(F.col("monetary"), F.lit(0.0)).alias("monetary"),
            day(as_of).alias("snapshot_dt"),
        )
    )


def rfm_affiliate(src: Sources, start: date | str, as_of: date | str, purchases: DataFrame | None = None) -> DataFrame:
    """Affiliate RFM of the members with revenue; `purchases` are those of the window where they are stored already."""
    if purchases is None:
        purchases = affiliate_purchases(src, start, as_of)
    return member_activity(src.app_members, purchases, as_of).where(F.col("monetary") > 0)


def _days_of(orders: DataFrame, count: str) -> DataFrame:
    """Orders per (member, day); those without a member meet nothing and are left out."""
    return orders.where("member_no IS NOT NULL").groupBy("member_no", "order_dt").agg(F.count(F.lit(1)).alias(count))


def _refund_counts(order_days: DataFrame, refund_days: DataFrame, as_of: date | str, within_days: int) -> DataFrame:
    """Per (member, order day): refunds of the member, and those that hit the day.

    A refund hits an order when it comes at most `within_days` after it (or at any
    time before) and not after `as_of`.  Order days, moved to their deadline, and
    refund days are put on one time line per member and the refunds are summed up
    along it, so no order x refund pairs are formed.  Both sides hold one row per
    calendar day and member: order_days(member_no, order_dt), refund_days(.., refunds).
    """
    deadline = F.least(F.date_add("order_dt", within_days), day(as_of))
    marks = order_days.select("member_no", deadline.alias("at"), "order_dt", F.lit(0).cast("bigint").alias("refunds")).unionByName(
        refund_days.select("member_no", F.col("order_dt").alias("at"), F.lit(None).cast("date").alias("order_dt"), "refunds")
    )
    return _summed_refunds(marks)


def _summed_refunds(marks: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The order days among marks(member_no, *by, at, order_dt, refunds, ...) with `hits`, the refunds up to `at`, and all `refunds`."""
    member = Window.partitionBy("member_no", *by)
    so_far = member.orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    others = [c for c in marks.columns if c not in ("at", "refunds")]
    summed = marks.select(*others, F.sum("refunds").over(so_far).alias("hits"), F.sum("refunds").over(member).alias("refunds"))
    return summed.where(F.col("order_dt").isNotNull())


def _days_with_refunds(days: DataFrame, as_of: date | str | Column, within_days: int, by: tuple[str, ...]) -> DataFrame:
    """The days with orders of `order_days` rows with their refunds, which are counted as in `_refund_counts`.

    A day with orders and refunds gives two marks, in its own place, so days that come dealt by member stay so.
    """
    carried = {"n": "bigint", "amt": "double", "rate_sum": "double", "rate_n": "bigint"}
    ordered, refunded = (F.col("n") > 0) & (F.col("order_dt") <= day(as_of)), (F.col("refunds") > 0) & F.col("member_no").isNotNull()
    deadline = F.least(F.date_add("order_dt", within_days), day(as_of))
    order = F.struct(deadline.alias("at"), "order_dt", F.lit(0).cast("bigint").alias("refunds"), *[F.col(c).cast(t).alias(c) for c, t in carried.items()])
    refund = F.struct(F.col("order_dt").alias("at"), F.lit(None).cast("date").alias("order_dt"), "refunds", *[F.lit(None).cast(t).alias(c) for c, t in carried.items()])
    marks = F.filter(F.array(F.when(ordered, order), F.when(refunded, refund)), lambda m: m.isNotNull())
    return _summed_refunds(days.select("member_no", *by, F.inline(marks)), by)


def refund_flags(
    orders: DataFrame,
    refunds: DataFrame,
    as_of: date | str,
    within_days: int = labels.REFUND_WINDOW_DAYS,
) -> DataFrame:
    """Orders with the number of refunds that hit them and whether any does."""
    counts = _refund_counts(_days_of(orders, "orders"), _days_of(refunds, "refunds"), as_of, within_days)
    met = left_join_nullable(orders, counts, "member_no", ["order_no"], also=("order_dt",))
    none = F.lit(0).cast("bigint")
    return met.withColumns({"hits": F.coalesce("hits", none), "refunds": F.coalesce("refunds", none)}).withColumn("is_refunded", F.col("hits") > 0)


def order_days(
    rows: DataFrame, start: date | str, last: date | str | None = None, valid=labels.MALL_VALID_STATUSES, refunded=labels.MALL_REFUND_STATUSES
) -> DataFrame:
    """(member_no, order_dt, n, amt, rate_sum, rate_n, refunds): valid orders of a window and refunds of any time.

    rows(member_no, order_dt, first_pay_amt, rate, status); with `last`, the window ends there.
    """
    is_valid = F.col("status").isin(*valid) & (F.col("order_dt") >= day(start))
    if last is not None:
        is_valid = is_valid & (F.col("order_dt") <= day(last))
    is_refund = F.col("status").isin(*refunded)
    return (
        rows.where(is_valid | is_refund)
        .groupBy("member_no", "order_dt")
        .agg(
            F.count_if(is_valid).alias("n"),
            F.sum(F.when(is_valid, F.col("first_pay_amt"))).alias("amt"),
            F.sum(F.when(is_valid, F.col("rate"))).alias("rate_sum"),
            F.count(F.when(is_valid, F.col("rate"))).alias("rate_n"),
            F.count_if(is_refund).alias("refunds"),
        )
    )


def mall_order_days(
    src: Sources, start: date | str, last: date | str, valid=labels.MALL_VALID_STATUSES, refunded=labels.MALL_REFUND_STATUSES
) -> DataFrame:
    """`order_days` of the mall orders."""
    rate = first_of(F.col("product_option"), "commission_rate")
    rows = src.mall_orders.select("member_no", "order_dt", "first_pay_amt", rate.alias("rate"), order_status().alias("status"))
    return order_days(rows, start, last, valid, refunded)


def rfm_mall(
    src: Sources,
    start: date | str,
    as_of: date | str,
    fan_out: bool = True,
    valid=labels.MALL_VALID_STATUSES,
    refunded=labels.MALL_REFUND_STATUSES,
    within_days: int = labels.REFUND_WINDOW_DAYS,
) -> DataFrame:
    """Mall RFM per member.

    With `fan_out` every order counts once per refund of its member, as a plain join
    of orders and refunds has it, which inflates purchases and money; without it every
    order counts once.  Both are computed from per-day counts.
    """
    return mall_profile(src, mall_order_days(src, start, as_of, valid, refunded), as_of, fan_out, within_days)


def mall_profile(
    src: Sources,
    days: DataFrame,
    as_of: date | str | Column,
    fan_out: bool = True,
    within_days: int = labels.REFUND_WINDOW_DAYS,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Mall RFM per member from its `order_days`, one row per member and calendar day; refunds count whatever their day.

    Days are dealt by member once.  Orders without a member meet no refund; they are one group, a row a day.
    Days of several dates are told apart by the columns `by`, and `as_of` is a column then.
    """
    met = _days_with_refunds(days, as_of, within_days, by)
    if fan_out:
        copies = F.greatest(F.col("refunds"), F.lit(1))
        lost = F.col("hits")
    else:
        copies = F.lit(1)
        lost = F.when(F.col("hits") > 0, 1).otherwise(0)
    kept = F.col("copies") - F.col("lost")
    per_member = met.withColumns({"copies": copies, "lost": lost}).groupBy("member_no", *by).agg(
        F.max(F.when(kept > 0, F.col("order_dt"))).alias("last_order_dt"),
        F.count_if(kept > 0).alias("frequency"),
        F.sum(F.coalesce(F.col("amt"), F.lit(0.0)) * kept).alias("monetary"),
        safe_divide(F.sum("rate_sum"), F.sum("rate_n")).alias("avg_commission_rate"),
        F.sum(F.col("n") * F.col("copies")).alias("total_purchases"),
        F.sum(F.col("n") * F.col("lost")).alias("total_refunds"),
        F.min("order_dt").alias("first_order_dt"),
    )
    people = src.mall_members.select("member_no", F.col("wk_id").alias("user_id"), "gender", "birth_year")
    apps = src.app_members.select("user_id", "platform", "join_dt", "total_accumulate_cash", "current_cash")
    known = left_join_nullable(per_member, people, "member_no")
    return (
        left_join_nullable(known, apps, "user_id", ["member_no"])
        .select(
            "member_no",
            "user_id",
            "platform",
            "join_dt",
            F.datediff(day(as_of), F.col("join_dt")).cast("bigint").alias("cum_lifetime"),
            "total_accumulate_cash",
            "current_cash",
            F.datediff(day(as_of), F.col("last_order_dt")).cast("bigint").alias("recency"),
            "frequency",
            "monetary",
            "gender",
            "birth_year",
            "avg_commission_rate",
            "total_purchases",
            "total_refunds",
            round_half_up(F.col("total_refunds") * 100.0 / F.col("total_purchases"), 2).alias("refund_rate"),
            "last_order_dt",
            "first_order_dt",
            day(as_of).alias("snapshot_dt"),
        )
    )
