"""Category interest per user: shares, ranks and the pivoted top lists."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from patronage.functions.joins import deal, left_join_nullable
from patronage.functions.scalars import clean_label, day, has_label, nested_label, round_half_up, safe_divide
from patronage.operators.revenue import purchase_names
from patronage.sources.schemas import Sources


def interest_shares(stats: DataFrame, user: str, as_of: date | str, also: tuple[str, ...] = ()) -> DataFrame:
    """Share of each category in a user's interest (apart for the values of `also`).

    stats(user, *also, label, latest_dt, order_count); interest = 0.6 x share of purchase
    days + 0.4 x exp(-0.1 x days since the last one).
    """
    per_user = Window.partitionBy(user, *also)
    days = F.abs(F.datediff(F.col("latest_dt"), day(as_of)))
    share = safe_divide(F.col("order_count"), F.sum("order_count").over(per_user))
    scored = stats.select(
        user, *also, "label", (0.6 * share + 0.4 * F.exp(-0.1 * days)).alias("score")
    )
    return scored.select(
        user,
        *also,
        "label",
        "score",
        round_half_up(safe_divide(F.col("score"), F.sum("score").over(per_user)), 2).alias("interest_ratio"),
    )


def rank_interest(shares: DataFrame, user: str, top: int, also: tuple[str, ...] = ()) -> DataFrame:
    """The `top` categories of each user (and value of `also`); ties by label."""
    order = Window.partitionBy(user, *also).orderBy(F.desc("interest_ratio"), "label")
    return (
        shares.select(user, *also, "label", "interest_ratio", F.row_number().over(order).alias("ranking"))
        .where(F.col("ranking") <= top)
    )


def _slots(depth: int, top: int, where: str = "true") -> list[Column]:
    return [
        F.expr(f"max({col}) filter (where ranking = {i} and {where}) as {out}_{depth}_{i}")
        for col, out in (("label", "ranking"), ("interest_ratio", "power"))
        for i in range(1, top + 1)
    ]


def pivot_top(ranked: DataFrame, user: str, depth: int, top: int) -> DataFrame:
    """One row per user: ranking_<depth>_<i> and power_<depth>_<i>."""
    return ranked.groupBy(user).agg(*_slots(depth, top))


def category_power(depth1: DataFrame, depth2: DataFrame, user: str, as_of: date | str) -> DataFrame:
    top3 = pivot_top(rank_interest(interest_shares(depth1, user, as_of), user, 3), user, 1, 3)
    top6 = pivot_top(rank_interest(interest_shares(depth2, user, as_of), user, 6), user, 2, 6)
    return top3.join(top6, user, "left")


def category_power_of_days(
    days: DataFrame, user: str, on: str, no: Column, label2: Column, second: Column, as_of: date | str, dates: Sequence[date | str] | None = None
) -> DataFrame:
    """`category_power` of days(user, on, depth1, depth2, ...), which may repeat and are dealt by user once for both levels.

    A user's task keeps distinct days only, at most one row per calendar day and category.  A day counts for its first level, one row per user and `no`, and where `second` holds for
    its second one, one row per user, depth1 and depth2, labelled `label2`.

    With `dates`, the days up to each of them give the rows of that date, marked by `snapshot_dt`; these are a few
    dates, as each is a few columns of the counts.
    """
    rows = level_days(days, user, on, no, label2, second)
    keys = [user, *LEVEL_KEYS]
    if dates is None:
        return power_of_stats(level_stats(rows, user, on), user, as_of)
    stats = _stats_at(rows.groupBy(*keys, on).agg(F.max("label").alias("label")), keys, on, dates)
    return power_of_stats(stats, user, F.col("snapshot_dt"), ("snapshot_dt",))


LEVEL_KEYS = ("level", "no", "sub1", "sub2")


def level_days(days: DataFrame, user: str, on: str, no: Column, label2: Column, second: Column) -> DataFrame:
    """(user, on, *LEVEL_KEYS, label): the days of both category levels, dealt by user."""
    none = F.lit(None).cast("string")
    levels = F.array(
        F.struct(F.lit(1).alias("level"), no.alias("no"), none.alias("sub1"), none.alias("sub2"), F.col("depth1").alias("label")),
        F.struct(F.lit(2).alias("level"), F.lit(None).alias("no"), F.col("depth1").alias("sub1"), F.col("depth2").alias("sub2"), label2.alias("label")),
    )
    rows = deal(days, user).distinct().select(user, on, second.alias("_second"), F.inline(levels))
    return rows.where((F.col("level") == 1) | F.col("_second")).drop("_second")


def level_stats(rows: DataFrame, user: str, on: str) -> DataFrame:
    """(user, *LEVEL_KEYS, label, latest_dt, order_count) of the days of both levels."""
    return rows.groupBy(user, *LEVEL_KEYS).agg(F.max("label").alias("label"), F.max(on).alias("latest_dt"), F.countDistinct(on).alias("order_count"))


def power_of_stats(stats: DataFrame, user: str, as_of: date | str | Column, dated: tuple[str, ...] = ()) -> DataFrame:
    """One row per user (and date) from the statistics of both levels; all steps stay in a partitioning by user."""
    also = (*dated, "level")
    ranked = rank_interest(interest_shares(stats, user, as_of, also), user, 6, also)
    # Of users without an id the second level is not known, as nothing meets a null.
    known = f"{user} is not null and level = 2"
    return ranked.groupBy(user, *dated).agg(*_slots(1, 3, "level = 1"), *_slots(2, 6, known))


def _stats_at(days: DataFrame, keys: list[str], on: str, dates: Sequence[date | str]) -> DataFrame:
    """(*keys, snapshot_dt, label, latest_dt, order_count) of distinct days(*keys, on, label), as of each date that has any."""
    upto = [F.col(on) <= day(d) for d in dates]
    counted = days.groupBy(*keys).agg(
        *[
            F.struct(
                day(d).alias("snapshot_dt"),
                F.max(F.when(seen, F.col("label"))).alias("label"),
                F.max(F.when(seen, F.col(on))).alias("latest_dt"),
                F.count_if(seen).alias("order_count"),
            ).alias(f"at{i}")
            for i, (d, seen) in enumerate(zip(dates, upto, strict=True))
        ]
    )
    each = F.filter(F.array(*[F.col(f"at{i}") for i in range(len(dates))]), lambda s: s["order_count"] > 0)
    return counted.select(*keys, F.inline(each))


# --- affiliate -------------------------------------------------------------


def affiliate_category_days(src: Sources, start: date | str, as_of: date | str, names: DataFrame | None = None) -> DataFrame:
    """Distinct (user, day, category1, category2) of affiliate purchases with a category."""
    return affiliate_bought_categories(src, start, as_of, names).distinct()


def affiliate_bought_categories(src: Sources, start: date | str, as_of: date | str, names: DataFrame | None = None) -> DataFrame:
    """(user, day, category1, category2) of affiliate purchases with a category; they may repeat.

    Only purchase days matter further on, so the keywords are deduplicated before the join.  `names` are the (user_id, event_dt, name) of the window where they
    are stored already.
    """
    bought = purchase_names(src, start, as_of) if names is None else names.select("user_id", "event_dt", "name")
    keywords = src.product_keywords.where(has_label(F.col("category1"))).select("name", "category1", "category2").distinct()
    return bought.join(keywords, "name").select(
        "user_id",
        "event_dt",
        clean_label(F.col("category1")).alias("depth1"),
        clean_label(F.col("category2")).alias("depth2"),
    )


def _dealt(days: DataFrame, user: str, *cols: str) -> DataFrame:
    """The columns of distinct days dealt by user once; all further steps group or join by the user.

    A user has at most one row per calendar day and category.
    """
    return days.select(user, *cols).repartition(user)


def affiliate_depth1(days: DataFrame) -> DataFrame:
    return _dealt(days, "user_id", "event_dt", "depth1").groupBy("user_id", F.col("depth1").alias("label")).agg(
        F.max("event_dt").alias("latest_dt"), F.countDistinct("event_dt").alias("order_count")
    )


def affiliate_depth2(days: DataFrame) -> DataFrame:
    """Grouped on the raw sub-category: null and blank stay two rows with one label."""
    stats = _dealt(days, "user_id", "event_dt", "depth1", "depth2").groupBy("user_id", "depth1", "depth2").agg(
        F.max("event_dt").alias("latest_dt"), F.countDistinct("event_dt").alias("order_count")
    )
    return affiliate_labels(stats)


def affiliate_labels(stats: DataFrame) -> DataFrame:
    """stats by (user_id, depth1, depth2) with their label."""
    # Trimmed here, as the affiliate rule trims the sub-category itself.
    label = nested_label(F.col("depth1"), F.trim("depth2"))
    return stats.select("user_id", label.alias("label"), "latest_dt", "order_count")


def category_power_affiliate(
    src: Sources, start: date | str, as_of: date | str, names: DataFrame | None = None, dates: Sequence[date | str] | None = None
) -> DataFrame:
    days = affiliate_bought_categories(src, start, as_of, names)
    return category_power_of_days(days, *affiliate_levels(), as_of, dates)


def affiliate_levels() -> tuple[str, str, Column, Column, Column]:
    """What `category_power_of_days` reads of affiliate days: user, day, number, second label, and where that counts."""
    # Trimmed here, as the affiliate rule trims the sub-category itself.
    return "user_id", "event_dt", F.col("depth1"), nested_label(F.col("depth1"), F.trim("depth2")), F.lit(True)


# --- mall --------------------------------------------------------------------


def category_by_code(categories: DataFrame) -> DataFrame:
    """Category rows keyed by the code an order may carry: depth 4 or depth 3.

    A row joins at most once per code, as `depth4 = code OR depth3 = code` does,
    but as an equality join instead of a nested loop.
    """
    codes = F.array_distinct(F.array("depth4_category_no", "depth3_category_no"))
    return categories.withColumn("category_no", F.explode(codes)).where(F.col("category_no").isNotNull())


def category_or_join(orders: DataFrame, categories: DataFrame) -> DataFrame:
    """Orders with every category row their code matches; unmatched orders stay."""
    return left_join_nullable(orders, category_by_code(categories), "category_no")


def mall_category_days(src: Sources, start: date | str, as_of: date | str) -> DataFrame:
    """Distinct (member, day, category) of mall orders; null category when unmatched.

    Only days and names are aggregated further on, so the names are reduced to
    distinct rows before the join and the days after it.
    """
    return category_days_of(src, src.mall_orders.where(F.col("order_dt").between(day(start), day(as_of))))


def category_days_of(src: Sources, orders: DataFrame) -> DataFrame:
    """`mall_category_days` of the given orders."""
    return mall_bought_categories(src, orders).distinct()


def mall_bought_categories(src: Sources, orders: DataFrame) -> DataFrame:
    """(member, day, category) of the given orders, which may repeat."""
    bought = orders.select("member_no", "order_dt", "category_no")
    names = category_by_code(src.mall_categories).select(
        "category_no",
        "depth1_category_no",
        clean_label(F.col("depth1_category_name")).alias("depth1"),
        clean_label(F.col("depth2_category_name")).alias("depth2"),
    ).distinct()
    return left_join_nullable(bought, names, "category_no").drop("category_no")


def mall_depth1(days: DataFrame) -> DataFrame:
    """By category number; orders without a category form a row of their own."""
    dealt = _dealt(days, "member_no", "order_dt", "depth1_category_no", "depth1")
    return dealt.groupBy("member_no", "depth1_category_no").agg(
        F.max("depth1").alias("label"),
        F.max("order_dt").alias("latest_dt"),
        F.countDistinct("order_dt").alias("order_count"),
    )


def mall_depth2(days: DataFrame) -> DataFrame:
    labelled = days.where(has_label(F.col("depth1")))
    stats = _dealt(labelled, "member_no", "order_dt", "depth1", "depth2").groupBy("member_no", "depth1", "depth2").agg(
        F.max("order_dt").alias("latest_dt"), F.countDistinct("order_dt").alias("order_count")
    )
    return mall_labels(stats)


def mall_labels(stats: DataFrame) -> DataFrame:
    """stats by (member_no, depth1, depth2) with their label."""
    label = nested_label(F.col("depth1"), F.col("depth2"))
    return stats.select("member_no", label.alias("label"), "latest_dt", "order_count")


def category_power_mall(src: Sources, start: date | str, as_of: date | str, dates: Sequence[date | str] | None = None) -> DataFrame:
    days = mall_bought_categories(src, src.mall_orders.where(F.col("order_dt").between(day(start), day(as_of))))
    return of_users(src, category_power_of_days(days, *mall_levels(), as_of, dates))


def mall_levels() -> tuple[str, str, Column, Column, Column]:
    """What `category_power_of_days` reads of mall days."""
    label = nested_label(F.col("depth1"), F.col("depth2"))
    return "member_no", "order_dt", F.col("depth1_category_no"), label, has_label(F.col("depth1"))


def of_users(src: Sources, power: DataFrame) -> DataFrame:
    """Category power of the members' users."""
    people = src.mall_members.select("member_no", F.col("wk_id").alias("user_id"))
    cols = [c for c in power.columns if c != "member_no"]
    return power.join(people, "member_no", "left").select("user_id", *cols)
