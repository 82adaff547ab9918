"""Affiliate revenue: orders and refunds of the event feed and of the partner feed."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from patronage.functions import labels
from patronage.functions.joins import deal
from patronage.functions.scalars import day, floor_at_zero
from patronage.sources.readers import order_window
from patronage.sources.schemas import Sources

PURCHASE_COLUMNS = ["event_dt", "user_id", "event_category", "event_label", "revenue"]


def entry_label(action: Column) -> Column:
    """Where the user came from, by action code; null for other actions."""
    out = None
    for code, label in labels.ENTRY_LABELS.items():
        out = F.when(action == code, label) if out is None else out.when(action == code, label)
    return out


# Coarse columns first: rows sorted for the event second are then sorted for the roll-up and the refunds too.
_ROLLED = ["user_id", "transaction_id", "event_dt", "event_action", "event_category"]
_GRAIN = [*_ROLLED, "event_dttm", "airbridge_device_id", "platform", "event_label"]


def _per_second(events: DataFrame, share: float, by_name: bool, with_name: bool = False) -> DataFrame:
    """The share rounded per event second (and name, if by_name); cancels count negative."""
    sign = F.when(F.col("event_category") == labels.ORDER_CANCEL, -1).otherwise(1)
    named = [F.min("name").alias("name")] if with_name else []
    return (
        events.groupBy(*_GRAIN, *(["name"] if by_name else []))
        .agg((F.round(F.sum("price") * share)).alias("revenue"), *named)
        .withColumns({"revenue": F.col("revenue") * sign, "event_label": entry_label(F.col("event_action"))})
    )


def revenue_rollup(
    events: DataFrame,
    category: str,
    share: float = labels.COMMISSION_SHARE,
    by_name: bool = False,
) -> DataFrame:
    """Revenue per (day, user, transaction, entry, action).

    The share is rounded per event second first and summed after, so the inner
    grain matters; `by_name` adds the product name to it.
    """
    named = [F.min("name").alias("name")] if by_name else []
    return (
        _per_second(events.where(F.col("event_category") == category), share, by_name)
        .groupBy("event_dt", "user_id", "transaction_id", "event_label", "event_action")
        .agg(
            F.min("airbridge_device_id").alias("airbridge_device_id"),
            F.min("platform").alias("platform"),
            *named,
            F.min("event_category").alias("event_category"),
            F.sum("revenue").alias("revenue"),
        )
    )


def _net(revenue: Column, refund: Column, floor: bool) -> Column:
    net = revenue + F.coalesce(refund, F.lit(0.0))
    return floor_at_zero(net).cast("double") if floor else net


def net_orders(orders: DataFrame, refunds: DataFrame, floor: bool = True, sum_refunds: bool = False) -> DataFrame:
    """Order revenue less the refunds of the same user and transaction.

    An order meets each matching refund row on its own, so several refund rows
    repeat it; `sum_refunds` adds them up first and keeps one row per order.
    """
    keys = ["user_id", "transaction_id"]
    back = refunds.select(*keys, F.col("revenue").alias("refund"))
    if sum_refunds:
        back = back.groupBy(*keys).agg(F.sum("refund").alias("refund"))
    return (
        orders.join(back, keys, "left")
        .withColumn("revenue", _net(F.col("revenue"), F.col("refund"), floor))
        .drop("refund")
    )


def rolled_events(
    events: DataFrame, by_name: bool = False, share: float = labels.COMMISSION_SHARE, with_name: bool = False, dealt: bool = False
) -> DataFrame:
    """Revenue of orders and refunds per (day, user, transaction, entry, action, kind), in one scan.

    The rows are dealt by user and transaction once, which serves both groupings and the
    refunds' window after them; grouped by the action alone, whose entry is known.  With
    `dealt` the events come dealt that way.
    """
    both = events.where(F.col("event_category").isin(labels.ORDER_COMPLETE, labels.ORDER_CANCEL))
    both = both.select(*_GRAIN, *(["name"] if by_name or with_name else []), "price")
    if not dealt:
        both = deal(both, "user_id", "transaction_id")
    if by_name:
        # Refunds are rounded without regard to the name.
        both = both.withColumn("name", F.when(F.col("event_category") == labels.ORDER_COMPLETE, F.col("name")))
    named = [F.min("name").alias("name")] if by_name or with_name else []
    return (
        _per_second(both, share, by_name, with_name)
        .groupBy(*_ROLLED)
        .agg(*named, F.sum("revenue").alias("revenue"))
        .withColumn("event_label", entry_label(F.col("event_action")))
    )


def _matched_refunds(events: DataFrame, by_name: bool, share: float, with_name: bool = False, dealt: bool = False) -> DataFrame:
    """The rolled-up orders with `refunds`, the (day, revenue) of the cancels of the same user and transaction.

    Orders and refunds are rolled up together and meet inside their (user,
    transaction) group.  After the roll-up such a group holds at most one row per
    day, action and kind, whatever the number of events.
    """
    is_order = F.col("event_category") == labels.ORDER_COMPLETE
    rolled = rolled_events(events, by_name, share, with_name, dealt)
    # A null transaction matches nothing.
    refund = F.when(~is_order & F.col("transaction_id").isNotNull(), F.struct("event_dt", "revenue"))
    refunds = F.collect_list(refund).over(Window.partitionBy("user_id", "transaction_id"))
    return rolled.withColumn("refunds", refunds).where(is_order)


def net_purchases(
    events: DataFrame,
    floor: bool = True,
    by_name: bool = False,
    share: float = labels.COMMISSION_SHARE,
    with_name: bool = False,
    dealt: bool = False,
) -> DataFrame:
    """The purchase columns of net_orders(rollup of orders, rollup of refunds) in one scan.

    `by_name` rounds per name as well; `with_name` only carries the least name along.
    `dealt` events come dealt by user and transaction.
    """
    kept = ["event_dt", "event_category", "event_label", "revenue"] + (["name"] if by_name or with_name else [])
    return (
        _matched_refunds(events, by_name, share, with_name, dealt)
        .select("user_id", *kept, F.explode_outer("refunds.revenue").alias("refund"))
        .withColumn("revenue", _net(F.col("revenue"), F.col("refund"), floor))
        .drop("refund")
    )


def _changes(orders: DataFrame, floor: bool) -> DataFrame:
    """(user_id, at, amount, is_order): how each order's net revenue builds up day by day.

    An order counts in full on its day.  Its first refund row, effective on the later of
    both days, puts the net amount in its place; each further one repeats the order net
    of itself, as net_orders does.
    """
    day_of, own = F.col("event_dt"), F.coalesce(F.col("revenue"), F.lit(0.0)).cast("double")
    back = F.array_sort(
        F.transform(
            F.coalesce(F.col("refunds"), F.array()),
            lambda r: F.struct(F.greatest(r["event_dt"], day_of).alias("at"), F.coalesce(_net(own, r["revenue"], floor), F.lit(0.0)).alias("net")),
        )
    )
    later = F.transform(
        back, lambda r, i: F.struct(r["at"].alias("at"), (r["net"] - F.when(i == 0, own).otherwise(0.0)).alias("amount"), F.lit(False).alias("is_order"))
    )
    first = F.struct(day_of.alias("at"), own.alias("amount"), F.lit(True).alias("is_order"))
    return orders.select("user_id", F.inline(F.concat(F.array(first), later)))


def purchase_changes(
    src: Sources, start: date | str, last: date | str, partner_start: date | str | None = None, floor: bool = True
) -> DataFrame:
    """Changes of net revenue by day: up to any day D they sum to `affiliate_purchases` as of D."""
    since = partner_start or start
    direct = _matched_refunds(order_window(src.affiliate_events, start, last), False, labels.COMMISSION_SHARE)
    partner = _partner_with_refunds(src, since, last)
    cols = ["user_id", "event_dt", "revenue", "refunds"]
    return _changes(direct.select(*cols), floor).unionByName(_changes(partner.select(*cols), floor))


def _partner_with_refunds(src: Sources, start: date | str, last: date | str) -> DataFrame:
    """Partner days with `refunds`, the (day, revenue) of their cancels."""
    cancels = (
        partner_cancel_daily(src.partner_cancels, start, last)
        .groupBy("user_id", F.col("order_date").alias("event_dt"))
        .agg(F.collect_list(F.struct("event_dt", "revenue")).alias("refunds"))  # one a cancel day
    )
    return partner_daily(src.partner_orders, start, last).join(cancels, ["user_id", "event_dt"], "left")


def partner_daily(orders: DataFrame, start: date | str, as_of: date | str) -> DataFrame:
    """Commission per (day, user) with the least product name of the day."""
    return (
        orders.where(F.col("date").between(day(start), day(as_of)) & F.col("subParam").isNotNull())
        .groupBy(F.col("date").cast("date").alias("event_dt"), F.col("subParam").alias("user_id"))
        .agg(F.min("productName").alias("name"), F.sum("commission").alias("revenue"))
        .withColumns(
            {
                "event_category": F.lit(labels.ORDER_COMPLETE),
                "event_action": F.lit(labels.PARTNER_ACTION),
                "event_label": F.lit(labels.PARTNER_LABEL),
            }
        )
    )


def partner_cancel_daily(cancels: DataFrame, start: date | str, as_of: date | str) -> DataFrame:
    """Commission taken back per (cancel day, order day, user); cancel days are yyyymmdd text.

    Dealt by order day and user, as partner_daily's rows are that net_partner joins them to.
    """
    cancel_dt = F.to_date("date", "yyyyMMdd")
    text = [F.date_format(day(d), "yyyyMMdd") for d in (start, as_of)]  # sorts as the days do, and reaches the scan
    return (
        cancels.where(F.col("date").between(*text) & cancel_dt.between(day(start), day(as_of)) & F.col("subParam").isNotNull())
        .select(cancel_dt.alias("event_dt"), F.col("orderDate").alias("order_date"), F.col("subParam").alias("user_id"), "commission")
        .repartition("order_date", "user_id")
        .groupBy("event_dt", "order_date", "user_id")
        .agg(F.sum("commission").alias("revenue"))
    )


def net_partner(orders: DataFrame, cancels: DataFrame, floor: bool = True) -> DataFrame:
    """Partner days less the cancels of the same user and order day, one row per cancel day."""
    back = cancels.select("user_id", F.col("order_date").alias("event_dt"), F.col("revenue").alias("refund"))
    return (
        orders.join(back, ["user_id", "event_dt"], "left")
        .withColumn("revenue", _net(F.col("revenue"), F.col("refund"), floor))
        .drop("refund")
    )


def affiliate_purchases(
    src: Sources,
    start: date | str,
    as_of: date | str,
    partner_start: date | str | None = None,
    floor: bool = True,
    by_name: bool = False,
) -> DataFrame:
    """Net purchases of both affiliate feeds up to `as_of`."""
    direct = net_purchases(order_window(src.affiliate_events, start, as_of), floor, by_name)
    since = partner_start or start
    partner = net_partner(
        partner_daily(src.partner_orders, since, as_of),
        partner_cancel_daily(src.partner_cancels, since, as_of),
        floor,
    )
    cols = PURCHASE_COLUMNS + (["name"] if by_name else [])
    return direct.select(*cols).unionByName(partner.select(*cols))


def purchases_with_refunds(src: Sources, start: date | str, last: date | str) -> DataFrame:
    """(user_id, event_dt, revenue, name, is_partner, refunds): the affiliate purchases of a window before refunds.

    `refunds` are the (day, revenue) of the cancels they meet; `purchases_at` gives the net purchases
    of any date of the window.  Both feeds are rolled up by day, so a date is a choice of rows and refunds.
    """
    dealt = getattr(src, "dealt_events", None)  # of sources that store orders with their lines
    events = src.affiliate_events if dealt is None else dealt
    direct = _matched_refunds(order_window(events, start, last), False, labels.COMMISSION_SHARE, with_name=True, dealt=dealt is not None)
    partner = _partner_with_refunds(src, start, last)
    cols = ["user_id", "event_dt", "revenue", "name", "refunds"]
    return direct.select(*cols, F.lit(False).alias("is_partner")).unionByName(partner.select(*cols, F.lit(True).alias("is_partner")))


def purchases_at(purchases: DataFrame, as_of: date | str) -> DataFrame:
    """`purchase_facts` as of a date, of purchases with the refunds of that and later days; nothing is shuffled."""
    known = F.filter("refunds", lambda r: r["event_dt"] <= day(as_of))
    return (
        purchases.where(F.col("event_dt") <= day(as_of))
        .withColumn("refund", F.explode_outer(F.transform(known, lambda r: r["revenue"])))
        .select("user_id", "event_dt", _net(F.col("revenue"), F.col("refund"), True).alias("revenue"), "name", "is_partner")
    )


def purchase_facts(src: Sources, start: date | str, as_of: date | str) -> DataFrame:
    """(user_id, event_dt, revenue, name, is_partner): what RFM, categories and cycles read of the affiliate purchases.

    The revenue is that of `affiliate_purchases`, the name that of `purchase_names`.
    """
    return purchases_at(purchases_with_refunds(src, start, as_of), as_of)


def purchase_names(
    src: Sources, start: date | str, as_of: date | str, partner_start: date | str | None = None
) -> DataFrame:
    """(user_id, event_dt, name) of the rows `affiliate_purchases(by_name=True)` returns.

    Refunds change the revenue of a purchase, never its day or name, so neither the
    refunds nor the revenue are computed.
    """
    orders = order_window(src.affiliate_events, start, as_of).where(F.col("event_category") == labels.ORDER_COMPLETE)
    direct = orders.groupBy("event_dt", "user_id", "transaction_id", "event_action").agg(F.min("name").alias("name"))
    cols = ["user_id", "event_dt", "name"]
    return direct.select(*cols).unionByName(
        partner_daily(src.partner_orders, partner_start or start, as_of).select(*cols)
    )
