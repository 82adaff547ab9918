"""The source tables derived from a TPC-H-like star schema plus an event log.

orders / lineitem stand in for both sales channels, customer for the members, part
for the catalogue and events for the ledger, the offer wall and the app log.
"""

from __future__ import annotations

import hashlib
from functools import cached_property
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from patronage.functions import labels
from patronage.functions.joins import deal
from patronage.sources.readers import kept_stage

ORDERS_START = "1995-01-01"
ORDERS_AS_OF = "2001-08-01"
EVENTS_AS_OF = "2024-01-31"

# Order priority -> affiliate action code.
_ACTIONS = {
    "1-URGENT": "balso1sa1",
    "2-HIGH": "balso1sr2",
    "3-MEDIUM": "balso2sa1",
    "4-NOT SPECIFIED": "balso2sr1",
}


# Columns of the star schema.  Given, so that opening a table runs no inference job.
_TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# What the fields read of a line; the first six put the lines of an order in order.
_LINE = ("l_linenumber", "l_partkey", "l_suppkey", "l_discount", "l_returnflag", "l_linestatus", "l_extendedprice", "l_shipdate")
# What the affiliate events read of a line.
_EVENT_LINE = ("l_linestatus", "l_returnflag", "l_suppkey", "l_partkey", "l_extendedprice")


def _event_keys() -> dict[str, Column]:
    return {"user_id": F.col("o_custkey").cast("string"), "transaction_id": F.col("o_orderkey").cast("string")}


class StarSchema:
    """Offers the fields of `Sources`; each is built when first read.

    With `store`, orders and their lines are joined once and stored there, and the four
    fields made of them read that table instead of joining them each.
    """

    def __init__(self, spark: SparkSession, base: str, store: str | None = None):
        self.spark, self.base, self.store = spark, base, store
        self._storing = Lock()

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(_TABLES[name]).parquet(f"{self.base}/{name}.parquet")

    def state(self) -> str:
        """A name for the present files of all tables: another one once a table was written anew."""
        seen = []
        for name in sorted(_TABLES):
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}.parquet")
            root = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).getFileStatus(path)
            seen.append(f"{name} {root.getModificationTime()} {root.getLen()} {sorted(self.table(name).inputFiles())}")
        return hashlib.md5("\n".join(seen).encode()).hexdigest()

    @property
    def orders_with_lines(self) -> DataFrame:
        """Every order with its lines as an array in the order of their numbers, null where it has none."""
        if not self.store:
            return self._orders_with_lines()
        with self._storing:  # the fields are read side by side
            return kept_stage(self.spark, self.store, "orders_with_lines", self._orders_with_lines)

    def _orders_with_lines(self) -> DataFrame:
        # Lines without a key belong to no order; an order's lines are few, so they are dealt as they are.
        # Only the day of shipping is read; it is shorter than the time.
        kept = self.table("lineitem").where("l_orderkey IS NOT NULL").withColumn("l_shipdate", F.to_date("l_shipdate"))
        lines = (
            deal(kept.select("l_orderkey", *_LINE), "l_orderkey")
            .groupBy("l_orderkey")
            .agg(F.array_sort(F.collect_list(F.struct(*_LINE))).alias("lines"))
        )
        return self.table("orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")

    @cached_property
    def order_lines(self) -> DataFrame:
        if self.store:
            orders = self.orders_with_lines
            return orders.select(*[c for c in orders.columns if c != "lines"], F.inline("lines"))
        return self.table("lineitem").join(
            self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")
        )

    @cached_property
    def affiliate_events(self) -> DataFrame:
        return self._events(self.order_lines.withColumns(_event_keys()))

    @property
    def dealt_events(self) -> DataFrame | None:
        """`affiliate_events` dealt by user and transaction, where orders are stored with their lines; else none.

        Orders are dealt before their lines are taken apart, so that each moves its own columns once, and
        by the texts of their keys without moving these texts.
        """
        if not self.store:
            return None
        lines = F.transform("lines", lambda line: F.struct(*[line[c].alias(c) for c in _EVENT_LINE]))
        kept = ("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority")
        orders = self.orders_with_lines.select(*kept, lines.alias("lines"))
        return self._events(deal(orders, *_event_keys().values()).select(*kept, F.inline("lines")).withColumns(_event_keys()))

    def _events(self, lines: DataFrame) -> DataFrame:
        action = F.when(
            (F.col("o_orderpriority") == "5-LOW"),
            F.when(F.col("l_linestatus") == "F", labels.PAY_ACTION).otherwise("other"),
        )
        for priority, code in _ACTIONS.items():
            action = action.when(F.col("o_orderpriority") == priority, code)
        shopping = (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O") & (F.col("o_orderpriority") == "4-NOT SPECIFIED")
        return lines.select(
            F.to_date("o_orderdate").alias("event_dt"),
            F.col("o_orderdate").alias("event_dttm"),
            "user_id",
            F.concat(F.lit("D"), F.col("l_suppkey")).alias("airbridge_device_id"),
            F.when(F.col("l_linestatus") == "O", "iOS").otherwise("Android").alias("platform"),
            "transaction_id",
            F.when(F.col("l_returnflag") == "R", labels.ORDER_CANCEL)
            .otherwise(labels.ORDER_COMPLETE)
            .alias("event_category"),
            F.when(shopping, labels.SHOPPING_LABEL).otherwise(F.col("l_linestatus")).alias("event_label"),
            action.alias("event_action"),
            F.concat(F.lit("item "), F.col("l_partkey")).alias("name"),
            F.col("l_extendedprice").alias("price"),
        )

    @cached_property
    def partner_orders(self) -> DataFrame:
        return self.order_lines.where(F.col("l_returnflag") != "R").select(
            F.to_date("o_orderdate").alias("date"),
            F.col("o_custkey").cast("string").alias("subParam"),
            F.concat(F.lit("item "), F.col("l_partkey")).alias("productName"),
            (F.col("l_extendedprice") * F.col("l_discount")).alias("commission"),
        )

    @cached_property
    def partner_cancels(self) -> DataFrame:
        return self.order_lines.where(F.col("l_returnflag") == "R").select(
            F.date_format("l_shipdate", "yyyyMMdd").alias("date"),
            F.to_date("o_orderdate").alias("orderDate"),
            F.col("o_custkey").cast("string").alias("subParam"),
            (-F.col("l_extendedprice") * F.col("l_discount")).alias("commission"),
        )

    @cached_property
    def product_keywords(self) -> DataFrame:
        size = F.col("p_size")
        return self.table("part").select(
            F.concat(F.lit("item "), F.col("p_partkey")).alias("name"),
            F.when(size == 1, labels.NO_CATEGORY_TEXT)
            .when(size == 2, " ")
            .when(size == 3, F.lit(None).cast("string"))
            .when(F.col("p_type") == "PROMO", "PROMO/SALE")
            .otherwise(F.col("p_type"))
            .alias("category1"),
            F.when(size > 45, F.lit(None).cast("string")).when(size > 40, "").otherwise(F.col("p_brand")).alias("category2"),
        )

    @cached_property
    def app_members(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").cast("string").alias("user_id"),
            F.col("c_mktsegment").alias("platform"),
            F.date_add(F.lit(ORDERS_START).cast("date"), F.col("c_nationkey") * 30).alias("join_dt"),
            F.floor(F.abs("c_acctbal") * 10).cast("bigint").alias("total_accumulate_cash"),
            F.floor("c_acctbal").cast("bigint").alias("current_cash"),
            F.when(F.col("c_acctbal") < 0, "N").otherwise("Y").alias("terms_agree_yn"),
        )

    @cached_property
    def mall_orders(self) -> DataFrame:
        def option(line: Column) -> Column:
            status = (
                F.when(F.col("o_orderstatus") == "F", "BUY_CONFIRM")
                .when(F.col("o_orderstatus") == "O", "DELIVERY_ING")
                .when(line["l_returnflag"] == "R", "RETURN_DONE")
                .when(line["l_returnflag"] == "A", "CANCEL DONE")
                .otherwise("PAY_WAIT")
            )
            return F.struct((line["l_discount"] * 100).alias("commission_rate"), status.alias("order_status_type"))

        return self.orders_with_lines.select(
            F.to_date("o_orderdate").alias("order_dt"),
            F.col("o_orderkey").alias("order_no"),
            F.col("o_custkey").alias("member_no"),
            F.try_element_at("lines", F.lit(1))["l_partkey"].alias("category_no"),
            F.col("o_totalprice").alias("first_pay_amt"),
            F.transform(F.coalesce("lines", F.array()), option).alias("product_option"),
        )

    @cached_property
    def mall_members(self) -> DataFrame:
        region = F.col("n_regionkey")
        nation = F.col("c_nationkey")
        return (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                F.col("c_custkey").alias("member_no"),
                F.when(nation != 13, F.col("c_custkey").cast("string")).alias("wk_id"),
                F.when(region.isin(0, 2), "F").when(region.isin(1, 3), "M").alias("gender"),
                F.when(nation == 7, "unknown")
                .otherwise((1950 + F.col("c_custkey") % 50).cast("string"))
                .alias("birth_year"),
            )
        )

    @cached_property
    def mall_categories(self) -> DataFrame:
        ptype = F.col("p_type")
        return self.table("part").select(
            (F.ascii(ptype) * 100 + F.length(ptype)).alias("depth1_category_no"),
            F.when(ptype == "PROMO", "PROMO/SALE").otherwise(ptype).alias("depth1_category_name"),
            F.when(F.col("p_size") > 45, F.lit(None).cast("string"))
            .when(F.col("p_size") > 40, "")
            .otherwise(F.col("p_brand"))
            .alias("depth2_category_name"),
            (F.col("p_partkey") + 1).alias("depth3_category_no"),
            F.col("p_partkey").alias("depth4_category_no"),
        )

    @cached_property
    def reward_ledger(self) -> DataFrame:
        # The log is moved back 24 years, into the time of the orders.
        return self.table("events").select(
            F.col("user_id").alias("member_no"),
            F.floor("value").cast("bigint").alias("amt"),
            F.when(F.col("event_type") == "purchase", labels.LEDGER_CREDITS[1])
            .when(F.col("event_type") == "click", labels.LEDGER_CREDITS[0])
            .when(F.col("event_type") == "error", labels.LEDGER_DEBITS[0])
            .otherwise(F.col("event_type"))
            .alias("accumulation_status"),
            (F.col("ts") - F.expr("INTERVAL '24' YEAR")).alias("register_dttm"),
        )

    @cached_property
    def offerwall_rfm(self) -> DataFrame:
        seen = F.to_date("ts")
        return (
            self.table("events")
            .groupBy(F.col("user_id").cast("string").alias("user_id"))
            .agg(
                F.datediff(F.lit(EVENTS_AS_OF).cast("date"), F.max(seen)).cast("bigint").alias("recency"),
                F.countDistinct(seen).alias("frequency"),
                F.round(F.sum("value"), 2).alias("monetary"),
            )
        )

    @cached_property
    def app_events(self) -> DataFrame:
        # Sign-ups carry no details: an empty array.
        detail = F.filter(
            F.array(F.struct(F.col("props").alias("detail")), F.struct(F.col("event_type").alias("detail"))),
            lambda x: F.col("event_type") != "signup",
        )
        return self.table("events").select(
            F.col("user_id").cast("string").alias("user_id"),
            F.to_date("ts").alias("event_dt"),
            F.col("event_type").alias("event_category"),
            F.col("props").alias("event_action"),
            F.lit("").alias("event_label"),
            detail.alias("event_detail"),
        )
