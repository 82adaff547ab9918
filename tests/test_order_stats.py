import random
from collections import Counter

from pyspark.sql import Window, functions as F

from patronage.functions import order_stats
from patronage.functions.order_stats import TileSpec, add_tiles, percentiles


def rows(spark, n=600, seed=1):
    """A third of the keys share one value, some are null."""
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        key = 7.0 if i % 3 == 0 else None if i % 17 == 0 else float(rnd.randint(0, 40))
        data.append((f"u{i:05d}", key, rnd.choice("abc")))
    data.append((None, 3.0, "a"))
    return spark.createDataFrame(data, "user_id string, x double, g string")


def test_tiles_equal_ntile_with_ties_nulls_and_hot_values(spark):
    df = rows(spark).repartition(5).cache()
    x = F.col("x")
    specs = {
        "up": TileSpec(x, 10),
        "down": TileSpec(x, 9, descending=True),
        "some": TileSpec(x, 9, descending=True, member=x > 5),
    }
    got = add_tiles(df, specs, "user_id")
    want = (
        got.withColumn("w_up", F.ntile(10).over(Window.orderBy(F.asc_nulls_first("x"), "user_id")))
        .withColumn("w_down", F.ntile(9).over(Window.orderBy(F.desc_nulls_last("x"), "user_id")))
        .withColumn(
            "w_some",
            F.when(x > 5, F.ntile(9).over(Window.partitionBy(x > 5).orderBy(F.desc("x"), "user_id"))),
        )
    )
    wrong = want.where(
        ~F.col("up").eqNullSafe(F.col("w_up"))
        | ~F.col("down").eqNullSafe(F.col("w_down"))
        | ~F.col("some").eqNullSafe(F.col("w_some"))
    )
    assert wrong.collect() == []
    sizes = Counter(r.up for r in got.select("up").collect()).values()
    assert max(sizes) - min(sizes) <= 1


def test_fewer_rows_than_tiles_and_no_rows(spark):
    df = spark.createDataFrame([("a", 2.0), ("b", 1.0), ("c", 3.0)], "user_id string, x double")
    got = {r.user_id: r.t for r in add_tiles(df, {"t": TileSpec(F.col("x"), 10)}, "user_id").collect()}
    assert got == {"b": 1, "a": 2, "c": 3}
    none = add_tiles(df, {"t": TileSpec(F.col("x"), 9, member=F.col("x") > 99)}, "user_id")
    assert {r.t for r in none.collect()} == {None}


def test_percentiles_equal_the_exact_aggregate(spark):
    df = rows(spark).cache()
    probs = [0.0, 0.2, 0.5, 0.95, 1.0]
    got = percentiles(df, {"x": F.col("x"), "y": F.col("x") * 2}, probs, "user_id").first()
    want = df.agg(F.percentile("x", probs).alias("x"), F.percentile(F.col("x") * 2, probs).alias("y")).first()
    assert [round(v, 9) for v in got.x] == [round(v, 9) for v in want.x]
    assert [round(v, 9) for v in got.y] == [round(v, 9) for v in want.y]
    by = {r.g: [round(v, 9) for v in r.x] for r in percentiles(df, {"x": F.col("x")}, probs, "user_id", "g").collect()}
    exact = df.groupBy("g").agg(F.percentile("x", probs).alias("x")).collect()
    assert by == {r.g: [round(v, 9) for v in r.x] for r in exact}


def test_tiling_sorts_and_stores_nothing(spark):
    df = rows(spark)
    for out in (add_tiles(df, {"t": TileSpec(F.col("x"), 10)}, "user_id"), percentiles(df, {"x": F.col("x")}, [0.5], "user_id")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not any(step in plan for step in ("Window", "Exchange", "Sort", "ntile"))


def test_large_and_skewed_keys_are_narrowed(spark, monkeypatch):
    """Intervals larger than SMALL, one key on a third of the rows, long ids that share their first bytes, infinities."""
    monkeypatch.setattr(order_stats, "SMALL", 20)
    rnd = random.Random(4)
    data = []
    for i in range(3000):
        key = 5.0 if i % 3 == 0 else rnd.choice([None, float("inf"), -float("inf"), -0.0, 0.0]) if i % 11 == 0 else rnd.lognormvariate(0, 3)
        data.append((f"customer-{rnd.random():.17f}-{i:04d}", key))
    data += [(None, 5.0), ("", 5.0), ("é", 5.0), ("customer-", 5.0)]
    df = spark.createDataFrame(data, "user_id string, x double").repartition(4).cache()
    x = F.col("x")
    got = add_tiles(df, {"up": TileSpec(x, 10), "down": TileSpec(x, 9, descending=True)}, "user_id")
    want = got.withColumns(
        {
            "w_up": F.ntile(10).over(Window.orderBy(F.asc_nulls_first("x"), "user_id")),
            "w_down": F.ntile(9).over(Window.orderBy(F.desc_nulls_last("x"), "user_id")),
        }
    )
    assert want.where("up != w_up OR down != w_down").collect() == []
    probs = [0.0, 0.001, 0.333, 0.5, 0.6, 0.999]
    finite = df.where("abs(x) < 1e300")
    exact = finite.agg(F.percentile("x", probs).alias("x")).first().x
    assert [round(v, 9) for v in percentiles(finite, {"x": x}, probs, "user_id").first().x] == [round(v, 9) for v in exact]


def test_percentiles_of_nothing(spark):
    df = rows(spark)
    assert percentiles(df.where("x > 99"), {"x": F.col("x")}, [0.5]).first().x == [None]
    assert percentiles(df.where("x > 99"), {"x": F.col("x")}, [0.5], by="g").collect() == []
