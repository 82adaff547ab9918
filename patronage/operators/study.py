"""Weight study: how well a weighted score follows an adjusted lifetime value.

Works on the flat records of a history snapshot (`history_at`).  The lifetime value
is computed once; correlations of any weighted score follow from the covariances of
the six scores and the value, so trying a weight vector does not touch the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from patronage.functions import labels
from patronage.functions.order_stats import percentiles
from patronage.functions.scalars import safe_divide, safe_double
from patronage.functions.stages import cut

SCORES = list(labels.SCORE_NAMES)
_MEDIAN_FILLED = ["current_trailing_term", "m_data", "predicted_survival_time"]
# Weights are whole multiples of 1/320; the search refines 16 -> 4 -> 1.
_UNITS = 320
_STEPS = (16, 4, 1)
_HASH_PRIME = 2_147_483_647
# Starts of the gradient search, its steps and their length.
STARTS, GRADIENT_STEPS, GRADIENT_STEP = 10, 400, 0.05


def preprocess_fill(records: DataFrame, id_col: str = "user_id") -> DataFrame:
    """Numbers from text where needed; gaps filled with the median (term, money,
    survival time) or the least value (scores)."""
    numeric = records.withColumns({c: safe_double(F.col(c).cast("string")) for c in _MEDIAN_FILLED + SCORES})
    medians = percentiles(numeric, {c: F.col(c) for c in _MEDIAN_FILLED}, [0.5], id_col)
    least = numeric.agg(*[F.min(c).alias(c) for c in SCORES])
    stand_in = medians.select(F.struct(*[F.col(c)[0].alias(c) for c in _MEDIAN_FILLED]).alias("_m")).crossJoin(
        F.broadcast(least.select(F.struct(*SCORES).alias("_s")))
    )
    filled = {c: F.coalesce(F.col(c), F.col(f"_m.{c}")) for c in _MEDIAN_FILLED}
    filled |= {c: F.coalesce(F.col(c), F.col(f"_s.{c}")) for c in SCORES}
    return numeric.crossJoin(F.broadcast(stand_in)).withColumns(filled).drop("_m", "_s")


def train_test_split(records: DataFrame, test_percent: int = 20, id_col: str = "user_id") -> DataFrame:
    """Adds split = 'test' or 'train' from a hash of the id: the same on every run."""
    bucket = F.conv(F.substring(F.md5(F.col(id_col)), 1, 8), 16, 10).cast("bigint") % 100
    return records.withColumn("split", F.when(bucket < test_percent, "test").otherwise("train"))


def adjusted_ltv(records: DataFrame, by: str | None = None, id_col: str = "user_id") -> DataFrame:
    """Adds adjusted_ltv.

    Repurchasers (more than one purchase day) and single buyers take different
    branches in every factor.  Money per purchase is scaled by its median and capped
    at its 95th percentile, the product is capped at the 97th percentile for
    repurchasers and the 95th for others; percentiles are over all rows (of a group).
    `records` is read several times: pass a stored table.
    """
    f, m = F.col("f_data").cast("double"), F.col("m_data").cast("double")
    term = F.col("current_trailing_term")
    again = f > 1

    def nonzero(stand_in: float) -> Column:
        return F.when(term == 0, stand_in).otherwise(term)

    quality = F.when(again, safe_divide(m, f) * F.log1p(f)).otherwise(m * labels.LTV_SINGLE_QUALITY)
    rows = records.withColumn("_quality", quality)
    scale = percentiles(rows, {"_q": F.col("_quality")}, list(labels.LTV_SCALE_PERCENTILES), id_col, by)
    rows = rows.join(scale, by) if by else rows.crossJoin(F.broadcast(scale))
    median, p95 = F.col("_q")[0], F.col("_q")[1]
    norm = F.least(F.greatest(safe_divide(F.col("_quality"), median), F.lit(0.0)), safe_divide(p95, median))

    def either(repeated, single) -> Column:
        return F.when(again, repeated).otherwise(single)

    cycle_weight = either(*labels.LTV_CYCLE_WEIGHT) / F.sqrt(nonzero(labels.LTV_LEAST_CYCLE))
    exponent, constant = labels.LTV_FREQUENCY
    frequency_factor = either(F.pow(f, F.lit(exponent)), constant)
    per_cycle = safe_divide(m, nonzero(1.0)) * either(*labels.LTV_PER_CYCLE)
    survival = F.col("predicted_survival_time") * cycle_weight * either(1 + F.log1p(f) * labels.LTV_SURVIVAL_GAIN, 1.0)
    multiplier = either(1 + F.log1p(f) * labels.LTV_GAIN, labels.LTV_SINGLE)
    raw = per_cycle * survival * (1 + frequency_factor) * norm * multiplier
    rows = rows.withColumn("_ltv", raw).drop("_quality", "_q")
    caps = percentiles(rows, {"_cap": F.col("_ltv")}, list(labels.LTV_CAP_PERCENTILES), id_col, by)
    rows = rows.join(caps, by) if by else rows.crossJoin(F.broadcast(caps))
    cap = F.when(again, F.col("_cap")[0]).otherwise(F.col("_cap")[1])
    return rows.withColumn("adjusted_ltv", F.least(F.greatest(F.col("_ltv"), F.lit(0.0)), cap)).drop("_ltv", "_cap")


def weighted_score(weights) -> Column:
    out = None
    for name, w in zip(SCORES, weights):
        w = w if isinstance(w, Column) else F.lit(float(w))
        out = F.col(name) * w if out is None else out + F.col(name) * w
    return out


def moments(valued: DataFrame, by: str | None = None) -> DataFrame:
    """Covariances of the scores among themselves and with the value, and the value's
    variance: 28 numbers per group, from one pass."""
    cols = ["var_samp(adjusted_ltv) as ltv_var", "count(1) as n"]
    for i, a in enumerate(SCORES):
        cols.append(f"covar_samp({a}, adjusted_ltv) as c{i}")
        cols += [f"covar_samp({a}, {SCORES[j]}) as v{i}{j}" for j in range(i, len(SCORES))]
    return valued.groupBy(*([by] if by else [])).agg(*map(F.expr, cols))


def score_corr(weights: list[Column]) -> Column:
    """Correlation of the weighted score with the value, from the moments."""
    with_value, own = None, None
    for i, w in enumerate(weights):
        t = w * F.col(f"c{i}")
        with_value = t if with_value is None else with_value + t
        for j in range(i, len(weights)):
            t = w * weights[j] * F.col(f"v{i}{j}") * (1 if i == j else 2)
            own = t if own is None else own + t
    return safe_divide(with_value, F.sqrt(own) * F.sqrt("ltv_var"))


def objective(weights: list[Column], importance=labels.STUDY_IMPORTANCE) -> Column:
    """Correlation + importance bonus - 0.1 x variance of the weights."""
    n = len(weights)
    mean = sum(weights[1:], weights[0]) / n
    squares = [(w - mean) * (w - mean) for w in weights]
    spread = sum(squares[1:], squares[0]) / n
    out = score_corr(weights) - 0.1 * spread
    if importance is not None:
        terms = [w * float(b) for w, b in zip(weights, importance)]
        out = out + sum(terms[1:], terms[0])
    return out


def _weights_from_units() -> list[Column]:
    return [F.col(f"u{i}") / F.lit(float(_UNITS)) for i in range(len(SCORES))]


def _best(candidates: DataFrame, mom: DataFrame) -> DataFrame:
    """The candidate with the greatest objective; one row.  Candidate tables are fixed
    in size, whatever the number of users."""
    units = [f"u{i}" for i in range(len(SCORES))]
    tried = candidates.select(*units).crossJoin(F.broadcast(mom)).withColumn("objective", objective(_weights_from_units()))
    order = [F.desc(F.round("objective", 12)), *units]
    return tried.orderBy(*order).limit(1).select(*units, "objective")


def weight_search(mom: DataFrame, least=labels.STUDY_MIN_WEIGHTS) -> DataFrame:
    """Weights that sum to 1 and respect the least weights with the greatest objective.

    A grid over the simplex in steps of 0.05, then two finer grids around the winner
    (0.0125 and 0.003125).  One row: w0..w5, objective, correlation.
    """
    spark = mom.sparkSession
    mom = cut(mom)
    n = len(SCORES)
    low = [round(w * _UNITS) for w in least]
    step = _STEPS[0]
    free = (_UNITS - sum(low)) // step
    grid = spark.range(1).select(F.lit(free).alias("left"))
    for i in range(n - 1):
        grid = grid.withColumn(f"k{i}", F.explode(F.sequence(F.lit(0), F.col("left"))))
        grid = grid.withColumn("left", F.col("left") - F.col(f"k{i}"))
    start = grid.select(
        *[(F.lit(low[i]) + F.col(f"k{i}" if i < n - 1 else "left") * step).alias(f"u{i}") for i in range(n)]
    )
    best = cut(_best(start, mom))
    for step in _STEPS[1:]:
        near = best
        for i in range(n - 1):
            near = near.withColumn(f"d{i}", F.explode(F.sequence(F.lit(-4 * step), F.lit(4 * step), F.lit(step))))
        moved = [(F.col(f"u{i}") + F.col(f"d{i}")).alias(f"u{i}") for i in range(n - 1)]
        rest = F.lit(_UNITS)
        for i in range(n - 1):
            rest = rest - F.col(f"u{i}") - F.col(f"d{i}")
        near = near.select(*moved, rest.alias(f"u{n - 1}"))
        for i in range(n):
            near = near.where(F.col(f"u{i}").between(low[i], _UNITS))
        best = cut(_best(near, mom))
    return best.crossJoin(F.broadcast(mom)).select(
        *[w.alias(f"w{i}") for i, w in enumerate(_weights_from_units())],
        "objective",
        score_corr(_weights_from_units()).alias("correlation"),
    )


def _bound(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def _projected(weights: list[Column], least) -> Column:
    """The nearest weights that sum to 1 and respect the least ones, as an array."""
    over = [w - float(low) for w, low in zip(weights, least, strict=True)]
    spare = 1 - float(sum(least))

    def shifted(r: Column) -> Column:
        total, levels = F.lit(-spare), []
        for k in range(len(over)):
            total = total + r["order"][k]
            levels.append(total / float(k + 1))
        level = F.greatest(*levels)
        return _bound(level, lambda x: F.array(*[F.greatest(r["over"][i] - x, F.lit(0.0)) + float(low) for i, low in enumerate(least)]))

    taken = F.array(*over)
    return _bound(taken, lambda a: _bound(F.struct(a.alias("over"), F.sort_array(a, asc=False).alias("order")), shifted))


def _start_weights(first, least) -> Column:
    """Weights of start `start`: the given ones, then ones drawn from a hash."""

    def draw(i: int) -> Column:
        name = F.concat(F.col("start").cast("string"), F.lit(f"|{i}"))
        return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / float(2**32)

    drawn = [F.when(F.col("start") == 0, F.lit(float(w))).otherwise(draw(i)) for i, w in enumerate(first)]
    return _projected(drawn, least)


def gradient_search(
    mom: DataFrame,
    least=labels.STUDY_MIN_WEIGHTS,
    first=labels.STUDY_START_WEIGHTS,
    importance=labels.STUDY_IMPORTANCE,
    starts: int = STARTS,
    steps: int = GRADIENT_STEPS,
) -> DataFrame:
    """Projected gradient ascent of the objective from several starts: start, w0..w5, objective, best.

    Each start takes a fixed number of steps over the 28 moments and reports the best
    weights it passed; `best` marks the first start with the greatest objective (to 6
    places).  Without variance of the scores or the value the objective is null and the
    weights are those of the start.
    """
    n = len(SCORES)
    mom = mom.select(
        F.array(*[F.array(*[F.col(f"v{min(i, j)}{max(i, j)}") for j in range(n)]) for i in range(n)]).alias("cov"),
        F.array(*[F.col(f"c{i}") for i in range(n)]).alias("with_value"),
        F.sqrt("ltv_var").alias("value_dev"),
    )

    def dot(a, b) -> Column:
        terms = [a(i) * b(i) for i in range(n)]
        return sum(terms[1:], terms[0])

    def step(state: Column, _: Column) -> Column:
        w = [state["w"][i] for i in range(n)]
        slope = F.array(*[dot(lambda j, i=i: F.col("cov")[i][j], lambda j: w[j]) for i in range(n)])

        def moved(r: Column) -> Column:
            common, own = dot(lambda i: F.col("with_value")[i], lambda i: w[i]), dot(lambda i: r[i], lambda i: w[i])
            mean = sum(w[1:], w[0]) / float(n)
            spread = dot(lambda i: w[i] - mean, lambda i: w[i] - mean) / float(n)
            bonus = dot(lambda i: w[i], lambda i: F.lit(float(importance[i])))
            known = (own > 0) & (F.col("value_dev") > 0)
            scalars = F.struct(
                common.alias("common"),
                own.alias("own"),
                mean.alias("mean"),
                F.when(known, common / (F.sqrt(own) * F.col("value_dev")) - 0.1 * spread + bonus).alias("objective"),
            )

            def ahead(x: Column) -> Column:
                rise = [
                    (F.col("with_value")[i] - x["common"] * r[i] / x["own"]) / (F.sqrt(x["own"]) * F.col("value_dev"))
                    - 0.2 * (w[i] - x["mean"]) / float(n)
                    + float(importance[i])
                    for i in range(n)
                ]
                to = F.when(x["objective"].isNull(), state["w"]).otherwise(_projected([w[i] + GRADIENT_STEP * g for i, g in enumerate(rise)], least))
                better = x["objective"].isNotNull() & (state["objective"].isNull() | (x["objective"] > state["objective"]))
                return F.struct(
                    to.alias("w"),
                    F.when(better, state["w"]).otherwise(state["best"]).alias("best"),
                    F.when(better, x["objective"]).otherwise(state["objective"]).alias("objective"),
                )

            return _bound(scalars, ahead)

        return _bound(slope, moved)

    table = mom.sparkSession.range(0, starts, 1, 1).select(F.col("id").alias("start")).withColumn("w", _start_weights(first, least))
    empty = F.struct(F.col("w"), F.col("w").alias("best"), F.lit(None).cast("double").alias("objective"))
    climbed = table.crossJoin(F.broadcast(mom)).withColumn("end", F.aggregate(F.sequence(F.lit(0), F.lit(steps)), empty, step))
    ends = cut(climbed.select("start", *[F.col("end.best")[i].alias(f"w{i}") for i in range(n)], "end.objective"))
    # One row per start.
    top = ends.agg(F.min_by("start", F.struct(F.coalesce(-F.round("objective", 6), F.lit(float("inf"))).alias("o"), "start")).alias("top"))
    return ends.crossJoin(F.broadcast(top)).withColumn("best", F.col("start") == F.col("top")).drop("top")


def weight_compare(mom_by_split: DataFrame, found: DataFrame, start=labels.STUDY_START_WEIGHTS) -> DataFrame:
    """Correlation of the starting and the found weights with the value, per split."""
    original = score_corr([F.lit(float(w)) for w in start])
    optimized = score_corr([F.col(f"w{i}") for i in range(len(SCORES))])
    return mom_by_split.crossJoin(F.broadcast(found.drop("objective", "correlation"))).select(
        "split", original.alias("original_corr"), optimized.alias("optimized_corr")
    )


PAIRS = ("original", "optimized")
SUMS = ("n", "x", "y", "xx", "yy", "xy")
_DRAWN_ROWS = 1024  # rows whose masks are held at once


def draws(a: np.ndarray, b: np.ndarray, replicates: int, keep: float) -> np.ndarray:
    """Which rows take part in replicates 1.., as (rows, replicates): (a + b x replicate) mod p below keep x p, p = 2**31 - 1."""
    x = a[:, None] + b[:, None] * np.arange(1, replicates + 1)
    x = (x & _HASH_PRIME) + (x >> 31)  # the same modulo p
    return np.where(x >= _HASH_PRIME, x - _HASH_PRIME, x) < int(keep * _HASH_PRIME)


def _replicate_sums(replicates: int, keep: float):
    """Sums of every replicate over a task's rows (a, b, y and a score per pair)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((replicates, len(PAIRS) * len(SUMS)))
        for batch in batches:
            for lo in range(0, batch.num_rows, _DRAWN_ROWS):
                part = batch.slice(lo, _DRAWN_ROWS)
                value = {c: part[c].to_numpy(zero_copy_only=False).astype(np.float64) for c in ("y", *PAIRS)}
                columns = []
                for pair in PAIRS:
                    known = ~(np.isnan(value["y"]) | np.isnan(value[pair]))
                    x, y = np.where(known, value[pair], 0), np.where(known, value["y"], 0)
                    columns += [known, x, y, x * x, y * y, x * y]
                taken = draws(part["a"].to_numpy(), part["b"].to_numpy(), replicates, keep)
                total += taken.T.astype(np.float64) @ np.stack(columns, axis=1).astype(np.float64)
        rows = [pa.array(np.arange(1, replicates + 1)), *(pa.array(c) for c in total.T.copy())]
        yield pa.RecordBatch.from_arrays(rows, ["rep", *(f"{p}_{s}" for p in PAIRS for s in SUMS)])

    return run


def bootstrap_corr(
    valued: DataFrame,
    found: DataFrame,
    start=labels.STUDY_START_WEIGHTS,
    replicates: int = 1000,
    keep: float = 0.8,
    id_col: str = "user_id",
) -> DataFrame:
    """95 % interval of both correlations over random subsets of the rows, and the mean gain; one row.

    Every row takes part in a replicate with probability `keep`, decided by hashes of its
    id: pairwise independent over the replicates and the same on every run and retry (rows
    without an id are drawn together).  A task adds up the sums of all replicates while it
    reads its rows, some 10 microseconds a row for 1,000 replicates, and passes on one row
    per replicate; no row is multiplied.
    """
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))

    def part(at: int) -> Column:
        return F.conv(F.substring(digest, at, 8), 16, 10).cast("bigint") % _HASH_PRIME

    scores = {"original": weighted_score(start), "optimized": weighted_score([F.col(f"w{i}") for i in range(len(SCORES))])}
    scored = valued.crossJoin(F.broadcast(found)).select(
        part(1).alias("a"), part(9).alias("b"), F.col("adjusted_ltv").cast("double").alias("y"), *[scores[p].cast("double").alias(p) for p in PAIRS]
    )
    mean = scored.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(f"mean_{c}") for c in ("y", *PAIRS)])
    # Sums of squares are taken around the means of all rows, so that large values leave digits to them.
    centred = scored.crossJoin(F.broadcast(mean)).select("a", "b", *[(F.col(c) - F.col(f"mean_{c}")).alias(c) for c in ("y", *PAIRS)])
    names = [f"{p}_{s}" for p in PAIRS for s in SUMS]
    sums = centred.mapInArrow(_replicate_sums(replicates, keep), "rep bigint, " + ", ".join(f"{n} double" for n in names))
    totals = sums.groupBy("rep").agg(*[F.sum(n).alias(n) for n in names])

    def corr(p: str) -> Column:
        n, x, y, xx, yy, xy = (F.col(f"{p}_{s}") for s in SUMS)
        return safe_divide(xy - safe_divide(x * y, n), F.sqrt((xx - safe_divide(x * x, n)) * (yy - safe_divide(y * y, n))))

    per_rep = totals.select("rep", *[corr(p).alias(p) for p in PAIRS])
    ends = [0.025, 0.975]
    return per_rep.agg(
        F.percentile("original", ends).alias("o"),
        F.percentile("optimized", ends).alias("p"),
        (F.avg("optimized") - F.avg("original")).alias("improvement"),
    ).select(
        F.col("o")[0].alias("original_low"),
        F.col("o")[1].alias("original_high"),
        F.col("p")[0].alias("optimized_low"),
        F.col("p")[1].alias("optimized_high"),
        "improvement",
    )
