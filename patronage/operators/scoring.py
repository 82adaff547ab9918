"""Scores by tiles, weighted total, percentile cuts and grades."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from patronage.functions import labels
from patronage.functions.order_stats import TileSpec, add_tiles, percentiles
from patronage.functions.scalars import age_group, day, grade_ladder, join_group, safe_divide
from patronage.sources.schemas import RANKING_COLUMNS

_SUFFIX = {"affiliate": "byshop", "mall": "shop"}
_CATEGORY_SUFFIX = {"affiliate": "bs", "mall": "sp"}


def score_specs(suffix: str) -> dict[str, TileSpec]:
    """The six tilings over the users who bought in the channel."""
    recency, frequency, money = (F.col(f"{c}_{suffix}") for c in "rfm")
    term, prev = F.col(f"current_trailing_term_{suffix}"), F.col(f"prev_trailing_term_{suffix}")
    return {
        "r_score": TileSpec(recency, 10, descending=True),
        "f_score": TileSpec(F.ln(frequency), 9, member=frequency > 1),
        "m_score": TileSpec(money, 10),
        "term_score": TileSpec(term, 9, descending=True, member=term.isNotNull()),
        "term_diff_score": TileSpec(term - prev, 9, descending=True, member=(term - prev).isNotNull()),
        "volatility_score": TileSpec(F.col(f"cycle_stddev_{suffix}"), 9, descending=True, member=term.isNotNull()),
    }


def add_scores(users: DataFrame, suffix: str, only: list[str] | None = None) -> DataFrame:
    """Scores 1-10.  Nine-tile scores start at 2; users they do not apply to get 1.

    Volatility tiles every user with a term but shows 1 where the previous term is
    unknown.  Reads `users` twice: pass a stored table.
    """
    specs = {n: s for n, s in score_specs(suffix).items() if only is None or n in only}
    frequency = F.col(f"f_{suffix}")
    term, prev = F.col(f"current_trailing_term_{suffix}"), F.col(f"prev_trailing_term_{suffix}")
    shift = {
        "f_score": frequency == 1,
        "term_score": term.isNull(),
        "term_diff_score": prev.isNull(),
        "volatility_score": prev.isNull(),
    }
    tiled = add_tiles(users, specs, "user_id")
    return tiled.withColumns(
        {n: F.when(lowest, 1).otherwise(F.col(n) + 1) for n, lowest in shift.items() if n in specs}
    )


def total_score(weights=labels.SCORE_WEIGHTS, names=labels.SCORE_NAMES) -> Column:
    """Weighted sum of the scores to two places, in decimal arithmetic so that a half
    is a half; unknown secondary scores count 1."""
    total = None
    for name, w in zip(names, weights):
        value = F.col(name) if name in names[:3] else F.coalesce(F.col(name), F.lit(1))
        part = value.cast("decimal(4,0)") * F.lit(str(w)).cast("decimal(6,4)")
        total = part if total is None else total + part
    return F.round(total, 2).cast("double")


def score_cuts(scored: DataFrame, score: str = "total_score") -> DataFrame:
    """Interpolated percentiles 0.4 / 0.7 / 0.9 of the total score; one row.

    Totals are sums of three scores 1-10 under fixed weights: about a thousand
    values, whose counts are all the aggregate keeps.
    """
    cuts = F.percentile(score, [p for p, _ in reversed(labels.GRADE_PERCENTILES)])
    return scored.agg(cuts.alias("c")).select(*[F.col("c")[i].alias(f"cut{i + 1}") for i in range(3)])


def assign_grades(scored: DataFrame, cuts: DataFrame, score: str = "total_score") -> DataFrame:
    """Grade by the cuts a score exceeds; adds cut1..cut3 and grade."""
    ladder = [(F.col(f"cut{3 - i}"), g) for i, (_, g) in enumerate(labels.GRADE_PERCENTILES)]
    return scored.crossJoin(F.broadcast(cuts)).withColumn("grade", grade_ladder(F.col(score), ladder))


def grade_by_thresholds(scored: DataFrame, thresholds=labels.GRADE_THRESHOLDS, score: str = "total_score") -> DataFrame:
    """Grade by fixed thresholds, e.g. those of an earlier period."""
    return scored.withColumn("grade", grade_ladder(F.col(score), thresholds))


def grade_by_quantiles(scored: DataFrame, column: str, id_col: str = "user_id") -> DataFrame:
    """Grade by the percentiles of any column, which may hold many distinct values."""
    cuts = percentiles(scored, {"q": F.col(column)}, [p for p, _ in labels.GRADE_PERCENTILES], id_col)
    ladder = [(F.col("q")[i], g) for i, (_, g) in enumerate(labels.GRADE_PERCENTILES)]
    return scored.crossJoin(F.broadcast(cuts)).withColumn("grade", grade_ladder(F.col(column), ladder)).drop("q")


def scored_snapshot(
    merged: DataFrame, track: str, as_of: date | str, weights=labels.SCORE_WEIGHTS
) -> DataFrame:
    """Merged rows of the channel's buyers with scores, cuts and grade.

    `merged` should be a stored table; the scores are read twice (cuts, rows), but
    only cost a pass over it each.
    """
    sfx, cat = _SUFFIX[track], _CATEGORY_SUFFIX[track]
    mall = track == "mall"
    users = merged.where(F.col(f"f_{sfx}") > 0)
    scored = add_scores(users, sfx).withColumn("total_score", total_score(weights))
    graded = assign_grades(scored, score_cuts(scored))
    term, prev = F.col(f"current_trailing_term_{sfx}"), F.col(f"prev_trailing_term_{sfx}")
    return graded.select(
        "tgt",
        "user_id",
        "gender",
        join_group(F.col("join_dt")).alias("join_group"),
        age_group(F.col("birth_year"), day(as_of)).alias("age_group"),
        "platform",
        "total_accumulate_cash",
        "current_cash",
        "total_accumulate_shoji",
        "current_shoji",
        *(["first_order_dt", "refund_rate"] if mall else []),
        "terms_agree_yn",
        f"r_{sfx}",
        f"f_{sfx}",
        f"m_{sfx}",
        F.round(safe_divide(F.col(f"m_{sfx}"), F.col(f"f_{sfx}")), 2).alias(f"ar_{sfx}"),
        term,
        prev,
        (term - prev).alias(f"term_diff_{sfx}"),
        f"cycle_stddev_{sfx}",
        *labels.SCORE_NAMES,
        "total_score",
        f"cycle_length_{sfx}",
        f"risk_level_{sfx}",
        F.round(f"suvival_prob_{sfx}", 2).alias(f"suvival_prob_{sfx}"),
        F.round(f"predicted_survival_time_{sfx}").alias(f"predicted_survival_time_{sfx}"),
        *[F.expr(f"{c}_{cat} as {c}") for c in RANKING_COLUMNS],
        day(as_of).alias("snapshot_dt"),
        "cut1",
        "cut2",
        "cut3",
        "grade",
    )
