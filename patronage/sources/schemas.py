"""Source tables and the schemas of the stored history."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, types as T


@dataclass(frozen=True)
class Sources:
    """The input tables of a run.

    Members and categories are dimensions; member keys must be unique.
    """

    affiliate_events: DataFrame
    partner_orders: DataFrame
    partner_cancels: DataFrame
    product_keywords: DataFrame
    app_members: DataFrame
    mall_orders: DataFrame
    mall_members: DataFrame
    mall_categories: DataFrame
    reward_ledger: DataFrame
    offerwall_rfm: DataFrame
    app_events: DataFrame


RANKING_COLUMNS = (
    [f"ranking_1_{i}" for i in range(1, 4)]
    + [f"power_1_{i}" for i in range(1, 4)]
    + [f"ranking_2_{i}" for i in range(1, 7)]
    + [f"power_2_{i}" for i in range(1, 7)]
)


def _struct(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


_S, _D, _L, _DT = T.StringType(), T.DoubleType(), T.LongType(), T.DateType()

CATEGORY_SNAPSHOT = _struct(
    [("snapshot_dt", _DT)] + [(c, _S if c.startswith("ranking") else _D) for c in RANKING_COLUMNS]
)


def score_snapshot(track: str) -> T.StructType:
    """One dated score record; the mall keeps refund_rate, the affiliate track tgt."""
    mall = track == "mall"
    return _struct(
        [("snapshot_dt", _DT)]
        + ([] if mall else [("tgt", _S)])
        + [("total_score", _D), ("cut1", _D), ("cut2", _D), ("cut3", _D)]
        + [("grade", _S), ("risk_level", _S), ("cycle_length", _S)]
        + [(c, _L) for c in ("r_score", "f_score", "m_score", "term_score", "term_diff_score", "volatility_score")]
        + [("r_data", _L), ("f_data", _L), ("m_data", _L), ("ar_data", _D)]
        + [(c, _D) for c in ("current_trailing_term", "prev_trailing_term", "term_diff", "cycle_stddev")]
        + ([("refund_rate", _D)] if mall else [])
        + [("survival_prob", _D), ("predicted_survival_time", _D)]
        + [(c, _L) for c in ("total_accumulate_cash", "total_accumulate_shoji", "current_cash", "current_shoji")]
    )


def slow_columns(track: str) -> list[tuple[str, T.DataType]]:
    """Attributes kept once per user and overwritten by each snapshot."""
    cols = [(c, _S) for c in ("gender", "age_group", "join_group", "platform", "terms_agree_yn")]
    return cols + ([("first_order_dt", _DT)] if track == "mall" else [])


def history_schema(track: str) -> T.StructType:
    return _struct(
        [("user_id", _S)]
        + slow_columns(track)
        + [
            ("score_history", T.ArrayType(score_snapshot(track))),
            ("category_history", T.ArrayType(CATEGORY_SNAPSHOT)),
        ]
    )
