import hashlib
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.functions import labels
from patronage.operators import history, profile, segments, study
from patronage.plans.snapshot import run_days
from patronage.sources import readers
from patronage.sources.schemas import RANKING_COLUMNS, history_schema

D = date


def scored(spark, rows, snapshot_dt):
    """A scored affiliate snapshot with the columns the history packs."""
    df = spark.createDataFrame(rows, "user_id string, total_score double, grade string, platform string")
    longs = ["r_score", "f_score", "m_score", "term_score", "term_diff_score", "volatility_score", "r_byshop", "f_byshop",
             "m_byshop", "total_accumulate_cash", "total_accumulate_shoji", "current_cash", "current_shoji"]
    doubles = ["cut1", "cut2", "cut3", "ar_byshop", "current_trailing_term_byshop", "prev_trailing_term_byshop", "term_diff_byshop",
               "cycle_stddev_byshop", "suvival_prob_byshop", "predicted_survival_time_byshop"]
    texts = ["gender", "age_group", "join_group", "terms_agree_yn", "tgt", "risk_level_byshop", "cycle_length_byshop"]
    extra = {c: F.lit(1) for c in longs} | {c: F.lit(1.0) for c in doubles} | {c: F.lit("t") for c in texts}
    extra |= {c: F.lit(None) for c in RANKING_COLUMNS} | {"snapshot_dt": F.lit(snapshot_dt).cast("date")}
    return df.withColumns(extra)


def test_upsert_inserts_appends_replaces_and_keeps(spark):
    empty = spark.createDataFrame([], history_schema("affiliate"))
    one = scored(spark, [("a", 1.0, "IRON", "p1"), ("b", 2.0, "GOLD", "p1"), (None, 9.0, "VIP", "p")], "2025-01-01")
    two = scored(spark, [("a", 3.0, "VIP", "p2"), ("c", 4.0, "VIP", "p2")], "2025-01-02")
    h1 = history.upsert_history(empty, one, "affiliate")
    h2 = history.upsert_history(h1, two, "affiliate").cache()
    got = {r.user_id: (r.platform, [s.total_score for s in r.score_history], len(r.category_history)) for r in h2.collect()}
    assert got == {"a": ("p2", [1.0, 3.0], 2), "b": ("p1", [2.0], 1), "c": ("p2", [4.0], 1)}
    again = history.upsert_history(h2, two, "affiliate")
    assert sorted(map(repr, again.collect())) == sorted(map(repr, h2.collect()))
    holed = h2.withColumn("score_history", F.when(F.col("user_id") != "a", F.col("score_history")))
    row = history.upsert_history(holed, two, "affiliate").where("user_id = 'a'").first()
    assert [s.total_score for s in row.score_history] == [3.0]
    assert sorted(r.user_id for r in history.history_at(h2, "2025-01-02").collect()) == ["a", "c"]


def test_stored_history_and_dated_form_agree(spark, tmp_path):
    one = scored(spark, [("a", 1.0, "IRON", "p1"), ("b", 2.0, "GOLD", "p1")], "2025-01-01")
    two = scored(spark, [("a", 3.0, "VIP", "p2")], "2025-01-02")
    path, dated = str(tmp_path / "h"), str(tmp_path / "d")
    readers.ensure_history(spark, path, "affiliate")
    for snap, on in ((one, "2025-01-01"), (two, "2025-01-02"), (two, "2025-01-02"), (one, "2025-01-01")):
        readers.ensure_history(spark, path, "affiliate")
        readers.write_history(history.upsert_history(readers.read_history(spark, path, "affiliate"), snap, "affiliate"), path)
        history.append_snapshot(snap, dated, "affiliate", on)
    assert readers.history_versions(spark, path) == [0, 1, 2, 3, 4]
    arrays = readers.read_history(spark, path, "affiliate")
    assembled = history.assemble_history(history.read_snapshots(spark, dated), "affiliate")
    assert sorted(map(repr, arrays.collect())) == sorted(map(repr, assembled.select(*arrays.columns).collect()))


# Six users; quintile cuts of six values lie at positions 1, 2, 3, 4 of the sorted ones.
PAST = {"recency": [2, 40, 9, 60, 17, 28], "frequency": [11, 1, 6, 2, 9, 4], "monetary": [900, 15, 400, 50, 700, 120]}
NOW = {"recency": [50, 3, 1, 61, 8, 30], "frequency": [11, 12, 13, 2, 6, 4], "monetary": [900, 950, 990, 50, 300, 120]}


def test_period_scores_and_vip_movement(spark):
    def table(cols):
        rows = [(str(i + 1), *vals) for i, vals in enumerate(zip(*cols.values()))]
        return spark.createDataFrame(rows, "user_id string, recency bigint, frequency bigint, monetary bigint")

    past, now = table(PAST), table(NOW)
    cuts = segments.past_quantiles(past)
    assert [[*cuts.first()[c]] for c in ("recency", "frequency", "monetary")] == [[9, 17, 28, 40], [2, 4, 6, 9], [50, 120, 400, 700]]
    p, n = segments.period_scores(past, cuts).cache(), segments.period_scores(now, cuts).cache()
    # User 2 then: recency 40 is over three cuts -> 2; frequency 1 and money 15 over none -> 1.
    # User 5 then: recency 17 is over one -> 4; frequency 9 over three -> 4; money 700 over three -> 4.
    assert {r.user_id: (r.r_score, r.f_score, r.m_score) for r in p.where("user_id in ('1', '2', '5')").collect()} == {
        "1": (5, 5, 5), "2": (2, 1, 1), "5": (4, 4, 4),
    }
    assert sorted(r.user_id for r in segments.vip_segment(p).collect()) == ["1", "5"]
    assert segments.vip_movement(p, n).first().asDict() == {"past_vips": 2, "current_vips": 2, "net_change": 0}
    assert sorted(r.user_id for r in segments.vip_new(p, n).collect()) == ["2", "3"]
    assert sorted(r.user_id for r in segments.vip_new(n, p).collect()) == ["1", "5"]


def test_cash_bands_close_on_the_right(spark):
    members = spark.createDataFrame([(str(i), c) for i, c in enumerate(["0", "1", "1000", "1001", "100000", "100001", "x", "-5"])], "user_id string, current_cash string")
    got = {r.band: r.users for r in segments.cash_band_profile(members).where("users > 0").collect()}
    assert got == {"1 ~  1,000": 2, "1,000 ~ 1,500": 1, "50,000 ~ 100,000": 1, "100,000 ~": 1}
    s = segments.balance_summary(members).first()
    assert (s.missing, s.positive_users, s.max_cash) == (1, 5, 100001.0)


def test_credits_without_debits_give_zero(spark):
    ledger = spark.createDataFrame(
        [(1, 10, "지급", D(2025, 1, 1)), (2, 10, "지급", D(2025, 1, 1)), (2, 4, "차감", D(2025, 1, 1)), (2, 99, "지급", D(2025, 3, 1))],
        "member_no bigint, amt bigint, accumulation_status string, register_dttm date",
    )
    members = spark.createDataFrame([(1, "a"), (2, "b")], "member_no bigint, wk_id string")
    got = {r.user_id: (r.accumulate_shoji, r.current_shoji) for r in profile.reward_balance(ledger, members, "2025-02-01").collect()}
    assert got == {"a": (10, 0), "b": (10, 6)}


def test_attributes_are_filled_as_row_by_row(spark):
    """Two members of one user, one without a gender: the stand-in takes part in the maximum."""
    rfm = spark.createDataFrame(
        [("u", None, 3, 1, 5.0), ("u", "F", 9, 2, 6.0)], "user_id string, gender string, recency bigint, frequency bigint, monetary double"
    )
    base = profile.channel_rfm(rfm, "mall").withColumn("gender_member", F.lit("M"))
    row = base.select("recency_mall", "frequency_mall", profile._filled("gender", base.columns, ["mall", "member"]).alias("gender")).first()
    assert (row.recency_mall, row.frequency_mall, row.gender) == (3, 2, "M")


def test_correlation_from_moments_and_search_limits(spark):
    rows = [(f"u{i}", *[float((i * k) % 10 + 1) for k in (3, 7, 9, 1, 11, 13)], float((i * 7) % 10) ** 2 + i % 5) for i in range(200)]
    df = spark.createDataFrame(rows, "user_id string, " + ", ".join(f"{c} double" for c in labels.SCORE_NAMES) + ", adjusted_ltv double").cache()
    mom = study.moments(df)
    w = labels.STUDY_START_WEIGHTS
    got = mom.select(study.score_corr([F.lit(x) for x in w]).alias("c")).first().c
    want = df.select(F.corr(study.weighted_score(w), "adjusted_ltv").alias("c")).first().c
    assert abs(got - want) < 1e-9
    found = study.weight_search(mom).cache()
    f = found.first()
    weights = [f[f"w{i}"] for i in range(6)]
    assert abs(sum(weights) - 1) < 1e-12 and weights[1] >= 0.2 and weights[2] >= 0.35 and min(weights) >= 0
    start = mom.select(study.objective([F.lit(x / 0.91) for x in w]).alias("o")).first().o
    assert f.objective >= start - 1e-9
    starts = study.gradient_search(mom).collect()
    ends = [[r[f"w{i}"] for i in range(6)] for r in starts]
    assert len(starts) == study.STARTS and sum(r.best for r in starts) == 1
    assert all(abs(sum(w) - 1) < 1e-9 and w[1] >= 0.2 - 1e-9 and w[2] >= 0.35 - 1e-9 and min(w) >= 0 for w in ends)
    top = next(r for r in starts if r.best)
    at_top = mom.select(study.objective([F.lit(top[f"w{i}"]) for i in range(6)]).alias("o")).first().o
    assert abs(at_top - top.objective) < 1e-9 and top.objective >= f.objective - 1e-9
    still = study.gradient_search(study.moments(df.withColumn("adjusted_ltv", F.lit(1.0))), starts=2, steps=3).collect()
    assert all(r.objective is None and abs(sum(r[f"w{i}"] for i in range(6)) - 1) < 1e-9 for r in still) and sum(r.best for r in still) == 1
    boot = study.bootstrap_corr(df, found, replicates=50)
    assert boot.first() == boot.first()
    rows, digits = df.select("user_id", "adjusted_ltv", study.weighted_score(w).alias("s")).toPandas(), study._HASH_PRIME

    def part(text, at):
        return int(hashlib.md5(text.encode()).hexdigest()[at : at + 8], 16) % digits

    each = [
        rows[[(part(u, 0) + part(u, 8) * rep) % digits < int(0.8 * digits) for u in rows.user_id]] for rep in range(1, 51)
    ]
    want = np.quantile([np.corrcoef(part_rows.s, part_rows.adjusted_ltv)[0, 1] for part_rows in each], [0.025, 0.975])
    assert np.allclose([boot.first().original_low, boot.first().original_high], want, atol=1e-9)


def test_draws_are_those_of_the_rule():
    rng, p = np.random.default_rng(1), study._HASH_PRIME
    a, b = np.r_[rng.integers(0, p, 50), 0, p - 1, p - 1], np.r_[rng.integers(0, p, 50), p - 1, p - 1, 0]
    got = study.draws(a, b, 1000, 0.8)
    assert got.tolist() == [[(x + y * rep) % p < int(0.8 * p) for rep in range(1, 1001)] for x, y in zip(a.tolist(), b.tolist(), strict=True)]


def test_run_days_checks_its_range():
    assert run_days(D(2025, 1, 30), D(2025, 2, 1), D(2024, 3, 1)) == [D(2025, 1, 30), D(2025, 1, 31), D(2025, 2, 1)]
    with pytest.raises(ValueError):
        run_days(D(2024, 1, 1), D(2024, 1, 2), D(2024, 3, 1))
    with pytest.raises(ValueError):
        run_days(D(2025, 1, 2), D(2025, 1, 1), D(2024, 3, 1))


def test_density_follows_the_exact_estimate(spark):
    """Linear binning on 200 points against the sum over all values."""
    rng = np.random.default_rng(7)
    values = {"A": np.r_[rng.normal(10, 2, 400), rng.normal(30, 1, 100)], "B": rng.exponential(5, 300), "C": np.array([4.0] * 9), "D": np.array([1.0])}
    rows = [(g, float(v)) for g, each in values.items() for v in each] + [("A", None)]
    out = segments.density(spark.createDataFrame(rows, "grade string, v double"), "grade", ["v"]).collect()
    assert {r.grade for r in out} == {"A", "B"}
    for grade in "AB":
        v, got = values[grade], sorted((r.point, r.x, r.density) for r in out if r.grade == grade)
        x, density = np.array([g[1] for g in got]), np.array([g[2] for g in got])
        h = v.std(ddof=1) * len(v) ** -0.2
        exact = np.exp(-(((x[:, None] - v) / h) ** 2) / 2).sum(axis=1) / (len(v) * h * np.sqrt(2 * np.pi))
        assert len(got) == 200 and np.abs(density - exact).max() < 0.01 * exact.max()
        assert abs(density.sum() * (x[1] - x[0]) - 1) < 0.01
