"""Dates that share what they read of the facts give the rows of each date's own run."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from patronage.functions import labels
from patronage.operators import category, revenue, rfm, survival
from patronage.plans import series
from patronage.plans.snapshot import TRACKS, SharedStages, Snapshot, Window, run_series, scored_side_by_side
from patronage.sources.readers import folders
from patronage.sources.schemas import Sources

START, EARLY, LATE, CHURN = "2000-01-01", "2000-01-25", "2000-03-10", "2000-01-08"
FIRST = dt.date(2000, 1, 1)


@pytest.fixture(scope="module")
def src(spark):
    """A few users whose orders, refunds and cancels lie before, between and after the two dates."""
    action = next(iter(labels.ENTRY_LABELS))
    events, partner, cancels, mall = [], [], [], []
    for u in range(7):
        for k in range(4 + u):
            day = FIRST + dt.timedelta(days=(11 * k + 5 * u) % 75)
            at, key = dt.datetime.combine(day, dt.time(4, u)), None if (u + k) % 6 == 5 else f"t{k % 5}"
            user = None if u == 6 and k == 0 else f"{u}"
            events.append((day, at, user, "D1", "iOS", key, labels.ORDER_COMPLETE, "x", action, f"item {k % 3}", 1000.0 + 100 * u))
            if k % 3 == 1:
                for later in (9, 30):
                    back = day + dt.timedelta(days=later)
                    events.append((back, dt.datetime.combine(back, dt.time(5)), user, "D1", "iOS", key, labels.ORDER_CANCEL, "x", action, "item 0", 400.0))
            partner.append((day, user, f"item {(k + 1) % 4}", 50.0))
            if k % 2:
                cancels += [((day + dt.timedelta(days=n)).strftime("%Y%m%d"), day, user, -15.0) for n in (3, 28)]
            member, status = None if (u, k) == (6, 1) else u, ("BUY_CONFIRM", "DELIVERY_ING", "RETURN_DONE", "PAY_WAIT")[(u + k) % 4]
            mall.append((day, member, k % 4, 10.5 + u, [(2.0, status)]))
            if k % 2:
                mall.append((day, member, None, 3.0, [(1.0, "CANCEL DONE")]))
    tables = {
        "affiliate_events": (events, "event_dt date, event_dttm timestamp_ntz, user_id string, airbridge_device_id string, platform string, transaction_id string, event_category string, event_label string, event_action string, name string, price double"),
        "partner_orders": (partner, "date date, subParam string, productName string, commission double"),
        "partner_cancels": (cancels, "date string, orderDate date, subParam string, commission double"),
        "product_keywords": ([("item 0", "a", "x"), ("item 1", "a", " "), ("item 2", "b", None), ("item 2", "b", "y")], "name string, category1 string, category2 string"),
        "app_members": ([(str(u), "p", FIRST, 10 * u, u, "Y") for u in range(7)], "user_id string, platform string, join_dt date, total_accumulate_cash bigint, current_cash bigint, terms_agree_yn string"),
        "mall_orders": (mall, "order_dt date, member_no bigint, category_no bigint, first_pay_amt double, product_option array<struct<commission_rate:double,order_status_type:string>>"),
        "mall_members": ([(u, None if u == 5 else str(u), "FM"[u % 2], str(1950 + u)) for u in range(7)], "member_no bigint, wk_id string, gender string, birth_year string"),
        "mall_categories": ([(1, "c", "u", 0, 1), (1, "d", "", 2, 2), (2, "e", None, 9, 3)], "depth1_category_no bigint, depth1_category_name string, depth2_category_name string, depth3_category_no bigint, depth4_category_no bigint"),
        "reward_ledger": ([(1, 5, labels.LEDGER_CREDITS[0], dt.datetime(2000, 1, 5))], "member_no bigint, amt bigint, accumulation_status string, register_dttm timestamp_ntz"),
        "offerwall_rfm": ([("1", 2, 3, 4.0)], "user_id string, recency bigint, frequency bigint, monetary double"),
        "app_events": ([], "user_id string"),
    }
    return Sources(**{name: spark.createDataFrame(rows, schema) for name, (rows, schema) in tables.items()})


def rounded(rows):
    return sorted(repr([round(v, 6) if isinstance(v, float) else v for v in r]) for r in rows.collect())


def test_purchases_of_a_date_are_a_choice_of_those_of_a_later_one(src):
    stored = revenue.purchases_with_refunds(src, START, LATE).cache()
    cols = ["user_id", "event_dt", "revenue"]
    for on in (EARLY, LATE):
        got = revenue.purchases_at(stored, on)
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString().split("InMemoryTableScan")[0]
        assert rounded(got.select(*cols)) == rounded(revenue.affiliate_purchases(src, START, on).select(*cols)) != []
    # Refunds between the dates change the money of the earlier days.
    money = [revenue.purchases_at(stored, on).where(F.col("event_dt") <= F.lit(EARLY).cast("date")).agg(F.sum("revenue")).first()[0] for on in (EARLY, LATE)]
    assert money[0] != money[1]


def test_shared_stages_give_each_date_its_own_rows(spark, src, tmp_path):
    shared = SharedStages([LATE, EARLY], f"file://{tmp_path}/all", reuse=True)
    snaps = {on: Snapshot(src, Window(START, START, on, CHURN), f"file://{tmp_path}/{on}", reuse=True, common=shared) for on in (EARLY, LATE)}
    found = dict(zip(snaps, scored_side_by_side(list(snaps.values()), "mall"), strict=True))
    for on, snap in snaps.items():
        days = survival.affiliate_days(src, START, on, CHURN), survival.mall_days(src, START, on)
        want = {
            "rfm_affiliate": rfm.rfm_affiliate(src, START, on),
            "rfm_mall": rfm.rfm_mall(src, START, on),
            "category_affiliate": category.category_power_affiliate(src, START, on),
            "category_mall": category.category_power_mall(src, START, on),
            "survival_affiliate": survival.SurvivalAnalysis(days[0], on).table,
            "survival_mall": survival.SurvivalAnalysis(days[1], on, grouped=True).table,
        }
        got = {f"{part}_{track}": rows(track) for part, rows in (("rfm", snap.rfm), ("category", snap.category_power), ("survival", snap.survival)) for track in TRACKS}
        for name, rows in want.items():
            assert got[name].columns == rows.columns
            assert rounded(got[name]) == rounded(rows) != [], (on, name)
        alone = Snapshot(src, Window(START, START, on, CHURN)).scored("mall")
        assert rounded(found[on]) == rounded(alone) != []
    # One table of the purchases, the days and the categories for both dates; none of a date alone.
    assert len([p for p in (tmp_path / "all").iterdir() if p.name.startswith(("purchases_", "category_", "days_", "order_days_"))]) == 6
    assert not [p for on in snaps for p in (tmp_path / on).iterdir() if p.name.startswith(("purchases_", "category_", "orders_"))]
    with pytest.raises(ValueError, match="not among the dates"):
        Snapshot(src, Window(START, START, "2000-02-01"), common=shared)


def test_the_days_of_a_loop_share_stages(spark, src, tmp_path):
    last = dt.date.fromisoformat(EARLY)
    paths = [f"file://{tmp_path}/{name}" for name in ("history", "stages")]
    run_series(src, FIRST, last - dt.timedelta(days=1), last, *paths, partner_churn_start=CHURN)
    for track in TRACKS:
        assert folders(spark, f"{paths[0]}/{track}", "snapshot_dt") == ["2000-01-24", EARLY]
    assert [p.name for p in (tmp_path / "stages" / "shared").iterdir() if p.name.startswith("purchases_")] == [f"purchases_affiliate-{EARLY}"]


def test_states_are_parts_of_the_keys_their_days_touch(spark, src, tmp_path, monkeypatch):
    """A later day writes the rows of its keys alone; states written whole after some parts are the same."""
    dates, stores = ["2000-01-25", "2000-01-27", "2000-02-03"], {}
    for name, most, keep in (("parts", 8, None), ("whole", 2, 1)):
        monkeypatch.setattr(series, "MOST_PARTS", most)
        stores[name] = series.ChainStore(spark, f"file://{tmp_path}/{name}", START, CHURN)
        for on in dates:
            stores[name].advance(src, on, keep)
    parts, whole = stores["parts"], stores["whole"]
    assert parts.parts(dates[-1]) == dates and whole.parts(dates[-1]) == dates[-1:]
    for place in ("state", "parts"):
        assert folders(spark, f"file://{tmp_path}/whole/{place}", "upto") == dates[-1:]

    def rows(table):
        return rounded(table.select(*[F.array_sort(c) if t.startswith("array") else F.col(c) for c, t in table.dtypes if c != "change"]))

    for name in series.TABLES:
        assert rows(parts.table(name, dates[-1])) == rows(whole.table(name, dates[-1])) != []
        written = [spark.read.parquet(f"file://{tmp_path}/parts/parts/upto={d}/{name}").count() for d in dates]
        assert 0 < written[1] < written[0]
        at = parts.table_at(name, dates)
        for d in dates:
            assert rows(at.where(F.col("snapshot_dt") == F.lit(d).cast("date")).drop("snapshot_dt")) == rows(parts.table(name, d))
    snap, alone = parts.snapshots(src, dates)[1], parts.snapshot(src, dates[1])
    for part in (Snapshot.rfm, Snapshot.category_power):
        got, want = (getattr(s, part.__name__)("mall") for s in (snap, alone))
        assert rounded(got) == rounded(want) != []


def test_first_time_buyers_are_counted_in_the_pass_for_the_latest_day(spark):
    rows = [("a", FIRST), ("b", FIRST), ("b", FIRST + dt.timedelta(days=2)), (None, FIRST), (None, FIRST + dt.timedelta(days=3))]
    buyers = survival.first_time_buyers(spark.createDataFrame(rows, "user_id string, order_dt date"), "2000-01-10")
    assert buyers._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(map(repr, map(tuple, buyers.collect()))) == sorted([repr(("a", 10)), repr((None, 7))])
