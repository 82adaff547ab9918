"""The whole chain of a date, and a range of dates into a history."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, fields
from datetime import date, timedelta
from threading import Lock

from pyspark.sql import DataFrame, SparkSession, functions as F

from patronage.functions.scalars import day
from patronage.functions.stages import cut
from patronage.operators import history as hist
from patronage.operators.category import category_power_affiliate, category_power_mall
from patronage.operators.profile import merged_snapshot, reward_balance, track_base, user_profile
from patronage.operators.revenue import affiliate_purchases, purchases_at, purchases_with_refunds
from patronage.operators.rfm import mall_order_days, mall_profile, rfm_affiliate
from patronage.operators.scoring import scored_snapshot
from patronage.operators.survival import SurvivalAnalysis, affiliate_days, mall_days
from patronage.sources.readers import kept_stage, write_stage
from patronage.sources.schemas import Sources

TRACKS = ("affiliate", "mall")
SIDE_BY_SIDE = 4  # dates whose chains share their reading of the facts


@dataclass(frozen=True)
class Window:
    """Dates of a run.  The churn input of the partner feed may start later."""

    affiliate_start: date | str
    mall_start: date | str
    as_of: date | str
    partner_churn_start: date | str | None = None


class SharedStages:
    """Stages that the snapshots of several dates read, each built once, by the first that asks for it.

    They are stored under `store` (replaced, or with `reuse` read where they are there), else in
    the checkpoint folder.
    """

    def __init__(self, dates: Sequence[date | str], store: str | None = None, reuse: bool = False):
        self.dates, self.store, self.reuse = sorted(set(map(str, dates))), store, reuse
        self._stages: dict[str, DataFrame] = {}
        self._locks: defaultdict[str, Lock] = defaultdict(Lock)

    @property
    def last(self) -> str:
        return self.dates[-1]

    def stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        with self._locks[name]:  # the dates are run side by side
            if name not in self._stages:
                self._stages[name] = _stored(self.store, name, build, self.reuse)
            return self._stages[name]


def _stored(store: str | None, name: str, build: Callable[[], DataFrame], reuse: bool) -> DataFrame:
    if store and reuse:
        return kept_stage(SparkSession.active(), store, name, build)
    return write_stage(build(), store, name) if store else cut(build())


class Snapshot:
    """The stages of one date.

    Stages are built on first use.  Those that several stages read are stored: under
    `store` if given (one Parquet table each, replaced on every run, or with `reuse` read
    where it is there), else in the checkpoint folder.  What is read of the facts serves the
    snapshots of several dates: it is stored under `common`, a folder or the stages shared by
    the dates they name, this one among them.
    """

    def __init__(self, src: Sources, window: Window, store: str | None = None, reuse: bool = False, common: str | SharedStages | None = None):
        self.src, self.window, self.store, self.reuse = src, window, store, reuse
        self.shared = common if isinstance(common, SharedStages) else SharedStages([window.as_of], common or store, reuse)
        if str(window.as_of) not in self.shared.dates:
            raise ValueError(f"{window.as_of} is not among the dates of the shared stages ({', '.join(self.shared.dates)})")
        self._stages: dict[str, DataFrame] = {}

    def stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._stages:
            self._stages[name] = _stored(self.store, name, build, self.reuse)
        return self._stages[name]

    def purchases(self) -> DataFrame:
        """Affiliate purchases with their refunds: all that the stages read of that channel's events, in one table."""
        w, last = self.window, self.shared.last
        return self.shared.stage(f"purchases_affiliate-{last}", lambda: purchases_with_refunds(self.src, w.affiliate_start, last))

    def orders(self) -> Sources:
        """The sources, with those columns of the mall orders (and of their first lines) that the stages read stored in one table."""
        wanted = ("order_dt", "member_no", "category_no", "first_pay_amt", F.slice("product_option", 1, 1).alias("product_option"))
        narrow = self.shared.stage("orders_mall", lambda: self.src.mall_orders.select(*wanted))
        return Sources(**{f.name: narrow if f.name == "mall_orders" else getattr(self.src, f.name) for f in fields(Sources)})

    def rfm(self, track: str) -> DataFrame:
        w, last = self.window, self.shared.last

        def affiliate() -> DataFrame:
            return rfm_affiliate(self.src, w.affiliate_start, w.as_of, purchases_at(self.purchases(), w.as_of))

        def mall() -> DataFrame:
            days = self.shared.stage(f"order_days_mall-{last}", lambda: mall_order_days(self.orders(), w.mall_start, last))
            return mall_profile(self.src, days, w.as_of)

        return self.stage(f"rfm_{track}", mall if track == "mall" else affiliate)

    def category_power(self, track: str) -> DataFrame:
        w, last, dates = self.window, self.shared.last, self.shared.dates

        def build() -> DataFrame:
            if track == "mall":
                return category_power_mall(self.orders(), w.mall_start, last, dates)
            return category_power_affiliate(self.src, w.affiliate_start, last, self.purchases(), dates)

        powers = self.shared.stage(f"category_power_{track}-{'_'.join(dates)}", build)
        return powers.where(F.col("snapshot_dt") == day(w.as_of)).drop("snapshot_dt")

    def purchase_log(self) -> DataFrame:
        """Affiliate purchases with unfloored revenue, as the churn stage logs them."""
        w = self.window
        return affiliate_purchases(self.src, w.affiliate_start, w.as_of, w.partner_churn_start, floor=False)

    def survival(self, track: str) -> DataFrame:
        w, last = self.window, self.shared.last

        def days() -> DataFrame:
            if track == "mall":
                return mall_days(self.orders(), w.mall_start, last)
            late = F.lit(True) if w.partner_churn_start is None else F.col("event_dt") >= day(w.partner_churn_start)
            return affiliate_days(self.src, w.affiliate_start, last, names=self.purchases().where(~F.col("is_partner") | late))

        def build() -> DataFrame:
            upto = self.shared.stage(f"days_{track}-{last}", days).where(F.col("order_dt") <= day(w.as_of))
            return SurvivalAnalysis(upto, w.as_of, grouped=track == "mall", stored=True).table

        return self.stage(f"survival_{track}", build)

    def prepare(self) -> None:
        """Build the two tables of purchases and then the six the merge reads.  The tables
        of a group do not depend on each other, and each is a chain of short jobs, so they
        are submitted side by side."""
        parts = (self.survival, self.category_power, self.rfm)
        with ThreadPoolExecutor(len(parts) * len(TRACKS)) as pool:
            for jobs in ([(self.purchases,), (self.orders,)], [(f, track) for f in parts for track in TRACKS]):
                for done in [pool.submit(*job) for job in jobs]:
                    done.result()

    def merged(self, track: str) -> DataFrame:
        def build() -> DataFrame:
            self.prepare()
            base = track_base(self.rfm("mall"), self.rfm("affiliate"), track)
            profile = user_profile(
                base,
                self.src,
                reward_balance(self.src.reward_ledger, self.src.mall_members, self.window.as_of),
                self.survival("mall"),
                self.survival("affiliate"),
                self.category_power("mall"),
                self.category_power("affiliate"),
            )
            return merged_snapshot(profile, track, self.window.as_of)

        return self.stage(f"merged_{track}", build)

    def scored(self, track: str) -> DataFrame:
        return self.stage(f"scored_{track}", lambda: scored_snapshot(self.merged(track), track, self.window.as_of))

    def all_scored(self, tracks: Sequence[str]) -> list[DataFrame]:
        """The scored rows of some channels, side by side once what they share is there."""
        self.prepare()
        with ThreadPoolExecutor(len(tracks)) as pool:
            return list(pool.map(self.scored, tracks))


def scored_side_by_side(snaps: Sequence[Snapshot], track: str) -> list[DataFrame]:
    """The scored rows of several dates.  Their chains are many short jobs, which leave room for each other."""
    with ThreadPoolExecutor(len(snaps)) as pool:
        return list(pool.map(lambda snap: snap.scored(track), snaps))


def run_days(first: date, last: date, data_start: date):
    """Dates of a run; the first must not lie before the data, nor the last before the first."""
    if first < data_start:
        raise ValueError(f"first date {first} lies before the data starts ({data_start})")
    if last < first:
        raise ValueError(f"last date {last} lies before the first ({first})")
    return [first + timedelta(days=i) for i in range((last - first).days + 1)]


def run_series(
    src: Sources,
    data_start: date,
    first: date,
    last: date,
    history_path: str,
    stage_path: str,
    tracks: Sequence[str] = TRACKS,
    partner_churn_start: date | str | None = None,
) -> None:
    """Run the chain for each date and write its records into each channel's dated history, `history_path`/track.

    Every date is computed cumulatively from `data_start`; an error stops the run, and
    running a date again replaces its records.  A few dates at a time run side by side and share what
    they read of the facts; their records are written in the order of the dates.
    """
    days = run_days(first, last, data_start)
    for some in (days[i : i + SIDE_BY_SIDE] for i in range(0, len(days), SIDE_BY_SIDE)):
        shared = SharedStages(some, f"{stage_path}/shared")
        windows = [Window(data_start, data_start, as_of, partner_churn_start) for as_of in some]
        snaps = [Snapshot(src, w, store=f"{stage_path}/{w.as_of}", common=shared) for w in windows]
        with ThreadPoolExecutor(len(snaps)) as pool:
            for snap, done in [(snap, pool.submit(snap.all_scored, tracks)) for snap in snaps]:
                for track, rows in zip(tracks, done.result(), strict=True):
                    hist.append_snapshot(rows, f"{history_path}/{track}", track, snap.window.as_of)
