"""Exact tiles and percentiles over a whole table without a sort.

`ntile` and `percentile_cont` over an unpartitioned window move every row into one
task.  Both only need a handful of order statistics: nine rows decide ten tiles, two
rows decide a percentile.  They are found by counting.  A quantile sketch of the keys
proposes two pivots around each wanted rank, one aggregate counts the rows below, at and
between the pivots of all measures, and the interval that holds the rank is narrowed the
same way until it holds at most SMALL rows, whose keys are counted singly.  The counts are
exact whatever the sketch proposes.  Where many rows share the key of a wanted rank, the
same search goes on over their ids, ID_BYTES bytes at a time.

The driver sees counts and pivots, a fixed number per wanted rank, and at most SMALL
keys per interval; no row is shuffled, sorted or stored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

SMALL = 20_000  # rows of an interval whose keys are counted singly
ACCURACY = 10_000  # of the sketch: a proposed pivot is off by 1 / ACCURACY of the rows
_GRID = [k / 1000 for k in range(1001)]
_MARGIN = 2  # steps of the grid between a wanted rank and its pivots
ID_BYTES = 6  # of an id compared at once: as a number they fit a double


@dataclass(frozen=True)
class TileSpec:
    """One tiling: sort key, number of tiles, direction and the rows that take part."""

    key: Column
    tiles: int
    descending: bool = False
    member: Column | None = None

    def parts(self) -> tuple[Column, Column]:
        """(late, key): ascending keys put nulls first, descending ones last."""
        key = self.key.cast("double")
        if self.descending:
            return F.when(key.isNull(), 1).otherwise(0), -key
        return F.when(key.isNull(), -1).otherwise(0), key


# --- selection by counting ---------------------------------------------------------


@dataclass
class _Interval:
    """Rows of one class with low < key < high (open ends where None), and the ranks wanted among them."""

    group: tuple
    low: float | None
    high: float | None
    before: int
    n: int
    ranks: list[int]
    cuts: list[float] = field(default_factory=list)


@dataclass(frozen=True)
class Found:
    """The row at a rank: its class, its key, its rank among the rows of that key, and their number."""

    late: int
    key: float
    rank: int
    ties: int


def _table(df: DataFrame, rows: list[tuple], **types: str) -> DataFrame:
    """A few rows known to the driver, to be broadcast."""
    structs = [F.struct(*[_literal(v, t).alias(n) for v, (n, t) in zip(row, types.items(), strict=True)]) for row in rows]
    return F.broadcast(df.sparkSession.range(1).select(F.inline(F.array(*structs))))


def _literal(value, dtype: str) -> Column:
    return (F.array(*map(F.lit, value)) if isinstance(value, list) else F.lit(value)).cast(dtype)


def _numbered(rows: DataFrame, intervals: list[_Interval]) -> DataFrame:
    """Rows of the intervals with their interval's number, and their segment: twice the cuts below the key, and one more on a cut."""
    known = _table(
        rows, [(*i.group, no, i.low, i.high, i.cuts) for no, i in enumerate(intervals)],
        m_="string", g_="string", l_="int", no="int", low="double", high="double", cuts="array<double>",
    )
    key = F.col("key")
    same = (F.col("measure") == F.col("m_")) & F.col("grp").eqNullSafe(F.col("g_")) & (F.col("late") == F.col("l_"))
    inside = (F.col("low").isNull() | (key > F.col("low"))) & (F.col("high").isNull() | (key < F.col("high")))
    segment = F.size(F.filter("cuts", lambda c: c < key)) + F.size(F.filter("cuts", lambda c: c <= key))
    return rows.join(known, same & inside).select("no", "key", segment.alias("segment"))


def _narrowed(rows: DataFrame, wide: list[_Interval]) -> tuple[list[_Interval], dict]:
    """Each interval's parts that hold wanted ranks, and the ranks that are found on a pivot."""
    sketch = F.percentile_approx("key", _GRID, ACCURACY)
    pivots = {r["no"]: r["p"] for r in _numbered(rows, wide).groupBy("no").agg(sketch.alias("p")).collect()}
    for i, interval in enumerate(wide):
        near = set()
        for rank in interval.ranks:
            at = (rank - interval.before - 0.5) / interval.n * (len(_GRID) - 1)
            near |= {pivots[i][max(0, math.floor(at) - _MARGIN)], pivots[i][min(len(_GRID) - 1, math.ceil(at) + _MARGIN)]}
        interval.cuts = sorted(near)
    counted = _numbered(rows, wide).groupBy("no", "segment").agg(F.count(F.lit(1)).alias("n")).collect()
    parts, found = [], {}
    for i, interval in enumerate(wide):
        before, ends = interval.before, [interval.low, *interval.cuts, interval.high]
        for segment, n in sorted((r["segment"], r["n"]) for r in counted if r["no"] == i):
            ranks = [r for r in interval.ranks if before < r <= before + n]
            if segment % 2:  # all rows of the segment have the pivot as their key
                for r in ranks:
                    found[interval.group, r] = Found(interval.group[2], ends[segment // 2 + 1], r - before, n)
            elif ranks:
                parts.append(_Interval(interval.group, ends[segment // 2], ends[segment // 2 + 1], before, n, ranks))
            before += n
    return parts, found


def _select(rows: DataFrame, counts: dict[tuple, int], wanted: dict[tuple, list[int]]) -> dict[tuple, Found]:
    """The row at every wanted rank, by (measure, grp, late) and rank within that class.

    rows(measure, grp, late, key); counts: rows of each class.
    """
    found: dict[tuple, Found] = {}
    open_ = [_Interval(group, None, None, 0, counts[group], sorted(set(ranks))) for group, ranks in wanted.items() if ranks]
    while wide := [i for i in open_ if i.n > SMALL]:
        parts, done = _narrowed(rows, wide)
        found |= done
        open_ = [i for i in open_ if i.n <= SMALL] + parts
    if open_:
        keys = _numbered(rows, open_).groupBy("no", "key").agg(F.count(F.lit(1)).alias("n")).collect()
        for i, interval in enumerate(open_):
            before = interval.before
            for key, n in sorted((r["key"], r["n"]) for r in keys if r["no"] == i):
                for r in interval.ranks:
                    if before < r <= before + n:
                        found[interval.group, r] = Found(interval.group[2], key, r - before, n)
                before += n
    return found


def _rows(df: DataFrame, entries: dict[str, Column], grp: Column, *keep: Column) -> DataFrame:
    """(measure, grp, late, key, *keep): a row per measure whose entry (late, key) is not null.

    A null key takes part in the order by `late` alone; NaN comes after all other keys.
    """
    each = [F.when(e.isNotNull(), F.struct(F.lit(name).alias("measure"), e["late"].alias("late"), e["key"].alias("key"))) for name, e in entries.items()]
    out = df.select(*keep, grp.alias("grp"), F.explode(F.array(*each)).alias("e")).where(F.col("e").isNotNull())
    key, late, nan = F.col("e.key"), F.col("e.late"), F.isnan("e.key")
    plain = F.when(key.isNull() | nan, 0.0).otherwise(key + 0.0)
    return out.select("e.measure", "grp", F.when(nan, 2).otherwise(late).cast("int").alias("late"), plain.alias("key"), *[c for c in out.columns if c not in ("grp", "e")])


def _class_counts(rows: DataFrame) -> dict[tuple, int]:
    """Rows of each (measure, grp, late); few."""
    return {(r[0], r[1], r[2]): r[3] for r in rows.groupBy("measure", "grp", "late").agg(F.count(F.lit(1)).alias("n")).collect()}


def _at_ranks(rows: DataFrame, wanted: Callable[[str, int], list[int]]) -> dict[tuple, tuple[int, dict[int, Found]]]:
    """The number of rows of each (measure, grp), and the rows at the ranks that wanted(measure, number) gives."""
    counts = _class_counts(rows)
    by_class: dict[tuple, list[int]] = {}
    place: dict[tuple, tuple] = {}
    totals: dict[tuple, int] = {}
    for measure, grp in {g[:2] for g in counts}:
        classes = sorted((g for g in counts if g[:2] == (measure, grp)), key=lambda g: g[2])
        totals[measure, grp] = sum(counts[g] for g in classes)
        for rank in wanted(measure, totals[measure, grp]):
            left = rank
            for g in classes:
                if left <= counts[g]:
                    by_class.setdefault(g, []).append(left)
                    place[measure, grp, rank] = (g, left)
                    break
                left -= counts[g]
    found = _select(rows, counts, by_class)
    out: dict[tuple, tuple[int, dict[int, Found]]] = {group: (total, {}) for group, total in totals.items()}
    for (measure, grp, rank), at in place.items():
        out[measure, grp][1][rank] = found[at]
    return out


# --- tiles --------------------------------------------------------------------------


def _id_image(id_: Column, part: int) -> Column:
    """Bytes of an id from part x ID_BYTES on as a number that sorts alike; -1 for null, which comes first."""
    raw = F.rpad(F.hex(F.substring(id_.cast("string").cast("binary"), part * ID_BYTES + 1, ID_BYTES)), 2 * ID_BYTES, "0")
    return F.coalesce(F.conv(raw, 16, 10).cast("double"), F.lit(-1.0))


def _ids_at(rows: DataFrame, wanted: dict[tuple, Found]) -> dict[tuple, str | None]:
    """The id at a rank among the rows (measure, grp, late, key, id) that share a key, by what it is wanted for."""
    if not wanted:
        return {}
    names = {str(i): tag for i, tag in enumerate(wanted)}
    keys = _table(rows, [(tag[0], wanted[tag].late, wanted[tag].key, name) for name, tag in names.items()], m_="string", l_="int", k_="double", name="string")
    here = (F.col("measure") == F.col("m_")) & (F.col("late") == F.col("l_")) & (F.col("key") == F.col("k_"))
    tied = rows.join(keys, here).select(F.col("name").alias("measure"), F.lit("").alias("grp"), F.lit(0).alias("late"), "id")
    left = {name: (wanted[tag].rank, wanted[tag].ties) for name, tag in names.items()}
    seen: dict[str, list[float]] = {name: [] for name in left}

    def among(which: list[str]) -> DataFrame:
        """Rows whose ids begin as those found so far for one of these."""
        depth = max(len(seen[name]) for name in which)
        alike = _table(rows, [(name, *seen[name], *[None] * (depth - len(seen[name]))) for name in which], n_="string", **{f"b{k}": "double" for k in range(depth)})
        same = F.col("measure") == F.col("n_")
        for k in range(depth):
            same = same & (F.col(f"b{k}").isNull() | (_id_image(F.col("id"), k) == F.col(f"b{k}")))
        return tied.join(alike, same).select(*tied.columns)

    part = 0
    while open_ := [name for name, (_, ties) in left.items() if ties > 1]:
        groups = {(name, "", 0): left[name][1] for name in open_}
        found = _select(among(open_).withColumn("key", _id_image(F.col("id"), part)), groups, {g: [left[g[0]][0]] for g in groups})
        for ((name, *_), _), at in found.items():
            seen[name].append(at.key)
            left[name] = (at.rank, at.ties)
        part += 1
        if max(at.ties for at in found.values()) > 1 and part * ID_BYTES >= tied.agg(F.max(F.octet_length(F.col("id").cast("string")))).first()[0]:
            break  # equal ids
    ids = among(list(left)).groupBy("measure").agg(F.min("id").alias("id")).collect()
    return {names[r["measure"]]: r["id"] for r in ids}


def tile_bounds(df: DataFrame, specs: dict[str, TileSpec], id_col: str) -> dict[str, list[tuple]]:
    """Per spec the first rows (late, key, id) of tiles 2..k, in order; no id where all rows of the key belong to the tile."""
    entries = {}
    for name, spec in specs.items():
        late, key = spec.parts()
        member = F.lit(True) if spec.member is None else F.coalesce(spec.member, F.lit(False))
        entries[name] = F.when(member, F.struct(late.alias("late"), key.alias("key")))
    rows = _rows(df, entries, F.lit(""), F.col(id_col).alias("id"))

    def starts(name: str, total: int) -> list[int]:
        """First rank of each tile: the leading (total mod k) tiles hold one row more."""
        k = specs[name].tiles
        ranks = [(t - 1) * (total // k) + min(t - 1, total % k) + 1 for t in range(2, k + 1)]
        return [r for r in ranks if r <= total]

    found = _at_ranks(rows, starts)
    # The first row of a key is any row of it; others need the id.
    inside = {(name, rank): at for (name, _), (_, ranks) in found.items() for rank, at in ranks.items() if at.rank > 1}
    ids = _ids_at(rows, inside)
    bounds = {name: sorted(found.get((name, ""), (0, {}))[1].items()) for name in specs}
    return {name: [(at.late, at.key, ids.get((name, rank))) for rank, at in ranks] for name, ranks in bounds.items()}


def add_tiles(df: DataFrame, specs: dict[str, TileSpec], id_col: str) -> DataFrame:
    """NTILE per spec as a new column; null for rows outside the spec.

    Ties are ordered by `id_col`, which must be unique (at most one null).
    `df` is read several times, so pass a cut or stored table.
    """
    tiles = {}
    for name, bounds in tile_bounds(df, specs, id_col).items():
        late, key = specs[name].parts()
        none, nan = key.isNull(), F.isnan(key)
        own = F.col(id_col).cast("string")
        me = F.struct(F.when(nan, 2).otherwise(late).alias("late"), F.when(none | nan, 0.0).otherwise(key + 0.0).alias("key"), own.alias("id"))
        # Structs compare field by field, and no id comes before all others.
        firsts = [F.struct(F.lit(at[0]).alias("late"), F.lit(at[1]).alias("key"), F.lit(at[2]).cast("string").alias("id")) for at in bounds]
        tile = 1 + _passed(firsts, me)
        tiles[name] = tile if specs[name].member is None else F.when(specs[name].member, tile)
    return df.withColumns(tiles)


def _passed(firsts: list[Column], me: Column) -> Column:
    """How many of the sorted structs are not after `me`."""
    return F.size(F.filter(F.array(*firsts), lambda first: first <= me)) if firsts else F.lit(0)


# --- percentiles ----------------------------------------------------------------------


def percentiles(
    df: DataFrame,
    measures: dict[str, Column],
    probs: Iterable[float],
    id_col: str | None = None,
    by: str | None = None,
) -> DataFrame:
    """Exact interpolated percentiles, nulls skipped.

    One row (or one per value of `by`) with an array of len(probs) per measure.
    `by` must have few values (grades, splits).  `df` is read several times.
    """
    probs = [float(p) for p in probs]
    grp = F.lit("") if by is None else F.col(by).cast("string")
    entries = {n: F.when(c.isNotNull(), F.struct(F.lit(0).alias("late"), c.cast("double").alias("key"))) for n, c in measures.items()}
    def ends(p: float, total: int) -> tuple[int, int]:
        """Ranks of the rows below and above a probability."""
        return math.floor(p * (total - 1)) + 1, math.ceil(p * (total - 1)) + 1

    found = _at_ranks(_rows(df, entries, grp), lambda _, total: sorted({r for p in probs for r in ends(p, total)}))

    def values(measure: str, group: str | None) -> list[float | None]:
        total, at = found.get((measure, group), (0, {}))
        if not total:
            return [None] * len(probs)
        key = {r: math.nan if f.late == 2 else f.key for r, f in at.items()}
        out = []
        for p in probs:
            low, high = (key[r] for r in ends(p, total))
            out.append(low + (high - low) * (p * (total - 1) - math.floor(p * (total - 1))))
        return out

    groups = [""] if by is None else sorted({g for _, g in found}, key=lambda g: (g is not None, g))
    rows = [
        F.struct(F.lit(g).cast("string").alias(by or "_all"), *[F.array(*[F.lit(v).cast("double") for v in values(n, g)]).alias(n) for n in measures])
        for g in groups
    ]
    spark = df.sparkSession
    if not rows:
        return spark.range(0).select(F.lit("").alias(by), *[F.array(F.lit(0.0)).alias(n) for n in measures])
    out = spark.range(1).select(F.inline(F.array(*rows)))
    return out if by is not None else out.drop("_all")
