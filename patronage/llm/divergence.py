"""How the sources of a language differ in their words.

Every source of a language is a group.  The terms that at least MIN_DOCS documents of the
language hold get smoothed whole shares in each group and in the language, in exact whole
numbers, and f(p, q) = floor((p - q)**2 / q) measures how far a share lies from another.
`source_pairs` sums f over all terms for each two sources of a language; `marked_terms`
gives the terms a group uses more than its language does, by f, to a rank k.

f rises with the term's count in the group and falls with its count in the language, and
ties go to the earlier term.  So a term is dominated by one with no lower group count, no
higher language count and an earlier place in UTF-8, and a term dominated by k others has
no rank up to k.  Every task keeps the terms that fewer than k others of a group dominate
(the k-skyband, which holds the skyband of any larger set of which its terms are a part),
as it reads them; the skybands are merged the same way, and what is left is ranked exactly.

Terms are the runs of ASCII letters and of characters outside ASCII, with A to Z in lower
case.  Counts are combined in the tasks that read the texts, so a frequent term or a large
group is a few rows per task.

Defined cases: a null text, lang or source is the empty text; a group or language without
terms has its shares all the same; a language without kept terms gives pairs of value 0 and no
marked terms; repeated rows are documents each; ids are not read, so they may be null or
repeated; texts are never cut (a task holds one text's terms); an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import Window as W

from patronage.functions.stages import cut
from patronage.llm.words import slices

MIN_DOCS = 3
WHOLE = 1_000_000_000  # the sum of a group's shares, about
_DIGITS = 1000  # WHOLE = _DIGITS ** 3: shares are divided out in three steps, none of which overflows
_NO_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
SALTS = 64  # parts of a group whose skybands are merged first
PART_CELLS = 1 << 18  # terms times sources of a language that a task compares
_SLICE = 1 << 21  # bytes of text whose terms are found at once (or one text, if that is longer)
_KEPT_ROWS = 1 << 19  # combined counts a task holds before it passes them on
_CELLS = 1 << 18  # terms times sources compared at once
_BLOCK = 512  # terms tested against a skyband at once


def _terms(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The terms of every text end to end, and the text each lies in."""
    clean = pc.ascii_lower(pc.replace_substring_regex(texts, _NO_TERM, " "))
    lists = pc.split_pattern(clean, " ")
    flat, owner = lists.flatten(), pc.list_parent_indices(lists)
    some = pc.greater(pc.binary_length(flat), 0)
    return flat.filter(some).dictionary_encode(), owner.filter(some).to_numpy()


def _combined(parts: list[pa.Table]) -> pa.Table:
    sums = pa.concat_tables(parts).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return sums.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select(["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that hold it), a row each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            for lo, to, data, starts in slices(batch["text"], _SLICE):
                terms, owner = _terms(pa.LargeStringArray.from_buffers(to - lo, pa.py_buffer(starts.tobytes()), pa.py_buffer(data.tobytes())))
                in_docs = pa.table({"doc": owner, "term": terms.indices}).group_by(["doc", "term"]).aggregate([([], "count_all")])
                place = pc.add(in_docs["doc"].cast(pa.int64()), lo)
                names = terms.dictionary.cast(pa.string()).take(in_docs["term"])
                rows = {"lang": batch["lang"].take(place), "source": batch["source"].take(place), "term": names}
                held.append(_combined([pa.table(rows | {"n": in_docs["count_all"], "docs": pa.array(np.ones(len(place), np.int64))})]))
                if sum(t.num_rows for t in held) > _KEPT_ROWS:
                    held = [_combined(held)]
                    if held[0].num_rows > _KEPT_ROWS // 2:
                        yield from held.pop().to_batches()
        if held:
            yield from _combined(held).to_batches()

    schema = "lang string, source string, term string, n bigint, docs bigint"
    named = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    # Dealt by term, which serves the counts of groups and those of languages.
    return named.mapInArrow(count, schema).repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column) -> Column:
    """1 + floor(WHOLE * (count + 1) / total), where count + 1 is at most total and total below 9e15; without any term, 1."""
    rest, digits, total = count + F.lit(1), F.lit(0).cast("bigint"), F.greatest(total, F.lit(1))
    for _ in range(3):
        rest = rest * _DIGITS
        digits, rest = digits * _DIGITS + F.call_function("div", rest, total), rest % total
    return digits + 1


def farness(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


class Audit:
    """The kept terms' counts of one table, stored; both parts read them.

    terms: lang, source, term, n (in the group), lang_n (in the language).
    groups: lang, source, kept (terms of the language), size and lang_size (what shares divide by), no (of the source in its language).
    """

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS):
        counts = term_counts(docs)
        everywhere = W.partitionBy("lang", "term")
        counted = counts.withColumns(
            {
                "lang_n": F.sum("n").over(everywhere),
                "lang_docs": F.sum("docs").over(everywhere),
                "once": F.row_number().over(everywhere.orderBy("source")) == 1,
            }
        )
        stored = cut(counted.where(F.col("lang_docs") >= min_docs).drop("docs", "lang_docs"), "terms")
        self.terms = stored.drop("once")
        languages = stored.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if("once").alias("kept"))
        totals = stored.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        named = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()
        groups = named.join(totals, ["lang", "source"], "left").join(languages, "lang", "left").fillna(0, ["total", "lang_total", "kept"])
        number = F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1
        sizes = ("kept", (F.col("total") + F.col("kept")).alias("size"), (F.col("lang_total") + F.col("kept")).alias("lang_size"))
        self.groups = cut(groups.select("lang", "source", *sizes, number.alias("no")), "groups")


def skyband(count: np.ndarray, everywhere: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Rows dominated by fewer than k others in higher count, lower count everywhere and earlier (own) place."""
    order = np.lexsort((place, everywhere, -count))  # a row comes after all that dominate it
    everywhere, place = everywhere[order], place[order]
    kept = np.zeros(0, np.int64)
    for lo in range(0, len(order), _BLOCK):
        block = np.arange(lo, min(lo + _BLOCK, len(order)))
        # Rows left out dominate nothing that k of the kept ones do not dominate too.
        by_kept = ((everywhere[kept] <= everywhere[block, None]) & (place[kept] < place[block, None])).sum(axis=1)
        block, by_kept = block[by_kept < k], by_kept[by_kept < k]
        inside = (everywhere[block] <= everywhere[block, None]) & (place[block] < place[block, None]) & (block < block[:, None])
        kept = np.concatenate([kept, block[by_kept + inside.sum(axis=1) < k]])
    return order[kept]


def _keep_skybands(rows: DataFrame, k: int) -> DataFrame:
    """In each partition, the rows of every group that its others there do not dominate k times."""

    def reduced(parts: list[pa.Table]) -> pa.Table:
        found = pa.concat_tables(parts)
        place = pc.rank(found["term"], tiebreaker="dense").to_numpy().astype(np.int64)
        return found.take(np.sort(skyband(found["n"].to_numpy(), found["lang_n"].to_numpy(), place, k)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], list[pa.Table]] = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            codes = pc.add(pc.multiply(_codes(table["lang"]), pa.scalar(table.num_rows, pa.int64())), _codes(table["source"])).to_numpy()
            order = np.argsort(codes, kind="stable")
            cuts = np.flatnonzero(np.diff(codes[order], prepend=-1, append=-1))
            for a, b in zip(cuts, cuts[1:], strict=False):
                part = table.take(order[a:b])
                parts = held.setdefault((part["lang"][0].as_py(), part["source"][0].as_py()), [])
                parts.append(part)
                if sum(t.num_rows for t in parts[1:]) > _KEPT_ROWS // 16:
                    parts[:] = [reduced(parts)]
            if sum(t.num_rows for parts in held.values() for t in parts) > _KEPT_ROWS:
                for parts in held.values():
                    parts[:] = [reduced(parts)]
                if sum(parts[0].num_rows for parts in held.values()) > _KEPT_ROWS // 2:  # many groups: pass them on and begin anew
                    for parts in held.values():
                        yield from parts[0].to_batches()
                    held = {}
        for parts in held.values():
            yield from reduced(parts).to_batches()

    return rows.mapInArrow(run, rows.schema)


def _codes(column: pa.ChunkedArray) -> pa.Array:
    return pc.dictionary_encode(column).combine_chunks().indices.cast(pa.int64())


def marked_terms(audit: Audit, k: int = 200) -> DataFrame:
    """lang, source, item, value, rank: the terms of each group whose share is above the language's, to rank k."""
    rows = audit.terms.select("lang", "source", "term", "n", "lang_n")
    near = _keep_skybands(rows, k).repartition("lang", "source", F.pmod(F.xxhash64("term"), F.lit(SALTS)))
    p, q = share(F.col("n"), F.col("size")), share(F.col("lang_n"), F.col("lang_size"))
    valued = (
        _keep_skybands(near, k)
        .join(audit.groups, ["lang", "source"])
        .select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
        .where("p > q")
        .withColumn("value", farness(F.col("p"), F.col("q")))
    )
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return valued.withColumn("rank", rank).where(F.col("rank") <= k).select("lang", "source", "item", "value", "rank")


def _pair_sums(rows: pa.Table) -> pa.Table:
    """Sums of f over the terms of one part of a language, for each two of its sources, which are the rows without a term."""
    sources = rows.filter(rows["term"].is_null()).sort_by("no")
    terms = rows.filter(rows["term"].is_valid())
    without, codes, no, p = sources["p"].to_numpy(), _codes(terms["term"]).to_numpy(), terms["no"].to_numpy(), terms["p"].to_numpy()
    n_terms, n = int(codes.max(initial=-1)) + 1, len(without)
    total, at_once = np.zeros((n, n), np.int64), max(1, _CELLS // n)
    for lo in range(0, n_terms, at_once):
        part = (codes >= lo) & (codes < lo + at_once)
        shares = np.tile(without, (min(at_once, n_terms - lo), 1))
        shares[codes[part] - lo, no[part]] = p[part]
        for one in range(n):
            total[one] += ((shares[:, [one]] - shares) ** 2 // shares).sum(axis=0)
    one, other = np.nonzero(~np.eye(n, dtype=bool))
    name = sources["source"].combine_chunks()
    lang = sources["lang"].combine_chunks().take(pa.array(np.zeros(len(one), np.int64)))
    return pa.table({"lang": lang, "source": name.take(pa.array(one)), "item": name.take(pa.array(other)), "value": total[one, other]})


def source_pairs(audit: Audit) -> DataFrame:
    """lang, source, item, value, rank: every other source of a source's language, by the sum of f over all kept terms.

    A language is dealt to as many parts as give each some PART_CELLS shares; the sums of the parts add up.
    """
    of_lang = W.partitionBy("lang")
    parts = (F.lit(1) + F.floor(F.col("kept") * F.count(F.lit(1)).over(of_lang) / PART_CELLS)).cast("int")
    groups = audit.groups.withColumn("parts", parts)
    none = groups.select("lang", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "source", F.lit(None).cast("string").alias("term"), "no", share(F.lit(0).cast("bigint"), F.col("size")).alias("p"))
    some = audit.terms.join(groups, ["lang", "source"]).select(
        "lang", F.pmod(F.xxhash64("term"), F.col("parts")).cast("int").alias("part"), F.lit(None).cast("string").alias("source"), "term", "no", share(F.col("n"), F.col("size")).alias("p")
    )
    sums = none.unionByName(some).groupBy("lang", "part").applyInArrow(_pair_sums, "lang string, source string, item string, value bigint")
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("rank", rank)


def audit_sources(docs: DataFrame, k: int = 200, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    audit = Audit(docs, min_docs)
    pairs, terms = source_pairs(audit), marked_terms(audit, k)
    both = pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term")))
    return both.select("lang", "source", "part", "item", "value", "rank")
