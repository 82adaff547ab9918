"""Substring dedup: words covered by a window of WIDTH words that also starts earlier are removed.

Candidates.  Each window has an anchor, its least GRAM-word hash; a window can only be
repeated if its anchor is.  Repeated anchors are counted in Spark and marked in a bit
table of fixed size (BITS; a shared bit only lets some more windows pass).  The windows
that pass travel by anchor, those of one anchor occurrence as one row, and get the place
where the same window hash lies first.  Anchors of HOT occurrences or more are dealt by
window instead, aggregated before the shuffle.

Decision.  The passages that others refer to are the reference, sharded by document and
place (SHARD windows).  A suffix automaton is built of each shard, on as many tasks as
its visitors need; the passages that refer to it are streamed through it.  A window is
removed if its matching statistic reaches WIDTH words and the automaton knows an earlier
place.  So hashes only propose; words decide.

Order: by doc_id, then by place.  Defined cases: null and empty texts have no words; a
text from which nothing is removed stays as it is, otherwise the kept words are joined
by one space; rows with a null id are neither judged nor referred to; fully repeated
rows are one document and are treated alike; of rows of one id with different texts each
loses what repeats an earlier place by its own words; an empty table gives no rows;
input columns named like new ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from patronage.functions.stages import cut
from patronage.llm.automaton import SuffixAutomaton
from patronage.llm.blocks import whole_groups
from patronage.llm.words import grams, least_of_windows, signed, slices, starts_inside, words_of

WIDTH, GRAM = 20, 8
BITS = 1 << 26
HOT = 1 << 16  # occurrences of one anchor that a task takes whole: some 7 MB of window hashes
SHARD = 1 << 15
VISITORS = 4096  # passages streamed through one copy of an automaton


class _Windows:
    """The windows of several joined texts, in runs that share an anchor."""

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        words = words_of(data, starts)
        least, at = least_of_windows(grams(words.hashes, GRAM), WIDTH - GRAM + 1)
        self.place = np.flatnonzero(starts_inside(words.first, WIDTH, len(least)))
        self.anchor = least[self.place]
        at = at[self.place]
        self.new = np.ones(len(at), bool)
        self.new[1:] = (at[1:] != at[:-1]) | (self.place[1:] != self.place[:-1] + 1)
        self.words = words


def _anchors(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, starts in slices(batch["text"]):
                w = _Windows(data, starts)
                yield pa.RecordBatch.from_arrays([pa.array(signed(w.anchor[w.new]))], ["anchor"])

    return docs.select("text").mapInArrow(run, "anchor bigint")


def _marked(docs: DataFrame, hot: int) -> tuple[np.ndarray, np.ndarray]:
    """Bit tables of the repeated and of the hot anchors."""
    repeated = _anchors(docs).groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    slot = F.col("anchor").bitwiseAND(F.lit(BITS - 1))
    bit = F.expr(f"shiftleft(1L, CAST((anchor & {BITS - 1}) & 63 AS INT))")
    rows = (
        repeated.groupBy(F.shiftright(slot, 6).alias("word"))
        .agg(F.bit_or(bit).alias("bits"), F.bit_or(F.when(F.col("n") >= hot, bit).otherwise(F.lit(0).cast("bigint"))).alias("hot"))
        .toArrow()  # BITS / 64 rows at most
    )
    tables = np.zeros((2, BITS // 64), np.int64)
    for table, column in zip(tables, ("bits", "hot"), strict=True):
        table[rows["word"].to_numpy()] = rows[column].to_numpy()
    return tables[0].view(np.uint64), tables[1].view(np.uint64)


def _is_marked(table: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    slot = anchor & np.uint64(BITS - 1)
    return (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) != 0


def _candidates(docs: DataFrame, marks, want_hot: bool) -> DataFrame:
    """anchor, doc_id, start, prints (window hashes, 64 bits each): the windows of each marked anchor occurrence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated, hot = marks.value
        for batch in batches:
            for lo, to, data, starts in slices(batch["text"]):
                w = _Windows(data, starts)
                take = _is_marked(repeated, w.anchor) & (_is_marked(hot, w.anchor) == want_hot)
                prints = grams(w.words.hashes, WIDTH)[w.place[take]]
                first = np.flatnonzero(w.new[take])
                place = w.place[take][first]
                text = np.searchsorted(w.words.first, place, side="right") - 1
                offsets = (8 * np.append(first, len(prints))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(w.anchor[take][first])),
                        batch["doc_id"].slice(lo, to - lo).take(pa.array(text)),
                        pa.array((place - w.words.first[text]).astype(np.int32)),
                        pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(prints.tobytes())]),
                    ],
                    ["anchor", "doc_id", "start", "prints"],
                )

    return docs.mapInArrow(run, "anchor bigint, doc_id bigint, start int, prints binary")


_RUN = "doc_id bigint, start int, n int, o_doc bigint, o_start int"


def _runs_by_anchor(rows: DataFrame) -> DataFrame:
    """Windows that lie earlier too, as runs of n windows with the first place of their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, _ in whole_groups(batches, ["anchor"]):
            column = table["prints"].combine_chunks().cast(pa.large_binary())
            offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            prints = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(np.uint64)
            count = np.diff(offsets) // 8
            row = np.repeat(np.arange(len(count)), count)
            doc = table["doc_id"].to_numpy()[row]
            start = (table["start"].to_numpy()[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)).astype(np.int32)
            _, first, back = np.unique(prints, return_index=True, return_inverse=True)
            first = first[back]  # rows are in order of place within an anchor
            later = np.flatnonzero(first != np.arange(len(first)))
            if not len(later):
                continue
            o_doc, o_start = doc[first[later]], start[first[later]]
            new = np.ones(len(later), bool)
            new[1:] = (row[later][1:] != row[later][:-1]) | (np.diff(later) != 1) | (o_doc[1:] != o_doc[:-1]) | (np.diff(o_start) != 1)
            at = np.flatnonzero(new)
            n = np.diff(np.append(at, len(later))).astype(np.int32)
            arrays = [doc[later][at], start[later][at], n, o_doc[at], o_start[at]]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["doc_id", "start", "n", "o_doc", "o_start"])

    return rows.repartition("anchor").sortWithinPartitions("anchor", "doc_id", "start").mapInArrow(run, _RUN)


def _runs_by_window(rows: DataFrame) -> DataFrame:
    """The same for hot anchors, one window at a time, with the first places found by a combining aggregate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch["prints"].to_pylist()
            prints = np.frombuffer(b"".join(raw), np.int64)
            count = np.array([len(r) // 8 for r in raw], np.int64)
            row = np.repeat(np.arange(len(raw)), count)
            start = batch["start"].to_numpy()[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(prints), batch["doc_id"].take(pa.array(row)), pa.array(start.astype(np.int32))], ["print", "doc_id", "start"]
            )

    windows = rows.mapInArrow(run, "print bigint, doc_id bigint, start int")
    firsts = windows.groupBy("print").agg(F.min(F.struct("doc_id", "start")).alias("o"), F.count(F.lit(1)).alias("k")).where("k > 1")
    met = windows.join(firsts, "print").select("doc_id", "start", F.lit(1).alias("n"), F.col("o.doc_id").alias("o_doc"), F.col("o.start").alias("o_start"))
    return met.where("doc_id != o_doc OR start != o_start")


def _lists(batch: pa.RecordBatch, name: str, fields: tuple[str, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Row number and fields of the entries of a list column."""
    column = batch[name]
    flat = column.flatten()
    count = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(column)), count), [flat.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in fields]


def _passages(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """shard, block, copy, kind (0 reference, 1 visitor), doc_id, version, start, words: what automata are built of and read."""
    block = F.floor(F.col("o_start") / SHARD).cast("int")
    runs = runs.withColumn("block", block)
    visits = runs.groupBy("o_doc", "block").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(VISITORS))).cast("int").alias("copies"))
    own = (
        runs.join(visits, ["o_doc", "block"])
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("start", "n", "o_doc", "o_start", "block", "copies")).alias("own"))
    )
    asked = runs.groupBy("o_doc", "block", "o_start").agg(F.max("n").alias("n")).join(visits, ["o_doc", "block"])
    asked = asked.groupBy(F.col("o_doc").alias("doc_id")).agg(F.collect_list(F.struct("o_start", "n", "block", "copies")).alias("asked"))
    both = own.join(asked, "doc_id", "full")
    joined = docs.select("doc_id", "text", F.xxhash64("text").alias("version")).join(both, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo, to, data, starts in slices(whole["text"]):
                batch = whole.slice(lo, to - lo)
                words = words_of(data, starts)
                doc, version = batch["doc_id"].to_numpy(), batch["version"].to_numpy()
                raw, first, last = data.tobytes(), words.first[:-1], words.first[1:]
                out: list[list] = [[] for _ in range(7)]

                def emit(kind, row, start, end, shard, block, copies, raw=raw, first=first, last=last, words=words, doc=doc, version=version, out=out):
                    end = np.minimum(end, (last - first)[row])
                    ok = end - start >= WIDTH
                    row, start, end, shard, block, copies = (x[ok] for x in (row, start, end, shard, block, copies))
                    a, b = words.begin[first[row] + start], words.end[first[row] + end - 1]
                    text = [raw[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
                    if kind:
                        times, copy = np.ones(len(row), np.int64), (doc[row] * 0x9E3779B1 + start) % np.maximum(copies, 1)
                    else:
                        times = copies
                        copy = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
                    n = np.repeat(np.arange(len(row)), times)
                    parts = (shard[n], block[n], copy, np.full(len(n), kind), doc[row][n], version[row][n], start[n])
                    for o, p in zip(out, parts, strict=True):
                        o.append(p)
                    return [text[k] for k in n.tolist()]

                texts = []
                row, (start, n, block, copies) = _lists(batch, "asked", ("o_start", "n", "block", "copies"))
                if len(row):
                    order = np.lexsort((start, block, row))
                    row, start, n, block, copies = (x[order] for x in (row, start, n, block, copies))
                    group = np.cumsum(np.append(0, (row[1:] != row[:-1]) | (block[1:] != block[:-1]))) << 40
                    reach = np.maximum.accumulate(group + start + n)  # windows asked for up to here
                    new = np.append(True, (group + start)[1:] > reach[:-1])
                    at = np.flatnonzero(new)
                    end = np.maximum.reduceat(start + n, at) + WIDTH - 1
                    texts += emit(0, row[at], start[at], end, doc[row[at]], block[at], copies[at])
                row, (start, n, o_doc, o_start, block, copies) = _lists(batch, "own", ("start", "n", "o_doc", "o_start", "block", "copies"))
                if len(row):
                    order = np.lexsort((start, row))
                    row, start, n, o_doc, o_start, block, copies = (x[order] for x in (row, start, n, o_doc, o_start, block, copies))
                    new = np.ones(len(row), bool)
                    new[1:] = (row[1:] != row[:-1]) | (o_doc[1:] != o_doc[:-1]) | (block[1:] != block[:-1])
                    new[1:] |= (start[1:] != (start + n)[:-1]) | ((o_start - start)[1:] != (o_start - start)[:-1])
                    at = np.flatnonzero(new)
                    end = np.append(at[1:], len(row)) - 1
                    texts += emit(1, row[at], start[at], start[end] + n[end] + WIDTH - 1, o_doc[at], block[at], copies[at])
                if out[0]:
                    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
                    arrays = [pa.array(np.concatenate(o)).cast(t) for o, t in zip(out, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([*arrays, pa.array(texts, pa.binary())], names)

    names = ["shard", "block", "copy", "kind", "doc_id", "version", "start", "words"]
    return joined.mapInArrow(run, "shard bigint, block int, copy int, kind int, doc_id bigint, version bigint, start int, words binary")


def _decided(passages: DataFrame) -> DataFrame:
    """doc_id, version, a, b: word ranges that the automata find to lie earlier too."""
    key = ["shard", "block", "copy"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, automaton, ends = None, SuffixAutomaton(), None
        for batch in batches:
            out: list[tuple] = []
            for shard, block, copy, kind, doc, version, start, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (shard, block, copy) != at:
                    at, automaton, ends = (shard, block, copy), SuffixAutomaton(), None
                words = text.split()
                if kind == 0:
                    automaton.add(words, start)
                    continue
                if ends is None:
                    ends = automaton.first_ends(WIDTH)
                a = b = -1
                for i, end in automaton.matches(words, WIDTH, ends):
                    last = start + i
                    if (shard, end) < (doc, last):
                        if last - WIDTH + 1 > b:
                            if b >= 0:
                                out.append((doc, version, a, b))
                            a = last - WIDTH + 1
                        b = last + 1
                if b >= 0:
                    out.append((doc, version, a, b))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["doc_id", "version", "a", "b"])

    types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    dealt = passages.repartition(*key).sortWithinPartitions(*key, "kind", "start", "doc_id")
    return dealt.mapInArrow(run, "doc_id bigint, version bigint, a int, b int")


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """The documents with text replaced by what is kept, and n_words, n_removed."""
    rows = docs.drop(*(c for c in docs.columns if c.lower() in ("n_words", "n_removed")))
    named = rows.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    tables = _marked(named, hot)
    marks = docs.sparkSession.sparkContext.broadcast(tables)  # BITS / 4 bytes
    cold = _runs_by_anchor(_candidates(named, marks, False))
    runs = cut(cold.unionByName(_runs_by_window(_candidates(named, marks, True))), "runs")
    ranges = _decided(_passages(named, runs))
    taken = {c.lower() for c in rows.columns}
    ident, cuts_name, version = (next(n for k in range(len(taken) + 1) if (n := f"_{x}{'_' * k}") not in taken) for x in ("id", "cuts", "version"))
    cuts = ranges.groupBy(F.col("doc_id").alias(ident)).agg(F.collect_list(F.struct("version", "a", "b")).alias(cuts_name))
    judged = rows.where("doc_id IS NOT NULL").join(cuts, F.col("doc_id") == F.col(ident), "left").drop(ident)
    whole = judged.unionByName(rows.where("doc_id IS NULL"), allowMissingColumns=True)
    return _apply(whole.withColumn(version, F.xxhash64("text")), cuts_name, version)


def _apply(rows: DataFrame, cuts: str, version_name: str) -> DataFrame:
    schema = rows.drop(cuts, version_name).withColumns({"n_words": F.lit(0).cast("bigint"), "n_removed": F.lit(0).cast("bigint")}).schema
    names = [c for c in rows.columns if c not in (cuts, version_name)]
    text_name = next(c for c in names if c.lower() == "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo, to, data, starts in slices(whole[text_name]):
                batch = whole.slice(lo, to - lo)
                words = words_of(data, starts)
                row, (version, a, b) = _lists(batch, cuts, ("version", "a", "b"))
                own = version == batch[version_name].to_numpy()[row]
                row, a, b = row[own], a[own], b[own]
                gone = np.zeros(len(words.hashes) + 1, np.int32)
                np.add.at(gone, words.first[row] + a, 1)
                np.add.at(gone, words.first[row] + b, -1)
                gone = np.cumsum(gone[:-1]) > 0
                removed = np.diff(np.append(0, np.cumsum(gone))[words.first])
                texts = batch[text_name].to_pylist()
                raw = data.tobytes()
                for k in np.flatnonzero(removed).tolist():
                    at = np.arange(words.first[k], words.first[k + 1])
                    at = at[~gone[at]]
                    texts[k] = b" ".join([raw[x:y] for x, y in zip(words.begin[at].tolist(), words.end[at].tolist(), strict=True)]).decode()
                columns = [pa.array(texts, pa.string()) if c == text_name else batch[c] for c in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(words.counts), pa.array(removed)], schema.names)

    return rows.mapInArrow(run, schema)
