"""Hashed n-gram features of whole texts, for many texts at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from patronage.llm.words import SPACE, Words, grams, mix, range_hashes, slices, starts_inside, words_of

_U = np.uint64
DIM = 1 << 17

_KIND = np.arange(256, dtype=np.uint8)  # letters by case, digits and every other sign for itself
_KIND[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = ord("a")
_KIND[ord("A") : ord("Z") + 1] = ord("A")
_KIND[ord("0") : ord("9") + 1] = ord("0")


@dataclass
class Rows:
    """Sparse rows: the entries of row i lie from first[i] to first[i + 1]."""

    first: np.ndarray
    index: np.ndarray
    value: np.ndarray

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0.0, np.cumsum(weights[self.index] * self.value, dtype=np.float64))[self.first])


def word_shapes(data: np.ndarray, words: Words) -> np.ndarray:
    """Hash of each word's shape: runs of lower case, upper case and digits count once, other signs stay."""
    kind = _KIND[data]
    change = np.ones(len(kind), bool)
    change[1:] = kind[1:] != kind[:-1]
    change[words.begin] = True
    change &= ~SPACE[data]
    at = np.flatnonzero(change)
    return range_hashes(kind[at], np.searchsorted(at, words.begin), np.searchsorted(at, words.end))


def ngram_rows(data: np.ndarray, starts: np.ndarray, chars: bool) -> Rows:
    """log(1 + count) of hashed word 1-2-grams, shape 1-2-grams and repetitions (and character 3-grams), each family of length 1."""
    n_texts = len(starts) - 1
    words = words_of(data, starts)
    text = words.text_of()
    pair = np.flatnonzero(text[1:] == text[:-1]) if len(text) else np.zeros(0, np.int64)
    families: list[tuple[np.ndarray, np.ndarray]] = [(np.arange(n_texts), mix(np.log2(words.counts + 1).astype(np.uint64)))]
    if len(text):
        shapes = word_shapes(data, words)
        same = (words.hashes[1:] == words.hashes[:-1])[pair].astype(np.uint64)
        families += [(text, words.hashes), (text, shapes), (text[pair], same)]
        families += [(text[pair], grams(a, 2)[pair]) for a in (words.hashes, shapes)]
    if chars and len(data) > 2:
        at = np.arange(len(data) - 2)
        inside = np.repeat(np.arange(n_texts), np.diff(starts))
        whole = inside[2:] == inside[:-2]
        code = data[:-2].astype(_U) | data[1:-1].astype(_U) << _U(8) | data[2:].astype(_U) << _U(16)
        families.append((inside[at[whole]], mix(code[whole] + _U(1))))
    keys, values = [], []
    for k, (row, token) in enumerate(families):
        bucket = mix(token ^ _U(0x5851F42D4C957F2D * (k + 1) % 2**64)) % _U(DIM)
        key, count = np.unique(row.astype(_U) * _U(DIM) + bucket, return_counts=True)
        value = np.log1p(count)
        norm = np.sqrt(np.bincount((key // _U(DIM)).astype(np.int64), value**2, minlength=n_texts))
        keys.append(key)
        values.append(value / norm[(key // _U(DIM)).astype(np.int64)])
    key, value = np.concatenate(keys), np.concatenate(values)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.searchsorted(key, np.arange(n_texts + 1, dtype=np.uint64) * _U(DIM))
    return Rows(first, (key % _U(DIM)).astype(np.int32), value[order].astype(np.float32))


@dataclass
class BaseCounts:
    """Counts of the base quality rules."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray


_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _per_text(marks: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.diff(np.append(0, np.cumsum(marks, dtype=np.int64))[starts])


def _repeated(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values lie twice or more in their text, and which of these come after the first."""
    _, first, back, count = np.unique(mix(hashes + mix(owner.astype(_U))), return_index=True, return_inverse=True, return_counts=True)
    later = np.ones(len(hashes), bool)
    later[first] = False
    return count[back] > 1, later


def base_counts(data: np.ndarray, starts: np.ndarray) -> BaseCounts:
    words = words_of(data, starts)
    inside = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    edge[1:][data == 0x0A] = True
    begin = np.flatnonzero(edge[:-1])
    end = np.append(begin[1:], len(data))[: len(begin)]
    owner = np.searchsorted(starts, begin, side="right") - 1
    end = end - (data[end - 1] == 0x0A) if len(begin) else end
    has_word = np.searchsorted(words.begin, end) > np.searchsorted(words.begin, begin)
    begin, end, owner = begin[has_word], end[has_word], owner[has_word]
    _, later = _repeated(owner, range_hashes(data, begin, end))
    text = words.text_of()
    windows = np.flatnonzero(starts_inside(words.first, 5, max(0, len(text) - 4)))
    twice, _ = _repeated(text[windows], grams(words.hashes, 5)[windows])
    cover = np.zeros(len(text) + 1, np.int32)
    np.add.at(cover, windows[twice], 1)
    np.add.at(cover, windows[twice] + 5, -1)
    n = len(starts) - 1
    return BaseCounts(
        words.counts,
        _per_text(inside & ((data & 0xC0) != 0x80), starts),
        _per_text(_SYMBOL[data], starts),
        np.bincount(owner[later], minlength=n),
        np.bincount(text[np.cumsum(cover[:-1]) > 0], minlength=n),
    )


def add_columns(docs: DataFrame, compute: Callable[[], Callable[[np.ndarray, np.ndarray], list[pa.Array]]], columns: str) -> DataFrame:
    """The rows with columns computed from slices of whole texts; `compute` is called once a task.

    A column of the input with the name of a new one is replaced.
    """
    new = docs.sparkSession.range(0).selectExpr(*(f"CAST(NULL AS {c.split(' ', 1)[1]}) AS {c.split(' ', 1)[0]}" for c in columns.split(", "))).schema
    kept = docs.drop(*(c for c in docs.columns if c.lower() in {n.lower() for n in new.names}))
    schema = T.StructType([*kept.schema.fields, *new.fields])
    at = kept.columns.index(next(c for c in kept.columns if c.lower() == "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = compute()
        for batch in batches:
            for lo, to, data, starts in slices(batch.column(at)):
                part = batch.slice(lo, to - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, *work(data, starts)], names=schema.names)

    return kept.mapInArrow(run, schema)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n
