"""Comparing the members of groups of any size, block by block, inside tasks.

A group of n members is cut into ceil(n / block) blocks; every pair of blocks is one piece
of work that a task receives whole.  No pair of members becomes a row: a task reports, for
each member, how many partners it found and one member it is connected with.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def block_pairs(members: DataFrame, size: Column, member: Column, block: int) -> DataFrame:
    """One row per member and block pair it takes part in: adds blk, i, j with i <= j and blk one of them."""
    n = F.ceil(size / F.lit(float(block))).cast("int")
    own = F.pmod(F.xxhash64(member, F.lit("block")), n).cast("int")
    return (
        members.withColumn("blk", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
        .withColumn("i", F.least("blk", "other"))
        .withColumn("j", F.greatest("blk", "other"))
        .drop("other")
    )


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by the keys as tables of complete groups, with each group's first row; the last bound is the length."""
    held: list[pa.RecordBatch] = []
    tail: tuple | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            column = batch[k].to_numpy(zero_copy_only=False)
            change[1:] |= column[1:] != column[:-1]
        head = tuple(batch[k][0].as_py() for k in keys)
        change[0] = tail is not None and head != tail
        tail = tuple(batch[k][batch.num_rows - 1].as_py() for k in keys)
        last = np.flatnonzero(change)
        if len(last):
            held.append(batch.slice(0, int(last[-1])))
            yield _grouped(held, keys)
            held = [batch.slice(int(last[-1]))]
        else:
            held.append(batch)
    if held:
        yield _grouped(held, keys)


def _grouped(parts: list[pa.RecordBatch], keys: list[str]) -> tuple[pa.Table, np.ndarray]:
    table = pa.Table.from_batches([p for p in parts if p.num_rows]).combine_chunks()
    change = np.zeros(table.num_rows, bool)
    change[:1] = True
    for k in keys:
        column = table[k].to_numpy()
        change[1:] |= column[1:] != column[:-1]
    return table, np.append(np.flatnonzero(change), table.num_rows)


def candidate_pairs(blk: np.ndarray, same_block: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within a block, or between the two blocks of a piece of work."""
    if same_block:
        return np.triu_indices(len(blk), 1)
    low = blk == blk.min()
    a, b = np.flatnonzero(low), np.flatnonzero(~low)
    return np.repeat(a, len(b)), np.tile(b, len(a))


def star(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n members the least index connected with it by the pairs."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new
