"""Packing along a space-filling curve.

Each document's token ids are hashed into a bag-of-tokens vector, projected to DIMS
dimensions and placed on a Hilbert curve.  Documents are range-partitioned and sorted by
their place on the curve, so neighbours in a sequence are alike, and laid end to end into
sequences of at most `width` tokens.  A document that doesn't fit is cut at the
sequence's end; only the last sequence of a partition is shorter.

Defined cases: null and empty texts are documents of the closing id alone; strings of
added tokens are these tokens; rows of one doc_id are packed separately;
null ids are allowed; an empty table gives no rows; other columns are ignored.  A task
holds one Arrow batch and the arrays of _BATCH_BYTES of text (or one document, if that is longer).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from patronage.functions.stages import cut
from patronage.llm.tokens import Tokenizer
from patronage.llm.words import mix, slices

DIMS, BITS = 3, 16
BUCKETS = 4096  # of the hashed bag of tokens
CLOSING_ID = 0
_BATCH_BYTES = 1 << 20
_PROJECTION = np.random.default_rng(7).standard_normal((BUCKETS, DIMS)).astype(np.float32)


def hilbert_key(coords: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of points with whole coordinates in [0, 2**bits); coords is (dims, n)."""
    x = coords.astype(np.int64)
    dims = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:  # undo the rotations and reflections from the coarsest cell inwards
        low = q - 1
        for i in range(dims):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn = np.where((x[-1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def curve_places(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hilbert keys of documents whose token ids lie end to end, document i from first[i] on."""
    bucket = (mix(np.arange(int(ids.max()) + 1, dtype=np.uint64)) % np.uint64(BUCKETS)).astype(np.int32)
    vectors = np.add.reduceat(_PROJECTION[bucket[ids]], first, axis=0)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True) + 1e-9
    return hilbert_key(np.clip((vectors.T + 1) * (1 << (BITS - 1)), 0, (1 << BITS) - 1))


def tokenized(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, place (on the curve), ids (little-endian, 16 bits each where the vocabulary allows)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(tokenizer_path)
        for batch in batches:
            for lo, to, data, starts in slices(batch["text"], _BATCH_BYTES):
                ids, first = tokenizer.encode(data, starts)
                ids = np.insert(ids, first[1:], np.uint32(CLOSING_ID))
                first = first + np.arange(len(first))
                places = curve_places(ids, first[:-1])
                wide = ids.max() >= 1 << 16
                raw, unit = ids.astype("<u4" if wide else "<u2").tobytes(), 4 if wide else 2
                mark = bytes([unit])
                each = [mark + raw[unit * a : unit * b] for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(lo, to - lo), pa.array(places, pa.int64()), pa.array(each, pa.binary())], ["doc_id", "place", "ids"]
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(encode, "doc_id bigint, place bigint, ids binary")


def pack(docs: DataFrame, tokenizer_path: str, width: int = 1024) -> DataFrame:
    """doc_id, start, length, ids (little-endian 32 bits each), doc_tokens, sequence_id, offset: one row per piece."""
    # Stored, since range partitioning reads its input twice.
    stored = cut(tokenized(docs, tokenizer_path), "tokens")
    along = stored.repartitionByRange("place", "doc_id").sortWithinPartitions("place", "doc_id")

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequences_before = TaskContext.get().partitionId() << 32
        at = 0  # tokens laid by this task so far
        for batch in batches:
            for lo, to, _, _ in slices(batch["ids"]):
                each = [np.frombuffer(b, "<u2" if b[0] == 2 else "<u4", offset=1) for b in batch["ids"].slice(lo, to - lo).to_pylist()]
                sizes = np.array([len(a) for a in each])
                ids = np.concatenate([a.astype("<u4") for a in each])
                begins = at + np.cumsum(sizes) - sizes
                end = at + int(sizes.sum())
                pieces = np.union1d(begins, np.arange(-(-at // width) * width, end, width))
                doc = np.searchsorted(begins, pieces, side="right") - 1
                ends = np.append(pieces[1:], end)
                raw = ids.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(lo, to - lo).take(pa.array(doc)),
                        pa.array(pieces - begins[doc]),
                        pa.array(ends - pieces),
                        pa.array([raw[4 * a : 4 * b] for a, b in zip((pieces - at).tolist(), (ends - at).tolist(), strict=True)], pa.binary()),
                        pa.array(sizes[doc]),
                        pa.array(sequences_before + pieces // width),
                        pa.array(pieces % width),
                    ],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                )
                at = end

    schema = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    return along.mapInArrow(lay, schema)
