"""Byte-level BPE by dynamic programming over prefixes.

The BPE encoding of a piece has one property that makes it computable from left to right:
a sequence of tokens is the encoding of its bytes exactly if every token and every two
neighbours encode to themselves.  So each prefix of a piece has one valid last token: the
one that ends there, whose predecessor is the valid last token of the shorter prefix and
which may follow it.  `Prefixes` stores that token for every prefix.  Bytes that are
appended only add entries, the ids follow by walking back from the end, and after an edit
only the entries near it are computed again, until they agree with the old ones over the
length of the longest token.  `TextIds` does the same for a whole text, piece by piece.

Texts are cut by the vocabulary's pattern into pieces, each encoded separately; ids of
short pieces are kept in a bounded table per task.  A piece that is itself in the
vocabulary is one token, as the public libraries have it.

Defined cases: null and empty texts have no ids; a text is never cut, so a task holds one
Arrow batch and the pieces of one text, however long; bytes that are no UTF-8 are read as
the replacement character; repeated rows and rows with a null id get their own result; an
empty table gives no rows; other columns pass unchanged, but those with the name of a
result column (whatever their case) are replaced.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from patronage.llm.words import slices

KEPT_PIECES, KEPT_PAIRS = 400_000, 500_000  # entries of a task's tables
_SLICE = 1 << 21  # bytes of text encoded together (or one text, if that is longer)
KEPT_LETTERS = 64  # longer pieces are not kept


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, which are the ids, of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Vocabulary:
    """Ranks with what the prefix tables ask: which token ends in some bytes and may follow another."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        self.longest = max(self.sizes.values(), default=0)
        # Every end of a token: its rank where it is a token itself, else -1.
        self._ends = {token[k:]: -1 for token in ranks for k in range(1, len(token))} | ranks
        self._alone: dict[int, bool] = {}
        self._pairs: dict[int, bool] = {}

    def merged(self, data: bytes) -> list[int]:
        """Encoding by merging the pair of least rank, leftmost first, until none is left; for short data."""
        ranks, none = self.ranks, 1 << 62
        parts = [data[k : k + 1] for k in range(len(data))]
        pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs:
            least = min(pairs)
            if least == none:
                break
            at = pairs.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], none)
            if at < len(pairs):
                pairs[at] = ranks.get(parts[at] + parts[at + 1], none)
        return [ranks[p] for p in parts]

    def stands(self, token: int) -> bool:
        """Whether the token's bytes encode to it alone."""
        known = self._alone.get(token)
        if known is None:
            known = self._alone[token] = self.merged(self.tokens[token]) == [token]
        return known

    def follows(self, left: int, right: int) -> bool:
        """Whether the bytes of both encode to the two."""
        if len(self._pairs) >= KEPT_PAIRS:
            self._pairs.clear()
        known = self._pairs[left << 32 | right] = self.merged(self.tokens[left] + self.tokens[right]) == [left, right]
        return known

    def extend(self, data: bytes, last: list[int], upto: int) -> None:
        """Add the valid last tokens of the prefixes of data, from the first that `last` lacks to that of `upto` bytes."""
        ends, pairs = self._ends.get, self._pairs.get
        for end in range(len(last) + 1, upto + 1):
            for begin in range(end - 1, -1, -1):
                token = ends(data[begin:end])
                if token is None:
                    raise ValueError(f"no token ends with byte {data[end - 1]}: the vocabulary lacks single bytes")
                if token < 0:
                    continue
                if begin:
                    known = pairs(last[begin - 1] << 32 | token)
                    if known is None:
                        known = self.follows(last[begin - 1], token)
                else:
                    known = self.stands(token)
                if known:
                    last.append(token)
                    break
            else:
                raise ValueError(f"no token ends with byte {data[end - 1]}: the vocabulary lacks single bytes")


class Prefixes:
    """The bytes of one piece and the valid last token of each of their prefixes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self._vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, data: bytes) -> None:
        """Add bytes at the end; no entry changes."""
        self.data += data
        self._vocabulary.extend(self.data, self.last, len(self.data))

    def become(self, data: bytes) -> None:
        """Hold other bytes; the entries of the prefix they share with the present ones stay."""
        same = 0
        for a, b in zip(self.data, data, strict=False):
            if a != b:
                break
            same += 1
        self.data = data
        del self.last[same:]
        self._vocabulary.extend(data, self.last, len(data))

    def replace(self, begin: int, end: int, data: bytes) -> int:
        """Put `data` in place of the bytes [begin, end); gives the number of entries computed."""
        old, shift = self.last, begin + len(data) - end
        self.data = self.data[:begin] + data + self.data[end:]
        self.last, agree, computed = old[:begin], 0, 0
        while len(self.last) < len(self.data) and agree < self._vocabulary.longest:
            at = len(self.last)
            self._vocabulary.extend(self.data, self.last, at + 1)
            computed += 1
            # Agreeing tokens must lie behind the edit and follow tokens that agree.
            agree = agree + 1 if at >= begin + len(data) and self.last[at] == old[at - shift] else 0
        self.last += old[len(self.last) - shift :] if len(self.last) < len(self.data) else []
        return computed

    def ids(self) -> list[int]:
        """The encoding, found by walking back from the end."""
        out, end, sizes = [], len(self.data), self._vocabulary.sizes
        while end:
            token = self.last[end - 1]
            out.append(token)
            end -= sizes[token]
        return out[::-1]


class Encoder:
    """Encodes texts piece by piece; one per task."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.vocabulary, self._pieces = Vocabulary(ranks), regex.compile(pattern).findall
        self._known: dict[str, bytes] = {}
        self._bytes = np.empty(max(self.vocabulary.tokens, default=-1) + 1, object)
        self._bytes[list(self.vocabulary.tokens)] = list(self.vocabulary.tokens.values())

    def pieces(self, text: str) -> list[str]:
        return self._pieces(text)

    def encode_pieces(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """Ids of pieces, in their order, so that neighbours share the entries of their common prefix.

        A piece that is in the vocabulary is one token.
        """
        out, table, ranks = {}, Prefixes(self.vocabulary), self.vocabulary.ranks
        for piece in sorted(pieces):
            data = piece.encode()
            whole = ranks.get(data)
            if whole is None:
                table.become(data)
            found = table.ids() if whole is None else [whole]
            out[piece] = struct.pack(f"<{len(found)}I", *found)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, little-endian unsigned 32 bits each."""
        pieces = [self._pieces(text) for text in texts]
        each = set().union(*pieces)
        new = each.difference(self._known)
        if len(self._known) + len(new) > KEPT_PIECES:  # begin anew, with those of the present texts
            self._known, new = {}, each
        self._known.update(self.encode_pieces(new))
        ids = self._known.__getitem__
        out = [b"".join(map(ids, own)) for own in pieces]
        for piece in [p for p in new if len(p) > KEPT_LETTERS]:
            del self._known[piece]
        return out

    def decode(self, ids: bytes) -> bytes:
        """Bytes of ids as `encode` gives them."""
        return b"".join(self._bytes[np.frombuffer(ids, "<u4")].tolist())


class TextIds:
    """A text with the ids of its pieces, kept right under appends and edits by work near them only."""

    def __init__(self, encoder: Encoder, text: str = ""):
        self._encoder, self._parts = encoder, []
        self.replace(0, 0, text)

    @property
    def text(self) -> str:
        return "".join(piece for piece, _ in self._parts)

    @property
    def ids(self) -> list[int]:
        return np.frombuffer(b"".join(ids for _, ids in self._parts), "<u4").tolist()

    def append(self, more: str) -> int:
        end = sum(len(piece) for piece, _ in self._parts)
        return self.replace(end, end, more)

    def replace(self, begin: int, end: int, text: str) -> int:
        """Put `text` in place of the characters [begin, end); gives the number of pieces encoded.

        A piece depends on itself and at most two characters behind it, so those that end two
        characters before the edit stay, and from the first old boundary that the new pieces
        meet behind the edit the old ones hold again.
        """
        first = at = 0
        while first < len(self._parts) and at + len(self._parts[first][0]) + 1 < begin:
            at += len(self._parts[first][0])
            first += 1
        rest = self._parts[first:]
        old = "".join(piece for piece, _ in rest)
        new = old[: begin - at] + text + old[end - at :]
        boundary, ends = 0, {}
        for k, (piece, _) in enumerate(rest):
            if boundary >= end - at:
                ends[boundary + begin - end + len(text)] = k
            boundary += len(piece)
        fresh, place, keep = [], 0, len(rest)
        for piece in self._encoder.pieces(new):
            if place >= begin - at + len(text) and place in ends:
                keep = ends[place]
                break
            fresh.append((piece, self._encoder.encode_pieces([piece])[piece]))
            place += len(piece)
        self._parts[first:] = fresh + rest[keep:]
        return len(fresh)


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """The rows with ids (little-endian, 32 bits each), n_tokens, and decoded, the bytes that the ids stand for."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # the vocabulary: its size is fixed by its file
    new = T.StructType().add("ids", T.BinaryType()).add("n_tokens", T.LongType()).add("decoded", T.BinaryType())
    kept = docs.drop(*(c for c in docs.columns if c.lower() in new.names))
    at = [c.lower() for c in kept.columns].index("text")
    schema = T.StructType([*kept.schema.fields, *new.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, pattern)
        for batch in batches:
            for lo, to, data, starts in slices(batch.column(at), _SLICE):
                raw, cuts = data.tobytes(), starts.tolist()
                ids = encoder.encode([raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:], strict=False)])
                texts = [encoder.decode(i) for i in ids]
                columns = [pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(texts, pa.binary())]
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, to - lo).columns, *columns], names=schema.names)

    return kept.mapInArrow(run, schema)
