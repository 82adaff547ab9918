"""Token ids of whole texts by a byte-level BPE vocabulary, computed word by word.

The vocabulary's pre-tokenizer starts a new piece at every white-space byte that stands
alone, so a text without two white-space characters in a row can be cut there.  Pieces
are found and hashed for many texts at once; the ids of a piece are computed once and
kept in a bounded table.  Texts with doubled or unusual white space are encoded whole.
Added tokens of the file match wherever their strings stand, before anything else, as the
public library has it.
"""

from __future__ import annotations

import json
import re
from itertools import chain

import numpy as np

from patronage.llm.words import SPACE, range_hashes

# The pattern of the byte-level vocabulary; a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEPT_PIECES, KEPT_BYTES = 300_000, 64


def byte_letters() -> dict[str, int]:
    """The printable letter a byte-level vocabulary writes for each byte: itself if printable, else one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def load_encoder(path: str):
    """The vocabulary of a tokenizer file as an encoder of ordinary text, and its added tokens."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    added = spec.get("added_tokens") or []
    if any(t.get(flag) for t in added for flag in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens that depend on the text around them")
    special = {t["content"]: t["id"] for t in added}
    if any(c.isspace() for token in special for c in token):
        raise ValueError("added tokens that hold white space")
    ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), special


def unusual_space(data: np.ndarray) -> np.ndarray:
    """Positions of white-space characters outside ASCII."""
    at = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
    padded = np.append(data, np.zeros(2, np.uint8))
    a, b, c = data[at], padded[at + 1], padded[at + 2]
    two = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    three = ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
    general = (a == 0xE2) & (((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F)))
    return at[two | three | general]


def _room(table: np.ndarray, n: int) -> np.ndarray:
    """The table with place for n entries at least."""
    return table if n <= len(table) else np.concatenate([table, np.zeros(max(n, 2 * len(table)) - len(table), table.dtype)])


class Tokenizer:
    """One per task: the encoder and the table of known pieces."""

    def __init__(self, path: str):
        self._encoder, self._added = load_encoder(path)
        # At one place the longest matches.
        self._find = re.compile("|".join(map(re.escape, sorted(self._added, key=len, reverse=True)))) if self._added else None
        self._forget()

    def _ids_of(self, text: str) -> list[int]:
        """Ids of a text that no added token crosses the ends of."""
        ordinary = self._encoder.encode_ordinary
        if self._find is None or not self._find.search(text):
            return ordinary(text)
        out, at = [], 0
        for match in self._find.finditer(text):
            out += [*ordinary(text[at : match.start()]), self._added[match.group()]]
            at = match.end()
        return out + ordinary(text[at:])

    def _forget(self) -> None:
        self._place: dict[int, int] = {}
        self._count = 0
        self._start, self._length = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self._ids, self._used = np.zeros(4096, np.uint32), 0

    def _keep(self, new: list[list[int]]) -> np.ndarray:
        """Places of newly encoded pieces."""
        length = np.fromiter(map(len, new), np.int64, len(new))
        total = int(length.sum())
        place = self._count + np.arange(len(new))
        self._count += len(new)
        self._start, self._length = _room(self._start, self._count), _room(self._length, self._count)
        self._ids = _room(self._ids, self._used + total)
        self._start[place], self._length[place] = self._used + np.cumsum(length) - length, length
        self._ids[self._used : self._used + total] = np.fromiter(chain.from_iterable(new), np.uint32, total)
        self._used += total
        return place

    def encode(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the joined texts end to end, and where each text's ids start."""
        if self._count > KEPT_PIECES:
            self._forget()
        n_texts = len(starts) - 1
        space = SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[starts] = True
        double = np.flatnonzero(space[1:] & space[:-1] & ~edge[1:-1]) if len(data) > 1 else np.zeros(0, np.int64)
        odd = np.unique(np.searchsorted(starts, np.append(double, unusual_space(data)), side="right") - 1)
        begin = np.flatnonzero(space | edge[:-1])
        if len(odd):
            begin = begin[~np.isin(np.searchsorted(starts, begin, side="right") - 1, odd) | edge[begin]]
        end = np.append(begin[1:], len(data))
        keys = range_hashes(data, begin, end)
        long = end - begin > KEPT_BYTES
        keys[long] = np.arange(long.sum(), dtype=np.uint64)  # met once each, not kept
        each, first, back = np.unique(keys, return_index=True, return_inverse=True)
        known, encode, raw = self._place.get, self._ids_of, data.tobytes()
        place = np.array([known(key, -1) for key in each.tolist()], np.int64)
        place[long[first]] = -1
        new = np.flatnonzero(place < 0)
        spans = zip(begin[first[new]].tolist(), end[first[new]].tolist(), strict=True)
        place[new] = self._keep([encode(raw[x:y].decode("utf-8", "replace")) for x, y in spans])
        kept = new[~long[first[new]]]
        self._place.update(zip(each[kept].tolist(), place[kept].tolist(), strict=True))
        place = place[back]
        length = self._length[place]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        ids = self._ids[np.repeat(self._start[place] - (ends - length), length) + np.arange(total)]
        text_start = np.append(ends - length, total)[np.searchsorted(begin, starts)] if n_texts else np.zeros(1, np.int64)
        return ids, text_start
