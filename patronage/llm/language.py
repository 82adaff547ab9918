"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time, on the driver, on a
bounded sample (SAMPLE_DOCS rows, the same number of each label where there are enough,
one excerpt of EXCERPT characters each, read whole).  Every byte of every text gets label
probabilities from the state before and after it; a document's probabilities are their
mean.  Texts are read in stretches of STRIDE bytes that begin at a character, side by side;
the network runs over WARM bytes more on either side before it counts, so the work is in
proportion to the bytes and no position is judged without its neighbours.  Gates are
piecewise linear.

Defined cases: a null text or one without a letter is `und` with score 0; rows with a
null text or label are not learned from, nor labels beyond the MOST_LABELS most frequent;
without any label everything is `und`; texts of any length are read whole; repeated
rows get the same label, and null ids are ids like any other; an empty table gives no rows;
a clashing input column is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from patronage.llm.features import add_columns, fold

SAMPLE_DOCS, EXCERPT, MOST_LABELS = 4000, 200, 256
STRIDE, WARM = 96, 14
CHUNK = STRIDE + 2 * WARM + 4  # bytes that the network runs over for a stretch; characters have up to 4
HIDDEN, ROWS = 8, 2048  # ROWS stretches are run side by side
STEPS, BATCH, RATE = 500, 128, 0.02
UNDETERMINED = "und"


@dataclass
class Direction:
    """One direction: gates update, reset and candidate, stacked; columns of `enter` are bytes."""

    enter: np.ndarray
    recur: np.ndarray

    @classmethod
    def new(cls, rng: np.random.Generator) -> Direction:
        enter = rng.normal(0, 0.1, (3 * HIDDEN, 256)).astype(np.float32)
        enter[: 2 * HIDDEN] += 0.5
        return cls(enter, rng.normal(0, 0.1, (3 * HIDDEN, HIDDEN)).astype(np.float32))

    def run(self, text: np.ndarray, trace: list | None = None) -> np.ndarray:
        """States after each byte; text is (steps, rows), the result (steps, HIDDEN, rows)."""
        steps, rows = text.shape
        out = np.empty((steps, HIDDEN, rows), np.float32)
        h = np.zeros((HIDDEN, rows), np.float32)
        a, u = np.empty((3 * HIDDEN, rows), np.float32), np.empty((3 * HIDDEN, rows), np.float32)
        for t in range(steps):
            np.take(self.enter, text[t], axis=1, out=a, mode="clip")
            np.matmul(self.recur, h, out=u)
            gates = a[: 2 * HIDDEN]
            gates += u[: 2 * HIDDEN]
            np.minimum(np.maximum(gates, 0, out=gates), 1, out=gates)
            z, r, n = a[:HIDDEN], a[HIDDEN : 2 * HIDDEN], a[2 * HIDDEN :]
            n += r * u[2 * HIDDEN :]
            np.minimum(np.maximum(n, -1, out=n), 1, out=n)
            if trace is not None:
                trace.append((h.copy(), a.copy(), u[2 * HIDDEN :].copy()))
            new = out[t]
            np.subtract(h, n, out=new)
            new *= z
            new += n
            h = new
        return out

    def gradient(self, text: np.ndarray, trace: list, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of `enter` and `recur`, given those of the states."""
        d_enter, d_recur = np.zeros_like(self.enter), np.zeros_like(self.recur)
        d_h = np.zeros_like(d_out[0])
        for t in range(len(text) - 1, -1, -1):
            before, a, un = trace[t]
            z, r, n = a[:HIDDEN], a[HIDDEN : 2 * HIDDEN], a[2 * HIDDEN :]
            d_h = d_h + d_out[t]
            d_n = d_h * (1 - z) * (np.abs(n) < 1)
            d_z = d_h * (before - n) * ((z > 0) & (z < 1))
            d_r = d_n * un * ((r > 0) & (r < 1))
            d_u = np.concatenate([d_z, d_r, d_n * r])
            d_recur += d_u @ before.T
            one_hot = np.zeros((text.shape[1], 256), np.float32)
            one_hot[np.arange(text.shape[1]), text[t]] = 1
            d_enter += np.concatenate([d_z, d_r, d_n]) @ one_hot
            d_h = d_h * z + self.recur.T @ d_u
        return d_enter, d_recur


@dataclass
class Network:
    labels: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray  # (labels, 2 * HIDDEN + 1), the last column the bias

    def parameters(self) -> list[np.ndarray]:
        return [self.forward.enter, self.forward.recur, self.backward.enter, self.backward.recur, self.out]

    def probabilities(self, text: np.ndarray) -> np.ndarray:
        """Label probabilities at every position; text is (steps, rows), the result (labels, steps, rows)."""
        n, (steps, rows) = len(self.labels), text.shape
        score = np.empty((n, steps, rows), np.float32)
        ahead = self.forward.run(text)
        for t in range(steps):
            score[:, t] = self.out[:, :HIDDEN] @ ahead[t]
        back = self.backward.run(text[::-1])
        for t in range(steps):
            score[:, t] += self.out[:, HIDDEN:-1] @ back[steps - 1 - t]
        score += self.out[:, -1, None, None]
        score -= score.max(axis=0)
        np.exp(score, out=score)
        score /= score.sum(axis=0)
        return score

    def pooled(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Mean probabilities of each joined text; (texts, labels)."""
        sizes = np.diff(starts)
        begin, low, high, end, owner = stretches(data, starts)
        total = np.zeros((len(sizes), len(self.labels)))
        padded = np.concatenate([data, np.full(CHUNK, 0x20, np.uint8)])
        step = np.arange(CHUNK)[:, None]
        for lo in range(0, len(owner), ROWS):
            part = slice(lo, lo + ROWS)
            at = begin[part] + step
            text = np.where(at < end[part], padded[at], 0x20).astype(np.uint8)
            p = (self.probabilities(text) * ((at >= low[part]) & (at < high[part]))).sum(axis=1)
            for k in range(len(self.labels)):
                total[:, k] += np.bincount(owner[part], p[k], minlength=len(sizes))
        return total / np.maximum(sizes, 1)[:, None]


def stretches(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per stretch of joined texts: where the network begins, the bounds of what counts, where it ends, and the text."""
    sizes = np.diff(starts)
    chunks = -(-sizes // STRIDE)
    owner = np.repeat(np.arange(len(sizes)), chunks)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    first, last = starts[:-1][owner], starts[1:][owner]
    low, high = first + nth * STRIDE, np.minimum(first + (nth + 1) * STRIDE, last)
    begin = np.maximum(low - WARM, first)
    for _ in range(3):  # back to the first byte of a character
        begin = begin - ((begin > first) & ((data[begin] & 0xC0) == 0x80)) if len(begin) else begin
    return begin, low, high, np.minimum(high + WARM, last), owner


def pieces(excerpt: bytes) -> list[bytes]:
    """The whole excerpt in pieces of CHUNK bytes; the last one reaches back, a short excerpt is padded."""
    starts = range(0, max(1, len(excerpt) - CHUNK + STRIDE), STRIDE)
    return [excerpt[min(k, max(0, len(excerpt) - CHUNK)) :][:CHUNK].ljust(CHUNK) for k in starts]


def train(excerpts: list[bytes], labels: list[str], steps: int = STEPS, seed: int = 3) -> Network:
    """Fit by backpropagation through time with a label at every position; rare labels weigh more."""
    rng = np.random.default_rng(seed)
    names = sorted(set(labels))
    cut_up = [pieces(e) for e in excerpts]
    text = np.stack([np.frombuffer(p, np.uint8) for own in cut_up for p in own]).T
    want = np.repeat([names.index(x) for x in labels], [len(own) for own in cut_up])
    weight = (len(want) / (len(names) * np.bincount(want, minlength=len(names))))[want] ** 0.5
    net = Network(names, Direction.new(rng), Direction.new(rng), rng.normal(0, 0.1, (len(names), 2 * HIDDEN + 1)).astype(np.float32))
    params = net.parameters()
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(want), BATCH)
        x = np.ascontiguousarray(text[:, pick])
        traces: tuple[list, list] = ([], [])
        ahead = net.forward.run(x, traces[0])
        back = net.backward.run(x[::-1], traces[1])
        state = np.concatenate([ahead, back[::-1], np.ones((CHUNK, 1, BATCH), np.float32)], axis=1)
        score = np.einsum("lh,thb->tlb", net.out, state)
        score = np.exp(score - score.max(axis=1, keepdims=True))
        score /= score.sum(axis=1, keepdims=True)
        score[:, want[pick], np.arange(BATCH)] -= 1
        d = score * (weight[pick] / (CHUNK * BATCH)).astype(np.float32)
        d_state = np.einsum("lh,tlb->thb", net.out, d)
        grads = [
            *net.forward.gradient(x, traces[0], d_state[:, :HIDDEN]),
            *net.backward.gradient(x[::-1], traces[1], d_state[::-1, HIDDEN:-1]),
            np.einsum("tlb,thb->lh", d, state),
        ]
        shrink = min(1.0, 1.0 / (np.sqrt(sum(float((g**2).sum()) for g in grads)) + 1e-9))
        rate = RATE * min(1.0, 2 * (1 - (step - 1) / steps))
        for p, g, m, v in zip(params, grads, first, second, strict=True):
            g = g * shrink
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return net


def train_fold(doc_id: Column) -> Column:
    """Rows the network may learn from."""
    return fold(doc_id, 4) != 2


def learn(docs: DataFrame, use: Column) -> Network | None:
    """Fit on SAMPLE_DOCS labelled rows of `use`, of each label those with the least hashes; an excerpt from a hashed place of each.

    The labels are counted first, so that a share of each label's rows is chosen by hash that holds
    twice as many as wanted: what reaches the driver doesn't grow with the table.
    """
    rows = docs.where(use).where("text IS NOT NULL AND text != '' AND lang IS NOT NULL")
    found = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LABELS).collect()
    if not found:
        return None
    wanted = -(-SAMPLE_DOCS // len(found))
    place = F.lit(1) + F.pmod(F.xxhash64(F.col("doc_id"), F.lit("place")), F.greatest(F.length("text") - EXCERPT, F.lit(1))).cast("int")
    excerpts = rows.select("lang", F.substring(F.col("text"), place, F.lit(EXCERPT)).alias("excerpt"), F.xxhash64("doc_id", F.octet_length("text")).alias("draw"))
    share = F.lit(None).cast("double")
    for r in found:
        share = F.when(F.col("lang") == r["lang"], min(1.0, 2 * wanted / r["n"] + 30 / r["n"])).otherwise(share)
    # The limit holds where many rows share a hash, as copies without an id do.
    chosen = excerpts.where(F.pmod(F.col("draw"), F.lit(1 << 30)) < share * (1 << 30)).limit(4 * SAMPLE_DOCS).collect()
    by_label: dict[str, list] = {}
    for r in chosen:
        by_label.setdefault(r["lang"], []).append((r["draw"] % (1 << 30), r["excerpt"]))
    sample = [(text, lang) for lang in sorted(by_label) for _, text in sorted(by_label[lang])[:wanted]]
    return train([text.encode() for text, _ in sample], [lang for _, lang in sample])


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """The documents with lang_pred and its mean probability as score."""
    if network is None:
        return docs.withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(network)  # a fixed number of weights and the sample's labels

    def start():
        net = shared.value
        names = np.array(net.labels, object)

        def work(data, starts):
            p = net.pooled(data, starts)
            return [pa.array(names[p.argmax(axis=1)], pa.string()), pa.array(np.clip(p.max(axis=1), 0, 1))]

        return work

    out = add_columns(docs, start, "lang_pred string, score double")
    known = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return out.withColumn("lang_pred", F.when(known, F.col("lang_pred")).otherwise(UNDETERMINED)).withColumn("score", F.when(known, F.col("score")).otherwise(0.0))
