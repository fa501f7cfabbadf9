"""Toxicity: a classifier chain of linear models over hashed word parts.

Method: the categories are predicted one after another.  Each link is a
logistic regression on the presence of hashed words and word beginnings; every
later link also gets the probabilities of the categories before it.  Those come from
out-of-fold predictions while training, so a link learns from earlier outputs
as noisy as it will meet, and from the full models when scoring.

Training takes a bounded sample (``per_class`` labelled documents with and
without the last category, least id hash first, never a held-out id).  In every
fold the ``features`` parts most associated with the category are chosen from
that fold's rows alone.  Scoring covers every word of every text.

Defined results: null and empty texts score by the intercepts alone; repeated
rows and null ids each give their row; an empty table gives an empty result; a
category without both values in the sample scores its share (0 if there are no
rows); other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitlens.llm import arrays as A
from orbitlens.llm.labels import held_out, one_row_per_id, sample

BITS = 20
BEGINNINGS = (4, 5, 6)         # bytes of a word's beginning that are parts of their own

NOT_LETTER = np.ones(256, bool)
NOT_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def folded(raw: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and two-byte Latin letters."""
    low = A.LOWER[raw]
    if len(raw) > 1:
        up = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)
        low[1:][up] += 32
    return low


def parts(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(part, text index) of every word and word beginning; parts are numbers below 2**BITS."""
    low = folded(raw)
    s, e, doc, h = A.words(low, off, space=NOT_LETTER)
    part, owner = [h], [doc]
    size = e - s
    for n in BEGINNINGS:
        long = np.flatnonzero(size > n)
        key = np.full(len(long), n, np.uint64)
        for j in range(n):
            key = key * np.uint64(0x100000001B3) + low[s[long] + j]
        part.append(A.mix(key))
        owner.append(doc[long])
    return (np.concatenate(part) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(owner)


class Link:
    """One logistic regression: chosen parts, weights, weights of earlier probabilities, intercept."""

    def __init__(self, rows: list[np.ndarray], y: np.ndarray, earlier: np.ndarray, features: int, weight: np.ndarray):
        self.slot = np.full(1 << BITS, -1, np.int32)
        self.share = float((y * weight).sum() / weight.sum()) if len(y) else 0.0
        self.ready = len(set(y.tolist())) == 2
        if not self.ready:
            return
        n1, n0 = y.sum(), len(y) - y.sum()
        with_part = [np.bincount(np.concatenate([r for r, v in zip(rows, y) if v == k] or [np.empty(0, np.int64)]),
                                 minlength=1 << BITS) for k in (1, 0)]
        p1, p0 = with_part[0] / n1, with_part[1] / n0
        pooled = (with_part[0] + with_part[1]) / len(y)
        z = np.abs(p1 - p0) / np.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n0) + 1e-12)
        z[with_part[0] + with_part[1] < 3] = 0
        chosen = np.argsort(-z, kind="stable")[:features]
        chosen = np.sort(chosen[z[chosen] > 3.5])
        self.slot[chosen] = np.arange(len(chosen))
        doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        flat = self.slot[np.concatenate(rows)] if rows else np.empty(0, int)
        doc, flat = doc[flat >= 0], flat[flat >= 0]
        self.w, self.v, self.b = np.zeros(len(chosen)), np.zeros(earlier.shape[1]), 0.0
        state = [np.zeros(len(chosen) + earlier.shape[1] + 1) for _ in range(2)]
        total = weight.sum()
        for step in range(1, 301):                                  # Adam, full batch
            s = np.bincount(doc, weights=self.w[flat], minlength=len(rows)) + earlier @ self.v + self.b
            g = (y - 1 / (1 + np.exp(-np.clip(s, -30, 30)))) * weight / total
            grad = np.concatenate([np.bincount(flat, weights=g[doc], minlength=len(chosen)) - 1e-4 * self.w,
                                   earlier.T @ g - 1e-4 * self.v, [g.sum()]])
            state[0] = .9 * state[0] + .1 * grad
            state[1] = .99 * state[1] + .01 * grad * grad
            move = .05 * (state[0] / (1 - .9**step)) / (np.sqrt(state[1] / (1 - .99**step)) + 1e-9)
            self.w += move[:len(chosen)]
            self.v += move[len(chosen):-1]
            self.b += move[-1]

    def logit(self, part: np.ndarray, doc: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        """``part``, ``doc``: distinct pairs."""
        if not self.ready:
            p = min(max(self.share, 1e-4), 1 - 1e-4)
            return np.full(len(earlier), np.log(p / (1 - p)))
        at = self.slot[part]
        hit = at >= 0
        return (np.bincount(doc[hit], weights=self.w[at[hit]], minlength=len(earlier)) + earlier @ self.v + self.b)


def distinct(part, doc):
    key = np.unique(doc * (1 << BITS) + part)
    return key % (1 << BITS), key // (1 << BITS)


def probability(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def train(rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray, features: int = 2000, folds: int = 5) -> list[Link]:
    """The chain: ``rows`` are distinct parts by document, ``y`` one column per category in chain order."""
    n, chain = len(rows), []
    earlier = np.zeros((n, 0))
    doc = np.repeat(np.arange(n), [len(r) for r in rows])
    flat = np.concatenate(rows) if n else np.empty(0, np.int64)
    for k in range(y.shape[1]):
        out = np.zeros(n)
        if k + 1 < y.shape[1]:                                      # the last link's own output feeds nothing
            for f in range(folds):
                inside = np.arange(n) % folds != f
                i, o = np.flatnonzero(inside), np.flatnonzero(~inside)
                link = Link([rows[j] for j in i], y[i, k], earlier[i], features, weight[i])
                sub = ~inside[doc]
                out[o] = link.logit(flat[sub], doc[sub] // folds, earlier[o])
        chain.append(Link(rows, y[:, k], earlier, features, weight))
        earlier = np.column_stack([earlier, probability(out)])
    return chain


def score(chain: list[Link], raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Probabilities [text, category]."""
    n = len(off) - 1
    part, doc = parts(raw, off)
    known = np.zeros(1 << BITS, bool)
    for link in chain:
        known |= link.slot >= 0
    keep = known[part]
    part, doc = distinct(part[keep], doc[keep])
    earlier, out = np.zeros((n, 0)), []
    for link in chain:
        out.append(probability(link.logit(part, doc, earlier)))
        earlier = np.column_stack([earlier, out[-1]])
    return np.column_stack(out)


def fit(docs: DataFrame, labels: DataFrame, categories: list[str], per_class: int, features: int) -> list[Link]:
    def run(batches):
        for table in A.chunks(batches, "text"):
            raw, off = A.utf8(table["text"])
            part, doc = distinct(*parts(raw, off))
            at = np.searchsorted(doc, np.arange(table.num_rows + 1))
            body = [part[at[i]:at[i + 1]].astype(np.int32).tobytes() for i in range(table.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [table["doc_id"].combine_chunks(), *[table[c].combine_chunks() for c in categories], pa.array(body, pa.binary())],
                names=["doc_id", *categories, "body"])

    schema = "doc_id long, " + ", ".join(f"`{c}` int" for c in categories) + ", body binary"
    got = (one_row_per_id(sample(docs, labels, categories, per_class, categories[-1]).mapInArrow(run, schema))
           .orderBy(F.xxhash64("doc_id"), "doc_id").toArrow().to_pylist())        # at most 2 * per_class rows
    rows = [np.frombuffer(r["body"], np.int32).astype(np.int64) for r in got]
    y = np.array([[r[c] for c in categories] for r in got], float).reshape(len(got), len(categories))
    counts = {r["v"]: r["n"] for r in labels.where(~held_out(F.col("doc_id"))).groupBy(F.col(categories[-1]).alias("v"))
              .agg(F.count("*").alias("n")).collect() if r["v"] is not None}
    taken = {v: max((y[:, -1] == v).sum(), 1) for v in (0, 1)}
    weight = np.array([counts.get(int(v), 1) / taken[int(v)] for v in y[:, -1]], float)   # back to the true shares
    return train(rows, y, weight, features)


def toxicity_chain(docs: DataFrame, labels: DataFrame, categories: list[str], *, id_col: str = "doc_id",
                   text_col: str = "text", per_class: int = 3000, features: int = 2000, threshold: float = 0.5) -> DataFrame:
    """One row per input row: doc_id, held_out, ``p_<category>`` of every link and ``toxic`` (the last link's verdict).

    ``categories`` are 0/1 columns of ``labels`` in chain order; the last is the category that decides.
    """
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    chain = fit(d, labels, categories, per_class, features)
    names = [f"p_{c}" for c in categories]

    def run(batches):
        for table in A.chunks(batches, "text"):
            p = score(chain, *A.utf8(table["text"]))
            yield pa.RecordBatch.from_arrays([table["doc_id"].combine_chunks(), *[pa.array(c) for c in p.T]],
                                             names=["doc_id", *names])

    out = d.mapInArrow(run, "doc_id long, " + ", ".join(f"`{n}` double" for n in names))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), *names,
                      (F.col(names[-1]) >= threshold).cast("int").alias("toxic"))
