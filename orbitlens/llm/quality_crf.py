"""Quality classifier: a linear-chain conditional random field over lines.

Every line is good or bad.  A line's potentials come from its own shape and
that of its neighbours (shares of letters, capitals, digits, symbols, repeated
words, repeated lines and so on); a 2 x 2 table scores neighbouring labels.
Forward-backward gives each line's marginal; a document's quality is the mean
marginal weighted by line length, put on a probability scale by a logistic fit.

Training takes a bounded sample (``per_class`` labelled documents of each
label, least id hash first, never a held-out id; ``max_lines`` lines in all);
lines carry their document's label.  Scoring covers every line of every text.
Only the text is an input of a score: no label, language, source or id.

Defined results: a null or empty text is one empty line; repeated rows and null
ids each give their row (a null id is not held out); an empty table gives an
empty result; without labelled rows of both kinds every score is 0.5; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitlens.llm import arrays as A
from orbitlens.llm.labels import held_out, one_row_per_id, sample

SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>@^~=_{}[]\\"]] = True
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
STOP = np.zeros(256, bool)
STOP[[ord(c) for c in ".,;:?"]] = True
OWN = 14                       # features of a line itself
WIDTH = 1 + OWN + 2 * OWN + 2  # bias, own, previous line, next line, first, last


def line_features(raw: np.ndarray, off: np.ndarray):
    """(features[line, WIDTH], document of line, weight of line); a text without \\n is one line."""
    n_docs = len(off) - 1
    cut = np.flatnonzero(raw == 10) + 1
    # a text opens a line, and so does every \\n: also one that is the last byte of its text
    owner = np.concatenate([np.arange(n_docs), np.searchsorted(off, cut - 1, side="right") - 1])
    at = np.concatenate([off[:-1], cut])
    o = np.lexsort((at, owner))
    doc, starts = owner[o], at[o]
    last_of_doc = np.append(doc[1:] != doc[:-1], True)
    ends = np.where(last_of_doc, off[doc + 1], np.append(starts[1:], len(raw)))
    n = len(starts)
    size = (ends - starts).astype(np.float64)

    def count(table):
        total = np.concatenate(([0], np.cumsum(table, dtype=np.int64)))
        return (total[ends] - total[starts]).astype(np.float64)

    letters = count(LETTER[raw])
    upper = UPPER[raw]
    if len(raw) > 1:                                             # capitals of two-byte Latin letters
        upper = upper.copy()
        upper[1:] |= (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)
    w_start, w_end, _, w_hash = A.words(raw, off)
    line = np.searchsorted(ends, w_start, side="right")          # the line that ends after the word's start
    words = np.bincount(line, minlength=n).astype(np.float64)
    per = lambda x: np.bincount(line, weights=x, minlength=n)
    again = np.zeros(len(line))
    distinct = words.copy()
    if len(line):
        again[1:] = (w_hash[1:] == w_hash[:-1]) & (line[1:] == line[:-1])
        key = A.mix(w_hash + line.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        rank = np.argsort(key)
        head = np.concatenate(([True], key[rank][1:] != key[rank][:-1]))
        distinct = np.bincount(line[rank][head], minlength=n).astype(np.float64)
        end_symbol = SYMBOL[raw[w_end - 1]].astype(float)
        sums = np.zeros(n, np.uint64)
        first, _ = A.spans(line)
        weight = np.arange(len(line), dtype=np.uint64) - np.repeat(first, np.diff(np.append(first, len(line)))).astype(np.uint64)
        sums[line[first]] = np.add.reduceat(A.mix(w_hash + (weight + np.uint64(1)) * np.uint64(0xD1342543DE82EF95)), first)
    else:
        end_symbol, sums = np.empty(0), np.zeros(n, np.uint64)
    repeated = np.zeros(n)
    filled = np.flatnonzero(words > 0)
    if len(filled):
        key = A.mix(sums[filled] + doc[filled].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        rank = np.argsort(key, kind="stable")
        same = np.concatenate(([False], key[rank][1:] == key[rank][:-1]))
        repeated[filled[rank[same]]] = 1
    per_byte, per_word, per_letter = np.maximum(size, 1), np.maximum(words, 1), np.maximum(letters, 1)
    own = np.column_stack([
        np.log1p(words) / 5, letters / per_byte, count(upper) / per_letter, count(DIGIT[raw]) / per_byte,
        np.minimum(8 * count(SYMBOL[raw]) / per_byte, 2), np.minimum(8 * count(raw == 33) / per_byte, 2),
        8 * np.minimum(count(STOP[raw]) / per_byte, .25), per(again) / per_word, 1 - distinct / per_word, repeated,
        np.minimum(letters / per_word / 10, 2), per(end_symbol) / per_word, count(raw >= 128) / per_byte,
        (words == 0).astype(float)]).astype(np.float32)
    before, after = np.zeros_like(own), np.zeros_like(own)
    first_line = np.concatenate(([True], doc[1:] != doc[:-1]))
    before[1:][~first_line[1:]] = own[:-1][~first_line[1:]]
    after[:-1][~last_of_doc[:-1]] = own[1:][~last_of_doc[:-1]]
    x = np.column_stack([np.ones(n, np.float32), own, before, after, first_line, last_of_doc]).astype(np.float32)
    return x, doc, np.maximum(size, 1)


class Chains:
    """Forward-backward over many chains at once: step t handles all chains longer than t."""

    def __init__(self, doc: np.ndarray):
        first, length = A.spans(doc)
        order = np.argsort(-length, kind="stable")
        self.first, self.length = first[order], length[order]
        self.doc = doc[self.first] if len(first) else first
        self.alive = [int(np.searchsorted(-self.length, -t)) for t in range(int(length.max()) if len(length) else 0)]

    def run(self, unary: np.ndarray, trans: np.ndarray):
        """(marginals[line, 2], pair sums[2, 2], log partition by chain)."""
        n = len(unary)
        a, b = np.empty((n, 2)), np.zeros((n, 2))
        for t, k in enumerate(self.alive):
            at = self.first[:k] + t
            if t == 0:
                a[at] = unary[at]
            else:
                p = a[at - 1]
                a[at] = unary[at] + np.logaddexp(p[:, :1] + trans[0], p[:, 1:] + trans[1])
        for t in range(len(self.alive) - 1, 0, -1):
            at = self.first[:self.alive[t]] + t
            q = unary[at] + b[at]
            b[at - 1] = np.logaddexp(trans[:, 0] + q[:, :1], trans[:, 1] + q[:, 1:])
        end = self.first + self.length - 1
        z = np.logaddexp(a[end, 0], a[end, 1])
        whole = np.empty(n)
        span = np.repeat(z, self.length)
        whole[np.concatenate([np.arange(f, f + m) for f, m in zip(self.first, self.length)]) if n else []] = span
        marginal = np.exp(a + b - whole[:, None])
        inner = np.ones(n, bool)
        inner[self.first] = False
        i = np.flatnonzero(inner)
        pair = np.zeros((2, 2))
        if len(i):
            q = unary[i] + b[i]
            pair = np.exp(a[i - 1][:, :, None] + trans[None] + q[:, None, :] - whole[i][:, None, None]).sum(0)
        return marginal, pair, z


def train(x, doc, y_doc, weight, steps: int = 150, l2: float = 1e-3) -> dict:
    """Maximum likelihood (Adam, full batch) of weights[2, width] and transitions[2, 2], then the logistic scale."""
    chains = Chains(doc)
    y = y_doc[doc].astype(int)
    mean, spread = x.mean(0), x.std(0) + 1e-3
    mean[0], spread[0] = 0, 1
    x = (x - mean) / spread
    theta = np.zeros(2 * x.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    truth = np.column_stack([y == 0, y == 1]).astype(float)
    inner = np.flatnonzero(np.concatenate(([False], doc[1:] == doc[:-1])))
    pairs = np.zeros((2, 2))
    np.add.at(pairs, (y[inner - 1], y[inner]), 1)
    # a long text must not outweigh the others: its lines share one document's weight
    lines = np.bincount(doc)[doc].astype(float)
    for step in range(1, steps + 1):
        w, trans = theta[:-4].reshape(2, -1), theta[-4:].reshape(2, 2)
        marginal, pair, _ = chains.run(x @ w.T, trans)
        g = np.concatenate([(((truth - marginal) / lines[:, None]).T @ x).ravel() / (doc.max() + 1),
                            ((pairs - pair) / max(len(y), 1)).ravel()]) - l2 * theta
        m, v = .9 * m + .1 * g, .99 * v + .01 * g * g
        theta += .1 * (m / (1 - .9**step)) / (np.sqrt(v / (1 - .99**step)) + 1e-8)
    model = {"w": theta[:-4].reshape(2, -1), "trans": theta[-4:].reshape(2, 2), "mean": mean, "spread": spread}
    s = _pooled(model, (x * spread + mean), doc, weight, len(y_doc))
    a, b = 1.0, 0.0
    for _ in range(200):                                          # logistic scale, ridge towards the identity
        p = 1 / (1 + np.exp(-(a * s + b)))
        e = y_doc - p
        h = p * (1 - p)
        ga, gb = (e * s).sum() - (a - 1), e.sum() - b
        haa, hab, hbb = (h * s * s).sum() + 1, (h * s).sum(), h.sum() + 1
        det = haa * hbb - hab * hab
        a, b = a + (hbb * ga - hab * gb) / det, b + (haa * gb - hab * ga) / det
    return model | {"a": a, "b": b}


def _pooled(model, x, doc, weight, n_docs):
    """Logit of the length-weighted mean marginal of 'good'."""
    x = (x - model["mean"]) / model["spread"]
    marginal, _, _ = Chains(doc).run(x @ model["w"].T, model["trans"])
    good = np.bincount(doc, weights=marginal[:, 1] * weight, minlength=n_docs) / np.bincount(doc, weights=weight, minlength=n_docs)
    good = np.clip(good, 1e-4, 1 - 1e-4)
    return np.log(good / (1 - good))


def score(model, raw, off) -> tuple[np.ndarray, np.ndarray]:
    """(probability of good, lines) of every text."""
    x, doc, weight = line_features(raw, off)
    n_lines = np.bincount(doc, minlength=len(off) - 1)
    if model is None:
        return np.full(len(off) - 1, 0.5), n_lines
    s = _pooled(model, x.astype(np.float64), doc, weight, len(off) - 1)
    return 1 / (1 + np.exp(-(model["a"] * s + model["b"]))), n_lines


def fit(docs: DataFrame, labels: DataFrame, *, per_class: int = 2000, max_lines: int = 200_000) -> dict | None:
    """Model from the bounded sample; None without documents of both labels."""
    def run(batches):
        for table in A.chunks(batches, "text"):
            raw, off = A.utf8(table["text"])
            x, doc, weight = line_features(raw, off)
            first, n = A.spans(doc)
            body = [np.column_stack([x[a:a + k], weight[a:a + k]]).astype(np.float32).tobytes() for a, k in zip(first, n)]
            yield pa.RecordBatch.from_arrays([table["doc_id"].combine_chunks(), table["quality"].combine_chunks(),
                                              pa.array(body, pa.binary())], names=["doc_id", "quality", "body"])

    rows = one_row_per_id(sample(docs, labels, ["quality"], per_class, "quality")
                          .mapInArrow(run, "doc_id long, quality int, body binary"))
    got = rows.orderBy(F.xxhash64("doc_id"), "doc_id").toArrow().to_pylist()      # bounded by per_class
    xs, ys, total = [], [], 0
    for r in got:
        m = np.frombuffer(r["body"], np.float32).reshape(-1, WIDTH + 1)
        if xs and total + len(m) > max_lines:
            continue
        xs.append(m)
        ys.append(r["quality"])
        total += len(m)
    if len(set(ys)) < 2:
        return None
    doc = np.repeat(np.arange(len(xs)), [len(m) for m in xs])
    m = np.concatenate(xs).astype(np.float64)
    return train(m[:, :-1], doc, np.array(ys, float), m[:, -1])


def quality_crf(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                threshold: float = 0.3, per_class: int = 2000) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted, n_lines."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    model = fit(d, labels, per_class=per_class)

    def run(batches):
        for table in A.chunks(batches, "text"):
            raw, off = A.utf8(table["text"])
            p, n = score(model, raw, off)
            yield pa.RecordBatch.from_arrays([table["doc_id"].combine_chunks(), pa.array(p), pa.array(n.astype(np.int64))],
                                             names=["doc_id", "score", "n_lines"])

    scored = d.mapInArrow(run, "doc_id long, score double, n_lines long")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"), "n_lines")


def keep_good(docs: DataFrame, labels: DataFrame, *, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, all columns unchanged."""
    model = fit(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), labels)

    def run(batches):
        for table in A.chunks(batches, text_col):
            p, _ = score(model, *A.utf8(table[text_col]))
            yield from table.filter(pa.array(p >= threshold)).combine_chunks().to_batches()

    return docs.mapInArrow(run, docs.schema)
