"""Benchmark decontamination: pigeonhole pieces, then bit-parallel edit distance.

Method: an item of length m may differ by ``k = floor(rate * m)`` edits from
its copy in a text.  Cut it into k + 1 pieces: k edits cannot touch them all,
so every such copy holds one piece exactly, within k places of where the item
puts it.  An Aho-Corasick automaton finds all piece hits in one pass over the
whole text; hits of one item on neighbouring diagonals share one window, and
Myers' bit-parallel distance decides.

Items and texts are compared in lower case with white space runs as one space.
The items are a stated query set: they pass in blocks of ``block_chars``
characters, each block against all texts, so what goes out to the tasks is
bounded however large the benchmark is.

Defined results: null and empty texts match nothing, null and blank items too;
an item shorter than ``min_chars`` matches only as it stands, from word to word
(a letter of a script without spaces is a word); an item without an id drops
documents like any other, but ``find_leaks``, whose rows name the item, gives
none for it; equal items with different ids each match; repeated text rows each give their rows;
an empty table on either side gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitlens.llm import arrays as A

SCHEMA = "doc_id long, item_id long, distance int, budget int, start int, end int"


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def nearest(pattern_bits: dict, m: int, window: str, stop: int) -> tuple[int, int]:
    """(least edit distance of the pattern to a substring of ``window``, end of that substring), by Myers."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, now, best, at = full, 0, m, m, 0
    for i, c in enumerate(window):
        eq = pattern_bits.get(c, 0)
        across = (((eq & plus) + plus) ^ plus) | eq
        down = eq | minus
        up_h = minus | (full & ~(across | plus))
        down_h = plus & across
        if up_h & top:
            now += 1
        elif down_h & top:
            now -= 1
            if now < best:
                best, at = now, i + 1
                if best <= stop:
                    break
        up_h = (up_h << 1) & full
        plus = ((down_h << 1) & full) | (full & ~(down | up_h))
        minus = up_h & down
    return best, at


def parted(text: str, at: int) -> bool:
    """No word of ``text`` runs over place ``at``."""
    if at <= 0 or at >= len(text):
        return True
    a, b = text[at - 1], text[at]
    return not (a.isalnum() and b.isalnum()) or max(a, b) >= "\u2e80"


class Items:
    """One block of items, ready to scan texts; those under ``min_chars`` match as they stand."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float, min_chars: int = 0):
        import ahocorasick

        self.text = [t for _, t in items]
        self.ids = [i for i, _ in items]
        self.short = [len(t) < min_chars for t in self.text]
        self.budget = [0 if s else int(rate * len(t)) for t, s in zip(self.text, self.short)]
        self.bits = []
        pieces: dict[str, list[tuple[int, int]]] = {}
        for n, (text, k) in enumerate(zip(self.text, self.budget)):
            bits: dict[str, int] = {}
            for i, c in enumerate(text):
                bits[c] = bits.get(c, 0) | 1 << i
            self.bits.append(bits)
            for p in range(k + 1):
                a, z = p * len(text) // (k + 1), (p + 1) * len(text) // (k + 1)
                pieces.setdefault(text[a:z], []).append((n, a))
        self.find = ahocorasick.Automaton()
        for piece, where in pieces.items():
            self.find.add_word(piece, (len(piece), where))
        if pieces:
            self.find.make_automaton()
        self.any = bool(pieces)

    def matches(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item, distance, start, end) for the best place of every item within its budget."""
        if not self.any or not text:
            return
        diagonals: dict[int, set[int]] = {}
        whole: dict[int, int] = {}                  # short item -> its first place
        for end, (size, where) in self.find.iter(text):
            for n, a in where:
                if self.short[n]:
                    if n not in whole and parted(text, end + 1 - size) and parted(text, end + 1):
                        whole[n] = end + 1 - size
                    continue
                diagonals.setdefault(n, set()).add(end + 1 - size - a)
        for n, start in whole.items():
            yield n, 0, start, start + len(self.text[n])
        for n, found in diagonals.items():
            item, k = self.text[n], self.budget[n]
            m = len(item)
            exact = text.find(item)
            if exact >= 0:
                yield n, 0, exact, exact + m
                continue
            best, low, high = (k + 1, 0), None, None
            for d in [*sorted(found), None]:
                if low is not None and (d is None or d - high > 2 * k):
                    a = max(0, low - k)
                    distance, end = nearest(self.bits[n], m, text[a:high + m + k], 0)
                    best = min(best, (distance, a + end))
                    low = None
                if d is not None:
                    low, high = d if low is None else low, d
            if best[0] <= k:
                yield n, best[0], max(0, best[1] - m), best[1]


def blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of bounded size, streamed."""
    rows = (benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
            .where("t is not null").distinct().orderBy("i", "t"))
    block, size = [], 0
    for r in rows.toLocalIterator():
        t = normal(r.t)
        if not t:
            continue
        if block and size + len(t) > block_chars:
            yield block
            block, size = [], 0
        block.append((r.i, t))
        size += len(t)
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
               item_id_col: str = "item_id", item_text_col: str = "text", rate: float = 0.08, min_chars: int = 30,
               block_chars: int = 2_000_000) -> DataFrame:
    """One row per (text row, item) within the item's budget: the best place, in the normalised text."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def scan(items):
        def run(batches):
            block = Items(items, rate, min_chars)
            for table in A.chunks(batches, "text"):
                rows = []
                for doc, text in zip(table["doc_id"].to_pylist(), table["text"].to_pylist()):
                    rows += [(doc, block.ids[n], x, block.budget[n], s, e) for n, x, s, e in block.matches(normal(text))]
                kinds = [pa.int64(), pa.int64()] + [pa.int32()] * 4
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                                 names=["doc_id", "item_id", "distance", "budget", "start", "end"])
        return d.mapInArrow(run, SCHEMA)

    named = benchmark.where(F.col(item_id_col).isNotNull())
    found = [scan(b) for b in blocks(named, item_id_col, item_text_col, block_chars)]
    if not found:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    return reduce(DataFrame.unionAll, found)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", rate: float = 0.08, min_chars: int = 30,
               block_chars: int = 2_000_000) -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns unchanged."""
    def keep(items):
        def run(batches):
            block = Items(items, rate, min_chars)
            for table in A.chunks(batches, text_col):
                clean = [next(block.matches(normal(t)), None) is None for t in table[text_col].to_pylist()]
                yield from table.filter(pa.array(clean, pa.bool_())).combine_chunks().to_batches()
        return run

    for b in blocks(benchmark, "item_id", "text", block_chars):
        docs = docs.mapInArrow(keep(b), docs.schema)
    return docs
