"""Secret scans: one minimal automaton for all rules, one pass over the bytes.

Method: every rule's regular expression becomes a small NFA; subset
construction joins them into one deterministic automaton that looks for all
rules at every position at once; partition refinement minimises it; the result
is one transition array.  A text's UTF-8 bytes go through it once.  Where a
rule fires, its own reversed automaton finds the leftmost start and its own
forward automaton the greedy end, so spans are leftmost and non-overlapping per
kind; too short ones are dropped afterwards, as they still use up their bytes.

What follows a match and is part of the secret (a private key's lines) is a
rule's ``rest``: only the forward automaton knows it.

Rule syntax: literals, ``[...]`` classes, groups with ``|``, ``?``, ``*``,
``+``, ``{n,}``, ``\\xHH`` and ``\\`` escapes, on bytes.  A rule must not let
a match begin inside the part of another match of it that is not yet complete
(true of keyword + value rules).

Defined results: null and empty texts have no spans (``base_sha256`` is the
digest of the empty string); every row gives a row, repeated or null ids too;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitlens.llm import arrays as A


@dataclass(frozen=True)
class Rule:
    """``head`` then ``tail``; kept if head + tail has ``least`` and the tail ``least_tail`` bytes."""
    kind: str
    head: str
    tail: str
    least: int = 0
    least_tail: int = 0
    fold: bool = False       # letters of the head in either case
    rest: str = ""           # what may follow head + tail: never sought, taken as far as it goes


#: fixed rules of the contract, in its order of kinds
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=-]+",
         least_tail=6, fold=True),
    Rule("access", r"AKIA", r"[A-Z0-9]+", least=20),
    Rule("hex", r"", r"[0-9a-f]{9,}", least=24),       # runs are maximal: few states now, the length afterwards
)
#: header lines of a key block; line breaks may be escaped, as in JSON
PEM_HEADERS = r"([\x0A\x0D\x5Cnr]+[A-Za-z0-9-]+:\x20[A-Za-z0-9\x20,.:;/+=()@_<>-]*)*"
#: what the method adds; a private key runs through its END line, one without to its last base64 line
EXTRA = (
    Rule("github", r"gh[opsur]_", r"[A-Za-z0-9]+", least_tail=36),
    Rule("slack", r"xox[abprs]-", r"[A-Za-z0-9-]+", least_tail=10),
    Rule("google", r"AIza", r"[A-Za-z0-9_-]+", least_tail=35),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.", r"[A-Za-z0-9_-]+", least_tail=10),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"",
         rest=PEM_HEADERS + r"([A-Za-z0-9+/=\x09\x0A\x0D\x20\"'>,\x5C]*-----END [A-Z ]*PRIVATE KEY-----"
              r"|(([\x09\x0A\x0D\x20\"'>,\x5C]+[A-Za-z0-9+/=]{16,})+([\x0A\x0D]+[A-Za-z0-9+/=]+)?)?)"),
)


# ------------------------------------------------------------------ syntax
def parse(pattern: str, fold: bool = False):
    """Tree of ('set', bytes), ('seq', [...]), ('alt', [...]), ('rep', node, least, most or None)."""
    at = 0

    def escaped():
        nonlocal at
        at += 1
        c = pattern[at]
        at += 1
        if c == "x":
            at += 2
            return int(pattern[at - 2:at], 16)
        return ord(c)

    def letters(found):
        if fold:
            found |= {b ^ 32 for b in found if 65 <= b <= 90 or 97 <= b <= 122}
        return ("set", frozenset(found))

    def bracket():
        nonlocal at
        at += 1
        out: set[int] = set()
        while pattern[at] != "]":
            a = escaped() if pattern[at] == "\\" else ord(pattern[at])
            if pattern[at - 1] != "\\" and a == ord(pattern[at]):
                at += 1
            if pattern[at] == "-" and pattern[at + 1] != "]":
                z = ord(pattern[at + 1])
                at += 2
                out |= set(range(a, z + 1))
            else:
                out.add(a)
        at += 1
        return letters(out)

    def atom():
        nonlocal at
        c = pattern[at]
        if c == "(":
            at += 1
            node = choice()
            at += 1
            return node
        if c == "[":
            return bracket()
        if c == "\\":
            return letters({escaped()})
        at += 1
        return letters({ord(c)})

    def sequence():
        nonlocal at
        out = []
        while at < len(pattern) and pattern[at] not in "|)":
            node = atom()
            while at < len(pattern) and pattern[at] in "?*+{":
                c = pattern[at]
                if c == "{":
                    end = pattern.index("}", at)
                    low, _, high = pattern[at + 1:end].partition(",")
                    node = ("rep", node, int(low), int(high) if high else None)
                    at = end
                else:
                    node = ("rep", node, int(c == "+"), 1 if c == "?" else None)
                at += 1
            out.append(node)
        return ("seq", out)

    def choice():
        nonlocal at
        out = [sequence()]
        while at < len(pattern) and pattern[at] == "|":
            at += 1
            out.append(sequence())
        return ("alt", out) if len(out) > 1 else out[0]

    return choice()


def flipped(node):
    """The tree of the reversed language."""
    kind = node[0]
    if kind == "set":
        return node
    if kind == "rep":
        return ("rep", flipped(node[1]), *node[2:])
    return (kind, [flipped(x) for x in (node[1][::-1] if kind == "seq" else node[1])])


# -------------------------------------------------------------- construction
class Nfa:
    def __init__(self):
        self.eps: list[list[int]] = []
        self.step: list[tuple[frozenset, int] | None] = []

    def state(self) -> int:
        self.eps.append([])
        self.step.append(None)
        return len(self.eps) - 1

    def add(self, node, a: int) -> int:
        """Build ``node`` from state ``a``; the end state."""
        if node[0] == "set":
            z = self.state()
            self.step[a] = (node[1], z)
            mid = self.state()
            self.eps[z].append(mid)
            return mid
        if node[0] == "seq":
            for x in node[1]:
                a = self.add(x, a)
            return a
        if node[0] == "alt":
            z = self.state()
            for x in node[1]:
                s = self.state()
                self.eps[a].append(s)
                self.eps[self.add(x, s)].append(z)
            return z
        _, inner, low, high = node
        for _ in range(low):
            a = self.add(inner, a)
        z = self.state()
        if high is None:
            s = self.state()
            self.eps[a] += [s, z]
            self.eps[self.add(inner, s)] += [s, z]
            return z
        self.eps[a].append(z)
        for _ in range(high - low):
            s = self.state()
            self.eps[a].append(s)
            a = self.add(inner, s)
            self.eps[a].append(z)
        return z

    def closure(self, found) -> frozenset:
        todo, seen = list(found), set(found)
        while todo:
            for y in self.eps[todo.pop()]:
                if y not in seen:
                    seen.add(y)
                    todo.append(y)
        return frozenset(x for x in seen if self.step[x] is not None or x in self.ends)

    ends: dict[int, int] = {}


def automaton(trees: list, anywhere: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimal (transitions[state, column], column[byte], accepting rules as bits[state]); state 0 starts."""
    nfa, starts, ends = Nfa(), [], {}
    for k, tree in enumerate(trees):
        s = nfa.state()
        starts.append(s)
        ends[nfa.add(tree, s)] = 1 << k
    nfa.ends = ends
    # bytes that no rule tells apart are one column
    sets = {x[0] for x in nfa.step if x}
    column: dict[tuple, int] = {}
    of = np.array([column.setdefault(tuple(b in s for s in sets), len(column)) for b in range(256)])
    sample = [int(np.flatnonzero(of == c)[0]) for c in range(len(column))]
    first = nfa.closure(starts)
    index, todo, trans, mask = {first: 0}, [first], [], []
    while todo:
        now = todo.pop(0)
        mask.append(sum({ends[x] for x in now if x in ends}))
        row = []
        for b in sample:
            reach = {nfa.step[x][1] for x in now if nfa.step[x] and b in nfa.step[x][0]}
            nxt = nfa.closure(reach | set(starts)) if anywhere else nfa.closure(reach)
            if nxt not in index:
                index[nxt] = len(index)
                todo.append(nxt)
            row.append(index[nxt])
        trans.append(row)
    trans, mask = np.array(trans), np.array(mask)
    # partition refinement: states split until equal rows mean equal states
    block = np.unique(mask, return_inverse=True)[1].reshape(-1)
    while True:
        finer = np.unique(np.column_stack([block, block[trans]]), axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    block = (block - block[0]) % (block.max() + 1)      # the start becomes state 0
    member = np.zeros(block.max() + 1, int)
    member[block] = np.arange(len(block))
    return np.ascontiguousarray(block[trans[member]]).astype(np.int32), of.astype(np.uint8), mask[member].astype(np.int64)


@dataclass
class Scanner:
    """All that a task needs: the joint automaton and, per rule, forward, reversed and head automata."""
    rules: tuple
    joint: tuple
    single: list

    @classmethod
    @lru_cache(maxsize=8)
    def build(cls, rules: tuple) -> Scanner:
        single, trees = [], []
        for r in rules:
            head, tail = parse(r.head, r.fold), parse(r.tail)
            both = ("seq", [head, tail])
            trees.append(both)
            single.append({"walk": automaton([("seq", [both, parse(r.rest)])], False), "back": automaton([flipped(both)], False),
                           "find": automaton([both], True), "head": automaton([head], False)})
        return cls(rules, automaton(trees, True), single)

    def prepare(self) -> Scanner:
        """A copy with the tables as lists by byte, for the scanning loops."""
        trans, of, mask = self.joint
        rows = [[None] * 256 + [int(m)] for m in mask]
        for row, to in zip(rows, trans):
            row[:256] = [rows[t] for t in to[of].tolist()]
        single = [{name: (t[:, of].tolist(), m.tolist(), [bool((t[s] == s).all() and not m[s]) for s in range(len(m))])
                   for name, (t, of, m) in one.items()} for one in self.single]
        ready = Scanner(self.rules, self.joint, single)
        ready.start = rows[0]
        return ready

    def fired(self, data: bytes) -> dict[int, list[list[int]]]:
        """Rule -> runs [first, last] of positions at which a match of it may end."""
        out: dict[int, list[list[int]]] = {}
        row, i = self.start, 0
        for c in data:
            row = row[c]
            i += 1
            if row[256]:
                bits, k = row[256], 0
                while bits:
                    if bits & 1:
                        runs = out.setdefault(k, [])
                        if runs and runs[-1][1] == i - 1:
                            runs[-1][1] = i
                        else:
                            runs.append([i, i])
                    bits >>= 1
                    k += 1
        return out

    def _longest(self, one, data, at):
        trans, mask, stuck = one
        s, best = 0, at if mask[0] else -1
        for i in range(at, len(data)):
            s = trans[s][data[i]]
            if mask[s]:
                best = i + 1
            elif stuck[s]:
                break
        return best

    def _leftmost(self, k, data, end, floor):
        trans, mask, stuck = self.single[k]["back"]
        s, best = 0, -1
        for i in range(end - 1, floor - 1, -1):
            s = trans[s][data[i]]
            if mask[s]:
                best = i
            elif stuck[s]:
                break
        return best

    def _first_end(self, k, data, at, stop):
        trans, mask, _ = self.single[k]["find"]
        s = 0
        for i in range(at, stop):
            s = trans[s][data[i]]
            if mask[s]:
                return i + 1
        return -1

    def matches(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes, by start, then rule."""
        found = []
        for k, runs in self.fired(data).items():
            rule, p, r = self.rules[k], 0, 0
            while r < len(runs):
                first, last = runs[r]
                if last <= p:
                    r += 1
                    continue
                end = first if first > p else -1
                start = self._leftmost(k, data, end, p) if end >= 0 else -1
                if start < 0:                      # that end belongs to an overlapping match: look again from here
                    end = self._first_end(k, data, p, last)
                    if end < 0:
                        r += 1
                        continue
                    start = self._leftmost(k, data, end, p)
                end = self._longest(self.single[k]["walk"], data, start)
                tail = end - self._longest(self.single[k]["head"], data, start) if rule.least_tail else 0
                if end - start >= rule.least and tail >= rule.least_tail:
                    found.append((start, k, end))
                p = end
        found.sort()
        return found

    def spans(self, data: bytes) -> list[tuple[str, int, int]]:
        """(kind, start, end) in code points."""
        out, at, point = [], 0, {}
        hits = self.matches(data)
        total = 0
        for b in sorted({x for s, _, e in hits for x in (s, e)}):
            total += len(data[at:b].decode("utf-8", "replace"))
            at = b
            point[b] = total
        for s, k, e in hits:
            out.append((self.rules[k].kind, point[s], point[e]))
        return out


# --------------------------------------------------------------------- Spark
SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
          "n_spans long")


def _joined(found) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in found)


def secret_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rules=BASE + EXTRA) -> DataFrame:
    """One row per input row with its spans (see ``SCHEMA``); kinds of ``BASE`` count as base."""
    scanner = Scanner.build(tuple(rules))
    base = {r.kind for r in BASE}
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        scan = scanner.prepare()
        for table in A.chunks(batches, "text", 4 << 20):
            raw, off = A.utf8(table["text"])
            rows = []
            for i in range(len(off) - 1):
                found = scan.spans(raw[off[i]:off[i + 1]].tobytes())
                own = [x for x in found if x[0] in base]
                kinds = [x[0] for x in own]
                rows.append((kinds.count("assign"), kinds.count("access"), kinds.count("hex"),
                             hashlib.sha256(_joined(own).encode()).hexdigest(), _joined(found), len(found)))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            cols = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([table["doc_id"].combine_chunks(), *cols],
                                             names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans",
                                                    "n_spans"])

    return d.mapInArrow(run, SCHEMA)


def redact(docs: DataFrame, *, text_col: str = "text", mark: str = "<secret>", rules=BASE + EXTRA) -> DataFrame:
    """The same rows and columns with every span of ``text_col`` replaced by ``mark`` (overlaps merge)."""
    scanner = Scanner.build(tuple(rules))
    schema, at = docs.schema, docs.columns.index(text_col)

    def run(batches):
        scan = scanner.prepare()
        for table in A.chunks(batches, text_col, 4 << 20):
            raw, off = A.utf8(table[text_col])
            texts = table[text_col].to_pylist()
            for i in range(len(texts)):
                hits = scan.matches(raw[off[i]:off[i + 1]].tobytes())
                if not hits:
                    continue
                data, out, p = raw[off[i]:off[i + 1]].tobytes(), [], 0
                for s, _, e in hits:
                    if s >= p:
                        out += [data[p:s], mark.encode()]
                    p = max(p, e)
                texts[i] = (b"".join(out) + data[p:]).decode("utf-8", "replace")
            yield from table.set_column(at, text_col, pa.array(texts, pa.string())).combine_chunks().to_batches()

    return docs.mapInArrow(run, schema)
