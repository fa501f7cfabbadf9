"""Plain definitions that the operators are held against."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def substring_dedup(rows, window=13):
    first = {}
    for doc, text in rows:
        if doc is None:
            continue
        w = words(text)
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, doc), doc)
    out = []
    for doc, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if doc is not None and first[tuple(w[i:i + window])] < doc:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


ASSIGN = re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


def secret_spans(text):
    t = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(t) if len(m[0]) >= 24]
    return [(("assign", "access", "hex")[k], s, e) for s, k, e in sorted(out)]


def shingles(text, size=5):
    w = words(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) or frozenset([tuple(w)])


def jaccard_components(rows, size=5, percent=75):
    """{row: (set size, smallest reachable id)} by comparing all pairs that share a shingle."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    holders, ids = {}, {}
    for i, (doc, _) in enumerate(rows):
        root[find(i)] = find(ids.setdefault(doc, i))
    met = set()
    for i, s in enumerate(sets):
        near = {}
        for x in s:
            for j in holders.get(x, ()):
                near[j] = near.get(j, 0) + 1
            holders.setdefault(x, []).append(i)
        for j, k in near.items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                met.add((i, j))
    for i, j in met:
        root[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), doc), doc)
    return sorted((doc, len(sets[i]), low[find(i)]) for i, (doc, _) in enumerate(rows))


def quality_base(text):
    """(words, characters in words, symbols, repeated lines, words in repeated three-word windows, failed)."""
    t = text or ""
    w = words(t)
    lines = [x for x in t.split("\n") if words(x)]
    seen = {}
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i:i + 3]), []).append(i)
    covered = {j for at in seen.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))
