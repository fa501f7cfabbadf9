"""SentencePiece encoding and decoding on the tokenizers library.

Method: read the model's protobuf fields, rebuild from them the normaliser
(character map, white space rules), the metaspace marker, the pieces with their
scores and byte fallback, and encode whole batches with the library's threads.
A unigram model keeps its scores; for a pair-merge model the scores give the
merge order.  Parity: every text is also decoded and held against its
normalised form, and ids are held against the sentencepiece library.

Word boundaries: if no piece joins a letter to a following marker, no merge can
cross the place before a marker, so texts are split there first (exact).  In
texts of single spaces a word then always has the same ids: a chunk's distinct
words (by 64-bit hash) are encoded as one batch and the texts put together from
them; all other texts are encoded whole.

The model file is read on the driver and goes out as bytes (a fixed size).

Defined results: null and empty texts have no ids and decode to the empty
string; repeated rows and null ids each give their row; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbitlens.llm import arrays as A

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def fields(data: bytes):
    """(field number, value) of a protobuf message: numbers for varints, bytes for the rest."""
    at = 0

    def varint():
        nonlocal at
        shift = value = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, data[at:at + size]
            at += size


def read_model(data: bytes) -> dict:
    """Pieces, model type and normaliser settings; the numbers are the format's fixed field numbers."""
    m = {"pieces": [], "type": 1, "byte_fallback": False, "unk": 0, "charsmap": b"", "prefix": True, "collapse": True,
         "escape": True, "suffix": False}
    for number, value in fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            m["pieces"].append((piece, score, kind))
        elif number == 2:
            for n, v in fields(value):
                name = {3: "type", 24: "suffix", 35: "byte_fallback", 40: "unk"}.get(n)
                if name:
                    m[name] = v
        elif number == 3:
            for n, v in fields(value):
                name = {2: "charsmap", 3: "prefix", 4: "collapse", 5: "escape"}.get(n)
                if name:
                    m[name] = v
    return m


@lru_cache(maxsize=2)
def build(data: bytes):
    """(tokenizer, model) from the model file's bytes."""
    from tokenizers import Regex, Tokenizer, models, normalizers, pre_tokenizers

    m = read_model(data)
    pieces = m["pieces"]
    if m["type"] == 1:
        model = models.Unigram([(p, s) for p, s, _ in pieces], m["unk"], bool(m["byte_fallback"]))
    elif m["type"] == 2:
        ids = {p: i for i, (p, _, _) in enumerate(pieces)}
        normal = {p: s for p, s, k in pieces if k in (NORMAL, USER)}
        merges = []
        for p, s in normal.items():
            for cut in range(1, len(p)):
                left, right = p[:cut], p[cut:]
                if left in normal and right in normal:
                    merges.append((-s, ids[p], ids[left], left, right))
        merges.sort()
        model = models.BPE(vocab=ids, merges=[(a, b) for *_, a, b in merges], unk_token=pieces[m["unk"]][0],
                           fuse_unk=True, byte_fallback=bool(m["byte_fallback"]))
    else:
        raise ValueError("only unigram and pair-merge models can be rebuilt")
    t = Tokenizer(model)
    steps = [normalizers.Precompiled(m["charsmap"])] if m["charsmap"] else []
    if m["collapse"]:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if m["escape"]:
        steps.append(normalizers.Replace(" ", MARK))
    if m["prefix"]:
        steps.append(normalizers.Prepend(MARK if m["escape"] else " "))
    t.normalizer = normalizers.Sequence(steps)
    inner = any(MARK in p.lstrip(MARK) for p, _, k in pieces if k == NORMAL)
    if m["escape"] and not inner and not m["suffix"]:
        t.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*"), "isolated")
    return t, m


class Decoder:
    """Ids back to text: byte pieces as UTF-8, the marker as a space, the added first space removed."""

    def __init__(self, m: dict):
        mark = MARK.encode()
        self.value, self.prefix = [], bool(m["prefix"])
        for p, _, k in m["pieces"]:
            if k == BYTE:
                self.value.append(bytes([int(p[3:5], 16)]))
            elif k in (CONTROL, UNUSED):
                self.value.append(b"")
            elif k == UNKNOWN:
                self.value.append(" ⁇ ".encode())
            else:
                self.value.append(p.encode().replace(mark, b" "))

    def __call__(self, ids) -> str:
        value = self.value
        text = b"".join([value[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def expected(text: str, m: dict) -> str | None:
    """What decoding must give back; None where the character map may change the text."""
    if m["charsmap"]:
        return None
    return " ".join(x for x in text.split(" ") if x) if m["collapse"] else text


SCHEMA = "doc_id long, n_tokens long, n_byte_tokens long, ids_sha256 string, decoded boolean, parity boolean, ids array<int>"
BLANK = np.zeros(256, bool)
BLANK[0x20] = True
CACHED_WORDS = 300_000         # words whose ids a task keeps between chunks


class Encoder:
    """Batches of texts to ids."""

    def __init__(self, model: bytes, threads: int):
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        self.tokenizer, self.m = build(model)
        self.opens = np.array([p.startswith(MARK) for p, _, _ in self.m["pieces"]])
        self.by_word = (self.tokenizer.pre_tokenizer is not None and self.m["prefix"] and any(p == MARK for p, *_ in self.m["pieces"])
                        and not (self.m["charsmap"] or self.m["collapse"]))
        from tokenizers import Tokenizer
        self.bare = Tokenizer(self.tokenizer.model)               # words come normalised and marked
        self._forget()

    def _forget(self):
        """Known words: sorted hashes, and where in ``flat`` their ids lie."""
        self.key, self.begin, self.size = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.flat = np.empty(0, np.int32)

    def _learn(self, key: np.ndarray, words: list[str]):
        flat = []
        for at in range(0, len(words), 20_000):
            block = [words[i:i + 500] for i in range(at, min(at + 20_000, len(words)), 500)]
            flat += [np.array(e.ids, np.int32)
                     for e in self.bare.encode_batch_fast(block, is_pretokenized=True, add_special_tokens=False)]
        flat = np.concatenate(flat)
        first = np.flatnonzero(self.opens[flat])                  # a word's first piece, and no other, has the marker
        size = np.diff(np.append(first, len(flat)))
        begin = len(self.flat) + first
        self.flat = np.concatenate([self.flat, flat])
        key, begin, size = (np.concatenate(x) for x in ((self.key, key), (self.begin, begin), (self.size, size)))
        o = np.argsort(key)
        self.key, self.begin, self.size = key[o], begin[o], size[o]

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [np.array(e.ids if t else [], np.int32) for e, t in zip(found, texts)]

    def __call__(self, raw: np.ndarray, off: np.ndarray, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets)."""
        plain = np.array([self.by_word and bool(t) and t[0] != " " and t[-1] != " " and "  " not in t and MARK not in t
                          for t in texts], bool)
        n = len(texts)
        parts: list = [None] * n
        rest = np.flatnonzero(~plain)
        for i, ids in zip(rest, self.whole([texts[i] for i in rest])):
            parts[i] = ids
        if plain.any():
            start, end, doc, h = A.words(raw, off, space=BLANK)
            k = plain[doc]
            start, end, doc, h = start[k], end[k], doc[k], h[k]
            key, first, which = np.unique(h, return_index=True, return_inverse=True)
            if len(self.key) > CACHED_WORDS:
                self._forget()
            at = np.searchsorted(self.key, key)
            known = np.append(self.key, np.uint64(0))[at] == key if len(self.key) else np.zeros(len(key), bool)
            known &= at < len(self.key)
            if not known.all():
                new = first[~known]
                view = raw.tobytes()
                self._learn(key[~known], [MARK + view[a:z].decode() for a, z in zip(start[new].tolist(), end[new].tolist())])
                at = np.searchsorted(self.key, key)
            begin, size, flat = self.begin[at], self.size[at], self.flat
            count = size[which]
            place = np.cumsum(count) - count
            ids = flat[np.repeat(begin[which] - place, count) + np.arange(int(count.sum()))]
            at = np.searchsorted(doc, np.arange(n + 1))
            edge = np.append(place, len(ids))[at]
            for i in np.flatnonzero(plain):
                parts[i] = ids[edge[i]:edge[i + 1]]
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in parts]))).astype(np.int64)
        return np.concatenate(parts) if parts else np.empty(0, np.int32), offsets


def encode(docs: DataFrame, model: bytes, *, id_col: str = "doc_id", text_col: str = "text", parity: bool = True,
           with_ids: bool = True, threads: int = 2) -> DataFrame:
    """One row per input row: the ids' count and digest (4-byte little endian), whether decoding gives the text back,
    whether the sentencepiece library gives the same ids (null where ``parity`` is off) and the ids (null unless
    ``with_ids``)."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        encoder = Encoder(model, threads)
        m = encoder.m
        back = Decoder(m)
        is_byte = np.array([k == BYTE for _, _, k in m["pieces"]])
        other = None
        if parity:
            import sentencepiece
            other = sentencepiece.SentencePieceProcessor(model_proto=model)
        for table in A.chunks(batches, "text", 4 << 20):
            texts = [t or "" for t in table["text"].to_pylist()]
            ids, off = encoder(*A.utf8(table["text"]), texts)
            each = [ids[off[i]:off[i + 1]] for i in range(len(texts))]
            same = pa.nulls(len(texts), pa.bool_())
            if other is not None:
                same = pa.array([np.array_equal(x, np.array(y, np.int32)) for at in range(0, len(texts), 256)
                                 for x, y in zip(each[at:at + 256], other.encode(texts[at:at + 256], num_threads=threads))],
                                pa.bool_())
            want = [expected(t, m) for t in texts]
            total = np.concatenate(([0], np.cumsum(is_byte[ids])))
            yield pa.RecordBatch.from_arrays([
                table["doc_id"].combine_chunks(), pa.array(np.diff(off)), pa.array((total[off[1:]] - total[off[:-1]]).astype(np.int64)),
                pa.array([hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in each]),
                pa.array([None if w is None else back(x.tolist()) == w for x, w in zip(each, want)], pa.bool_()), same,
                pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids)) if with_ids
                else pa.nulls(len(texts), pa.list_(pa.int32()))],
                names=["doc_id", "n_tokens", "n_byte_tokens", "ids_sha256", "decoded", "parity", "ids"])

    return d.mapInArrow(run, SCHEMA)


def decode(rows: DataFrame, model: bytes, *, ids_col: str = "ids", out_col: str = "decoded_text") -> DataFrame:
    """Adds the text of an id array column."""
    schema = T.StructType([*rows.schema.fields, T.StructField(out_col, T.StringType())])
    at = rows.columns.index(ids_col)

    def run(batches):
        back = Decoder(read_model(model))
        for b in batches:
            texts = pa.array([None if x is None else back(x) for x in b.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, texts], names=[*b.schema.names, out_col])

    return rows.mapInArrow(run, schema)
