import hashlib

import numpy as np
import pytest
import sentencepiece

from orbitlens.llm import spm
from orbitlens.llm.queries import SPM_MODEL

DATA = open(SPM_MODEL, "rb").read()
TEXTS = ["", " ", "  a  b ", "a▁b", "<s> x </s>", "<0x41> <unk>", "日本語 😀\n\n\ttab", "a\u0000b", "ｆｕｌｌ ﬁ x", "   ", "x" * 5000,
         "\n", "é è", "one two\n three", "one  two", " lead", "trail ", "a " * 20_000 + "b", "▁", "tab\tand\r\nline"]


@pytest.fixture(scope="module")
def reference():
    return sentencepiece.SentencePieceProcessor(model_proto=DATA)


def test_model_fields(reference):
    m = spm.read_model(DATA)
    assert len(m["pieces"]) == reference.get_piece_size()
    assert all(p == reference.id_to_piece(i) for i, (p, _, _) in enumerate(m["pieces"]))
    assert all(abs(s - reference.get_score(i)) < 1e-6 for i, (_, s, _) in enumerate(m["pieces"]))


def test_ids_and_decoding_equal_the_library(spark, reference):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(100, None, "x"), (None, "a b", "y"), (0, "", "x")],
                               "doc_id long, text string, ids string")
    out = spm.decode(spm.encode(df, DATA), DATA).collect()
    assert len(out) == len(TEXTS) + 3 and all(r.parity for r in out)
    for r in out:
        if r.doc_id is not None and r.doc_id < 100:
            want = reference.encode(TEXTS[r.doc_id])
            assert r.ids == want and r.decoded_text == reference.decode(want) and r.n_tokens == len(want)
            assert r.ids_sha256 == hashlib.sha256(np.array(want, "<i4").tobytes()).hexdigest()
            assert r.decoded == (r.decoded_text == TEXTS[r.doc_id])
    assert next(r for r in out if r.doc_id == 100).n_tokens == 0
    assert spm.encode(df.limit(0), DATA).count() == 0


def test_documents(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    rows = spm.encode(docs, DATA, with_ids=False).collect()
    assert len(rows) == docs.count() and all(r.parity and r.decoded and r.ids is None for r in rows)


def message(*parts):
    out = b""
    for number, value in parts:
        if isinstance(value, int):
            out += bytes([number << 3 & 127 | 0]) if number < 16 else bytes([(number << 3 & 127) | 128, number >> 4])
            out += bytes([value])
        elif isinstance(value, float):
            import struct
            out += bytes([number << 3 | 5]) + struct.pack("<f", value)
        else:
            out += bytes([number << 3 | 2, len(value)]) + value
    return out


def test_unigram_scores_are_kept():
    pieces = [("<unk>", 0.0, 2), ("▁", -2.0, 1), ("▁ab", -3.0, 1), ("a", -2.5, 1), ("b", -2.5, 1), ("ab", -4.0, 1)]
    data = b"".join(message((1, message((1, p.encode()), (2, s), (3, k)))) for p, s, k in pieces)
    data += message((2, message((3, 1)))) + message((3, message((3, 1), (4, 1), (5, 1))))
    ours, m = spm.build(data)
    theirs = sentencepiece.SentencePieceProcessor(model_proto=data)
    for text in ("ab", "abab", " a  b ", "ba ab", "c ab"):
        assert ours.encode(text, add_special_tokens=False).ids == theirs.encode(text)
