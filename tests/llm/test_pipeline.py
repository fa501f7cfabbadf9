import re

import corpus_pipeline
import sentencepiece
from llm import brute
from orbitlens.llm.decontaminate import normal
from orbitlens.llm.queries import QUERIES, SPM_MODEL


def test_rows_equal_brute_force(spark, sf01):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf01}/documents.parquet").collect()]
    good = {r.doc_id for r in QUERIES["op2_quality_crf"](spark, sf01).collect() if r.predicted}
    kept = [d for d in docs if d[0] in good]
    first = {doc for doc, _, low in brute.jaccard_components(kept) if doc == low}
    items = [normal(r.text) for r in spark.read.parquet(f"{sf01}/benchmark.parquet").collect()]
    sp = sentencepiece.SentencePieceProcessor(model_file=SPM_MODEL)
    want = {}
    for doc, text in kept:
        if doc in first and not any(i in normal(text) for i in items):
            out, p = [], 0
            for _, s, e in brute.secret_spans(text):
                out += [text[p:s], "<secret>"] if s >= p else []
                p = max(p, e)
            want[doc] = sp.encode("".join(out) + text[p:])
    rows = corpus_pipeline.run(spark, sf01).collect()
    assert len(rows) == len({r.doc_id for r in rows}) and 0 < len(want) < len(docs)
    got = {r.doc_id: r.ids for r in rows}
    assert got.keys() == want.keys()
    assert sum(got[d] == want[d] for d in want) == len(want) and all(r.parity for r in rows)


def test_stages_keep_columns_and_survive_odd_rows(spark, sf01):
    rows = [(1, None, "en", None, None, "x"), (None, "a b c " * 40, "en", "s", 3, None), (2, "", None, "s", 0, "x"), (3, "words and words " * 50, "en", "s", 1, "y"),
            (3, "words and words " * 50, "en", "s", 1, "y"), (4, "password: hunter22x and more", "en", "s", 28, "z")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, component_id string"
    df = spark.createDataFrame(rows, schema)
    for docs, n in ((df, 4), (df.limit(0), 0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf01)
            assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
            got = out.collect()
            if n and name == "n-gram Jaccard join":
                assert sorted(str(r.doc_id) for r in got) == ["1", "2", "3", "4", "None"]
            if n and name == "secret scan":
                assert next(r for r in got if r.doc_id == 4).text == "<secret> and more"
                assert next(r for r in got if r.doc_id == 4).n_chars == 17
            if not n:
                assert got == []
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf01).count() == len(rows) * bool(n)


def test_unlinked_texts_with_one_id_stay(spark, sf01):
    a, b, c = ("words of the first text go here " * 1 + " ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(5, a, 1), (5, b, 2), (5, b, 2), (2, a + " more", 3), (9, c, 4), (7, c, 5), (None, c, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int")
    got = corpus_pipeline.dedup_stage(spark, df, sf01).collect()
    assert sorted(r.n for r in got) == [2, 3, 5, 6]


def test_stage_list():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "n-gram Jaccard join", "benchmark decontamination", "secret scan",
                                                      "sentencepiece"]
    assert re.match(r"\d", str(len(corpus_pipeline.STAGES)))
