"""Quality rules with a hashed n-gram log-likelihood ratio. DataFrame functions only.

Method: two multinomials over hashed word unigrams and bigrams, one of a
trusted target, one of the raw corpus.  A document's score is the mean over its
n-grams of ``log p_target - log p_raw``; it is kept if the score reaches a
fixed threshold (no sampling, so a document's verdict never varies).

The raw counts cover every document.  The target comes from documents that the
label table marks as good, at most ``max_trusted`` of them (those of least
hash, so the choice does not depend on layout); that bounds the id list that is
broadcast.  ``buckets`` bounds the weights that come back to the driver and go
out again as one constant array.

Base rules (see ``quality_rules``) fail very short and very repetitive texts.

Defined results: a null text has no words (base_failed); a text without
n-grams scores 0; repeated rows and null ids each give their row; an empty
table gives an empty result; without trusted rows every weight is 0; other
columns are ignored.  Three-word windows are compared by 64-bit hash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def ngram_buckets(words: Column, buckets: int) -> Column:
    """Bucket of every unigram, then of every bigram (``words`` must be a column, not an expression)."""
    one = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))
    two = F.transform(F.sequence(F.lit(1), F.size(words) - 1),
                      lambda i: F.pmod(F.xxhash64(F.get(words, i - 1), F.get(words, i)), F.lit(buckets)).cast("int"))
    return F.when(F.size(words) >= 2, F.concat(one, two)).otherwise(one)


def ngram_weights(docs: DataFrame, trusted: DataFrame, buckets: int, smoothing: float = 1.0) -> list[float]:
    """log p_target - log p_raw by bucket; ``docs`` has doc_id and words, ``trusted`` a bounded list of doc_id."""
    marked = (docs.join(F.broadcast(trusted.select(F.col("doc_id").alias("t_id"), F.lit(1).alias("t"))),
                        F.col("doc_id") == F.col("t_id"), "left")
              .select(F.coalesce("t", F.lit(0)).alias("t"), F.explode(ngram_buckets(F.col("words"), buckets)).alias("b")))
    rows = marked.groupBy("b").agg(F.count("*").alias("raw"), F.sum("t").alias("target")).collect()   # <= buckets rows
    raw, target = [smoothing] * buckets, [smoothing] * buckets
    for r in rows:
        raw[r.b] += r.raw
        target[r.b] += r.target
    if not any(r.target for r in rows):
        return [0.0] * buckets
    shift = math.log(sum(raw)) - math.log(sum(target))
    return [math.log(t) - math.log(r) + shift for t, r in zip(target, raw)]


def base_columns(d: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed to (text, words)."""
    text, words = F.col("text"), F.col("words")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.regexp_replace(x, SPACE, "")) > 0)
    triples = F.when(F.size(words) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))
    d = d.withColumns({"lines": lines, "triples": F.coalesce(triples, F.array().cast("array<bigint>"))})
    # most texts repeat no window: only the others are sorted
    again = F.size(F.array_distinct("triples")) < F.size("triples")
    d = d.withColumn("ranked", F.when(again, F.array_sort(F.transform(
        "triples", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    ranked = F.col("ranked")
    same = lambda p, j: F.coalesce(p.h == F.get(ranked, j).h, F.lit(False))
    seen = F.filter(ranked, lambda p, j: same(p, j - 1) | same(p, j + 1))
    d = d.withColumn("seen", F.array_sort(F.transform(seen, lambda p: p.i)))
    covered = F.aggregate(
        "seen", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct((a.n + i + 3 - F.greatest(a.end, i)).alias("n"), (i + 3).alias("end")),
        lambda a: a.n.cast("long"))
    d = d.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.length(F.regexp_replace(text, SPACE, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0).cast("long")),
    })
    return d.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def quality_rules(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", buckets: int = 10_000, max_trusted: int = 20_000,
                  threshold: float = -0.2) -> DataFrame:
    """One row per input row: doc_id, the base counts, base_failed, llr (score) and kept."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    d = d.withColumn("words", words_of(F.col("text")))
    good = labels.where(F.col(label_col) == 1).select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id is not null")
    trusted = good.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_trusted)
    weights = ngram_weights(d.select("doc_id", "words"), trusted, buckets)
    constant = F.split(F.lit(",".join(f"{w:.9g}" for w in weights)), ",").cast("array<double>")   # folded once
    d = base_columns(d)
    d = d.withColumn("grams", ngram_buckets(F.col("words"), buckets))
    total = F.aggregate("grams", F.lit(0.0), lambda a, b: a + F.get(constant, b))
    d = d.withColumn("llr", F.when(F.size("grams") > 0, total / F.size("grams")).otherwise(F.lit(0.0)))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & (F.col("llr") >= threshold)).alias("kept"), "llr")
