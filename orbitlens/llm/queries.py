"""The registered queries of this subpackage: one thin query per operator."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orbitlens.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)          # Python workers import the package from the shipped archive
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op5_substring_dedup")
def op5(spark, sf_dir):
    from orbitlens.llm.substring_dedup import substring_dedup
    return substring_dedup(table(spark, sf_dir, "documents")).drop("intervals")


@register("op6_secret_scan")
def op6(spark, sf_dir):
    from orbitlens.llm.secrets import secret_scan
    return secret_scan(table(spark, sf_dir, "documents")).drop("n_spans")


@register("op7_quality_rules")
def op7(spark, sf_dir):
    from orbitlens.llm.quality_rules import quality_rules
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op2_quality_crf")
def op2(spark, sf_dir):
    from orbitlens.llm.quality_crf import quality_crf
    return quality_crf(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op1_toxicity")
def op1(spark, sf_dir):
    """The label table has two 0/1 columns: the chain predicts poor quality first, then toxicity."""
    from pyspark.sql import functions as F

    from orbitlens.llm.toxicity import toxicity_chain
    labels = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("poor"), "toxic")
    return toxicity_chain(table(spark, sf_dir, "documents"), labels, ["poor", "toxic"])


@register("op3_decontaminate")
def op3(spark, sf_dir):
    from orbitlens.llm.decontaminate import find_leaks
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op9_jaccard_join")
def op9(spark, sf_dir):
    from orbitlens.llm.jaccard_join import jaccard_join
    return jaccard_join(table(spark, sf_dir, "documents"))


#: the tokenizer file; a parameter, never part of the repository
SPM_MODEL = os.environ.get("ORBITLENS_SPM_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


@register("op4_sentencepiece")
def op4(spark, sf_dir):
    from orbitlens.llm.spm import encode
    with open(SPM_MODEL, "rb") as f:
        model = f.read()
    return encode(table(spark, sf_dir, "documents"), model, with_ids=False).drop("ids")


@register("op10_warc", sql="""
SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, {b32} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first,
             regexp_extract_all(sha1(coalesce(html, '')), '.{10}') AS h FROM pages)
""".replace("{b32}", "list_aggregate(list_transform(h, lambda x: list_aggregate(list_transform(range(8), "
            "lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || x)::BIGINT >> (35 - 5 * i)) & 31)::INT, 1)), "
            "'string_agg', '')), 'string_agg', '')"))
def op10(spark, sf_dir):
    from orbitlens.llm.warc import archive_round_trip
    return archive_round_trip(spark, table(spark, sf_dir, "pages")).drop("url")


@register("op8_html_wrapper")
def op8(spark, sf_dir):
    from orbitlens.llm.html_wrapper import html_text
    return html_text(table(spark, sf_dir, "pages"))


#: smallest id of every group of texts whose word-shingle sets link, by comparing all pairs that share a shingle
JACCARD_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(len(w) - {size} + 1), lambda i: array_to_string(w[i + 1:i + {size}], ' ')) END)) AS s FROM w),
c AS (SELECT min(doc_id) AS cls, s, len(s) AS n FROM s WHERE len(s) > 0 GROUP BY s),
t AS (SELECT cls, n, unnest(s) AS t FROM c),
link AS (SELECT x.cls AS a, y.cls AS b FROM t x JOIN t y ON x.t = y.t AND x.cls < y.cls
         GROUP BY x.cls, y.cls, x.n, y.n HAVING 100 * count(*) >= {percent} * (x.n + y.n - count(*))),
sides AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT cls AS a, cls AS b FROM c UNION SELECT r.a, k.b FROM reach r JOIN sides k ON r.b = k.a),
comp AS (SELECT a AS cls, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(comp.component_id, s.doc_id) AS component_id{more}
FROM s LEFT JOIN c ON c.s = s.s LEFT JOIN comp ON comp.cls = c.cls
"""


@register("op13_bbit_minhash", sql=JACCARD_SQL.format(size=3, percent=85, more=",\n       s.doc_id = coalesce(comp.component_id, s.doc_id) AS kept"))
def op13(spark, sf_dir):
    from orbitlens.llm.bbit_minhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


@register("op12_prefix_trie", sql="""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS rk FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT conv_id, count(*) AS n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
             list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
             lambda s, x: list_reduce(list_prepend(xor(s, x), range(8)), lambda v, i: xor(v >> 1, 3988292384 * (v & 1))))) % 6 AS h
      FROM t GROUP BY conv_id),
c AS (SELECT k.*, k.conv_id - k.conv_id % 100 AS base, least(k.h, coalesce(b.n, 0)) AS nb
      FROM k LEFT JOIN k b ON b.conv_id = k.conv_id - k.conv_id % 100),
r AS (SELECT c.conv_id, t.rk AS pos, role, text FROM c JOIN t ON t.conv_id = c.base AND t.rk < c.h
      UNION ALL SELECT c.conv_id, t.rk - c.h + c.nb, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.rk >= c.h),
p AS (SELECT conv_id, pos + 1 AS d, length(text) AS chars,
             string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS path FROM r
      UNION ALL SELECT conv_id, 0, 0, '' FROM c),
l AS (SELECT conv_id, max(d) AS len FROM p GROUP BY conv_id),
n AS (SELECT path, d, min(p.conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars, count(*) FILTER (WHERE len > d) = 0 AS leaf,
             sha256(coalesce(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) FILTER (WHERE len = d), '')) AS ends_sha256
      FROM p JOIN l USING (conv_id) GROUP BY path, d),
s AS (SELECT left(path, 32 * i) AS path, sum((n_convs - 1) * chars) AS saved, count(*) FILTER (WHERE leaf) AS leaves
      FROM (SELECT *, unnest(range(d + 1)) AS i FROM n) GROUP BY 1),
kids AS (SELECT left(path, 32 * (d - 1)) AS path, count(*) AS n FROM n WHERE d > 0 GROUP BY 1)
SELECT n.conv_id, n.d::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0)::BIGINT AS n_children,
       s.leaves AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN s USING (path) LEFT JOIN kids USING (path) LEFT JOIN n up ON n.d > 0 AND up.path = left(n.path, 32 * (n.d - 1))
""")
def op12(spark, sf_dir):
    from orbitlens.llm.prefix_trie import conversation_trie
    return conversation_trie(table(spark, sf_dir, "conversations"))


@register("op11_phrase_mining", sql="""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, m, unnest(list_transform(range(len(w) - m + 1), lambda i: array_to_string(w[i + 1:i + m], ' '))) AS phrase
      FROM w, (VALUES (1), (2), (3)) AS s(m)),
f AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS a FROM g GROUP BY lang, m, phrase),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
c AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND a >= 10),
parts AS MATERIALIZED (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS lft, array_to_string(w[k + 1:], ' ') AS rgt
        FROM (SELECT *, unnest(range(1, m)) AS k FROM c)),
cut AS (SELECT x.lang, x.phrase, x.a, k, l.a AS l, r.a AS r, ((1000000::HUGEINT * x.a * x.a) // (l.a::HUGEINT * r.a))::BIGINT AS score
        FROM parts x JOIN f l ON l.lang = x.lang AND l.phrase = x.lft JOIN f r ON r.lang = x.lang AND r.phrase = x.rgt),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (SELECT lang, array_to_string(w[1:2], ' ') AS phrase, NULL AS lft, a AS rgt FROM c WHERE m = 3
           UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a, NULL FROM c WHERE m = 3),
ext AS (SELECT lang, phrase, max(lft) AS best_left, max(rgt) AS best_right FROM longer GROUP BY lang, phrase)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, n, score, best_left, best_right
FROM best b JOIN n USING (lang) LEFT JOIN ext e ON e.lang = b.lang AND e.phrase = b.phrase
WHERE 100 * greatest(coalesce(best_left, 0), coalesce(best_right, 0)) < 50 * a
QUALIFY rank <= 2000
""")
def op11(spark, sf_dir):
    from orbitlens.llm.phrase_mining import phrase_mining
    return phrase_mining(table(spark, sf_dir, "documents"))


SQL["op9_jaccard_join"] = JACCARD_SQL.format(size=5, percent=75, more="")

SQL["op5_substring_dedup"] = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
w AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i, len(w) AS n FROM d),
k AS (SELECT doc_id, i, n, md5(string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)) AS key FROM w),
f AS (SELECT key, min(doc_id) AS least FROM k WHERE i <= n - 12 GROUP BY key),
g AS (SELECT k.doc_id, k.i FROM k JOIN f USING (key) WHERE k.i <= k.n - 12 AND f.least < k.doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM g),
left_over AS (SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.i) AS kept, count(*) AS m FROM w ANTI JOIN gone USING (doc_id, i) GROUP BY w.doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(m, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_over USING (doc_id)
"""
