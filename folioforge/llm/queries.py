"""The queries and oracle SQL that ``__spark_entry__`` registers for these operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, decontaminate, html_extract, language_id, lm_score, mixing, simhash, substring_dedup, toxicity, url_filter
from .common import table


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where("vec_id % 20 = 0"))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(url_filter.RULES), "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.train(docs))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats(table(spark, sf_dir, "documents"), with_text=False)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


QUERIES = {
    "op1_lm_score": op1_lm_score,
    "op2_decontaminate": op2_decontaminate,
    "op3_mix": op3_mix,
    "op4_nearest": op4_nearest,
    "op5_url_rules": op5_url_rules,
    "op6_main_text": op6_main_text,
    "op7_language": op7_language,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_simhash": op9_simhash,
    "op10_toxicity": op10_toxicity,
}

ORACLE_SQL = {
    "op3_mix": r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM s),
r AS (SELECT *, row_number() OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST) AS k FROM w),
c AS (SELECT *, coalesce(sum(3 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_words,
      sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight, sum(source_size) OVER () AS all_words FROM r),
l AS (SELECT (all_words - full_words)::DOUBLE / open_weight::DOUBLE AS share FROM c WHERE (all_words - full_words)::DOUBLE / open_weight::DOUBLE * weight <= 3.0 * source_size ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN share IS NULL OR share * weight > 3.0 * source_size THEN (3.0 * source_size)::DOUBLE ELSE (share * weight)::DOUBLE END AS target FROM w LEFT JOIN l ON TRUE),
j AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size, 3.0) ELSE 0.0 END AS rate,
      ('0x' || substr(md5('mix-1:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0 AS draw
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, ((floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM j
""",
    "op5_url_rules": r"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
p AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
      coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
r(rhost, rpath, rverdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (SELECT p.*, rhost || rpath AS rule, rverdict, row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rhost) DESC, length(rpath) DESC) AS k
      FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.rverdict, 'allow') AS verdict
FROM p LEFT JOIN (SELECT DISTINCT page_id, host, path, rule, rverdict FROM m WHERE k = 1) m ON p.page_id = m.page_id AND p.host = m.host AND p.path = m.path
""",
    "op8_substring_dedup": r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, greatest(len(w) - 11, 1))) AS p, w FROM d WHERE len(w) >= 13),
h AS (SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS win FROM g),
f AS (SELECT win, min(doc_id) AS least FROM h GROUP BY win),
m AS (SELECT h.doc_id, list(h.p) AS ps FROM h JOIN f USING (win) WHERE h.doc_id > f.least GROUP BY h.doc_id),
c AS (SELECT doc_id, list_sort(list_distinct(flatten(list_transform(ps, lambda s: range(s, s + 13))))) AS gone FROM m),
x AS (SELECT d.doc_id, w, coalesce(gone, []) AS gone FROM d LEFT JOIN c USING (doc_id)),
k AS (SELECT doc_id, len(w) AS n_words, len(gone) AS n_removed, w, gone FROM x),
e AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM k),
q AS (SELECT doc_id, unnest(gone) AS i FROM k),
s AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.i) AS kept FROM e ANTI JOIN q ON e.doc_id = q.doc_id AND e.i = q.i GROUP BY e.doc_id)
SELECT k.doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM k LEFT JOIN s USING (doc_id)
""",
}
