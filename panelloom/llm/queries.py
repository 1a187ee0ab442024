"""The registered queries of this package: thin wrappers over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.llm import ann, boilerplate, bpe, jaccard, langid, packing, periodic, quality, ranked, simhash, suffixtree, topk, urls
from panelloom.llm.common import held_out, table

# The rules, lengths and limits that the queries are asked for.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
SEQUENCE, END_ID = 1024, 2
SHINGLE, MAX_BITS = 3, 3
LEAST, BITS = 2, 10.0  # op7: occurrences of a word or a context; bits that the next symbols of a retained context save
PACKING_TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken"


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(PACKING_TOKENIZER), public_tokenizers.PATTERN,
                                  capacity=SEQUENCE, end_id=END_ID)


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.extract(table(spark, sf_dir, "pages"))


def op4_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN))


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), k=10, every=100)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 5, 0))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixtree.score_documents(table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 5, 1), least=LEAST, bits=BITS)


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), k=20, every=20)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out(F.col("doc_id"), 3, 1))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=SHINGLE, max_bits=MAX_BITS)


def with_cycles(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in the documents whose id has a checksum divisible by 10 the words from some place on repeat a stretch."""
    h = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(1))
    words = F.filter(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", (F.floor(h / 10)).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    n = F.size("words").cast("bigint")
    a = F.col("g") % n
    rows = rows.withColumn("n", n).withColumn("a", F.when(F.col("n") > 0, a))
    rows = rows.withColumn("p", 1 + F.expr("(n - a) div (3 + g % 8)"))
    cycled = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(
        F.expr("words")[(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")]))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(cycled, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(with_cycles(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("longest.start")).alias("start"), F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"), F.expr("(1000 * longest.length) div -longest.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"), shingle=SHINGLE, percent=90)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    fn.__name__: fn for fn in (
        op1_url_filters, op2_best_fit_packing, op3_html_extraction, op4_byte_level_bpe, op5_exact_top_k, op6_language_id,
        op7_lm_scoring, op8_nearest_neighbours, op9_quality_classifier, op10_simhash_near_dedup, op11_periodic_runs, op12_ngram_jaccard_join, op13_ranked_search)}

# Links that pages declare are rare, so the recursive part is small; a component is walked from each of its urls.
URL_FILTERS = r"""
WITH RECURSIVE page AS (
    SELECT page_id, url, html,
           translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
    FROM pages),
tag AS (
    SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag
    FROM page WHERE lower(html) LIKE '%canonical%' OR lower(html) LIKE '%refresh%'),
target AS (
    SELECT url, CASE WHEN regexp_matches(tag, '(?is)\srel\s*=\s*["'']?canonical') THEN regexp_extract(tag, '(?is)\shref\s*=\s*["'']?([^"''\s>]+)', 1)
                     WHEN regexp_matches(tag, '(?is)\shttp-equiv\s*=\s*["'']?refresh') THEN trim(regexp_extract(tag, '(?is)url\s*=\s*[''"]?([^''"]*)', 1)) END AS target
    FROM tag),
edge AS (
    SELECT DISTINCT a, b FROM (
        SELECT translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || regexp_extract(url, '://[^/?#]*([^#]*)', 1) AS a,
               translate(regexp_extract(target, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || regexp_extract(target, '://[^/?#]*([^#]*)', 1) AS b
        FROM target WHERE target LIKE '%://%') WHERE a <> b),
both_ways AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
reach AS (
    SELECT a, b FROM both_ways
    UNION
    SELECT r.a, e.b FROM reach r JOIN both_ways e ON e.a = r.b),
node AS (SELECT DISTINCT b AS node, regexp_extract(b, '^([^/?#]*)', 1) AS host, regexp_extract(b, '^[^/?#]*([^?#]*)', 1) AS path FROM reach),
bad AS (
    SELECT DISTINCT r.a FROM reach r JOIN node n ON n.node = r.b
    WHERE CASE WHEN (n.host = 'www.example.com' OR n.host LIKE '%.www.example.com') AND starts_with(n.path, '/en/') THEN false
               WHEN (n.host = 'example.com' OR n.host LIKE '%.example.com') AND starts_with(n.path, '/en/') THEN true
               WHEN (n.host = 'net' OR n.host LIKE '%.net') AND (starts_with(n.path, '/es/') OR starts_with(n.path, '/fr/')) THEN true
               ELSE false END),
ruled AS (
    SELECT *, CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
                   WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
                   WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
                   WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
                   WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
    FROM page)
SELECT r.page_id, r.host, r.path, r.rule,
       CASE WHEN r.rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN r.rule IS NOT NULL THEN 'block'
            WHEN b.a IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM ruled r LEFT JOIN bad b ON b.a = r.host || regexp_extract(coalesce(r.url, ''), '://[^/?#]*([^#]*)', 1)
"""

EXACT_TOP_K = """
WITH v AS (
    SELECT vec_id, row_number() OVER () AS place, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
    SELECT q.place, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[]) AS BIGINT) AS score
    FROM v q JOIN v c ON c.place <> q.place WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""

RANKED_SEARCH = r"""
WITH doc AS (
    SELECT row_number() OVER () AS place, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents),
posting AS (SELECT place, term, count(*) AS tf FROM (SELECT place, unnest(terms) AS term FROM doc) GROUP BY place, term),
total AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM doc WHERE len(terms) > 0),
item AS (
    SELECT place, item_id, term, count(*) AS repeats FROM (
        SELECT row_number() OVER () AS place, item_id,
               unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark) GROUP BY place, item_id, term),
weight AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM posting GROUP BY term), total),
scored AS (
    SELECT i.place, i.item_id, d.place AS doc_place, d.doc_id,
           sum(i.repeats * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (100 - 75 + (75 * len(d.terms) * t.n_docs) // t.n_terms))))::BIGINT AS score
    FROM item i JOIN weight w USING (term) JOIN posting p USING (term) JOIN doc d ON d.place = p.place, total t
    GROUP BY i.place, i.item_id, d.place, d.doc_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM placed WHERE rank <= 10
"""

ORACLES: dict[str, str] = {"op1_url_filters": URL_FILTERS, "op5_exact_top_k": EXACT_TOP_K, "op13_ranked_search": RANKED_SEARCH}
