"""The corpus operators' registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, divergence, forest, gnat, maxscore, mixing, pii, secrets, simhash, substring, suffix, toxicity, urlfilter
from ._common import read_table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return forest.search(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urlfilter.judge(read_table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", *[F.col(f"__mill_{c}").alias(c) for c in ("host", "path", "rule", "verdict")])


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(read_table(spark, sf_dir, "documents"))


def op5_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return maxscore.search(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


def op6_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(read_table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read_table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.deduplicate_digests(read_table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), words=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return gnat.mine(vectors.withColumn("label", relabelled), F.col("vec_id") % 100 == 0)


def op12_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.deduplicate_digests(read_table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_prefix_forest": op1_prefix_forest,
    "op2_toxicity": op2_toxicity,
    "op3_url_filter": op3_url_filter,
    "op4_secret_scan": op4_secret_scan,
    "op5_maxscore": op5_maxscore,
    "op6_temperature_mixing": op6_temperature_mixing,
    "op7_personal_data": op7_personal_data,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_simhash": op10_simhash,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_suffix_array": op12_suffix_array,
    "op13_source_divergence": op13_source_divergence,
}

_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in urlfilter.RULES)
_BLOCKED = ", ".join(f"'{h}'" for h in urlfilter.BLOCKED_HOSTS)

OP3 = f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULES}),
blocked AS (SELECT unnest([{_BLOCKED}]) AS blocked_host),
parts AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
),
hosts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
),
keyed AS (SELECT row_number() OVER () AS n, * FROM hosts),
fits AS (
  SELECT n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
  FROM keyed JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY n
)
SELECT page_id, host, path, rule,
  coalesce(rule_verdict, CASE WHEN EXISTS (SELECT 1 FROM blocked WHERE host = blocked_host OR ends_with(host, '.' || blocked_host)) THEN 'block' ELSE 'allow' END) AS verdict
FROM keyed LEFT JOIN fits USING (n)
"""

OP5 = """
WITH entries AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, max(CAST(list_inner_product(q.v, c.v) AS BIGINT)) AS score
  FROM entries q JOIN entries c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v) GROUP BY ALL
),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM pairs)
SELECT * FROM ranked WHERE rank <= 20
"""

OP11 = """
WITH entries AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
  SELECT a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same, CAST(list_inner_product(a.v, x.v) AS BIGINT) AS score
  FROM entries a JOIN entries x ON a.vec_id % 100 = 0 AND a.vec_id <> x.vec_id AND len(a.v) = len(x.v)
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

OP13 = f"""
WITH numbered AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{divergence.UPPER}', '{divergence.LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS found FROM documents
),
words AS (SELECT r, lang, source, unnest(found) AS term FROM numbered),
kept AS (SELECT lang, term, count(*) AS n_lang FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(n_lang) AS total_lang FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
groups AS (SELECT lang, source, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM numbered) LEFT JOIN totals USING (lang, source)),
shares AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (total + 5 * v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (n_lang + 5)) // (total_lang + 5 * v)::HUGEINT AS q
  FROM groups JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN counts USING (lang, source, term)
),
apart AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
found AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups x JOIN groups y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN apart a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source
  UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM shares WHERE n > 0 AND p > q
)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found QUALIFY part = 'pair' OR rank <= 50
"""

ORACLES: dict[str, str | None] = {
    "op3_url_filter": OP3,
    "op5_maxscore": OP5,
    "op11_hard_negatives": OP11,
    "op13_source_divergence": OP13,
}
