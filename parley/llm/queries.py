"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parley.llm import ann, bpe, html_extract, line_dedup, near_dedup, packing, quality_classifier, quality_rules, secrets, url_filter


def vocabulary() -> str:
    """The vocabulary file that the registered queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents"), vocabulary())


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(read(spark, sf_dir, "pages"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(read(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.strip(read(spark, sf_dir, "documents").select("doc_id", "source", "text")).select("doc_id", "n_lines", "n_removed", "text")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), vocabulary())


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(read(spark, sf_dir, "embeddings"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_html_extraction": op3_html_extraction,
    "op4_secret_scan": op4_secret_scan,
    "op5_quality_rules": op5_quality_rules,
    "op6_near_dedup": op6_near_dedup,
    "op7_line_dedup": op7_line_dedup,
    "op8_packing": op8_packing,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_url_filter": op10_url_filter,
}

_SETS = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN list_distinct(w)
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM w
), x AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
"""

ORACLE: dict[str, str] = {
    "op6_near_dedup": _SETS
    + """
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id
  WHERE 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), e AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
r AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents
  UNION
  SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM s JOIN (SELECT node, min(seen) AS component_id FROM r GROUP BY node) c ON s.doc_id = c.node
""",
    "op7_line_dedup": r"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM documents
), b AS (
  SELECT line FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY line HAVING count(DISTINCT source) >= 10
), j AS (SELECT l.*, b.line IS NOT NULL AS bad FROM l LEFT JOIN b ON l.line = b.line)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (bad) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT bad), '') AS text
FROM j GROUP BY doc_id
""",
    "op9_nearest_neighbours": """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL),
d AS (
  SELECT q.vec_id AS query_id, p.vec_id, list_distance(q.v, p.v) AS score
  FROM v q JOIN v p ON q.vec_id % 100 = 0 AND p.vec_id <> q.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
""",
    "op10_url_filter": r"""
WITH u AS (
  SELECT page_id, url, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), r AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM u
), l AS (SELECT host, NOT bool_or(starts_with(url, 'https://')) AS listed FROM u WHERE host <> '' GROUP BY host)
SELECT page_id, r.host, path, rule, CASE
  WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN coalesce(listed, false) THEN 'block' ELSE 'allow' END AS verdict
FROM r LEFT JOIN l ON r.host = l.host
""",
}
