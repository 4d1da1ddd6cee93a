"""The registered queries of this subpackage: thin calls of its operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import decontaminate, embedding_dedup, html_extract, html_training, near_dedup, packing, quality, secrets, suffix_dedup, toxicity, url_filter
from touchline.llm.common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: The listed entries of op10: (host, path, verdict).
URL_RULES = (
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), "text")
    found, _ = secrets.scan_versions(versions)
    base = F.filter("findings", lambda x: x["ord"] < len(secrets.BASE_RULES))

    def count(kind: str):
        return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("path").alias("doc_id"),
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(secrets.joined_spans(base).cast("binary"), 256).alias("base_sha256"),
        secrets.joined_spans(F.col("findings")).alias("spans"),
    )


def op3_sorted_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, chain).withColumn("toxic", F.col("p_toxic") >= 0.5)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    most = {0: quality.TRAIN_ROWS, 1: quality.TRAIN_ROWS}
    learn = toxicity.labelled_sample(docs, table(spark, sf_dir, "labels"), "quality", most, "crc32(cast(doc_id as string)) % 5 <> 0")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    scored = quality.score(docs, quality.train(learn))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"), html_extract.train(html_training.labelled_pages()))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"), tokenizer_path()))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.sql("SELECT * FROM VALUES " + ", ".join(map(str, URL_RULES)) + " AS rules(host, path, verdict)")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), listed).select("page_id", "host", "path", "rule", "verdict")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_secret_scan": op2_secret_scan,
    "op3_sorted_projections": op3_sorted_projections,
    "op4_order_minhash": op4_order_minhash,
    "op5_decontamination": op5_decontamination,
    "op6_toxicity": op6_toxicity,
    "op7_quality": op7_quality,
    "op8_html_extraction": op8_html_extraction,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_url_filter": op10_url_filter,
}

def _found_sql(rule: secrets.Rule, order: int) -> str:
    """Matches of one rule with the gaps before them, whose lengths give the positions."""
    pattern = rule.pattern.replace("'", "''")
    long_enough = f"length(regexp_extract(m[i], '{pattern}', {rule.group})) >= {rule.at_least}" if rule.group else "true"
    return f"""SELECT rid, {order} AS ord, '{rule.kind}' AS kind, s, s + length(m[i]) AS e FROM (
  SELECT *, CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s FROM (
    SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT rid, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS g FROM d))) WHERE {long_enough}"""


ORACLE: dict[str, str] = {
    "op2_secret_scan": "WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents), f AS ("
    + " UNION ALL ".join(_found_sql(r, i) for i, r in enumerate(secrets.RULES))
    + f"""), a AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord) FILTER (ord < {len(secrets.BASE_RULES)}), '') AS base, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord) AS spans
  FROM f GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (rid)""",
    "op10_url_filter": r"""
WITH p AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
m AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/7') THEN 'example.com/en/7'
    WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/de/8') THEN 'example.net/de/8'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/en/') THEN 'com/en/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/de/') THEN 'net/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/es/') THEN 'org/es/' END AS rule
  FROM p)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('com/en/', 'example.net/de/8', 'org/es/') THEN 'block' ELSE 'allow' END AS verdict
FROM m""",
}
