"""Queries of the text, search, JSON and page operators over documents, customers, events and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.functions import text as t
from touchline.operators import masters, tables
from touchline.plans.analogs import table
from touchline.plans.match_queries import query
from touchline.sources.pages import page_facts


def nested(pairs: list[tuple[str, str]], column: str) -> str:
    for old, new in pairs:
        column = f"replace({column}, '{old}', '{new}')"
    return column


_FOLD = f"translate(lower(text), '{t.ACCENTED[0]}', '{t.ACCENTED[1]}')"
_TERMS = nested([*t.TRIGRAPHS.items(), *t.DIGRAPHS.items(), *[(d + d, d) for d in t.DOUBLES]], _FOLD)
_CYRILLIC = f"translate({nested([*t.LATIN_PAIRS.items(), ('x', 'кс')], 'lower(c_name)')}, '{t.LATIN_SINGLE[0]}', '{t.LATIN_SINGLE[1]}')"


@query(f"SELECT doc_id, CASE WHEN trim(coalesce(text, '')) = '' THEN '' ELSE {_TERMS} END AS terms FROM documents", base=False)
def search_terms(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", t.search_terms(F.col("text")).alias("terms"))


@query(f"SELECT doc_id FROM documents WHERE contains({_TERMS}, 'token')", base=False)
def search_contains(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.filter(t.search_matches(t.search_terms(F.col("text")), "Token")).select("doc_id")


@query(
    f"""WITH l AS (SELECT doc_id, translate(lower(source || ' / ' || lang || ' Čč'), '{t.ACCENTED_SLUG[0]}', '{t.ACCENTED_SLUG[1]}') AS s FROM documents)
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(s, '[\\s/]+', '_', 'g'), '[^a-z0-9_\\-]+', '', 'g'), '_{{2,}}', '_', 'g'), '^_+|_+$', '', 'g') AS slug FROM l""",
    base=False,
)
def slug(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", t.slug(F.concat("source", F.lit(" / "), "lang", F.lit(" Čč"))).alias("slug"))


@query(
    f"""WITH c AS (SELECT c_custkey, {_CYRILLIC} AS s FROM customer) SELECT c_custkey, list_aggregate(list_transform(string_split(s, ' '), lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), 'string_agg', ' ') AS cyrillic FROM c""",
    base=False,
)
def translit(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", t.latin_to_cyrillic(F.col("c_name")).alias("cyrillic"))


@query("SELECT doc_id, lower(trim(regexp_replace(text, '[\\s \u0085 -     　 ]+', ' ', 'g'))) AS k FROM documents", base=False)
def join_keys(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", t.join_key(F.col("text")).alias("k"))


@query(
    """WITH w AS (SELECT conv_id, turn, string_split(trim(regexp_replace(text, '[\\s ]+', ' ', 'g')), ' ') AS w FROM conversations)
SELECT conv_id, turn, w[len(w)] AS surname, list_aggregate(list_reverse(w), 'string_agg', ' ') AS reversed FROM w""",
    base=False,
)
def word_order(spark, sf_dir):
    c = t.squish(F.col("text"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", t.last_word(F.col("text")).alias("surname"), t.reversed_words(c).alias("reversed"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(to_json({'event_id': event_id, 'type': event_type, 'missing': NULL}) AS VARCHAR) AS j FROM events", base=False)
def json_props(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    out = F.struct("event_id", F.col("event_type").alias("type"), F.lit(None).cast("string").alias("missing"))
    return ev.select("event_id", F.from_json("props", "k long")["k"].alias("k"), F.to_json(out, {"ignoreNullFields": "false"}).alias("j"))


@query(
    """SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, CAST(len(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1, 's'), '<a href="([^"]*)"', 1)) AS BIGINT) AS links FROM pages""",
    base=False,
)
def html_title(spark, sf_dir):
    return page_facts(table(spark, sf_dir, "pages"))


@query("SELECT d.doc_id, d.lang, coalesce(CAST(l.quality AS BIGINT), -1) AS quality FROM documents d LEFT JOIN labels l USING (doc_id)", base=False)
def sparse_labels(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("long").alias("quality"))
    return tables.null_safe_join(table(spark, sf_dir, "documents").select("doc_id", "lang"), labels, ["doc_id"]).fillna(-1, ["quality"])


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)", base=False)
def unlabelled(spark, sf_dir):
    return tables.null_safe_join(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id"), ["doc_id"], "left_anti")


@query(
    f"""WITH n AS (SELECT DISTINCT source AS name, 'source' AS type, 's_' AS p FROM documents UNION SELECT DISTINCT lang, 'lang', 'l_' FROM documents)
SELECT name, type, p || name AS target_id, {nested([*t.TRIGRAPHS.items(), *t.DIGRAPHS.items(), *[(d + d, d) for d in t.DOUBLES]], 'name')} AS terms FROM n""",
    base=False,
)
def search_index(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    families = {"source": (docs.select(F.col("source").alias("name")).distinct(), "s_"), "lang": (docs.select(F.col("lang").alias("name")).distinct(), "l_")}
    return masters.search_index(families)


@query("SELECT n_name AS key, CASE WHEN n_nationkey % 3 = 0 THEN 'en ' || n_name WHEN n_nationkey % 3 = 1 THEN 'mk ' || n_name ELSE n_name END AS text FROM nation", base=False)
def translated_texts(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    texts = n.filter("n_nationkey % 3 = 0").select(F.col("n_name").alias("key"), F.lit("en").alias("lang"), F.concat(F.lit("en "), "n_name").alias("text"))
    texts = texts.union(n.filter("n_nationkey % 3 < 2").select("n_name", F.lit("mk"), F.concat(F.lit("mk "), "n_name")))
    return masters.translated(n.select(F.col("n_name").alias("key")), texts, "en")


@query("SELECT c_mktsegment AS letter_source, upper(substr(c_mktsegment, 1, 1)) AS letter, count(*) AS n FROM customer GROUP BY ALL", base=False)
def alphabet_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("letter_source"), F.upper(F.substring("c_mktsegment", 1, 1)).alias("letter"))
    return rows.groupBy("letter_source", "letter").agg(F.count("*").alias("n"))
