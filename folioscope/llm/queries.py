"""The queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioscope.llm import bin_completion, block_naming, gumbel_pieces, html_crf, langid_ppm, probminhash, quality_ordinal, rpforest, token_rans, url_rules


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = _table(spark, sf_dir, "documents")
    return langid_ppm.identify(docs, langid_ppm.fit(docs))


#: (rule_id, host or host and path prefix, action): whole domains, exceptions within them, and exceptions to those.
URL_RULES = [
    (1, "example.com", "allow"),
    (2, "ads-track.example.com", "deny"),
    (3, "cheap-pills.example.com", "deny"),
    (4, "spam-farm.example.org", "deny"),
    (5, "spam-farm.example.org/en", "review"),
    (6, "spam-farm.example.org/en/1", "deny"),
    (7, "example.net", "review"),
    (8, "blog.example.net", "deny"),
    (9, "m.example.com", "deny"),
    (10, "example.org/fr", "deny"),
    (11, "tiontion.example.com", "deny"),
    (12, "blog.tiontion.example.com", "allow"),
    (13, "blog.tiontion.example.com/en/8", "deny"),
    (14, "WWW.Example.ORG", "allow"),
    (15, "example.org", "deny"),
]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most specific rule for every page."""
    return url_rules.matched(_table(spark, sf_dir, "pages"), url_rules.rules_table(spark, URL_RULES))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's expected grade and chance of the top grade."""
    docs = _table(spark, sf_dir, "documents")
    return quality_ordinal.rate(docs, quality_ordinal.fit(docs, quality_ordinal.graded(_table(spark, sf_dir, "labels"))))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of near copies."""
    return probminhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids, compressed."""
    return token_rans.encoded(_table(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = _table(spark, sf_dir, "pages")
    return html_crf.extracted(pages, html_crf.fit(html_crf.labelled_pages(pages, _table(spark, sf_dir, "documents"))))


def op7_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding's group of near copies."""
    return rpforest.groups(_table(spark, sf_dir, "embeddings"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of every document lies."""
    return bin_completion.packed(_table(spark, sf_dir, "documents"))


def op9_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct sampled segmentations of every document, and whether each is decoded to its text."""
    return gumbel_pieces.sampled(_table(spark, sf_dir, "documents"))


def op10_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's first copy and number of copies."""
    return block_naming.duplicates(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_url_filter": op2_url_filter,
    "op3_quality": op3_quality,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_token_blocks": op5_token_blocks,
    "op6_html_text": op6_html_text,
    "op7_embedding_duplicates": op7_embedding_duplicates,
    "op8_packing": op8_packing,
    "op9_sampled_pieces": op9_sampled_pieces,
    "op10_exact_duplicates": op10_exact_duplicates,
}

_KEY = """
    WITH bare AS (SELECT *, regexp_replace(regexp_replace(trim({url}), '^([a-zA-Z][a-zA-Z0-9+.-]*:)?//', ''), '[?#].*$', '') AS rest FROM {table}),
    hosted AS (SELECT *, regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace(split_part(rest, '/', 1), '^.*@', ''), ':[0-9]*$', ''), '\\.$', '')), '^www\\.', '') AS host FROM bare)
    SELECT *, CASE WHEN host <> '' THEN array_to_string(list_reverse(string_split(host, '.')), ',') || ',' ||
        CASE WHEN contains(rest, '/') THEN substr(rest, strpos(rest, '/')) ELSE '/' END END AS key FROM hosted
"""

ORACLE_SQL: dict[str, str] = {
    "op2_url_filter": f"""
        WITH rules(rule_id, rule, action) AS (VALUES {", ".join(map(str, URL_RULES))}),
        given AS (SELECT CASE WHEN contains(rule, '/') THEN key ELSE regexp_replace(key, '/$', '') END AS prefix, min(rule_id) AS rule_id, arg_min(action, rule_id) AS action
                  FROM ({_KEY.format(url="rule", table="rules")}) GROUP BY 1),
        keyed AS (SELECT page_id, url, key FROM ({_KEY.format(url="url", table="pages")})),
        best AS (SELECT page_id, url, max_by(rule_id, length(prefix)) AS rule_id, max_by(action, length(prefix)) AS action, count(*) AS depth
                 FROM (SELECT DISTINCT page_id, url, key FROM keyed) JOIN given ON starts_with(key, prefix) GROUP BY ALL)
        SELECT k.page_id, k.key, CAST(b.rule_id AS BIGINT) AS rule_id, coalesce(b.action, 'allow') AS action, CAST(coalesce(b.depth, 0) AS INTEGER) AS depth
        FROM keyed k LEFT JOIN best b ON k.page_id = b.page_id AND k.url = b.url
    """,
    "op10_exact_duplicates": """
        SELECT doc_id,
               CASE WHEN text IS NULL THEN doc_id ELSE min(doc_id) OVER (PARTITION BY text) END AS keep_id,
               CASE WHEN text IS NULL THEN 1 ELSE count(*) OVER (PARTITION BY text) END AS copies
        FROM documents
    """,
}
