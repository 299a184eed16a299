"""The registered queries of the subpackage, and their SQL where DuckDB can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wintide.llm import (
    bpe,
    decontaminate,
    ordinal_quality,
    pair_bounds,
    posting_lists,
    secrets_index,
    simhash,
    suffix_levels,
    suffix_trees,
    token_links,
    url_rules,
    warc_zip,
    weighted_sampling,
)
from wintide.llm.shared import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def registered(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(fn)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, folder)

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@registered
def op1_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through ZIP-packaged WARC archives and back."""
    return warc_zip.through_packages(table(spark, sf_dir, "pages")).select(
        F.col("record_id").cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


@registered
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by prefix tables and decoded again."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_documents(table(spark, sf_dir, "documents"), ranks, ids=False)


@registered
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, found over a trigram index."""
    found = secrets_index.find_secrets(table(spark, sf_dir, "documents"))
    spans = secrets_index.spans_text(F.col("found"))
    return found.withColumn("spans", spans).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("spans", 256).alias("base_sha256"), "spans"
    )


# Host, path, verdict.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


@registered
def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by nested rules."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), rules)


_RULE_ROWS = ", ".join(str(rule) for rule in URL_RULES)
ORACLE_SQL["op4_url_rules"] = f"""
WITH rules(rhost, rpath, rverdict) AS (VALUES {_RULE_ROWS}),
rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r
  FROM pages
),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM (
  SELECT p.page_id, p.host, p.path, rhost || rpath AS rule, rverdict AS verdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(rhost || rpath) DESC NULLS LAST) AS place
  FROM parts p LEFT JOIN rules
    ON (p.host = rhost OR ends_with(p.host, '.' || rhost)) AND starts_with(p.path, rpath)
) WHERE place = 1
"""


@registered
def op10_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consistent weighted samples of every document and of its edited text."""
    return weighted_sampling.fingerprint_documents(table(spark, sf_dir, "documents"))


@registered
def op3_suffix_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of 400-byte repeats removed from every document."""
    return suffix_levels.remove_repeats(table(spark, sf_dir, "documents"), kept=False)


@registered
def op8_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of 20-word windows that started earlier removed from every document."""
    return suffix_trees.remove_repeated_words(table(spark, sf_dir, "documents"), kept=False)


@registered
def op5_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probabilities of every document."""
    docs = table(spark, sf_dir, "documents")
    return ordinal_quality.score_documents(docs, ordinal_quality.train(docs, table(spark, sf_dir, "labels")))


@registered
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@registered
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in the documents."""
    return decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@registered
def op11_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest neighbours of every hundredth vector among all."""
    return posting_lists.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


@registered
def op13_pair_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty highest-scoring documents for every benchmark item."""
    return pair_bounds.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@registered
def op12_token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token groups of every document under two tokenizers, and the counts of their links."""
    return token_links.align_tokens(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
        public_tokenizers.PATTERN,
    )
