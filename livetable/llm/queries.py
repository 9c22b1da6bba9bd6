"""The ``opN_`` queries: each operator, with production parameters, over its whole
table.  ``SQL`` holds the DuckDB form of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import byte_bpe, chat_template, collocations, lexical_rank, line_dedup, main_text, maxent_lm, projected_search, toxicity, url_filter
from .decontaminate import contamination
from .minhash_dedup import near_duplicates
from .phrase_dedup import repeated_phrases
from .store import read, ship

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


#: (action, host and path) of the contract (fixed values).
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def remainder(n: int):
    """crc32 of doc_id, written out, by modulus n."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def _words_in(spans: str):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"), size=2, percent=80)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "action string, rule string")
    return url_filter.filter_urls(read(spark, sf_dir, "pages", "page_id", "url"), rules)


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, k, role, "</s>[INST] ok [/INST]") for k, role in enumerate(("user", "assistant"))], rows.schema)
    return chat_template.read_back(chat_template.format_conversations(rows.union(extra)))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "labels", "doc_id", "toxic")
    held = remainder(5) == 0
    scored = toxicity.fit(docs, labels, allowed=~held).score(docs)
    return scored.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", "predicted")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark"))
    hit = _words_in("spans")
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = byte_bpe.encode(read(spark, sf_dir, "documents", "doc_id", "text"), VOCABULARY, decode=True)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(read(spark, sf_dir, "pages", "page_id", "url", "html")) \
        .withColumn("n_chars", F.length("text").cast("long"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeated_phrases(read(spark, sf_dir, "documents", "doc_id", "text"), joined=True)
    return kept.select("doc_id", "n_words", _words_in("spans").alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_projected_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projected_search.search(read(spark, sf_dir, "embeddings", "vec_id", "embedding"), lambda v: v % 100 == 0, k=10)


def op10_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.score(read(spark, sf_dir, "documents", "doc_id", "text"), held_out=remainder(7) == 2)


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    kept = line_dedup.drop_repeated_lines(docs, line_dedup.file_batches(read(spark, sf_dir, "documents")))
    return kept.select("doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_lexical_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_rank.rank(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark"), k=50)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents", "doc_id", "lang", "text"))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _shipped(f) for f in (
        op1_minhash_dedup, op2_url_filter, op3_chat_format, op4_toxicity, op5_benchmark_decontamination, op6_byte_bpe,
        op7_main_text, op8_substring_dedup, op9_projected_search, op10_maxent_lm, op11_line_dedup, op12_lexical_rank, op13_collocations)
}

SQL: dict[str, str] = {
    "op2_url_filter": r"""
WITH parts AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
rules(action, rule, rule_host, rule_path) AS (
  VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
         ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')),
fits AS (
  SELECT page_id, host, path, rule, action, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) AS r
  FROM split LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM fits WHERE r = 1
""",
    "op3_chat_format": chat_template.SQL,
    "op11_line_dedup": line_dedup.SQL,
    "op12_lexical_rank": lexical_rank.SQL,
    "op13_collocations": collocations.SQL,
}
