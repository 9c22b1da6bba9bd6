"""Corpus pipeline: the stages that turn ``documents`` into training input.

STAGES lists (name, function); each function takes (spark, docs, sf_dir), where
docs is what the stage before wrote, and returns a DataFrame.  ``run`` applies
them in order, writing every stage's result as Parquet in the shared folder and
reading it again, so a lost executor never reaches back beyond one stage.

Rows with null or empty texts pass every stage as they are; a null doc_id is a
document of its own.  A document that a stage cuts keeps its row, also where nothing is
left of its text.  Repeated rows leave as one at near_dedup.  An empty table passes every
stage as an empty table.  A long text is one row in every stage, read whole.  Columns beside
those of ``documents`` are dropped by the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from livetable.llm import byte_bpe, toxicity
from livetable.llm.decontaminate import contamination
from livetable.llm.minhash_dedup import near_duplicates
from livetable.llm.phrase_dedup import repeated_phrases
from livetable.llm.store import read, ship
from livetable.session import shared_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _recut(rows: DataFrame) -> DataFrame:
    """The documents' columns with the cleaned text; n_chars follows where it was cut."""
    cut = F.size("spans") > 0
    return rows.select("doc_id", F.col("cleaned").alias("text"), "lang", "source",
                       F.when(cut, F.length("cleaned").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model predicts as toxic go.  It learns from the
    labelled rows of ``docs`` whose crc32(doc_id) mod 5 is not 0."""
    ship(spark)
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = toxicity.fit(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"), allowed=~held)
    return model.score(docs, carry=tuple(COLUMNS)).filter("predicted = 0").select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity
    0.8 or more) stays: the one with the smallest doc_id.  Repeated rows stay once;
    rows without doc_id stay."""
    ship(spark)
    keep = near_duplicates(docs, size=5, percent=80).filter("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.select(COLUMNS).join(keep, "doc_id", "left_semi").dropDuplicates()
    return named.union(docs.filter("doc_id is null").select(COLUMNS))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of 13-word passages that a document with a smaller doc_id has too are cut."""
    ship(spark)
    return _recut(repeated_phrases(docs, cleaned=True, carry=("lang", "source", "n_chars")))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of ``benchmark`` items (10-word windows) are cut."""
    ship(spark)
    return _recut(contamination(docs, read(spark, sf_dir, "benchmark"), clean=True, carry=("lang", "source", "n_chars")))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids; ``text`` is what the ids decode to."""
    ship(spark)
    coded = byte_bpe.encode(docs, VOCABULARY, decode=True, carry=("lang", "source", "n_chars"))
    return coded.select("doc_id", F.col("decoded").cast("string").alias("text"), "lang", "source", "n_chars",
                        F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", near_dedup),
    ("substring_dedup", drop_repeated_passages),
    ("decontamination", decontaminate),
    ("byte_bpe", tokenize),
]

#: SQL can express neither the toxicity model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = shared_dir(spark, "corpus_pipeline", unique=True)
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{k}_{name}")
        docs = spark.read.parquet(f"{root}/{k}_{name}")
    return docs
