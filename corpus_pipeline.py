"""A corpus cleaning pipeline: language, quality, near duplicates, packing.

Every stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a frame that is written as Parquet and read again as the next stage's
docs.  All stages but the last return the columns of ``documents``.

* language_id drops documents without a letter (``und``);
* quality_rules keeps what operator 4 keeps;
* near_duplicates keeps one document of each component, that with the smallest
  doc_id;
* packing returns the pieces of the kept documents with their sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard, language, packing, rules
from tidemark.llm.shared import ship_library, write_table
from tidemark.sources.tables import load_table


def nested(docs: DataFrame) -> DataFrame:
    """The text, and all other columns as one, so that no column of theirs meets an operator's working columns."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"), "text")


def restored(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Prototypes from the training rows of this stage's input; documents without a language go."""
    prototypes = language.train(docs.where(language.remainder("doc_id", 5) != 0))
    found = language.identify(nested(docs), prototypes)
    return found.where(F.col("lang_pred") != language.UNDETERMINED).transform(restored, docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # the row number keeps the optimizer from copying the whole projection into a filter below it
    judged = rules.apply_rules(nested(docs)).withColumn("number", F.monotonically_increasing_id())
    return judged.where(F.col("kept") & (F.col("number") >= 0)).transform(restored, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are numbered, so that rows without an id, or with one id and different texts, are documents of their own.
    The row with the smallest id of each component stays (an id before none, then the smaller number)."""
    numbered = write_table(spark, nested(docs).select("row", "text", F.monotonically_increasing_id().alias("number")), "near-rows")
    found = jaccard.jaccard_components(spark, numbered.select(F.col("number").alias("doc_id"), "text"))
    ids = numbered.select("number", F.col("row.doc_id").alias("id"))
    first = found.join(ids, found["doc_id"] == ids["number"]).groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "number")).alias("first"))
    return numbered.join(first.select("first.number"), "number", "left_semi").transform(restored, docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.cut_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 1)
    return packing.pack(spark, pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def _shipped(stage: Callable) -> Callable:
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_library(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("language_id", _shipped(language_id)),
    ("quality_rules", _shipped(quality_rules)),
    ("near_duplicates", _shipped(near_duplicates)),
    ("packing", _shipped(pack_documents)),
]

#: Language models, near-duplicate components and packing are not SQL; tests/llm compares with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
