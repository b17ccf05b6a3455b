"""The operators of this subpackage over the tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, content, jaccard, language, license, merkle, mixing, near_vectors, negatives, packing, repeats, rules, transducer
from tidemark.llm.shared import ship_library
from tidemark.sources import tables

#: Parameters of the queries.
RANKS, WORD_TOKENIZER = "byte_bpe_50k.tiktoken", "word_bpe_49k.json"
CLOSING_ID, TOKEN_LIMIT = 1, 2048


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_library(spark)
    return tables.load_table(spark, sf_dir, name)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_texts(load_table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut_documents(load_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER), CLOSING_ID)
    return packing.pack(spark, pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op3_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    return mixing.score_texts(spark, docs, language.remainder("doc_id", 7) != 2)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # only these columns: others may have the names of counts
    judged = rules.apply_rules(load_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = language.remainder("doc_id", 5) == 0
    prototypes = language.train(docs.where(~held_out))
    found = language.identify(docs.select("doc_id", "text"), prototypes)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content.extract(load_table(spark, sf_dir, "pages"))


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(spark, load_table(spark, sf_dir, "embeddings"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(spark, load_table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = transducer.count_tokens(load_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan_licenses(load_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = {"text": merkle.tampered_text(F.col("text"), F.col("doc_id"))}
    return merkle.digest_rows(merkle.manifest(spark, load_table(spark, sf_dir, "documents"), tampered))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest_texts(repeats.without_repeats(spark, load_table(spark, sf_dir, "documents")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load_table(spark, sf_dir, "embeddings").where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & negatives.usable(F.col("embedding")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = e.select(F.col("vec_id").alias("id"), label.alias("label"), negatives.quantised(F.col("embedding")).alias("vector"))
    return negatives.mine(spark, rows, F.col("id") % 100 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_byte_bpe,
        op2_packing,
        op3_context_mixing,
        op4_quality_rules,
        op5_language_id,
        op6_html_extraction,
        op7_near_vectors,
        op8_ngram_jaccard,
        op9_token_counts,
        op10_license_scan,
        op11_merkle_manifest,
        op12_substring_dedup,
        op13_hard_negatives,
        pipeline,
    )
}
ORACLE: dict[str, str] = {"op4_quality_rules": rules.oracle(), "op11_merkle_manifest": merkle.oracle(), "op12_substring_dedup": repeats.oracle(), "op13_hard_negatives": negatives.oracle()}
