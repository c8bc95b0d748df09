"""Queries of the operators, and their SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    collocations,
    decontaminate,
    line_dedup,
    minhash_dedup,
    mixing,
    ngram_lm,
    substring_dedup,
    token_counts,
    token_files,
    toxicity,
    vector_dedup,
    warc,
    whitening,
)
from .common import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


@query
def op1_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return minhash_dedup.near_duplicates(load(spark, folder, "documents"))


@query
def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages in every document."""
    return decontaminate.decontaminate(load(spark, folder, "documents"), load(spark, folder, "benchmark"))


SQL["op2_decontaminate"] = decontaminate.SQL


@query
def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that repeat a passage of an earlier one."""
    return substring_dedup.remove_repeats(load(spark, folder, "documents")).drop("kept")


SQL["op4_substring_dedup"] = substring_dedup.SQL


def word_vocabulary() -> str:
    """The vocabulary file of the public word-level tokenizer."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Where every document's token ids lie, read back from the packed files."""
    return token_files.packed(load(spark, folder, "documents"), word_vocabulary())


@query
def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of every document the mix takes."""
    rows = mixing.mixed(load(spark, folder, "documents"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return rows.select("doc_id", "size", "source_size", "target", taken)


@query
def op10_ngram_lm(spark: SparkSession, folder: str) -> DataFrame:
    """Log probability of every document under a trigram model of the training fold."""
    return ngram_lm.score(load(spark, folder, "documents"))


@query
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of every document that repeat three lines seen before."""
    return line_dedup.remove_repeated_lines(load(spark, folder, "documents")).drop("kept")


SQL["op6_line_dedup"] = line_dedup.SQL


@query
def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written as archives, normalised, and read back."""
    return warc.archived(load(spark, folder, "pages"))


SQL["op9_warc"] = warc.SQL


@query
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, learned from two thirds of the labels."""
    docs, labels = load(spark, folder, "documents"), load(spark, folder, "labels")
    model = toxicity.learn(docs, labels.where(~toxicity.held_out()))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", "spans")


@query
def op3_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate links and components of all embeddings."""
    return vector_dedup.near_duplicates(load(spark, folder, "embeddings"))


@query
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """All embeddings on the leading eigenvectors of their covariance."""
    return whitening.whiten(load(spark, folder, "embeddings"))


def byte_vocabulary() -> str:
    """The vocabulary file of the public byte-level tokenizer."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return token_counts.count_tokens(load(spark, folder, "documents"), byte_vocabulary())


@query
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The phrases of each language whose words go together most."""
    return collocations.phrases(load(spark, folder, "documents"))


SQL["op13_collocations"] = collocations.SQL
