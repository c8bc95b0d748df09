"""A corpus from documents to token files: score, dedup, decontaminate, mix, pack.

Each stage works on all the rows its predecessor kept, and is written before the next
reads it. Rows without a doc_id pass the filters: nothing can be said of them by id.

Nulls, empty and very long texts, ties: a null or empty text is neither toxic, nor a copy, nor
contaminated, and stays; in the mix it counts no words and comes along with the whole copies of
its source. Texts are worked on whole. Of rows that repeat doc_id and text one stays after
near-dedup; rows of one id and different texts share what is said of the id. An empty table goes through all
stages as one. Other columns are carried as they are, whatever their names, up to the last
stage; map columns count as equal in rows that repeat id and text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.llm import decontaminate, minhash_dedup, mixing, token_files, toxicity
from lakeloom.llm.common import load, own, unused
from lakeloom.llm.queries import word_vocabulary
from lakeloom.session import pin, scratch_path  # noqa: F401


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is not among ``dropped``, which grows with them."""
    ids = dropped.select("doc_id").distinct().hint("merge")
    return docs.join(ids, "doc_id", "left_anti").select(*own(docs))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the model learns from the labels that are not held out."""
    labels = load(spark, sf_dir, "labels").where(~toxicity.held_out())
    model = toxicity.learn(docs, labels)
    return toxicity.accepted(docs, model)


def once(docs: DataFrame) -> DataFrame:
    """One row of those that repeat doc_id and text; a task sends one row of each."""
    plain = [c for c, f in zip(own(docs), docs.schema, strict=True) if f.dataType.typeName() != "map"]
    same = Window.partitionBy("doc_id", F.sha2("text", 256)).orderBy(F.xxhash64(*plain))
    place = unused(docs, "_place")
    first = docs.where("doc_id IS NOT NULL").withColumn(place, F.row_number().over(same))
    return first.where(F.col(place) == 1).drop(place).unionByName(docs.where("doc_id IS NULL"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id.

    Shingles are of five words, as for any stage; four are op1's own contract.
    """
    judged = pin(minhash_dedup.near_duplicates(docs, words=5).select("doc_id", "kept"), "near")
    return once(without(docs, judged.where("NOT kept")))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    judged = decontaminate.decontaminate(docs, load(spark, sf_dir, "benchmark"))
    judged = pin(judged.select("doc_id", "contaminated"), "contaminated")
    return without(docs, judged.where("contaminated"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.sample(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as packed token files; where each document lies in them."""
    return token_files.packed(docs, word_vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix),
    ("token-ID / binary output", tokens),
]

# Learned scores and random ranks have no SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
