"""From raw documents to packed training sequences, in stages that each read the one before."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stipend.llm import lines, mixing, packing, quality, simhash
from stipend.llm.queries import MAX_DISTANCE, SHINGLE_WORDS, VOCABULARY, table
from stipend.shared import own_folder, released, write_stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    judged = quality.classify(docs, table(spark, sf_dir, "labels"))
    return judged.where("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line stands for; those left without any go."""
    left = lines.drop_lines(docs).where("not emptied")
    size = F.when(F.col("n_dropped") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", size).select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs, SHINGLE_WORDS, MAX_DISTANCE)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_rows(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(docs, VOCABULARY)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

#: A fitted classifier, hashes and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result but the last is written and read again, and what the
    stage itself wrote on the way goes then."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        kept = own_folder(spark, name)
        with released():
            docs = write_stage(apply(spark, docs, sf_dir), kept)
    return STAGES[-1][1](spark, docs, sf_dir)
