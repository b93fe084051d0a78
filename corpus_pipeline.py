"""The corpus pipeline: quality rules, SimHash near-dedup, benchmark
decontamination, PII masking, best-fit packing. Every stage takes the rows its
predecessor kept; all but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm import decontamination, packing, pii, quality_rules, simhash
from vaultline.llm.common import materialize, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or a certified cutoff reject go."""
    judged = quality_rules.screen(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))
    return judged.filter("kept").select(*COLUMNS)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs.select(*COLUMNS), shingle=simhash.SHINGLE, max_bits=simhash.MAX_BITS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.remove_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mask(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows the text."""
    masked = pii.mask_pii(docs.select(*COLUMNS))
    return masked.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of at most 4,096."""
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [("quality", quality), ("dedup", dedup), ("decontaminate", decontaminate), ("pii", mask), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


# Fingerprints and token ids have no SQL form: tests/llm compare run() with a brute-force version.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
