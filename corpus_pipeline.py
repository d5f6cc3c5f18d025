"""The training-text pipeline: five stages, each over what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sessionloom.llm import mixing, quality_rules, simhash, toxicity, winnowing
from sessionloom.llm.common import table
from sessionloom.session import pin_utc, written_once

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their failing lines; n_chars follows the text."""
    kept = quality_rules.judged(docs, "doc_id", "lang", "source").filter("kept")
    return kept.select("doc_id", F.col("clean_text").alias("text"), "lang", "source",
                       F.char_length("clean_text").cast("long").alias("n_chars"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learnt from the labelled ones among them, does not reject."""
    return toxicity.kept(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every near-duplicate class."""
    return simhash.one_of_each(docs.select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage of ten words with a benchmark item."""
    return winnowing.uncontaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix itself: every document as often as its source's target takes it, with the pass as ``epoch``."""
    return mixing.mixed(docs.select(*COLUMNS))


STAGES = [
    ("quality_rules", clean_lines),
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("mixing_to_target_weights", mix_sources),
]
# learnt scores decide, which SQL cannot express; tests compare with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is stored in the shared folder before the next one reads it."""
    docs = table(pin_utc(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written_once(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
