"""Registered queries of the training-text operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import pin_utc
from . import (
    byte_bpe, collocations, hard_negatives, knn_quality, licenses, maxent, mixing, quality_rules, simhash, token_counts,
    toxicity, warc, winnowing,
)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TOKEN_LIMIT = 4096
TOKENIZER = "piece_bpe_32k.model"
RANKS = "byte_bpe_multi_50k.tiktoken"


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(pin_utc(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


@query
def op1_mixing(spark, sf_dir):
    """What a mix of weighted sources takes of every document."""
    sized = mixing.sized_rows(table(spark, sf_dir, "documents"))
    rows = mixing.with_taken(sized, mixing.mix_plan(sized))
    return rows.select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken")


@query
def op4_warc(spark, sf_dir):
    """Every page as a WARC record, read back from the archives."""
    written = warc.write_archives(table(spark, sf_dir, "pages"), warc.archive_folder(spark))
    return warc.read_archives(written, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


@query
def op5_quality_rules(spark, sf_dir):
    """Counts and verdict of line-first cleaning for every document."""
    return quality_rules.judged(table(spark, sf_dir, "documents"), "doc_id").drop("clean_text")


@query
def op7_token_counts(spark, sf_dir):
    """Tokens of every document by the public 32,000-piece model."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counted = docs.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), token_counts.piece_count(
        spark, public_tokenizers.path(TOKENIZER), F.col("text")).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query
def op6_decontamination(spark, sf_dir):
    """Words of every document inside passages of ten words that a benchmark item holds as well."""
    found = winnowing.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(
        F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"), "contaminated")


@query
def op8_simhash(spark, sf_dir):
    """Fingerprint and near-duplicate class of every document."""
    rows = simhash.clustered(table(spark, sf_dir, "documents"))
    return rows.select(F.col("key").alias("doc_id"), simhash.hex_mark(F.col("mark")).alias("fingerprint"),
                       F.col("component").alias("component_id"))


@query
def op9_licenses(spark, sf_dir):
    """Licence notices in every document."""
    found = licenses.scanned(table(spark, sf_dir, "documents"), "doc_id")
    return found.select("doc_id", "n_matches", "licenses", "best_license", "best_dice")


@query
def op10_quality(spark, sf_dir):
    """Quality of every document by its labelled neighbours."""
    return knn_quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_toxicity(spark, sf_dir):
    """Toxicity of every document by its worst sentence."""
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_language_model(spark, sf_dir):
    """Probability of every document under a maximum-entropy model and under unigrams."""
    return maxent.scored(table(spark, sf_dir, "documents"))


@query
def op11_byte_bpe(spark, sf_dir):
    """Ids of every document by the ranks of a public byte-level vocabulary, and what they decode to."""
    import public_tokenizers

    bpe = byte_bpe.ByteBpe(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    coded = table(spark, sf_dir, "documents").select("doc_id", bpe.coded(F.col("text")).alias("c"))
    return coded.select("doc_id", bpe.count(F.col("c.ids")).alias("n_tokens"), F.sha2("c.ids", 256).alias("ids_sha256"),
                        F.sha2("c.bytes", 256).alias("decoded_sha256"))


@query
def op13_collocations(spark, sf_dir):
    """The phrases of every language whose words attract each other most."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op12_hard_negatives(spark, sf_dir):
    """Rows of other labels that score close below an anchor's positives."""
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))
