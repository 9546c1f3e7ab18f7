"""From raw documents to a training mix: five operators, each applied to all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyops.llm import decontaminate, line_dedup, mixing, quality, simhash
from skyops.llm.common import scratch, stored, words_of

SHINGLE_WORDS = 5
MIN_SIMILARITY = 0.8
# Texts go to Python in batches of about so many bytes, so that memory doesn't grow with their length.
ARROW_BYTES = 1024 * 1024


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _small_batches(spark: SparkSession) -> None:
    """For the rest of the session, as stages are worked out only when they are written."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counts and are mostly content lines."""
    _small_batches(spark)
    return quality.keep_good(docs, quality.fit_lines(docs, _table(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier one; every line with a word is compared. A document goes if it lost
    lines and no word is left: all that it said has been said before."""
    deduped = line_dedup.dedup_lines(docs)
    kept = deduped.where((F.col("n_dropped") == 0) | (F.size(words_of(F.col("text"))) > 0))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts that are similar enough the row with the least id; null ids come last."""
    _small_batches(spark)
    with scratch(spark):
        found = simhash.similar_duplicates(docs, SHINGLE_WORDS, min_similarity=MIN_SIMILARITY)
        found = stored(found, "pipeline-near", keep=True)
    return simhash.one_of_each(docs, found)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, _table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the mix takes, with all their columns and those of ``mixing.mix``; ``copies`` says how often."""
    return mixing.mix(docs, whole_rows=True).where("copies > 0")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminated),
    ("source_mixing", mixed),
]

# The quality stage is a fitted model and the mix a dynamic programme; tests hold both against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
