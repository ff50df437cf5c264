"""Training data from ``documents`` in stages, each stage's table being the next one's input."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from themeweave.llm import decontamination, exact_dedup, mixing, near_dedup, quality
from themeweave.session import materialize, ship_package


# Bytes of an Arrow batch between executors and their Python workers. Whole texts
# pass in both directions here, and either side holds several batches.
BATCH_BYTES = 4 << 20


def _stage(f):
    """A stage with bounded batches, its package known to the workers."""

    @functools.wraps(f)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return f(spark, docs, sf_dir)

    return run


def _side(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_stage
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier finds neither bad nor toxic stay."""
    return quality.keep_good(docs, _side(spark, sf_dir, "labels"))


@_stage
def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every set of equal texts stays: the one of the smallest doc_id."""
    return exact_dedup.drop_copies(docs)


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group linked by a similarity of 0.8 on shingles of five words stays."""
    return near_dedup.drop_near(docs, size=5, percent=80)


@_stage
def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, even with other numbers or names, go."""
    return decontamination.drop_leaks(docs, _side(spark, sf_dir, "benchmark"))


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's words in the mix, and its training positions, in order of the first pass over it."""
    mixed = mixing.ordered(mixing.mix(docs))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken", "position", "positions")


STAGES = [
    ("quality", keep_good),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
]

# Classifier, similarity join and template alignment have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _side(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
