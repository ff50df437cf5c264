"""The operators of this subpackage applied to whole tables, one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from . import conversation_repair, decontamination, exact_dedup, fill_in_middle, language_id, language_model, mixing, near_dedup
from . import personal_data, quality, secret_scan, substring_dedup, token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op7_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@query
def op10_mixing(spark, sf_dir):
    mixed = mixing.ordered(mixing.mix(table(spark, sf_dir, "documents")))
    second = F.floor(F.get("positions", F.lit(1)) * 1e6).cast("long")  # of documents that are taken twice
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "position", second.alias("second_position"))


@query
def op6_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


@query
def op5_substring_dedup(spark, sf_dir):
    return substring_dedup.digest(substring_dedup.without_repeats(table(spark, sf_dir, "documents")))


@query
def op4_language_model(spark, sf_dir):
    return language_model.score_held_out(table(spark, sf_dir, "documents"))


@query
def op3_language_id(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"))


@query
def op9_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.classify(docs, quality.fit(docs, labels))


@query
def op2_decontamination(spark, sf_dir):
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op1_secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.learn(docs))


@query
def op8_personal_data(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return personal_data.find(docs, personal_data.learn(docs))


@query
def op11_conversation_repair(spark, sf_dir):
    return conversation_repair.digest(table(spark, sf_dir, "conversations"))


@query
def op12_fill_in_middle(spark, sf_dir):
    return fill_in_middle.digest(fill_in_middle.transform(table(spark, sf_dir, "documents")))


@query
def op13_token_files(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    files = token_files.write_documents(table(spark, sf_dir, "documents"), path, end_id=1, by_word=True)
    return token_files.read_digests(spark, files)
