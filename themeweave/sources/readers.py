"""Sources. Every reader takes or knows its schema; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas


def scan_corpus(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A landed corpus. The column list reaches the Parquet scan."""
    corpus = spark.read.parquet(path)
    return corpus.select(*columns) if columns else corpus


def scan_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stage table as CSV with header and quoted embedded newlines.

    An unquoted empty field is null, a quoted one is the empty string. The null
    marker only has to differ from the empty string for Spark to keep them apart.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "\x00")
        .csv(path)
    )


def scan_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.VECTORS).parquet(path)


def scan_json_document(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A whole-file JSON object (one row) or array (one row per element)."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def scan_template(spark: SparkSession, path: str) -> DataFrame:
    """A prompt template file as one row with one string, ``template``."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("template"))


def optional_source(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """The table at ``path``, or an empty one of the same schema if there is none.

    Only "path does not exist" is forgiven; a table that is there but cannot be
    read stays an error.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    if fmt == "json":
        return reader.option("multiLine", True).json(path)
    return reader.format(fmt).load(path)
