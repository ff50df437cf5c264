"""The stateless stages on streams: cleaning documents and checking labels as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from .. import schemas
from ..operators.labeling import parse_labels, validate_labels
from ..operators.selection import preprocess_corpus


def read_landing(spark: SparkSession, path: str, schema: StructType = schemas.RAW_CORPUS, files_per_trigger: int = 1000) -> DataFrame:
    """New Parquet files of a landing folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def clean_stream(raw: DataFrame) -> DataFrame:
    return preprocess_corpus(raw)


def check_label_stream(responses: DataFrame) -> DataFrame:
    return validate_labels(parse_labels(responses))


def drain_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived to a Parquet table, exactly once, then stop."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
