"""Sinks. Tables go to Parquet; CSV and JSON are there for exchange."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from .. import schemas
from ..session import materialize


def sink_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Overwrite the table at ``path``. An empty result is written too, with its schema.

    CSV cannot hold nested values, so those become JSON text there.
    """
    if fmt == "csv":
        nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (ArrayType, MapType, StructType))]
        df = df.withColumns({name: F.to_json(name) for name in nested})
        options = {
            "header": True,
            "quote": '"',
            "escape": '"',
            "emptyValue": '""',
            "ignoreLeadingWhiteSpace": False,
            "ignoreTrailingWhiteSpace": False,
        }
        df.write.mode("overwrite").options(**options).csv(path)
        return
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(fmt).save(path)


def sink_corpus_by_year(df: DataFrame, path: str) -> None:
    """The corpus partitioned by calendar year, so that a period filter prunes folders."""
    sink_table(df.withColumn("year", F.year("date")), path, partition_by=["year"])


def sink_vectors(df: DataFrame, path: str) -> None:
    """Vectors keyed by ``doc_id``, in float32 as they come from the encoder."""
    columns = [F.col(f.name).cast(f.dataType) for f in schemas.VECTORS.fields]
    sink_table(df.select(*columns), path)


def sink_json_document(df: DataFrame, path: str) -> None:
    """Reports of one or few rows, as JSON text. Nulls are kept as ``null``."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def sink_dead_letters(df: DataFrame, path: str, fmt: str = "parquet", run: str | None = None) -> None:
    """Append failures. Writers never read what is there, so they do not race.

    With ``run``, the letters are that run's, in a folder of its own (a column ``run``
    when read). Writing them again replaces them as a whole when the job commits, so a
    repeated run adds no row, and one that dies before its commit leaves what was there.
    A run without failures leaves an empty table, also where an earlier attempt had some.
    """
    letters = df.select(*[F.col(f.name).cast(f.dataType) for f in schemas.DEAD_LETTER.fields])
    if run is None:
        letters.write.mode("append").format(fmt).save(path)
        return
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", run):
        raise ValueError("a run is named by letters, digits, dots, hyphens and underscores")
    letters = materialize(letters, "dead-letters")
    if letters.isEmpty():
        # Replacing partitions that rows fall into would leave an earlier attempt's, and no schema to read.
        letters.write.mode("overwrite").format(fmt).save(f"{path}/run={run}")
        return
    keyed = letters.withColumn("run", F.lit(run))
    keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").format(fmt).save(path)
