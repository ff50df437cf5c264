"""Projections, filters and the cleaning of the corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import text as tx


def parse_iso_date(col: Column, lenient: bool = False) -> Column:
    """ISO-8601 text to timestamp. Bad values raise, or become null when lenient."""
    return F.try_to_timestamp(col) if lenient else F.to_timestamp(col)


def filter_period(df: DataFrame, start: str = fv.PERIOD_START, end: str = fv.PERIOD_END, column: str = "date") -> DataFrame:
    """``start <= date < end``; rows without a date drop out.

    The bounds are cast, not the column, so the filter reaches the scan. A corpus
    laid out by ``year`` is filtered by that, too, which prunes its folders.
    """
    if "year" in df.columns and column == "date":
        last = F.year(F.lit(end).cast("timestamp") - F.expr("interval 1 microsecond"))
        df = df.where(F.col("year").between(F.year(F.lit(start).cast("date")), last))
    kind = df.schema[column].dataType
    low, high = F.lit(start).cast(kind), F.lit(end).cast(kind)
    return df.where((F.col(column) >= low) & (F.col(column) < high))


def project_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns)


def clean_corpus(df: DataFrame) -> DataFrame:
    """Cleaned ``title`` and ``text`` and the ``texto_modelo`` made from them.

    The cleaned pair goes through a one-row ``inline``: filters on the model
    text, such as the length filter, would otherwise be pushed below the
    projection and clean every text a second time.
    """
    # clean_text in two steps, so that no step repeats the one before it
    without_urls = df.withColumns({c: tx.strip_urls(tx.null_to_empty(F.col(c))) for c in ("title", "text")})
    pair = F.struct(*[tx.normalize_whitespace(tx.strip_tags(F.col(c))).alias(c) for c in ("title", "text")])
    others = [c for c in df.columns if c not in ("title", "text")]
    cleaned = without_urls.select(*others, F.inline(F.array(pair))).select(*df.columns)
    return cleaned.withColumn("texto_modelo", tx.model_text(F.col("title"), F.col("text")))


def filter_min_length(df: DataFrame, chars: int = fv.MIN_CHARS, column: str = "texto_modelo") -> DataFrame:
    return df.where(F.char_length(column) >= chars)


def preprocess_corpus(df: DataFrame, chars: int = fv.MIN_CHARS) -> DataFrame:
    """Clean, build the model text, drop documents that are too short.

    A single narrow stage without shuffle; works on streams as well.
    """
    return filter_min_length(clean_corpus(df), chars)


def stage_counts(df: DataFrame, chars: int = fv.MIN_CHARS, start: str = fv.PERIOD_START, end: str = fv.PERIOD_END) -> DataFrame:
    """Rows before, after and removed by the length filter, and rows in the period."""
    long_enough = F.char_length("texto_modelo") >= chars
    kind = df.schema["date"].dataType
    in_period = (F.col("date") >= F.lit(start).cast(kind)) & (F.col("date") < F.lit(end).cast(kind))
    return clean_corpus(df).agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(long_enough).alias("rows_after"),
        F.count_if(~long_enough).alias("rows_removed"),
        F.count_if(in_period).alias("rows_in_period"),
    )


def drop_noise(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) != fv.NOISE)


def filter_cluster(df: DataFrame, column: str, cluster_id: int) -> DataFrame:
    return df.where(F.col(column) == cluster_id)


def attach_assignments(df: DataFrame, assignments: DataFrame) -> DataFrame:
    """Cluster columns joined to the corpus by ``doc_id``, never by position."""
    return df.join(assignments, "doc_id", "left")
