"""Seeded exact-size samples, dense ids and top-n selections.

Random order is the order of ``md5(seed|id)``: it depends on the row and not on
how the data is partitioned, so a lost executor or another cluster size gives
the same sample. Ids are expected to be unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from .selection import filter_period

HASH_PREFIX = 4  # hex digits: up to 65,536 buckets of evenly spread hashes


def sample_key(id_col: str, seed: int = fv.SAMPLE_SEED) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col).cast("string")).cast("binary"))


def ranked_by_hash(df: DataFrame, id_col: str = "doc_id", seed: int = fv.SAMPLE_SEED, limit: int | None = None) -> DataFrame:
    """Add ``sample_rank``, the 1-based place of each row in hash order.

    A global ``row_number`` would sort everything in one task. Instead rows are
    ranked inside their hash-prefix bucket and the counts of the buckets before
    it are added; only the bucket histogram (65,536 rows at most) is ordered as
    a whole. With a ``limit``, buckets that start past it are dropped before the
    wide rows are shuffled.
    """
    keyed = df.withColumn("_key", sample_key(id_col, seed)).withColumn("_bucket", F.substring("_key", 1, HASH_PREFIX))
    # Counting needs only ids; the wide columns are not read for it.
    histogram = (
        df.select(F.substring(sample_key(id_col, seed), 1, HASH_PREFIX).alias("_bucket"))
        .groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_in_bucket"))
    )
    before = F.coalesce(
        F.sum("_in_bucket").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    offsets = histogram.select("_bucket", before.alias("_offset"))
    if limit is not None:
        offsets = offsets.where(F.col("_offset") < limit)
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy("_key", id_col))
    # The prefix length bounds the offsets to 65,536 small rows.
    ranked = keyed.join(F.broadcast(offsets), "_bucket").withColumn("_place", place)
    if limit is not None:
        ranked = ranked.where(F.col("_place") <= limit)
    ranked = ranked.withColumn("sample_rank", F.col("_offset") + F.col("_place"))
    if limit is not None:
        ranked = ranked.where(F.col("sample_rank") <= limit)
    return ranked.drop("_key", "_bucket", "_offset", "_place")


def sample_exact_n(df: DataFrame, n: int = fv.SAMPLE_SIZE, id_col: str = "doc_id", seed: int = fv.SAMPLE_SEED) -> DataFrame:
    """Exactly ``n`` rows without replacement, or all of them if there are fewer."""
    return ranked_by_hash(df, id_col, seed, limit=n).drop("sample_rank")


def dense_doc_id(df: DataFrame, id_col: str = "doc_id", seed: int = fv.SAMPLE_SEED, out: str = "doc_id") -> DataFrame:
    """0-based gapless ids in sample order, without a single-partition window."""
    ranked = ranked_by_hash(df, id_col, seed)
    return ranked.withColumn(out, F.col("sample_rank") - 1).drop("sample_rank")


def require_min_rows(corpus: DataFrame, n: int = fv.SAMPLE_SIZE, start: str = fv.PERIOD_START, end: str = fv.PERIOD_END) -> DataFrame:
    """The rows of the period; raises if there are fewer than ``n``.

    The error carries the yearly volume of the whole corpus as a diagnosis.
    """
    in_period = filter_period(corpus, start, end)
    # n rows at most are counted, however long the period is.
    found = in_period.select(F.lit(1)).limit(n).count()
    if found < n:
        volume = docs_per_year(corpus).orderBy("year").collect()
        lines = ", ".join(f"{row['year']}: {row['n_docs']}" for row in volume)
        raise ValueError(f"the period has {found} documents, fewer than {n}; documents per year: {lines}")
    return in_period


def draw_sample(corpus: DataFrame, n: int = fv.SAMPLE_SIZE, start: str = fv.PERIOD_START, end: str = fv.PERIOD_END, seed: int = fv.SAMPLE_SEED) -> DataFrame:
    """Period, volume check, sample and dense id in one go: the raw sample table."""
    in_period = require_min_rows(corpus, n, start, end)
    ranked = ranked_by_hash(in_period, "doc_id", seed, limit=n)
    dense = ranked.withColumn("doc_id", F.col("sample_rank") - 1)
    return dense.select("doc_id", "title", "text", "date", "category", "link")


def docs_per_year(df: DataFrame, column: str = "date") -> DataFrame:
    """Rows without a date are in no year."""
    dated = df.where(F.col(column).isNotNull())
    return dated.groupBy(F.year(column).alias("year")).agg(F.count(F.lit(1)).alias("n_docs"))


def first_n_per_cluster(df: DataFrame, cluster_col: str, n: int = fv.EXAMPLES_PER_CLUSTER, order_col: str = "doc_id") -> DataFrame:
    """The first rows of each cluster in document order, with their rank ``rk``.

    The rank filter lets Spark cut every partition to ``n`` rows per cluster
    before the shuffle, so a giant cluster sends no more than a small one.
    """
    place = F.row_number().over(Window.partitionBy(cluster_col).orderBy(order_col))
    return df.withColumn("rk", place).where(F.col("rk") <= n)


def cluster_sample(df: DataFrame, cluster_col: str, cluster_id: int, n: int = 10) -> DataFrame:
    """The first rows of one cluster as shown in a report."""
    rows = df.where(F.col(cluster_col) == cluster_id).select("doc_id", "title", "category", "date")
    return rows.orderBy("doc_id").limit(n)


def sorted_clusters(df: DataFrame, cluster_col: str) -> DataFrame:
    return df.select(F.col(cluster_col).alias("cluster_id")).distinct().orderBy("cluster_id")


def select_best_k(scores: DataFrame) -> DataFrame:
    """The k with the highest silhouette; the smallest k wins ties.

    Scores of -1 or less never win, as the search starts from -1.
    """
    return scores.where(F.col("silhouette") > -1).orderBy(F.desc("silhouette"), F.asc("k")).limit(1)
