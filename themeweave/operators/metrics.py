"""Counts, purity, coverage and the metrics record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv


def category_counts(df: DataFrame, column: str = "category") -> DataFrame:
    """Rows per value, most frequent first; nulls are left out."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_docs"))
    return counts.orderBy(F.desc("n_docs"), column)


def cluster_distribution(df: DataFrame, cluster_col: str) -> DataFrame:
    return (
        df.groupBy(F.col(cluster_col).alias("cluster_id"))
        .agg(F.count(F.lit(1)).alias("n_docs"))
        .orderBy("cluster_id")
    )


def majority_category(df: DataFrame, cluster_col: str, category_col: str = "category") -> DataFrame:
    """Per cluster: its size, its most frequent category and that category's count.

    Null categories count for the size only; a cluster with no category at all
    has a majority of 0. Ties go to the first category in name order. The first
    aggregation shrinks every cluster to one row per category before anything
    is shuffled.
    """
    by_category = (
        df.where(F.col(cluster_col) != fv.NOISE)
        .groupBy(F.col(cluster_col).alias("cluster_id"), F.col(category_col).alias("category"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    named = F.col("category").isNotNull()
    # min over (-n, category) is the largest n with the smallest name
    top = F.min(F.when(named, F.struct((-F.col("n")).alias("neg"), F.col("category"))))
    return (
        by_category.groupBy("cluster_id")
        .agg(F.sum("n").alias("cluster_rows"), top.alias("top"))
        .select(
            "cluster_id",
            "cluster_rows",
            F.col("top.category").alias("majority_category"),
            F.coalesce(-F.col("top.neg"), F.lit(0)).cast("long").alias("majority_count"),
        )
    )


def cluster_purity(df: DataFrame, cluster_col: str, category_col: str = "category") -> DataFrame:
    """Share of clustered rows in their cluster's majority category; 0.0 without rows."""
    totals = majority_category(df, cluster_col, category_col).agg(
        F.sum("majority_count").alias("hits"), F.sum("cluster_rows").alias("rows")
    )
    share = F.when(F.col("rows") > 0, F.col("hits") / F.col("rows")).otherwise(F.lit(0.0))
    return totals.select(share.cast("double").alias("purity"))


def coverage(df: DataFrame, cluster_col: str) -> DataFrame:
    """Share of rows that are not noise."""
    return df.agg(F.avg((F.col(cluster_col) != fv.NOISE).cast("double")).alias("coverage"))


def n_clusters(df: DataFrame, cluster_col: str) -> DataFrame:
    label = F.when(F.col(cluster_col) != fv.NOISE, F.col(cluster_col))
    return df.agg(F.count_distinct(label).alias("n_clusters"))


def cluster_documents(df: DataFrame, cluster_col: str, text_col: str = "texto_modelo", span: int = 256) -> DataFrame:
    """Each cluster's texts joined by a space, in chunks of ``span`` ids.

    The concatenation of a cluster's chunks in ``chunk`` order is the document
    of the cluster. A chunk holds ``span`` documents at most, so no task ever
    has to hold a whole cluster.
    """
    ordered = F.sort_array(F.collect_list(F.struct("doc_id", F.col(text_col).alias("body"))))
    return (
        df.where(F.col(cluster_col) != fv.NOISE)
        .groupBy(F.col(cluster_col).alias("cluster_id"), F.floor(F.col("doc_id") / span).alias("chunk"))
        .agg(F.array_join(F.transform(ordered, lambda r: r["body"]), " ").alias("document"))
    )


def clustering_metrics(
    df: DataFrame,
    silhouette_kmeans: float | None,
    silhouette_density: float | None,
    kmeans_col: str = "cluster_kmeans",
    density_col: str = "cluster_hdbscan",
    dims: int = fv.REDUCED_DIMS,
    k: int | None = None,
    reducer: str = "PCA",
) -> DataFrame:
    """The nested metrics record of one run, as a single row.

    ``k`` is the k that was chosen; without it the clusters that hold rows are
    counted. ``reducer`` names the reduction behind the density clustering.
    A silhouette that could not be computed (NaN) is reported as null. The two
    silhouettes live in different spaces, hence ``metrica_distancia`` and
    ``aviso``.
    """
    # One row per pair of cluster ids; counting distinct ids over the rows
    # themselves would multiply them.
    sizes = df.groupBy(kmeans_col, density_col).agg(F.count(F.lit(1)).alias("n"))
    clustered = F.col(density_col) != fv.NOISE
    base = sizes.agg(
        F.count_distinct(kmeans_col).alias("k"),
        F.count_distinct(F.when(clustered, F.col(density_col))).alias("n_found"),
        (F.sum(F.when(clustered, F.col("n")).otherwise(0)) / F.sum("n")).alias("density_coverage"),
    ).withColumns({
        "kmeans_purity": cluster_purity(df, kmeans_col).scalar(),
        "density_purity": cluster_purity(df, density_col).scalar(),
    })

    def reported(score: float | None):
        value = F.lit(score).cast("double")
        return F.when(~F.isnan(value), value)

    return base.select(
        F.struct(
            (F.col("k") if k is None else F.lit(k).cast("long")).alias("k_escolhido"),
            reported(silhouette_kmeans).alias("silhouette"),
            F.col("kmeans_purity").alias("pureza"),
            F.lit(1.0).cast("double").alias("cobertura"),
            F.lit(fv.METRIC_CENTROID).alias("metrica_distancia"),
        ).alias("kmeans"),
        F.struct(
            F.col("n_found").alias("n_clusters_descobertos"),
            reported(silhouette_density).alias("silhouette"),
            F.col("density_purity").alias("pureza"),
            F.col("density_coverage").alias("cobertura"),
            F.lit(fv.METRIC_DENSITY.format(reducer=reducer)).alias("metrica_distancia"),
            F.lit(dims).alias("umap_n_components"),
        ).alias("hdbscan"),
        F.lit(fv.METRICS_WARNING).alias("aviso"),
    )
