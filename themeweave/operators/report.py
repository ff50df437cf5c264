"""Queries behind a topic report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from .metrics import cluster_distribution

NOT_LABELLED = "not labelled"
NOISE_NAME = "Ruído (-1)"


def cluster_label_lookup(clusters: DataFrame, labels: DataFrame) -> DataFrame:
    """Every cluster with its label record; one without a label says so."""
    found = clusters.select("cluster_id").join(labels, "cluster_id", "left")
    return found.withColumn("nome_topico", F.coalesce("nome_topico", F.lit(NOT_LABELLED)))


def cluster_card(df: DataFrame, cluster_col: str, labels: DataFrame) -> DataFrame:
    """Size, display name, label and keyword line of every cluster."""
    sizes = cluster_distribution(df, cluster_col)
    cards = sizes.join(labels, "cluster_id", "left")
    shown = F.when(F.col("cluster_id") == fv.NOISE, F.lit(NOISE_NAME)).otherwise(
        F.concat(F.lit("Cluster "), F.col("cluster_id").cast("string"))
    )
    return cards.select(
        "cluster_id",
        shown.alias("display_name"),
        "n_docs",
        F.coalesce("nome_topico", F.lit(NOT_LABELLED)).alias("nome_topico"),
        F.coalesce(F.array_join("palavras_chave", ", "), F.lit("")).alias("keywords"),
        "resumo",
        "nivel_confianca",
        "possivel_ruido",
    )


def metrics_card(metrics: DataFrame) -> DataFrame:
    """The fields of the metrics record that a report shows, as display text where needed."""

    def or_na(path: str):
        return F.coalesce(F.format_string("%.3f", F.col(path)), F.lit("N/A"))

    # format_string prints "null" for a missing number, hence the test before it
    def shown(path: str):
        return F.when(F.col(path).isNull(), F.lit("N/A")).otherwise(or_na(path))

    return metrics.select(
        F.col("kmeans.k_escolhido").alias("k_chosen"),
        shown("kmeans.silhouette").alias("kmeans_silhouette"),
        F.round("kmeans.pureza", 6).alias("kmeans_purity"),
        F.col("hdbscan.n_clusters_descobertos").alias("n_found"),
        shown("hdbscan.silhouette").alias("density_silhouette"),
        F.round("hdbscan.cobertura", 6).alias("density_coverage"),
        F.coalesce("aviso", F.lit(fv.METRICS_WARNING)).alias("warning"),
    )
