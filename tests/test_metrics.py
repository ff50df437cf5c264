import pytest
from pyspark.sql import functions as F

from themeweave.operators import metrics

SCHEMA = "doc_id long, category string, cluster_kmeans int, cluster_hdbscan int"


def frame(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)


def test_purity_by_hand(spark):
    df = frame(spark, [("a", 0, 0), ("a", 0, 0), ("b", 0, 0), ("b", 1, 1), (None, 1, 1), ("c", 1, -1)])
    assert metrics.cluster_purity(df, "cluster_hdbscan").first()[0] == pytest.approx(3 / 5)
    assert metrics.cluster_purity(df, "cluster_kmeans").first()[0] == pytest.approx(3 / 6)


def test_majority_ties_go_to_the_first_name(spark):
    df = frame(spark, [("b", 0, 0), ("a", 0, 0)])
    row = metrics.majority_category(df, "cluster_kmeans").first()
    assert (row["majority_category"], row["majority_count"], row["cluster_rows"]) == ("a", 1, 2)


def test_cluster_without_categories_counts_zero(spark):
    df = frame(spark, [(None, 0, 0), (None, 0, 0), ("a", 1, 1)])
    assert metrics.cluster_purity(df, "cluster_kmeans").first()[0] == pytest.approx(1 / 3)


def test_all_noise(spark):
    df = frame(spark, [("a", 0, -1), ("b", 0, -1)])
    assert metrics.cluster_purity(df, "cluster_hdbscan").first()[0] == 0.0
    assert metrics.coverage(df, "cluster_hdbscan").first()[0] == 0.0
    assert metrics.n_clusters(df, "cluster_hdbscan").first()[0] == 0


def test_empty_input(spark):
    df = frame(spark, [])
    assert metrics.cluster_purity(df, "cluster_kmeans").first()[0] == 0.0
    assert metrics.coverage(df, "cluster_kmeans").first()[0] is None
    assert metrics.category_counts(df).count() == 0
    assert metrics.cluster_distribution(df, "cluster_kmeans").count() == 0


def test_metrics_record_turns_nan_into_null(spark):
    df = frame(spark, [("a", 0, 0), ("b", 1, -1)])
    row = metrics.clustering_metrics(df, 0.25, float("nan")).first()
    assert row["kmeans"]["silhouette"] == 0.25 and row["kmeans"]["k_escolhido"] == 2
    assert row["hdbscan"]["silhouette"] is None and row["hdbscan"]["cobertura"] == 0.5
    assert row["hdbscan"]["umap_n_components"] == 15 and "comparaveis" in row["aviso"]


def test_cluster_documents_keep_order_and_noise_out(spark):
    df = spark.createDataFrame([(2, "b", 0), (1, "a", 0), (600, "z", 0), (3, "n", -1)], "doc_id long, texto_modelo string, c int")
    rows = metrics.cluster_documents(df, "c").orderBy("chunk").collect()
    assert [(r["cluster_id"], r["chunk"], r["document"]) for r in rows] == [(0, 0, "a b"), (0, 2, "z")]
    assert rows[0]["document"] + " " + rows[1]["document"] == "a b z"


def test_counts_leave_nulls_out(spark):
    df = frame(spark, [("a", 0, 0), ("b", 0, 0), ("b", 0, 0), (None, 0, 0)])
    assert [tuple(r) for r in metrics.category_counts(df).collect()] == [("b", 2), ("a", 1)]
    assert df.where(F.col("category").isNull()).count() == 1
