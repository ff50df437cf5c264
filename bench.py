"""Headline queries on local[$BENCH_CPUS]; prints one JSON line.

The tables are first written into ``FILES`` files each, outside the timing. Each query
runs once to warm up and then three times; the median counts. Results
are fully computed and thrown away by the no-op sink. ``BENCH_ALL=1`` times every
registered query once instead of the headline ones three times.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from themeweave.plans.queries import QUERIES
from themeweave.session import local_session

HEADLINE = [
    "preprocess_corpus",
    "sample_exact_n",
    "dense_doc_id",
    "tokenize",
    "category_counts",
    "cluster_purity",
    "document_frequency",
    "ctfidf_top_terms",
    "embed_documents",
    "cluster_centroids",
    "nearest_centroid_assign",
    "nearest_to_centroid",
    "silhouette_cosine",
    "silhouette_euclidean",
    "kmeans_sweep",
    "reduce_dimensions",
    "knn_graph",
    "density_cluster",
    "density_cluster_auto",
    "render_prompts",
    "validate_labels",
    "label_clusters",
    "project_costs",
]


FILES = 16  # per table; the given ones are of one row group, which one task reads


def spread_tables(spark, sf_dir: str) -> str:
    """The tables the queries read, written once into many files, as a large table is."""
    out = tempfile.mkdtemp(prefix="bench-")
    for name in ("documents", "embeddings", "conversations"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(FILES).write.parquet(f"{out}/{name}.parquet")
    for table in os.listdir(sf_dir):
        if not os.path.exists(f"{out}/{table}"):
            os.symlink(f"{sf_dir}/{table}", f"{out}/{table}")
    return out


def timed(name: str, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    every = os.environ.get("BENCH_ALL") == "1"
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    given, sf_dir = sf_dir, spread_tables(spark, sf_dir)
    seconds = {}
    for name in QUERIES if every else HEADLINE:
        timed(name, spark, sf_dir)
        seconds[name] = round(statistics.median(timed(name, spark, sf_dir) for _ in range(1 if every else 3)), 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "topic_mining_total", "value": total, "unit": "sec", "queries": seconds, "sf": given.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
