"""The whole run: sample, clean, embed, cluster, score, label, project costs.

Every stage is written under one output folder and the next stage reads the
files, so a run can be resumed by hand from any of them and nothing is computed
twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import fixed_values as fv
from ..functions.templates import DEFAULT_TEMPLATE
from ..operators import centroids, costs, density, embedding, kmeans, labeling, metrics, sampling, selection, silhouette
from ..sources import readers, writers


@dataclass
class Options:
    n_sample: int = fv.SAMPLE_SIZE
    start: str = fv.PERIOD_START
    end: str = fv.PERIOD_END
    seed: int = fv.SAMPLE_SEED
    k_min: int = fv.K_MIN
    k_max: int = fv.K_MAX
    n_init: int = fv.N_INIT
    dims: int = fv.REDUCED_DIMS
    min_cluster_size: int = fv.MIN_CLUSTER_SIZE
    label_column: str = "cluster_kmeans"
    nearest_examples: bool = False  # example rows nearest the centroid instead of the first ones
    template: str = DEFAULT_TEMPLATE
    concurrency: int | None = None
    lenient: bool = False  # take numbers and booleans written as text, as a forgiving reader would


def prepare(corpus: DataFrame, out: str, options: Options) -> DataFrame:
    """Sample the period and clean it: ``raw`` and ``clean``."""
    spark = corpus.sparkSession
    sample = sampling.draw_sample(corpus, options.n_sample, options.start, options.end, options.seed)
    writers.sink_table(sample, f"{out}/raw")
    raw = readers.scan_corpus(spark, f"{out}/raw")
    writers.sink_table(selection.preprocess_corpus(raw), f"{out}/clean")
    return readers.scan_corpus(spark, f"{out}/clean")


def vectorize(clean: DataFrame, out: str, load_encoder: Callable | None = None) -> DataFrame:
    """``vectors`` of the cleaned documents."""
    writers.sink_vectors(embedding.embed_documents(clean, load_encoder), f"{out}/vectors")
    return readers.scan_vectors(clean.sparkSession, f"{out}/vectors")


def cluster(clean: DataFrame, vectors: DataFrame, out: str, options: Options) -> DataFrame:
    """Both clusterings with their metrics: ``reduced``, ``clustered`` and ``metrics``."""
    spark = clean.sparkSession
    sweep = kmeans.kmeans_sweep(vectors, options.k_min, options.k_max, options.n_init, options.seed)
    writers.sink_vectors(embedding.reduce_dimensions(vectors, options.dims), f"{out}/reduced")
    reduced = readers.scan_vectors(spark, f"{out}/reduced")
    dense = density.density_cluster_auto(reduced, options.min_cluster_size)
    assigned = selection.attach_assignments(selection.attach_assignments(clean, sweep.labels), dense)
    writers.sink_table(assigned, f"{out}/clustered")
    clustered = spark.read.parquet(f"{out}/clustered")
    placed = reduced.join(clustered.select("doc_id", "cluster_hdbscan"), "doc_id")
    density_score = silhouette.silhouette_euclidean(placed, "cluster_hdbscan").first()["silhouette"]
    record = metrics.clustering_metrics(clustered, sweep.score, density_score, dims=options.dims, k=sweep.k)
    writers.sink_json_document(record, f"{out}/metrics")
    return clustered


def label(clustered: DataFrame, vectors: DataFrame, out: str, make_client: Callable, options: Options) -> DataFrame:
    """``responses``, ``labels``, ``dead_letters``, ``usage`` and ``costs``."""
    spark = clustered.sparkSession
    chosen = None
    if options.nearest_examples:
        placed = vectors.join(clustered.select("doc_id", options.label_column), "doc_id")
        chosen = centroids.nearest_to_centroid(placed, options.label_column, fv.EXAMPLES_PER_CLUSTER)
    labels, dead, responses = labeling.label_clusters(
        clustered, options.label_column, make_client, f"{out}/responses", options.template, chosen=chosen,
        lenient=options.lenient, concurrency=options.concurrency,
    )
    writers.sink_table(labels, f"{out}/labels")
    writers.sink_dead_letters(dead, f"{out}/dead_letters", run="labels")
    writers.sink_json_document(costs.usage_means(costs.usage_totals(responses)), f"{out}/usage")
    usage = readers.optional_source(spark, f"{out}/usage", schemas.USAGE_REPORT, "json")
    prices = costs.price_dimension(spark)
    writers.sink_json_document(costs.cost_document(costs.means_or_default(usage), prices), f"{out}/costs")
    return readers.scan_corpus(spark, f"{out}/labels").orderBy(F.col("cluster_id"))


def run(corpus: DataFrame, out: str, make_client: Callable, load_encoder: Callable | None = None, options: Options | None = None) -> DataFrame:
    """All stages; returns the labels. ``out`` is a folder all executors can reach."""
    options = options or Options()
    clean = prepare(corpus, out, options)
    vectors = vectorize(clean, out, load_encoder)
    clustered = cluster(clean, vectors, out, options)
    return label(clustered, vectors, out, make_client, options)
