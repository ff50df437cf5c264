"""Every operator as a query over the driver's tables: ``fn(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import json
from functools import wraps

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import fixed_values as fv
from ..functions import text as tx
from ..functions import vectors as vx
from ..functions.templates import DEFAULT_TEMPLATE
from ..operators import (
    centroids,
    costs,
    density,
    embedding,
    kmeans,
    labeling,
    metrics,
    neighbors,
    neighbors_large,
    report,
    sampling,
    selection,
    silhouette,
    terms,
)
from ..session import materialize, scratch_path, ship_package
from ..sources import readers, writers
from . import fixtures as fx

SAMPLE = 50  # rows; the smallest test corpus has 99 in its period
KNN = 5
DENSITY = {"min_samples": 3, "min_cluster_size": 3}
EPS = 1.15
AUTO = {"min_samples": 4, "min_cluster_size": 8}
BLOCK = 64  # rows of a block, so that small tables are worked on in many blocks, too
QUERIES: dict = {}


def query(fn):
    @wraps(fn)
    def ready(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = ready
    return ready


def r6(col):
    """Rounded to 6 places, without negative zero."""
    col = F.col(col) if isinstance(col, str) else col
    return F.round(col.cast("double"), 6) + F.lit(0.0).cast("double")


def _clean_clustered(spark, sf_dir):
    return selection.preprocess_corpus(fx.clustered(spark, sf_dir))


def _term_counts(spark, sf_dir):
    return terms.count_terms(_clean_clustered(spark, sf_dir), "cluster_hdbscan")


# --- sources and sinks --------------------------------------------------------


@query
def scan_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.scan_corpus(spark, f"{sf_dir}/documents.parquet", ["doc_id", "text", "lang", "source"])


@query
def scan_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    writers.sink_table(fx.corpus(spark, sf_dir), path, fmt="csv")
    return readers.scan_csv(spark, path, schemas.RAW_CORPUS)


@query
def scan_vectors(spark, sf_dir):
    path = scratch_path(spark, "vectors")
    writers.sink_vectors(fx.vectors(spark, sf_dir), path)
    rows = readers.scan_vectors(spark, path)
    return rows.select("doc_id", F.size("embedding").alias("dims"), r6(vx.squared_norm(F.col("embedding"))).alias("norm2"))


@query
def scan_json_document(spark, sf_dir):
    path = scratch_path(spark, "usage-json")
    totals = costs.usage_means(costs.usage_totals(fx.usage(spark, sf_dir)))
    writers.sink_json_document(totals, path)
    back = readers.scan_json_document(spark, path, schemas.USAGE_REPORT)
    return back.select(
        "tokens_entrada", "tokens_saida", "chamadas",
        r6("media_tokens_entrada_por_chamada").alias("mean_in"), r6("media_tokens_saida_por_chamada").alias("mean_out"),
    )


@query
def scan_template(spark, sf_dir):
    path = scratch_path(spark, "template")
    # The text sink ends every row with a newline of its own.
    spark.createDataFrame([(DEFAULT_TEMPLATE.removesuffix("\n"),)], "value string").coalesce(1).write.text(path)
    template = readers.scan_template(spark, path).first()["template"]
    sizes = metrics.cluster_distribution(fx.vectors(spark, sf_dir), "label")
    filled = labeling.render_template(template, {
        "cluster_id": F.col("cluster_id").cast("string"),
        "palavras_chave": F.lit(""),
        "exemplos": F.col("n_docs").cast("string"),
    })
    return sizes.select(F.col("cluster_id").cast("int").alias("cluster_id"), filled.alias("filled"))


@query
def optional_source(spark, sf_dir):
    """A usage report that was never written: the projection falls back to the defaults."""
    absent = readers.optional_source(spark, scratch_path(spark, "absent"), schemas.USAGE_REPORT)
    calls = fx.usage(spark, sf_dir).agg(F.count(F.lit(1)).alias("calls"))
    means = costs.means_or_default(absent)
    return calls.select(
        "calls", means.select("mean_in").scalar().alias("mean_in"), means.select("mean_out").scalar().alias("mean_out")
    )


@query
def sink_table(spark, sf_dir):
    path = scratch_path(spark, "table")
    writers.sink_corpus_by_year(selection.preprocess_corpus(fx.corpus(spark, sf_dir)), path)
    return spark.read.schema(T.StructType([*schemas.CLEAN_CORPUS, T.StructField("year", T.IntegerType())])).parquet(path)


@query
def sink_vectors(spark, sf_dir):
    path = scratch_path(spark, "vectors")
    writers.sink_vectors(fx.vectors(spark, sf_dir), path)
    rows = readers.scan_vectors(spark, path)
    return rows.select("doc_id", F.size("embedding").alias("dims"), r6(vx.squared_norm(F.col("embedding"))).alias("norm2"))


@query
def sink_json_document(spark, sf_dir):
    path = scratch_path(spark, "metrics-json")
    record = metrics.clustering_metrics(fx.clustered(spark, sf_dir), None, None)
    writers.sink_json_document(record, path)
    back = readers.scan_json_document(spark, path, schemas.METRICS)
    return back.select(
        F.col("kmeans.k_escolhido").alias("k"), r6("kmeans.pureza").alias("kmeans_purity"),
        r6("hdbscan.pureza").alias("density_purity"), r6("hdbscan.cobertura").alias("density_coverage"),
        "hdbscan.umap_n_components", "aviso",
    )


@query
def sink_dead_letters(spark, sf_dir):
    path = scratch_path(spark, "dead-letters")
    bad = labeling.quarantine_labels(labeling.validate_labels(labeling.parse_labels(fx.responses(spark, sf_dir))))
    writers.sink_dead_letters(bad.where("cluster_id % 2 = 0"), path)
    writers.sink_dead_letters(bad.where("cluster_id % 2 <> 0"), path)
    return spark.read.schema(schemas.DEAD_LETTER).parquet(path).select("cluster_id", "resposta_crua", "erro")


# --- projections, filters, predicates ----------------------------------------


@query
def parse_iso_date(spark, sf_dir):
    hour = F.lpad((F.col("doc_id") % 24).cast("string"), 2, "0")
    raw = F.concat(F.col("date").cast("string"), F.lit("T"), hour, F.lit(":15:30"))
    parsed = selection.parse_iso_date(raw)
    return fx.corpus(spark, sf_dir).select(
        "doc_id", parsed.cast("date").alias("day"), F.hour(parsed).alias("hour"), F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("stamp")
    )


@query
def filter_period(spark, sf_dir):
    return selection.filter_period(fx.corpus(spark, sf_dir)).select("doc_id", "date", "category")


@query
def project_columns(spark, sf_dir):
    return selection.project_columns(fx.corpus(spark, sf_dir), ["doc_id", "title", "category", "date"])


@query
def null_to_empty(spark, sf_dir):
    return fx.corpus(spark, sf_dir).select(
        "doc_id", tx.null_to_empty(F.col("title")).alias("title"), F.length(tx.null_to_empty(F.col("text"))).cast("long").alias("text_chars")
    )


@query
def build_model_text(spark, sf_dir):
    return selection.clean_corpus(fx.corpus(spark, sf_dir)).select("doc_id", "texto_modelo")


@query
def filter_min_length(spark, sf_dir):
    kept = selection.filter_min_length(selection.clean_corpus(fx.corpus(spark, sf_dir)))
    return kept.select("doc_id", F.char_length("texto_modelo").cast("long").alias("chars"))


@query
def drop_noise(spark, sf_dir):
    return selection.drop_noise(fx.clustered(spark, sf_dir), "cluster_hdbscan").select("doc_id", "cluster_hdbscan")


@query
def dense_doc_id(spark, sf_dir):
    rows = selection.filter_period(fx.corpus(spark, sf_dir)).select("doc_id")
    return sampling.dense_doc_id(rows, out="dense_id").select("doc_id", F.col("dense_id").cast("long").alias("dense_id"))


@query
def attach_assignments(spark, sf_dir):
    labels = fx.clustered(spark, sf_dir).select("doc_id", "cluster_kmeans", "cluster_hdbscan")
    return selection.attach_assignments(fx.corpus(spark, sf_dir), labels).select(
        "doc_id", "category", "cluster_kmeans", "cluster_hdbscan"
    )


@query
def filter_cluster(spark, sf_dir):
    return selection.filter_cluster(fx.clustered(spark, sf_dir), "cluster_kmeans", 3).select("doc_id", "category", "date")


@query
def excerpt(spark, sf_dir):
    return fx.corpus(spark, sf_dir).select("doc_id", tx.excerpt(F.col("text")).alias("excerpt"))


# --- text ---------------------------------------------------------------------


@query
def strip_urls(spark, sf_dir):
    return fx.corpus(spark, sf_dir).select("doc_id", tx.strip_urls(F.col("text")).alias("text"))


@query
def strip_tags(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", tx.strip_tags(F.col("html")).alias("text"))


@query
def normalize_whitespace(spark, sf_dir):
    return fx.corpus(spark, sf_dir).select("doc_id", tx.normalize_whitespace(F.col("text")).alias("text"))


@query
def clean_text(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", tx.clean_text(F.col("html")).alias("text"))


@query
def preprocess_corpus(spark, sf_dir):
    return selection.preprocess_corpus(fx.corpus(spark, sf_dir))


@query
def tokenize(spark, sf_dir):
    tokens = selection.preprocess_corpus(fx.corpus(spark, sf_dir)).select("doc_id", tx.tokenize(F.col("texto_modelo")).alias("t"))
    return tokens.select(
        "doc_id", F.size("t").cast("long").alias("n_tokens"), F.md5(F.array_join("t", " ").cast("binary")).alias("tokens_md5")
    )


@query
def remove_stopwords(spark, sf_dir):
    tokens = selection.preprocess_corpus(fx.corpus(spark, sf_dir)).select(
        "doc_id", tx.remove_stopwords(tx.tokenize(F.col("texto_modelo"))).alias("t")
    )
    return tokens.select("doc_id", F.size("t").cast("long").alias("n_kept"), F.md5(F.array_join("t", " ").cast("binary")).alias("tokens_md5"))


@query
def join_keywords(spark, sf_dir):
    lines = labeling.keyword_lines(terms.ctfidf_top_terms(_clean_clustered(spark, sf_dir), "cluster_kmeans"))
    return lines.select(F.col("cluster_id").cast("int").alias("cluster_id"), "palavras_chave")


@query
def parse_keyword_list(spark, sf_dir):
    """List literals as an older text export has them: [lang, source] in single quotes."""
    literal = F.concat(F.lit("['"), F.col("lang"), F.lit("', \"d'"), F.col("source"), F.lit("\"]"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", literal.alias("l"))
    items = docs.select("doc_id", tx.parse_keyword_list(F.col("l")).alias("items"))
    return items.select("doc_id", F.size("items").alias("n"), F.array_join("items", "|").alias("joined"))


# --- sampling, sorting, limits ------------------------------------------------


@query
def sample_exact_n(spark, sf_dir):
    sample = sampling.sample_exact_n(selection.filter_period(fx.corpus(spark, sf_dir)), SAMPLE)
    return sample.select("doc_id", "title", "date", "category")


@query
def require_min_rows(spark, sf_dir):
    return sampling.docs_per_year(sampling.require_min_rows(fx.corpus(spark, sf_dir), SAMPLE))


@query
def first_n_per_cluster(spark, sf_dir):
    rows = fx.clustered(spark, sf_dir).select("doc_id", "cluster_kmeans", "title")
    return sampling.first_n_per_cluster(rows, "cluster_kmeans")


@query
def nearest_to_centroid(spark, sf_dir):
    found = centroids.nearest_to_centroid(fx.vectors(spark, sf_dir), "label")
    return found.select("cluster_id", "doc_id", "rk", r6("distance").alias("distance"))


@query
def top_terms(spark, sf_dir):
    counts = _term_counts(spark, sf_dir)
    scored = terms.ctfidf_scores(counts, terms.cluster_term_counts(counts))
    return terms.top_terms(scored, 5).select("cluster_id", "rank", "term", r6("score").alias("score"))


@query
def select_best_k(spark, sf_dir):
    """Scores read from the vectors: mean of each component, one candidate k per component."""
    scores = fx.vectors(spark, sf_dir).select(F.posexplode("embedding")).groupBy((F.col("pos") + 4).alias("k")).agg(
        F.round(F.avg(F.col("col").cast("double")), 3).alias("silhouette")
    )
    return sampling.select_best_k(scores).select("k", r6("silhouette").alias("silhouette"))


@query
def cluster_sample(spark, sf_dir):
    return sampling.cluster_sample(fx.clustered(spark, sf_dir), "cluster_kmeans", 3)


@query
def sorted_clusters(spark, sf_dir):
    return sampling.sorted_clusters(fx.clustered(spark, sf_dir), "cluster_hdbscan")


# --- aggregations -------------------------------------------------------------


@query
def docs_per_year(spark, sf_dir):
    return sampling.docs_per_year(fx.corpus(spark, sf_dir))


@query
def category_counts(spark, sf_dir):
    return metrics.category_counts(fx.corpus(spark, sf_dir))


@query
def cluster_distribution(spark, sf_dir):
    return metrics.cluster_distribution(fx.clustered(spark, sf_dir), "cluster_hdbscan")


@query
def stage_counts(spark, sf_dir):
    return selection.stage_counts(fx.corpus(spark, sf_dir))


@query
def majority_category(spark, sf_dir):
    return metrics.majority_category(fx.clustered(spark, sf_dir), "cluster_hdbscan")


@query
def cluster_purity(spark, sf_dir):
    return metrics.cluster_purity(fx.clustered(spark, sf_dir), "cluster_hdbscan").select(r6("purity").alias("purity"))


@query
def coverage(spark, sf_dir):
    return metrics.coverage(fx.clustered(spark, sf_dir), "cluster_hdbscan").select(r6("coverage").alias("coverage"))


@query
def n_clusters(spark, sf_dir):
    return metrics.n_clusters(fx.clustered(spark, sf_dir), "cluster_hdbscan")


@query
def cluster_documents(spark, sf_dir):
    docs = metrics.cluster_documents(_clean_clustered(spark, sf_dir), "cluster_kmeans")
    return docs.select("cluster_id", "chunk", F.length("document").cast("long").alias("chars"), F.md5(F.col("document").cast("binary")).alias("document_md5"))


@query
def usage_totals(spark, sf_dir):
    return costs.usage_totals(fx.usage(spark, sf_dir))


@query
def usage_means(spark, sf_dir):
    means = costs.usage_means(costs.usage_totals(fx.usage(spark, sf_dir)))
    return means.select(
        "tokens_entrada", "tokens_saida", "chamadas",
        r6("media_tokens_entrada_por_chamada").alias("mean_in"), r6("media_tokens_saida_por_chamada").alias("mean_out"),
    )


def _scored_metrics(spark, sf_dir):
    rows = fx.clustered(spark, sf_dir)
    placed = rows.select("doc_id", "cluster_kmeans", "cluster_hdbscan").join(fx.vectors(spark, sf_dir).select("doc_id", "embedding"), "doc_id")
    placed = materialize(placed, "placed")
    cosine = silhouette.silhouette_cosine(placed, "cluster_kmeans")
    euclidean = silhouette.silhouette_euclidean(placed, "cluster_hdbscan").first()["silhouette"]
    return metrics.clustering_metrics(rows, cosine, euclidean)


@query
def clustering_metrics(spark, sf_dir):
    return _scored_metrics(spark, sf_dir).select(
        F.col("kmeans.k_escolhido").alias("k"), r6("kmeans.silhouette").alias("kmeans_silhouette"),
        r6("kmeans.pureza").alias("kmeans_purity"), r6("kmeans.cobertura").alias("kmeans_coverage"),
        F.col("hdbscan.n_clusters_descobertos").alias("n_found"), r6("hdbscan.silhouette").alias("density_silhouette"),
        r6("hdbscan.pureza").alias("density_purity"), r6("hdbscan.cobertura").alias("density_coverage"),
        F.col("kmeans.metrica_distancia").alias("kmeans_metric"), F.col("hdbscan.metrica_distancia").alias("density_metric"),
        F.col("hdbscan.umap_n_components").alias("dims"), "aviso",
    )


# --- distinctive terms --------------------------------------------------------


@query
def document_frequency(spark, sf_dir):
    return terms.document_frequency(_term_counts(spark, sf_dir))


@query
def cluster_term_counts(spark, sf_dir):
    return terms.cluster_term_counts(_term_counts(spark, sf_dir)).select("cluster_id", "term", "tf")


@query
def term_totals(spark, sf_dir):
    return terms.term_totals(terms.cluster_term_counts(_term_counts(spark, sf_dir)))


@query
def mean_cluster_words(spark, sf_dir):
    counts = _term_counts(spark, sf_dir)
    mean = terms.mean_cluster_words(counts, terms.cluster_term_counts(counts))
    return mean.select(r6("mean_words").alias("mean_words"))


@query
def ctfidf_scores(spark, sf_dir):
    counts = _term_counts(spark, sf_dir)
    scored = terms.ctfidf_scores(counts, terms.cluster_term_counts(counts))
    return scored.select("cluster_id", "term", "tf", "total", r6("score").alias("score"))


@query
def ctfidf_top_terms(spark, sf_dir):
    top = terms.ctfidf_top_terms(_clean_clustered(spark, sf_dir), "cluster_hdbscan")
    return top.select("cluster_id", "rank", "term", r6("score").alias("score"))


# --- vectors and clustering ---------------------------------------------------


@query
def embed_documents(spark, sf_dir):
    return embedding.embed_documents(selection.preprocess_corpus(fx.corpus(spark, sf_dir)))


LETTERS = "abcdefghijklmnopqrstuvwxyz"


def letter_encoder():
    """A stand-in for a model: how often each letter occurs in a text."""
    return lambda texts: np.array([[text.count(letter) for letter in LETTERS] for text in texts], dtype=np.float64)


@query
def embed_documents_encoder(spark, sf_dir):
    """The plug-in encoder path, with vectors that SQL can count as well."""
    rows = selection.preprocess_corpus(fx.corpus(spark, sf_dir))
    vectors = embedding.embed_documents(rows, letter_encoder)
    return vectors.select("doc_id", F.size("embedding").alias("dims"), F.posexplode("embedding").alias("pos", "x")).select("doc_id", "dims", "pos", r6("x").alias("x"))


@query
def l2_normalize(spark, sf_dir):
    unit = fx.vectors(spark, sf_dir).select("doc_id", F.posexplode(vx.l2_normalize(F.col("embedding"))).alias("pos", "x"))
    return unit.select("doc_id", "pos", r6("x").alias("x"))


@query
def cosine_similarity(spark, sf_dir):
    rows = fx.vectors(spark, sf_dir)
    centres = centroids.cluster_centroids(rows, "label").select("cluster_id", "centroid")
    members = rows.select(F.col("label").alias("cluster_id"), "doc_id", "embedding")
    joined = centroids.with_own_centroid(members, centres).withColumnRenamed("cluster_id", "label")
    return joined.select(
        "doc_id", "label", r6(vx.cosine_similarity(F.col("embedding"), F.col("centroid"))).alias("cosine")
    )


@query
def cluster_centroids(spark, sf_dir):
    means = centroids.cluster_centroids(fx.vectors(spark, sf_dir), "label")
    return means.select("cluster_id", "n_docs", F.posexplode("centroid").alias("pos", "x")).select("cluster_id", "n_docs", "pos", r6("x").alias("x"))


@query
def nearest_centroid_assign(spark, sf_dir):
    rows = fx.vectors(spark, sf_dir)
    placed = centroids.nearest_centroid_assign(rows, centroids.cluster_centroids(rows, "label"))
    return placed.select("doc_id", "label", "nearest", r6("distance").alias("distance"))


@query
def kmeans_sweep(spark, sf_dir):
    sweep = kmeans.kmeans_sweep(fx.vectors(spark, sf_dir))
    return sweep.labels.withColumns({"k": F.lit(sweep.k), "silhouette": r6(F.lit(sweep.score))})


@query
def silhouette_cosine(spark, sf_dir):
    rows = fx.vectors(spark, sf_dir)
    score = silhouette.silhouette_cosine(rows, "label")
    return rows.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", r6(F.lit(score)).alias("silhouette"))


@query
def silhouette_euclidean(spark, sf_dir):
    rows = fx.vectors(spark, sf_dir).withColumn("label", F.when(F.col("label") == 9, -1).otherwise(F.col("label")))
    return silhouette.silhouette_euclidean(rows, "label", block_rows=BLOCK).select(r6("silhouette").alias("silhouette"))


@query
def silhouette_sample(spark, sf_dir):
    """A fifth of each cluster's rows measured against all rows."""
    rows = fx.vectors(spark, sf_dir).withColumn("label", F.when(F.col("label") == 9, -1).otherwise(F.col("label")))
    score = silhouette.silhouette_euclidean(rows, "label", block_rows=BLOCK, sample_fraction=0.2)
    return score.select(r6("silhouette").alias("silhouette"), r6("standard_error").alias("standard_error"), "asked")


@query
def reduce_dimensions(spark, sf_dir):
    return embedding.reduce_dimensions(fx.vectors(spark, sf_dir))


@query
def knn_graph(spark, sf_dir):
    graph = neighbors.knn_graph(fx.vectors(spark, sf_dir), KNN, block_rows=BLOCK)
    return graph.select("doc_id", "neighbor_id", "rank", r6("distance").alias("distance"))


@query
def knn_graph_large(spark, sf_dir):
    """Nearly exact lists of all rows, at a cost that grows with the rows."""
    graph = neighbors_large.knn_graph_large(fx.vectors(spark, sf_dir), 10, block_rows=256)
    return graph.select("doc_id", "neighbor_id", "rank", r6("distance").alias("distance"))


@query
def core_distance(spark, sf_dir):
    core = neighbors.core_distance(fx.vectors(spark, sf_dir), KNN, block_rows=BLOCK)
    return core.select("doc_id", r6("core_distance").alias("core_distance"))


@query
def density_cluster(spark, sf_dir):
    return density.density_cluster(fx.vectors(spark, sf_dir), EPS, **DENSITY, block_rows=BLOCK)


@query
def density_cluster_auto(spark, sf_dir):
    return density.density_cluster_auto(fx.vectors(spark, sf_dir), **AUTO, block_rows=256)


# --- labels -------------------------------------------------------------------


def echo_client():
    """A stand-in for a model: answers with the first three keywords of the prompt."""

    def ask(cluster_id: int, prompt: str) -> tuple[str, int, int]:
        words = prompt.split("\npalavras_chave: ")[1].split("\n")[0].split(", ")[:3]
        raw = json.dumps(
            {
                "cluster_id": cluster_id,
                "nome_topico": f"Tema do grupo {cluster_id}",
                "palavras_chave": words,
                "resumo": "Resposta de teste.",
                "nivel_confianca": 0.75,
            },
            ensure_ascii=False,
        )
        return raw, prompt.count(" ") + 1, raw.count(" ") + 1

    return ask


def _prompts(spark, sf_dir):
    df = _clean_clustered(spark, sf_dir)
    keywords = labeling.keyword_lines(terms.ctfidf_top_terms(df, "cluster_kmeans"))
    return labeling.render_prompts(keywords, labeling.example_blocks(df, "cluster_kmeans"))


@query
def example_blocks(spark, sf_dir):
    blocks = labeling.example_blocks(_clean_clustered(spark, sf_dir), "cluster_kmeans")
    return blocks.select(F.col("cluster_id").cast("int").alias("cluster_id"), "exemplos")


@query
def render_prompts(spark, sf_dir):
    return _prompts(spark, sf_dir)


@query
def infer_batches(spark, sf_dir):
    return labeling.infer_batches(_prompts(spark, sf_dir), echo_client).select(
        "cluster_id", "attempts", "tokens_in", "tokens_out"
    )


@query
def parse_labels(spark, sf_dir):
    parsed = labeling.parse_labels(fx.responses(spark, sf_dir))
    return parsed.select(
        "cluster_id", "parsed", "label_id", "nome_topico", F.array_join("palavras_chave", "|").alias("keywords"),
        "resumo", r6("nivel_confianca").alias("nivel_confianca"), "possivel_ruido",
    )


@query
def validate_labels(spark, sf_dir):
    checked = labeling.validate_labels(labeling.parse_labels(fx.responses(spark, sf_dir)))
    return checked.select("cluster_id", "nome_topico", F.array_join("reasons", ", ").alias("reasons"))


@query
def quarantine_labels(spark, sf_dir):
    checked = labeling.validate_labels(labeling.parse_labels(fx.responses(spark, sf_dir)))
    return labeling.quarantine_labels(checked).select("cluster_id", "resposta_crua", "erro")


@query
def explode_label_batch(spark, sf_dir):
    items = labeling.explode_label_batch(fx.batches(spark, sf_dir))
    parsed = labeling.parse_labels(items)
    return parsed.select("batch_id", "pos", "label_id", "nome_topico", F.array_join("palavras_chave", "|").alias("keywords"))


@query
def label_clusters(spark, sf_dir):
    labels, _, _ = labeling.label_clusters(
        _clean_clustered(spark, sf_dir), "cluster_kmeans", echo_client, scratch_path(spark, "responses")
    )
    return labels.select(
        "cluster_id", "nome_topico", F.array_join("palavras_chave", ", ").alias("keywords"), "resumo",
        r6("nivel_confianca").alias("nivel_confianca"), "possivel_ruido",
    )


# --- costs --------------------------------------------------------------------


def _means(spark, sf_dir):
    return costs.means_or_default(costs.usage_means(costs.usage_totals(fx.usage(spark, sf_dir))))


@query
def price_dimension(spark, sf_dir):
    spent = costs.price_calls(fx.usage(spark, sf_dir), costs.price_dimension(spark))
    return spent.select("model", "price_in", "price_out", r6("spent_usd").alias("spent_usd"))


@query
def project_costs(spark, sf_dir):
    return costs.project_costs(_means(spark, sf_dir), costs.price_dimension(spark))


@query
def cost_report(spark, sf_dir):
    rows = costs.cost_report(_means(spark, sf_dir), costs.price_dimension(spark))
    return rows.withColumns({c: r6(c) for c in ("tokens_entrada_por_chamada", "tokens_saida_por_chamada")})


# --- report -------------------------------------------------------------------


def _labels(spark, sf_dir):
    return labeling.valid_labels(labeling.validate_labels(labeling.parse_labels(fx.responses(spark, sf_dir))))


@query
def cluster_label_lookup(spark, sf_dir):
    clusters = sampling.sorted_clusters(fx.clustered(spark, sf_dir), "cluster_kmeans")
    found = report.cluster_label_lookup(clusters, _labels(spark, sf_dir))
    return found.select("cluster_id", "nome_topico", "resumo", r6("nivel_confianca").alias("nivel_confianca"), "possivel_ruido")


@query
def cluster_card(spark, sf_dir):
    cards = report.cluster_card(fx.clustered(spark, sf_dir), "cluster_hdbscan", _labels(spark, sf_dir))
    return cards.withColumn("nivel_confianca", r6("nivel_confianca"))


@query
def metrics_card(spark, sf_dir):
    return report.metrics_card(_scored_metrics(spark, sf_dir))
