"""Distinctive terms of each cluster by class-based TF-IDF.

``score = tf * ln(1 + A / (total + 1))`` with ``tf`` the raw count of the term
in the cluster, ``total`` its count over all clusters, and ``A`` the mean number
of vocabulary words per cluster.

Documents are read and tokenised once, by ``count_terms``. Each token occurrence
carries a flag telling if it is the first of its term in the document, and each
document adds one row without a term. One aggregation by (cluster, term) then
yields term counts, document counts and the number of documents together. Its
map side already folds the text to distinct terms, which is all that is
shuffled; everything after it works on that small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import text as tx
from ..session import materialize


def term_occurrences(df: DataFrame, cluster_col: str, text_col: str = "texto_modelo", language: str = "pt") -> DataFrame:
    """(cluster_id, term, first_in_doc): one row per token, and per document one with a null term."""
    tokens = df.where(F.col(cluster_col) != fv.NOISE).select(
        F.col(cluster_col).alias("cluster_id"), F.array_sort(tx.tokenize(F.col(text_col))).alias("tokens")
    )
    marked = F.transform(
        F.col("tokens"),
        lambda t, i: F.struct(
            t.alias("term"),
            F.when(i == 0, 1).when(t != F.get(F.col("tokens"), i - 1), 1).otherwise(0).alias("first_in_doc"),
        ),
    )
    document = F.array(F.struct(F.lit(None).cast("string").alias("term"), F.lit(1).alias("first_in_doc")))
    exploded = tokens.select("cluster_id", F.inline(F.concat(document, marked)))
    return exploded.where(F.col("term").isNull() | ~tx.is_stopword(F.col("term"), language))


def count_terms(df: DataFrame, cluster_col: str, text_col: str = "texto_modelo", language: str = "pt") -> DataFrame:
    """(cluster_id, term, tf, df_in_cluster), written out; a null term stands for the documents."""
    counts = (
        term_occurrences(df, cluster_col, text_col, language)
        .groupBy("cluster_id", "term")
        .agg(F.count(F.lit(1)).alias("tf"), F.sum("first_in_doc").alias("df_in_cluster"))
    )
    return materialize(counts, "term-counts")


def _documents(counts: DataFrame) -> DataFrame:
    """(cluster_id, n_docs)"""
    return counts.where(F.col("term").isNull()).select("cluster_id", F.col("tf").alias("n_docs"))


def _ceiling(counts: DataFrame, max_df: float):
    return F.lit(max_df).cast("double") * _documents(counts).agg(F.sum("n_docs")).scalar()


def document_frequency(counts: DataFrame, min_df: int = fv.MIN_DF, max_df: float = fv.MAX_DF) -> DataFrame:
    """The vocabulary: terms in at least ``min_df`` and at most ``max_df * n`` documents."""
    totals = counts.where(F.col("term").isNotNull()).groupBy("term").agg(F.sum("df_in_cluster").alias("doc_freq"))
    return totals.where((F.col("doc_freq") >= min_df) & (F.col("doc_freq") <= _ceiling(counts, max_df)))


def cluster_term_counts(counts: DataFrame, min_df: int = fv.MIN_DF, max_df: float = fv.MAX_DF) -> DataFrame:
    """(cluster_id, term, tf, total) for vocabulary terms.

    The window over ``term`` sees one row per cluster and spares joining the
    counts with aggregates of themselves.
    """
    by_term = Window.partitionBy("term")
    counted = counts.where(F.col("term").isNotNull()).select(
        "cluster_id",
        "term",
        "tf",
        F.sum("tf").over(by_term).alias("total"),
        F.sum("df_in_cluster").over(by_term).alias("doc_freq"),
    )
    in_vocabulary = (F.col("doc_freq") >= min_df) & (F.col("doc_freq") <= _ceiling(counts, max_df))
    return counted.where(in_vocabulary).drop("doc_freq")


def term_totals(vocabulary_counts: DataFrame) -> DataFrame:
    return vocabulary_counts.groupBy("term").agg(F.sum("tf").alias("total"))


def mean_cluster_words(counts: DataFrame, vocabulary_counts: DataFrame) -> DataFrame:
    """Mean over clusters of their vocabulary words.

    The number of clusters comes from the documents: a cluster without any
    vocabulary term still counts, as zero.
    """
    n_clusters = _documents(counts).agg(F.count(F.lit(1))).scalar()
    words = vocabulary_counts.agg(F.coalesce(F.sum("tf"), F.lit(0)).alias("words"))
    return words.select((F.col("words").cast("double") / n_clusters).alias("mean_words"))


def ctfidf_scores(counts: DataFrame, vocabulary_counts: DataFrame) -> DataFrame:
    """(cluster_id, term, tf, total, score)"""
    mean_words = mean_cluster_words(counts, vocabulary_counts).scalar()
    idf = F.log(F.lit(1.0).cast("double") + mean_words / (F.col("total") + 1))
    return vocabulary_counts.withColumn("score", F.col("tf") * idf)


def top_terms(scores: DataFrame, n: int = fv.TOP_TERMS) -> DataFrame:
    """The ``n`` best terms per cluster; equal scores in descending term order."""
    best_first = Window.partitionBy("cluster_id").orderBy(F.desc("score"), F.desc("term"))
    return scores.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= n)


def pad_zero_scores(scores: DataFrame, n: int = fv.TOP_TERMS, clusters: DataFrame | None = None) -> DataFrame:
    """Zero-score terms for clusters with fewer than ``n`` terms of their own.

    ``clusters`` (cluster_id) names those to fill, also ones without any term.

    Only the last ``2n`` vocabulary terms in name order can be needed: a short
    cluster owns fewer than ``n`` of them, which leaves enough to fill it.
    """
    vocabulary = scores.select("term").distinct().orderBy(F.desc("term")).limit(2 * n)
    owned = scores.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n_own"))
    if clusters is not None:
        owned = clusters.select("cluster_id").join(owned, "cluster_id", "left")
    short = owned.where(F.coalesce("n_own", F.lit(0)) < n)
    tail = vocabulary.agg(F.collect_list("term").alias("tail"))
    candidates = short.select("cluster_id", F.explode(tail.scalar()).alias("term"))
    missing = candidates.join(scores.select("cluster_id", "term"), ["cluster_id", "term"], "left_anti")
    zero = missing.select("cluster_id", "term", F.lit(0.0).cast("double").alias("score"))
    return scores.select("cluster_id", "term", "score").unionByName(zero)


def ctfidf_top_terms(
    df: DataFrame,
    cluster_col: str,
    text_col: str = "texto_modelo",
    n: int = fv.TOP_TERMS,
    min_df: int = fv.MIN_DF,
    max_df: float = fv.MAX_DF,
    language: str = "pt",
    pad_zero: bool = False,
) -> DataFrame:
    """(cluster_id, rank, term, score), noise left out.

    Raises ``ValueError`` if no term can pass both document-frequency bounds.
    """
    counts = count_terms(df, cluster_col, text_col, language)
    n_docs = _documents(counts).agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0]
    if max_df * n_docs < min_df:
        raise ValueError(f"{n_docs} documents are too few for min_df={min_df} and max_df={max_df}")
    vocabulary_counts = cluster_term_counts(counts, min_df, max_df)
    if vocabulary_counts.isEmpty():
        raise ValueError(f"no term lies between min_df={min_df} and max_df={max_df}")
    scores = ctfidf_scores(counts, vocabulary_counts)
    if pad_zero:
        scores = pad_zero_scores(scores, n, _documents(counts))
    return top_terms(scores, n).select("cluster_id", "rank", "term", "score")
