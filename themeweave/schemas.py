"""Explicit schema of every stage table."""

from pyspark.sql import types as T

RAW_CORPUS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("category", T.StringType()),
    T.StructField("link", T.StringType()),
])

CLEAN_CORPUS = T.StructType(RAW_CORPUS.fields + [T.StructField("texto_modelo", T.StringType())])

CLUSTERED_CORPUS = T.StructType(CLEAN_CORPUS.fields + [
    T.StructField("cluster_kmeans", T.IntegerType()),
    T.StructField("cluster_hdbscan", T.IntegerType()),
])

VECTORS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
])

LABEL = T.StructType([
    T.StructField("cluster_id", T.IntegerType()),
    T.StructField("nome_topico", T.StringType()),
    T.StructField("palavras_chave", T.ArrayType(T.StringType())),
    T.StructField("resumo", T.StringType()),
    T.StructField("nivel_confianca", T.DoubleType()),
    T.StructField("possivel_ruido", T.BooleanType()),
])

RESPONSE = T.StructType([
    T.StructField("cluster_id", T.IntegerType()),
    T.StructField("raw", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("attempts", T.IntegerType()),
    T.StructField("tokens_in", T.LongType()),
    T.StructField("tokens_out", T.LongType()),
])

DEAD_LETTER = T.StructType([
    T.StructField("cluster_id", T.IntegerType()),
    T.StructField("resposta_crua", T.StringType()),
    T.StructField("erro", T.StringType()),
    T.StructField("timestamp", T.DoubleType()),
])

USAGE_REPORT = T.StructType([
    T.StructField("tokens_entrada", T.LongType()),
    T.StructField("tokens_saida", T.LongType()),
    T.StructField("chamadas", T.LongType()),
    T.StructField("media_tokens_entrada_por_chamada", T.DoubleType()),
    T.StructField("media_tokens_saida_por_chamada", T.DoubleType()),
])

PRICES = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("price_in", T.DoubleType()),
    T.StructField("price_out", T.DoubleType()),
])

METRICS = T.StructType([
    T.StructField("kmeans", T.StructType([
        T.StructField("k_escolhido", T.LongType()),
        T.StructField("silhouette", T.DoubleType()),
        T.StructField("pureza", T.DoubleType()),
        T.StructField("cobertura", T.DoubleType()),
        T.StructField("metrica_distancia", T.StringType()),
    ])),
    T.StructField("hdbscan", T.StructType([
        T.StructField("n_clusters_descobertos", T.LongType()),
        T.StructField("silhouette", T.DoubleType()),
        T.StructField("pureza", T.DoubleType()),
        T.StructField("cobertura", T.DoubleType()),
        T.StructField("metrica_distancia", T.StringType()),
        T.StructField("umap_n_components", T.IntegerType()),
    ])),
    T.StructField("aviso", T.StringType()),
])
