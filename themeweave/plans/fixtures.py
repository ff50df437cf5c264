"""The driver's tables dressed as the corpus, vectors, usage and responses of a run.

The SQL runs unchanged in Spark and DuckDB. Table names in braces are filled in
by either side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Titles are first lines; nulls, URLs, tags and a no-break space are planted by
# doc_id because the source texts have none.
CORPUS = """
select doc_id,
 case when doc_id % 17 = 0 then null else split_part(text, chr(10), 1) end as title,
 case when doc_id % 19 = 0 then null
      when doc_id % 7 = 0 then concat('<p class="x">', substring(text, length(split_part(text, chr(10), 1)) + 2), '</p>', chr(10), 'http://a.example/', cast(doc_id as string), chr(9), 'www.b.example', chr(160), '<br>')
      else substring(text, length(split_part(text, chr(10), 1)) + 2) end as text,
 case when doc_id % 29 = 0 then null else cast(date_add(DATE '2019-07-01', cast(doc_id * 37 % 730 as int)) as date) end as date,
 case when doc_id % 23 = 0 then null else lang end as category,
 concat('https://news.example.org/', cast(doc_id as string)) as link
from {documents}
"""

# Fixed assignments for every document: the label of the vector whose number is its own
# modulo the number of vectors. Label 9 plays noise in the density column.
CLUSTERED = """
select c.*, e.label as cluster_kmeans, case when e.label = 9 then -1 else e.label end as cluster_hdbscan
from {corpus} c join {embeddings} e on e.vec_id = c.doc_id % {n_vectors}
"""

VECTORS = "select vec_id as doc_id, embedding, label from {embeddings}"

# One call per conversation, words standing in for tokens.
USAGE = """
select conv_id as call_id,
 cast(sum(case when role = 'user' then length(text) - length(replace(text, ' ', '')) + 1 else 0 end) as bigint) as tokens_in,
 cast(sum(case when role = 'assistant' then length(text) - length(replace(text, ' ', '')) + 1 else 0 end) as bigint) as tokens_out
from {conversations} group by conv_id
"""

# One model response per document; doc_id decides which rule it breaks, if any.
RESPONSES = """
select cast(doc_id as int) as cluster_id,
 case when doc_id % 16 = 1 then concat('{{"cluster_id":', cast(doc_id as string), ',"nome_topico":" Outros ","palavras_chave":["a","b","c"],"resumo":"Resumo em ', lang, '.","nivel_confianca":0.4,"possivel_ruido":true}}')
      when doc_id % 16 = 2 then concat('{{"cluster_id":', cast(doc_id as string), ',"nome_topico":"Tema ', source, '","palavras_chave":["gol","copa"],"resumo":"Resumo em ', lang, '.","nivel_confianca":0.8,"possivel_ruido":false}}')
      when doc_id % 16 = 3 then concat('{{"cluster_id":', cast(doc_id as string), ',"nome_topico":"Tema ', source, '","palavras_chave":["a","b","c"],"resumo":"Resumo em ', lang, '.","nivel_confianca":1.5,"possivel_ruido":false}}')
      when doc_id % 16 = 4 then concat('{{"cluster_id":"', cast(doc_id as string), '","nome_topico":"Tema ', source, '","palavras_chave":["a","b","c"],"resumo":"Resumo em ', lang, '.","nivel_confianca":0.7,"possivel_ruido":false}}')
      when doc_id % 16 = 5 then concat('not json ', lang)
      when doc_id % 16 = 6 then concat('{{"cluster_id":', cast(doc_id as string), ',"nome_topico":" Tema de ', lang, ' ","palavras_chave":["a","', lang, '","', source, '"],"resumo":"Resumo em ', lang, '.","nivel_confianca":1,"possivel_ruido":true,"extra":[1,2]}}')
      when doc_id % 16 = 7 then concat('{{"cluster_id":', cast(doc_id as string), ',"nome_topico":"Tema ', source, '","palavras_chave":["a","b","c"],"resumo":"Resumo em ', lang, '.","nivel_confianca":0.7,"possivel_ruido":null}}')
      when doc_id % 16 = 8 then concat('{{"cluster_id":', cast(doc_id as string), ',"nome_topico":"', lang, '","palavras_chave":["a","b","c"],"resumo":"Resumo em ', lang, '.","nivel_confianca":0.7,"possivel_ruido":false}}')
      when doc_id % 16 = 9 then concat('{{"cluster_id":', cast(doc_id as string), ',"nome_topico":"Tema ', source, '","palavras_chave":["a","b","c"],"nivel_confianca":0.7,"possivel_ruido":false}}')
      when doc_id % 16 = 10 then concat('{{"cluster_id":', cast(doc_id + 1 as string), ',"nome_topico":"Tema ', source, '","palavras_chave":["a","b","c"],"resumo":"Resumo em ', lang, '.","nivel_confianca":0.7,"possivel_ruido":false}}')
      when doc_id % 16 = 11 then concat('{{"cluster_id":', cast(doc_id as string), ',"nome_topico":"Tema ', source, '","palavras_chave":["a","b","c","d","e","f","g","h","i"],"resumo":"Resumo em ', lang, '.","nivel_confianca":0.7,"possivel_ruido":false}}')
      when doc_id % 16 = 12 then concat('{{"cluster_id":', cast(doc_id as string), ',"nome_topico":', cast(n_chars as string), ',"palavras_chave":["a",2,"c"],"resumo":"curto","nivel_confianca":"0.7","possivel_ruido":"yes"}}')
      else concat('{{"cluster_id":', cast(doc_id as string), ',"nome_topico":"Tema ', source, '","palavras_chave":["', lang, '","', source, '","noticia"],"resumo":"Resumo de ', cast(n_chars as string), ' letras.","nivel_confianca":0.9}}')
 end as raw
from {documents}
"""

BATCHES = "select cluster_id as batch_id, concat('{{\"rotulos\":[', raw, ',', raw, ']}}') as raw from {responses}"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CORPUS, documents=_table(spark, sf_dir, "documents"))


def clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = _table(spark, sf_dir, "embeddings")
    return spark.sql(CLUSTERED, corpus=corpus(spark, sf_dir), embeddings=embeddings, n_vectors=embeddings.count())


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(VECTORS, embeddings=_table(spark, sf_dir, "embeddings"))


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(USAGE, conversations=_table(spark, sf_dir, "conversations"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RESPONSES, documents=_table(spark, sf_dir, "documents"))


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BATCHES, responses=responses(spark, sf_dir))
