"""Document vectors and their reduction."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import IDF, PCA, HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import text as tx
from ..functions import vectors as vx
from ..session import materialize

DIMENSIONS = 768

Encoder = Callable[[list[str]], np.ndarray]


def embed_documents(df: DataFrame, load_encoder: Callable[[], Encoder] | None = None, text_col: str = "texto_modelo", batch_size: int = 64) -> DataFrame:
    """(doc_id, embedding): unit vectors of the texts.

    ``load_encoder`` is called once per Python task and returns a function from
    a list of texts to a matrix; a model is thus loaded once, not per batch.
    Without it, hashed TF-IDF vectors are made on the JVM side.
    """
    if load_encoder is None:
        return _hashed_vectors(df, text_col)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            for start in range(0, batch.num_rows, batch_size):
                part = batch.slice(start, batch_size)
                encoder = encoder or load_encoder()
                unit = vx.unit_rows(np.asarray(encoder(part.column("body").to_pylist()), dtype=np.float64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), vx.to_lists(unit).cast(pa.list_(pa.float32()))], names=["doc_id", "embedding"]
                )

    rows = df.select("doc_id", tx.null_to_empty(F.col(text_col)).alias("body"))
    return rows.mapInArrow(encode, "doc_id long, embedding array<float>")


def _hashed_vectors(df: DataFrame, text_col: str) -> DataFrame:
    """Hashed term counts, weighted by inverse document frequency, scaled to length one.

    The counts are written out between the two passes that weighting takes, so
    texts are read and tokenised once.
    """
    tokens = df.select("doc_id", tx.tokenize(F.col(text_col)).alias("tokens"))
    hashing = HashingTF(inputCol="tokens", outputCol="tf", numFeatures=DIMENSIONS)
    counts = materialize(hashing.transform(tokens).select("doc_id", "tf"), "hashed")
    weighted = IDF(inputCol="tf", outputCol="weighted").fit(counts).transform(counts)
    unit = Normalizer(inputCol="weighted", outputCol="unit", p=2.0).transform(weighted)
    return unit.select("doc_id", vector_to_array("unit", "float32").alias("embedding"))


def reduce_dimensions(df: DataFrame, dims: int = fv.REDUCED_DIMS, vector_col: str = "embedding") -> DataFrame:
    """(doc_id, embedding) in ``dims`` dimensions by principal components of the unit vectors.

    A linear reduction; its fit is one aggregation to a matrix whose size is the
    vectors' width squared, whatever the number of rows.
    """
    rows = df.select("doc_id", array_to_vector(vx.l2_normalize(F.col(vector_col))).alias("x"))
    model = PCA(k=dims, inputCol="x", outputCol="y").fit(rows)
    return model.transform(rows).select("doc_id", vector_to_array("y", "float32").alias("embedding"))


def explained_variance(df: DataFrame, dims: int = fv.REDUCED_DIMS, vector_col: str = "embedding") -> list[float]:
    rows = df.select(array_to_vector(vx.l2_normalize(F.col(vector_col))).alias("x"))
    return [float(x) for x in PCA(k=dims, inputCol="x", outputCol="y").fit(rows).explainedVariance]
