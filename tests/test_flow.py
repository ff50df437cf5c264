import numpy as np
import pytest

from themeweave import schemas
from themeweave.plans import fixtures as fx
from themeweave.plans import flow
from themeweave.plans.queries import echo_client
from themeweave.sources import readers


def letter_encoder():
    """Letter frequencies: crude vectors, but ones that tell languages apart."""

    def load():
        def encode(texts):
            return np.array([[t.lower().count(c) + 0.01 for c in "abcdefghijklmnopqrstuvwxyzéèàçßüñ"] for t in texts])

        return encode

    return load


@pytest.mark.parametrize("nearest", [False, True])
def test_whole_run(spark, tmp_path, nearest):
    out = str(tmp_path / "run")
    options = flow.Options(n_sample=90, k_max=6, n_init=2, min_cluster_size=8, dims=5, nearest_examples=nearest)
    corpus = fx.corpus(spark, "/root/testdata/sf0.001")
    labels = flow.run(corpus, out, echo_client, letter_encoder(), options)
    clustered = spark.read.parquet(f"{out}/clustered")
    assert spark.read.parquet(f"{out}/raw").count() == 90
    assert clustered.count() == spark.read.parquet(f"{out}/clean").count() == readers.scan_vectors(spark, f"{out}/vectors").count()
    assert clustered.where("cluster_kmeans is null or cluster_hdbscan is null").count() == 0
    ids = {r[0] for r in clustered.select("cluster_kmeans").distinct().collect()}
    assert {r["cluster_id"] for r in labels.collect()} <= ids and 4 <= len(ids) <= 6
    record = readers.scan_json_document(spark, f"{out}/metrics", schemas.METRICS).first()
    assert record["kmeans"]["k_escolhido"] == len(ids) and 0 < record["kmeans"]["pureza"] <= 1
    usage = readers.scan_json_document(spark, f"{out}/usage", schemas.USAGE_REPORT).first()
    assert usage["chamadas"] == labels.count() + spark.read.parquet(f"{out}/dead_letters").count()
