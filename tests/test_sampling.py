import hashlib

import pytest
from pyspark.sql import functions as F

from themeweave.operators import sampling, selection


@pytest.fixture(scope="module")
def ids(spark):
    return spark.range(5000).withColumnRenamed("id", "doc_id")


def expected_order(seed=42, n=5000):
    return sorted(range(n), key=lambda i: (hashlib.md5(f"{seed}|{i}".encode()).hexdigest(), i))


@pytest.mark.parametrize("n", [1, 50, 1000, 5000, 6000])
def test_sample_is_exact_and_seeded(ids, n):
    got = [r["doc_id"] for r in sampling.sample_exact_n(ids, n).collect()]
    assert len(got) == len(set(got)) == min(n, 5000)
    assert set(got) == set(expected_order()[:n])


def test_sample_ignores_partitioning(ids):
    one = {r["doc_id"] for r in sampling.sample_exact_n(ids.repartition(1), 100).collect()}
    many = {r["doc_id"] for r in sampling.sample_exact_n(ids.repartition(37), 100).collect()}
    other_seed = {r["doc_id"] for r in sampling.sample_exact_n(ids, 100, seed=7).collect()}
    assert one == many != other_seed


def test_dense_ids_follow_the_sample_order(ids):
    got = {r["doc_id"]: r["dense"] for r in sampling.dense_doc_id(ids, out="dense").collect()}
    assert got == {i: place for place, i in enumerate(expected_order())}


def corpus(spark, n=30):
    return spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.lit("t").alias("title"),
        F.lit("x").alias("text"),
        F.expr("date_add(date'2019-12-25', cast(id as int))").alias("date"),
        F.lit("c").alias("category"),
        F.lit("l").alias("link"),
    )


def test_period_is_half_open(spark):
    days = [r["date"].isoformat() for r in selection.filter_period(corpus(spark), "2019-12-26", "2019-12-28").collect()]
    assert sorted(days) == ["2019-12-26", "2019-12-27"]


def test_too_few_rows_raise_with_yearly_volume(spark):
    with pytest.raises(ValueError, match="2019: 7, 2020: 23"):
        sampling.require_min_rows(corpus(spark), 24)
    assert sampling.require_min_rows(corpus(spark), 23).count() == 23


def test_drawn_sample_has_gapless_ids(spark):
    drawn = sampling.draw_sample(corpus(spark), n=10)
    assert drawn.columns == ["doc_id", "title", "text", "date", "category", "link"]
    assert sorted(r["doc_id"] for r in drawn.collect()) == list(range(10))


def test_best_k_takes_smallest_on_ties_and_nothing_below_start(spark):
    scores = spark.createDataFrame([(4, 0.2), (5, 0.5), (6, 0.5)], "k int, silhouette double")
    assert sampling.select_best_k(scores).first()["k"] == 5
    low = spark.createDataFrame([(4, -1.0)], "k int, silhouette double")
    assert sampling.select_best_k(low).count() == 0


def test_rank_filter_is_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("c"), F.col("id").alias("doc_id"))
    plan = sampling.first_n_per_cluster(df, "c")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
