import json
import random

from pyspark.sql import functions as F

from themeweave import schemas
from themeweave.operators import costs

# Recorded run: 3443 tokens in and 499 out over 4 calls.
RECORDED = (3443, 499, 4, 860.75, 124.75)
GOLDEN = {
    "gemini-2.5-flash": (0.2582, 0.3119, 0.5701),
    "gemini-3-flash-preview": (0.4304, 0.3742, 0.8046),
    "gemini-3.1-pro-preview": (1.7215, 1.497, 3.2185),
}


def test_recorded_costs(spark):
    usage = spark.createDataFrame([RECORDED], schemas.USAGE_REPORT)
    rows = costs.project_costs(costs.means_or_default(usage), costs.price_dimension(spark)).collect()
    assert {r["model"]: tuple(r)[1:] for r in rows} == GOLDEN


def test_cost_document(spark):
    usage = spark.createDataFrame([RECORDED], schemas.USAGE_REPORT)
    document = costs.cost_document(costs.means_or_default(usage), costs.price_dimension(spark))
    got = json.loads(document.select(F.to_json(F.struct("*"))).first()[0])
    assert got["premissas"]["n_elementos"] == 1000 and got["premissas"]["tokens_entrada_por_chamada"] == 860.75
    assert {m: tuple(c.values()) for m, c in got["custos_por_modelo"].items()} == GOLDEN


def test_usage_and_its_means(spark):
    calls = spark.createDataFrame([(0, 10, 3), (1, 5, 2)], "call_id int, tokens_in long, tokens_out long")
    assert tuple(costs.usage_means(costs.usage_totals(calls)).first()) == (15, 5, 2, 7.5, 2.5)
    none = costs.usage_means(costs.usage_totals(calls.limit(0))).first()
    assert tuple(none) == (0, 0, 0, 0.0, 0.0)


def test_defaults_without_a_report(spark):
    empty = spark.createDataFrame([], schemas.USAGE_REPORT)
    assert tuple(costs.means_or_default(empty).first()) == (600.0, 150.0)


def test_rounding_equals_python(spark):
    rng = random.Random(1)
    values = [0.02175, 0.37424999999999997, 0.00005, 0.5, 0.0, 2.00015]
    values += [rng.randint(1, 8000) / rng.choice([1, 2, 4, 8]) / 1000 * rng.choice([0.3, 0.5, 2.0, 2.5, 3.0, 12.0]) for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.select("x", costs.round_half_even(F.col("x")).alias("r")).collect()
    assert [(r["x"], r["r"]) for r in got if r["r"] != round(r["x"], 4)] == []
