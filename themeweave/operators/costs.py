"""Token usage and cost projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import fixed_values as fv


def price_dimension(spark: SparkSession) -> DataFrame:
    """(model, price_in, price_out) in USD per million tokens."""
    return spark.createDataFrame(fv.PRICES, schemas.PRICES)


def usage_totals(usage: DataFrame) -> DataFrame:
    """Sums of ``tokens_in`` and ``tokens_out`` and the number of calls."""
    return usage.agg(
        F.coalesce(F.sum("tokens_in"), F.lit(0)).cast("long").alias("tokens_entrada"),
        F.coalesce(F.sum("tokens_out"), F.lit(0)).cast("long").alias("tokens_saida"),
        F.count(F.lit(1)).alias("chamadas"),
    )


def usage_means(totals: DataFrame) -> DataFrame:
    """Totals with their means per call; no call at all gives 0, not an error."""
    calls = F.greatest(F.col("chamadas"), F.lit(1))
    return totals.withColumns({
        "media_tokens_entrada_por_chamada": F.col("tokens_entrada") / calls,
        "media_tokens_saida_por_chamada": F.col("tokens_saida") / calls,
    })


def means_or_default(usage_report: DataFrame, tokens_in: float = fv.DEFAULT_TOKENS_IN, tokens_out: float = fv.DEFAULT_TOKENS_OUT) -> DataFrame:
    """(mean_in, mean_out) of a usage report, or the defaults if it has no row."""
    return usage_report.agg(
        F.coalesce(F.max("media_tokens_entrada_por_chamada"), F.lit(tokens_in)).cast("double").alias("mean_in"),
        F.coalesce(F.max("media_tokens_saida_por_chamada"), F.lit(tokens_out)).cast("double").alias("mean_out"),
    )


def price_calls(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """What all calls would have cost under each model, unrounded."""
    totals = usage_totals(usage)
    paid_in = totals.select("tokens_entrada").scalar() / 1_000_000 * F.col("price_in")
    paid_out = totals.select("tokens_saida").scalar() / 1_000_000 * F.col("price_out")
    return prices.select("model", "price_in", "price_out", (paid_in + paid_out).alias("spent_usd"))


def round_half_even(x: Column, places: int = 4) -> Column:
    """Rounding of the exact value of a double, ties to even.

    ``round`` and ``bround`` look at the shortest decimal text of the number, so
    0.02175, which is a little less than that as a double, would go up. Here the
    number is split in two parts short enough for exact products, which tells on
    which side of the midpoint it lies.
    """
    scale = 10.0**places
    low = F.floor(x * scale)
    head = x.cast("float").cast("double")
    side = (head * (2 * scale) - (2 * low + 1)) + (x - head) * (2 * scale)
    step = F.when(side > 0, 1).when(side < 0, 0).otherwise(F.pmod(low, F.lit(2)))
    return (low + step).cast("double") / scale


def project_costs(means: DataFrame, prices: DataFrame, n_elements: int = fv.PROJECTED_ELEMENTS) -> DataFrame:
    """Cost of ``n_elements`` calls of mean size per model, rounded to 4 places.

    The total is rounded from the unrounded parts. The order of operations is
    part of the result: another order can round the last digit differently.
    """
    cost_in = means.select("mean_in").scalar() * n_elements / 1_000_000 * F.col("price_in")
    cost_out = means.select("mean_out").scalar() * n_elements / 1_000_000 * F.col("price_out")
    return prices.select("model", cost_in.alias("i"), cost_out.alias("o")).select(
        "model",
        round_half_even(F.col("i")).alias("custo_entrada_usd"),
        round_half_even(F.col("o")).alias("custo_saida_usd"),
        round_half_even(F.col("i") + F.col("o")).alias("custo_total_usd"),
    )


def cost_report(means: DataFrame, prices: DataFrame, n_elements: int = fv.PROJECTED_ELEMENTS) -> DataFrame:
    """The projection with its assumptions beside every row."""
    return project_costs(means, prices, n_elements).withColumns({
        "tokens_entrada_por_chamada": means.select("mean_in").scalar(),
        "tokens_saida_por_chamada": means.select("mean_out").scalar(),
        "n_elementos": F.lit(n_elements).cast("long"),
    })


def cost_document(means: DataFrame, prices: DataFrame, n_elements: int = fv.PROJECTED_ELEMENTS) -> DataFrame:
    """The report as one nested row, ready for a JSON sink. One entry per priced model."""
    costs = F.struct("custo_entrada_usd", "custo_saida_usd", "custo_total_usd")
    entries = F.map_from_entries(F.sort_array(F.collect_list(F.struct("model", costs.alias("costs")))))
    return project_costs(means, prices, n_elements).agg(entries.alias("custos_por_modelo")).select(
        F.struct(
            means.select("mean_in").scalar().alias("tokens_entrada_por_chamada"),
            means.select("mean_out").scalar().alias("tokens_saida_por_chamada"),
            F.lit(n_elements).alias("n_elementos"),
            F.lit(fv.PRICE_SOURCE).alias("fonte_precos"),
        ).alias("premissas"),
        "custos_por_modelo",
    )
