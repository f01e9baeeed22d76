"""Storage-cost projection from the manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# USD per GB-month, USD per month, what a trip may do.
STORAGE_USD_PER_GB_MONTH = 0.015
THRESHOLD_USD = 5.00
MODES = ("fail", "warn", "off")


class CostCheckTripped(RuntimeError):
    """The projected monthly cost is above the threshold."""


def project_cost(
    manifest: DataFrame,
    rate: float = STORAGE_USD_PER_GB_MONTH,
    threshold: float = THRESHOLD_USD,
) -> DataFrame:
    """One row: all bytes ever logged, as GB and USD per month.

    Counts every run and status. ``tripped`` needs the cost strictly above the
    threshold. An empty manifest projects 0.
    """
    total = manifest.agg(F.coalesce(F.sum("bytes"), F.lit(0)).cast("bigint").alias("bytes_cumulative"))
    gigabytes = F.col("bytes_cumulative") / F.lit(float(1024**3))
    return (
        total.withColumn("gigabytes_cumulative", gigabytes)
        .withColumn("monthly_cost_usd", F.col("gigabytes_cumulative") * F.lit(float(rate)))
        .withColumn("threshold_usd", F.lit(float(threshold)))
        .withColumn("tripped", F.col("monthly_cost_usd") > F.col("threshold_usd"))
    )


def check_cost(projection: DataFrame, mode: str = "fail") -> dict:
    """The projection as a dict; raises on a trip in ``fail`` mode only."""
    if mode not in MODES:
        raise ValueError(f"unknown cost-check mode {mode!r}")
    row = projection.first().asDict()
    if row["tripped"] and mode == "fail":
        raise CostCheckTripped(
            f"projected ${row['monthly_cost_usd']:.4f}/month is above "
            f"${row['threshold_usd']:.2f}/month for {row['bytes_cumulative']} bytes"
        )
    return row
