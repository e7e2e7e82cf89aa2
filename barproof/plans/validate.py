"""Validate: all checks over the stored prices, replacing the stored flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barproof.operators.checks import all_flags
from barproof.schemas import FLAGS
from barproof.sources.calendar import Calendar
from barproof.sources.tables import read_series, read_table, replace_table


def run_validations(
    spark: SparkSession,
    prices_path: str,
    flags_path: str,
    calendar: Calendar,
    stale_price_n: int = 3,
    outlier_k: float = 3.0,
) -> DataFrame:
    """Replace the stored flags and return them. If a check fails, the old flags stay."""
    prices = read_series(spark, prices_path)
    flags = all_flags(prices, calendar, stale_price_n, outlier_k, keyed=True)
    replace_table(spark, flags, flags_path)
    return read_table(spark, flags_path, FLAGS)
