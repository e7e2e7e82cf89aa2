"""Counts and scopes over prices and flags."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barproof.schemas import KEY


def ticker_summary(prices: DataFrame) -> DataFrame:
    """Row count and date range of each ticker, sorted by ticker."""
    return (
        prices.groupBy("ticker")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("date").alias("start_date"),
            F.max("date").alias("end_date"),
        )
        .orderBy("ticker")
    )


def scope_stats(prices: DataFrame) -> DataFrame:
    """Date range and row count of the whole table: NULL, NULL and 0 if it is empty."""
    return prices.agg(
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def ingest_counts(batch: DataFrame) -> DataFrame:
    """Rows and distinct tickers of a batch."""
    return batch.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("ticker").alias("tickers")
    )


def tickers(prices: DataFrame) -> DataFrame:
    """Distinct tickers in order."""
    return prices.select("ticker").distinct().orderBy("ticker")


def flag_counts(flags: DataFrame) -> DataFrame:
    """Flags per type and severity, sorted by both."""
    return (
        flags.groupBy("flag_type", "severity")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("flag_type", "severity")
    )


def flagged_pairs(flags: DataFrame) -> DataFrame:
    """Distinct (ticker, date) of all flags; NULL dates count as a value."""
    return flags.select(*KEY).distinct()


def repeated_keys(df: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*key).count().where(F.col("count") > 1)


def percent_passed(total: Column, failed: Column) -> Column:
    """Rows that did not fail, in percent; 0.0 if there are no rows."""
    return F.when(total == 0, 0.0).otherwise(100.0 * (total - failed) / total)


def pass_rate(prices: DataFrame, flags: DataFrame) -> DataFrame:
    """Share of rows without a flag, in percent; 0.0 if there are no rows.

    ``pass_rate`` counts every flagged (ticker, date), also days that have no row, so missing days
    lower it. ``pass_rate_existing`` counts only rows that exist.
    """
    pairs = flagged_pairs(flags)
    flagged = pairs.agg(F.count(F.lit(1))).scalar()
    flagged_existing = prices.join(pairs, KEY, "left_semi").agg(F.count(F.lit(1))).scalar()

    def percent(failed):
        return percent_passed(F.col("total_rows"), failed)

    return (
        prices.agg(F.count(F.lit(1)).alias("total_rows"))
        .select(
            "total_rows",
            flagged.alias("flagged_rows"),
            flagged_existing.alias("flagged_existing_rows"),
        )
        .select(
            "total_rows",
            "flagged_rows",
            percent(F.col("flagged_rows")).alias("pass_rate"),
            percent(F.col("flagged_existing_rows")).alias("pass_rate_existing"),
        )
    )
