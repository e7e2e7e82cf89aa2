"""Daily bars and landed files derived from the sample tables, for queries, tests and the bench."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barproof.schemas import EXPLANATIONS, conform
from barproof.sources.calendar import Calendar

EXCHANGES = ("NYSE", "LSE")
HOLIDAYS = [
    ("NYSE", date(2024, 1, 1)),
    ("NYSE", date(2024, 1, 15)),
    ("LSE", date(2024, 1, 1)),
]
ZONES = {"NYSE": "America/New_York", "LSE": "Europe/London"}


def sample_calendar(spark: SparkSession) -> Calendar:
    return Calendar.of(spark, HOLIDAYS, EXCHANGES)


# Columns in use, declared so that no job has to infer them from file footers.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, value double",
    "lineitem": "l_suppkey bigint, l_quantity double, l_extendedprice double, "
    "l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _exchange(number: str) -> str:
    return f"CASE WHEN {number} % 2 = 0 THEN 'NYSE' ELSE 'LSE' END AS exchange"


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar per user and day of ``events``, all of them, with a few planted defects; keyed."""
    daily = (
        _table(spark, sf_dir, "events")
        .selectExpr("user_id", "event_id", "value", "to_date(ts) AS date")
        .groupBy("user_id", "date")
        .agg(
            F.min_by("value", "event_id").alias("open"),
            F.max("value").alias("top"),
            F.min("value").alias("low"),
            F.max_by("value", "event_id").alias("last"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    impossible = "(user_id * 7 + dayofmonth(date)) % 41 = 0"
    frozen = "user_id % 10 = 3 AND dayofmonth(date) BETWEEN 8 AND 12"
    return daily.selectExpr(
        "concat('U', user_id) AS ticker",
        _exchange("user_id"),
        "date",
        "open",
        f"CASE WHEN {impossible} THEN low - 1 ELSE top END AS high",
        "low",
        f"CASE WHEN {frozen} THEN 50D ELSE last END AS close",
        "n * 100 AS volume",
        "last AS adj_close",
    )


def repeating_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event bars with some of them repeated; unkeyed."""
    bars = event_bars(spark, sf_dir)
    again = bars.where("(bigint(substr(ticker, 2)) * 3 + dayofmonth(date)) % 53 = 0")
    return bars.unionByName(again)


def supplier_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar per supplier and shipping day of ``lineitem``: seven years of history; keyed."""
    daily = (
        _supplier_ticks(spark, sf_dir)
        .groupBy("l_suppkey", "date")
        .agg(
            F.min("price").alias("low"),
            F.max("price").alias("high"),
            F.sum("quantity").alias("volume"),
        )
    )
    return daily.selectExpr(
        "concat('S', l_suppkey) AS ticker",
        _exchange("l_suppkey"),
        "date",
        "low AS open",
        "high",
        "low",
        "high AS close",
        "volume",
        "high AS adj_close",
    )


def supplier_tick_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as a bar of its own: several per supplier and day; unkeyed."""
    hundreds = "double(floor(price / 100)) * 100"
    return _supplier_ticks(spark, sf_dir).selectExpr(
        "concat('S', l_suppkey) AS ticker",
        _exchange("l_suppkey"),
        "date",
        "price AS open",
        "price AS high",
        f"CASE WHEN quantity = 13 THEN price + 1 ELSE {hundreds} END AS low",
        f"{hundreds} AS close",
        "quantity AS volume",
        "price AS adj_close",
    )


def _supplier_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey",
        "to_date(l_shipdate) AS date",
        "l_extendedprice / l_quantity AS price",
        "bigint(l_quantity) AS quantity",
    )


def landed_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the shape of landed files: zoned times, fractional volume, no ``Adj Close``."""
    return _table(spark, sf_dir, "events").selectExpr(
        "concat('U', user_id) AS symbol",
        "timestamp(convert_timezone('UTC', current_timezone(), ts)) AS Date",
        "value AS Open",
        "value + 1 AS High",
        "value - 1 AS Low",
        "CASE WHEN event_id % 97 = 0 THEN double('NaN') ELSE value END AS Close",
        "value * 50 AS Volume",
    )


def customer_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A universe of one symbol per customer; many of them never landed."""
    return _table(spark, sf_dir, "customer").selectExpr(
        "concat('U', c_custkey) AS symbol", _exchange("c_custkey")
    )


def ingest_batch(bars: DataFrame) -> DataFrame:
    """A later delivery: late days with other prices, and the same under new tickers."""
    late = bars.where(F.dayofmonth("date") >= 20)
    corrected = late.withColumn("close", F.col("close") + 1).withColumn(
        "adj_close", F.col("adj_close") + 1
    )
    added = corrected.withColumn("ticker", F.concat(F.lit("N"), "ticker"))
    return corrected.unionByName(added)


def earlier_explanations(flags: DataFrame) -> DataFrame:
    """Explanations already stored: those of flags on every third day of the month."""
    seen = flags.where(F.pmod(F.dayofmonth("date"), F.lit(3)) == 0)
    return conform(
        seen.withColumn("explanation", F.concat(F.lit("Seen before: "), "flag_type")), EXPLANATIONS
    )
