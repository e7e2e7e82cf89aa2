"""Ingest: landed bars of the configured tickers, upserted into the stored prices."""

from __future__ import annotations

import logging
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barproof.schemas import PRICE_COLUMNS, UNIVERSE
from barproof.sources.raw_bars import (
    FILE,
    look_back,
    normalize_bars,
    sorted_bars,
    unavailable,
    within_period,
)
from barproof.sources.tables import Batch, replace_table, stage, upsert_staged
from barproof.sources.universe import load_config

logger = logging.getLogger(__name__)

REJECTS = T.StructType([T.StructField(name, T.StringType()) for name in ("ticker", "reason", "file", "line")])
MISSING = UNIVERSE


def missing_path(prices_path: str) -> str:
    """Where an ingest lists the configured tickers without data, all of them."""
    return f"{prices_path.rstrip('/')}.missing-tickers"


def rejects_path(prices_path: str) -> str:
    """Where an ingest lists the landed rows that can't be parsed, if they were read as rejects."""
    return f"{prices_path.rstrip('/')}.rejects"


def run_ingest(
    spark: SparkSession,
    config_path: str,
    raw: DataFrame,
    prices_path: str | None = None,
    as_of: date | None = None,
    zones: dict[str, str] | None = None,
) -> dict[str, int]:
    """Ingest and return the counts of written rows and tickers.

    The landed files are read once: normalised rows are staged, counted as they are written, and
    all that follows reads them. Configured tickers without data are a table beside the prices
    (:func:`missing_path`). If ``raw`` was read with ``rejects``, rows that can't be parsed are
    another one (:func:`rejects_path`), the rest is ingested, and ``rejected`` counts them; otherwise
    the first such row fails the job.
    """
    config = load_config(spark, config_path)
    path = prices_path or config.db_path
    quarantine = FILE in raw.columns
    landed = look_back(raw, config.period, as_of) if as_of and not quarantine else raw
    bars = (sorted_bars if quarantine else normalize_bars)(landed, config.universe, zones)
    bad = "reason IS NOT NULL" if quarantine else "false"
    missing_key = "ticker IS NULL OR exchange IS NULL OR date IS NULL"
    staged, seen = stage(
        bars,
        F.expr("count(*) AS rows"),
        F.expr(f"count_if({bad}) AS rejected"),
        F.expr(f"count_if(NOT ({bad}) AND ({missing_key})) AS incomplete"),
    )
    counts = {"rejected": seen["rejected"]} if quarantine else {}
    if quarantine:
        replace_table(spark, staged.where(bad).select(*REJECTS.fieldNames()), rejects_path(path))
        logger.warning("%d landed row(s) can't be parsed, listed in %s", seen["rejected"], rejects_path(path))
    batch = within_period(staged.where(f"NOT ({bad})").select(*PRICE_COLUMNS), config.period, as_of)
    counts |= upsert_staged(spark, Batch(batch, batch.count(), seen["incomplete"]), path)
    found = batch.select("ticker").distinct().withColumnRenamed("ticker", "symbol")
    missing = config.universe.join(found, "symbol", "left_anti").select("symbol", "exchange")
    replace_table(spark, missing.orderBy("symbol"), missing_path(path))
    if not counts["rows"]:
        raise unavailable(config.universe)
    absent = config.universe.count() - counts["tickers"]
    if absent:
        logger.warning("No data for %d ticker(s), listed in %s", absent, missing_path(path))
    logger.info("Wrote %(rows)d row(s) covering %(tickers)d ticker(s)", counts)
    return counts
