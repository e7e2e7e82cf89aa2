"""The whole run: ingest, verify, validate, explain, report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from barproof.operators.summaries import flag_counts, ticker_summary
from barproof.plans.explain import run_explanations
from barproof.plans.ingest import run_ingest
from barproof.plans.report import run_report
from barproof.plans.validate import run_validations
from barproof.session import materialize
from barproof.sources.calendar import Calendar
from barproof.sources.tables import read_prices
from barproof.sources.universe import load_config


class StageFailed(RuntimeError):
    """A stage raised; ``stage`` names it and the cause is chained."""

    def __init__(self, stage: str, cause: Exception):
        super().__init__(f"{stage} failed: {cause}")
        self.stage = stage


@dataclass(frozen=True)
class Paths:
    prices: str
    flags: str
    explanations: str
    reports: str


@dataclass(frozen=True)
class Outcome:
    ingested: dict[str, int]
    tickers: DataFrame
    flag_counts: DataFrame
    explained: dict[str, int]
    report: str


def verified_tickers(spark: SparkSession, prices_path: str) -> DataFrame:
    """Rows and dates of each stored ticker; an error if there are none."""
    tickers = materialize(ticker_summary(read_prices(spark, prices_path)))
    if tickers.isEmpty():
        raise ValueError(f"No prices are stored at {prices_path}.")
    return tickers


def run_pipeline(
    spark: SparkSession,
    config_path: str,
    raw: DataFrame,
    paths: Paths,
    calendar: Calendar,
    explain_fn: Callable[[str], str],
    stale_price_n: int = 3,
    outlier_k: float = 3.0,
    as_of: date | None = None,
    zones: dict[str, str] | None = None,
    report_date: date | None = None,
) -> Outcome:
    """Run all stages; the first that fails stops the run with :class:`StageFailed`."""

    def stage(name: str, job: Callable, *args, **kwargs):
        try:
            return job(*args, **kwargs)
        except Exception as error:
            raise StageFailed(name, error) from error

    stage("Configuration", load_config, spark, config_path)
    ingested = stage(
        "Ingestion", run_ingest, spark, config_path, raw, paths.prices, as_of, zones
    )
    tickers = stage("Verification", verified_tickers, spark, paths.prices)
    flags = stage(
        "Validation",
        run_validations,
        spark,
        paths.prices,
        paths.flags,
        calendar,
        stale_price_n,
        outlier_k,
    )
    explained = stage(
        "Explanation",
        run_explanations,
        spark,
        paths.prices,
        paths.flags,
        paths.explanations,
        explain_fn,
    )
    report = stage(
        "Report",
        run_report,
        spark,
        paths.prices,
        paths.flags,
        paths.explanations,
        paths.reports,
        report_date,
    )
    return Outcome(ingested, tickers, flag_counts(flags), explained, report)
