"""Report: one ordered table of markdown text, written as a folder of ordered text files."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barproof.functions import text
from barproof.operators.flag_joins import with_explanations
from barproof.operators.summaries import percent_passed
from barproof.schemas import EXPLANATIONS, FLAG_COLUMNS, FLAGS
from barproof.session import materialize
from barproof.sources.tables import read_prices, read_table

# Sections in document order.
HEAD, TICKERS, TOTAL, COUNTS, AFTER_COUNTS, BY_TICKER, RESULT = range(7)

# Columns that place a text inside its section, in sorting order.
_PLACE = {
    "ticker": "string",
    "entry": "int",
    "date": "date",
    "flag_type": "string",
    "severity": "string",
    "place": "string",
}

#: Fixed value: a ticker's share of the hash over all names, which needs no order of them.
_NAME_PIECE = "CAST(conv(substr(sha2(ticker, 256), 1, 15), 16, 10) AS DECIMAL(20, 0))"


def _line(section: int, content: str, when: str = "true", **keys: str) -> str:
    """A text with its place in the document, as a struct; NULL unless ``when``."""
    places = ", ".join(f"'{name}', CAST({keys.get(name, 'NULL')} AS {kind})" for name, kind in _PLACE.items())
    return f"CASE WHEN {when} THEN named_struct('section', {section}, {places}, 'text', {content}) END"


def _lines(df: DataFrame, *lines: str) -> DataFrame:
    return df.selectExpr(f"inline(array_compact(array({', '.join(lines)})))")


@dataclass(frozen=True)
class Facts:
    """All counts of a report: one aggregate of the prices and one of the flags, put together.

    ``rows`` is stored: a row for each ticker (its bars, first and last day, and flags), and one for each
    flag type with its severity. ``sums`` is a single row over them all.
    """

    rows: DataFrame
    sums: Row
    kinds: T.StructType

    @property
    def total(self) -> DataFrame:
        """``sums`` as a table of literals."""
        literals = [self.literal(field.name) for field in self.kinds]
        return self.rows.sparkSession.range(1).select(*literals)

    def literal(self, name: str) -> Column:
        return F.lit(self.sums[name]).cast(self.kinds[name].dataType).alias(name)

    @property
    def tickers(self) -> DataFrame:
        return self.rows.where("bars > 0")


def report_facts(prices: DataFrame, flags: DataFrame) -> Facts:
    by_ticker = prices.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("bars"), F.min("date").alias("first_day"), F.max("date").alias("last_day")
    )
    # The first flag of a ticker and day stands for the pair, a NULL day included.
    pair = "row_number() OVER (PARTITION BY ticker, date ORDER BY flag_type)"
    by_kind = (
        flags.selectExpr("ticker", "flag_type", "severity", f"int({pair} = 1) AS new")
        .groupingSets([["ticker"], ["flag_type", "severity"]], "ticker", "flag_type", "severity")
        .agg(F.count(F.lit(1)).alias("flags"), F.sum("new").alias("pairs"))
    )
    keys = ["ticker", "flag_type", "severity"]
    facts = materialize(
        by_ticker.unionByName(by_kind, allowMissingColumns=True)
        .groupBy(*keys)
        .agg(
            F.coalesce(F.sum("bars"), F.lit(0)).alias("bars"),
            F.min("first_day").alias("first_day"),
            F.max("last_day").alias("last_day"),
            F.coalesce(F.sum("flags"), F.lit(0)).alias("flags"),
            F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"),
        )
    )
    known = "CASE WHEN bars > 0 THEN ticker END"
    total = facts.selectExpr(
        f"min({known}) AS first_ticker",
        f"max({known}) AS last_ticker",
        f"count({known}) AS tickers",
        f"sum(CASE WHEN bars > 0 THEN {_NAME_PIECE} END) AS name_pieces",
        "min(first_day) AS min_date",
        "max(last_day) AS max_date",
        "bigint(coalesce(sum(bars), 0)) AS total_rows",
        "bigint(coalesce(sum(CASE WHEN flag_type IS NULL THEN pairs END), 0)) AS flagged_rows",
        "count(flag_type) AS kinds",
    )
    return Facts(facts, total.first(), total.schema)


def report_entries(prices: DataFrame, flags: DataFrame, explanations: DataFrame) -> DataFrame:
    """Flags of the tickers in ``prices``, each with its explanation or a fallback note."""
    return _entries(prices.select("ticker").distinct(), flags, explanations)


def _entries(known: DataFrame, flags: DataFrame, explanations: DataFrame) -> DataFrame:
    fallback = (
        f"CASE WHEN flag_type = 'MISSING_DATES' THEN {text.quoted(text.HOLIDAY_NOTE)} "
        f"ELSE {text.quoted(text.NO_EXPLANATION_NOTE)} END"
    )
    # Flags stay on the left of both joins, the side Spark can split when a key is hot.
    return (
        with_explanations(flags, explanations)
        .join(known, "ticker", "left_semi")
        .selectExpr(*FLAG_COLUMNS, f"coalesce(explanation, {fallback}) AS explanation")
    )


def _fixed_lines(total: DataFrame) -> DataFrame:
    """The lines that a report has once."""
    head = text.joined(
        text.quoted("# Data Quality Report\n\n## Summary\n\n- Date range: "),
        "coalesce(string(min_date), 'None')",
        "' to '",
        "coalesce(string(max_date), 'None')",
    )
    table_head = text.quoted("| Flag Type | Severity | Count |\n|---|---|---|")
    heading = f"CASE WHEN kinds = 0 THEN {text.quoted(text.NO_FLAGS_NOTE)} ELSE {table_head} END"
    # Without any ticker, the empty ticker section leaves a blank line of its own.
    result = text.joined(
        "CASE WHEN total_rows = 0 THEN '\n' ELSE '' END",
        text.quoted("## Result\n\n"),
        text.fixed("pass_rate", 1),
        "'% of rows passed all validation checks.'",
    )
    return _lines(
        total.withColumn("pass_rate", percent_passed(F.col("total_rows"), F.col("flagged_rows"))),
        _line(HEAD, head),
        _line(TICKERS, "'- Tickers: '", when="tickers = 0"),
        _line(TOTAL, "concat('- Total rows: ', total_rows, '\n')"),
        _line(COUNTS, heading, entry="0"),
        _line(AFTER_COUNTS, "''"),
        _line(RESULT, result),
    )


def _counted_lines(facts: Facts) -> DataFrame:
    """The lines of each ticker and flag type.

    ``- Tickers: A,`` and so on, one line per name; Markdown joins such lines with a blank.
    """
    name = (
        "concat(CASE WHEN ticker = first_ticker THEN '- Tickers: ' ELSE '  ' END, ticker, "
        "CASE WHEN ticker = last_ticker THEN '' ELSE ',' END)"
    )
    return _lines(
        facts.rows.select("*", facts.literal("first_ticker"), facts.literal("last_ticker")),
        _line(TICKERS, name, when="bars > 0", ticker="ticker"),
        _line(BY_TICKER, "concat('## ', ticker, '\n')", when="bars > 0", ticker="ticker", entry="0"),
        _line(
            BY_TICKER,
            text.quoted(text.NO_TICKER_FLAGS_NOTE + "\n"),
            when="bars > 0 AND flags = 0",
            ticker="ticker",
            entry="1",
        ),
        _line(
            COUNTS,
            "concat_ws(' ', '|', flag_type, '|', severity, '|', flags, '|')",
            when="flag_type IS NOT NULL",
            entry="1",
            flag_type="flag_type",
            severity="severity",
        ),
    )


def report_text(prices: DataFrame, flags: DataFrame, explanations: DataFrame) -> DataFrame:
    """The report as rows of markdown text in document order; a row may span several lines."""
    return _report_text(report_facts(prices, flags), flags, explanations)


def _report_text(facts: Facts, flags: DataFrame, explanations: DataFrame) -> DataFrame:
    entries = _lines(
        _entries(facts.tickers, flags, explanations),
        _line(
            BY_TICKER,
            text.report_entry(),
            ticker="ticker",
            entry="1",
            date="date",
            flag_type="flag_type",
            severity="severity",
            place="concat_ws('\n', details, explanation)",
        ),
    )
    whole = _fixed_lines(facts.total).unionByName(_counted_lines(facts)).unionByName(entries)
    order = [F.asc_nulls_last(name) if name == "date" else F.asc(name) for name in whole.columns]
    return whole.orderBy(*order[:-1])


def save_report(report: DataFrame, path: str) -> None:
    """Write the report as text files whose names sort in document order."""
    report.select("text").write.mode("overwrite").text(path)


def scope_hash(prices: DataFrame) -> DataFrame:
    """Eight hex digits that identify the set of tickers and the date range.

    The names enter as their number and the sum of their digests, which needs no order and no row
    that holds them all.
    """
    by_ticker = prices.groupBy("ticker").agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"))
    return _hashed(
        by_ticker.selectExpr(
            "count(*) AS tickers",
            f"sum({_NAME_PIECE}) AS name_pieces",
            "min(first_day) AS min_date",
            "max(last_day) AS max_date",
        )
    )


def _hashed(total: DataFrame) -> DataFrame:
    names = "concat_ws(',', tickers, name_pieces)"
    days = "coalesce(string(min_date), 'None'), coalesce(string(max_date), 'None')"
    return total.selectExpr(f"substr(sha2(concat_ws('|', {names}, {days}), 256), 1, 8) AS scope_hash")


def report_name(prices: DataFrame, report_date: date | None = None) -> DataFrame:
    """Name of the report for this scope and day."""
    return _named(scope_hash(prices), report_date)


def _named(hashed: DataFrame, report_date: date | None) -> DataFrame:
    day = (report_date or date.today()).isoformat()
    name = F.concat(F.lit(f"market_data_quality_report_{day}_"), F.col("scope_hash"), F.lit(".md"))
    return hashed.select(name.alias("report_name"))


def run_report(
    spark: SparkSession,
    prices_path: str,
    flags_path: str,
    explanations_path: str,
    reports_path: str,
    report_date: date | None = None,
) -> str:
    """Write the report of the stored tables and return its path."""
    prices = read_prices(spark, prices_path)
    flags = read_table(spark, flags_path, FLAGS)
    explanations = read_table(spark, explanations_path, EXPLANATIONS, may_be_absent=True)
    facts = report_facts(prices, flags)
    name = _named(_hashed(facts.total), report_date).first().report_name
    path = f"{reports_path.rstrip('/')}/{name}"
    save_report(_report_text(facts, flags, explanations), path)
    return path
