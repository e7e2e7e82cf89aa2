"""Trading calendars: Monday to Friday, less the holidays of each known exchange."""

from __future__ import annotations

from dataclasses import dataclass

from datetime import date

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barproof.functions.text import quoted
from barproof.schemas import HOLIDAYS, conform


@dataclass(frozen=True)
class Calendar:
    """Holidays as a table of (exchange, date), and the exchanges it speaks for.

    The exchanges are listed apart because one may have no holiday in the covered range. A ticker
    of any other exchange is an error, never a silent fall back to plain weekdays.
    """

    holidays: DataFrame
    exchanges: tuple[str, ...]

    @classmethod
    def of(
        cls,
        spark: SparkSession,
        holidays: list[tuple[str, date]],
        exchanges: tuple[str, ...],
    ) -> Calendar:
        # An Arrow table becomes a local relation, whose size the optimizer knows.
        names, days = zip(*holidays) if holidays else ((), ())
        table = pa.table({"exchange": pa.array(names, pa.string()), "date": pa.array(days, pa.date32())})
        return cls(spark.createDataFrame(table, HOLIDAYS), exchanges)

    @classmethod
    def read(cls, spark: SparkSession, path: str, exchanges: tuple[str, ...]) -> Calendar:
        return cls(conform(spark.read.parquet(path), HOLIDAYS), exchanges)

    def known(self, exchange: str) -> Column:
        """True for a known exchange; fails the query otherwise."""
        names = ", ".join(quoted(name) for name in self.exchanges)
        return F.expr(
            f"CASE WHEN {exchange} IN ({names}) THEN true ELSE boolean(raise_error("
            f"concat('No trading calendar for exchange ', coalesce({exchange}, 'NULL')))) END"
        )

    def drop_holidays(self, days: DataFrame, exchange: str) -> DataFrame:
        """Drop rows that fall on a holiday of the exchange in column ``exchange``.

        Rows with a NULL there are kept.
        """
        closed = self.holidays.selectExpr("exchange AS _closed_exchange", "date AS _closed_date")
        matches = F.expr(f"{exchange} = _closed_exchange AND date = _closed_date")
        return days.join(closed, matches, "left_anti")
