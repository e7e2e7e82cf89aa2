"""Small tables and helpers that several test modules use."""

from datetime import date, timedelta
from pathlib import Path

from barproof.schemas import EXPLANATIONS, FLAGS, PRICES


def weekdays(start: date, count: int) -> list[date]:
    days = (start + timedelta(days=i) for i in range(count * 2 + 7))
    return [day for day in days if day.weekday() < 5][:count]


def bar(ticker, day, close=10.0, exchange="NYSE", **values):
    row = {
        "ticker": ticker,
        "exchange": exchange,
        "date": day,
        "open": close,
        "high": None if close is None else close + 1,
        "low": None if close is None else close - 1,
        "close": close,
        "volume": 1000,
        "adj_close": close,
    }
    return {**row, **values}


def prices_of(spark, rows):
    columns = PRICES.fieldNames()
    return spark.createDataFrame([tuple(row[c] for c in columns) for row in rows], PRICES)


def flags_of(spark, rows):
    return spark.createDataFrame(rows, FLAGS)


def explanations_of(spark, rows):
    return spark.createDataFrame(rows, EXPLANATIONS)


def saved(path):
    return "".join(p.read_text(encoding="utf-8") for p in sorted(Path(path).glob("part-*")))
