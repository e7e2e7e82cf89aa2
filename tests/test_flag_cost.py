"""What a bar costs in the outlier check and in all checks, and that cheap ways give the same flags."""

from datetime import date, timedelta
from random import Random

import pytest

from barproof.operators import checks
from barproof.schemas import PRICES
from barproof.sources.calendar import Calendar

FIRST = date(2026, 1, 5)


def odd_bars(spark):
    """Series of noise with jumps, constant returns, flat prices, and prices that aren't finite."""
    rng, rows = Random(7), []
    for ticker in ("NOISE", "GROWTH", "FLAT", "ODD"):
        price = 100.0
        for i in range(260):
            if ticker == "NOISE":
                price *= 1 + rng.gauss(0, 0.01) * (9 if rng.random() < 0.04 else 1)
            elif ticker == "GROWTH":
                price *= 1.01
            elif ticker == "FLAT":
                price = 50.0 + (rng.random() * 1e-9 if i % 40 < 4 else 0.0)
            else:
                odd = [0.0, None, float("inf"), float("nan"), 1e200]
                price = odd[i // 50 % 5] if i % 50 == 49 else 100 + rng.random()
            rows.append((ticker, "NYSE", FIRST + timedelta(days=i), 1.0, 2.0, 1.0, 1.5, 1, price))
    return spark.createDataFrame(rows, PRICES)


@pytest.mark.parametrize("k", [0.0, 1.0, 3.0])
@pytest.mark.parametrize("max_rows", [40, checks.MAX_ROWS])
def test_outliers_are_those_of_walked_frames(spark, k, max_rows):
    bars = odd_bars(spark)
    bars.createOrReplaceTempView("odd_bars")
    expected = spark.sql(f"""
        WITH returns AS (
            SELECT *, (CASE WHEN before <> 0 THEN adj_close / before ELSE adj_close * pow(before, -1D) END - 1) * 100 AS r
            FROM (SELECT *, lag(adj_close) OVER (PARTITION BY ticker ORDER BY date) AS before FROM odd_bars)),
        walked AS (
            SELECT *, avg(r) OVER trailing AS mean, stddev_samp(r) OVER trailing AS std FROM returns
            WINDOW trailing AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
        SELECT ticker, date, {checks.text.outlier_return_details('r', 'mean', 'std')} AS details
        FROM walked WHERE std > 0 AND abs(r - mean) > double('{k}') * std
    """)
    found = checks.outlier_return(bars, k=k, max_rows=max_rows).select("ticker", "date", "details")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    assert not expected.isEmpty()


@pytest.mark.parametrize("max_rows", [40, checks.MAX_ROWS])
def test_no_walk_and_no_lambda_for_every_bar(spark, max_rows):
    calendar = Calendar.of(spark, [("NYSE", FIRST)], ("NYSE",))
    flags = checks.all_flags(odd_bars(spark), calendar, max_rows=max_rows)
    nodes = [line.lstrip(" :+-*0123456789()") for line in flags._jdf.queryExecution().executedPlan().toString().splitlines()]
    windows = [node for node in nodes if node.startswith("Window")]
    assert windows and not any("stddev" in node or "avg(" in node for node in windows)
    copies = [node for node in nodes if node.startswith("Generate")]
    assert copies and not any("lambda" in node for node in copies)
