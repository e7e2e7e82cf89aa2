import math
import random
from datetime import date, timedelta

import duckdb
import pytest
from tests.bars import bar, prices_of, weekdays

import comparison_sql as sql
from barproof.functions import numeric, text
from barproof.operators import checks, summaries
from barproof.sources.calendar import Calendar

START = date(2026, 1, 5)
DAYS = weekdays(START, 6)


def rows(flags):
    return [tuple(r) for r in flags.select("date", "severity", "details").orderBy("date").collect()]


# --- missing dates --------------------------------------------------------------------------


def trading_days(count):
    return [d for d in weekdays(START, count + 1) if d != date(2026, 1, 19)][:count]


@pytest.mark.parametrize("keyed", [True, False])
def test_missing_dates(spark, calendar, keyed):
    days = trading_days(8)
    clean = prices_of(spark, [bar("AAA", d, 10.0 + i) for i, d in enumerate(days)])
    assert checks.missing_dates(clean, calendar, keyed).count() == 0
    dirty = clean.where(f"date <> DATE '{days[3]}'")
    assert rows(checks.missing_dates(dirty, calendar, keyed)) == [
        (days[3], "low", f"No price row found for expected trading day {days[3]}.")
    ]


def test_holidays_are_never_missing(spark, calendar):
    days = trading_days(14)
    assert days[-1] == date(2026, 1, 23)
    bars = [bar("AAA", d) for d in days]
    assert checks.missing_dates(prices_of(spark, bars), calendar).count() == 0
    # The same day is an ordinary one elsewhere.
    elsewhere = prices_of(spark, [{**b, "exchange": "LSE"} for b in bars])
    assert [r[0] for r in rows(checks.missing_dates(elsewhere, calendar))] == [date(2026, 1, 19)]


def test_only_inner_gaps_are_missing(spark, calendar):
    wide = prices_of(spark, [bar("AAA", d) for d in weekdays(START, 5)])
    late = prices_of(spark, [bar("BBB", d) for d in weekdays(date(2026, 2, 2), 2)])
    assert checks.missing_dates(wide.unionByName(late), calendar).count() == 0


def test_long_gap_and_weekend_bars(spark, calendar):
    found = checks.missing_dates(
        prices_of(spark, [bar("AAA", date(2026, 1, 3)), bar("AAA", date(2026, 3, 1))]), calendar
    )
    expected = [
        date(2026, 1, 3) + timedelta(days=i)
        for i in range(1, 57)
        if (date(2026, 1, 3) + timedelta(days=i)).weekday() < 5
    ]
    expected.remove(date(2026, 1, 19))
    assert [r[0] for r in rows(found)] == expected


@pytest.mark.parametrize("max_rows", [32, 10**6])
def test_unknown_exchange_is_an_error(spark, calendar, max_rows):
    bars = prices_of(spark, [bar("AAA", d, exchange="MOON") for d in weekdays(START, 40)])
    with pytest.raises(Exception, match="No trading calendar for exchange MOON"):
        checks.missing_dates(bars, calendar, max_rows=max_rows).collect()
    with pytest.raises(Exception, match="No trading calendar for exchange MOON"):
        checks.all_flags(bars, calendar, max_rows=max_rows).collect()


def test_exchange_without_any_holiday_is_known(spark):
    bars = prices_of(spark, [bar("AAA", d, exchange="LSE") for d in (DAYS[0], DAYS[2])])
    none = Calendar.of(spark, [], ("LSE",))
    assert checks.missing_dates(bars, none).count() == 1


# --- stale price ----------------------------------------------------------------------------


@pytest.mark.parametrize("keyed", [True, False])
def test_stale_price(spark, keyed):
    def series(closes):
        return prices_of(spark, [bar("AAA", d, float(c)) for d, c in zip(DAYS, closes)])

    assert checks.stale_price(series([10, 11, 12, 13, 14, 15]), 3, keyed).count() == 0
    assert rows(checks.stale_price(series([10, 11, 12, 12, 12, 12]), 3, keyed)) == [
        (DAYS[5], "medium", "close unchanged at 12.00 for 4 consecutive trading days")
    ]
    assert checks.stale_price(series([12] * 6), 3, keyed).count() == 3
    assert checks.stale_price(series([12] * 6), 5, keyed).count() == 1


def test_null_close_continues_a_streak_and_ends_it_for_the_next(spark):
    closes = [5.0, 5.0, None, None, 5.0, 5.0]
    flags = checks.stale_price(
        prices_of(spark, [bar("AAA", d, c) for d, c in zip(DAYS, closes)]), n=1
    )
    # Row 4 restarts after a NULL, and so does the row after it.
    assert rows(flags) == [
        (DAYS[1], "medium", "close unchanged at 5.00 for 2 consecutive trading days"),
        (DAYS[2], "medium", "close unchanged at nan for 3 consecutive trading days"),
        (DAYS[5], "medium", "close unchanged at 5.00 for 2 consecutive trading days"),
    ]


# --- outlier return -------------------------------------------------------------------------

def closes_after(returns, first=40.0):
    closes = [first]
    for value in returns:
        closes.append(closes[-1] * (1 + value / 100))
    return closes


@pytest.mark.parametrize("keyed", [True, False])
def test_outlier_return(spark, keyed):
    days = weekdays(START, 46)
    swell = [0.7 * math.sin(1.9 * i) for i in range(45)]

    def series(returns):
        return prices_of(spark, [bar("AAA", d, c) for d, c in zip(days, closes_after(returns))])

    assert checks.outlier_return(series(swell), 3.0, keyed).count() == 0
    # The crash of the 41st return is not held against the days after it.
    crash = [*swell[:40], -18.0, *swell[41:]]
    ((day, severity, details),) = rows(checks.outlier_return(series(crash), 3.0, keyed))
    assert (day, severity) == (days[41], "medium")
    past = swell[10:40]
    deviation = math.sqrt(sum((x - sum(past) / 30) ** 2 for x in past) / 29)
    assert details.startswith(f"daily return -18.00% vs trailing 30-day mean {sum(past) / 30:.2f}% (std {deviation:.2f}%)")
    assert details.endswith(f" {(-18 - sum(past) / 30) / deviation:.1f} std devs from mean")


def test_two_earlier_returns_are_needed(spark):
    bars = [bar("AAA", d, c) for d, c in zip(DAYS, [100.0, 101.0, 500.0])]
    assert checks.outlier_return(prices_of(spark, bars)).count() == 0


def test_zero_negative_and_null_previous_price_follow_ieee(spark):
    values = [0.0, 5.0, 0.0, 0.0, -0.0, -3.0, None, 2.0, -4.0]
    pairs = [(a, b) for a in values for b in values]
    frame = spark.createDataFrame(pairs, "a double, b double")
    got = frame.selectExpr("a", "b", f"{numeric.ieee_divide('a', 'b')} AS q").collect()
    for row in got:
        if row.a is None or row.b is None:
            assert row.q is None
        elif row.b != 0:
            assert row.q == row.a / row.b
        elif row.a == 0:
            assert math.isnan(row.q)
        else:
            sign = math.copysign(1, row.a) * math.copysign(1, row.b)
            assert row.q == sign * math.inf


# --- duplicates and bar rules ---------------------------------------------------------------


def test_duplicate_rows(spark):
    clean = [bar("AAA", d) for d in DAYS[:5]]
    assert checks.duplicate_rows(prices_of(spark, clean)).count() == 0
    assert rows(checks.duplicate_rows(prices_of(spark, [*clean, clean[2], clean[2]]))) == [
        (DAYS[2], "high", "3 duplicate rows found for this ticker/date combination")
    ]


def test_ohlc_inconsistency(spark):
    values = dict(open=10.0, high=12.0, low=8.0, close=11.0)
    clean = [bar("AAA", d, **values) for d in DAYS[:5]]
    assert checks.ohlc_inconsistency(prices_of(spark, clean)).count() == 0
    dirty = [dict(row) for row in clean]
    dirty[2]["high"] = 5.0
    assert rows(checks.ohlc_inconsistency(prices_of(spark, dirty))) == [
        (
            DAYS[2],
            "high",
            "high (5.00) < low (8.00); high (5.00) < open (10.00); high (5.00) < close (11.00)",
        )
    ]


def test_null_price_hides_only_its_own_rules(spark):
    bars = [
        bar("AAA", DAYS[0], open=None, high=1.0, low=2.0, close=1.5),
        bar("AAA", DAYS[1], open=None, high=None, low=2.0, close=None),
        bar("AAA", DAYS[2], open=1.0, high=None, low=2.0, close=1.0),
    ]
    assert rows(checks.ohlc_inconsistency(prices_of(spark, bars))) == [
        (DAYS[0], "high", "high (1.00) < low (2.00); high (1.00) < close (1.50); low (2.00) > close (1.50)"),
        (DAYS[2], "high", "low (2.00) > open (1.00); low (2.00) > close (1.00)"),
    ]


# --- number text ----------------------------------------------------------------------------


def test_fixed_decimals_round_the_exact_binary_value(spark):
    chosen = random.Random(7)
    values = [0.125, 0.375, 1.005, 2.675, -0.001, 0.0, -0.0, 0.05, 0.15, 0.25, 1e9 + 0.5, 12345.675]
    values += [round(chosen.uniform(-500, 500), chosen.choice([1, 2, 3, 4])) for _ in range(3000)]
    values += [n / 8 for n in range(-50, 50)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for decimals in (1, 2):
        got = frame.selectExpr("v", f"{text.fixed('v', decimals)} AS t").collect()
        assert [(r.v, r.t) for r in got] == [(r.v, f"{r.v:.{decimals}f}") for r in got]


def test_fixed_decimals_of_special_values(spark):
    special = [math.inf, -math.inf, math.nan, None]
    frame = spark.createDataFrame([(v,) for v in special], "v double").coalesce(1)
    assert [r[0] for r in frame.selectExpr(text.fixed("v", 2)).collect()] == ["inf", "-inf", "nan", "nan"]


# --- all checks together, whole and cut, against SQL ------------------------------------------


def random_bars(seed, tickers, length, repeats):
    """Bars with gaps, flat stretches, zeros, NULLs, broken rules, and repeated days if wanted."""
    chosen = random.Random(seed)
    bars = []
    for number in range(tickers):
        name = f"T{number}"
        day = START
        close = 10.0
        # The first ticker holds about a third of all bars.
        for _ in range(length * tickers // 2 if number == 0 else length):
            day += timedelta(days=chosen.choice([1, 1, 1, 1, 3, 6]))
            if chosen.random() < 0.6:
                close = chosen.choice([10.0, 11.0, 12.5, 0.0, 50.0, -1.0])
            row = bar(name, day, close, exchange="NYSE" if number % 2 else "LSE")
            if chosen.random() < 0.1:
                row["close"] = None
            if chosen.random() < 0.1:
                row["adj_close"] = None
            if chosen.random() < 0.05:
                row["high"] = row["low"] - 2
            bars.append(row)
            while repeats and chosen.random() < repeats:
                again = dict(row)
                if chosen.random() < 0.5:
                    again["close"] = again["adj_close"] = chosen.choice([10.0, 20.0, None])
                bars.append(again)
    chosen.shuffle(bars)
    return bars


def expected(bars, query):
    con = duckdb.connect()
    con.execute(
        "CREATE TABLE bars (ticker VARCHAR, exchange VARCHAR, date DATE, open DOUBLE, high DOUBLE, "
        "low DOUBLE, close DOUBLE, volume BIGINT, adj_close DOUBLE)"
    )
    con.executemany("INSERT INTO bars VALUES (?,?,?,?,?,?,?,?,?)", [list(b.values()) for b in bars])
    holidays = "WITH holidays AS (SELECT 'NYSE' AS exchange, DATE '2026-01-19' AS date)"
    result = con.execute(f"{holidays} {query}")
    return sorted(tuple(map(str, row)) for row in result.fetchall())


def got(df):
    return sorted(tuple(map(str, row)) for row in df.collect())


@pytest.mark.parametrize(
    "repeats, max_rows", [(0, 10**6), (0.3, 10**6), (0, 31), (0.3, 31), (0.3, 50), (0.6, 400)]
)
def test_all_checks_equal_sql(spark, calendar, repeats, max_rows):
    bars = random_bars(max_rows, 5, 60, repeats)
    flags = checks.all_flags(prices_of(spark, bars), calendar, n=2, k=2.0, max_rows=max_rows)
    parts = [
        sql.missing_dates("bars"),
        sql.stale_price("bars", 2),
        sql.outlier_return("bars", 2.0),
        sql.duplicate_rows("bars"),
        sql.ohlc_inconsistency("bars"),
    ]
    assert got(flags) == expected(bars, " UNION ALL ".join(f"({p})" for p in parts))


@pytest.mark.parametrize("max_rows", [31, 10**6])
def test_single_checks_equal_all_checks(spark, calendar, max_rows):
    prices = prices_of(spark, random_bars(3, 4, 50, 0.2))
    single = (
        checks.missing_dates(prices, calendar, max_rows=max_rows)
        .unionByName(checks.stale_price(prices, max_rows=max_rows))
        .unionByName(checks.outlier_return(prices, max_rows=max_rows))
        .unionByName(checks.duplicate_rows(prices))
        .unionByName(checks.ohlc_inconsistency(prices))
    )
    assert got(checks.all_flags(prices, calendar, max_rows=max_rows)) == got(single)


def test_streak_across_many_blocks(spark):
    days = weekdays(START, 300)
    flat = prices_of(spark, [bar("AAA", d, 7.0) for d in days])
    flags = checks.stale_price(flat, max_rows=20)
    assert flags.count() == 297
    assert flags.where("details LIKE '% for 300 consecutive%'").first().date == days[-1]


def test_group_of_exact_copies_is_spread(spark):
    """Copies of one bar fill most of the table; each still gets its own place in the order."""
    copies = prices_of(spark, [bar("AAA", DAYS[0], 7.0)]).crossJoin(spark.range(500)).drop("id")
    rest = prices_of(spark, [bar("AAA", d, float(i)) for i, d in enumerate(DAYS[1:])])
    flags = checks.stale_price(copies.unionByName(rest), max_rows=40)
    lengths = [int(r.details.split()[5]) for r in flags.collect()]
    assert sorted(lengths) == list(range(4, 501))


def test_blocks_must_hold_the_frame(spark):
    bars = prices_of(spark, [bar("AAA", d) for d in weekdays(START, 60)])
    with pytest.raises(ValueError, match="does not fit"):
        checks.outlier_return(bars, max_rows=10)


def test_empty_prices(spark, calendar):
    empty = prices_of(spark, [])
    for keyed in (True, False):
        flags = checks.all_flags(empty, calendar, keyed=keyed)
        assert flags.columns == ["ticker", "date", "flag_type", "severity", "details"]
        assert flags.count() == 0


def test_keyed_checks_shuffle_and_sort_once(spark, calendar, tmp_path):
    path = str(tmp_path / "prices")
    prices_of(spark, [bar("AAA", d) for d in DAYS]).write.parquet(path)
    flags = checks.all_flags(spark.read.parquet(path), calendar, keyed=True)
    plan = flags._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan


# --- summaries ------------------------------------------------------------------------------


def test_summaries(spark):
    prices = prices_of(
        spark, [bar("BBB", d, exchange="LSE") for d in DAYS[:4]] + [bar("AAA", d) for d in DAYS[1:3]]
    )
    assert [tuple(r) for r in summaries.ticker_summary(prices).collect()] == [
        ("AAA", 2, DAYS[1], DAYS[2]),
        ("BBB", 4, DAYS[0], DAYS[3]),
    ]
    assert tuple(summaries.scope_stats(prices).first()) == (DAYS[0], DAYS[3], 6)
    assert tuple(summaries.scope_stats(prices.limit(0)).first()) == (None, None, 0)
    assert tuple(summaries.ingest_counts(prices).first()) == (6, 2)
    assert [r[0] for r in summaries.tickers(prices).collect()] == ["AAA", "BBB"]
    assert summaries.repeated_keys(prices).count() == 0
