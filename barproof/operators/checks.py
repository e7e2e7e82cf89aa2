"""The five quality checks, each as a DataFrame of flags, and all of them in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barproof.functions import text
from barproof.functions.numeric import ieee_divide, is_weekday, weekdays_before
from barproof.operators.series import BLOCK, CONTEXT, MAX_ROWS, POSITION, Series, arrange
from barproof.schemas import FLAG_COLUMNS
from barproof.session import materialize
from barproof.sources.calendar import Calendar

# Flag types with their severities, in check order.
SEVERITY = {
    "MISSING_DATES": "low",
    "STALE_PRICE": "medium",
    "OUTLIER_RETURN": "medium",
    "DUPLICATE_ROW": "high",
    "OHLC_INCONSISTENCY": "high",
}

#: Returns the trailing frame looks back on, not counting the bar itself.
TRAILING = 30
#: Bars a row's windows reach back: the trailing returns, and the bar before the first of them.
REACH = TRAILING + 1


def _as_flags(df: DataFrame, flag_type: str, details: str) -> DataFrame:
    return df.selectExpr(
        "ticker",
        "date",
        f"'{flag_type}' AS flag_type",
        f"'{SEVERITY[flag_type]}' AS severity",
        f"{details} AS details",
    )


# --- columns computed over a ticker's series ------------------------------------------------


def _neighbours(series: Series, before: int) -> DataFrame:
    """Each bar with the ones next to it, and its place where a streak or a day starts with it."""
    over = series.over()
    df = series.with_context(before=before, after=1).selectExpr(
        "*",
        f"lag(close) {over} AS _previous_close",
        f"lag(adj_close) {over} AS _previous_adj",
        f"lag(date) {over} AS previous_date",
        f"lead(date) {over} AS _next_date",
    )
    # A streak starts where the previous close is NULL or differs. A NULL close itself does not
    # differ from anything, so it continues the streak. Context rows do not count as starts, since
    # their own previous bar may be out of sight.
    starts_streak = f"NOT {CONTEXT} AND (_previous_close IS NULL OR close <> _previous_close)"
    starts_day = f"NOT {CONTEXT} AND (previous_date IS NULL OR date <> previous_date)"
    return df.selectExpr(
        "*",
        f"CASE WHEN {starts_streak} THEN {POSITION} END AS _streak_start",
        f"CASE WHEN {starts_day} THEN {POSITION} END AS _day_start",
    )


def _carried(series: Series) -> DataFrame:
    """For each block of cut series, what the ticker's earlier blocks hand on to it.

    A prefix scan over block summaries: the last start of a streak and of a day before the block,
    and the ticker's exchange. One row per block, written once.
    """
    blocks = (
        _neighbours(series, before=1)
        .where(f"NOT {CONTEXT}")
        .groupBy("ticker", BLOCK)
        .agg(
            F.min("exchange").alias("_least_exchange"),
            F.max("_streak_start").alias("_last_streak"),
            F.max("_day_start").alias("_last_day"),
        )
    )
    earlier = f"OVER (PARTITION BY ticker ORDER BY {BLOCK} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return materialize(
        blocks.selectExpr(
            "ticker",
            BLOCK,
            f"max(_last_streak) {earlier} AS _carried_streak",
            f"max(_last_day) {earlier} AS _carried_day",
            "min(_least_exchange) OVER (PARTITION BY ticker) AS _exchange",
        )
    )


def _may_be_outlier(k: float) -> str:
    """False only where a return is surely within ``k`` deviations of its trailing mean.

    The trailing sums are differences of running sums over ``_n`` returns, so each is off by some
    ``_n`` roundings of the whole sum at most; the margins are far wider than these and than what
    the exact mean and deviation are off themselves. What is not finite may always be an outlier.
    """
    n = "greatest(size(_trailing), 1)"
    total, squares = "(_sum - coalesce(_sum_before, 0D))", "(_squares - coalesce(_squares_before, 0D))"
    off, off_squares = "(1e-14D * _n * sqrt(_n * _squares))", "(1e-14D * _n * _squares)"
    least = f"({squares} - {off_squares} - (abs({total}) + {off}) * (abs({total}) + {off}) / {n})"
    distance = f"(abs(pct_return - {total} / {n}) + 2 * {off} / {n}) * 1.00001D"
    within = f"{distance} <= double('{float(k)}') * sqrt({least} / greatest({n} - 1, 1))"
    sure = f"_squares < double('Infinity') AND {least} > 1e-8D * {squares} AND {within}"
    return f"size(_trailing) > 1 AND NOT coalesce({sure}, false)"


def _mean(values: str) -> str:
    """As ``avg`` does it, step by step."""
    return f"aggregate({values}, 0D, (total, x) -> total + x) / size({values})"


def _deviation(values: str) -> str:
    """As ``stddev_samp`` does it, step by step; for two values or more."""
    step = (
        "named_struct('n', s.n + 1D, 'mean', s.mean + (x - s.mean) / (s.n + 1D), "
        "'squares', s.squares + (x - s.mean) * ((x - s.mean) - (x - s.mean) / (s.n + 1D)))"
    )
    start = "named_struct('n', 0D, 'mean', 0D, 'squares', 0D)"
    return f"aggregate({values}, {start}, (s, x) -> {step}, s -> sqrt(s.squares / (s.n - 1D)))"


def _profile(series: Series, before: int, k: float = 3.0) -> DataFrame:
    """Add to each bar what the checks need to know about the bars around it.

    All windows share one layout, so they cost one shuffle and one sort, and run as two operators:
    neighbours first, then running values. Columns that a check does not use are pruned. The
    trailing mean and deviation are given for returns that may be ``k`` deviations off, else NULL:
    running sums leave out most returns, and walking 30 bars for each costs more than all the rest.
    """
    df = _neighbours(series, before)
    skipped = f"{weekdays_before('date')} - {weekdays_before('date_add(previous_date, 1)')}"
    df = df.selectExpr(
        "*",
        f"({ieee_divide('adj_close', '_previous_adj')} - 1) * 100 AS pct_return",
        f"CASE WHEN datediff(date, previous_date) > 1 THEN {skipped} ELSE 0 END AS weekdays_skipped",
    )
    so_far = series.over("UNBOUNDED PRECEDING", "CURRENT ROW")
    trailing = series.over(f"{TRAILING} PRECEDING", "1 PRECEDING")
    until_last = series.over("UNBOUNDED PRECEDING", "1 PRECEDING")
    until_trailing = series.over("UNBOUNDED PRECEDING", f"{TRAILING + 1} PRECEDING")
    streak, day = f"max(_streak_start) {so_far}", f"max(_day_start) {so_far}"
    if series.is_cut:
        df = df.join(_carried(series), ["ticker", BLOCK])
        streak, day = f"coalesce({streak}, _carried_streak)", f"coalesce({day}, _carried_day)"
    else:
        exchange = f"min(exchange) {series.over('UNBOUNDED PRECEDING', 'UNBOUNDED FOLLOWING')}"
        df = df.selectExpr("*", f"{exchange} AS _exchange")
    return df.selectExpr(
        "*",
        f"{POSITION} - {streak} + 1 AS streak_length",
        f"{POSITION} - {day} + 1 AS occurrences",
        f"collect_list(pct_return) {trailing} AS _trailing",
        f"count(pct_return) {until_last} AS _n",
        f"sum(pct_return) {until_last} AS _sum",
        f"sum(pct_return * pct_return) {until_last} AS _squares",
        f"sum(pct_return) {until_trailing} AS _sum_before",
        f"sum(pct_return * pct_return) {until_trailing} AS _squares_before",
    ).selectExpr(
        "*",
        f"CASE WHEN {_may_be_outlier(k)} THEN {_mean('_trailing')} END AS rolling_mean",
        f"CASE WHEN {_may_be_outlier(k)} THEN {_deviation('_trailing')} END AS rolling_std",
    )


def _has_stale_price(n: int) -> str:
    return f"streak_length > {int(n)}"


def _is_outlier(k: float) -> str:
    return (
        "rolling_std > 0 AND "
        f"abs(pct_return - rolling_mean) > double('{float(k)}') * rolling_std"
    )


HAS_GAP = "weekdays_skipped > 0"
# The last bar of a day knows how many there were.
IS_REPEATED_DAY = "occurrences > 1 AND (_next_date IS NULL OR _next_date <> date)"
DAYS_BETWEEN = "sequence(date_add(previous_date, 1), date_sub(date, 1))"
STALE_DETAILS = text.stale_price_details("close", "streak_length")
RETURN = ("pct_return", "rolling_mean", "rolling_std")
OUTLIER_DETAILS = text.outlier_return_details(*RETURN)


# --- single checks --------------------------------------------------------------------------


def ticker_bounds(prices: DataFrame) -> DataFrame:
    """First and last day of each ticker, with its exchange (the smallest, if it has several)."""
    return prices.groupBy("ticker").agg(
        F.min("exchange").alias("exchange"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
    )


def missing_dates(
    prices: DataFrame, calendar: Calendar, keyed: bool = False, max_rows: int = MAX_ROWS
) -> DataFrame:
    """Flag trading days inside a ticker's own range that have no bar.

    Neighbouring bars already show every gap, so no table of expected days is built: only the days
    inside a gap are generated.
    """
    return _missing_dates(arrange(prices, keyed, max_rows), calendar)


def _missing_dates(series: Series, calendar: Calendar) -> DataFrame:
    df = _profile(series, before=1).where(f"NOT {CONTEXT}").where(calendar.known("_exchange"))
    days = (
        df.where(HAS_GAP)
        .selectExpr("ticker", "_exchange", f"explode({DAYS_BETWEEN}) AS date")
        .where(is_weekday("date"))
    )
    expected = calendar.drop_holidays(days, "_exchange")
    return _as_flags(expected, "MISSING_DATES", text.missing_date_details("date"))


def stale_price(
    prices: DataFrame, n: int = 3, keyed: bool = False, max_rows: int = MAX_ROWS
) -> DataFrame:
    """Flag every bar that extends a run of equal closes beyond ``n``."""
    return _stale_price(arrange(prices, keyed, max_rows), n)


def _stale_price(series: Series, n: int) -> DataFrame:
    stale = _profile(series, before=1).where(f"NOT {CONTEXT} AND {_has_stale_price(n)}")
    return _as_flags(stale, "STALE_PRICE", STALE_DETAILS)


def outlier_return(
    prices: DataFrame, k: float = 3.0, keyed: bool = False, max_rows: int = MAX_ROWS
) -> DataFrame:
    """Flag returns more than ``k`` deviations away from the mean of the trailing 30 returns."""
    return _outlier_return(arrange(prices, keyed, max_rows), k)


def _outlier_return(series: Series, k: float) -> DataFrame:
    outliers = _profile(series, before=REACH, k=k).where(f"NOT {CONTEXT} AND {_is_outlier(k)}")
    return _as_flags(outliers, "OUTLIER_RETURN", OUTLIER_DETAILS)


def duplicate_rows(prices: DataFrame) -> DataFrame:
    """Flag each (ticker, date) that occurs more than once."""
    repeated = prices.groupBy("ticker", "date").count().where("count > 1")
    return _as_flags(repeated, "DUPLICATE_ROW", text.duplicate_row_details("count"))


def ohlc_inconsistency(prices: DataFrame) -> DataFrame:
    """Flag bars whose prices contradict each other."""
    broken = prices.where(text.breaks_bar_rule())
    return _as_flags(broken, "OHLC_INCONSISTENCY", text.bar_rule_details())


# --- all checks -----------------------------------------------------------------------------


def all_flags(
    prices: DataFrame,
    calendar: Calendar,
    n: int = 3,
    k: float = 3.0,
    keyed: bool = False,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """All five checks as one set of flags, duplicates kept.

    The series are shuffled and sorted once for all five checks: every bar yields its
    flags. Cut series do so block by block, with what a prefix scan over the blocks hands on.
    """
    return _all_flags_in_one_pass(arrange(prices, keyed, max_rows), calendar, n, k)


def _all_flags_in_one_pass(series: Series, calendar: Calendar, n: int, k: float) -> DataFrame:
    on_this_bar = [
        ("STALE_PRICE", _has_stale_price(n), STALE_DETAILS),
        ("OUTLIER_RETURN", _is_outlier(k), text.outlier_return_details(*RETURN, "_distance")),
        ("DUPLICATE_ROW", IS_REPEATED_DAY, text.duplicate_row_details("occurrences")),
        ("OHLC_INCONSISTENCY", text.breaks_bar_rule(), text.bar_rule_details("_{}_text".format)),
    ]
    bars = _profile(series, before=REACH, k=k).where(f"NOT {CONTEXT}").where(calendar.known("_exchange"))
    # A plain filter first: most bars have no flag.
    any_flag = " OR ".join(f"({condition})" for _, condition, _ in on_this_bar)
    # Each bar once for each check on it (numbers below 0), and once for each day of the gap before it.
    # Plain numbers instead of arrays of flags: texts are built for flags alone, in generated code.
    in_the_gap = f"CASE WHEN {HAS_GAP} THEN datediff(date, previous_date) - 2 ELSE -1 END"
    numbered = bars.where(f"{HAS_GAP} OR {any_flag}").selectExpr(
        "*", f"explode(sequence(-{len(on_this_bar)}, {in_the_gap})) AS _number"
    )
    day = "date_add(previous_date, _number + 1)"

    def by_check(values: list[str], missing: str) -> str:
        cases = " ".join(f"WHEN {i - len(values)} THEN {value}" for i, value in enumerate(values))
        return f"CASE _number {cases} ELSE {missing} END"

    def named(values: list[str]) -> str:
        return f"array({', '.join(map(text.quoted, values))})[least(_number, 0) + {len(on_this_bar)}]"

    types = [flag_type for flag_type, _, _ in on_this_bar] + ["MISSING_DATES"]
    # What a text needs several times is a column first: Java compiles no method beyond 8,000 bytes.
    parts = [f"CASE WHEN _number = -1 THEN {text.fixed(c, 2)} END AS _{c}_text" for c in ("open", "high", "low", "close")]
    parts.append(f"CASE WHEN _number = -3 THEN {text.deviations(*RETURN)} END AS _distance")
    wanted = numbered.where(by_check([c for _, c, _ in on_this_bar], is_weekday(day))).selectExpr("*", *parts)
    flags = wanted.selectExpr(
        "ticker",
        "_exchange",
        f"CASE WHEN _number < 0 THEN date ELSE {day} END AS date",
        f"{named(types)} AS flag_type",
        f"{named([SEVERITY[t] for t in types])} AS severity",
        f"{by_check([d for _, _, d in on_this_bar], text.missing_date_details(day))} AS details",
    )
    # Only missing days are compared with the holidays; a NULL exchange matches none.
    flags = flags.selectExpr(
        "*", "CASE WHEN flag_type = 'MISSING_DATES' THEN _exchange END AS _calendar"
    )
    return calendar.drop_holidays(flags, "_calendar").select(*FLAG_COLUMNS)
