"""Price history around flagged days, for all flags at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barproof.functions.text import history_line
from barproof.operators.series import CONTEXT, MAX_ROWS, Series, arrange, measure
from barproof.schemas import BAR_VALUES, KEY, PRICE_COLUMNS

#: Bars on either side of the flagged one.
SPAN = 10

_ANCHOR = "_anchor"
#: 0 for a target, which comes first among the rows of its day, 1 for a bar.
_BAR = "_is_bar"


def _anchored(prices: DataFrame, targets: DataFrame, keyed: bool, max_rows: int, span: int):
    """Arrange the bars of tickers that have targets, marking the bars on a target day.

    Targets are rows among the bars, so that one sweep in the order of days marks what it meets: the
    cost is that of bars and targets, in the one shuffle that the windows need. Only where series
    are too long for a task, bars and targets are joined by ticker and day instead.
    """
    days = targets.where("date IS NOT NULL").select(*KEY).distinct()
    # Few tickers are broadcast and drop the bars of all others before any shuffle.
    wanted = prices.select(*PRICE_COLUMNS).join(days.select("ticker").distinct(), "ticker", "left_semi")
    layout = measure(prices, keyed, max_rows)
    if layout.cut:
        marked = wanted.join(days.withColumn(_ANCHOR, F.lit(True)), KEY, "left")
        marked = marked.selectExpr(*PRICE_COLUMNS, f"coalesce({_ANCHOR}, false) AS {_ANCHOR}")
        series = arrange(marked, keyed, max_rows, extra_columns=(_ANCHOR,), layout=layout)
    else:
        both = wanted.withColumn(_BAR, F.lit(1)).unionByName(
            days.withColumn(_BAR, F.lit(0)), allowMissingColumns=True
        )
        arranged = arrange(both, keyed, max_rows, layout=layout)
        sweep = Series(arranged.rows, ["date", _BAR, *arranged.order[1:]])
        last = f"max(CASE WHEN {_BAR} = 0 THEN date END) {sweep.over('UNBOUNDED PRECEDING', 'CURRENT ROW')}"
        met = sweep.rows.selectExpr("*", f"coalesce({last} = date, false) AS {_ANCHOR}")
        series = Series(met.where(f"{_BAR} = 1"), sweep.order)
    return series, series.with_context(before=span, after=span)


def _collect_around(series: Series, df: DataFrame, span: int, bar: str) -> DataFrame:
    """Keep the anchors, each with ``history``: ``bar`` of its surrounding bars in order.

    ``bar`` is computed once for each bar in reach, however many windows it is in.
    """
    around = series.over(f"{span} PRECEDING", f"{span} FOLLOWING")
    until = series.over("UNBOUNDED PRECEDING", f"{span} FOLLOWING")
    before = series.over("UNBOUNDED PRECEDING", f"{span + 1} PRECEDING")
    # Every bar within reach of an anchor survives this filter, so frames around anchors stay whole,
    # while arrays are built only near anchors. Two growing frames count the anchors in reach, with
    # one update per row instead of one per row and frame member.
    return (
        df.selectExpr(
            "*", f"count_if({_ANCHOR}) {until} - count_if({_ANCHOR}) {before} AS _anchors_in_reach"
        )
        .where("_anchors_in_reach > 0")
        .selectExpr("*", f"{bar} AS _bar")
        .selectExpr("*", f"collect_list(_bar) {around} AS history")
        .where(f"{_ANCHOR} AND NOT {CONTEXT}")
    )


def price_window(
    prices: DataFrame,
    targets: DataFrame,
    span: int = SPAN,
    keyed: bool = False,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Bars up to ``span`` rows before and after each distinct target (ticker, date).

    A target without a bar on its very day yields nothing. Each bar on a target day opens a window
    of its own, should a day be repeated.
    """
    bar = f"struct(date, {', '.join(BAR_VALUES)})"
    anchors = _collect_around(*_anchored(prices, targets, keyed, max_rows, span), span, bar)
    return anchors.selectExpr("ticker", "date AS target_date", "inline(history)")


def history_lines(prices: DataFrame, targets: DataFrame, span: int = SPAN) -> DataFrame:
    """One row per target day that has a bar, with ``history``: its surrounding bars as lines.

    The prices must be keyed; a repeated day fails the query rather than doubling a history.
    """
    bar = f"struct(date, {history_line()} AS line)"
    anchors = _collect_around(*_anchored(prices, targets, True, MAX_ROWS, span), span, bar)
    unique = (
        "CASE WHEN size(array_distinct(history.date)) = size(history) THEN history "
        "ELSE raise_error(concat('Repeated day in the bars of ', ticker)) END"
    )
    return anchors.selectExpr(*KEY, f"({unique}).line AS history")
