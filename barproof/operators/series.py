"""Date-ordered series of each ticker, laid out so that no task holds more than it can sort.

Window functions over ``partitionBy("ticker")`` put a whole ticker into one task. That is safe for
*keyed* prices: with one bar per ticker and day, a series is never longer than the calendar, however
large the table is. Unkeyed prices have no such bound, so there the largest ticker is measured, and
if it is too long every series is cut into blocks of consecutive rows. Blocks carry copies of their
neighbours' rows as context, so a row-based frame sees exactly the rows it would see in the uncut
series.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barproof.schemas import BAR_VALUES, PRICE_COLUMNS
from barproof.session import materialize

#: Rows of one ticker (or one block) that a single task may sort; about 200 MB of bars.
MAX_ROWS = 2_000_000

POSITION = "_position"
BLOCK = "_block"
CONTEXT = "_context"


@dataclass(frozen=True)
class Series:
    """Bars arranged for window functions.

    ``rows`` holds the bars; when the series are cut, also their position in the total order.
    """

    rows: DataFrame
    order: list[str]
    block_rows: int | None = None

    @property
    def is_cut(self) -> bool:
        return self.block_rows is not None

    @property
    def keys(self) -> list[str]:
        return ["ticker", BLOCK] if self.is_cut else ["ticker"]

    def over(self, first: str = "", last: str = "") -> str:
        """The OVER clause of a window along the series, with a frame of rows if one is given."""
        frame = f" ROWS BETWEEN {first} AND {last}" if first else ""
        return f"OVER (PARTITION BY {', '.join(self.keys)} ORDER BY {', '.join(self.order)}{frame})"

    def with_context(self, before: int = 0, after: int = 0) -> DataFrame:
        """Return rows with ``_position``, plus context copies if the series are cut.

        ``before`` and ``after`` say how many neighbouring rows a frame reaches. Context copies are
        marked in ``_context`` and must be dropped once the windows are computed.
        """
        if not self.is_cut:
            return self.rows.selectExpr(
                "*", f"bigint(row_number() {self.over()}) AS {POSITION}", f"false AS {CONTEXT}"
            )
        size = self.block_rows
        if max(before, after) > size:
            raise ValueError(f"A frame of {max(before, after)} rows does not fit blocks of {size}.")
        place = f"pmod({POSITION}, {size})"
        first, last = f"{place} < {after}", f"{place} >= {size - before}"
        # Constant arrays, and no lambda: the copies are made in generated code.
        steps = (
            f"CASE WHEN {first} AND {last} THEN array(-1, 0, 1) WHEN {first} THEN array(-1, 0) "
            f"WHEN {last} THEN array(0, 1) ELSE array(0) END"
        )
        return self.rows.selectExpr("*", f"explode({steps}) AS _step").selectExpr(
            *self.rows.columns, f"{POSITION} div {size} + _step AS {BLOCK}", f"_step <> 0 AS {CONTEXT}"
        )


@dataclass(frozen=True)
class Layout:
    """How many tasks the bars are for, and whether a ticker has too many for one."""

    cut: bool = False
    tasks: int = 0


def measure(prices: DataFrame, keyed: bool = False, max_rows: int = MAX_ROWS) -> Layout:
    """One small count per ticker, unless (ticker, date) is known to be unique."""
    if keyed:
        return Layout()
    sizes = prices.groupBy("ticker").count()
    found = sizes.agg(F.max("count").alias("largest"), F.sum("count").alias("total")).first()
    if found.largest is None:
        return Layout()
    return Layout(found.largest > max_rows, -(-found.total // MAX_ROWS))


def arrange(
    prices: DataFrame,
    keyed: bool = False,
    max_rows: int = MAX_ROWS,
    extra_columns: tuple[str, ...] = (),
    layout: Layout | None = None,
) -> Series:
    """Arrange bars into series.

    Pass ``keyed=True`` when (ticker, date) is known to be unique: the stored ``prices`` table, or
    an aggregate grouped by that key. Otherwise one small count per ticker decides about cutting.
    Bars of one ticker and day are ordered by their values, so results never depend on task order.
    """
    if keyed:
        return Series(prices, ["date"])
    layout = layout or measure(prices, keyed, max_rows)
    order = ["date", *BAR_VALUES, *extra_columns]
    usual = int(prices.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not layout.cut:
        return Series(prices.repartition(layout.tasks, "ticker") if layout.tasks > usual else prices, order)
    columns = [*PRICE_COLUMNS, *extra_columns]
    rows = number_rows(prices.select(*columns), ["ticker", *order], max(usual, layout.tasks))
    return Series(rows, [POSITION], max_rows)


def number_rows(df: DataFrame, order: list[str], parts: int) -> DataFrame:
    """Number all rows in total order without bringing any key into one task.

    Range partitioning samples the sort key, so a key that holds a third of the rows is spread over
    many partitions. The input partition breaks the tie between exact copies, which lets Spark
    spread even those. Writing the table fixes the sampled ranges before numbers are derived.
    """
    placed = materialize(
        df.withColumn("_source", F.spark_partition_id())
        .repartitionByRange(parts, *order, "_source")
        .sortWithinPartitions(*order)
        .drop("_source")
        .withColumn("_id", F.monotonically_increasing_id())
    ).selectExpr("*", "shiftright(_id, 33) AS _part", f"_id & {(1 << 33) - 1} AS _place")
    # One row per range partition; written, so that its size is known where it is joined.
    until = "OVER (ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    counts = placed.groupBy("_part").count()
    offsets = materialize(counts.selectExpr("_part", f"coalesce(sum(count) {until}, 0) AS _offset"))
    return (
        placed.join(offsets, "_part")
        .selectExpr("*", f"_offset + _place AS {POSITION}")
        .drop("_id", "_part", "_place", "_offset")
    )
