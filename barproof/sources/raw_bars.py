"""Landed daily bars: scanning, look-back, and the match against the universe."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from datetime import date
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyarrow import fs, orc, parquet
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barproof.functions.numeric import nan_to_null
from barproof.functions.text import quoted
from barproof.session import materialize
from barproof.sources.tables import is_folder

# Raw column names and the price columns they become.
RAW_COLUMNS = {
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Volume": "volume",
    "Adj Close": "adj_close",
}

RAW = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("Date", T.TimestampType()),
        *[T.StructField(name, T.DoubleType()) for name in RAW_COLUMNS],
    ]
)

class TickerDataUnavailable(RuntimeError):
    """No landed bars were found for any configured ticker; ``missing`` is the table of them all."""

    def __init__(self, message: str, missing: DataFrame):
        super().__init__(message)
        self.missing = missing


#: Bytes read at a time to find the end of a header line.
HEADER_BYTES = 1 << 16

#: Columns that tell about a row where rejects are wanted: the text that can't be parsed, and its file.
BROKEN, FILE = "_broken", "_file"


def _layout(uri: str, fmt: str) -> str | None:
    """What tells a file's columns: its header line, or its schema; None if Python can't open it."""
    local = uri.removeprefix("file:") if uri.startswith("file:") else None
    try:
        if local is not None:
            files, path = fs.LocalFileSystem(), "/" + unquote(local).lstrip("/")
        else:
            files, path = fs.FileSystem.from_uri(uri)
        if fmt == "csv":
            with files.open_input_stream(path) as stream:
                line = b""
                while b"\n" not in line and (more := stream.read(HEADER_BYTES)):
                    line += more
            return line.partition(b"\n")[0].rstrip(b"\r").decode()
        with files.open_input_file(path) as file:
            schema = parquet.read_schema(file) if fmt == "parquet" else orc.ORCFile(file).schema
        return schema.remove_metadata().to_string()
    except (pa.ArrowException, OSError, ValueError):
        return None


def inventory(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """The files below ``path``, each with its layout; only headers are read, by the executors.

    The layout is NULL for files in a store that Python can't open.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_layout(uri, fmt) for uri in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(found, pa.string())], names=["file", "layout"])

    files = spark.read.format("binaryFile").load(path).select("path")
    return files.mapInArrow(run, "file string, layout string")


def _layouts(spark: SparkSession, path: str, fmt: str) -> dict[str | None, list[str]]:
    """The files of each layout, from one job. A lone layout has no list: then all files have it."""
    found = materialize(inventory(spark, path, fmt))
    kinds = [row.layout for row in found.select("layout").distinct().orderBy("layout").collect()]
    if len(kinds) == 1:
        return {kinds[0]: []}
    # As Spark itself, which lists what it reads, the driver holds the names of the files.
    by_kind = found.groupBy("layout").agg(F.sort_array(F.collect_list("file")).alias("files"))
    return {row.layout: row.files for row in by_kind.orderBy("layout").toLocalIterator()}


def _first_lines(spark: SparkSession, path: str | list[str]) -> dict[str, list[str]]:
    """The files of each header line by Spark's own reading of all lines, for stores only it opens."""
    lines = (
        spark.read.text(path)
        .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
        .where("at = 0")
        .withColumn("line", F.monotonically_increasing_id())
    )
    first = lines.groupBy("file").agg(F.min_by("value", "line").alias("header"))
    found: dict[str, list[str]] = {}
    for row in first.orderBy("file").toLocalIterator():
        found.setdefault(row.header, []).append(row.file)
    return found


def _csv_headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files of each distinct header line; no files where all have the same."""
    found = _layouts(spark, path, "csv")
    unread = found.pop(None, None)
    if unread is not None:
        for header, files in _first_lines(spark, unread or path).items():
            found.setdefault(header, []).extend(files)
    return {header: files for header, files in found.items() if header}


def _schemas(spark: SparkSession, path: str, fmt: str) -> list[tuple[T.StructType, list[str]]]:
    """The files of each distinct schema, which Spark reads from one of them."""
    reader = spark.read.option("basePath", path) if is_folder(spark, path) else spark.read
    found: dict[str, tuple[T.StructType, list[str]]] = {}
    for layout, files in _layouts(spark, path, fmt).items():
        files = files or list(spark.read.format(fmt).load(path).inputFiles())
        for few in [files] if layout is not None else [[file] for file in files]:
            schema = reader.format(fmt).load(few[0]).schema
            found.setdefault(schema.json(), (schema, []))[1].extend(few)
    return list(found.values())


def _by_name(parts: list[DataFrame]) -> DataFrame:
    """Put parts with different columns together by name; numbers of different kinds become double."""
    kinds: dict[str, set[str]] = {}
    for part in parts:
        for name, kind in part.dtypes:
            kinds.setdefault(name, set()).add(kind)
    mixed = {name for name, found in kinds.items() if len(found) > 1 and name in RAW_COLUMNS}
    return reduce(
        lambda one, two: one.unionByName(two, allowMissingColumns=True),
        [part.withColumns({n: F.col(f"`{n}`").cast("double") for n in mixed & set(part.columns)}) for part in parts],
    )


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet", rejects: bool = False) -> DataFrame:
    """Scan landed bars (``parquet``, ``orc``, ``csv`` or ``json``); price columns may be absent.

    The symbol is a column of the files or of a ``symbol=...`` folder. Columns are taken by name file
    by file: their order may differ, a file may lack some, and a volume may be whole in one file and
    fractional in another. Files are sorted by their headers on the executors, so any number of
    small files takes a few jobs. Rows that can't be parsed fail the job that reads them; with
    ``rejects`` they are rows with their text in ``_broken``, and every row has its ``_file``, for
    :func:`sorted_bars`.
    """
    reader = spark.read.option("mode", "PERMISSIVE" if rejects else "FAILFAST").option("columnNameOfCorruptRecord", BROKEN)
    if is_folder(spark, path):
        reader = reader.option("basePath", path)

    def scanned(reader, files, schema: T.StructType | None = None) -> DataFrame:
        if schema is not None and rejects and fmt in ("csv", "json"):
            schema = T.StructType([*schema, T.StructField(BROKEN, T.StringType())])
        rows = (reader if schema is None else reader.schema(schema)).format(fmt).load(files)
        return rows.select("*", F.col("_metadata.file_path").alias(FILE)) if rejects else rows

    if fmt in ("parquet", "orc"):
        try:
            return scanned(reader.option("mergeSchema", "true"), path)
        except (PySparkException, Py4JJavaError) as error:
            if "CANNOT_MERGE" not in str(error):
                raise
        return _by_name([scanned(reader, files, schema) for schema, files in _schemas(spark, path, fmt)])
    if fmt == "csv":
        # Names come from each file's header, types from normalising.
        reader = reader.option("header", True).option("enforceSchema", False)
        parts = []
        for header, files in _csv_headers(spark, path).items():
            names = next(csv.reader([header.removeprefix("\ufeff")]))
            parts.append(scanned(reader, files or path, T.StructType([T.StructField(n, T.StringType()) for n in names])))
        return _by_name(parts) if parts else spark.createDataFrame([], RAW)
    if fmt == "json":
        # Dates stay texts, which tell a moment in time from a plain day.
        kinds = [T.StructField("Date", T.StringType()) if f.name == "Date" else f for f in RAW]
        return scanned(reader, path, T.StructType(kinds))
    raise ValueError(f"Unknown format {fmt!r} of landed bars.")


def first_day(period: str, last: date | Column) -> Column | None:
    """First day of a look-back such as ``5d``, ``1mo``, ``2y``, ``ytd``; None for ``max``."""
    if period == "max":
        return None
    last = last if isinstance(last, Column) else F.lit(last)
    if period == "ytd":
        return F.trunc(last, "year")
    match = re.fullmatch(r"(\d+)(d|mo|y)", period)
    if not match:
        raise ValueError(f"Unknown look-back period {period!r}.")
    number = int(match[1])
    if match[2] == "d":
        return F.date_sub(last, number - 1)
    return F.add_months(last, -number * (12 if match[2] == "y" else 1))


def look_back(raw: DataFrame, period: str, as_of: date) -> DataFrame:
    """Landed bars that may belong to the period, by a plain comparison that reaches the scan.

    Local days can differ from the session's by one, so a day of slack is kept.
    """
    first = first_day(period, as_of)
    if first is None:
        return raw
    # Constant folding turns the bound into a literal of the column's own type.
    return raw.where(F.col("Date") >= F.date_sub(first, 1).cast(raw.schema["Date"].dataType))


#: A time of day with its distance from UTC at the end of a text.
ZONED_TEXT = r"\\d[T ]\\d{1,2}:.*(Z|[+-]\\d{2}(:?\\d{2})?)$"


def _zoned(universe: DataFrame, zones: dict[str, str] | None) -> DataFrame:
    """The universe with the zone of each exchange, or NULL: decided per symbol, not per bar."""
    cases = " ".join(f"WHEN {quoted(name)} THEN {quoted(zone)}" for name, zone in (zones or {}).items())
    return universe.selectExpr("symbol", "exchange", f"{f'CASE exchange {cases} END' if cases else 'string(NULL)'} AS _zone")


def _local_date(raw: DataFrame, zones: dict[str, str] | None, cast: str = "CAST") -> str:
    """The day of a bar on the clock of its exchange.

    A moment in time (a timestamp, or a text with a zone) has a day only with a zone for its exchange.
    """
    kind = raw.schema["Date"].dataType
    known = "_zone"
    if cast == "CAST":
        known = "coalesce(_zone, raise_error(concat('No time zone for exchange ', exchange)))"
    moment = f"CAST({cast}(Date AS TIMESTAMP) AS TIMESTAMP_NTZ)"
    local = f"to_date(convert_timezone(current_timezone(), {known}, {moment}))"
    if isinstance(kind, T.TimestampType):
        if not zones:
            raise ValueError("Bars with moments in time need the time zones of their exchanges.")
        return local
    if isinstance(kind, T.StringType):
        return f"CASE WHEN Date RLIKE '{ZONED_TEXT}' THEN {local} ELSE to_date({cast}(Date AS TIMESTAMP_NTZ)) END"
    return "to_date(Date)"


def _values(raw: DataFrame, cast: str = "CAST") -> dict[str, str]:
    """The price columns as expressions over the raw ones."""
    out = {}
    for source, target in RAW_COLUMNS.items():
        kind = "bigint" if target == "volume" else "double"
        if source not in raw.columns:
            value = "NULL"
        elif kind == "bigint" and isinstance(raw.schema[source].dataType, T.IntegralType):
            value = f"`{source}`"
        else:
            value = nan_to_null(f"{cast}(`{source}` AS DOUBLE)")
            # Half to even; a plain cast would truncate.
            value = value if kind == "double" else f"rint({value})"
        out[target] = f"{cast}({value} AS {kind})"
    return out


def normalize_bars(
    raw: DataFrame, universe: DataFrame, zones: dict[str, str] | None = None
) -> DataFrame:
    """Bring landed bars of the universe's symbols into the layout of ``prices``.

    Absent columns become NULL, NaN becomes NULL, a fractional volume is rounded half to even, and a
    zoned timestamp becomes the day in ``zones[exchange]``.
    """
    values = [f"{value} AS {name}" for name, value in _values(raw).items()]
    columns = ["symbol AS ticker", "exchange", f"{_local_date(raw, zones)} AS date", *values]
    return raw.join(_zoned(universe, zones), "symbol").selectExpr(*columns)


def sorted_bars(
    raw: DataFrame, universe: DataFrame, zones: dict[str, str] | None = None
) -> DataFrame:
    """Normalised bars of the universe's symbols, and rows that are none with the reason.

    ``raw`` was read with ``rejects``. A good row has a NULL ``reason``. Else ``reason`` names what
    can't be parsed, and ``file`` and ``line`` tell where it comes from: a line as it stands in a CSV or
    JSON file, else the row as JSON. Rows of other symbols are left out, unless they have none.
    """
    broken = BROKEN if BROKEN in raw.columns else "string(NULL)"
    day = _local_date(raw, zones, "TRY_CAST")
    values = _values(raw, "TRY_CAST")
    # What is there before and not after could not be parsed; NaN could.
    doubts = {"Date": "_day"} | {s: f"_{t}" for s, t in RAW_COLUMNS.items() if s in raw.columns}
    names = [n for n in ("symbol", "Date", *RAW_COLUMNS) if n in raw.columns]
    reasons = ["CASE WHEN symbol IS NULL THEN 'no symbol' END", "CASE WHEN Date IS NULL THEN 'no Date' END"]
    for source, target in doubts.items():
        nan = "" if target == "_day" else f" AND NOT coalesce(isnan(TRY_CAST(`{source}` AS DOUBLE)), false)"
        reasons.append(
            f"CASE WHEN `{source}` IS NOT NULL AND {target} IS NULL{nan} THEN concat('{source} is ', string(`{source}`)) END"
        )
    rows = raw.withColumn(BROKEN, F.expr(broken)).join(_zoned(universe, zones), "symbol", "left")
    parsed = rows.where(f"exchange IS NOT NULL OR symbol IS NULL OR {BROKEN} IS NOT NULL").selectExpr(
        "*", f"{day} AS _day", *[f"{value} AS _{name}" for name, value in values.items()]
    )
    reason = f"CASE WHEN {BROKEN} IS NOT NULL THEN 'malformed' ELSE nullif(concat_ws('; ', {', '.join(reasons)}), '') END"
    line = f"coalesce({BROKEN}, to_json(struct({', '.join(f'`{n}`' for n in names)})))"
    return parsed.selectExpr(
        "symbol AS ticker", "exchange", "_day AS date", *[f"_{name} AS {name}" for name in values], f"{reason} AS reason", f"{FILE} AS file", f"{line} AS _line"
    ).selectExpr("* EXCEPT (_line)", "CASE WHEN reason IS NOT NULL THEN _line END AS line")


def missing_tickers(universe: DataFrame, raw: DataFrame) -> DataFrame:
    """Configured symbols without any landed bar."""
    return universe.join(raw.select("symbol").distinct(), "symbol", "left_anti").select(
        "symbol", "exchange"
    )


def unavailable(universe: DataFrame) -> TickerDataUnavailable:
    """The error for a universe of which nothing has landed."""
    return TickerDataUnavailable(
        f"No data was found for any of the {universe.count()} configured ticker(s).",
        universe.select("symbol", "exchange"),
    )


def select_bars(
    universe: DataFrame,
    raw: DataFrame,
    period: str = "1mo",
    as_of: date | None = None,
    zones: dict[str, str] | None = None,
) -> DataFrame:
    """Normalised bars of the configured tickers within the look-back, which may be none.

    The look-back ends at ``as_of``, by default at each ticker's own last day.
    """
    bars = normalize_bars(look_back(raw, period, as_of) if as_of else raw, universe, zones)
    return within_period(bars, period, as_of)


def within_period(bars: DataFrame, period: str, as_of: date | None = None) -> DataFrame:
    """Bars of the look-back that ends at ``as_of``, or at each ticker's own last day."""
    if as_of:
        first = first_day(period, as_of)
        bars = bars.where(F.col("date") <= F.lit(as_of))
        return bars if first is None else bars.where(F.col("date") >= first)
    first = first_day(period, F.col("_last"))
    if first is None:
        return bars
    last = bars.groupBy("ticker").agg(F.max("date").alias("_last"))
    return bars.join(last, "ticker").where(F.col("date") >= first).select(*bars.columns)


def collect_bars(
    universe: DataFrame,
    raw: DataFrame,
    period: str = "1mo",
    as_of: date | None = None,
    zones: dict[str, str] | None = None,
) -> DataFrame:
    """The selected bars; an error if there are none for any configured ticker."""
    bars = select_bars(universe, raw, period, as_of, zones)
    if bars.isEmpty():
        raise unavailable(universe)
    return bars
