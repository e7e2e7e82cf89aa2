"""Stored tables: keyed upsert, replace, and append, on plain parquet in versions."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barproof.functions.numeric import round_to_bigint
from barproof.operators.summaries import repeated_keys
from barproof.schemas import KEY, PRICES, conform
from barproof.session import materialize
from barproof.sources import versions
from barproof.sources.versions import Version, hadoop_path

#: Prices are stored in one folder per month, so that a daily batch rewrites recent months only.
MONTH = "month"

#: Size of sorted rows that a task should get.
TASK_BYTES = 256 * 1024 * 1024
#: How much a compressed columnar byte grows as a row in memory.
ROW_BYTES_PER_STORED_BYTE = 4

#: The part that a replaced table consists of.
WHOLE = "whole"


class DuplicateKeyError(ValueError):
    """A batch repeats a (ticker, date)."""


def exists(spark: SparkSession, path: str) -> bool:
    fs, jvm_path = hadoop_path(spark, path)
    return fs.exists(jvm_path)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, jvm_path = hadoop_path(spark, path)
    return fs.exists(jvm_path) and fs.getFileStatus(jvm_path).isDirectory()


def _read(spark: SparkSession, path: str, version: Version, schema: T.StructType, parts=None) -> DataFrame:
    """The parts of a version that are asked for, or all."""
    chosen = [folder for part, folder in version.parts.items() if parts is None or part in parts]
    if not chosen:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{folder.name}" for folder in chosen])


def _version(spark: SparkSession, path: str, may_be_absent: bool) -> Version:
    version = versions.current(spark, path)
    if version is None and not may_be_absent:
        raise FileNotFoundError(f"No table is stored at {path}.")
    return version or Version()


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, may_be_absent: bool = False
) -> DataFrame:
    """Read a stored table; an absent one is an error, or empty where it ``may_be_absent``.

    Reading changes nothing. The rows are those of one version, also while others write.
    """
    return _read(spark, path, _version(spark, path, may_be_absent), schema)


def from_pandas(spark: SparkSession, frame: pd.DataFrame, schema: T.StructType) -> DataFrame:
    """An in-memory frame as a table: columns by name, absent ones and NaN as NULL."""
    named = pa.Table.from_pandas(frame.reindex(columns=schema.fieldNames()), preserve_index=False)
    df = spark.createDataFrame(named)
    fractional = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    for field in schema:
        if isinstance(field.dataType, T.LongType) and field.name in fractional:
            df = df.withColumn(field.name, F.expr(round_to_bigint(field.name)))
    return conform(df, schema)


def month_of(day="date"):
    return F.date_format(day, "yyyy-MM")


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """The stored prices; unique by (ticker, date)."""
    return read_table(spark, path, PRICES)


def read_series(spark: SparkSession, path: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """The stored prices, spread by ticker over as many tasks as their size calls for.

    Adaptive execution merges small shuffle partitions but cannot split a hash partition, so a table
    too large for the session's number of partitions gets a number of its own. Windows by ticker
    work on this partitioning as it is.
    """
    version = _version(spark, path, may_be_absent=False)
    prices = _read(spark, path, version, PRICES)
    tasks = version.bytes * ROW_BYTES_PER_STORED_BYTE // task_bytes
    if tasks <= int(spark.conf.get("spark.sql.shuffle.partitions")):
        return prices
    return prices.repartition(tasks, "ticker")


def upserted(old: DataFrame, batch: DataFrame) -> DataFrame:
    """``old`` with the rows of ``batch`` put in the place of those with the same (ticker, date)."""
    kept = old.join(batch.select(*KEY).distinct(), KEY, "left_anti")
    return kept.select(*batch.columns).unionByName(batch)


@dataclass(frozen=True)
class Batch:
    """Rows for the prices, written once; what they come from is not read again."""

    rows: DataFrame
    count: int
    incomplete: int


def stage(batch: DataFrame, *more: F.Column) -> tuple[DataFrame, dict]:
    """Write a DataFrame to the shared folder once, and what is ``observed`` of it on the way."""
    seen = Observation()
    return materialize(batch.observe(seen, *more)), seen.get


def staged_batch(batch: DataFrame) -> Batch:
    incomplete = "count_if(ticker IS NULL OR exchange IS NULL OR date IS NULL) AS incomplete"
    rows, seen = stage(conform(batch, PRICES), F.expr("count(*) AS rows"), F.expr(incomplete))
    return Batch(rows, seen["rows"], seen["incomplete"])


def upsert_prices(spark: SparkSession, batch: DataFrame, path: str) -> dict[str, int]:
    """Upsert a batch into the stored prices and return its row and ticker counts.

    The batch is computed once and staged. Only months that it touches are read and rewritten, into
    folders of their own; then a new version of the table names them. Until then, readers and
    a job that dies leave the old version as it is; after that all of the batch is there.
    """
    return upsert_staged(spark, staged_batch(batch), path)


def upsert_staged(spark: SparkSession, batch: Batch, path: str) -> dict[str, int]:
    path = path.rstrip("/")
    if batch.incomplete:
        raise ValueError("The batch holds rows without ticker, exchange or date.")
    found = (
        batch.rows.groupBy(*KEY)
        .count()
        .agg(
            F.count_distinct("ticker").alias("tickers"),
            F.max("count").alias("most"),
            F.collect_set(month_of()).alias("months"),  # bounded by the calendar
        )
        .first()
    )
    if found.most is not None and found.most > 1:
        listed = f"{path}.repeated-keys"
        repeated = materialize(repeated_keys(batch.rows))
        replace_table(spark, repeated, listed)
        raise DuplicateKeyError(f"The batch repeats {repeated.count()} (ticker, date), listed in {listed}.")
    base = versions.current(spark, path)
    if batch.count:
        stored = _read(spark, path, base or Version(), PRICES, found.months)
        merged = upserted(stored, batch.rows)
        folder = versions.new_folder()
        (
            merged.withColumn(MONTH, month_of())
            .hint("rebalance", MONTH)
            .sortWithinPartitions(MONTH, *KEY)
            .write.partitionBy(MONTH)
            .parquet(f"{path}/{folder}")
        )
        written = {month: f"{folder}/{MONTH}={month}" for month in found.months}
        versions.commit(spark, path, base, {**(base.parts if base else {}), **written})
    elif base is None:
        versions.commit(spark, path, None, {})
    return {"rows": batch.count, "tickers": found.tickers}


def replace_table(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Replace a stored table; readers find the old one or the new one, each whole."""
    path, folder = path.rstrip("/"), versions.new_folder()
    df.write.parquet(f"{path}/{folder}")
    versions.commit(spark, path, versions.current(spark, path), {WHOLE: folder})


def append_table(df: DataFrame, path: str) -> None:
    """Add rows to a stored table, or begin one; readers find all of the rows or none.

    Rows that are added do not depend on those that are there, so a job that was faster is no reason to
    fail: the written folder is put on the next list.
    """
    spark, path, folder = df.sparkSession, path.rstrip("/"), versions.new_folder()
    df.write.parquet(f"{path}/{folder}")
    while True:
        base = versions.current(spark, path) or Version()
        try:
            versions.commit(spark, path, base, {**base.parts, folder: folder})
            return
        except versions.ConcurrentWriteError:
            continue
