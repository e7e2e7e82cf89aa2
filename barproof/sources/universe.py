"""The configured tickers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barproof.schemas import UNIVERSE

# Defaults of the optional settings.
DEFAULT_PRICES_PATH = "data/market_data"
DEFAULT_PERIOD = "1mo"

_CONFIG = T.StructType(
    [
        T.StructField("tickers", T.ArrayType(UNIVERSE)),
        T.StructField("db_path", T.StringType()),
        T.StructField("period", T.StringType()),
        T.StructField("_corrupt", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Config:
    universe: DataFrame
    db_path: str
    period: str


def load_config(spark: SparkSession, path: str) -> Config:
    """Read and validate a JSON file with ``tickers``, ``db_path`` and ``period``.

    A large universe may be a folder of such files; the settings are then those that any of them has.
    """
    try:
        config = spark.read.schema(_CONFIG).json(
            path, multiLine=True, columnNameOfCorruptRecord="_corrupt"
        )
        incomplete = F.exists("tickers", lambda t: t.isNull() | t["symbol"].isNull() | t["exchange"].isNull())
        settings = config.agg(
            F.max("db_path").alias("db_path"),
            F.max("period").alias("period"),
            F.coalesce(F.bool_or(F.col("_corrupt").isNotNull()), F.lit(False)).alias("corrupt"),
            F.coalesce(F.sum(F.greatest(F.size("tickers"), F.lit(0))), F.lit(0)).alias("entries"),
            F.coalesce(F.bool_or(incomplete), F.lit(False)).alias("incomplete"),
        ).first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"There is no configuration at {path}.") from error
        raise
    if not settings.corrupt and settings.entries < 1:
        raise ValueError(f"The configuration {path} names no tickers.")
    if settings.corrupt or settings.incomplete:
        raise ValueError(
            f"The configuration {path} has a ticker without symbol or exchange, or can't be parsed."
        )
    universe = config.select(F.inline("tickers"))
    return Config(
        universe, settings.db_path or DEFAULT_PRICES_PATH, settings.period or DEFAULT_PERIOD
    )
