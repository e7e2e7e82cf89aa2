"""Declared schemas of the tables the library reads and writes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = ["ticker", "date"]
FLAG_KEY = ["ticker", "date", "flag_type"]

PRICES = T.StructType(
    [
        T.StructField("ticker", T.StringType(), False),
        T.StructField("exchange", T.StringType(), False),
        T.StructField("date", T.DateType(), False),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("adj_close", T.DoubleType()),
    ]
)

FLAGS = T.StructType(
    [
        T.StructField("ticker", T.StringType(), False),
        T.StructField("date", T.DateType()),
        T.StructField("flag_type", T.StringType(), False),
        T.StructField("severity", T.StringType(), False),
        T.StructField("details", T.StringType(), False),
    ]
)

EXPLANATIONS = T.StructType(
    [
        T.StructField("ticker", T.StringType(), False),
        T.StructField("date", T.DateType()),
        T.StructField("flag_type", T.StringType(), False),
        T.StructField("explanation", T.StringType(), False),
    ]
)

HOLIDAYS = T.StructType(
    [
        T.StructField("exchange", T.StringType(), False),
        T.StructField("date", T.DateType(), False),
    ]
)

UNIVERSE = T.StructType(
    [
        T.StructField("symbol", T.StringType(), False),
        T.StructField("exchange", T.StringType(), False),
    ]
)

PRICE_COLUMNS = PRICES.fieldNames()
FLAG_COLUMNS = FLAGS.fieldNames()
EXPLANATION_COLUMNS = EXPLANATIONS.fieldNames()

#: Values of a bar, in the order used to break ties between bars of one ticker and day.
BAR_VALUES = ["open", "high", "low", "close", "volume", "adj_close"]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of ``schema`` by name, in its order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
