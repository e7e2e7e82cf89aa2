"""Texts reach Python in batches of bounded bytes."""

import pyarrow as pa
from pyspark.sql import functions as F

from barproof.llm.registry import importable

NAME = "spark.sql.execution.arrow.maxBytesPerBatch"


def largest_batch(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"size": [batch.nbytes]})

    long_texts = spark.range(0, 400, 1, 1).select(F.repeat(F.lit("word "), 10_000).alias("text"))
    return long_texts.mapInArrow(sizes, "size long").agg(F.max("size")).first()[0]


def test_long_texts_come_in_small_batches(spark):
    importable(spark)
    assert largest_batch(spark) < 4 << 20


def test_a_size_that_the_session_sets_stays(spark):
    before = spark.conf.get(NAME)
    spark.conf.set(NAME, "8m")
    try:
        importable(spark)
        assert spark.conf.get(NAME) == "8m"
        assert largest_batch(spark) > 4 << 20
    finally:
        spark.conf.set(NAME, before)
