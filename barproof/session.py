"""Session helpers: the folder that all executors share, and tables written there between steps."""

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Return the folder for tables between steps: ``spark.checkpoint.dir`` as the session names it.

    Where a session names none, as in tests, the folder is set below the warehouse, which every
    executor of a Spark application reaches as well. A machine's own temporary folder is never used.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        context.setCheckpointDir(f"{warehouse}/between-steps")
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str = "table") -> str:
    """A path of its own in the shared folder; what is written there goes when Python ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_forget, spark, path)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Compute a table once and go on from its files, which outlive any executor.

    Parquet in the shared folder instead of ``checkpoint()``: later steps then read only the
    columns they need, and the optimizer knows the table's size.
    """
    spark = df.sparkSession
    path = new_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path through Spark's file systems; a path that is not there is left alone."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _forget(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:  # a stopped session can't delete any more
        remove(spark, path)
