"""The registered query of each operator, and its SQL where SQL can express it."""

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from barproof.llm import content_sort, language, latent, minmax, mixing, packing, periodic, signature_tree, subvectors, suffix_sort, toxicity, url_filter, warc

Query = Callable[[SparkSession, str], DataFrame]

#: Bytes of an Arrow batch, unless the session sets its own: each task has several batches in memory, on
#: both sides, and Spark's 64 MB are much for small executors. Results don't depend on it.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "2m"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the library from wherever the driver did.

    On a cluster the library is shipped with ``--py-files``. The workers get texts in small batches.
    """
    name, size = BATCH_BYTES
    if name not in spark.conf.getAll:
        spark.conf.set(name, size)
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "labels")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages")


QUERIES: dict[str, Query] = {
    "op1_ngram_jaccard_join": lambda spark, sf: signature_tree.ngram_jaccard_join(
        _documents(spark, sf), shingle=3, num=90, den=100
    ),
    "op2_content_sort_dedup": lambda spark, sf: content_sort.content_sort_dedup(_documents(spark, sf)),
    "op3_toxicity": lambda spark, sf: toxicity.toxicity(_documents(spark, sf), _labels(spark, sf)),
    "op4_mix_sources": lambda spark, sf: mixing.mix(_documents(spark, sf)),
    "op5_url_filter": lambda spark, sf: url_filter.url_filter(_pages(spark, sf), url_filter.rules_frame(spark)),
    "op6_pack_tokens": lambda spark, sf: packing.pack(_documents(spark, sf)),
    "op7_decontaminate": lambda spark, sf: latent.decontaminate(
        _documents(spark, sf), _table(spark, sf, "benchmark")
    ),
    "op8_warc": lambda spark, sf: warc.archived_pages(_pages(spark, sf)),
    "op9_language_id": lambda spark, sf: language.language_id(_documents(spark, sf)),
    "op10_suffix_sort_dedup": lambda spark, sf: suffix_sort.remove_repeats(_documents(spark, sf)).drop("kept"),
    "op11_periodic_runs": lambda spark, sf: periodic.run_digests(periodic.with_planted_runs(_documents(spark, sf))),
    "op12_centroid_clustering": lambda spark, sf: subvectors.clustered(_table(spark, sf, "embeddings")),
    "op13_minmax_near_dedup": lambda spark, sf: minmax.near_duplicates(_documents(spark, sf)),
}

SQL: dict[str, str] = {
    "op1_ngram_jaccard_join": signature_tree.SQL,
    "op2_content_sort_dedup": content_sort.SQL,
    "op4_mix_sources": mixing.SQL,
    "op5_url_filter": url_filter.SQL,
    "op8_warc": warc.SQL,
    "op11_periodic_runs": periodic.SQL,
    "op12_centroid_clustering": subvectors.SQL,
    "op13_minmax_near_dedup": minmax.SQL,
}
