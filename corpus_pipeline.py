"""From raw documents to packed rows of token ids, in five stages.

Each stage is a function of (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as
Parquet and reads again for the next one. All stages but the last return the columns of ``docs``.
Rows that share a doc_id are one document: they stay or go together. Documents without a doc_id
pass the stages that name documents by it.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barproof.llm import language, latent, mixing, packing, signature_tree
from barproof.llm.registry import importable
from barproof.session import new_path

#: Part of a text's n-grams that its language must have; prose of a learned language has over 0.9.
LEAST_COVERAGE = 0.3
#: Near duplicates: words of a shingle, and the similarity as a fraction.
SHINGLE, SIMILAR = 5, (8, 10)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be learned from the corpus; others go."""
    importable(spark)
    return language.known_language(docs, language.train(docs), LEAST_COVERAGE)


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    return docs.join(gone.where("doc_id is not null").select("doc_id").distinct(), "doc_id", "left_anti").select(
        *[F.col(f"`{name}`") for name in docs.columns]
    )


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays."""
    importable(spark)
    groups = signature_tree.ngram_jaccard_join(docs, SHINGLE, *SIMILAR)
    return _without(docs, groups.where("doc_id <> component_id"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    importable(spark)
    return _without(docs, latent.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_rows(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids."""
    importable(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", language_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("decontaminate", decontamination_stage),
    ("mix_sources", mixing_stage),
    ("pack_tokens", packing_stage),
]

#: Stages that learn models and pack rows are not expressible in SQL; tests compare them otherwise.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
