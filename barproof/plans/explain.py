"""Explain: a user's function turns each unexplained flag, with its price history, into text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barproof.functions.text import prompt_text
from barproof.operators.flag_joins import unexplained_flags
from barproof.operators.price_window import SPAN, history_lines
from barproof.schemas import EXPLANATIONS, FLAG_COLUMNS, FLAG_KEY, FLAGS, KEY, conform
from barproof.session import materialize, new_path
from barproof.sources.tables import append_table, exists, read_series, read_table, replace_table

RESULTS = T.StructType(
    [
        *FLAGS.fields[:3],
        T.StructField("explanation", T.StringType()),
        T.StructField("status", T.StringType(), False),
        T.StructField("error", T.StringType()),
    ]
)

#: Flags explained between two writes of answers, at least; and the most rounds of a run, so that a job
#: that dies loses the answers of one round in 50 and the writes between do not grow with the flags.
ROUND, ROUNDS = 10_000, 50

EXPLAINED = "explained"
FAILED = "failed"


def prompts(prices: DataFrame, flags: DataFrame, span: int = SPAN) -> DataFrame:
    """Add ``prompt`` to each flag; a flag whose day has no bar gets an empty history."""
    prompt = prompt_text("coalesce(history, array())")
    return (
        flags.select(*FLAG_COLUMNS)
        .join(history_lines(prices, flags, span), KEY, "left")
        .selectExpr(*FLAG_COLUMNS, f"{prompt} AS prompt")
    )


def explain(
    prompted: DataFrame, explain_fn: Callable[[str], str], parallelism: int | None = None
) -> DataFrame:
    """Call ``explain_fn`` on every prompt; a failed call becomes a row with its error.

    An answer that is not a text, or is empty, counts as failed.

    Prompts are small but calls are slow, so they are spread evenly over ``parallelism`` tasks.
    """
    key, explained, failed = list(FLAG_KEY), EXPLAINED, FAILED

    def call(batches):
        for batch in batches:
            texts, errors = [], []
            for prompt in batch["prompt"]:
                try:
                    answer = explain_fn(prompt)
                    if not isinstance(answer, str):
                        raise TypeError(f"answer is {type(answer).__name__}, not a text")
                    if not answer.strip():
                        raise ValueError("answer is empty")
                    texts.append(answer)
                    errors.append(None)
                except Exception as error:  # one failed call must not stop the others
                    texts.append(None)
                    errors.append(f"{type(error).__name__}: {error}")
            result = batch[key].copy()
            result["explanation"] = texts
            result["status"] = [explained if e is None else failed for e in errors]
            result["error"] = errors
            yield result

    tasks = parallelism or prompted.sparkSession.sparkContext.defaultParallelism
    return prompted.select(*FLAG_KEY, "prompt").repartition(tasks).mapInPandas(call, RESULTS)


def explain_counts(flags: DataFrame, results: DataFrame) -> DataFrame:
    """Counts of this run: newly explained, already explained before, and failed."""
    total = flags.agg(F.count(F.lit(1))).scalar()
    return results.agg(
        F.count_if(F.col("status") == EXPLAINED).alias("newly_explained"),
        (total - F.count(F.lit(1))).alias("already_cached"),
        F.count_if(F.col("status") == FAILED).alias("failed"),
    )


def run_explanations(
    spark: SparkSession,
    prices_path: str,
    flags_path: str,
    explanations_path: str,
    explain_fn: Callable[[str], str],
    span: int = SPAN,
    parallelism: int | None = None,
) -> dict[str, int]:
    """Explain the flags that have no explanation yet, append the new ones, and return counts.

    Prompts are written once, in a folder for each round, and each round reads its own. Answers are
    appended round by round, so that a job that dies keeps all finished rounds. Failed flags stay
    unexplained and are tried again by the next run; their reasons are a table beside the
    explanations (:func:`failures_path`).
    """
    prices = read_series(spark, prices_path)
    flags = read_table(spark, flags_path, FLAGS)
    stored = read_table(spark, explanations_path, EXPLANATIONS, may_be_absent=True)
    # Fixed before the first answer is stored, as what is pending changes with it.
    pending = materialize(unexplained_flags(flags, stored))
    total = pending.count()
    rounds = min(-(-total // ROUND), ROUNDS)
    work, answers = new_path(spark, "prompts"), new_path(spark, "answers")
    if rounds:
        number = F.pmod(F.xxhash64(*FLAG_KEY), F.lit(rounds)).cast("int")
        prompted = prompts(prices, pending, span)
        prompted.withColumn("round", number).repartition("round").write.partitionBy("round").parquet(work)
    explained = 0
    for number in range(rounds):
        some = f"{work}/round={number}"
        if not exists(spark, some):  # no flag has fallen into it
            continue
        # The user's function runs once; counting and appending read what it returned.
        results = f"{answers}/round={number}"
        is_new, seen = F.col("status") == EXPLAINED, Observation()
        answered = explain(spark.read.schema(prompted.schema).parquet(some), explain_fn, parallelism)
        answered.observe(seen, F.count_if(is_new).alias("explained")).write.parquet(results)
        new = spark.read.schema(RESULTS).parquet(results).where(is_new)
        count = seen.get["explained"]
        if count:
            append_table(conform(new, EXPLANATIONS), explanations_path)
        explained += count
    every = spark.read.schema(RESULTS).parquet(answers) if rounds else spark.createDataFrame([], RESULTS)
    replace_table(spark, every.where(F.col("status") == FAILED).select(*RESULTS.fieldNames()), failures_path(explanations_path))
    return {
        "newly_explained": explained,
        "already_cached": flags.count() - total,
        "failed": total - explained,
    }


def failures_path(explanations_path: str) -> str:
    """Where a run lists the flags that it failed to explain, with reasons."""
    return f"{explanations_path.rstrip('/')}.failures"
