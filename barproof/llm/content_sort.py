"""Exact dedup by a content sort."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barproof.llm.words import text_of, without_white_space
from barproof.session import materialize

#: Characters of a text that range bounds hold; bounds are sampled by Spark and stay this short.
HEAD = 64
#: Rows with one head from which on it is spread over sub-ranges, and the part of all rows; so the
#: list of such heads has 10,000 entries at most.
HOT_ROWS, HOT_SHARE = 10_000, 10_000
#: Sub-ranges of a hot head by content, and of one content.
SPREAD = 1024

RANGE = ["head", "spread", "salt"]


def _spread(rows: DataFrame) -> DataFrame:
    """Add ``spread`` and ``salt``: 0 but for heads that very many rows share.

    Those are dealt to sub-ranges by content, and the rows of one content by their numbers.
    """
    head = F.xxhash64("head").alias("hot")
    counts = materialize(rows.groupBy(head).count())
    total = counts.agg(F.sum("count")).first()[0] or 0
    hot = counts.where(F.col("count") > max(HOT_ROWS, total // HOT_SHARE)).select("hot")
    dealt = rows.join(F.broadcast(hot), rows["head_hash"] == hot["hot"], "left")
    number = F.xxhash64("doc_id", F.spark_partition_id())
    sub = lambda key: F.when(F.col("hot").isNull(), 0).otherwise(F.pmod(key, F.lit(SPREAD))).cast("int")
    return dealt.select(
        "doc_id", "code_points", "content", "head", sub(F.xxhash64("content")).alias("spread"), sub(number).alias("salt"),
        F.col("hot").isNotNull().alias("hot"),
    )


def _runs(rows: DataFrame, partition: list[str]) -> DataFrame:
    """Number the runs of equal contents in each range, with the row that leads each run.

    Rows are sorted by content, and equal ones so that the one that stays leads. ``starts`` is 1 where the whole content differs from that of the neighbour before it.
    """
    in_order = Window.partitionBy(*partition).orderBy(
        "content", F.col("code_points").desc(), F.col("doc_id").asc_nulls_last()
    )
    before = F.lag("content").over(in_order)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    leader = F.when(F.col("starts") == 1, F.struct("doc_id", "code_points"))
    return (
        rows.withColumn("starts", (before.isNull() | (before != F.col("content"))).cast("int"))
        .withColumn("run", F.sum("starts").over(so_far))
        .withColumn("leader", F.last(leader, ignorenulls=True).over(so_far))
    )


def content_sort_dedup(docs: DataFrame) -> DataFrame:
    """Find rows of ``docs`` (doc_id, text) with equal texts and name the row that stays.

    Texts are equal when the same after white space is deleted. The row with the most code points
    in the original text stays, then the smallest doc_id. One row per row of ``docs``: doc_id,
    keep_id, group_size, kept, text_sha256.

    How: Spark samples splitters and range-partitions the rows by the beginning of their content;
    each partition is sorted by content (externally where it spills), which puts equal texts next
    to each other, the row that stays first. A group begins where a whole text differs from its
    neighbour's, and its size is counted over the run. A beginning that very many rows share, such
    as that of a text with copies in a third of the table, is spread over sub-ranges; the leaders
    of their runs are then sorted by content once more, and neighbours that are equal there join
    the runs of several sub-ranges to one group. The digest is made for the result only.

    Edge cases: a null text counts as empty, and all empty texts are one group. A null doc_id
    loses every tie. Of rows that repeat a doc_id with equal texts, those with the most code points
    are kept if that doc_id is: exact copies all, a shorter one not. Other columns are ignored,
    whatever their names.
    """
    rows = docs.select("doc_id", text_of().alias("original")).select(
        "doc_id",
        F.length("original").alias("code_points"),
        without_white_space(F.col("original")).alias("content"),
    )
    head = F.substring("content", 1, HEAD)
    spread = _spread(rows.select("*", head.alias("head"), F.xxhash64(head).alias("head_hash")))
    # The windows ask for the same columns that the ranges are made of: no second exchange.
    sorted_rows = _runs(spread.repartitionByRange(*RANGE), RANGE)
    placed = materialize(
        sorted_rows.select(
            *RANGE,
            "run",
            "doc_id",
            "code_points",
            "leader",
            "hot",
            F.sha2(F.col("content").cast("binary"), 256).alias("digest"),
            F.when(F.col("hot") & (F.col("starts") == 1), F.col("content")).alias("content"),
        ).withColumn("size", F.count("*").over(Window.partitionBy(*RANGE, "run")))
    )
    plain = placed.where("not hot").select("doc_id", "code_points", "digest", "leader", F.col("size").alias("group_size"))
    # Leaders of runs in sub-ranges: of one content at most one for each of them.
    leaders = _runs(
        placed.where("content is not null").select(*RANGE, F.col("run").alias("part"), "size", "leader.*", "content")
        .repartitionByRange("head", "spread"),
        ["head", "spread"],
    )
    merged = materialize(
        leaders.select(
            *RANGE, "part", "leader", F.sum("size").over(Window.partitionBy("head", "spread", "run")).alias("group_size")
        )
    )
    hot = (
        placed.where("hot")
        .drop("leader")
        .withColumnRenamed("run", "part")
        .join(merged, [*RANGE, "part"])
        .select("doc_id", "code_points", "digest", "leader", "group_size")
    )
    leads = F.col("doc_id").eqNullSafe(F.col("leader.doc_id")) & (F.col("code_points") == F.col("leader.code_points"))
    return plain.unionByName(hot).select(
        "doc_id",
        F.col("leader.doc_id").alias("keep_id"),
        "group_size",
        leads.alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


SQL = r"""
with t as (
  select doc_id, length(coalesce(text, '')) as points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as digest
  from documents
), g as (
  select *, count(*) over (partition by digest) as group_size,
         first_value(doc_id) over (partition by digest order by points desc, doc_id) as keep_id
  from t
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, digest as text_sha256 from g
"""
