"""Mixing sources to target weights with histograms of hash thresholds."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barproof.llm.words import text_of, word_count
from barproof.session import materialize

#: Weights of the sources in code point order, over and over; most uses of a text.
WEIGHTS = (5, 2, 1)
MOST = 3
#: Bits of a hash, and bits that one histogram tells apart.
HASH_BITS = 56
STEP_BITS = 8


def doc_hash(doc_id: Column) -> Column:
    """56 bits of the id's MD5: evenly spread, and the same in every engine and run."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, HASH_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def _with_weights(sources: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Number the sources in code point order (null last) and give each its weight.

    Ranges are sorted on their own; a source's place is its place in the range plus the rows of
    the ranges before, of which there are as many as partitions.
    """
    ordered = materialize(
        sources.withColumn("last", F.col("source").isNull())
        .repartitionByRange("last", "source")
        .sortWithinPartitions("last", "source")
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("at", 33))
    )
    by_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy("part")
        .agg(F.count("*").alias("rows"))
        .select("part", F.coalesce(F.sum("rows").over(by_part), F.lit(0)).alias("offset"))
    )
    rank = F.col("offset") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    return ordered.join(offsets, "part").select("key", "source_size", weight.alias("weight"))


def _with_targets(sources: DataFrame, most: int) -> DataFrame:
    """Share all sizes by weight; what exceeds ``most`` times a source's size is shared again.

    Each round needs two sums over the sources still below their limit. A source that reaches its
    limit never leaves it, as shares only grow.
    """
    limit = F.col("source_size") * F.lit(float(most))
    level, total = 0.0, None
    while True:
        full = F.col("weight") * F.lit(level) >= limit
        sums = sources.agg(
            F.sum("source_size").alias("all"),
            F.coalesce(F.sum(F.when(full, F.col("source_size"))), F.lit(0)).alias("full"),
            F.sum(F.when(~full, F.col("weight"))).alias("open"),
        ).first()
        total = sums["all"] or 0
        if not sums["open"]:
            break
        raised = (total - most * sums["full"]) / sums["open"]
        if raised <= level:
            break
        level = raised
    share = F.col("weight") * F.lit(level)
    return sources.withColumn("target", F.when(share >= limit, limit).otherwise(share))


def _boundaries(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """The hash below which each source's texts are taken once more: (key, threshold).

    ``rows``: (key, size, hash). A histogram sums sizes by source and by the next bits of the hash.
    Whole buckets fit the budget up to one; only that one's texts go to the next, finer histogram,
    until the bucket holds one hash. The text on the boundary is taken if that is nearer.
    """
    state = sources.select(
        "key", F.col("rest").alias("left"), F.lit(0).cast("long").alias("threshold")
    )
    found, level = [], HASH_BITS
    while True:
        level -= STEP_BITS
        bucket = F.shiftright("hash", level)
        sums = materialize(
            rows.groupBy("key", bucket.alias("bucket")).agg(
                F.sum("size").alias("size"),
                F.min("hash").alias("low"),
                F.max("hash").alias("high"),
            )
        )
        # At most 2 ** STEP_BITS rows of a source, however large it is.
        in_order = Window.partitionBy("key").orderBy("bucket")
        below = F.coalesce(
            F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        )
        crossing = materialize(
            sums.withColumn("below", below)
            .join(state, "key")
            .where("below <= left and below + size > left")
            .select("key", "bucket", "low", "high", "size", (F.col("left") - F.col("below")).alias("left"))
        )
        single = F.col("low") == F.col("high")
        # A hash of its own is taken whole or not at all, whichever comes nearer to the budget.
        found.append(
            crossing.where(single).select(
                "key",
                (F.col("low") + F.when(2 * F.col("left") > F.col("size"), 1).otherwise(0)).alias("threshold"),
            )
        )
        wide = crossing.where(~single)
        if wide.isEmpty():
            break
        state = wide.select("key", "left")
        chosen = wide.select("key", F.col("bucket").alias("chosen"))
        rows = rows.join(chosen, "key").where(bucket == F.col("chosen")).drop("chosen")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return materialize(out)


def _source_key() -> Column:
    """A key without nulls: joins by it are plain equalities, which Spark can split."""
    return F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))


def _times(hashed: Column, plan: str = "") -> Column:
    """How often a text enters the mix: whole passes, and once more under its source's threshold."""
    once_more = hashed < F.coalesce(f"{plan}threshold", F.lit(0).cast("long"))
    return F.col(f"{plan}passes") + once_more.cast("long")


def _planned(docs: DataFrame, weights: tuple[int, ...], most: int) -> tuple[DataFrame, DataFrame]:
    """The sizes of all texts, and for each source its target, whole passes and threshold."""
    sized = materialize(
        docs.select(
            "doc_id",
            "source",
            word_count(text_of()).alias("size"),
            doc_hash(F.col("doc_id")).alias("hash"),
            _source_key().alias("key"),
        )
    )
    totals = sized.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    sources = materialize(_with_targets(materialize(_with_weights(totals, weights)), most))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    planned = sources.select("*", passes.cast("long").alias("passes")).withColumn(
        "rest", F.col("target") - F.col("passes") * F.col("source_size")
    )
    boundaries = _boundaries(sized.select("key", "size", "hash"), planned.where("rest > 0"))
    return sized, materialize(planned.join(boundaries, "key", "left").drop("rest", "weight"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Choose how often each text of ``docs`` (doc_id, text, source) enters a mix of its sources.

    A text's size is its number of words. All sources together are to give as many words as
    ``docs`` has; shares follow ``weights``, and no source gives more than ``most`` times its size.
    Returns doc_id, size, source_size, target, taken for every row.

    How: a target is a number of whole passes over the source plus a rest. The rest takes the
    texts whose hash lies under the source's threshold, found by nested histograms; texts are
    never sorted, and a filter by the threshold finishes the job. A source gives less or more than
    its target by half a text at most (by half of all texts with one doc_id, which go together).

    Edge cases: null texts have size 0; null sources are one source, the last; a null doc_id
    hashes as the empty text; a source without words has target 0; an empty table gives no rows.
    Columns besides the three are ignored.
    """
    sized, plan = _planned(docs, weights, most)
    return sized.join(plan, "key").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * _times(F.col("hash"))).alias("taken")
    )


def mixed_rows(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with all its columns."""
    _, plan = _planned(docs, weights, most)
    # Names of our own that no column has, in whatever case.
    taken = {name.lower() for name in docs.columns}
    key, own, copy = (name + "_" * (1 + max(map(len, taken), default=0)) for name in ("key", "plan", "copy"))
    limits = plan.select(F.col("key").alias(key), F.struct("passes", "threshold").alias(own))
    times = _times(doc_hash(F.col("doc_id")), f"{own}.")
    return (
        docs.withColumn(key, _source_key())
        .join(limits, key)
        .withColumn(copy, F.explode(F.sequence(F.lit(0).cast("long"), times)))
        .where(F.col(copy) > 0)
        .select(*[F.col(f"`{name}`") for name in docs.columns])
    )


#: The levels at which sources reach their limits are tried in order of size / weight. The texts
#: of a source are summed in the order of their hashes.
MIX_SQL = r"""
with recursive docs as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
         ('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 14))::bigint as hash
  from {documents}
), ranked as (
  select source, cast(sum(size) as bigint) as source_size,
         row_number() over (order by source nulls last) - 1 as place
  from docs group by source
), sources as (
  select *, [5, 2, 1][place % 3 + 1] as weight from ranked
), levels as (
  select 0.0::double as level
  union
  select greatest(l.level, (t.total - 3 * t.full_size)::double / t.open_weight)
  from levels l, lateral (
    select cast(sum(source_size) as bigint) as total,
           cast(coalesce(sum(source_size) filter (where weight * l.level >= source_size * 3.0::double), 0) as bigint) as full_size,
           cast(sum(weight) filter (where not weight * l.level >= source_size * 3.0::double) as bigint) as open_weight
    from sources) t
  where t.open_weight > 0
), level as (select max(level) as level from levels),
targets as (
  select source, source_size,
         case when weight * level >= source_size * 3.0::double then source_size * 3.0::double else weight * level end as target
  from sources, level
), planned as (
  select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as passes from targets
), by_hash as (
  select source, hash, cast(sum(size) as bigint) as size from docs group by source, hash
), running as (
  select *, coalesce(sum(size) over (partition by source order by hash rows between unbounded preceding and 1 preceding), 0) as below
  from by_hash
), thresholds as (
  select p.source, max(case when below + size <= target - passes * source_size or (below <= target - passes * source_size
           and 2 * (target - passes * source_size - below) > size) then hash end) as threshold
  from planned p join running r on p.source is not distinct from r.source
  where target - passes * source_size > 0 group by p.source
)
select d.doc_id, d.size, p.source_size, p.target,
       d.size * (p.passes + case when d.hash <= t.threshold then 1 else 0 end) as taken
from docs d join planned p on d.source is not distinct from p.source
left join thresholds t on d.source is not distinct from t.source
"""
SQL = MIX_SQL.format(documents="documents")
