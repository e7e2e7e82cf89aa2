"""Near duplicates by min-max hashing: both ends of each permutation, banded and then confirmed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barproof.llm.components import components
from barproof.llm.rolling import column_texts, mixed, shingle_sets
from barproof.session import materialize

#: Permutations; each gives two values of a signature, its minimum and its maximum.
PERMUTATIONS = 48
#: Values of a band. Sets with similarity s share one of the 24 bands but for (1 - s ** 4) ** 24,
#: which is 2e-8 at 0.85.
ROWS = 4
#: Pairs whose signatures agree in less than the least similarity, less this part of the values, are
#: dropped before texts are read: some 5 standard deviations of the estimate.
MARGIN = 0.19
#: Documents that a task compares on each side, and documents compared with a copy of a head's text.
BLOCK = 2048
SHARE = 256
#: Bits of the filter ahead of joins with texts (512 KB), and of one row of it, as Spark lays them out.
FILTER_BITS, MAP_BITS = 1 << 22, 1 << 15
#: Fixed value: the multipliers come from these numbers by ``mixed``.
SEED = 0x2545F4914F6CDD1D

_DESCRIBED = "doc_id bigint, n bigint, same_a bigint, same_b bigint, bands array<bigint>, signature binary"


def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and summands: a token's place in permutation i is ``token * a[i] + b[i]``."""
    numbers = mixed(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(SEED))
    return numbers[:count] | np.uint64(1), numbers[count:]


def signatures(sets: list[np.ndarray], count: int = PERMUTATIONS) -> np.ndarray:
    """A row for each set, none of them empty: the minima under all permutations, then the maxima."""
    tokens, starts = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((2 * count, len(sets)), np.uint64)
    for i, (a, b) in enumerate(zip(*permutations(count), strict=True)):
        places = tokens * a + b
        out[i] = np.minimum.reduceat(places, starts)
        out[count + i] = np.maximum.reduceat(places, starts)
    return out.T


def bands(values: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """Hashes of ``rows`` values each; minimum and maximum of a permutation are in different bands."""
    parts = values.reshape(len(values), -1, rows)
    total = np.arange(1, parts.shape[1] + 1, dtype=np.uint64) * np.uint64(SEED) * np.ones((len(values), 1), np.uint64)
    for i in range(rows):
        total = mixed(total) + parts[:, :, i]
    return mixed(total)


def _described(docs: DataFrame, shingle: int) -> DataFrame:
    """For each row its set's size, two sums that tell sets apart, bands, and a byte of each value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in column_texts(batch.column("text")):
                sets = list(shingle_sets(texts, shingle))
                some = [i for i, tokens in enumerate(sets) if len(tokens)]
                values = np.zeros((len(sets), 2 * PERMUTATIONS), np.uint64)
                if some:
                    values[some] = signatures([sets[i] for i in some])
                keys = bands(values)
                sums = [(t.sum(dtype=np.uint64), mixed(t).sum(dtype=np.uint64)) for t in sets]
                same = np.array(sums, np.uint64).reshape(-1, 2).view(np.int64)
                offsets = pa.array(np.arange(len(sets) + 1) * keys.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, len(texts)),
                        pa.array([len(t) for t in sets], pa.int64()),
                        pa.array(same[:, 0]),
                        pa.array(same[:, 1]),
                        pa.ListArray.from_arrays(offsets, pa.array(keys.view(np.int64).ravel())),
                        pa.array([row.tobytes() for row in values.astype(np.uint8)], pa.binary()),
                    ],
                    names=["doc_id", "n", "same_a", "same_b", "bands", "signature"],
                )
                at += len(texts)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _DESCRIBED)


def only(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``docs`` (doc, text) without most rows whose ``doc`` is not in ``wanted``, before any shuffle.

    A bitmap of hashed numbers, of ``FILTER_BITS`` bits however many are wanted, goes to all tasks. It
    lets some others pass, more where more are wanted, so the join that follows still decides.
    """
    hashed = F.pmod(F.xxhash64("doc"), F.lit(FILTER_BITS))
    bucket, position = (hashed / MAP_BITS).cast("int"), F.pmod(hashed, F.lit(MAP_BITS))
    maps = wanted.groupBy(bucket.alias("bucket")).agg(F.bitmap_construct_agg(position).alias("map"))
    byte = F.conv(F.hex(F.substr("map", (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.getbit(byte, F.pmod(position, F.lit(8)).cast("int"))
    placed = docs.withColumn("bucket", bucket).join(F.broadcast(maps), "bucket")
    return placed.where(bit == 1).drop("bucket", "map")


def _agreeing(pairs: DataFrame, kinds: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (doc, head) whose sizes and signatures allow a link."""
    least = (num / den - MARGIN) * 2 * PERMUTATIONS
    one = kinds.select(F.col("kind").alias("doc"), F.col("n").alias("n_doc"), F.col("signature").alias("of_doc"))
    two = kinds.select(F.col("kind").alias("head"), F.col("n").alias("n_head"), F.col("signature").alias("of_head"))
    near = f"{den} * least(n_doc, n_head) >= {num} * greatest(n_doc, n_head)"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (_matrix(batch.column(name)) for name in ("of_doc", "of_head"))
            keep = (a == b).sum(axis=1) >= least
            yield batch.select(["doc", "head"]).filter(pa.array(keep))

    whole = pairs.join(one, "doc").join(two, "head").where(near).select("doc", "head", "of_doc", "of_head")
    return whole.mapInArrow(run, "doc bigint, head bigint")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def linked(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """Whether two sorted sets overlap in num / den of their union."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or den * len(small) < num * len(large):
        return False
    place = np.minimum(np.searchsorted(large, small), len(large) - 1)
    overlap = int(np.count_nonzero(large[place] == small))
    return den * overlap >= num * (len(a) + len(b) - overlap)


def confirmed(docs: DataFrame, pairs: DataFrame, shingle: int, num: int, den: int) -> DataFrame:
    """Of the pairs (doc, head), those whose whole sets are linked, as (src, dst).

    A head with many documents is dealt to several tasks, each with a copy of its text.
    """
    sizes = pairs.groupBy("head").agg(F.ceil(F.count("*") / SHARE).cast("int").alias("parts"))
    dealt = materialize(
        pairs.join(sizes, "head").select("head", "doc", F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int").alias("part"))
    )
    heads = dealt.select("head", "part").distinct()
    wanted = dealt.select("head", "part", "doc", F.lit(1).alias("side")).unionByName(
        heads.select("head", "part", F.col("head").alias("doc"), F.lit(0).alias("side"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, own = None, []
        for batch in batches:
            rows = zip(*(batch.column(n).to_pylist() for n in ("head", "part", "side", "doc")), strict=True)
            sets = (tokens for texts in column_texts(batch.column("text")) for tokens in shingle_sets(texts, shingle))
            found = []
            for (name, part, side, doc), tokens in zip(rows, sets, strict=True):
                if head != (name, part):
                    head, own = (name, part), []
                if side == 0:
                    # One set, unless rows share the head's id.
                    if not any(np.array_equal(tokens, other) for other in own):
                        own.append(tokens)
                elif any(linked(other, tokens, num, den) for other in own):
                    found.append((doc, name))
            if found:
                src, dst = zip(*found, strict=True)
                yield pa.RecordBatch.from_pydict({"src": pa.array(src, pa.int64()), "dst": pa.array(dst, pa.int64())})

    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
    return (
        only(texts, wanted)
        .join(wanted, "doc")
        .select("head", "part", "side", "doc", "text")
        .repartition("head", "part")
        .sortWithinPartitions("head", "part", "side")
        .mapInArrow(run, "src bigint, dst bigint")
    )


class Groups:
    """Groups of documents in one task, by the names they come with, joined on the way."""

    def __init__(self, names: np.ndarray):
        _, self.of = np.unique(names, return_inverse=True)

    def join(self, a: int, b: int) -> None:
        self.of[self.of == self.of[b]] = self.of[a]


def _first_groups(links: DataFrame) -> DataFrame:
    """doc and ``of``: a smaller document that it is linked with, over two links at most.

    Most documents are linked with the same heads, so this is nearly their component, at far less cost;
    what it tells apart though it is connected is only looked at once more.
    """
    both = links.union(links.select("dst", "src"))
    near = materialize(both.groupBy(F.col("src").alias("doc")).agg(F.min("dst").alias("near")))
    near = near.select("doc", F.least("doc", "near").alias("near"))
    further = near.select(F.col("doc").alias("near"), F.col("near").alias("of"))
    return near.join(further, "near").select("doc", "of")


def _cells(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """Documents that may be linked to another group than their own, dealt to cells that fit a task.

    The documents of a band's value are mostly in one group, the value's main one; those of all values
    with one main group are a cluster. Those out of the main group are compared with all of a cluster:
    a cell (cluster, block, strip) holds a block of all on side 0, and a strip of the others on side 1.
    """
    key = ["band", "value"]
    # Two or three documents have met each other.
    shared = postings.where("members > 3").select(*key, "doc")
    placed = materialize(shared.join(groups, "doc", "left").withColumn("of", F.coalesce("of", "doc")))
    counts = placed.groupBy(*key, "of").agg(F.count("*").alias("members"))
    main = (
        counts.groupBy(*key)
        .agg(F.max(F.struct("members", "of")).alias("most"), F.count("*").alias("groups"))
        .where("groups > 1")
        .select(*key, F.col("most.of").alias("cluster"))
    )
    members = materialize(placed.join(main, key).select("cluster", "doc", "of").distinct())
    sizes = members.groupBy("cluster").agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"),
        F.ceil(F.count_if(F.col("of") != F.col("cluster")) / BLOCK).cast("int").alias("strips"),
    )
    deal = F.pmod(F.xxhash64("doc"), F.lit(1 << 30))
    dealt = materialize(members.join(sizes, "cluster").select("*", deal.alias("deal")))
    every = dealt.select(
        "cluster", F.pmod("deal", "blocks").cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("strips") - 1)).alias("strip"), F.lit(0).alias("side"), "doc", "of",
    )
    others = dealt.where("of <> cluster").select(
        "cluster", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod("deal", "strips").cast("int").alias("strip"), F.lit(1).alias("side"), "doc", "of",
    )
    return every.unionByName(others)


def _remaining(
    docs: DataFrame, postings: DataFrame, kinds: DataFrame, groups: DataFrame, shingle: int, num: int, den: int
) -> DataFrame:
    """Links (src, dst) from one group to another, as far as they join groups.

    In each cell signatures choose and whole sets decide; pairs that are in one group by then are
    passed over, so a cell gives fewer rows than it has.
    """
    least = (num / den - MARGIN) * 2 * PERMUTATIONS
    cell = ["cluster", "block", "strip"]

    def answered(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        side, doc, of, n = (rows.column(c).to_numpy() for c in ("side", "doc", "of", "n"))
        signature = _matrix(rows.column("signature").combine_chunks())
        texts = column_texts(rows.column("text").combine_chunks())
        sets = [tokens for part in texts for tokens in shingle_sets(part, shingle)]
        joined, found = Groups(of), []
        block, strip = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        for b in strip.tolist():
            other = block[joined.of[block] != joined.of[b]]
            other = other[den * np.minimum(n[other], n[b]) >= num * np.maximum(n[other], n[b])]
            agree = (signature[other] == signature[b]).sum(axis=1)
            near = np.flatnonzero(agree >= least)
            # The likeliest first: once a link is there, its group needs no other.
            for a in other[near[np.argsort(-agree[near], kind="stable")]].tolist():
                if joined.of[a] != joined.of[b] and linked(sets[a], sets[b], num, den):
                    joined.join(a, b)
                    found.append((doc[a], doc[b]))
        if found:
            src, dst = zip(*found, strict=True)
            yield pa.RecordBatch.from_pydict({"src": pa.array(src, pa.int64()), "dst": pa.array(dst, pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            keys = np.column_stack([held.column(c).to_numpy() for c in cell])
            # The last cell may go on in the next batch.
            bounds = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()]
            for start, end in zip(bounds[:-1], bounds[1:], strict=True):
                yield from answered(held.slice(start, end - start))
            held = held.slice(bounds[-1])
        if held is not None and len(held):
            yield from answered(held)

    cells = _cells(postings, groups)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
    signed = kinds.select(F.col("kind").alias("doc"), "n", "signature")
    whole = only(texts, cells).join(cells, "doc").join(signed, "doc")
    return whole.repartition(*cell).sortWithinPartitions(*cell).mapInArrow(run, "src bigint, dst bigint")


def near_duplicates(docs: DataFrame, shingle: int = 5, num: int = 85, den: int = 100) -> DataFrame:
    """Link documents of ``docs`` (doc_id, text) whose sets of word shingles have a Jaccard
    similarity of num / den or more; returns doc_id, n_shingles, component_id, kept for each row.

    Words are runs without white space, A-Z in lower case; a text with fewer words than a shingle
    is one shingle, a text without words has an empty set and no link. component_id is the smallest
    doc_id reachable by links, the document itself included; ``kept`` tells whether it is that one.

    How: a permutation of the shingles gives a signature two values, the smallest and the largest
    place of a set, each equal for two sets with a chance of their similarity. ``PERMUTATIONS``
    evaluations give twice as many values, banded by ``ROWS``. Equal sets are one. The sets that
    share a band's value all meet the most central one, which shares most values with others. Where
    the signatures agree well enough the whole sets decide. What then is not in the main group of
    a value meets all others of the values with that main group, block by block, in the same way.
    No pair within a group is looked at, a value shared by any number of documents is dealt to many
    tasks, and nothing is capped; the second look grows with the documents of a cluster times those
    outside its main group.

    A link is missed where no band agrees: 2e-8 of the pairs at a similarity of 0.85, fewer above.

    Edge cases: null texts have no words; a null doc_id has no component and is kept; rows that repeat
    a doc_id and a text share its component (with other texts, the doc_id stands for all of them).
    Other columns are ignored. An empty table gives no rows.
    """
    described = materialize(_described(docs, shingle))
    known = described.where("doc_id is not null and n > 0")
    same = ["n", "same_a", "same_b"]
    kinds = materialize(
        known.groupBy(*same).agg(
            F.min("doc_id").alias("kind"), F.any_value("bands").alias("bands"), F.any_value("signature").alias("signature")
        )
    )
    copies = (
        known.select("doc_id", *same)
        .join(kinds.select(*same, "kind"), same)
        .where("doc_id <> kind")
        .select(F.col("doc_id").alias("src"), F.col("kind").alias("dst"))
        .distinct()
    )
    listed = kinds.select(F.col("kind").alias("doc"), F.posexplode("bands").alias("band", "value"))
    key = ["band", "value"]
    ends = listed.groupBy(*key).agg(
        F.min("doc").alias("least"), F.max("doc").alias("most"), F.count("*").alias("members")
    )
    postings = materialize(listed.join(ends.where("least < most"), key))
    # Three documents meet when all meet the first and the last; of more, the most central is the head.
    few = postings.where("members <= 3").select("doc", F.explode(F.array("least", "most")).alias("head"))
    many = postings.where("members > 3")
    weights = many.groupBy("doc").agg(F.sum("members").alias("weight"))
    heads = many.join(weights, "doc").groupBy(*key).agg(F.max_by("doc", F.struct("weight", -F.col("doc"))).alias("head"))
    met = few.unionByName(many.select(*key, "doc").join(heads, key).select("doc", "head")).where("doc <> head").distinct()
    likely = materialize(_agreeing(met, kinds, num, den))
    links = materialize(confirmed(docs, likely, shingle, num, den))
    groups = _first_groups(links)
    found = components(links.union(_remaining(docs, postings, kinds, groups, shingle, num, den)).union(copies))
    component = F.coalesce("component", "doc_id")
    return described.join(found, described["doc_id"] == found["node"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') as w
  from documents
), s as (
  select doc_id, list_sort(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
         else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) end) as s
  from w
), k as (
  select doc_id, len(s) as n, min(doc_id) over (partition by md5(array_to_string(s, chr(10)))) as kind, s from s
), t as (
  select doc_id, n, unnest(s) as shingle from k where doc_id = kind
), pairs as (
  select a.doc_id as a, b.doc_id as b from t a join t b on a.shingle = b.shingle and a.doc_id < b.doc_id
    and 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  group by a.doc_id, b.doc_id, a.n, b.n
  having 100 * count(*) >= 85 * (a.n + b.n - count(*))
), links as (
  select a, b from pairs union all select b, a from pairs
), reach(doc_id, other) as (
  select kind, kind from k where doc_id = kind
  union
  select l.a, r.other from reach r join links l on l.b = r.doc_id
), c as (
  select doc_id, min(other) as component_id from reach group by doc_id
), named as (
  select k.doc_id, cast(k.n as bigint) as n_shingles, case when k.n = 0 then k.doc_id else c.component_id end as component_id
  from k join c on k.kind = c.doc_id
)
select *, doc_id = component_id as kept from named
"""
