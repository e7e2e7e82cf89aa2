"""N-gram Jaccard join with signature trees."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barproof.llm.components import components
from barproof.llm.rolling import column_texts, mixed, shingle_sets
from barproof.session import materialize

#: Least bits of a token bitmap (larger sets have two for each token or more), members of a leaf,
#: children of a node.
BITS = 2048
LEAF = 16
FANOUT = 4
#: Tokens and members that one tree holds. A larger block has several trees.
TREE_TOKENS = 4 << 20
TREE_MEMBERS = 4096
#: Common tokens are found on a bounded sample: about so many documents, those with the smallest hashes.
#: Which tokens are found decides the order of tokens, never the result.
SAMPLE_DOCS = 20_000
COMMON = 4
MOST_COMMON = 1 << 20
#: Sets that a task remembers, so as to read equal ones once.
SEEN = 1 << 16


class SignatureTree:
    """Members in the order of their sizes; nodes hold the union of bitmaps and the range of sizes."""

    def __init__(self, sizes: np.ndarray, maps: np.ndarray):
        self.sizes, self.maps = sizes, maps
        self.bits = np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        # Levels from the leaves up: first member, end, smallest and largest size, fewest bits, union.
        starts = np.arange(0, len(sizes), LEAF)
        self.levels = [self._level(starts, sizes, sizes, self.bits, maps, len(sizes))]
        while len(self.levels[-1]["first"]) > 1:
            under = self.levels[-1]
            starts = np.arange(0, len(under["first"]), FANOUT)
            self.levels.append(
                self._level(starts, under["least"], under["most"], under["bits"], under["map"], len(under["first"]))
            )

    @staticmethod
    def _level(starts, least, most, bits, maps, count) -> dict[str, np.ndarray]:
        return {
            "first": starts,
            "end": np.append(starts[1:], count),
            "least": np.minimum.reduceat(least, starts),
            "most": np.maximum.reduceat(most, starts),
            "bits": np.minimum.reduceat(bits, starts),
            "map": np.bitwise_or.reduceat(maps, starts, axis=0),
        }


def _may_link(overlap, smaller, larger, num: int, den: int):
    """Whether an overlap of at most so much lets sets of at least these sizes reach num / den."""
    return (den + num) * overlap >= num * (smaller + larger)


def leaf_pairs(one: SignatureTree, two: SignatureTree, num: int, den: int) -> Iterator[tuple[slice, slice]]:
    """Traverse both trees at once; yield the leaves that may hold a link.

    Of a member of one node, all bits that the other node's union lacks stand for tokens that no
    member there has. So the overlap of two members is at most the larger size less the fewest
    bits plus the bits the unions share; and a small set can't link with one much larger.
    """
    same = one is two
    pairs = np.array([[len(one.levels) - 1, 0, len(two.levels) - 1, 0]])
    while len(pairs):
        depth_a, depth_b = int(pairs[0, 0]), int(pairs[0, 2])
        a, b = one.levels[depth_a], two.levels[depth_b]
        i, j = pairs[:, 1], pairs[:, 3]
        shared = np.bitwise_count(a["map"][i] & b["map"][j]).sum(axis=1, dtype=np.int64)
        most = np.minimum(
            a["most"][i] - np.maximum(0, a["bits"][i] - shared), b["most"][j] - np.maximum(0, b["bits"][j] - shared)
        )
        low_a, low_b = a["least"][i], b["least"][j]
        keep = _may_link(most, low_a, low_b, num, den)
        keep &= (den * a["most"][i] >= num * low_b) & (den * b["most"][j] >= num * low_a)
        i, j = i[keep], j[keep]
        if depth_a == 0 and depth_b == 0:
            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                yield slice(a["first"][x], a["end"][x]), slice(b["first"][y], b["end"][y])
            return
        below = []
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            left = range(a["first"][x], a["end"][x]) if depth_a else (x,)
            right = range(b["first"][y], b["end"][y]) if depth_b else (y,)
            down = (max(depth_a - 1, 0), max(depth_b - 1, 0))
            below += [
                (down[0], u, down[1], v) for u in left for v in right if not same or u <= v
            ]
        pairs = np.array(below, dtype=np.int64).reshape(-1, 4)


class Groups:
    """Union-find over members of one task; a group is named by its smallest member."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, a: int, b: int) -> None:
        keep, gone = sorted((self.of[a], self.of[b]))
        if keep != gone:
            self.of[self.of == gone] = keep


class Members:
    """Members of a block with what decides links between them: bitmaps, and token sets if given.

    A bitmap is as wide as its set is large, so members are kept by width. Linked sets have sizes
    near each other, den / num apart at most, so the wider one of a pair has ``reach`` times the
    width at most; it is folded.
    """

    def __init__(self, docs: np.ndarray, sizes: np.ndarray, maps: list[bytes], sets: list[bytes] | None, num: int, den: int):
        self.num, self.den = num, den
        # The power of two from den / num on; of sets of a size as well, widths may be doubled.
        self.reach = max(2, 1 << (-(-den // num) - 1).bit_length())
        self.docs, self.sizes = docs, sizes
        self.widths = np.array([8 * len(m) for m in maps])
        self.place = np.zeros(len(docs), np.int64)
        self.maps = {}
        for width in np.unique(self.widths).tolist():
            at = np.flatnonzero(self.widths == width)
            self.place[at] = np.arange(len(at))
            self.maps[width] = np.frombuffer(b"".join(maps[i] for i in at), np.uint64).reshape(len(at), width // 64)
        self.sets = None if sets is None else [np.frombuffer(t, np.uint64) for t in sets]

    def folded(self, members: np.ndarray, width: int) -> np.ndarray:
        """Bitmaps of members of one width, as bitmaps of ``width`` bits."""
        own = int(self.widths[members[0]])
        maps = self.maps[own][self.place[members]]
        while own > width:
            own //= 2
            maps = maps[:, : own // 64] | maps[:, own // 64 :]
        return maps

    def links(self, one: np.ndarray, two: np.ndarray, width: int) -> np.ndarray:
        """For members ``one`` against members ``two``: where the bitmaps allow a link."""
        a, b = self.folded(one, width)[:, None], self.folded(two, width)[None, :]
        lost_a = np.bitwise_count(a & ~b).sum(axis=2, dtype=np.int64)
        lost_b = np.bitwise_count(b & ~a).sum(axis=2, dtype=np.int64)
        n_a, n_b = self.sizes[one][:, None], self.sizes[two][None, :]
        return _may_link(np.minimum(n_a - lost_a, n_b - lost_b), n_a, n_b, self.num, self.den)

    def linked(self, a: int, b: int) -> bool:
        """The full check, where token sets are there."""
        if self.sets is None:
            return True
        x, y = self.sets[a], self.sets[b]
        at = np.minimum(np.searchsorted(y, x), len(y) - 1)
        overlap = int(np.count_nonzero(y[at] == x))
        return bool(_may_link(overlap, len(x), len(y), self.num, self.den))

    def connect(self, groups: Groups, one: np.ndarray, two: np.ndarray, width: int) -> None:
        """Join groups of members that are linked; pairs in one group already are passed over."""
        apart = groups.of[one][:, None] != groups.of[two][None, :]
        if not apart.any():
            return
        for x, y in np.argwhere(apart & self.links(one, two, width)).tolist():
            a, b = one[x], two[y]
            if groups.of[a] != groups.of[b] and self.linked(a, b):
                groups.join(a, b)

    def traverse(self, groups: Groups, one: np.ndarray, two: np.ndarray) -> None:
        """Join groups over the trees of two sets of members, each of one width (or of one set)."""
        width = int(min(self.widths[one[0]], self.widths[two[0]]))
        tree = SignatureTree(self.sizes[one], self.folded(one, width))
        other = tree if one is two else SignatureTree(self.sizes[two], self.folded(two, width))
        for left, right in leaf_pairs(tree, other, self.num, self.den):
            self.connect(groups, one[left], two[right], width)


def joined(members: Members, side: np.ndarray, head: int) -> np.ndarray:
    """The smallest document of each member's group, in one task. Members are in the order of sizes.

    Members of side 0 are compared with each other; where there is a side 1, its members are compared
    with those of side 0 only. The block's head comes first against all: in a group of near copies
    it links most, and the traversal passes over what is linked already.
    """
    groups = Groups(len(members.docs))
    classes = {
        (s, width): np.flatnonzero((side == s) & (members.widths == width)) for s in (0, 1) for width in members.maps
    }
    if (side == 1).any():
        pairs = [
            (classes[0, w], classes[1, v])
            for w in members.maps
            for v in members.maps
            if max(w, v) <= members.reach * min(w, v)
        ]
    else:
        first = np.flatnonzero(members.docs == head)[:1]
        for width in members.maps if len(first) else ():
            own = int(members.widths[first[0]])
            at = classes[0, width]
            for start in range(0, len(at), 256) if max(own, width) <= members.reach * min(own, width) else ():
                members.connect(groups, first, at[start : start + 256], min(own, width))
        if (groups.of == groups.of[0]).all():
            pairs = []
        else:
            pairs = [
                (classes[0, w], classes[0, v]) for w in members.maps for v in members.maps if w <= v <= members.reach * w
            ]
    for one, two in pairs:
        if len(one) and len(two):
            members.traverse(groups, one, two)
    least = np.full(len(groups.of), np.iinfo(np.int64).max)
    np.minimum.at(least, groups.of, members.docs)
    return least[groups.of]


def _tasks(members: DataFrame, num: int, den: int, more: list[str]) -> DataFrame:
    """Run ``joined`` on each (block, chunk, other): (block, chunk, doc, least).

    Groups are read one after the other from sorted partitions; one group is in memory at a time.
    """
    key = ["block", "chunk", "other"]
    columns = [*key, "side", "doc", "n", "map", *more]

    def answered(rows: pa.Table) -> pa.RecordBatch:
        """One group, of which nothing is left afterwards."""
        block, chunk = rows.column("block")[0].as_py(), rows.column("chunk")[0].as_py()
        docs, sizes, side = (rows.column(c).to_numpy() for c in ("doc", "n", "side"))
        sets = rows.column("tokens").to_pylist() if more else None
        own = Members(docs, sizes, rows.column("map").to_pylist(), sets, num, den)
        least = joined(own, side, block)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(docs), block)), pa.array(np.full(len(docs), chunk, np.int32)), pa.array(docs), pa.array(least)],
            names=["block", "chunk", "doc", "least"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            del batch, rows
            keys = np.column_stack([held.column(c).to_numpy() for c in key])
            # The last group may go on in the next batch.
            bounds = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()]
            for start, end in zip(bounds[:-1], bounds[1:], strict=True):
                yield answered(held.slice(start, end - start))
            # Copied, so that the batch it comes from can go.
            held = held.slice(bounds[-1]).combine_chunks() if len(bounds) > 1 else held
        if held is not None and len(held):
            yield answered(held)

    return (
        members.select(*columns)
        .repartition(*key)
        .sortWithinPartitions(*key, "n", "doc")
        .mapInArrow(run, "block long, chunk int, doc long, least long")
    )


def block_links(members: DataFrame, num: int, den: int) -> DataFrame:
    """Links (src, dst) that connect what is linked within each block.

    ``members``: block, doc, n, map and perhaps tokens; a block is named by one document in it, its
    head. Without tokens, links are those the bitmaps allow.

    A block of any size is dealt into chunks of bounded tokens and members, each with a tree of its
    own that has the block's head besides. Members that reach the head need no further look at each
    other: they are one group. Only the others are compared with the other chunks, chunk by chunk.
    """
    more = [c for c in members.columns if c == "tokens"]
    weight = F.greatest(
        F.sum("n") / F.lit(TREE_TOKENS if more else float("inf")), F.count("*") / F.lit(TREE_MEMBERS)
    )
    sizes = materialize(members.groupBy("block").agg(F.ceil(weight).cast("int").alias("chunks")))
    several = sizes.where("chunks > 1")
    dealt = members.join(sizes, "block").withColumn(
        "chunk", F.pmod(F.xxhash64("doc"), F.col("chunks")).cast("int")
    )
    spare = dealt.withColumn("other", F.lit(-1)).withColumn("side", F.lit(0))
    # The head goes to each chunk; where it is already, once is enough.
    heads = (
        spare.where("doc = block and chunks > 1")
        .withColumn("own", F.col("chunk"))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .where("chunk <> own")
        .drop("own")
    )
    first = materialize(_tasks(spare.unionByName(heads), num, den, more))
    links = first.where("doc <> least").select(F.col("doc").alias("src"), F.col("least").alias("dst"))
    with_head = first.where("doc = block").select("block", "chunk", F.col("least").alias("reached"))
    apart = (
        first.join(several.select("block"), "block")
        .join(with_head, ["block", "chunk"])
        .where("least <> reached")
        .select("block", "doc")
        .distinct()
    )
    if apart.isEmpty():
        return links
    rest = materialize(apart.select("block", "doc", F.pmod(F.xxhash64("doc", F.lit(1)), F.lit(1 << 30)).alias("deal")))
    counts = rest.groupBy("block").agg(F.ceil(F.count("*") / F.lit(TREE_MEMBERS // 4)).cast("int").alias("parts"))
    parts = materialize(counts)
    # Every member of side 0 in its chunk, once for each part of the rest; the rest in each chunk.
    zero = dealt.join(parts, "block").select(
        "block", "chunk", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"), F.lit(0).alias("side"),
        "doc", "n", "map", *more,
    )
    one = (
        dealt.join(rest, ["block", "doc"])
        .join(parts, "block")
        .withColumn("other", F.pmod("deal", "parts").cast("int"))
        .withColumn("own", F.col("chunk"))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .where("chunk <> own")
        .select("block", "chunk", "other", F.lit(1).alias("side"), "doc", "n", "map", *more)
    )
    second = _tasks(zero.unionByName(one), num, den, more)
    return links.union(second.where("doc <> least").select("doc", "least"))


def _sets(texts: pd.Series, shingle: int) -> Iterator[np.ndarray]:
    yield from shingle_sets([t.encode("utf-8", "surrogatepass") for t in texts.fillna("")], shingle)


def bitmap(tokens: np.ndarray) -> bytes:
    width = max(BITS, 1 << (2 * len(tokens) - 1).bit_length())
    out = np.zeros(width, np.uint8)
    out[(tokens & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(out).tobytes()


def _described(docs: DataFrame, shingle: int) -> DataFrame:
    """doc, n, map, and two sums that tell sets apart (same_a, same_b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in column_texts(batch.column("text")):
                sizes, maps, sums = [], [], []
                for tokens in shingle_sets(texts, shingle):
                    sizes.append(len(tokens))
                    maps.append(bitmap(tokens))
                    sums.append((tokens.sum(dtype=np.uint64), mixed(tokens).sum(dtype=np.uint64)))
                same = np.array(sums, np.uint64).view(np.int64)
                arrays = [pa.array(sizes, pa.int64()), pa.array(maps, pa.binary()), pa.array(same[:, 0]), pa.array(same[:, 1])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(texts)), *arrays], names=["doc_id", "n", "map", "same_a", "same_b"]
                )
                at += len(texts)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n long, map binary, same_a long, same_b long"
    )


def _common_tokens(docs: DataFrame, rows: int, shingle: int) -> np.ndarray:
    """Tokens that ``COMMON`` documents of the sample have, at most ``MOST_COMMON``, sorted."""
    # All ids below a threshold that the number of rows gives: a filter in the scan.
    part = (SAMPLE_DOCS << 30) // max(1, rows)
    sample = docs.select("doc_id", "text").where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(part))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = list(_sets(batch["text"], shingle))
            if seen:
                tokens, count = np.unique(np.concatenate(seen), return_counts=True)
                yield pd.DataFrame({"token": tokens.view(np.int64), "docs": count})

    counts = (
        sample.mapInPandas(run, "token long, docs long")
        .groupBy("token")
        .agg(F.sum("docs").alias("docs"))
        .where(F.col("docs") >= COMMON)
    )
    # Below the bound all are taken; beyond it, the commonest by a threshold on their counts.
    found = counts.orderBy(F.desc("docs"), "token").limit(MOST_COMMON).select("token").toPandas()
    return np.sort(found["token"].to_numpy(np.int64).view(np.uint64))


def _prefixes(docs: DataFrame, shingle: int, num: int, den: int, common: np.ndarray) -> DataFrame:
    """(token, doc_id, n, common) for the tokens of which two linked sets share one at least.

    All sets are put in one order: rare tokens first, then the common ones, each by hash. Linked
    sets overlap in num / den of their sizes, so they share a token among the first n - overlap + 1.
    Of equal sets a task reads one only.
    """
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = shared.value
        # The last sets read, by their marks: a table of fixed size.
        seen = np.zeros(SEEN, np.uint64)
        for batch in batches:
            at = 0
            for texts in column_texts(batch.column("text")):
                ids = batch.column("doc_id").slice(at, len(texts)).to_pylist()
                at += len(texts)
                out = [taken for taken in map(prefix, ids, shingle_sets(texts, shingle), repeat(often), repeat(seen)) if taken]
                if out:
                    tokens, docs_out, sizes, flags = (np.concatenate(column) for column in zip(*out, strict=True))
                    yield pa.RecordBatch.from_pydict(
                        {"token": tokens.view(np.int64), "doc_id": docs_out, "n": sizes, "common": flags}
                    )

    def prefix(doc_id: int, tokens: np.ndarray, often: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, ...] | None:
        n = len(tokens)
        if not n:
            return None
        mark = mixed(np.array([tokens.sum(dtype=np.uint64), mixed(tokens).sum(dtype=np.uint64), n], np.uint64))
        mark = (mark * np.array([1, 3, 5], np.uint64)).sum(dtype=np.uint64) | np.uint64(1)
        place = int(mark >> np.uint64(40)) % SEEN
        if seen[place] == mark:
            return None
        seen[place] = mark
        is_common = np.zeros(n, bool)
        if len(often):
            is_common = often[np.minimum(np.searchsorted(often, tokens), len(often) - 1)] == tokens
        length = n - -(-num * n // den) + 1
        first = np.concatenate([np.flatnonzero(~is_common), np.flatnonzero(is_common)])[:length]
        return tokens[first], np.full(len(first), doc_id, np.int64), np.full(len(first), n, np.int32), is_common[first]

    return docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "token long, doc_id long, n int, common boolean"
    )


def _blocks(prefixes: DataFrame, num: int, den: int) -> DataFrame:
    """(block, doc_id): documents that share a prefix token, under one of them.

    Documents with a token are taken in the order of their sizes, and a new block begins where a
    set is too large to link with the one before it. Common tokens may have any number of
    documents, which are never read by one task: their blocks are ranges of sizes, and each set is
    in its own range and in the next one that it may have links in.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        token, size, block = None, 0, 0
        for batch in batches:
            if batch.empty:
                continue
            tokens, docs = batch["token"].to_numpy(), batch["doc_id"].to_numpy()
            sizes = batch["n"].to_numpy(np.int64)
            other = np.append(token is None or tokens[0] != token, tokens[1:] != tokens[:-1])
            far = den * np.append(size, sizes[:-1]) < num * sizes
            new = other | far
            starts = np.maximum.accumulate(np.where(new, np.arange(len(tokens)), -1))
            blocks = np.where(starts >= 0, docs[np.maximum(starts, 0)], block)
            pairs = np.unique(np.stack([blocks[~new], docs[~new]], axis=1), axis=0)
            if len(pairs):
                yield pd.DataFrame({"block": pairs[:, 0], "doc_id": pairs[:, 1]})
            token, size, block = tokens[-1], sizes[-1], blocks[-1]

    rare = (
        prefixes.where("not common")
        .select("token", "n", "doc_id")
        .repartition("token")
        .sortWithinPartitions("token", "n", "doc_id")
        .mapInPandas(run, "block long, doc_id long")
    )
    # Sizes from ratio ** r to ratio ** (r + 1) are range r; rounding is covered by the margin.
    ratio = den / num
    place = F.log(F.col("n").cast("double")) / F.lit(np.log(ratio) * (1 + 1e-9))
    own = F.floor(place + F.lit(1e-9)).cast("int")
    often = prefixes.where("common").select(
        "token", "doc_id", F.explode(F.array(own, own + 1)).alias("range")
    )
    heads = materialize(
        often.groupBy("token", "range").agg(F.min("doc_id").alias("block"), F.count("*").alias("docs"))
    )
    shared = often.join(heads.where("docs > 1"), ["token", "range"]).select("block", "doc_id")
    return rare.union(shared).where("block <> doc_id").distinct()


def _with_heads(pairs: DataFrame) -> DataFrame:
    return pairs.union(pairs.select("block", F.col("block").alias("doc_id")).distinct())


def ngram_jaccard_join(docs: DataFrame, shingle: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """Link documents of ``docs`` (doc_id, text) whose sets of word shingles have a Jaccard
    similarity of num / den or more; returns doc_id, n_shingles, component_id for each row.

    Words are runs without white space, A-Z in lower case; a text with fewer words than a shingle
    is one shingle, a text without words has an empty set and no link. component_id is the smallest
    doc_id reachable by links, the document itself included. All links count; none is estimated.

    How: equal sets are one (two 64-bit sums and the size tell sets apart; shingles are 64-bit
    hashes). Sets that share a token of their prefixes form blocks, with common tokens last in
    the prefixes' order. Blocks are joined twice with signature trees, whose nodes hold the union
    of their members' token bitmaps and the range of their sizes: first on bitmaps alone, which
    drops what merely shares a passage, then with whole sets within what is left, which decides.
    Links are kept as links to a group's smallest document, so a group of copies costs as many
    rows as it has members; components are found by star joins.

    Edge cases: null texts have no words; a null doc_id has no component; rows that repeat a
    doc_id and a text share its component (with other texts, the doc_id stands for all of them).
    Other columns are ignored. An empty table gives no rows.
    """
    described = materialize(_described(docs, shingle))
    known = described.where("doc_id is not null and n > 0")
    same = ["n", "same_a", "same_b"]
    kinds = materialize(known.groupBy(*same).agg(F.min("doc_id").alias("kind")))
    # The smallest document with a set stands for it. Documents of their own need no entry.
    copies = materialize(
        known.select("doc_id", *same).join(kinds, same).where("doc_id <> kind").select("doc_id", "kind").distinct()
    )

    def represented(pairs: DataFrame, column: str) -> DataFrame:
        named = copies.select(F.col("doc_id").alias(column), "kind")
        return pairs.join(named, column, "left").withColumn(column, F.coalesce("kind", column)).drop("kind")

    prefixes = materialize(_prefixes(docs, shingle, num, den, _common_tokens(docs, described.count(), shingle)))
    blocks = materialize(_with_heads(_blocks(prefixes, num, den)))
    blocks = represented(represented(blocks, "doc_id"), "block").where("block <> doc_id").distinct()
    blocks = _with_heads(materialize(blocks))
    facts = known.select("doc_id", "n", "map")
    with_maps = materialize(blocks.join(facts, "doc_id").withColumnRenamed("doc_id", "doc"))
    likely = components(materialize(block_links(with_maps, num, den)))

    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in column_texts(batch.column("text")):
                rows = [(len(tokens), bitmap(tokens), tokens.tobytes()) for tokens in shingle_sets(texts, shingle)]
                sizes, maps, tokens = zip(*rows, strict=True)
                named = [batch.column(c).slice(at, len(texts)) for c in ("component", "node")]
                made = [pa.array(sizes, pa.int64()), pa.array(maps, pa.binary()), pa.array(tokens, pa.binary())]
                yield pa.RecordBatch.from_arrays([*named, *made], names=["block", "doc", "n", "map", "tokens"])
                at += len(texts)

    members = materialize(
        docs.select(F.col("doc_id").cast("long").alias("node"), "text")
        .join(likely, "node")
        .mapInArrow(with_sets, "block long, doc long, n long, map binary, tokens binary")
    )
    links = block_links(members, num, den).union(copies.select("doc_id", "kind"))
    found = components(materialize(links))
    return described.select("doc_id", F.col("n").alias("n_shingles")).join(
        found, described["doc_id"] == found["node"], "left"
    ).select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') as w
  from documents
), s as (
  select doc_id, list_sort(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
         else list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) end) as s
  from w
), k as (
  select doc_id, len(s) as n, min(doc_id) over (partition by md5(array_to_string(s, chr(10)))) as kind, s from s
), t as (
  select doc_id, n, unnest(s) as shingle from k where doc_id = kind
), pairs as (
  select a.doc_id as a, b.doc_id as b from t a join t b on a.shingle = b.shingle and a.doc_id < b.doc_id
    and 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  group by a.doc_id, b.doc_id, a.n, b.n
  having 100 * count(*) >= 90 * (a.n + b.n - count(*))
), links as (
  select a, b from pairs union all select b, a from pairs
), reach(doc_id, other) as (
  select kind, kind from k where doc_id = kind
  union
  select l.a, r.other from reach r join links l on l.b = r.doc_id
), c as (
  select doc_id, min(other) as component_id from reach group by doc_id
)
select k.doc_id, cast(k.n as bigint) as n_shingles, case when k.n = 0 then k.doc_id else c.component_id end as component_id
from k join c on k.kind = c.doc_id
"""
