"""Removal of repeated byte strings by a hash-compared suffix sort."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barproof.llm.rolling import (
    BASE,
    OTHER_BASE,
    SECOND_MIX,
    chunks,
    mixed,
    powers,
    prefix_hashes,
    span_hashes,
)
from barproof.session import materialize

#: Bytes of a repeated string.
LENGTH = 100
#: Bytes of the grams of which each string has a smallest one, its anchor.
GRAM = 24
#: Bytes of text around anchors that are sorted at a time, and members from which a group of equal
#: anchors is compared window by window instead, over all tasks.
SORTED_BYTES = 2 << 20
LARGE_GROUP = 50_000
#: Texts whose digests a task remembers to pass over copies.
REMEMBERED = 1 << 18


class Suffixes:
    """Suffixes of one buffer, compared by prefix hashes: a common extension takes a binary search."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.data, self.starts, self.ends = data, starts, ends
        self.prefix = prefix_hashes(data)
        self.down = powers(BASE, len(data) + 1)[1]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes that suffixes a and b (numbers) have in common at their start, by hashes."""
        x, y = self.starts[a], self.starts[b]
        low = np.zeros(len(a), np.int64)
        high = np.minimum(self.ends[a] - x, self.ends[b] - y)
        p, down = self.prefix, self.down
        px, py, dx, dy = p[x], p[y], down[x], down[y]
        while True:
            open_ = low < high
            if not open_.any():
                return low
            middle = (low + high + 1) >> 1
            same = (p[x + middle] - px) * dx == (p[y + middle] - py) * dy
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle - 1, high)

    def before(self, a: np.ndarray, b: np.ndarray, or_equal: bool) -> np.ndarray:
        """Whether suffix a comes before b (or is equal to it)."""
        n = self.common(a, b)
        x, y = self.starts[a] + n, self.starts[b] + n
        over_x, over_y = x >= self.ends[a], y >= self.ends[b]
        last = len(self.data) - 1
        less = self.data[np.minimum(x, last)] < self.data[np.minimum(y, last)]
        equal = over_x & over_y
        return np.where(over_x | over_y, over_x & ~over_y, less) | (equal & or_equal)

    def verified(self, a: np.ndarray, b: np.ndarray, lengths: np.ndarray, back: bool = False) -> np.ndarray:
        """Whether the bytes behind equal hashes are equal, from the starts on (or up to them)."""
        if not len(a):
            return np.zeros(0, bool)
        total = np.concatenate([[0], np.cumsum(lengths)])
        step = np.arange(total[-1]) - np.repeat(total[:-1], lengths)
        x, y = self.starts[a] - lengths * back, self.starts[b] - lengths * back
        differs = self.data[np.repeat(x, lengths) + step] != self.data[np.repeat(y, lengths) + step]
        sums = np.concatenate([[0], np.cumsum(differs)])
        return sums[total[1:]] == sums[total[:-1]]


def merge_sorted(suffixes: Suffixes, groups: np.ndarray) -> np.ndarray:
    """The order of suffixes within each run of equal ``groups``: a bottom-up mergesort.

    All groups are merged at once. Each suffix finds its place in the run beside its own by binary
    search, and each comparison is a binary search for the first byte that differs.
    """
    n = len(groups)
    order = np.arange(n)
    new = np.append(True, groups[1:] != groups[:-1]) if n else np.zeros(0, bool)
    begins = np.flatnonzero(new)
    begin = begins[np.cumsum(new) - 1] if n else order
    sizes = np.diff(np.append(begins, n))
    end = begin + np.repeat(sizes, sizes)
    width, largest = 1, int(sizes.max(initial=0))
    place = np.arange(n)
    while width < largest:
        offset = place - begin
        number = offset // width
        odd = (number & 1).astype(bool)
        # The run beside a suffix's own, which may be cut short or missing at a group's end.
        other = begin + (number + np.where(odd, -1, 1)) * width
        low, high = np.minimum(other, end), np.minimum(other + width, end)
        first = low.copy()
        active = np.flatnonzero(low < high)
        while len(active):
            middle = (low[active] + high[active]) >> 1
            mine, theirs = order[active], order[middle]
            # Of equal suffixes those of the left run come first.
            is_odd = odd[active]
            after = np.empty(len(active), bool)
            for flag in (False, True):
                part = is_odd == flag
                after[part] = suffixes.before(theirs[part], mine[part], or_equal=flag)
            low[active[after]] = middle[after] + 1
            high[active[~after]] = middle[~after]
            active = active[low[active] < high[active]]
        start = begin + (number - odd) * width
        target = start + (offset % width) + (low - first)
        moved = np.empty_like(order)
        moved[target] = order
        order = moved
        width *= 2
    return order


def repeats(
    suffixes: Suffixes, groups: np.ndarray, rank: np.ndarray, reach: np.ndarray, count: np.ndarray, length: int = LENGTH
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Which strings around anchors also occur at a smaller rank: (member, bytes before the anchor).

    A member's suffix begins at its anchor; it has ``count`` strings, the first of which begins
    ``reach`` bytes before the anchor and each next one a byte later. In the order of suffixes, the
    strings that begin ``o`` bytes before their anchors are equal if no common extension between them is
    shorter than length - o, and the o bytes before their anchors are equal too.
    """
    n = len(groups)
    order = merge_sorted(suffixes, groups)
    a, b = order[:-1], order[1:]
    same_group = groups[a] == groups[b]
    common = np.where(same_group, suffixes.common(a, b), -1)
    checked = np.flatnonzero(same_group)
    true = suffixes.verified(a[checked], b[checked], common[checked])
    if not true.all():
        raise ValueError("two different strings have one hash")
    found = []
    longest = int(reach.max(initial=0))
    for o in range(longest + 1):
        has = (reach[order] >= o) & (reach[order] - count[order] < o)
        splits = np.append(0, np.cumsum(common < length - o)) if n else np.zeros(0, np.int64)
        at = np.flatnonzero(has)
        if not len(at):
            continue
        block = splits[at]
        # Only blocks with two such members matter.
        pair = np.append(False, block[1:] == block[:-1])
        keep = pair | np.append(pair[1:], False)
        at, block = at[keep], block[keep]
        if not len(at):
            continue
        member = order[at]
        starts = suffixes.starts[member]
        left = span_hashes(suffixes.prefix, starts - o, starts)
        by = np.lexsort((rank[member], left, block))
        member, block, left = member[by], block[by], left[by]
        fresh = np.append(True, (block[1:] != block[:-1]) | (left[1:] != left[:-1]))
        head = member[np.maximum.accumulate(np.where(fresh, np.arange(len(member)), 0))]
        later = np.flatnonzero(~fresh)
        if not suffixes.verified(member[later], head[later], np.full(len(later), o), back=True).all():
            raise ValueError("two different strings have one hash")
        # Equal ranks are rows of one document.
        later = later[rank[member[later]] > rank[head[later]]]
        found.append((member[later], np.full(len(later), o)))
    return found


def anchored_runs(data: np.ndarray, valid: np.ndarray, length: int = LENGTH) -> dict[str, np.ndarray]:
    """Runs of neighbouring strings with one anchor.

    ``valid``: whether a string of ``length`` bytes may begin at each byte. The anchor is the
    leftmost of the string's grams with the smallest hash. Returns for each run: start, count (of
    strings), reach (bytes from the first string's begin to the anchor), anchor (the gram's hash),
    content (a hash of all bytes of the run's strings, and of the anchor's place).
    """
    width = length - GRAM + 1
    names = ("start", "count", "reach", "anchor", "content")
    last = len(data) - length
    if last < 0 or not valid.any():
        return {name: np.zeros(0, np.uint64 if name in names[3:] else np.int64) for name in names}
    prefix = prefix_hashes(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = mixed(span_hashes(prefix, at, at + GRAM))
    least, span = grams, 1
    while span * 2 <= width:
        least = np.minimum(least[: len(least) - span], least[span:])
        span *= 2
    least = np.minimum(least[: last + 1], least[width - span : width - span + last + 1])
    ok = valid[: last + 1]
    changes = ok & np.append(True, ~ok[:-1] | (least[1:] != least[:-1]))
    begin = np.flatnonzero(changes)
    # A run ends before the next one, or where strings stop being valid.
    stops = np.flatnonzero(ok & ~np.append(ok[1:], False))
    end = np.minimum(np.append(begin[1:] - 1, last), stops[np.searchsorted(stops, begin)])
    frames = np.lib.stride_tricks.sliding_window_view(grams, width)
    parts = []
    while len(begin):
        # While the leftmost smallest gram is inside, it is the anchor; then the next one is.
        reach = frames[begin].argmin(axis=1)
        stop = np.minimum(end, begin + reach)
        parts.append((begin, stop - begin + 1, reach))
        more = stop < end
        begin, end = stop[more] + 1, end[more]
    start, count, reach = (np.concatenate(p) for p in zip(*parts, strict=True))
    content = mixed(span_hashes(prefix_hashes(data, OTHER_BASE), start, start + count - 1 + length, OTHER_BASE))
    content = mixed(content + (count * 1000 + reach).astype(np.uint64), SECOND_MIX)
    return {"start": start, "count": count, "reach": reach, "anchor": grams[start + reach], "content": content}


def _texts(batch: pd.DataFrame) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in batch["text"].fillna("")]


def _joined(docs: np.ndarray, first: np.ndarray, past: np.ndarray) -> pd.DataFrame:
    """Stretches of bytes (doc_id, first, past), those that touch or overlap as one.

    Stretches given for one document must not lie inside an earlier one, as those of strings in
    order never do.
    """
    order = np.lexsort((first, docs))
    docs, first, past = docs[order], first[order], past[order]
    fresh = np.append(True, (docs[1:] != docs[:-1]) | (first[1:] > past[:-1])) if len(docs) else np.zeros(0, bool)
    begin = np.flatnonzero(fresh)
    last = np.append(begin[1:] - 1, len(docs) - 1) if len(begin) else begin
    return pd.DataFrame({"doc_id": docs[begin], "first": first[begin], "past": past[last]}).astype("int64")


RUNS = "anchor long, content long, doc_id long, start int, count int, reach int, copy boolean"


def _combined(runs: pd.DataFrame, length: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The first run of each anchor and content, and the stretches of bytes that the others cover."""
    order = np.lexsort([runs[c].to_numpy() for c in ("start", "doc_id", "content", "anchor")])
    runs = runs.iloc[order]
    key, at = runs[["anchor", "content"]].to_numpy(), runs[["doc_id", "start"]].to_numpy()
    fresh = np.append(True, (key[1:] != key[:-1]).any(axis=1))
    head = np.maximum.accumulate(np.where(fresh, np.arange(len(runs)), 0))
    gone = runs[~fresh & (at != at[head]).any(axis=1)]
    past = (gone["start"] + gone["count"] - 1 + length).to_numpy(np.int64)
    return runs[fresh], _joined(gone["doc_id"].to_numpy(), gone["start"].to_numpy(np.int64), past)


def _runs(docs: DataFrame, length: int) -> DataFrame:
    """All runs of all documents, where what a task can see to be repeated is left out: a copy of a
    text with a smaller doc_id, and of equal runs of a batch all but the first. Their bytes are given
    as stretches instead (copy). So a text or line that is very common costs a row a batch.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[bytes, int] = {}
        for batch in batches:
            texts, ids = [], []
            copies = []
            for doc_id, text in zip(batch["doc_id"], _texts(batch), strict=True):
                if len(text) < length:
                    continue
                digest = hashlib.blake2b(text, digest_size=16).digest()
                earlier = seen.get(digest)
                if earlier is not None and earlier <= doc_id:
                    if earlier < doc_id:
                        copies.append((doc_id, len(text)))
                    continue
                if len(seen) < REMEMBERED or earlier is not None:
                    seen[digest] = doc_id
                texts.append(text)
                ids.append(doc_id)
            if copies:
                out = pd.DataFrame(copies, columns=["doc_id", "count"])
                yield out.assign(anchor=0, content=0, start=0, reach=0, copy=True)
            numbers, runs = np.array(ids, np.int64), []
            for part in chunks([len(t) for t in texts]):
                sizes = np.array([len(t) for t in texts[part]])
                begins = np.cumsum(sizes) - sizes
                data = np.frombuffer(b"".join(texts[part]), np.uint8)
                valid = np.zeros(len(data) + 1, np.int8)
                np.add.at(valid, begins, 1)
                np.add.at(valid, begins + sizes - length + 1, -1)
                found = anchored_runs(data, np.cumsum(valid[:-1], dtype=np.int8).astype(bool), length)
                of = np.searchsorted(begins, found["start"], side="right") - 1
                runs.append(
                    pd.DataFrame(
                        {
                            "anchor": found["anchor"].view(np.int64),
                            "content": found["content"].view(np.int64),
                            "doc_id": numbers[part][of],
                            "start": (found["start"] - begins[of]).astype(np.int32),
                            "count": found["count"].astype(np.int32),
                            "reach": found["reach"].astype(np.int32),
                        }
                    )
                )
            if runs:
                first, gone = _combined(pd.concat(runs, ignore_index=True), length)
                yield first.assign(copy=False)
                gone = gone.rename(columns={"first": "start"}).assign(count=gone["past"] - gone["first"])
                yield gone.drop(columns="past").assign(anchor=0, content=0, reach=0, copy=True)

    return docs.where("doc_id is not null").select("doc_id", "text").mapInPandas(run, RUNS)


def _classed(runs: DataFrame, length: int) -> DataFrame:
    """Runs that are repeated: as a whole (remove), or perhaps in part (the others).

    Of runs with equal content the first stays. Runs with one anchor and different contents may
    share some of their strings; the first one of each content goes on to be sorted.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["anchor", "doc_id", "start", "count", "reach"]
        anchor = content = None
        first = (0, 0)  # document and start of the class's first run
        alone: pd.DataFrame | None = None  # the first run of an anchor that has one content so far
        for batch in batches:
            if batch.empty:
                continue
            anchors, contents = batch["anchor"].to_numpy(), batch["content"].to_numpy()
            docs, starts = batch["doc_id"].to_numpy(), batch["start"].to_numpy()
            n = len(batch)
            new_anchor = np.append(anchor is None or anchors[0] != anchor, anchors[1:] != anchors[:-1])
            new_content = new_anchor | np.append(contents[0] != content, contents[1:] != contents[:-1])
            head = np.maximum.accumulate(np.where(new_content, np.arange(n), -1))
            head_doc = np.where(head >= 0, docs[np.maximum(head, 0)], first[0])
            head_start = np.where(head >= 0, starts[np.maximum(head, 0)], first[1])
            removed = ~new_content & ((docs != head_doc) | (starts != head_start))
            # Other contents of an anchor, and its first one once another follows.
            group = np.cumsum(new_anchor)
            others = new_content & ~new_anchor
            several = np.bincount(group, others, minlength=group[-1] + 1) > 0
            sorted_ = others | (new_anchor & several[group])
            if alone is not None and several[0]:
                yield alone.assign(remove=False)
            continues = group[-1] == 0
            if not continues or several[0]:
                alone = None
            last = np.flatnonzero(new_anchor & (group == group[-1]) & ~several[group])
            if len(last):
                alone = batch.iloc[last][columns]
            out = batch[columns].assign(remove=removed)
            yield out[removed | sorted_]
            anchor, content = anchors[-1], contents[-1]
            first = (head_doc[-1], head_start[-1])

    return (
        runs.where("not copy")
        .select("anchor", "content", "doc_id", "start", "count", "reach")
        .repartition("anchor")
        .sortWithinPartitions("anchor", "content", "doc_id", "start")
        .mapInPandas(run, "anchor long, doc_id long, start int, count int, reach int, remove boolean")
    )


STRETCH = "doc_id long, first long, past long"


def _partly_repeated(docs: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """Sort the runs that may share strings by the text around their anchors: stretches to remove."""
    wanted = runs.groupBy("doc_id").agg(
        F.collect_list(F.struct("anchor", "start", "count", "reach", "large")).alias("runs")
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc_id, text, found in zip(batch["doc_id"], _texts(batch), batch["runs"], strict=True):
                rows = [
                    (r["anchor"], doc_id, r["start"], r["count"], r["reach"], r["large"],
                     text[r["start"] : r["start"] + r["count"] - 1 + length])
                    for r in found
                ]
                yield pd.DataFrame(rows, columns=["anchor", "doc_id", "start", "count", "reach", "large", "around"])

    cuts = materialize(
        docs.select("doc_id", "text")
        .join(wanted, "doc_id")
        .mapInPandas(cut, "anchor long, doc_id long, start int, count int, reach int, large boolean, around binary")
    )

    def compared(rows: pd.DataFrame) -> pd.DataFrame:
        sizes = rows["around"].map(len).to_numpy()
        begins = np.cumsum(sizes) - sizes
        reach, count = rows["reach"].to_numpy(np.int64), rows["count"].to_numpy(np.int64)
        ids, starts = rows["doc_id"].to_numpy(), rows["start"].to_numpy(np.int64)
        anchors = starts + reach
        by = np.lexsort((anchors, ids))
        step = np.append(0, (ids[by][1:] != ids[by][:-1]) | (anchors[by][1:] != anchors[by][:-1]))
        rank = np.empty(len(rows), np.int64)
        rank[by] = np.cumsum(step)
        data = np.frombuffer(b"".join(rows["around"]), np.uint8)
        suffixes = Suffixes(data, begins + reach, begins + sizes)
        found = repeats(suffixes, rows["anchor"].to_numpy(), rank, reach, count, length)
        member = np.concatenate([np.zeros(0, np.int64), *(m for m, _ in found)])
        before = np.concatenate([np.zeros(0, np.int64), *(o for _, o in found)])
        at = anchors[member] - before
        return _joined(ids[member], at, at + length)

    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            size += int(batch["around"].map(len).sum())
            held.append(batch)
            if size >= SORTED_BYTES:
                rows = pd.concat(held, ignore_index=True)
                # The last group may go on in the next batch.
                open_ = rows["anchor"] == rows["anchor"].iloc[-1]
                if not open_.all():
                    yield compared(rows[~open_])
                held = [rows[open_]]
                size = int(held[0]["around"].map(len).sum())
        if held:
            yield compared(pd.concat(held, ignore_index=True))

    small = (
        cuts.where("not large")
        .drop("large")
        .repartition("anchor")
        .sortWithinPartitions("anchor", "doc_id", "start")
        .mapInPandas(sort, STRETCH)
    )
    large = cuts.where("large")
    if large.isEmpty():
        return small

    def strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for around, doc_id, start, count in zip(
                batch["around"], batch["doc_id"], batch["start"], batch["count"], strict=True
            ):
                data = np.frombuffer(bytes(around), np.uint8)
                at = np.arange(count)
                pair = [
                    mixed(span_hashes(prefix_hashes(data, base), at, at + length, base)).view(np.int64)
                    for base in (BASE, OTHER_BASE)
                ]
                yield pd.DataFrame({"one": pair[0], "two": pair[1], "doc_id": doc_id, "start": start + at})

    windows = materialize(large.mapInPandas(strings, "one long, two long, doc_id long, start long"))
    firsts = materialize(
        windows.groupBy("one", "two").agg(F.min(F.struct("doc_id", "start")).alias("head"), F.count("*").alias("n"))
    )
    later = windows.join(firsts.where("n > 1"), ["one", "two"]).where(
        (F.col("doc_id") != F.col("head.doc_id")) | (F.col("start") != F.col("head.start"))
    )
    return small.union(later.select("doc_id", F.col("start").alias("first"), (F.col("start") + length).alias("past")))


def remove_repeats(docs: DataFrame, length: int = LENGTH, large_group: int = LARGE_GROUP) -> DataFrame:
    """Remove from ``docs`` (doc_id, text) each byte that a string of ``length`` bytes covers which
    also starts earlier: in a document with a smaller doc_id, or before in the same document.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, kept (the bytes
    that stay) for each row. Strings are judged on the input, overlaps count, and none crosses
    documents.

    How: a string's anchor is its gram with the smallest hash, so equal strings have equal anchors
    at the same place. Neighbouring strings with one anchor are a run; one shuffle brings runs with
    equal anchors together. Runs of equal content are repeated as a whole. Where an anchor has
    several contents, the suffixes from it on are sorted: common extensions are found by binary
    search over prefix polynomial hashes, so a comparison of the mergesort takes logarithmic time, and
    bytes are compared wherever hashes say that they are equal. Neighbours in the order with a long
    enough extension, and equal bytes before the anchor, are repeats.

    Runs of equal content count as equal by two 64-bit hashes over different polynomials. An anchor
    with more than ``large_group`` contents is not sorted in one task: its strings are grouped by two
    such hashes over all tasks, with partial sums, so a passage in any part of the documents is spread.

    Edge cases: null texts are empty; texts shorter than ``length`` stay whole; rows that repeat a
    doc_id count as one document with one text, and get the same answer; documents without a doc_id
    stay whole and nothing is removed on their account. Other columns are ignored.
    """
    written = materialize(_runs(docs, length))
    copies = written.where("copy").select(
        "doc_id",
        F.col("start").cast("long").alias("first"),
        (F.col("start") + F.col("count")).cast("long").alias("past"),
    )
    classed = materialize(_classed(written, length))
    whole = classed.where("remove").select(
        "doc_id",
        F.col("start").cast("long").alias("first"),
        (F.col("start") + F.col("count") - 1 + length).cast("long").alias("past"),
    )
    partly = classed.where("not remove")
    sizes = partly.groupBy("anchor").agg(F.count("*").alias("members")).where(F.col("members") > large_group)
    several = partly.join(materialize(sizes), "anchor", "left").withColumn("large", F.col("members").isNotNull())
    sorted_ = _partly_repeated(docs, several, length)
    stretches = (
        whole.union(copies)
        .union(sorted_)
        .groupBy("doc_id")
        .agg(F.array_sort(F.collect_set(F.struct("first", "past"))).alias("stretches"))
    )

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text, found in zip(batch["doc_id"], _texts(batch), batch["stretches"], strict=True):
                parts, at, spans, removed = [], 0, 0, 0
                for stretch in found if found is not None else ():
                    first, past = stretch["first"], stretch["past"]
                    if first > at or not spans:
                        parts.append(text[at:first])
                        spans += 1
                        removed += past - first
                        at = past
                    elif past > at:
                        removed += past - at
                        at = past
                parts.append(text[at:])
                kept = b"".join(parts)
                rows.append(
                    (None if pd.isna(doc_id) else int(doc_id), len(text), removed, spans, hashlib.sha256(kept).hexdigest(), kept)
                )
            out = pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
            yield out.astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").join(stretches, "doc_id", "left").mapInPandas(
        keep, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
