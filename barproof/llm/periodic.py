"""Runs of words that repeat with a period, by suffix automata with link-cut access."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barproof.llm.rolling import OTHER_BASE, column_texts, mixed, word_hashes

#: Words that a run has at least.
LEAST = 12
#: Rounds of leaving out words that no run can hold; any number gives the same runs.
SCREENS = 3

_RUNS = "runs array<struct<start:bigint,length:bigint,period:bigint>>"


def automaton(ids: list[int]) -> tuple[list[int], list[int], list[int]]:
    """The suffix automaton's links, lengths of the longest strings, and the state of each prefix."""
    after: list[dict[int, int]] = [{}]
    link, length, prefixes = [-1], [0], []
    last = 0
    for word in ids:
        state = len(after)
        after.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at != -1 and word not in after[at]:
            after[at][word] = state
            at = link[at]
        if at != -1:
            target = after[at][word]
            if length[target] == length[at] + 1:
                link[state] = target
            else:
                clone = len(after)
                after.append(after[target].copy())
                length.append(length[at] + 1)
                link.append(link[target])
                while at != -1 and after[at].get(word) == target:
                    after[at][word] = clone
                    at = link[at]
                link[target] = link[state] = clone
        last = state
        prefixes.append(state)
    return link, length, prefixes


def heavy_paths(link: list[int], length: list[int]) -> list[int]:
    """The top of each state's path, where every state's largest child goes on with its path."""
    order = np.argsort(np.array(length), kind="stable").tolist()
    size = [1] * len(link)
    for state in reversed(order[1:]):
        size[link[state]] += size[state]
    heavy = [-1] * len(link)
    for state in order[1:]:
        parent = link[state]
        if heavy[parent] < 0 or size[state] > size[heavy[parent]]:
            heavy[parent] = state
    top = [0] * len(link)
    for state in order[1:]:
        top[state] = top[link[state]] if heavy[link[state]] == state else state
    return top


def squares(ids: list[int]) -> Iterator[tuple[int, int, int]]:
    """(end, earlier end, length): the longest strings that end at both, where they touch or overlap.

    Appending a word accesses the path from the new prefix to the root of the tree of links. All
    states on it get the word's place as the last end of their strings. Before that, the path falls
    into segments that were last recoloured together; a segment's deepest state has its longest
    string. Segments are stacks along heavy paths, those near a path's top last: an access takes
    segments off a stack and puts one on, and meets O(log n) heavy paths.
    """
    link, length, prefixes = automaton(ids)
    top = heavy_paths(link, length)
    stacks: list[list[tuple[int, int]]] = [[] if top[state] == state else None for state in range(len(link))]
    for end, state in enumerate(prefixes):
        while state > 0:
            head, longest = top[state], length[state]
            stack = stacks[head]
            while stack:
                deepest, earlier = stack[-1]
                shared = deepest if deepest < longest else longest
                if end - earlier <= shared:
                    yield end, earlier, shared
                if deepest > longest:
                    break
                stack.pop()
                if deepest == longest:
                    break
            stack.append((longest, end))
            state = link[head]


def runs(ids: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of at least ``least`` words and two periods, by start."""
    out, until = [], {}
    for end, earlier, shared in squares(ids):
        period = end - earlier
        # A square inside the last run of its period belongs to that run.
        if until.get(period, -1) >= end:
            continue
        start, stop = earlier - shared + 1, end + 1
        while start and ids[start - 1] == ids[start - 1 + period]:
            start -= 1
        while stop < len(ids) and ids[stop] == ids[stop - period]:
            stop += 1
        until[period] = stop - 1
        if stop - start >= max(least, 2 * period):
            out.append((start, stop - start, period))
    return sorted(out, key=lambda run: (run[0], run[2]))


def suspects(hashes: np.ndarray, bounds: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """Stretches of words (begin, end) that hold all runs; equal words have equal hashes.

    A run of length n and period q has n - q words that are repeated q words on, and as many that
    are repeated q words before. Both are at least half of ``least``, and together they are the whole
    run. So each word of a run is in a string of least / 2 words that occurs again in that run.
    """
    width = max(1, least // 2)
    begins, ends = bounds[:-1], bounds[1:]
    if len(hashes) < width:
        return []
    strings = np.full(len(hashes) - width + 1, np.uint64(width), np.uint64)
    for i in range(width):
        strings *= np.uint64(OTHER_BASE)
        strings += hashes[i : len(hashes) - width + 1 + i]
    for _ in range(SCREENS):
        wide = ends - begins >= least
        begins, ends = begins[wide], ends[wide]
        if not len(begins):
            return []
        # Places where a string of a stretch begins, with the stretch.
        counts = ends - begins - width + 1
        stretch = np.repeat(np.arange(len(begins)), counts)
        place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + begins[stretch]
        keys = strings[place] ^ mixed(stretch.astype(np.uint64))
        order = np.argsort(keys, kind="stable")
        equal = keys[order][1:] == keys[order][:-1]
        again = np.zeros(len(keys), bool)
        again[order[1:][equal]] = again[order[:-1][equal]] = True
        edges = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(edges, place[again], 1)
        np.add.at(edges, place[again] + width, -1)
        covered = np.cumsum(edges[:-1]) > 0
        # Stretches do not run on over the borders of earlier ones.
        inside = np.concatenate([[False], covered, [False]])
        first = covered & ~inside[:-2]
        first[begins] |= covered[begins]
        final = covered & ~inside[2:]
        final[ends - 1] |= covered[ends - 1]
        found = np.flatnonzero(first), np.flatnonzero(final) + 1
        same = len(found[0]) == len(begins) and (found[0] == begins).all() and (found[1] == ends).all()
        begins, ends = found
        if same:
            break
    return [(a, b) for a, b in zip(begins.tolist(), ends.tolist(), strict=True) if b - a >= least]


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words joined by blanks, of each run only its first period, less what other runs drop."""
    kept = np.ones(len(words), bool)
    for start, length, period in found:
        kept[start + period : start + length] = False
    return b" ".join(words[i] for i in np.flatnonzero(kept).tolist())


def _searched(texts: list[bytes], least: int) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """The runs of each text, and what it is without their repetitions."""
    hashes, bounds = word_hashes(texts)
    stretches: dict[int, list[tuple[int, int]]] = {}
    for begin, end in suspects(hashes, bounds, least):
        number = int(np.searchsorted(bounds, begin, side="right")) - 1
        stretches.setdefault(number, []).append((begin - int(bounds[number]), end - int(bounds[number])))
    for number, text in enumerate(texts):
        words, found = text.split(), []
        for begin, end in stretches.get(number, ()):
            known: dict[bytes, int] = {}
            ids = [known.setdefault(word, len(known)) for word in words[begin:end]]
            found += [(begin + start, length, period) for start, length, period in runs(ids, least)]
        found.sort(key=lambda run: (run[0], run[2]))
        yield found, collapsed(words, found) if found else b" ".join(words)


def word_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Runs of words in ``docs`` (doc_id, text): doc_id, runs (start, length, period), collapsed.

    Words are runs without white space, numbered from 0. A run is a stretch of words with the
    smallest period q, at least ``least`` words and 2 * q long, that no neighbouring word extends.
    ``runs`` are sorted by start and period. ``collapsed`` is the text's words joined by blanks
    without those that any run holds after its first q words.

    How: each text is searched by itself in a task, whole. A suffix automaton is built over its
    words; each appended word accesses the path to the root, and what was last recoloured together
    there gives the squares that end at the word. Squares are extended to runs, each once. In
    n words that is O(n log n) steps. Beforehand, words that lie in no string of least / 2 words
    that occurs twice are left out, as no run can hold them; prose is mostly gone by then.

    How the method is departed from: all words are known when a text is read, so the automaton is
    complete before the first access, and preferred paths are kept as stacks along its heavy paths
    instead of in splay trees. The segments an access finds are the same.

    Edge cases: null texts and texts without words have no runs and collapse to an empty text; a
    null doc_id stays null; rows are independent of each other, so repeated rows repeat their result.
    A text of any length is searched whole, in memory proportional to its longest stretch of
    repeated strings. Other columns are ignored. An empty table gives no rows.
    """

    names = ("start", "length", "period")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in column_texts(batch.column("text")):
                found, short = zip(*_searched(texts, least), strict=True)
                named = [[dict(zip(names, r, strict=True)) for r in one] for one in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, len(texts)),
                        pa.array(named, pa.list_(pa.struct([(n, pa.int64()) for n in names]))),
                        pa.array(short, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "runs", "collapsed"],
                )
                at += len(texts)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id bigint, {_RUNS}, collapsed string")


#: Fixed value: the words of the contracts.
WORD = r"[^\\x20\\x09-\\x0D]+"


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the texts repeat words from some place on.

    The checksum h of the id decides which: those with h % 10 = 0, at a = g % n of n words with
    g = h div 10, by the period 1 + (n - a) div (3 + g % 8). A null id counts as an empty text.
    """
    checked = docs.selectExpr(
        "doc_id", "text", "crc32(cast(coalesce(cast(doc_id as string), '') as binary)) as h"
    ).selectExpr(
        "doc_id", "text", "h div 10 as g", f"case when h % 10 = 0 then regexp_extract_all(text, '{WORD}', 0) end as words"
    )
    placed = checked.selectExpr("*", "case when size(words) > 0 then int(g % size(words)) end as a").selectExpr(
        "*", "int(1 + (size(words) - a) div (3 + g % 8)) as p"
    )
    planted = "transform(words, (word, i) -> case when i < a then word else get(words, a + (i - a) % p) end)"
    return placed.selectExpr("doc_id", f"case when a is not null then array_join({planted}, ' ') else text end as text")


def run_digests(docs: DataFrame) -> DataFrame:
    """The longest run of each document, and digests of its runs and of the collapsed text."""
    lines = "array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\n'), '')"
    longest = "array_sort(runs, (x, y) -> case when x.length <> y.length then int(sign(y.length - x.length)) " \
        "when x.start <> y.start then int(sign(x.start - y.start)) else int(sign(x.period - y.period)) end)"
    return word_runs(docs).selectExpr("*", f"get({longest}, 0) as best").selectExpr(
        "doc_id",
        "cast(size(runs) as bigint) as n_runs",
        "best.start as start",
        "best.length as length",
        "best.period as period",
        "(1000 * best.length) div best.period as exponent_milli",
        f"sha2(cast({lines} as binary), 256) as runs_sha256",
        "sha2(cast(collapsed as binary), 256) as collapsed_sha256",
    )


SQL = r"""
with h as (
  select doc_id, coalesce(text, '') as text, xor(list_reduce(
      flatten(list_transform(string_split(cast(doc_id as varchar), ''),
                             lambda c: [cast(ascii(c) as bigint), -1, -1, -1, -1, -1, -1, -1, -1])),
      lambda c, x: case when x >= 0 then xor(c, x) else xor(c >> 1, case when c & 1 = 1 then 3988292384 else 0 end) end,
      cast(4294967295 as bigint)), cast(4294967295 as bigint)) as h
  from documents
), w as (
  select doc_id, h, h // 10 as g, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w from h
), a as (
  select *, len(w) as n, case when h % 10 = 0 and len(w) > 0 then g % len(w) end as a from w
), p as (
  select *, 1 + (n - a) // (3 + g % 8) as p from a
), d as materialized (
  select doc_id, n, case when a is null then w else list_transform(range(n),
         lambda i: case when i < a then w[i + 1] else w[a + (i - a) % p + 1] end) end as w
  from p
), grams as materialized (
  select doc_id, i, md5(array_to_string(w[i + 1 : i + 6], ' ')) as gram
  from (select doc_id, w, unnest(range(n - 5)) as i from d where n >= 12)
), pairs as (
  select x.doc_id, x.i, y.i - x.i as q from grams x join grams y on x.doc_id = y.doc_id and x.gram = y.gram and x.i < y.i
), islands as (
  select doc_id, q, i, i - row_number() over (partition by doc_id, q order by i) as island from pairs
), stretches as (
  select doc_id, q, min(i) as start, count(*) + 5 + q as length from islands group by doc_id, q, island
), runs as materialized (
  select doc_id, start, length, min(q) as period from stretches
  where length >= 12 and length >= 2 * q group by doc_id, start, length
), best as (
  select * from runs qualify row_number() over (partition by doc_id order by length desc, start, period) = 1
), lines as (
  select doc_id, count(*) as n_runs,
         string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines
  from runs group by doc_id
), dropped as (
  select distinct doc_id, unnest(range(start + period, start + length)) as i from runs
), kept as (
  select doc_id, string_agg(word, ' ' order by i) as collapsed
  from (select doc_id, unnest(range(n)) as i, unnest(w) as word from d) words
  where not exists (select 1 from dropped x where x.doc_id = words.doc_id and x.i = words.i)
  group by doc_id
)
select d.doc_id, cast(coalesce(n_runs, 0) as bigint) as n_runs, cast(start as bigint) as start,
       cast(length as bigint) as length, cast(period as bigint) as period,
       cast((1000 * length) // period as bigint) as exponent_milli,
       sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(collapsed, '')) as collapsed_sha256
from d left join best using (doc_id) left join lines using (doc_id) left join kept using (doc_id)
"""
