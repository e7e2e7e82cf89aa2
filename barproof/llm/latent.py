"""Benchmark decontamination by latent semantic retrieval."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barproof.llm.rolling import SIGNS, chunks, word_hashes

#: Hashed vocabulary, latent dimensions, extra dimensions of the basis, rows of the random sketch.
DIM = 1 << 14
RANK = 80
EXTRA = 16
SKETCH = 128
SEED = 11
#: Words of a block; windows are 2 blocks, or 1 for items of fewer words than BRIEF, or 4 for items
#: of LONG words and more.
BLOCK = 8
SHORT, LONG_BLOCKS = 2, 4
BRIEF, LONG = 12, 40
#: Cosine from which a window is looked at closely: of two blocks (which may hold a fourth of other
#: words), and of four. Stretches below that are looked at by their words, see ``Stretches``.
LEAST_COSINES = (0.62, 0.75)
#: Part of an item's words that a text has in their order: enough alone, or with the answer.
LEAST_LCS, LEAST_LCS_WITH_ANSWER = 0.75, 0.6
#: Words at an item's end that count as its answer, and how many of them a text must have in order.
ANSWER_WORDS, ANSWER_FOUND = 6, 5
#: Items of one pass over the corpus.
ITEMS_PER_PASS = 2000
#: Rows of a part of a matrix, and bytes of text whose arrays are in memory at a time.
PART = 1024
CHUNK = 1 << 19
#: First sums of partial matrices meet in so many groups.
SPREAD = 64


def _encoded(texts: pd.Series) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in texts.fillna("")]


@dataclass
class Chunk:
    """Words of some texts: hashes, where each text's begin (and the end), first text's number."""

    first: int
    words: np.ndarray
    bounds: np.ndarray

    @property
    def buckets(self) -> np.ndarray:
        return (self.words % np.uint64(DIM)).astype(np.int64)


def _chunks(texts: list[bytes]) -> Iterator[Chunk]:
    for part in chunks([len(t) for t in texts], CHUNK):
        words, bounds = word_hashes(texts[part], SIGNS)
        yield Chunk(part.start, words, bounds)


def block_sums(chunk: Chunk, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of word vectors over blocks of each text, and where each text's blocks begin.

    ``vectors`` has a row of zeros at the end, for the places after a text's last word.
    """
    lengths = np.diff(chunk.bounds)
    blocks = np.maximum(1, -(-lengths // BLOCK))
    begins = np.concatenate([[0], np.cumsum(blocks)])
    places = np.full(begins[-1] * BLOCK, DIM, np.int64)
    shift = np.repeat(begins[:-1] * BLOCK - chunk.bounds[:-1], lengths)
    places[np.arange(len(chunk.words)) + shift] = chunk.buckets
    return vectors[places].reshape(-1, BLOCK, vectors.shape[1]).sum(axis=1), begins


def windows(sums: np.ndarray, begins: np.ndarray, width: int, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors of windows of ``width`` blocks every ``step`` blocks; their texts and first blocks.

    The last window of a text ends with it; a text of fewer blocks is one window.
    """
    counts = np.diff(begins)
    per_text = np.maximum(1, -(-(counts - width) // step) + 1)
    text = np.repeat(np.arange(len(counts)), per_text)
    order = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    start = np.minimum(order * step, np.maximum(0, counts[text] - width))
    total = np.zeros((len(text), sums.shape[1]), sums.dtype)
    for i in range(width):
        inside = start + i < counts[text]
        total[inside] += sums[begins[text[inside]] + start[inside] + i]
    return total, text, start


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _with_zeros(matrix: np.ndarray) -> np.ndarray:
    return np.vstack([matrix, np.zeros((1, matrix.shape[1]), matrix.dtype)]).astype(np.float32)


def _summed(parts: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """Sum matrices that tasks have made, in parts of ``PART`` rows: (part, deal, cells).

    Rows of one part and deal are read one after the other and added to a single sum, so memory does
    not depend on the number of tasks.
    """
    schema = "part int, deal int, cells binary"

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, total = None, np.zeros(0)
        for batch in batches:
            for part, deal, cells in zip(batch["part"], batch["deal"], batch["cells"], strict=True):
                more = np.frombuffer(cells, np.float32).astype(np.float64)
                if key == (part, deal):
                    total += more
                    continue
                if key:
                    yield one(key, total)
                key, total = (part, deal), more
        if key:
            yield one(key, total)

    def one(key: tuple, total: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"part": [key[0]], "deal": [key[1]], "cells": [total.astype(np.float32).tobytes()]})

    def met(rows: DataFrame) -> DataFrame:
        return rows.repartition("part", "deal").sortWithinPartitions("part", "deal").mapInPandas(added, schema)

    first = met(parts).withColumn("deal", F.lit(0))
    out = np.zeros(shape)
    for row in met(first).toLocalIterator():
        cells = np.frombuffer(row["cells"], np.float32).reshape(-1, shape[1])
        out[row["part"] * PART : row["part"] * PART + len(cells)] = cells
    return out


def _parts(matrix: np.ndarray) -> pd.DataFrame:
    cells = [matrix[i : i + PART].astype(np.float32).tobytes() for i in range(0, len(matrix), PART)]
    return pd.DataFrame({"part": range(len(cells)), "deal": TaskContext.get().partitionId() % SPREAD, "cells": cells})


def frequencies_and_sketch(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Inverse document frequency of each hashed word over all documents, and a sketch of all passages.

    With A as the TF-IDF passages (rows) by hashed words (columns), the sketch is S A, where a random S
    adds each passage with a random sign to one of ``SKETCH`` rows. Weights belong to columns, so words are
    added as they are and weighted at the end; one pass gives both. Returns idf and (S A)'.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        random = np.random.default_rng([SEED, TaskContext.get().partitionId()])
        total, having, rows = np.zeros(SKETCH * DIM), np.zeros(DIM, np.int64), 0
        passage_words = BLOCK * LONG_BLOCKS
        for batch in batches:
            rows += len(batch)
            for chunk in _chunks(_encoded(batch["text"])):
                lengths, buckets = np.diff(chunk.bounds), chunk.buckets
                text = np.repeat(np.arange(len(lengths)), lengths)
                # A text and a word each once; small numbers are sorted faster.
                keys = text * DIM + buckets
                keys = np.sort(keys.astype(np.int32) if len(lengths) < (1 << 31) // DIM - 1 else keys)
                having += np.bincount(keys[np.append(True, keys[1:] != keys[:-1])[: len(keys)]] % DIM, minlength=DIM)
                per_text = -(-lengths // passage_words)
                place = np.arange(len(chunk.words)) - np.repeat(chunk.bounds[:-1], lengths)
                passage = np.repeat(np.cumsum(per_text) - per_text, lengths) + place // passage_words
                count = int(per_text.sum())
                row, sign = random.integers(0, SKETCH, count), random.choice([-1.0, 1.0], count)
                np.add.at(total, row[passage] * DIM + buckets, sign[passage])
        # The last column has the documents with a word, the last row the number of all.
        out = np.zeros((DIM + 1, SKETCH + 1))
        out[:DIM, :SKETCH], out[:DIM, SKETCH], out[DIM, SKETCH] = total.reshape(SKETCH, DIM).T, having, rows
        yield _parts(out)

    parts = docs.select("text").mapInPandas(counted, "part int, deal int, cells binary")
    sums = _summed(parts, (DIM + 1, SKETCH + 1))
    idf = np.log((sums[DIM, SKETCH] + 1) / (sums[:DIM, SKETCH] + 1)) + 0.1
    return idf, sums[:DIM, :SKETCH] * idf[:, None]


def latent_vectors(docs: DataFrame, idf: np.ndarray, sketch: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Word vectors of a randomised SVD of all TF-IDF passages A, scaled by the singular values.

    The sketch's first right singular vectors V span nearly what those of A do; a pass over the passages
    sums (A V)' (A V), whose eigenvectors turn V into the singular vectors. Tasks send sums only, of a
    fixed size, and these meet in two steps.
    """
    context = docs.sparkSession.sparkContext
    columns = rank + EXTRA
    texts = docs.select("text")
    shape = "part int, deal int, cells binary"
    left, _, _ = np.linalg.svd(sketch, full_matrices=False)
    basis = left[:, :columns]
    project = context.broadcast(_with_zeros(basis * idf[:, None]))

    def squared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((columns, columns))
        for batch in batches:
            for chunk in _chunks(_encoded(batch["text"])):
                rows, _, _ = windows(*block_sums(chunk, project.value), LONG_BLOCKS, LONG_BLOCKS)
                total += rows.T @ rows
        yield _parts(total)

    gram = _summed(texts.mapInPandas(squared, shape), (columns, columns))
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    best = np.argsort(values)[::-1][:rank]
    scale = 1 / np.sqrt(np.maximum(values[best], max(values.max(), 1e-12) * 1e-9))
    return _with_zeros((basis @ vectors[:, best]) * scale * idf[:, None])


def common_subsequence(masks: dict[int, int], words: list[int]) -> int:
    """Length of the longest common subsequence, by bits of one big integer.

    ``masks``: for each word of the first text the bits of its places.
    """
    row = 0
    for word in words:
        if mask := masks.get(word):
            either = row | mask
            # Of each run of ends, the lowest place of the word moves the end down.
            row = either & ~(either - ((row << 1) | 1)) if row or mask else row
    return row.bit_count()


def masks_of(words: list[int]) -> dict[int, int]:
    masks: dict[int, int] = {}
    for i, word in enumerate(words):
        masks[word] = masks.get(word, 0) | 1 << i
    return masks


@dataclass
class Item:
    """A benchmark item's words, and those of its answer."""

    item_id: int
    words: list[int]

    def __post_init__(self):
        self.masks = masks_of(self.words)
        self.answer = self.words[-ANSWER_WORDS:]
        self.answer_masks = masks_of(self.answer)
        #: Words of a stretch that is held against the item, and how many of the item's it has at least.
        self.span = len(self.words) + len(self.words) // 4
        self.least = math.ceil(len(self.words) * LEAST_LCS_WITH_ANSWER)

    def judged(self, near: list[int]) -> tuple[float, bool] | None:
        """The best part of the item's words found in order, and whether the answer is there.

        Every stretch of ``span`` words is judged on its own, with an eighth of the item on either
        side for the answer. Of those accepted the largest ratio is returned.
        """
        n, masks = len(self.words), self.masks
        if sum(map(masks.__contains__, near)) < self.least or common_subsequence(masks, near) < self.least:
            return None
        span, margin = self.span, max(1, n // 8)
        known = np.cumsum([0, *map(masks.__contains__, near)])
        starts = np.arange(max(1, len(near) - span + 1))
        counts = known[np.minimum(starts + span, len(near))] - known[starts]
        best = None
        for at in starts[counts >= self.least].tolist():
            ratio = common_subsequence(masks, near[at : at + span]) / n
            if ratio < LEAST_LCS_WITH_ANSWER or (best and ratio < best[0]):
                continue
            close = near[max(0, at - margin) : at + span + margin]
            answer = common_subsequence(self.answer_masks, close) >= min(ANSWER_FOUND, len(self.answer))
            if (answer or ratio >= LEAST_LCS) and (best is None or (ratio, answer) > best):
                best = ratio, answer
                if best == (1.0, True):
                    break
        return best


class Stretches:
    """Where texts have so many of an item's rarer words that the item may be there.

    A stretch of ``span`` words that counts has ``least`` of the item's words or more. The item's
    commonest words are left out, in all ``least - need`` places of the item at most, so ``need``
    words of the stretch are others of the item. No stretch that counts is passed over, whatever
    the inverse frequencies ``idf`` are.
    """

    def __init__(self, items: list[Item], idf: np.ndarray):
        words, of, need = [], [], []
        for number, item in enumerate(items):
            often = {word: mask.bit_count() for word, mask in item.masks.items()}
            need.append(max(1, item.least // 3))
            left_out = 0
            for word in sorted(often, key=lambda w: (idf[w % DIM], w)):
                left_out += often[word]
                if left_out > item.least - need[-1]:
                    words.append(word)
                    of.append(number)
        order = np.argsort(np.array(words, np.uint64), kind="stable")
        self.words, first = np.unique(np.array(words, np.uint64)[order], return_index=True)
        self.bounds = np.append(first, len(words))
        self.of = np.array(of, np.int64)[order]
        self.need, self.span = np.array(need, np.int64), np.array([i.span for i in items], np.int64)
        self.buckets = np.zeros(DIM, bool)
        self.buckets[(self.words % np.uint64(DIM)).astype(np.int64)] = True

    def within(self, chunk: Chunk) -> Iterator[tuple[int, int, int]]:
        """(text, item, place of a word in the text): the stretches around these places."""
        place = np.flatnonzero(self.buckets[chunk.buckets]) if len(self.words) else np.zeros(0, np.int64)
        at = np.searchsorted(self.words, chunk.words[place])
        known = self.words[np.minimum(at, len(self.words) - 1)] == chunk.words[place] if len(place) else place > 0
        place, at = place[known], at[known]
        counts = self.bounds[at + 1] - self.bounds[at]
        spare = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        item, place = self.of[np.repeat(self.bounds[at], counts) + spare], np.repeat(place, counts)
        order = np.argsort(item, kind="stable")
        item, place = item[order], place[order]
        text = np.searchsorted(chunk.bounds, place, side="right") - 1
        last = np.arange(len(item)) + self.need[item] - 1
        inside = last < len(item)
        last = np.minimum(last, len(item) - 1)
        inside &= (item[last] == item) & (text[last] == text) & (place[last] - place < self.span[item])
        text, item, place = text[inside], item[inside], place[inside]
        return zip(text.tolist(), item.tolist(), (place - chunk.bounds[text]).tolist(), strict=True)


def _queries(items: list[Item], vectors: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of windows over the items whose windows have ``blocks``, every quarter window."""
    width, step = blocks * BLOCK, blocks * BLOCK // 4
    rows, of = [], []
    for number, item in enumerate(items):
        n = len(item.words)
        if blocks != (1 if n < BRIEF else LONG_BLOCKS if n >= LONG else SHORT):
            continue
        buckets = np.array(item.words, np.uint64) % np.uint64(DIM)
        for at in range(0, max(1, len(buckets) - width + step), step):
            rows.append(vectors[buckets[at : at + width].astype(np.int64)].sum(axis=0))
            of.append(number)
    return _unit(np.array(rows).reshape(-1, vectors.shape[1])), np.array(of, np.int64)


def _matches(
    docs: DataFrame, items: list[Item], vectors: np.ndarray, idf: np.ndarray, least_cosines: tuple[float, float], by_words: bool
) -> DataFrame:
    model = docs.sparkSession.sparkContext.broadcast((vectors, idf, [(i.item_id, i.words) for i in items]))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors, idf, raw = model.value
        items = [Item(*pair) for pair in raw]
        stretches = Stretches(items, idf)
        scales = [
            (1, 1, least_cosines[0], *_queries(items, vectors, 1)),
            (SHORT, 1, least_cosines[0], *_queries(items, vectors, SHORT)),
            (LONG_BLOCKS, 2, least_cosines[1], *_queries(items, vectors, LONG_BLOCKS)),
        ]
        for batch in batches:
            found = []
            ids = batch["doc_id"].tolist()
            for chunk in _chunks(_encoded(batch["text"])):
                sums, begins = block_sums(chunk, vectors)
                near: dict[tuple[int, int], list[tuple[int, int]]] = {}
                compared: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
                for width, step, least, queries, of in scales:
                    if not len(of):
                        continue
                    rows, text, start = windows(sums, begins, width, step)
                    rows = _unit(rows)
                    compared.update((number, (rows, text, queries[of == number])) for number in np.unique(of).tolist())
                    for low in range(0, len(rows), 4096):
                        close = rows[low : low + 4096] @ queries.T >= least
                        for w in np.flatnonzero(close.any(axis=1)).tolist():
                            first = int(start[low + w]) * BLOCK
                            for number in of[close[w]].tolist():
                                near.setdefault((int(text[low + w]), number), []).append((first, first + width * BLOCK))
                for text, number, at in stretches.within(chunk) if by_words else ():
                    near.setdefault((text, number), []).append((at, at + 1))
                for (text, number), hits in near.items():
                    item = items[number]
                    words = chunk.words[chunk.bounds[text] : chunk.bounds[text + 1]]
                    best = None
                    for first, last in _merged(hits, item.span):
                        judged = item.judged(words[first:last].tolist())
                        if judged and (best is None or judged > best):
                            best = judged
                    if best:
                        rows, of_text, queries = compared[number]
                        own = slice(*np.searchsorted(of_text, [text, text + 1]))
                        cosine = float((rows[own] @ queries.T).max())
                        found.append((ids[chunk.first + text], item.item_id, cosine, *best))
            yield pd.DataFrame(found, columns=["doc_id", "item_id", "cosine", "lcs_ratio", "answer_found"])

    return docs.select("doc_id", "text").mapInPandas(
        run, "doc_id long, item_id long, cosine double, lcs_ratio double, answer_found boolean"
    )


def _merged(hits: list[tuple[int, int]], around: int) -> list[tuple[int, int]]:
    """Stretches of words around hits, with ``around`` words on either side."""
    out: list[list[int]] = []
    for first, last in sorted(hits):
        first, last = max(0, first - around), last + around
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [(a, b) for a, b in out]


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, least_cosines: tuple[float, float] = LEAST_COSINES, by_words: bool = True
) -> DataFrame:
    """Find items of ``benchmark`` (item_id, text) in ``docs`` (doc_id, text), also reworded.

    Returns a row for each document and item found in it: doc_id, item_id, cosine (the best
    window's), lcs_ratio (the part of the item's words that a stretch of the document has in order),
    answer_found. A stretch counts from a ratio of ``LEAST_LCS``, or of ``LEAST_LCS_WITH_ANSWER``
    if it has the item's last words, its answer, as well.

    How: idf and a randomised SVD are computed over the passages of all documents. Every window of
    every document is compared with the windows of all items in the latent space; those close
    enough are checked by the longest common subsequence of words. Rewording and windows that lie
    apart can take a match below any useful cosine, so a stretch with enough of an item's rarer
    words is checked as well (``Stretches``); none that can count is passed over. Without ``by_words``
    the latent search is left alone, so that its own recall can be measured. The items are the query set:
    they are read in blocks of about ``ITEMS_PER_PASS``, and each block meets all documents. The
    corpus is never shuffled; tasks exchange sums of a fixed size.

    Items of fewer than ``BRIEF`` words have windows of one block; where that still holds mostly
    other words, the search by words finds them.

    Edge cases: null texts have no words and no match; an item without words matches nothing; a
    null doc_id or item_id is kept as null; repeated documents and items are matched one by one.
    An empty table on either side gives no rows. Other columns are ignored.
    """
    items = benchmark.where(F.col("text").isNotNull()).select("item_id", "text")
    count = items.count()
    passes = max(1, math.ceil(count / ITEMS_PER_PASS))
    idf, vectors = np.zeros(DIM), np.zeros((DIM + 1, RANK), np.float32)
    if count:
        idf, sketch = frequencies_and_sketch(docs)
        vectors = latent_vectors(docs, idf, sketch)
    found = None
    for number in range(passes):
        some = items.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == number).orderBy("item_id").toPandas()
        block = []
        for item_id, text in zip(some["item_id"], _encoded(some["text"]), strict=True):
            words = word_hashes([text], SIGNS)[0].tolist()
            if words:
                block.append(Item(None if pd.isna(item_id) else int(item_id), words))
        matches = _matches(docs, block, vectors, idf, least_cosines, by_words)
        found = matches if found is None else found.union(matches)
    return found
