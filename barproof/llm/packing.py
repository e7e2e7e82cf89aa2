"""Token ids packed into rows of fixed length by best-fit decreasing."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The vocabulary's split pattern, and the free id that ends a document.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 50256
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
ROW_TOKENS = 2048
#: Tokens that a task holds before it packs what it has.
HELD_TOKENS = 8 << 20
#: White space as the pattern has it, and so long a run of it that the pattern's own matching gives up.
WHITE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_SPACE = re.compile(f"[{WHITE_SPACE}]{{50000,}}")
#: Little-endian ids of a row; the vocabulary has fewer than 65,536.
ID_TYPE = "<u2"

SCHEMA = (
    "shard int, row int, n_tokens int, doc_ids array<long>, token_offsets array<int>, "
    "cu_seqlens array<int>, position_resets array<int>, ids binary"
)


class CapacityTree:
    """A segment tree over remaining capacities; finds the smallest one that is large enough."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, capacity: int, number: int) -> None:
        self.bins[capacity].append(number)
        self._change(capacity, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return (capacity, bin) of the tightest bin with at least ``least`` left."""
        node, count = least + self.size, self.count
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node == 1:
                return None
            node += 1
            while node < self.size:
                node *= 2
                if not count[node]:
                    node += 1
        capacity = node - self.size
        self._change(capacity, -1)
        return capacity, self.bins[capacity].pop()

    def _change(self, capacity: int, by: int) -> None:
        node = capacity + self.size
        while node:
            self.count[node] += by
            node >>= 1


def best_fit_decreasing(lengths: list[int], row: int) -> list[list[int]]:
    """Rows as lists of item numbers: the longest item first, each into the tightest row it fits."""
    rows: list[list[int]] = []
    tree = CapacityTree(row)
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        length = lengths[item]
        if found := tree.take(length):
            left, number = found
            rows[number].append(item)
        else:
            left, number = row, len(rows)
            rows.append([item])
        if left > length:
            tree.add(left - length, number)
    return rows


def encoding_of(vocabulary: bytes) -> tiktoken.Encoding:
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(encoding: tiktoken.Encoding, text: str) -> list[int]:
    """The ids of a text of any kind.

    Of a long run of white space the pattern makes one piece: all of it at the end of a text, else
    all but its last character, which goes with what follows. Such a piece is encoded directly.
    """
    ids, at = [], 0
    for run in LONG_SPACE.finditer(text):
        ids += encoding.encode_ordinary(text[at : run.start()])
        at = run.end() if run.end() == len(text) else run.end() - 1
        ids += encoding._encode_single_piece(text[run.start() : at].encode())
    return ids + encoding.encode_ordinary(text[at:])


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, row_tokens: int = ROW_TOKENS) -> DataFrame:
    """Tokenise ``docs`` (doc_id, text) and pack the ids into rows of ``row_tokens``.

    Each document is its ids and an end id. Returns one line for each packed row: shard and row
    (its place), n_tokens, doc_ids of its segments in turn, token_offsets (where in its document
    a segment begins), cu_seqlens (cumulative segment lengths, from 0), position_resets (where the
    position starts again at 0), and ids (``row_tokens`` little-endian 16-bit ids, filled up with
    the end id).

    How: a document longer than a row is cut into whole rows and a rest; nothing is lost, and
    doc_ids with token_offsets put it together again. Rests and short documents are packed by
    best-fit decreasing, where a segment tree over the capacities left finds the tightest row. A
    task packs its own documents as it reads them, at most ``HELD_TOKENS`` at a time: no shuffle,
    bounded memory, and a lost task repeats just its own rows. ``vocabulary`` is read where the
    driver is; its bytes (about 1 MB) go to the tasks.

    Edge cases: a null or empty text is one end id; texts of special-token names are ordinary
    text; a null doc_id stays null; repeated rows are packed as often as they are; an empty table
    gives no rows. Other columns are ignored.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = encoding_of(ranks.value)
        shard, at, held = TaskContext.get().partitionId(), 0, 0
        items: list[tuple[int | None, int, np.ndarray]] = []
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                ids = np.array([*ids_of(encoding, text or ""), END], ID_TYPE)
                items += [(doc_id, i, ids[i : i + row_tokens]) for i in range(0, len(ids), row_tokens)]
                held += len(ids)
                if held >= HELD_TOKENS:
                    for frame in lines(shard, at, items):
                        at += len(frame)
                        yield frame
                    held, items = 0, []
        yield from lines(shard, at, items)

    def lines(shard: int, first: int, items: list) -> Iterator[pd.DataFrame]:
        rows = best_fit_decreasing([len(ids) for _, _, ids in items], row_tokens)
        for start in range(0, len(rows), 1024):
            out = []
            for number, members in enumerate(rows[start : start + 1024], start):
                ends = np.cumsum([len(items[i][2]) for i in members]).tolist()
                full = np.full(row_tokens, END, ID_TYPE)
                full[: ends[-1]] = np.concatenate([items[i][2] for i in members])
                begins = [0, *ends[:-1]]
                out.append(
                    (
                        shard, first + number, ends[-1], [items[i][0] for i in members],
                        [items[i][1] for i in members], [0, *ends], begins, full.tobytes(),
                    )
                )
            yield pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return docs.select("doc_id", F.col("text").alias("text")).mapInPandas(packed, SCHEMA)


def write_packed(docs: DataFrame, path: str, **options) -> None:
    """Write packed rows as Parquet: each file is a matrix of ids with its segments beside it."""
    pack(docs, **options).write.parquet(path)


def segments(rows: DataFrame) -> DataFrame:
    """Packed rows back to doc_id, token_offset, ids: the segments that were packed."""

    def unpacked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for line in batch.itertuples(index=False):
                ids = np.frombuffer(line.ids, ID_TYPE).astype(np.int32)
                bounds = zip(line.cu_seqlens[:-1], line.cu_seqlens[1:], strict=True)
                for doc_id, offset, (a, b) in zip(line.doc_ids, line.token_offsets, bounds, strict=True):
                    out.append((None if pd.isna(doc_id) else int(doc_id), offset, ids[a:b]))
            frame = pd.DataFrame(out, columns=["doc_id", "token_offset", "ids"])
            yield frame.astype({"doc_id": "Int64"})

    return rows.select("doc_ids", "token_offsets", "cu_seqlens", "ids").mapInPandas(
        unpacked, "doc_id long, token_offset int, ids array<int>"
    )
