"""Prefix polynomial hashes of bytes, and hashes of words and shingles made from them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Fixed odd multipliers; arithmetic is modulo 2**64.
BASE = 0x9E3779B97F4A7C15
OTHER_BASE = 0xD1342543DE82EF95
FIRST_MIX, SECOND_MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Bytes whose arrays are in memory at a time, besides one whole text.
CHUNK = 1 << 18

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base ** i`` and its inverse for i up to n, kept for the next call."""
    found = _POWERS.get(base)
    if found is None or len(found[0]) <= n:
        size = max(n + 1, CHUNK + (CHUNK >> 2))
        both = []
        for factor in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        found = _POWERS[base] = (both[0], both[1])
    return found


def prefix_hashes(data: np.ndarray, base: int = BASE) -> np.ndarray:
    """P, where the hash of data[a:b] is ``(P[b] - P[a]) * base ** -a``."""
    up, _ = powers(base, len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    # 1 is added to each byte, so that leading zero bytes count.
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE) -> np.ndarray:
    _, down = powers(base, len(prefix))
    return (prefix[ends] - prefix[starts]) * down[starts]


def mixed(values: np.ndarray, factor: np.uint64 = FIRST_MIX) -> np.ndarray:
    """Spread values over all 64 bits; one to one."""
    out = values ^ (values >> np.uint64(31))
    out *= factor
    out ^= out >> np.uint64(29)
    out *= SECOND_MIX
    out ^= out >> np.uint64(32)
    return out


def chunks(sizes: list[int], most: int = CHUNK) -> Iterator[slice]:
    """Runs of texts of up to ``most`` bytes; a longer text is a run of its own."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield slice(start, i)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def column_texts(column: pa.Array) -> Iterator[list[bytes]]:
    """The texts of an Arrow column in turn, by parts of bounded size; null as empty."""
    column = column.cast(pa.binary())
    for part in chunks(pc.binary_length(column).fill_null(0).to_pylist()):
        yield [text or b"" for text in column.slice(part.start, part.stop - part.start).to_pylist()]


#: For each byte whether it stands between words: white space, or all ASCII but letters and digits.
SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
SIGNS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def word_hashes(texts: list[bytes], between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z lower-cased, and where each text's begin (and the end)."""
    data = np.frombuffer(b"\n".join([b"", *texts, b""]).lower(), np.uint8)
    space = between[data]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    hashes = mixed(span_hashes(prefix_hashes(data), starts, ends))
    bounds = np.cumsum([1, *(len(text) + 1 for text in texts)])
    return hashes, np.searchsorted(starts, bounds)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes of all runs of ``size`` words; of the whole text where it has fewer."""
    n = len(words)
    if not n:
        return words
    width = min(size, n)
    total = np.full(n - width + 1, np.uint64(width), np.uint64)
    for i in range(width):
        total *= np.uint64(OTHER_BASE)
        total += words[i : n - width + 1 + i]
    return np.unique(mixed(total))


def shingle_sets(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text in turn."""
    for part in chunks([len(t) for t in texts]):
        words, bounds = word_hashes(texts[part])
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            yield shingles(words[a:b], size)
