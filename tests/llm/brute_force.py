"""Plain versions of operators for small inputs."""

import hashlib
import re

SPACE = re.compile(r"[\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def words(text):
    return [w for w in SPACE.split((text or "").translate(UPPER)) if w]


def shingle_set(text, size):
    found = words(text)
    if len(found) < size:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + size]) for i in range(len(found) - size + 1))


def near_duplicates(rows, size, num, den):
    """doc_id -> (set size, component) for (doc_id, text) rows."""
    sets = {doc_id: shingle_set(text, size) for doc_id, text in rows}
    of = {doc_id: doc_id for doc_id in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                keep, gone = sorted((of[a], of[b]))
                of = {d: keep if c == gone else c for d, c in of.items()}
    return {doc_id: (len(sets[doc_id]), of[doc_id]) for doc_id in sets}


def without_repeats(rows, length):
    """doc_id -> (bytes, removed, spans, digest of what stays) for (doc_id, text) rows."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        covered = bytearray(len(data))
        for i in range(len(data) - length + 1):
            string = data[i : i + length]
            if string in seen:
                covered[i : i + length] = b"\x01" * length
            seen.add(string)
        kept = bytes(b for b, c in zip(data, covered, strict=True) if not c)
        spans = len(re.findall(b"\x01+", bytes(covered)))
        out[doc_id] = (len(data), sum(covered), spans, hashlib.sha256(kept).hexdigest())
    return out


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        below = [0]
        for j, y in enumerate(b):
            below.append(row[j] + 1 if x == y else max(row[j + 1], below[j]))
        row = below
    return row[-1]
