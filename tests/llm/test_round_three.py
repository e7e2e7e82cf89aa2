"""Periodic runs, clustering and min-max near duplicates, against plain versions."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from barproof.llm import minmax, periodic, subvectors
from tests.llm.brute_force import SPACE, near_duplicates
from tests.llm.test_pairs import edited_copies

# --- periodic runs --------------------------------------------------------------------------------


def plain_runs(words, least):
    """Every period at every place, straight from the definition."""
    found = []
    for period in range(1, len(words) // 2 + 1):
        start = 0
        while start + period < len(words):
            end = start
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            length = end - start + period
            if end > start and length >= max(least, 2 * period):
                if not any(p < period and s <= start and s + n >= start + length for s, n, p in found):
                    found.append((start, length, period))
            start = max(end, start + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


def plain_digests(doc_id, text):
    words = [w for w in SPACE.split(text or "") if w]
    h = zlib.crc32(str(doc_id if doc_id is not None else "").encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words, 12)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    dropped = {i for start, length, period in found for i in range(start + period, start + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{start},{length},{period}\n" for start, length, period in found)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (len(found), *best, milli, *(hashlib.sha256(t.encode()).hexdigest() for t in (lines, kept)))


@pytest.mark.parametrize("least", [2, 5, 12, 13])
def test_runs_of_random_words_are_those_of_the_definition(least):
    pick = random.Random(least)
    for _ in range(600):
        words = pick.choices(range(pick.choice([1, 2, 2, 3, 5])), k=pick.randrange(70))
        if pick.random() < 0.3:
            words += words[-pick.randrange(1, 8) :] * pick.randrange(6)
        want = plain_runs(words, least)
        assert periodic.runs(words, least) == want
        # With the words that no run can hold left out beforehand.
        assert [r for r, _ in periodic._searched([" ".join(f"w{w}" for w in words).encode()], least)] == [want]


def test_screening_finds_runs_that_meet_and_overlap():
    pick = random.Random(7)
    texts = []
    for _ in range(60):
        words = []
        for _ in range(pick.randrange(1, 6)):
            unit = [f"u{pick.randrange(40)}" for _ in range(pick.randrange(1, 9))]
            words += [f"x{pick.randrange(10**6)}" for _ in range(pick.randrange(4))] + unit * pick.randrange(1, 9)
        texts.append(" ".join(words))
    found = [runs for runs, _ in periodic._searched([t.encode() for t in texts], 12)]
    assert found == [plain_runs(t.split(), 12) for t in texts] and sum(map(len, found)) > 60


def test_digests_are_those_of_the_plain_version(documents):
    pick = random.Random(3)
    rows = [(i, pick.choice(" \n\t\x0b").join(pick.choices("abcdefgh", k=pick.randrange(90)))) for i in range(150)]
    rows += [(500, None), (501, ""), (502, " \t\r\n"), (503, "one"), (504, "x " * 40), (505, "A a " * 9 + "a"), (None, "y " * 30)]
    rows += [(506, "é ü " * 14), (507, "no\x00des " * 13), rows[4], rows[4]]
    found = periodic.run_digests(periodic.with_planted_runs(documents(rows))).collect()
    assert sorted(map(tuple, found), key=str) == sorted(((i, *plain_digests(i, t)) for i, t in rows), key=str)
    assert sum(r.n_runs > 0 for r in found) > 10


def test_very_long_texts_are_searched_whole(documents):
    rows = [(1, "word " * 300_000), (2, " ".join(f"w{i % 1000}" for i in range(200_000))), (3, "x" * 3_000_000)]
    rows += [(4, " ".join(map(str, range(100_000))) + " end" * 20)]
    found = {r.doc_id: r for r in periodic.word_runs(documents(rows)).collect()}
    assert [(r.start, r.length, r.period) for i in (1, 2, 4) for r in found[i].runs] == [
        (0, 300_000, 1), (0, 200_000, 1000), (100_000, 20, 1)
    ]
    assert found[1].collapsed == "word" and len(found[2].collapsed.split()) == 1000 and found[3].runs == []


def test_no_documents_have_no_runs(documents):
    assert periodic.run_digests(periodic.with_planted_runs(documents([]))).collect() == []


# --- clustering -----------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, cluster string, v string"


def plain_clusters(rows, k, rounds, dims, scale=64):
    kept = [
        (i, [math.floor(scale * float(np.float32(x))) for x in e])
        for i, e in rows
        if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)
    ]
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def assign():
        out = []
        for i, v in kept:
            distance = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            out.append((i, v, distance.index(min(distance)), min(distance)))
        return out

    for _ in range(rounds):
        members = {}
        for _, v, c, _ in assign():
            members.setdefault(c, []).append(v)
        for c, vectors in members.items():
            centroids[c] = [sum(x) // len(vectors) for x in zip(*vectors, strict=True)]
    final = assign()
    inertia = {}
    for _, _, c, d in final:
        inertia[c] = inertia.get(c, 0) + d
    digest = lambda c: hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
    return [(i, c, d, inertia[c], sum(inertia.values()), digest(c)) for i, _, c, d in final]


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 1, "x", "y") for i, e in rows], VECTORS)


@pytest.mark.parametrize("width, chunk", [(1, 7), (2, 8192), (3, 50), (8, 16)])
def test_clusters_are_those_of_the_plain_version(spark, width, chunk):
    pick = random.Random(width)
    dims, nan = 8, float("nan")
    centers = [[pick.uniform(-1, 1) for _ in range(dims)] for _ in range(5)]
    rows = [(i, [x + pick.gauss(0, 0.2) for x in pick.choice(centers)]) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(150)]  # a third are copies of one vector
    odd = [None, [], [1.0] * 7, [1.0] * 9, [1.0] * 7 + [None], [nan] + [1.0] * 7, [float("inf")] * 8, [-0.0] * 8]
    rows += [(2000 + i, e) for i, e in enumerate(odd)] + [(None, [0.5] * 8), rows[0], rows[0], (3, rows[9][1])]
    found = subvectors.clustered(frame(spark, rows), dims=dims, k=6, width=width, chunk=chunk).collect()
    assert sorted(map(tuple, found), key=str) == sorted(plain_clusters(rows, 6, 3, dims), key=str)


def test_empty_clusters_keep_their_centroid_and_few_vectors_make_few(spark):
    rows = [(i, [float(i % 2)] * 4) for i in range(30)]
    found = subvectors.clustered(frame(spark, rows), dims=4, k=16).collect()
    assert sorted(map(tuple, found)) == sorted(plain_clusters(rows, 16, 3, 4))
    assert len({r.cluster for r in found}) == 2
    for few in (rows[:3], []):
        found = subvectors.clustered(frame(spark, few), dims=4, k=16).collect()
        assert sorted(map(tuple, found)) == sorted(plain_clusters(few, 16, 3, 4))


def test_first_centroids_are_found_whatever_share_is_looked_at(spark, monkeypatch):
    monkeypatch.setattr(subvectors, "CANDIDATES", 2)
    rows = [(i, [i / 64] * 4) for i in range(400)]
    kept = subvectors.integer_vectors(frame(spark, rows), 4, 64)
    first = sorted(range(400), key=lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest())[:16]
    assert subvectors.first_centroids(kept, 400, 16, 1) == [[i] * 4 for i in first]


def test_components_that_distances_cannot_hold_are_refused(spark):
    with pytest.raises(Exception, match="distances would not fit"):
        subvectors.clustered(frame(spark, [(1, [1e9] * 4)]), dims=4)


# --- near duplicates ------------------------------------------------------------------------------


def found_near(documents, rows, *settings):
    found = minmax.near_duplicates(documents(rows), *settings).collect()
    assert len(found) == len(rows)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in found)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in found}


def test_near_duplicates_are_those_of_the_plain_version(documents):
    rows = edited_copies(11, groups=30) + [(0, None), (2, " "), (5, "one"), (8, "ONE"), (11, "one two"), (14, "x " * 30_000)]
    assert found_near(documents, rows) == near_duplicates(rows, 5, 85, 100)


@pytest.mark.parametrize("block", [4, 2048])
def test_chains_and_stars_of_edits_are_followed_to_their_ends(documents, monkeypatch, block):
    monkeypatch.setattr(minmax, "BLOCK", block)
    pick = random.Random(5)
    rows = []
    for group in range(4):
        base = [f"g{group}w{i}" for i in range(200)]
        for i in range(25):
            text = list(base)
            # Chains: neighbours are linked, the ends are not. Stars: all are near the base, few near each other.
            for j in range(i) if group % 2 else pick.sample(range(200), pick.randrange(6)):
                text[j * 7 % 200] = f"n{j}" if group % 2 else f"n{pick.randrange(10**6)}"
            rows.append((pick.randrange(10**9), " ".join(text)))
    want = near_duplicates(rows, 5, 85, 100)
    assert found_near(documents, rows) == want
    assert len({c for _, c in want.values()}) < len(rows) / 2


def test_copies_repeated_rows_and_ids(documents):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(9, text), (9, text), (4, text.upper()), (7, text.replace(" ", "\n")), (None, text), (None, text), (30, "w1 w2")]
    assert found_near(documents, rows) == {9: (56, 4), 4: (56, 4), 7: (56, 4), None: (56, None), 30: (1, 30)}
    assert minmax.near_duplicates(documents([])).collect() == []


def test_both_ends_of_a_permutation_estimate_the_similarity():
    pick = np.random.default_rng(2)
    both = []
    for _ in range(200):
        tokens = pick.integers(0, 2**63, 400).astype(np.uint64)
        one, two = minmax.signatures([np.sort(tokens[:350]), np.sort(tokens[50:])])
        both.append((one == two).reshape(2, -1).mean(axis=1))
    low, high = np.mean(both, axis=0)
    assert abs(low - 0.75) < 0.02 and abs(high - 0.75) < 0.02
    # Taken together they spread less than either.
    assert np.var(np.mean(both, axis=1)) < 0.7 * np.var([b[0] for b in both])
