"""Near duplicates, repeated strings, benchmark passages, against plain versions."""

import random

import numpy as np
import pytest

from barproof.llm import components, latent, rolling, signature_tree, suffix_sort
from tests.llm.brute_force import near_duplicates, subsequence, without_repeats


def edited_copies(seed, groups=12, copies=6):
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = pick.choices(vocabulary, k=30)
    rows = []
    for _ in range(groups):
        base = pick.choices(vocabulary, k=pick.randrange(5, 120))
        for _ in range(pick.randrange(1, copies)):
            text = list(base)
            for _ in range(pick.randrange(0, 4)):
                text[pick.randrange(len(text))] = pick.choice(vocabulary)
            if pick.random() < 0.3:
                text += passage
            rows.append((len(rows) * 3 + 1, pick.choice(" \n\t").join(text)))
    return rows


@pytest.mark.parametrize("size, num, den", [(3, 90, 100), (5, 8, 10)])
def test_links_are_those_of_the_plain_version(documents, size, num, den):
    rows = edited_copies(size) + [(0, None), (2, " "), (5, "one"), (8, "ONE"), (11, "one two"), (14, "x " * 30_000)]
    found = signature_tree.ngram_jaccard_join(documents(rows), size, num, den).collect()
    want = near_duplicates(rows, size, num, den)
    assert len(found) == len(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want
    assert len(set(c for _, c in want.values())) < len(rows) - 1


def test_a_large_block_is_dealt_into_chunks_with_the_same_links(documents, monkeypatch):
    monkeypatch.setattr(signature_tree, "TREE_MEMBERS", 8)
    pick = random.Random(4)
    base = pick.choices([f"w{i}" for i in range(300)], k=80)
    rows = []
    for i in range(60):
        text = list(base)
        # Chains of edits: neighbours are linked, the ends are not.
        for j in range(i // 4):
            text[j * 5 % 80] = f"n{j}"
        rows.append((i, " ".join(text)))
    found = signature_tree.ngram_jaccard_join(documents(rows), 3, 80, 100).collect()
    want = near_duplicates(rows, 3, 80, 100)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want


def test_links_between_sets_whose_bitmaps_differ_in_width(documents):
    pick = random.Random(9)
    rows = []
    for group in range(4):
        base = pick.choices([f"w{i}" for i in range(900)], k=1000)
        for extra in (0, 20, 30, 60, 90, 200):
            text = base + pick.choices([f"n{i}" for i in range(900)], k=extra)
            text[pick.randrange(900)] = "edit"
            rows.append((len(rows), " ".join(text)))
    found = signature_tree.ngram_jaccard_join(documents(rows), 3, 90, 100).collect()
    want = near_duplicates(rows, 3, 90, 100)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want
    assert 4 < len({c for _, c in want.values()}) < 12
    assert {len(signature_tree.bitmap(np.arange(n, dtype=np.uint64))) * 8 for n, _ in want.values()} == {2048, 4096}


def test_near_duplicates_take_repeated_rows_null_ids_and_no_rows(documents):
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, "A b c d")]
    found = signature_tree.ngram_jaccard_join(documents(rows), 3, 90, 100).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in found if r["doc_id"]) == [(1, 1), (1, 1), (2, 1)]
    assert signature_tree.ngram_jaccard_join(documents([]), 3, 90, 100).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 199)]
    found = components.components(spark.createDataFrame(links, "src long, dst long"))
    want = {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 160)} | {199: 199, 200: 199}
    assert {r["node"]: r["component"] for r in found.collect()} == want


def test_tree_traversal_keeps_all_leaves_with_links():
    pick = np.random.default_rng(3)
    sets = [np.unique(rolling.mixed(pick.integers(0, 4000, 60).astype(np.uint64))) for _ in range(60)]
    sets += [np.unique(np.append(s[:-2], np.uint64(i))) for i, s in enumerate(sets)]
    sets.sort(key=len)
    sizes = np.array([len(s) for s in sets])
    maps = np.stack([np.frombuffer(signature_tree.bitmap(s), np.uint64) for s in sets])
    tree = signature_tree.SignatureTree(sizes, maps)
    kept = {
        (i, j) for a, b in signature_tree.leaf_pairs(tree, tree, 9, 10)
        for i in range(a.start, a.stop) for j in range(b.start, b.stop)
    }
    for i, x in enumerate(sets):
        for j in range(i + 1, len(sets)):
            overlap = len(np.intersect1d(x, sets[j]))
            if 10 * overlap >= 9 * (len(x) + len(sets[j]) - overlap):
                assert (i, j) in kept


def repeated_texts(seed):
    pick = random.Random(seed)
    base = ["".join(pick.choices("ab cé", k=pick.randrange(20, 400))) for _ in range(5)]
    rows = []
    for doc_id in range(40):
        parts = []
        for _ in range(pick.randrange(0, 5)):
            text = pick.choice(base)
            at = pick.randrange(len(text))
            parts.append(text[at:] if pick.random() < 0.6 else text)
            if pick.random() < 0.3:
                parts.append(pick.choice(["x", "abc" * 50, "é" * 120, "q" * pick.randrange(300)]))
        rows.append((doc_id, "".join(parts) if pick.random() > 0.05 else None))
    return rows


@pytest.mark.parametrize("large_group", [50_000, 2])
def test_repeats_are_those_of_the_plain_version(documents, large_group):
    rows = repeated_texts(1) + [(90, "0123456789" * 3000)]
    found = suffix_sort.remove_repeats(documents(rows), large_group=large_group).collect()
    want = without_repeats(rows, 100)
    assert {r["doc_id"]: tuple(r)[1:5] for r in found} == want and len(found) == len(rows)
    assert sum(removed for _, removed, _, _ in want.values()) > 1000


def test_repeats_take_repeated_rows_null_ids_and_no_rows(documents):
    text = "".join(random.Random(2).choices("abcdefgh ", k=250))
    found = suffix_sort.remove_repeats(documents([(1, text), (1, text), (None, text), (2, text + "!")])).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"], r["n_spans"]) for r in found) == [(0, 0, 0), (1, 0, 0), (1, 0, 0), (2, 250, 1)]
    assert suffix_sort.remove_repeats(documents([])).count() == 0


def test_merge_sort_orders_suffixes():
    pick = np.random.default_rng(5)
    data = pick.integers(0, 2, 3000).astype(np.uint8)
    starts = np.sort(pick.integers(0, 2900, 300))
    ends = np.minimum(starts + pick.integers(1, 90, 300), 3000)
    groups = np.repeat([1, 2, 3, 4], [100, 1, 149, 50])
    order = suffix_sort.merge_sorted(suffix_sort.Suffixes(data, starts, ends), groups)
    text = [bytes(data[a:b]) for a, b in zip(starts, ends, strict=True)]
    assert order.tolist() == sorted(range(300), key=lambda i: (groups[i], text[i], i))


def test_equal_hashes_of_different_bytes_are_found_out(monkeypatch):
    data = np.frombuffer(b"aaaabbbb", np.uint8)
    suffixes = suffix_sort.Suffixes(data, np.array([0, 4]), np.array([4, 8]))
    assert suffixes.verified(np.array([0]), np.array([1]), np.array([3])).tolist() == [False]


def prose(pick, n):
    return [f"{a}{b}" for a, b in zip(pick.choices("bcdfgklmnprst", k=n), pick.choices(["a", "en", "or", "ish", "ul"], k=n), strict=True)]


def test_planted_items_are_found_and_clean_documents_left_alone(spark, documents):
    pick = random.Random(8)
    item_words = [[w + x for w, x in zip(prose(pick, n), prose(pick, n), strict=True)] for n in (18, 30, 45, 60)]
    items = [(i, " ".join(words)) for i, words in enumerate(item_words)] + [(9, None), (10, "")]
    rows, planted = [], set()
    for doc_id in range(240):
        words = [w + x for w, x in zip(prose(pick, 150), prose(pick, 150), strict=True)]
        if doc_id % 10 == 0:
            number = doc_id // 10 % 4
            at = pick.randrange(len(words))
            inside = list(item_words[number])
            if doc_id % 20 == 0 and number > 1:  # a paraphrase: every ninth word is another one
                inside[4:-8:9] = ["other"] * len(inside[4:-8:9])
            words[at:at] = inside
            planted.add((doc_id, number))
        rows.append((doc_id, " ".join(words)))
    rows += [(900, None), (901, "word"), (902, "word " * 20_000)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = latent.decontaminate(documents(rows), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == planted
    assert latent.decontaminate(documents(rows), benchmark.limit(0)).count() == 0
    assert latent.decontaminate(documents([]), benchmark).count() == 0


def test_subsequences_by_bits():
    pick = random.Random(1)
    for _ in range(300):
        a = [pick.randrange(6) for _ in range(pick.randrange(1, 90))]
        b = [pick.randrange(8) for _ in range(pick.randrange(0, 70))]
        assert latent.common_subsequence(latent.masks_of(a), b) == subsequence(a, b)
