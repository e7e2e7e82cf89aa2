"""Nothing that a rule accepts is lost on the way to it, on cases that are hard to come across."""

import random
import zlib

import pytest

from barproof.llm import latent, signature_tree, toxicity
from tests.llm.brute_force import near_duplicates


def invented(pick, n):
    return ["".join(pick.choices("bdfgklmnprstaeiou", k=7)) for _ in range(n)]


def inside_long_documents(pick, copies, filler):
    """Documents of 300 words of ``filler`` with a copy each at any place, and as many without."""
    rows = []
    for number, copy in enumerate(copies):
        for doc_id, words in ((2 * number, copy), (2 * number + 1, [])):
            text = pick.choices(filler, k=300)
            at = pick.randrange(300)
            rows.append((doc_id, " ".join(text[:at] + words + text[at:])))
    return rows


@pytest.mark.parametrize("kept", [0.6, 0.7, 0.8, 0.9])
def test_reworded_items_of_all_lengths_are_found(spark, documents, kept):
    pick = random.Random(int(kept * 10))
    filler, items, copies = invented(pick, 4000), [], []
    for number, n in enumerate([*range(16, 61, 4)] * 4):
        words = pick.choices(filler, k=n)
        items.append((number, " ".join(words)))
        reworded = list(words)
        # The answer, the last 6 words, is left as it is.
        for place in pick.sample(range(n - 6), min(n - 6, int(n - kept * n))):
            reworded[place] = pick.choice(filler)
        masks = latent.masks_of(words)
        assert latent.common_subsequence(masks, reworded) >= kept * n
        copies.append(reworded)
    rows = inside_long_documents(pick, copies, filler)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in latent.decontaminate(documents(rows), benchmark).collect()}
    want = {(2 * number, number) for number in range(len(items))}
    assert found == want
    # The latent search by itself, without the look at rarer words: its recall.
    alone = latent.decontaminate(documents(rows), benchmark, by_words=False).collect()
    assert len({(r["doc_id"], r["item_id"]) for r in alone} & want) >= 0.9 * len(want)


def test_short_items_are_found_in_long_documents(spark, documents):
    pick = random.Random(6)
    filler = invented(pick, 4000)
    copies = [pick.choices(filler, k=n) for n in [*range(3, 16)] * 3]
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(copies)], "item_id long, text string")
    rows = inside_long_documents(pick, copies, filler)
    found = {(r["doc_id"], r["item_id"]): r["lcs_ratio"] for r in latent.decontaminate(documents(rows), benchmark).collect()}
    assert {(2 * number, number): 1.0 for number in range(len(copies))}.items() <= found.items()


def test_each_stretch_of_a_document_is_judged_on_its_own():
    item = latent.Item(1, list(range(1, 21)))
    other = list(range(100, 200))
    larger = [*range(1, 15), *other[:6]]  # 14 of 20 words, without the answer
    smaller = [*range(1, 8), *other[:7], *range(15, 21)]  # 13 of 20, with it
    assert item.judged(larger) is None
    assert item.judged(smaller) == (0.65, True)
    for near in (larger + other[:40] + smaller, smaller + other[:40] + larger):
        assert item.judged(near) == (0.65, True)
    # A copy with words between its own, that only one place of the stretch holds.
    wide = [*range(1, 8), *other[:12], *range(16, 21), 300]
    assert all(item.judged(other[:lead] + wide + other[50:90]) == (0.6, True) for lead in range(12))


@pytest.mark.parametrize("missing", [3, 4])
def test_toxic_labels_missing_in_one_fold_still_teach(spark, documents, missing):
    pick = random.Random(missing)
    filler, rows, labels = invented(pick, 300), [], []
    for doc_id in range(400):
        fold = zlib.crc32(str(doc_id).encode()) % 5
        toxic = doc_id % 4 == 0 and fold != missing
        insult = ["you", "stupid", "idiot"] if toxic else []
        rows.append((doc_id, " ".join(pick.choices(filler, k=20) + insult)))
        labels.append((doc_id, int(toxic)))
    found = toxicity.toxicity(documents(rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert {r["doc_id"]: r["predicted"] for r in found} == dict(labels)


def test_links_between_sets_of_which_one_is_four_times_as_large(documents):
    pick = random.Random(12)
    words = invented(pick, 3600)
    rows = [(1, " ".join(words[:1000])), (2, " ".join(words)), (3, " ".join(invented(pick, 2000)))]
    found = signature_tree.ngram_jaccard_join(documents(rows), 3, 1, 4).collect()
    want = near_duplicates(rows, 3, 1, 4)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want
    assert want[2][1] == 1
