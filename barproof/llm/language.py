"""Language identification with bit-sliced Bloom filters of n-grams."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barproof.llm.folds import held_out

UNKNOWN = "und"
#: The training sample: documents of each language on average, those with the smallest hashes of all.
SAMPLE_DOCS = 1500
#: An n-gram belongs to a language if so large a part of its sampled documents has it.
LEAST_SHARE = 0.03
#: N-grams that one language's filter holds at most, the most common ones.
NGRAMS = 20_000
#: Positions of the filters, and hash functions.
SLOTS = 1 << 18
HASHES = 3
#: Characters whose arrays are in memory at a time, besides one whole text.
CHUNK = 1 << 17

LETTER = re.compile(r"[^\W\d_]")
_TABLE: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or 0 for what is no letter."""
    if not _TABLE:
        table = np.zeros(0x110000, np.uint32)
        for point in range(0x110000):
            if LETTER.match(chr(point)):
                table[point] = ord(chr(point).lower()[0])
        _TABLE.append(table)
    return _TABLE[0]


def ngram_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of all texts, and where each text's begin (with the end in addition).

    An n-gram is a letter with its left and right neighbours, where all but letters are one sign.
    """
    points = np.frombuffer("\n".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    signs = _letters()[points].astype(np.uint64)
    at = np.flatnonzero(signs[1:-1]) + 1
    mixed = signs[at - 1] * np.uint64(0x9E3779B97F4A7C15)
    mixed += signs[at] * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed += signs[at + 1] * np.uint64(0x165667B19E3779F9)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    ends = np.cumsum([0, *(len(text) + 1 for text in texts)])
    return mixed, np.searchsorted(at, ends + 1)


def slots_of(hashes: np.ndarray, slots: int, functions: int) -> Iterator[np.ndarray]:
    first, second = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    for i in range(functions):
        yield ((first + np.uint64(i) * second) % np.uint64(slots)).astype(np.int64)


def chunks(texts: list[str]) -> Iterator[slice]:
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > CHUNK:
            yield slice(start, i)
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


@dataclass
class LanguageModel:
    """One Bloom filter for each language, bit-sliced: a slot has a bit for each language."""

    languages: list[str]
    words: list[np.ndarray]  # 64 languages each
    false_positive: np.ndarray
    usual: int  # the language of most training documents

    @classmethod
    def of(cls, ngrams: dict[str, np.ndarray], usual: str, slots: int = SLOTS, functions: int = HASHES) -> LanguageModel:
        languages = sorted(ngrams)
        words = [np.zeros(slots, np.uint64) for _ in range((len(languages) + 63) // 64)]
        rates = []
        for i, language in enumerate(languages):
            bit = np.uint64(1) << np.uint64(i % 64)
            for at in slots_of(ngrams[language], slots, functions):
                words[i // 64][at] |= bit
            rates.append(float(np.count_nonzero(words[i // 64] & bit) / slots) ** functions)
        return cls(languages, words, np.array(rates), languages.index(usual))

    def predict(self, texts: list[str], functions: int = HASHES) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and coverage of each text."""
        names, scores, covers = [], [], []
        for part in chunks(texts):
            hashes, bounds = ngram_hashes(texts[part])
            counts = np.diff(bounds)
            hits = np.empty((len(counts), len(self.languages)))
            at = list(slots_of(hashes, len(self.words[0]), functions))
            for w, word in enumerate(self.words):
                has = word[at[0]]
                for other in at[1:]:
                    has &= word[other]
                for i in range(w * 64, min(len(self.languages), w * 64 + 64)):
                    bits = (has >> np.uint64(i % 64)) & np.uint64(1)
                    sums = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])
                    hits[:, i] = sums[bounds[1:]] - sums[bounds[:-1]]
            # Of the n-grams a language lacks, its filter still returns its rate of false positives.
            n = counts[:, None]
            true = np.maximum(0, (hits - n * self.false_positive) / (1 - self.false_positive))
            best = true.argmax(axis=1)
            most, total = true.max(axis=1), true.sum(axis=1)
            best[most == 0] = self.usual
            lettered = counts > 0
            names += [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
            scores.append(np.where(lettered & (total > 0), most / np.maximum(total, 1e-9), 0.0))
            covers.append(np.where(lettered, most / np.maximum(counts, 1), 0.0))
        return names, np.concatenate([np.zeros(0), *scores]), np.concatenate([np.zeros(0), *covers])


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> LanguageModel | None:
    """Learn from text and lang of the training fold; None where it has no labelled text.

    Each language's sample has about ``sample_docs`` documents, whose hashes lie under the threshold
    that its number of documents gives; their whole texts are counted on the executors. What the
    driver gets is one count for each language, and the model: up to ``NGRAMS`` hashes of each.
    """
    labelled = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = labelled.groupBy("lang").count().collect()
    if not sizes:
        return None
    position = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    limits = [part for row in sizes for part in (F.lit(row["lang"]), F.lit((sample_docs << 30) // row["count"]))]
    sample = labelled.select("doc_id", "lang", "text").where(position < F.create_map(*limits)[F.col("lang")])

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, group in batch.groupby("lang"):
                texts = group["text"].tolist()
                seen = []
                for part in chunks(texts):
                    hashes, bounds = ngram_hashes(texts[part])
                    seen += [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                grams, docs_with = np.unique(np.concatenate(seen), return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": grams.view(np.int64), "docs": docs_with, "texts": 0})
                yield pd.DataFrame({"lang": [lang], "gram": [0], "docs": [0], "texts": [len(texts)]})

    counts = sample.mapInPandas(counted, "lang string, gram long, docs long, texts long")
    per_gram = counts.groupBy("lang", "gram").agg(F.sum("docs").alias("docs"), F.sum("texts").alias("texts"))
    listed = (
        per_gram.where(F.col("docs") > 0)
        .join(counts.groupBy("lang").agg(F.sum("texts").alias("of")), "lang")
        .where(F.col("docs") >= F.col("of") * LEAST_SHARE)
        .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("docs"), "gram")))
        .where(F.col("place") <= NGRAMS)
        .groupBy("lang")
        .agg(F.collect_list("gram").alias("grams"), F.max("of").alias("of"))
        .collect()
    )
    if not listed:
        return None
    usual = min(listed, key=lambda row: (-row["of"], row["lang"]))["lang"]
    return LanguageModel.of({r["lang"]: np.array(r["grams"], np.int64).view(np.uint64) for r in listed}, usual)


def answer(model: LanguageModel | None) -> Callable[[str], Column]:
    """A function of a text column: struct of lang_pred, score, coverage."""

    @F.pandas_udf("lang_pred string, score double, coverage double")
    def answered(texts: pd.Series) -> pd.DataFrame:
        whole = texts.fillna("").tolist()
        if model is None:
            names, score, coverage = [UNKNOWN] * len(whole), 0.0, 0.0
        else:
            names, score, coverage = model.predict(whole)
        return pd.DataFrame({"lang_pred": names, "score": score, "coverage": coverage})

    return answered


def known_language(docs: DataFrame, model: LanguageModel | None, least_coverage: float) -> DataFrame:
    """The rows of ``docs`` whose text is in a language of the model, with all their columns.

    Texts without a letter go, and texts of which the best language has less than
    ``least_coverage`` of the n-grams.
    """
    found = answer(model)("text")
    return docs.where((found["lang_pred"] != UNKNOWN) & (found["coverage"] >= least_coverage))


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, coverage of every row. See ``language_id``."""

    return docs.select("doc_id", held_out().alias("held_out"), answer(model)("text").alias("answer")).select(
        "doc_id", "held_out", "answer.*"
    )


def language_id(docs: DataFrame) -> DataFrame:
    """Learn languages from ``docs`` (doc_id, text, lang) and predict each text's.

    Returns doc_id, held_out, lang_pred, score (the best language's part of all languages' n-grams
    found, 0 to 1) and coverage (the part of the text's n-grams that the best language has).

    How: each language has a Bloom filter of its common n-grams. The filters are bit-sliced, so a
    lookup of a few slots returns all languages that contain an n-gram. Bits are counted for each
    language, the expected number of false positives is taken off, and the largest count decides.
    The model has a fixed size and travels with the tasks; prediction is one pass without a shuffle.

    Edge cases: ``und`` with score 0 for null texts and texts without a letter, and for all texts
    if nothing could be learned; the usual language with score 0 where no n-gram is known; equal
    counts go to the first language by code point. Repeated rows are learned as often as they are
    and judged one by one; lang, source and doc_id never enter a prediction. Other columns are
    ignored.
    """
    return identify(docs, train(docs))
