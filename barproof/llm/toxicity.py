"""Toxicity by boosted trees over dense features, calibrated by isotonic regression."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barproof.llm.folds import fold, held_out
from barproof.session import materialize

#: Training sample: about so many labelled documents, by their hashes; never more than twice as many.
SAMPLE_DOCS = 24_000
#: ``TERMS`` is the size of the model: those of the largest odds, then the first by code point.
#: A term is learned from so many toxic documents at least, with log odds of at least this.
LEAST_DOCS, LEAST_ODDS, TERMS = 6, 3.0, 5_000
#: Words between a term and a pronoun that count as close.
NEAR = 4
TREES, DEPTH, STEP = 24, 3, 0.3

#: Insults, and pronouns of the second person.
INSULTS = frozenset(
    "idiot idiots stupid moron morons loser losers trash scum pathetic worthless disgusting clown clowns "
    "dumb fool ugly garbage vermin filth filthy imbecile jerk bastard bitch asshole shit fuck fucking crap damn "
    "dumm blöd trottel depp abschaum arschloch scheisse scheiße widerlich idiota estúpido estúpida imbécil basura "
    "asqueroso mierda idiote stupide crétin connard ordure merde débile minable".split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself you're ur u du dich dir dein deine euch euer tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros".split()
)

INSULT, WORD, PREFIX, PERSON, CAPITALS, MIXED, HIDDEN = (1 << i for i in range(7))
TERM = INSULT | WORD | PREFIX | HIDDEN
EDGES = ".,;:!?\"'()[]{}|<>«»„“”…-–—*#&$%"
PREFIXES = (4, 5, 6, 7)
#: Signs that stand for letters.
DISGUISE = str.maketrans("013457@$!+|", "oieastasiti", "*._-~^")
LOUD = re.compile(r"[!?]")
RUNS = re.compile(r"[!?.*#$%&]{2,}")
CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]")

FEATURES = [
    "insults", "words", "prefixes", "hidden", "terms", "odds", "most_odds", "log_terms", "log_insults",
    "person", "near_person", "capitals", "capital_words", "loud", "runs", "mixed", "log_words",
]


def terms_of(word: str) -> Iterator[str]:
    """A word's own term and those of its beginnings."""
    low = word.strip(EDGES).lower()
    if low:
        yield f"={low}"
        for size in PREFIXES:
            if len(low) > size:
                yield low[:size]


class WordFlags(dict):
    """The flags and odds of a word, looked up once for each word.

    The memory of words is cleared between texts only, so a text's features are a function of the
    text, whatever was read before it.
    """

    LIMIT = 500_000

    def __init__(self, odds: dict[str, float]):
        super().__init__()
        self.known = odds
        self.odds: dict[str, float] = {}

    def of(self, words: list[str]) -> tuple[np.ndarray, list[float]]:
        """The flags of a text's words, and the odds of those that are terms."""
        if len(self) >= self.LIMIT:
            self.clear()
            self.odds.clear()
        flags = np.frombuffer(bytes(map(self.__getitem__, words)), np.uint8)
        return flags, [self.odds.get(words[i], 0.0) for i in np.flatnonzero(flags & TERM)]

    def __missing__(self, word: str) -> int:
        low, flags, weight = word.strip(EDGES).lower(), 0, 0.0
        flags |= INSULT * (low in INSULTS) | PERSON * (low in SECOND_PERSON)
        for term in terms_of(word):
            if found := self.known.get(term):
                flags |= WORD if term[0] == "=" else PREFIX
                weight = max(weight, found)
        flags |= CAPITALS * (len(low) > 1 and word.isupper())
        if low and not low.isalpha() and any(c.isalpha() for c in low):
            flags |= MIXED
            plain = low.translate(DISGUISE)
            if plain != low and (plain in INSULTS or f"={plain}" in self.known):
                flags |= HIDDEN
        if weight:
            self.odds[word] = weight
        self[word] = flags
        return flags


def features_of(text: str, memory: WordFlags) -> list[float]:
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    flags, odds = memory.of(words)
    count = lambda bit: int(np.count_nonzero(flags & bit))
    hits = np.flatnonzero(flags & TERM)
    near = 0
    if len(hits):
        people = np.flatnonzero(flags & PERSON)
        if len(people):
            after = np.searchsorted(people, hits)
            right = people[np.minimum(after, len(people) - 1)] - hits
            left = hits - people[np.maximum(after - 1, 0)]
            near = int(np.count_nonzero((np.abs(right) <= NEAR) | (np.abs(left) <= NEAR)))
    insults = count(INSULT)
    size = len(text)
    return [
        insults / n, count(WORD) / n, count(PREFIX) / n, count(HIDDEN) / n, len(hits) / n, sum(odds) / n,
        max(odds, default=0.0), float(np.log1p(len(hits))), float(np.log1p(insults)), count(PERSON) / n, near / n,
        len(CAPITAL.findall(text)) / size, count(CAPITALS) / n, len(LOUD.findall(text)) / size, len(RUNS.findall(text)) / n,
        count(MIXED) / n, float(np.log1p(n)),
    ]


def _on_texts(keep: list[str], odds: dict[str, float]) -> Callable:
    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory = WordFlags(odds)
        for batch in batches:
            out = batch[keep].copy()
            out["features"] = [features_of(text, memory) for text in batch["text"].fillna("")]
            yield out

    return featured


def learned_terms(sample: DataFrame) -> dict[str, float]:
    """Terms that toxic documents have far more often: log odds by term.

    Each task counts its documents first. The result is bounded by ``TERMS``.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            with_term: dict[str, list[int]] = {}
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                for term in {t for word in set(text.split()) for t in terms_of(word)}:
                    with_term.setdefault(term, [0, 0])[toxic] += 1
            if with_term:
                rows = [(term, *n) for term, n in with_term.items()]
                yield pd.DataFrame(rows, columns=["term", "clean", "toxic"])

    totals = sample.groupBy("toxic").count().collect()
    toxic = sum(r["count"] for r in totals if r["toxic"])
    clean = sum(r["count"] for r in totals if not r["toxic"])
    counts = (
        sample.select("text", "toxic")
        .mapInPandas(counted, "term string, clean long, toxic long")
        .groupBy("term")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("toxic") >= LEAST_DOCS)
    )
    ratio = lambda part, whole: F.log((F.col(part) + 0.5) / (F.lit(whole) - F.col(part) + 0.5))
    odds = counts.select("term", (ratio("toxic", toxic) - ratio("clean", clean)).alias("odds"))
    best = odds.where(F.col("odds") >= LEAST_ODDS).orderBy(F.desc("odds"), "term").limit(TERMS).collect()
    return {row["term"]: row["odds"] for row in best}


@dataclass
class ToxicityModel:
    odds: dict[str, float]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    usual: float  # the score where the labels have one value only


def _raw(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    """Add ``raw``: the trees' probability before calibration."""
    scored = trees.transform(rows.withColumn("features", array_to_vector("features")))
    return scored.withColumn("raw", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def _grown(rows: DataFrame) -> GBTClassificationModel:
    growing = rows.withColumn("features", array_to_vector("features")).coalesce(4)
    return GBTClassifier(labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=7).fit(growing)


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> ToxicityModel:
    """Learn from labelled rows outside the held-out fold, on a sample of ``sample_docs`` of them.

    The remaining four folds have separate parts, so that nothing is judged by rows it was learned
    from: two give the terms, one the trees, one the calibration. Texts count once. Where the trees' or the
    calibration's fold lacks a value that others have, the trees learn from all four, uncalibrated.
    """
    marked = (
        labels.where(~held_out() & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    # The labelled rows with hashes under the threshold that their number gives: a filter in every
    # task. The limit is for the case that the hashes are uneven.
    part = (sample_docs << 30) // max(1, marked.count())
    few = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < part).limit(2 * sample_docs)
    sample = materialize(
        docs.where(F.col("text").isNotNull())
        .select("doc_id", "text", fold().alias("fold"))
        .join(F.broadcast(few), "doc_id")  # bounded by the sample
        .groupBy(F.sha2("text", 256).alias("same"))
        .agg(F.min_by(F.struct("text", "fold", "toxic"), "doc_id").alias("row"))
        .select("row.*")
    )
    odds = learned_terms(sample.where("fold in (1, 2)"))
    featured = lambda some: materialize(
        some.mapInPandas(_on_texts(["fold", "toxic"], odds), "fold int, toxic int, features array<double>")
    )
    rows = featured(sample.where("fold in (3, 4)"))
    found = {(r["fold"], r["toxic"]): r["count"] for r in rows.groupBy("fold", "toxic").count().collect()}
    if not all(found.get((f, t)) for f in (3, 4) for t in (0, 1)):
        values = {r["toxic"] for r in sample.select("toxic").distinct().collect()}
        if len(values) < 2:
            return ToxicityModel(odds, None, None, float(max(values, default=0)))
        return ToxicityModel(odds, _grown(featured(sample)), None, 0.0)
    trees = _grown(rows.where("fold = 3"))
    raw = materialize(_raw(trees, rows.where("fold = 4")).select("toxic", "raw"))
    calibration = IsotonicRegression(featuresCol="raw", labelCol="toxic", predictionCol="score").fit(raw)
    return ToxicityModel(odds, trees, calibration, 0.0)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``: one pass, no shuffle."""
    kept = docs.select("doc_id", held_out().alias("held_out"), "text")
    if model.trees is None:
        scored = kept.drop("text").withColumn("score", F.lit(model.usual))
    else:
        rows = kept.mapInPandas(
            _on_texts(["doc_id", "held_out"], model.odds), "doc_id long, held_out boolean, features array<double>"
        )
        raw = _raw(model.trees, rows)
        scored = model.calibration.transform(raw).drop("raw") if model.calibration else raw.withColumnRenamed("raw", "score")
    bounded = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score")))
    return scored.select(
        "doc_id", "held_out", bounded.alias("score"), (bounded >= 0.5).cast("int").alias("predicted")
    )


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn ``labels.toxic`` and score every text of ``docs`` (doc_id, text).

    Returns doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.5).

    How: a text becomes rates of insults (a fixed list, terms learned from the training folds, and
    terms behind signs that stand for letters), of terms close to the second person, of capitals,
    punctuation and mixed words. Boosted trees judge the features, isotonic regression turns their
    output into probabilities. Training sees a bounded sample (``SAMPLE_DOCS``); scoring reads
    every whole text once, on the executors.

    Edge cases: null and empty texts are scored as texts without words. If the training folds have
    labels of one value only, or none, every score is that value (0 without labels). Of
    labels that repeat a doc_id the largest counts; null labels are not learned from. labels, lang,
    source and doc_id never enter a score, and other columns are ignored.
    """
    return score(docs, train(docs, labels))
