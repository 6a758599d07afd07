"""Toxicity by multiple-instance learning.

Only documents are labelled, sentences are what is toxic. A sentence's probability is
a logistic function of its words and their beginnings; a document is toxic if any of its
sentences is, so its probability is the noisy-or of theirs. The likelihood of document
labels is maximised over the weights of hashed features, and the weights then also tell
which sentences made a document toxic.

A sentence adds to its document what its probability exceeds that of a plain one, whose
features weigh nothing. What is toxic without a telling word is one background term per
document. So plain sentences add nothing, and no text is rejected for its length alone.

The model is fitted on a bounded sample of labelled documents, ``MOST_POSITIVE`` and
``MOST_NEGATIVE`` at most, in the order of a hash of their id and weighted back to the
shares of all labelled documents. Scoring covers every whole text: a word's weight is the
sum of its features' weights, so a sentence is a sum over its words.

Only features that toxic documents have clearly more often than chance take part; the
rest would only name the documents of the sample.

Null and empty texts, and texts without a word, get the score of a document without
sentences, 0. Conflicting labels of an id count as toxic; null ids and null labels are
not learned from. Rows that repeat an id are scored each by its own text. Without labels
of both kinds every score is the share of toxic ones (0 without labels).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureframe.llm.common import ids_and_texts
from featureframe.session import settle, ship_package

MOST_POSITIVE = 4_000
MOST_NEGATIVE = 8_000
FEATURE_BITS = 19
ROUNDS = 150
RATE = 0.1
PENALTY = 3e-5
LEAST_DEVIATIONS = 4.5

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")
_REMEMBERED = 300_000
_LABELLED = ("text", "toxic", "weight")


@dataclass
class Model:
    weights: np.ndarray
    #: Of a sentence.
    bias: float
    #: Of a document with words, whatever their number.
    background: float = 0.0
    #: For every text where there is nothing to learn from.
    constant: float | None = None


def _features(word: str) -> list[int]:
    named = (f"w{word}", f"3{word[:3]}", f"4{word[:4]}", f"5{word[:5]}")
    return [xxhash.xxh32_intdigest(one) & ((1 << FEATURE_BITS) - 1) for one in named]


class _Remembering(dict):
    """Values of words, computed when first asked for."""

    def __init__(self, compute):
        super().__init__()
        self._compute = compute

    def __missing__(self, word: str):
        if len(self) >= _REMEMBERED:
            self.clear()
        self[word] = value = self._compute(word)
        return value


def _sentences(text: str) -> list[list[str]]:
    """The words of each sentence that has any."""
    found = (_WORD.findall(one.lower()) for one in _SENTENCE.findall(text))
    return [one for one in found if one]


def _telling(rows: DataFrame, share: float) -> np.ndarray:
    """Features toxic documents have more often than chance explains; others would only name documents.

    Each task adds up its documents, so at most one row per feature and task is shuffled.
    """

    def run(batches):
        sums = np.zeros((3, 1 << FEATURE_BITS))
        known = _Remembering(_features)
        for batch in batches:
            for text, toxic, weight in zip(*(batch.column(name).to_pylist() for name in _LABELLED), strict=True):
                own = {feature for words in _sentences(text) for word in words for feature in known[word]}
                # documents of a sampled class stand for several, but are no more evidence than one
                sums[:, np.fromiter(own, np.int64, len(own))] += [[weight], [weight * toxic], [weight**2]]
        found = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int64()), *(pa.array(one[found]) for one in sums)], ["feature", "n", "toxic", "squares"]
        )

    counts = rows.mapInArrow(run, "feature long, n double, toxic double, squares double")
    totals = counts.groupBy("feature").agg(*(F.sum(name).alias(name) for name in ("n", "toxic", "squares")))
    excess = F.col("toxic") - share * F.col("n")
    spread = F.sqrt(F.col("squares") * (share * (1 - share)))
    # at most one row for each of the fixed number of features
    kept = totals.filter(excess > LEAST_DEVIATIONS * spread).select("feature").toArrow()
    return np.sort(kept.column(0).to_numpy())


def _labelled_features(rows: DataFrame, telling: np.ndarray) -> DataFrame:
    """``features`` of the sentences that have any of ``telling``, their ``sizes``, and the number of the others."""

    def run(batches):
        wanted = np.zeros(1 << FEATURE_BITS, bool)
        wanted[telling] = True
        known = _Remembering(lambda word: [feature for feature in _features(word) if wanted[feature]])
        for batch in batches:
            features, sizes, plain = [], [], []
            for text in batch.column("text"):
                found = [[f for word in words for f in known[word]] for words in _sentences(text.as_py())]
                telling_ones = [one for one in found if one]
                features.append(np.array([f for one in telling_ones for f in one], np.uint32).tobytes())
                sizes.append(np.array([len(one) for one in telling_ones], np.uint32).tobytes())
                plain.append(len(found) - len(telling_ones))
            columns = [batch.column("toxic"), batch.column("weight")]
            columns += [pa.array(features, pa.binary()), pa.array(sizes, pa.binary()), pa.array(plain, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["toxic", "weight", "features", "sizes", "plain"])

    return rows.mapInArrow(run, "toxic int, weight double, features binary, sizes binary, plain long")


def _sample(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & learn)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    totals = {row["toxic"]: row["n"] for row in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    parts = []
    for toxic, most in ((1, MOST_POSITIVE), (0, MOST_NEGATIVE)):
        total = totals.get(toxic, 0)
        weight = total / min(total, most) if total else 0.0
        part = known.filter(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        parts.append(part.withColumn("weight", F.lit(weight)))
    chosen = parts[0].union(parts[1])
    return ids_and_texts(docs).join(chosen, "doc_id").select(*_LABELLED)


def train(docs: DataFrame, labels: DataFrame, learn: Column) -> Model:
    """Fit on the labelled documents for whose ``doc_id`` the condition ``learn`` holds."""
    ship_package(docs.sparkSession)
    rows = settle(_sample(docs, labels, learn))
    totals = rows.agg(F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("toxic")).alias("toxic")).first()
    share = totals["toxic"] / totals["n"] if totals["n"] else 0.0
    if not 0 < share < 1:
        return Model(np.zeros(1 << FEATURE_BITS, np.float32), 0.0, constant=share)
    found = _labelled_features(rows, _telling(rows, share)).toArrow()
    features, sizes = (
        [np.frombuffer(one.as_py(), np.uint32).astype(np.int64) for one in found.column(name)]
        for name in ("features", "sizes")
    )
    toxic, weight, plain = (found.column(name).to_numpy() for name in ("toxic", "weight", "plain"))
    return _fit(features, sizes, plain, toxic, weight / weight.sum(), share)


def _fit(
    features: list[np.ndarray],
    sizes: list[np.ndarray],
    plain: np.ndarray,
    toxic: np.ndarray,
    weight: np.ndarray,
    share: float,
) -> Model:
    """Maximise the weighted log-likelihood of noisy-or labels by full-batch Adam steps.

    ``plain`` counts a document's sentences that have none of the features.
    """
    sentences = np.array([len(one) for one in sizes])
    document = np.repeat(np.arange(len(sentences)), sentences)
    flat_sizes, flat = np.concatenate(sizes), np.concatenate(features)
    sentence = np.repeat(np.arange(len(flat_sizes)), flat_sizes)
    weights = np.zeros(1 << FEATURE_BITS)
    bias = float(np.log(share / (1 - share)) - np.log(max(1.0, (sentences + plain).mean())))
    background = float(np.log(share / (1 - share)))
    worded = sentences + plain > 0
    mean, square = np.zeros(len(weights) + 2), np.zeros(len(weights) + 2)
    for step in range(1, ROUNDS + 1):
        logit = np.bincount(sentence, weights=weights[flat], minlength=len(flat_sizes)) + bias
        # log(1 - p) of sentences beyond that of a plain one, and of documents as their sum
        clean = np.bincount(document, weights=_beyond_plain(logit, bias), minlength=len(plain))
        clean = np.minimum(clean - worded * np.logaddexp(0, background), -1e-12)
        odds = np.where(toxic == 1, np.exp(clean) / -np.expm1(clean), -1.0) * weight
        odds_of = odds[document] * (logit >= bias)
        slope = odds_of * _logistic(logit)
        gradient = np.bincount(flat, weights=slope[sentence], minlength=len(weights)) - PENALTY * weights
        own = slope.sum() - odds_of.sum() * _logistic(bias), (odds * worded).sum() * _logistic(background)
        gradient = np.append(gradient, own)
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        move = RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
        weights += move[:-2]
        bias += move[-2]
        background += move[-1]
    return Model(weights.astype(np.float32), float(bias), float(background))


def _beyond_plain(logit, bias: float):
    """log(1 - p) of sentences less that of a plain one; none makes its document less toxic."""
    return np.minimum(np.logaddexp(0, bias) - np.logaddexp(0, logit), 0)


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


class _Scorer:
    """Scores texts one by one."""

    def __init__(self, model: Model):
        self._model = model
        weights = model.weights
        self._weight = _Remembering(lambda word: float(weights[_features(word)].sum())).__getitem__

    def __call__(self, text: str) -> tuple[float, np.ndarray, list[tuple[int, int]]]:
        """The document's score, and score and place of each sentence that has words."""
        logits, places = [], []
        for sentence in _SENTENCE.finditer(text):
            # places are those of the text: lower case may be longer
            found = _WORD.findall(sentence[0].lower())
            if found:
                logits.append(self._model.bias + sum(map(self._weight, found)))
                places.append(sentence.span())
        logits, model = np.array(logits, np.float64), self._model
        if model.constant is not None:
            return model.constant, _logistic(logits), places
        if not places:
            return 0.0, logits, places
        clean = _beyond_plain(logits, model.bias).sum() - np.logaddexp(0, model.background)
        return float(-np.expm1(clean)), _logistic(logits), places


def score(docs: DataFrame, model: Model, worst: float = 0.5) -> DataFrame:
    """``doc_id, score, sentences``: the spans of sentences whose own probability reaches ``worst``."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        scorer = _Scorer(shared.value)
        for batch in batches:
            scores, spans = [], []
            for text in batch.column("text"):
                whole, own, places = scorer(text.as_py())
                scores.append(whole)
                spans.append(
                    [{"start": places[at][0], "end": places[at][1], "score": float(own[at])} for at in np.flatnonzero(own >= worst)]
                )
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(spans, kind)],
                ["doc_id", "score", "sentences"],
            )

    return ids_and_texts(docs).mapInArrow(
        run, "doc_id long, score double, sentences array<struct<start:int,end:int,score:double>>"
    )


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, with all their columns."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = _Scorer(shared.value)
        for texts in parts:
            yield pd.Series([scorer(text)[0] for text in texts], dtype="float64")

    return docs.filter(scored(F.coalesce(F.col("text").cast("string"), F.lit(""))) < threshold)
