"""Toxicity by multiple-instance learning.

Labels are known for documents, not for sentences. A sentence with the features x
is toxic with p = sigmoid(b + w.x); a document is toxic unless each of its sentences
is not (noisy-or), with a small leak for what sentences do not show:

    P(document) = 1 - (1 - leak) * product(1 - p)

w, b and leak follow from document labels by gradient descent; the sentence scores
then locate the offending sentences. Features of a sentence are its different words
and their first four and five letters. Spark counts in how many toxic and other
training documents each feature occurs and keeps the most telling ones; a sentence
without any of them has no say, so a long document is not suspect for its length.

The model is fitted on at most about ``rows`` labelled rows, chosen by a hash of
their id. Everything else covers all rows. Training data that reach the driver are
feature numbers of those sentences that have any.

Defined cases: null or empty text has the leak as score; a label that is null does
not train; repeated rows train and score like others; if no feature tells toxic rows
from others, every score is the leak, the share of toxic training rows: 0 without any,
1 if all are.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import in_small_batches, kept
from orderflow.session import stage

#: Labelled rows that train, about; the bound of the training sample.
TRAIN_ROWS = 10_000
#: Features that are kept, at most.
FEATURES = 2_000
#: Toxic training documents a feature needs.
MIN_TOXIC = 4
#: How much higher the odds of being toxic are with a feature, as a factor, and its gain in
#: standard deviations, at least. Both work for any share of toxic documents.
ODDS, DEVIATIONS = 3.0, 2.0
KNOWN_WORDS = 100_000
WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[^.!?\n]+")


@dataclass(frozen=True)
class Model:
    features: tuple[str, ...]
    weights: tuple[float, ...]
    bias: float
    leak: float


def features_of(word: str) -> set[str]:
    return {word, word[:4] + "*", word[:5] + "*"} if len(word) > 3 else {word}


class _Known(dict):
    """The kept features of a word, as numbers."""

    def __init__(self, names: tuple[str, ...]):
        super().__init__()
        self.number = {name: i for i, name in enumerate(names)}

    def __missing__(self, word: str) -> frozenset[int]:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        found = self[word] = frozenset(
            self.number[f] for f in features_of(word) if f in self.number)
        return found


def _known(names: tuple[str, ...]) -> _Known:
    return kept(("toxicity", names), lambda: _Known(names))


def sentences_of(text: str | None, known: _Known) -> Iterator[tuple[int, int, list[int]]]:
    """Start, stop and features of the sentences that have any."""
    if not text or not any(map(known.__getitem__, WORD.findall(text.lower()))):
        return
    for found in SENTENCE.finditer(text):
        own = set().union(*map(known.__getitem__, WORD.findall(found.group().lower())))
        if own:
            yield found.start(), found.end(), sorted(own)


def _sample(labelled: DataFrame, rows: int) -> DataFrame:
    total = labelled.count()
    if total <= rows:
        return labelled
    steps = 1 << 20
    return labelled.where(
        F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(steps)) < int(steps * rows / total))


def _share(sample: DataFrame) -> float:
    return sample.agg(F.avg("toxic")).first()[0] or 0.0


def telling_features(sample: DataFrame, most: int = FEATURES) -> list[tuple[str, float]]:
    """Features with which documents are toxic at far higher odds, with log-odds.

    Ranked by the toxic documents they are found in beyond what the share of toxic
    documents explains, in standard deviations. Log-odds are relative to that share.
    """
    per_doc = sample.select("toxic", F.explode(F.array_distinct(F.expr(
        "flatten(transform(array_distinct(regexp_extract_all(lower(text), '\\\\p{L}+', 0)), w -> "
        "CASE WHEN length(w) > 3 THEN array(w, concat(left(w, 4), '*'), concat(left(w, 5), '*')) "
        "ELSE array(w) END))"))).alias("feature"))
    base = _share(sample)
    counts = per_doc.groupBy("feature").agg(
        F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("all"))
    gain = (F.col("bad") - base * F.col("all")) / F.sqrt(base * (1 - base) * F.col("all"))
    rows = (
        counts.where((F.col("bad") >= MIN_TOXIC)
                     & (F.col("bad") * (1 - base) > ODDS * base * (F.col("all") - F.col("bad"))))
        .select("feature", "bad", "all", gain.alias("gain")).where(F.col("gain") >= DEVIATIONS)
        .orderBy(F.desc("gain"), "feature").limit(most).collect()
    )
    return [
        (r["feature"], math.log((r["bad"] + 0.5) / (r["all"] - r["bad"] + 0.5) * (1 - base) / base))
        for r in rows
    ]


def _bags(sample: DataFrame, names: tuple[str, ...]) -> list[tuple[int, list[list[int]]]]:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            own = [[f for *_, f in sentences_of(t, _known(names))] for t in frame["text"]]
            yield pd.DataFrame({"toxic": frame["toxic"], "bag": own})

    found = in_small_batches(sample).select("toxic", "text").mapInPandas(run, "toxic int, bag array<array<int>>")
    return [(r["toxic"], r["bag"]) for r in found.collect()]


def fit(labelled: DataFrame, rows: int = TRAIN_ROWS, rounds: int = 400, rate: float = 0.1,
        decay: float = 3e-6) -> Model:
    """Learn from ``labelled`` (doc_id, text, toxic), by Adam over the whole sample."""
    sample = stage(
        _sample(labelled.where("toxic IS NOT NULL"), rows).select("doc_id", "text", "toxic"),
        "toxicity-sample",
    )
    telling = telling_features(sample) if 0 < _share(sample) < 1 else []
    names = tuple(n for n, _ in telling)
    bags = _bags(sample, names) if names else []
    if not bags:
        return Model((), (), 0.0, _share(sample))
    truth = np.array([t for t, _ in bags], float)
    owner = np.array([i for i, (_, bag) in enumerate(bags) for _ in bag], np.int64)
    flat = [s for _, bag in bags for s in bag]
    at = np.repeat(np.arange(len(flat)), [len(s) for s in flat])
    feature = np.array([f for s in flat for f in s], np.int64)
    # parameters: weights, bias, leak as a log-odds
    # a word has up to three features, which start with a share of what each says alone
    start = [min(odds, 6.0) / 3 for _, odds in telling]
    x = np.concatenate([start, [-2.0, -4.0]])
    first, second = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, rounds + 1):
        z = np.bincount(at, x[feature], len(flat)) + x[-2]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        leak = 1 / (1 + np.exp(-np.clip(x[-1], -30, 30)))
        clean = np.log1p(-leak) + np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-9)), len(bags))
        score = np.clip(-np.expm1(clean), 1e-9, 1 - 1e-9)
        # d loss / d log(1 - score)
        slope = np.where(truth > 0, (1 - score) / score, -1.0) / len(bags)
        by_z = -slope[owner] * p
        grad = np.concatenate([
            np.bincount(feature, by_z[at], len(names)) + decay * x[:-2],
            [by_z.sum(), -(slope * leak).sum()],
        ])
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        x = x - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    leak = float(1 / (1 + np.exp(-x[-1])))
    return Model(names, tuple(map(float, x[:-2])), float(x[-2]), leak)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with score, and offending: (start, stop, score) of the sentences of 0.5 and more."""
    weights, bias, leak = np.array(model.weights), model.bias, model.leak
    names = model.features

    @F.pandas_udf("score double, offending array<struct<start:int,stop:int,score:double>>")
    def judged(texts: pd.Series) -> pd.DataFrame:
        known, scores, located = _known(names), [], []
        for body in texts:
            clean, bad = 1 - leak, []
            for start, stop, own in sentences_of(body, known):
                p = float(1 / (1 + np.exp(-np.clip(bias + weights[own].sum(), -30, 30))))
                clean *= 1 - p
                if p >= 0.5:
                    bad.append({"start": start, "stop": stop, "score": p})
            scores.append(1 - clean)
            located.append(bad)
        return pd.DataFrame({"score": scores, "offending": located})

    others = [c for c in docs.columns if c not in ("score", "offending")]
    mark = "_" * (1 + max(map(len, docs.columns)))  # no column of docs has this name
    scored = in_small_batches(docs).select(*others, judged(text).alias(mark))
    return scored.select(*others, f"{mark}.*")


def held_out(doc_id: str = "doc_id"):
    """Rows that never train: crc32 of the id as text is a multiple of 5."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def train_on(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """A model from the labelled documents that are not held out."""
    known = labels.where(F.col("toxic").isNotNull() & ~held_out()).select("doc_id", "toxic")
    # about ``rows`` rows of two numbers
    chosen = F.broadcast(_sample(known, rows))
    return fit(docs.select("doc_id", "text").join(chosen, "doc_id"), 2 * rows)
