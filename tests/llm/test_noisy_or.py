"""The toxicity model against brute force: features by counting, a fit by finite differences, scores."""

import math
import random
import re

import numpy as np
import pytest

from orderflow.llm import toxicity


def words_of(text):
    return re.findall(r"[^\W\d_]+", text.lower())


def features_of(text):
    return {f for w in words_of(text) for f in ({w, w[:4] + "*", w[:5] + "*"} if len(w) > 3 else {w})}


def table(n=240, seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7))) for _ in range(120)]
    rows = []
    for i in range(n):
        toxic = int(rng.random() < 0.3)
        lines = [" ".join(rng.choice(words) for _ in range(6)) for _ in range(rng.randrange(1, 5))]
        if toxic and rng.random() < 0.9 or rng.random() < 0.05:
            lines[rng.randrange(len(lines))] += " " + rng.choice(["Vileones", "VILEmost", "rotten", "bad ox"])
        rows.append((i, "! ".join(lines), toxic))
    return rows


def counted(rows):
    """Features that tell toxic rows from others, with their log-odds."""
    base = sum(t for *_, t in rows) / len(rows)
    found = []
    for f in sorted(set().union(*(features_of(t) for _, t, _ in rows))):
        every = [t for _, text, t in rows if f in features_of(text)]
        bad, n = sum(every), len(every)
        gain = (bad - base * n) / math.sqrt(base * (1 - base) * n)
        if bad >= 4 and bad * (1 - base) > 3 * base * (n - bad) and gain >= 2:
            found.append((-gain, f, math.log((bad + 0.5) / (n - bad + 0.5) * (1 - base) / base)))
    return [(f, odds) for _, f, odds in sorted(found)]


def bag(text, names):
    own = [[names.index(f) for f in features_of(s) if f in names] for s in re.findall(r"[^.!?\n]+", text)]
    return [s for s in own if s]


def score(x, sentences):
    clean = 1 - 1 / (1 + math.exp(-x[-1]))
    for s in sentences:
        clean *= 1 - 1 / (1 + math.exp(-(sum(x[f] for f in s) + x[-2])))
    return 1 - clean


def loss(x, bags, decay):
    nll = -sum(math.log(score(x, b) if t else 1 - score(x, b)) for t, b in bags) / len(bags)
    return nll + decay / 2 * sum(w * w for w in x[:-2])


def test_features_equal_counting(spark):
    rows = table()
    made = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got, want = toxicity.telling_features(made), counted(rows)
    assert [f for f, _ in got] == [f for f, _ in want] and len(got) >= 6
    assert [o for _, o in got] == pytest.approx([o for _, o in want])


def test_fit_equals_descent_by_finite_differences(spark):
    rows, decay, rate = table(), 0.01, 0.1
    made = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(made, rounds=6, rate=rate, decay=decay)
    telling = counted(rows)
    names = [f for f, _ in telling]
    assert list(model.features) == names
    bags = [(t, bag(text, names)) for _, text, t in rows]
    x = np.array([min(o, 6.0) / 3 for _, o in telling] + [-2.0, -4.0])
    first, second = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, 7):
        grad = np.array([(loss(x + e, bags, decay) - loss(x - e, bags, decay)) / 2e-5
                         for e in np.eye(len(x)) * 1e-5])
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        x = x - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    assert list(model.weights) == pytest.approx(x[:-2].tolist(), abs=1e-4)
    assert model.bias == pytest.approx(x[-2], abs=1e-4)
    assert model.leak == pytest.approx(1 / (1 + math.exp(-x[-1])), abs=1e-5)


def test_scores_of_a_whole_table_equal_the_formula(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.train_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    names = list(model.features)
    x = [*model.weights, model.bias, math.log(model.leak / (1 - model.leak)) if 0 < model.leak < 1 else -40.0]
    for r in toxicity.score(docs, model).collect():
        assert r["score"] == pytest.approx(score(x, bag(r["text"] or "", names)), abs=1e-9)
