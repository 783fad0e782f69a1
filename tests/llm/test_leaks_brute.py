"""Decontamination over a whole table against the edit distance of every item and every text."""

import random

import duckdb
import numpy as np

from orderflow.llm import decontaminate


def _normal(text):
    return decontaminate.normalised(np.frombuffer(text.encode(), np.uint8))[0].tobytes()


def test_leaks_equal_brute_force_over_a_whole_table(sf_dir):
    read = lambda t: duckdb.sql(f"SELECT * FROM '{sf_dir}/{t}.parquet'").df()
    benchmark, documents = read("benchmark"), read("documents")
    items = list(zip(benchmark["item_id"].tolist(), benchmark["text"]))
    rng, texts = random.Random(6), [t or "" for t in documents["text"]]
    for n, (_, body) in enumerate(items):  # an edited copy of each, up to the limit of 20 %
        own = list(body)
        for _ in range(int(len(own) * rng.choice([0.0, 0.05, 0.1, 0.15]))):
            at = rng.randrange(len(own))
            own[at:at + rng.randrange(2)] = rng.choice(["", "x", "e", "t"])
        at = rng.randrange(len(texts[n]) + 1)
        texts[n] = f"{texts[n][:at]} {''.join(own)} {texts[n][at:]}"
    searcher, want, got = decontaminate.Searcher(items, 0.8), set(), set()
    bodies = [(i, _normal(t.strip())) for i, t in items]
    for n, text in enumerate(texts):
        normal = _normal(text)
        want |= {(n, i) for i, b in bodies
                 if decontaminate.edit_ends(b, normal)[0] <= int(0.2 * len(b) + 1e-9)}
        data = np.frombuffer(text.encode(), np.uint8)
        got |= {(n, hit["item_id"]) for hit in searcher.search(data, np.array([0, len(data)]))[0]}
    assert len(want) >= len(items) and got == want
