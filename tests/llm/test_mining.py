"""Lexical search, phrase mining and the metric join against brute force and on unusual rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from orderflow.llm import lexical, metric_join, phrases

WORDS = [a + b for a in ("ka", "lo", "mi", "é", "Ne") for b in ("x", "YY", "z9", "ß", "")]


def say(rng, n, words=WORDS, glue=" "):
    return glue.join(rng.choice(words) for _ in range(n))


# 11 ranked lexical search


def _terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def _ranked(docs, items, best):
    bags = [(i, Counter(_terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_words = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    rows = []
    for item, text in items:
        scores = []
        for i, bag in bags:
            m = 75 + 25 * sum(bag.values()) * n_docs // n_words
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (1_000_000_000 * bag[t] // (1000 * bag[t] + 12 * m)) for t in _terms(text) if t in bag)
            if score > 0:
                scores.append((-score, i is None, i or 0))
        rows += [(item, k, None if no else i, -s)
                 for k, (s, no, i) in enumerate(sorted(scores)[:best], 1)]
    return sorted(rows, key=repr)


@pytest.mark.parametrize("owners", [1, 3])
def test_search_equals_brute_force_over_slices_and_bundles(spark, monkeypatch, owners):
    monkeypatch.setattr(lexical, "SLICE_DOCS", 7)
    monkeypatch.setattr(lexical, "BUNDLE_ITEMS", 3)
    rng = random.Random(owners)
    docs = [(rng.randrange(10**9) if i % 9 else None, say(rng, rng.randrange(1, 40))) for i in range(150)]
    docs += [(10**10 + i, docs[5][1]) for i in range(30)] + [(7, None), (8, ""), (9, "?! --"), (docs[5][0], docs[5][1])]
    items = [(i, say(rng, rng.randrange(1, 9))) for i in range(10)] + [(50, None), (51, "unheard"), (52, "!")]
    wide = [(i, t, "clash", "clash") for i, t in docs]
    got = lexical.search(
        spark.createDataFrame(wide, "doc_id long, text string, term string, slice string").repartition(5),
        spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, bundle int"),
        best=6, owners=owners)
    assert sorted(map(tuple, got.collect()), key=repr) == _ranked(docs, items, 6)


def test_search_prunes_but_keeps_the_best(spark, monkeypatch):
    """One common word and many rare ones: later owners have little to add."""
    monkeypatch.setattr(lexical, "SLICE_DOCS", 64)
    rng = random.Random(5)
    rare = [f"r{i}" for i in range(60)]
    docs = [(i, "the of " + say(rng, 6, rare) + " the" * rng.randrange(5)) for i in range(400)]
    items = [(i, "the of " + say(rng, 4, rare)) for i in range(8)]
    got = lexical.search(spark.createDataFrame(docs, "doc_id long, text string"),
                         spark.createDataFrame(items, "item_id long, text string"), best=5)
    assert sorted(map(tuple, got.collect()), key=repr) == _ranked(docs, items, 5)


def test_search_of_empty_tables_and_long_texts(spark):
    docs = spark.createDataFrame([(1, "far " * 200_000 + "near")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "near")], "item_id long, text string")
    assert [r["doc_id"] for r in lexical.search(docs, items).collect()] == [1]
    assert lexical.search(docs.limit(0), items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0
    assert lexical.search(docs.where("doc_id < 0"), items).columns == ["item_id", "rank", "doc_id", "score"]


# 12 phrases


def test_trie_counts_like_a_table():
    rng = random.Random(3)
    for length in (2, 3):
        trie, plain = phrases.HatTrie(length, burst=5), Counter()
        got = Counter()
        for _ in range(40):
            keys = [sum(rng.choice([1, 2, 3, 30, 900]) << phrases.WORD_BITS * i for i in range(length)) for _ in range(50)]
            found, times = np.unique(keys, return_counts=True)
            trie.add(found, 2 * times)
            plain.update({k: 2 * n for k, n in Counter(keys).items()})
            if rng.random() < 0.2:
                left = trie.size // 2
                own, numbers = trie.spill(left)
                assert trie.size <= left and (np.diff(own) > 0).all()
                assert not {k >> phrases.WORD_BITS * (length - 1) for k in own.tolist()} & set(trie.root)
                got.update(dict(zip(own.tolist(), numbers.tolist())))
        size = trie.size
        own, numbers = trie.spill()
        assert len(own) == size and trie.size == 0
        got.update(dict(zip(own.tolist(), numbers.tolist())))
        assert got == plain


def _collocations(docs, least, best, covered):
    out = []
    by = {}
    for lang, text in docs:
        by.setdefault(lang or "und", []).append(text or "")
    for lang, texts in by.items():
        f = Counter()
        for text in texts:
            lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lower):
                words = re.findall(r"[^ \t]+", piece)
                for k in (1, 2, 3):
                    f.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
        n = sum(v for p, v in f.items() if len(p) == 1)
        good = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in good.items():
            longer = [b for q, b in good.items() if len(q) > len(p) and any(
                q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * b >= covered * a for b in longer):
                continue
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), a, left, right, n, score))
        for rank, (_, _, p, a, left, right, n, score) in enumerate(sorted(rows)[:best], 1):
            out.append((lang, rank, p.decode(), a, left, right, n, score))
    return sorted(out)


def test_phrases_equal_brute_force_with_spills(spark, monkeypatch):
    monkeypatch.setattr(phrases, "ENTRIES", 50)
    monkeypatch.setattr(phrases, "BURST", 8)
    monkeypatch.setattr(phrases, "HOT", 40)
    monkeypatch.setattr(phrases, "PART", 300)
    monkeypatch.setattr(phrases, "WINDOW", 37)
    rng = random.Random(1)
    docs = [(rng.choice(["en", "fr", None]), "".join(
        rng.choice(WORDS) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "!", " "])
        for _ in range(rng.randrange(300)))) for _ in range(60)]
    docs += [("en", "hot Pair"), ("en", "hot pair again"), ("de", None), (None, ""), ("de", "...!?")] * 30
    table = spark.createDataFrame(
        [(lang, t, "clash", 1) for lang, t in docs], "lang string, text string, first string, f int").repartition(5)
    got = phrases.collocations(table, least=5, best=40)
    assert sorted(map(tuple, got.collect())) == _collocations(docs, 5, 40, 50)


def test_phrases_of_empty_tables_and_very_long_texts(spark):
    docs = spark.createDataFrame([("en", "one two three " * 120_000)], "lang string, text string")
    got = phrases.collocations(docs).collect()
    assert {r["phrase"]: r["a"] for r in got} == {
        "one two three": 120_000, "two three one": 119_999, "three one two": 119_999}
    assert {r["n"] for r in got} == {360_000}
    assert phrases.collocations(docs.limit(0)).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    big = 4 * 10**12 + 7
    word = spark.createDataFrame([("en", "a", "", big + 2), ("en", "b", "", big + 9)], "lang string, first string, rest string, f long")
    pair = spark.createDataFrame([("en", "a", "b", big)], word.schema)
    total = spark.createDataFrame([("en", 3 * big)], "lang string, n long")
    (row,) = phrases.ranked(word, pair, pair.limit(0), total, 5, 50).collect()
    assert row["score"] == 1_000_000 * big * big // ((big + 2) * (big + 9))


# 13 metric join


def _linked(rows, cosine):
    """(n_links, component_id) of each row, by comparing all."""
    def unit(v):
        if not v or None in v or not np.isfinite(v).all() or not np.any(v):
            return None
        return np.array(v) / np.linalg.norm(v)

    units = [unit(v) for _, v, _ in rows]
    n = len(rows)
    near = [[j for j in range(n) if j != i and units[i] is not None and units[j] is not None
             and rows[i][2] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j])
             and (rows[i][1] == rows[j][1] or units[i] @ units[j] >= cosine)] for i in range(n)]
    least = {}
    for i in range(n):
        if i in least:
            continue
        seen, todo = {i}, [i]
        while todo:
            new = set(near[todo.pop()]) - seen
            seen |= new
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least.update(dict.fromkeys(seen, min(ids) if ids else None))
    return sorted(((rows[i][0], len(near[i]), least[i], rows[i][0] is not None and rows[i][0] == least[i])
                   for i in range(n)), key=repr)


def _planted(seed, dims):
    """Chains and bunches around a few centres, copies, and vectors that cannot link."""
    rng = np.random.default_rng(seed)
    rows, centres = [], rng.normal(size=(6, dims))
    for i in range(260):
        v = centres[i % 6] * rng.choice([1, 3]) + rng.normal(size=dims) * rng.choice([0.05, 0.3, 0.6, 1.5])
        rows.append((int(rng.integers(10**6)), v.tolist(), int(rng.integers(3))))
    rows += [(i, rows[0][1], rows[0][2]) for i in range(2_000_000, 2_000_040)]
    rows += [(11, None, 1), (12, [], 1), (13, [0.0] * dims, 1), (14, [float("nan")] * dims, 1),
             (15, [float("inf")] + [1.0] * (dims - 1), 1), (16, [None] + [1.0] * (dims - 1), 1),
             (17, rows[0][1], None), (None, rows[0][1], rows[0][2]), (18, [1.0, 2.0], 1), (19, [2.0, 4.0], 1),
             (rows[3][0], rows[3][1], rows[3][2]), (20, [-x for x in rows[0][1]], rows[0][2])]
    return rows


@pytest.mark.parametrize(("fine", "dims", "chunk", "home", "guest"), [
    (16, 4, 1 << 19, 1 << 18, 1 << 20), (0.8, 4, 200, 24, 56), (0.5, 12, 400, 10**6, 120), (2, 3, 90, 30, 10**6)])
def test_links_equal_brute_force_for_any_cells_and_blocks(spark, fine, dims, chunk, home, guest):
    rows = _planted(dims, dims)
    table = spark.createDataFrame(
        [(i, v, label, "clash", 1) for i, v, label in rows],
        "vec_id long, embedding array<double>, label int, node string, cell int").repartition(4)
    got = metric_join.near_duplicates(table, 0.93, fine, chunk, home, guest)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=repr) == _linked(rows, 0.93)


def test_pivots_spare_comparisons_of_bunched_vectors(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] + rng.normal(size=16) * 0.02).tolist(), 1) for i in range(1200)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    vectors = metric_join.read_vectors(table).withColumn("copies", metric_join.F.lit(1).cast("long"))
    inside = metric_join.members(metric_join.dealt(vectors, fine=0.6))
    # with 58 pivots for 40 bunches, a vector is in few cells instead of all 58
    assert inside.count() < 12 * len(rows)


def test_a_large_group_of_near_copies(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=8)
    rows = [(i, (centre + rng.normal(size=8) * 0.01).tolist(), 5) for i in range(900)]
    got = metric_join.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), home=800, guest=2000).collect()
    assert all(r["n_links"] == 899 and r["component_id"] == 0 and r["kept"] == (r["vec_id"] == 0) for r in got)


def test_vectors_of_an_empty_table(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert metric_join.near_duplicates(none).count() == 0
    alone = spark.createDataFrame([(3, [1.0, 0.0], None), (4, None, 2)], "vec_id long, embedding array<float>, label int")
    assert sorted(map(tuple, metric_join.near_duplicates(alone).collect())) == [(3, 0, 3, True), (4, 0, 4, True)]
