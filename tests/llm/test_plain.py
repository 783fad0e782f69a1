"""The parts of the operators that need no Spark."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from orderflow.llm import bagminhash, bpe, decontaminate, sharding


def test_signatures_estimate_weighted_jaccard_without_bias():
    rng, errors = random.Random(1), []
    for _ in range(40):
        a = {rng.getrandbits(63): rng.choice([1, 1, 2, 3, 5, 9, 40]) for _ in range(60)}
        b = {k: max(1, v + rng.choice([0, 0, 1, -1, 3])) for k, v in a.items() if rng.random() < 0.8}
        b |= {rng.getrandbits(63): 2 for _ in range(5)}
        got = bagminhash.signatures(
            np.array([0] * len(a) + [1] * len(b)), np.array([*a, *b], np.uint64),
            np.array([*a.values(), *b.values()], float), 2)
        keys = set(a) | set(b)
        exact = sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(
            max(a.get(k, 0), b.get(k, 0)) for k in keys)
        errors.append((got[0] == got[1]).mean() - exact)
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.08


def test_signature_does_not_depend_on_the_batch():
    texts = [f"w{i} " * 3 + "some more words of the text " * (i % 4) for i in range(20)] + ["", None, "one"]
    whole = bagminhash.sign_texts(texts)
    alone = [bagminhash.sign_texts([t]) for t in texts]
    assert whole[0] == [d[0] for d, _, _ in alone]
    assert all((w == a[2][0]).all() for w, a in zip(whole[2], alone))


def test_elements_are_the_bag():
    rng = random.Random(2)
    for _ in range(100):
        x, y = (" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in "xy")
        a, b = (Counter(bagminhash.shingles(t).tolist()) for t in (x, y))
        e, f = (set(bagminhash.elements(t).tolist()) for t in (x, y))
        assert len(e & f) == sum((a & b).values()) and len(e | f) == sum((a | b).values())


def _edit(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def test_edit_distance_to_the_best_place():
    rng = random.Random(3)
    for _ in range(200):
        p, t = (bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 90))) for _ in "pt")
        assert decontaminate.edit_ends(p, t)[0] == _edit(p, t)


def test_search_finds_edited_copies_and_their_spans():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, say(30)) for i in range(60)]
    searcher, found = decontaminate.Searcher(items, 0.8), 0
    for i, body in items:
        edited = "".join(c if rng.random() > 0.08 else rng.choice("xyz") for c in body)
        text = f"É{say(20)}. {edited} {say(20)}"
        data = np.frombuffer(text.encode(), np.uint8)
        (hits,) = searcher.search(data, np.array([0, len(data)]))
        hits = [h for h in hits if h["item_id"] == i]
        found += bool(hits)
        for h in hits:
            assert abs(h["start"] - text.index(edited)) < 12
    assert found >= 0.9 * len(items)
    data = np.frombuffer(say(3000).encode(), np.uint8)
    assert searcher.search(data, np.array([0, len(data)])) == [[]]


def _edited(body, rng, edits, kinds, letters):
    body = list(body)
    for _ in range(edits):
        at, kind = rng.randrange(len(body)), rng.choice(kinds)
        body[at:at + (kind != "insert")] = [] if kind == "delete" else [rng.choice(letters)]
    return "".join(body)


@pytest.mark.parametrize("size", [10, 20, 33, 50, 60, 80, 100, 165, 233, 330])
@pytest.mark.parametrize("kinds", [["change", "insert", "delete"], ["delete"]])
def test_search_finds_pairs_at_the_limit(size, kinds):
    """Against brute force: a place within the allowed edits must be found."""
    rng, letters = random.Random(size), "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, (say(size) + "xy")[:size - 1].rstrip() + "e") for i in range(40)]
    searcher = decontaminate.Searcher(items, 0.8)
    true = found = 0
    for i, body in items:
        most = int(0.2 * len(body) + 1e-9)
        text = f"{say(9)} {_edited(body, rng, most, kinds, letters)} {say(9)}"
        data = np.frombuffer(text.encode(), np.uint8)
        # a letter lost between blanks costs two edits
        if _edit(body.encode(), decontaminate.normalised(data)[0].tobytes()) > most:
            continue
        true += 1
        found += any(h["item_id"] == i for h in searcher.search(data, np.array([0, len(data)]))[0])
    assert true > 9 and found >= 0.97 * true
    assert size >= decontaminate.SURE or found == true


@pytest.mark.parametrize("size", [12, 30, 80])
def test_search_in_unspaced_text(size):
    rng = random.Random(size)
    say = lambda n: "".join(chr(rng.randrange(0x4E00, 0x5200)) for _ in range(n))
    items = [(i, say(size)) for i in range(20)]
    searcher = decontaminate.Searcher(items, 0.8)
    for edits in (0, size // 18):
        for i, body in items:
            body = _edited(body, rng, edits, ["change", "insert", "delete"], say(50))
            text = say(47) + body + say(33)
            data = np.frombuffer(text.encode(), np.uint8)
            (hits,) = searcher.search(data, np.array([0, len(data)]))
            assert [h["item_id"] for h in hits] == [i]
            assert abs(hits[0]["start"] - 47) <= 1 + edits


def test_search_reports_neighbouring_copies_once_each():
    item = "two short words of one item"
    text = " ".join([item] * 4)
    data = np.frombuffer((text + text).encode(), np.uint8)
    searcher = decontaminate.Searcher([(1, item), (2, "abcdefghij")], 0.8)
    hits = searcher.search(data, np.array([0, len(text), len(data)]))
    assert [sorted(h["start"] for h in own) for own in hits] == [[28 * k for k in range(4)]] * 2


def _best_fit_one_by_one(sizes, capacity):
    bins = []
    for size in sorted((s for s, n in sizes for _ in range(n)), reverse=True):
        fitting = [(left, i) for i, left in enumerate(bins) if left >= size]
        if fitting:
            bins[min(fitting)[1]] -= size
        else:
            bins.append(capacity - size)
    return bins


def test_best_fit_equals_one_by_one():
    rng = random.Random(5)
    for _ in range(200):
        sizes = sorted({rng.randrange(1, 60): rng.randrange(1, 9) for _ in range(15)}.items(), reverse=True)
        capacity = rng.randrange(60, 200)
        fill = Counter()
        for size, shard, put in sharding.best_fit(sizes, capacity):
            fill[shard] += size * put
        assert sorted(capacity - f for f in fill.values()) == sorted(_best_fit_one_by_one(sizes, capacity))


def test_balanced_tree_stays_balanced():
    tree, rng, held = sharding.BalancedTree(), random.Random(6), []
    for i in range(2000):
        key = (rng.randrange(500), i)
        tree.add(key)
        held.append(key)
        if i % 3 == 0:
            tree.remove(held.pop(rng.randrange(len(held))))
    assert tree.root.height <= 14
    for probe in range(0, 520, 13):
        assert tree.ceiling((probe, -1)) == min((k for k in held if k >= (probe, -1)), default=None)


@pytest.fixture(scope="module")
def coder():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    made = bpe.tokenizer_json(path, public_tokenizers.PATTERN)
    return made, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                                   mergeable_ranks=bpe.read_ranks(path), special_tokens={})


def test_bpe_equals_the_rank_library_and_decodes(coder):
    made, other = coder
    rng = random.Random(7)
    letters = [lambda: chr(rng.randrange(32, 0x250)), lambda: chr(rng.randrange(0x250, 0xD7FF)),
               lambda: chr(rng.randrange(0xE000, 0x2FFFF)), lambda: rng.choice([" ", "\n", "'s", "1", "   ", "aaaa"])]
    texts = ["", " ", "<|endoftext|>", "x " * 300_000] + [
        "".join(rng.choice(letters)() for _ in range(60)) for _ in range(400)]
    for text, ids in zip(texts, bpe.encode_texts(texts, made)):
        assert np.frombuffer(ids, "<u4").tolist() == other.encode_ordinary(text)
        assert bpe.decode_ids(ids, made).decode() == text


def test_bpe_spans_cover_split_characters(coder):
    made, _ = coder
    text = "añ\U0001fe5f日本 word"
    (ids,) = bpe.encode_texts([text], made)
    spans = bpe.char_spans(ids, made)
    assert len(spans) == len(ids) // 4 and spans[0][0] == 0 and spans[-1][1] == len(text)
    for i, c in enumerate(text):
        assert any(a <= i < b for a, b in spans), c
