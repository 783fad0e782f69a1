"""Operators against brute force and on unusual rows."""

import random
from collections import Counter

import public_tokenizers
import pytest
from compare import connect, difference
from pyspark.sql import functions as F

import corpus_pipeline
from orderflow.llm import (
    bagminhash, bpe, chat, common, components, decontaminate, license_scan, line_dedup, merkle,
    sharding, toxicity, url_rules,
)
from orderflow.llm.oracle import ORACLE
from orderflow.llm.queries import QUERIES

#: text and n_chars plus columns whose names the operators use themselves.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "size string, shard string, score string, host string, leaks string, n_tokens string, ids string")


def odd_docs(spark, more=()):
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (3, "One line.", None, "a"), (3, "One line.", None, "a"),
        (None, "No id here, but words to say.", "en", None), (5, "long " * 60_000 + "\n" + "x" * 50_000, "en", "b"),
        (6, "One line.", "en", "b"), *more,
    ]
    return spark.createDataFrame(
        [(i, t, l, s, len(t or ""), *["clash"] * 7) for i, t, l, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def coder():
    return bpe.tokenizer_json(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, con, key):
    assert difference(QUERIES[key](spark, sf_dir), con, ORACLE[key]) is None


def test_attach_gives_the_same_rows_by_either_join(spark):
    big = spark.range(50).select((F.col("id") % 7).alias("k"), "id")
    lookup = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    both = [sorted(map(tuple, common.attach(big, lookup, ["k"], most=n).collect())) for n in (0, 100)]
    assert both[0] == both[1]


def test_numbers_are_gapless_in_each_key(spark):
    rows = spark.range(1000).select((F.col("id") % 3 * (F.col("id") % 2)).alias("k"), "id")
    got = common.number_within(rows.union(rows), "k", ["id"], "n", buckets=8).collect()
    for k in {r["k"] for r in got}:
        own = sorted(r["n"] for r in got if r["k"] == k)
        assert own == list(range(len(own)))


# 1 sharding


def test_shards_hold_whole_groups_of_near_equal_size(spark, sf_dir, texts):
    rows = QUERIES["op1_shards"](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    fill, slots, home = Counter(), {}, {}
    for r in rows:
        assert r["size"] == len(texts[r["doc_id"]].encode()) + 1
        fill[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert home.setdefault(texts[r["doc_id"]], r["shard"]) == r["shard"]
    assert sorted(fill) == list(range(8)) and max(fill.values()) < 1.01 * min(fill.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_fixed_capacity_opens_as_many_shards_as_needed(spark):
    docs = spark.createDataFrame([(i, "x" * (9 if i < 6 else 4) + str(i)) for i in range(10)],
                                 "doc_id long, text string")
    rows = sharding.shard(docs, capacity=17).collect()
    fill = Counter()
    for r in rows:
        fill[r["shard"]] += r["size"]
    assert sorted(fill.values()) == [11, 11, 12, 12, 17, 17, 17, 17][2:] or max(fill.values()) <= 17
    with pytest.raises(ValueError):
        sharding.shard(docs)


def test_shards_of_odd_rows(spark):
    rows = sharding.shard(odd_docs(spark), shards=2).collect()
    assert len(rows) == 7
    assert {r["size"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    assert len({r["shard"] for r in rows if r["doc_id"] in (3, 6)}) == 1
    assert sharding.shard(odd_docs(spark).limit(0), shards=2).count() == 0


# 2 line dedup


def test_lines_of_odd_rows(spark):
    docs = odd_docs(spark, [(i, f"Menu \nown {i}\n\nown {i}", "en", "c") for i in range(10, 20)])
    rows = line_dedup.drop_boilerplate(docs).collect()
    got = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] is not None}
    assert len(rows) == 17 and set(rows[0].asDict()) >= set(docs.columns)
    assert got[10] == "own 10\n\nown 10" and got[1] is None and got[2] == "" and got[3] == "One line."
    assert [r["text"] for r in rows if r["doc_id"] is None] == ["No id here, but words to say."]
    # four pages of a host are too few
    few = odd_docs(spark, [(i, "Menu", "en", "c") for i in range(4)])
    assert line_dedup.boilerplate(few).count() == 0
    all_gone = line_dedup.drop_boilerplate(odd_docs(spark, [(i, "Menu", "en", "c") for i in range(30, 36)]))
    assert [r["text"] for r in all_gone.where("doc_id >= 30").collect()] == [""] * 6
    assert line_dedup.drop_boilerplate(docs.limit(0)).count() == 0


# 3 toxicity


def test_toxicity_finds_held_out_documents_and_sentences(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    rows = []
    for i in range(600):
        lines = [" ".join(rng.choice(words) for _ in range(8)) for _ in range(rng.randrange(1, 9))]
        if i % 6 == 0:
            lines[rng.randrange(len(lines))] += f" {rng.choice(['vileones', 'vilemost', 'rotten'])} it is"
        rows.append((i, ". ".join(lines), int(i % 6 == 0)))
    made = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train_on(made, made)
    got = toxicity.score(made, model).withColumn("out", toxicity.held_out()).collect()
    assert all((r["score"] >= 0.5) == bool(r["toxic"]) for r in got if r["out"])
    for r in got:
        for place in r["offending"]:
            assert any(w in r["text"][place["start"]:place["stop"]] for w in ("vile", "rotten"))


@pytest.mark.parametrize("share", [0.33, 0.5, 0.9])
def test_toxicity_at_any_share_of_toxic_labels(spark, share):
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    rows = []
    for i in range(1000):
        lines = [" ".join(rng.choice(words) for _ in range(8)) for _ in range(rng.randrange(1, 5))]
        toxic = int(rng.random() < share)
        if toxic:
            lines[rng.randrange(len(lines))] += f" {rng.choice(['vileones', 'vilemost', 'rotten'])} it is"
        rows.append((i, ". ".join(lines), toxic))
    made = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train_on(made, made)
    out = toxicity.score(made, model).where(toxicity.held_out()).collect()
    right = [(r["score"] >= 0.5) == bool(r["toxic"]) for r in out]
    assert sum(right) >= 0.95 * len(right)


def test_toxicity_with_one_kind_of_labels(spark):
    rows = spark.range(20).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text"))
    for toxic in (0, 1):
        model = toxicity.fit(rows.withColumn("toxic", F.lit(toxic)))
        assert {r["score"] for r in toxicity.score(rows, model).collect()} == {toxic}


def test_toxicity_of_odd_rows(spark):
    model = toxicity.Model(("idiot",), (9.0,), -1.0, 0.02)
    docs = odd_docs(spark, [(9, "Fine. You IDIOT!", "en", "a")])
    rows = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert rows[1]["score"] == rows[2]["score"] == rows[5]["score"] == pytest.approx(0.02)
    assert rows[9]["score"] > 0.9 and rows[9]["text"][rows[9]["offending"][0]["start"]:] == " You IDIOT!"
    none = toxicity.fit(docs.select("doc_id", "text").withColumn("toxic", F.lit(None).cast("int")))
    assert toxicity.score(docs, none).where("score = 0").count() == 8


def test_toxicity_beside_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "words", "x", "y", "z")], "doc_id long, text string, _judged string, _ string, offending string")
    got = toxicity.score(docs, toxicity.Model((), (), 0.0, 0.25))
    assert got.columns == ["doc_id", "text", "_judged", "_", "score", "offending"]
    assert got.first()["score"] == 0.25 and got.first()["_judged"] == "x"


def test_training_sample_is_bounded(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic"))
    assert 800 < toxicity._sample(rows, 1000).count() < 1200


# 4 near-duplicates


def near_classes(texts, similarity=0.8):
    bags = {i: frozenset(bagminhash.elements(t).tolist()) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = bags[a], bags[b]
            if x == y or x and y and len(x & y) >= similarity * len(x | y):
                a_, b_ = find(a), find(b)
                root[max(a_, b_)] = min(a_, b_)
    return {i: find(i) for i in ids}


def test_classes_equal_brute_force(spark, sf_dir, texts):
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op4_bagminhash"](spark, sf_dir).collect()}
    assert got == near_classes(texts)


def test_classes_of_a_large_group_of_near_copies(spark):
    """Copies of copies: the ends of the chain are far from the first node."""
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(500)]
    body, texts = [rng.choice(words) for _ in range(120)], {}
    for i in range(150):
        if i % 5 == 0:
            body[rng.randrange(len(body))] = rng.choice(words)
        own = list(body)
        own[rng.randrange(len(own))] = rng.choice(words)
        texts[i] = " ".join(own)
    texts |= {1000 + i: " ".join(rng.choice(words) for _ in range(100)) for i in range(30)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in bagminhash.classes(docs).collect()}
    assert got == near_classes(texts)


def test_classes_of_odd_rows(spark):
    rows = bagminhash.classes(odd_docs(spark, [(7, "No id here, but words to say!", "en", "a")])).collect()
    got = {r["doc_id"]: r["class_id"] for r in rows}
    assert len(rows) == 8
    assert got[1] == got[2] == 1 and got[3] == got[6] == 3 and got[None] == got[7] == 7 and got[5] == 5
    assert bagminhash.classes(odd_docs(spark).limit(0)).count() == 0


def test_wordless_texts_are_near_to_equal_texts_only(spark):
    texts = ["🙂🙂", "!!!", "---- ***", "!!!", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in bagminhash.classes(docs).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 1, 4: 4, 5: 4}
    left = bagminhash.one_of_each_class(docs).collect()
    assert sorted(r["doc_id"] for r in left) == [0, 1, 2, 4]


def test_unspaced_scripts_are_compared_by_characters(spark):
    rng = random.Random(12)
    han = [chr(0x4E00 + i) for i in range(2000)]
    body = [rng.choice(han) for _ in range(400)]
    near, far = list(body), [rng.choice(han) for _ in range(400)]
    near[200] = "x"
    thai = "".join(chr(0x0E01 + rng.randrange(40)) for _ in range(300))
    texts = ["".join(body), "".join(near), "".join(far), thai, thai[:150] + "ก" + thai[151:], "eng" + thai[:20]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in bagminhash.classes(docs).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 3, 4: 3, 5: 5}


def test_rows_under_one_doc_id_have_the_class_of_their_own_text(spark):
    rng = random.Random(13)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(500)]
    a, b, c = (" ".join(rng.choice(words) for _ in range(60)) for _ in "abc")
    rows = [(1, a), (2, b), (2, a + " more"), (2, c), (2, c), (3, c), (4, b), (4, "own words of four"), (None, a), (5, a)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, copy string")
    got = bagminhash.classified(docs).collect()
    assert len(got) == len(rows) and len({r["root"] for r in got}) == 4
    left = bagminhash.one_of_each_class(docs)
    assert left.columns == docs.columns
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in left.collect()))) == sorted(
        map(str, [(1, a), (2, b), (2, c), (2, c), (4, "own words of four"), (None, a)]))


def test_components_of_chains(spark):
    rng = random.Random(10)
    links = [(i, i + 1) for i in range(40) if i != 20] + [(100, b) for b in range(101, 120)]
    rng.shuffle(links)
    got = {r["b"]: r["a"] for r in components.components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 21)}, **{i: 21 for i in range(22, 41)},
                   **{i: 100 for i in range(101, 120)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# 5 decontamination


def test_leaks_contain_every_exact_copy(spark, sf_dir, texts, con):
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    exact = {(d, i) for d, t in texts.items() for i, x in items if x in t}
    rows = QUERIES["op5_decontamination"](spark, sf_dir).collect()
    bodies = dict(items)
    assert exact <= {(r["doc_id"], r["item_id"]) for r in rows}
    for r in rows:
        limit = (1 - decontaminate.SIMILARITY) * len(bodies[r["item_id"]].encode())
        assert 0 <= r["distance"] <= limit and r["start"] < r["stop"] <= len(texts[r["doc_id"]])


def test_leaks_of_odd_rows(spark):
    benchmark = spark.createDataFrame(
        [(1, "What is the capital city of the old country, they asked."), (2, None), (3, "hm"), (4, "")],
        "item_id long, text string")
    hit = "é WHAT is the capital   city of the odd country; they asked?"
    docs = odd_docs(spark, [(8, hit, "en", "a"), (9, f"{hit} {hit}", "en", "a")])
    rows = decontaminate.leaks(docs, benchmark).collect()
    assert Counter((r["doc_id"], r["item_id"]) for r in rows) == {(8, 1): 1, (9, 1): 2}
    assert hit[rows[0]["start"]:rows[0]["stop"]].startswith("WHAT")
    assert decontaminate.mark_leaks(docs, benchmark).where(decontaminate.is_clean()).count() == 7
    assert decontaminate.leaks(docs, benchmark.limit(0)).count() == 0
    assert decontaminate.leaks(docs.limit(0), benchmark).count() == 0


# 6 fingerprints


def test_next_document_over_group_borders(spark):
    ids = [-5, 0, 3, 4, 9, 17, 18, 40, 1000, 70_000]
    docs = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string")
    got = {r["doc_id"]: r["next_text"] for r in merkle.with_next(docs, bits=2).collect()}
    assert got == {a: f"text {b}" for a, b in zip(ids, ids[1:] + ids[:1])}


def test_next_document_of_sparse_and_dense_ids(spark):
    rng = random.Random(14)
    ids = sorted({*(rng.getrandbits(62) * rng.choice([1, -1]) for _ in range(800)), *range(5000, 9000)})
    docs = spark.createDataFrame([(i, str(i)) for i in rng.sample(ids, len(ids))], "doc_id long, text string")
    got = {r["doc_id"]: int(r["next_text"]) for r in merkle.with_next(docs.repartition(7)).collect()}
    assert got == dict(zip(ids, [*ids[1:], ids[0]]))


def test_fingerprints_of_odd_rows(spark):
    rows = merkle.compare_with_next(odd_docs(spark)).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == 7 and got[1]["fingerprint"] == got[2]["fingerprint"]
    assert got[3]["fingerprint"] == got[6]["fingerprint"] != got[2]["fingerprint"]
    assert got[1]["near_next"] == 1.0 and got[2]["near_next"] == 0.0 and got[1]["n_chars"] == 0
    assert merkle.compare_with_next(odd_docs(spark).limit(0)).count() == 0
    alone = merkle.compare_with_next(odd_docs(spark).where("doc_id = 6")).first()
    assert alone["near_next"] == 1.0


def test_differing_leaves_locate_an_edit(spark):
    lines = [f"Line {i} says something." for i in range(60)]
    other = [*lines[:30], "A new line.", *lines[30:]]
    rows = spark.createDataFrame([("\n".join(lines), "\n".join(other))], "a string, b string")
    got = (rows.select(merkle.leaves("a").alias("la"), merkle.leaves("b").alias("lb"))
           .select(merkle.fingerprint("la").alias("fa"), merkle.fingerprint("lb").alias("fb"), "lb")
           .select(merkle.differing("fb", "fa").alias("new"), merkle.differing("fa", "fb").alias("gone"), "lb"))
    row = got.first()
    assert row["gone"] == [] and len(row["new"]) == 1 and row["new"][0] in row["lb"]


# 7 urls


def test_urls_equal_brute_force(spark):
    rng = random.Random(11)
    labels = ["com", "net", "a", "b", "www", "a-b", "x"]
    host = lambda: ".".join(rng.choice(labels) for _ in range(rng.randrange(1, 5)))
    path = lambda: "".join(f"/{rng.choice('ab')}" for _ in range(rng.randrange(3)))
    rules = list({(h, p): (rng.choice(["allow", "block"]), h, p)
                  for h, p in ((host(), path()) for _ in range(60))}.values())
    urls = [(i, f"http://{host()}{path()}{rng.choice(['', '?q', '#f/a', '/'])}") for i in range(400)]
    urls += [(900, None), (901, "no scheme"), (902, ""), (903, "HTTP://WWW.A.COM"), (904, "x://"), (None, None)]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in urls], "page_id long, url string, host string")
    got = {r["page_id"]: r for r in
           url_rules.judge(pages, url_rules.rule_table(spark, rules), ranges=7).collect()}
    assert len(got) == len(urls)
    for i, r in got.items():
        fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules
                if (r["host"] == h or r["host"].endswith("." + h)) and r["path"].startswith(p)]
        best = max(fits, default=(0, 0, None, "allow"))
        assert (r["rule"], r["verdict"]) == best[2:], (i, r)
    assert got[903]["host"] == "www.a.com" and got[901]["host"] == got[900]["host"] == ""
    assert {r["verdict"] for r in url_rules.judge(pages, url_rules.rule_table(spark, [])).collect()} == {"allow"}
    assert url_rules.judge(pages.limit(0), url_rules.rule_table(spark, rules)).count() == 0


# 8 licences


def test_licences_of_odd_rows(spark):
    docs = odd_docs(spark, [
        (7, "Text.\n  released UNDER the MIT licence, MIT License!\nReleased under the MIT License.", "en", "a"),
        (8, "This work is licensed under the\nGNU General Public License, version 3.", "en", "a"),
        (9, "Licensed under a mood.", "en", "a")])
    got = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    assert (got[7]["license"], got[7]["dice"], got[7]["line_no"]) == ("MIT", 1.0, 2)
    assert (got[8]["license"], got[8]["line_no"]) == ("GPL-3.0", -1)
    assert all(got[i]["license"] is None for i in (1, 2, 3, 5, 9))
    assert license_scan.scan(docs.limit(0)).count() == 0


def test_licences_in_windows(spark):
    full = dict(license_scan.full_texts())
    grant = license_scan.TEMPLATES[16][1].replace("any person", "any\nperson").replace("without lim", "without\nlim")
    cases = [(10 + i, name, f"Copyright 2020 A. Person\n\n{body}\nSome words that follow.")
             for i, (name, body) in enumerate(full.items())]
    cases += [(40, "MIT", "First line.\n" + grant + "\nLast line of it, with more words than the notice has " * 9),
              (41, "MIT", "A tool by someone, released under the MIT license in 2020 and kept by many others."),
              (42, "GPL-3.0", "See below.\nThis work is licensed under the GNU\nGeneral Public License, version 3. " + "x y z " * 90),
              (43, None, "Work that is licensed under the Apache License, Version 1.1 and not any other one, as we say."),
              (44, None, "Nobody has any rights that all of us reserved.")]
    docs = odd_docs(spark, [(i, body, "en", "a") for i, _, body in cases])
    got = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    assert {i: got[i]["license"] for i, *_ in cases} == {i: name for i, name, _ in cases}
    assert (got[41]["dice"], got[41]["line_no"], got[42]["line_no"]) == (1.0, 0, 1)
    assert all(got[i]["license"] is None for i in (1, 2, 3, 5, 6))


# 9 chats


def test_chats_keep_maximal_conversations(spark):
    turn = lambda c, n, t, r="user": (c, n, r, t, "clash")
    rows = [turn(1, 0, "a"), turn(2, 0, "a"), turn(2, 1, "b"), turn(3, 0, "a"), turn(3, 1, "b"), turn(3, 1, "b"),
            turn(4, 0, "b"), turn(5, 0, None), turn(5, 1, "x", None), turn(None, 0, "a"), turn(6, None, "z")]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, said string")
    got = {r["conv_id"]: r for r in chat.render(chats).collect()}
    assert set(got) == {2, 4, 5, 6} and got[2]["copies"] == 2 and got[2]["n_turns"] == 2
    assert got[5]["chat"] == "<|user|>\n\n<|end|>\n<|user|>\nx\n<|end|>\n"
    assert chat.render(chats.limit(0)).count() == 0


# 10 byte-level BPE


def test_bpe_query_equals_the_rank_library(spark, sf_dir, texts):
    import hashlib
    import struct

    import tiktoken

    rank = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=bpe.read_ranks(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    rows = QUERIES["op10_byte_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = rank.encode_ordinary(texts[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()
    (one,) = bpe.encode(spark.createDataFrame([("na\u00efve \U0001f642 Text",)], "text string"), bpe.tokenizer_json(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN), spans=True).collect()
    ids = rank.encode_ordinary("na\u00efve \U0001f642 Text")
    spans = struct.unpack(f"<{2 * len(ids)}i", one["spans"])
    assert list(spans[::2]) == rank.decode_with_offsets(ids)[1] and spans[-1] == len("na\u00efve \U0001f642 Text")


def test_bpe_of_odd_rows(spark, coder):
    docs = odd_docs(spark, [(7, "x\u0000y \U0001fe5f", "en", "a")])
    rows = bpe.decode(bpe.encode(docs, coder), coder).collect()
    assert len(rows) == 8
    for r in rows:
        assert bytes(r["decoded"]).decode() == (r["text"] or "") and len(r["ids"]) == 4 * r["n_tokens"]
        assert r["size"] == "clash"
    assert bpe.encode(docs.limit(0), coder).count() == 0


# pipeline


def test_stages_of_odd_rows(spark, sf_dir):
    docs = odd_docs(spark)
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, sf_dir)
        assert docs.columns == list(corpus_pipeline.COLUMNS), name
    assert sorted(r["doc_id"] or 0 for r in docs.collect()) == [0, 1, 3, 3, 5]
    empty = odd_docs(spark).limit(0)
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, empty, sf_dir).count() == 0, name


def test_pipeline_leaves_only_what_its_last_stage_reads(spark, sf_dir):
    from orderflow.session import shared_dir
    from orderflow.sources.versions import Files

    before = set(Files(spark).names(shared_dir(spark)))
    rows = corpus_pipeline.run(spark, sf_dir).count()
    left = set(Files(spark).names(shared_dir(spark))) - before
    assert rows and [x.rsplit("-", 1)[0] for x in left] == ["pipeline-decontamination"]


def test_pipeline_equals_brute_force(spark, sf_dir, texts, con):
    kept = {r["doc_id"] for r in QUERIES["op3_toxicity"](spark, sf_dir).where("predicted = 0").collect()}
    con.execute(f"CREATE OR REPLACE TEMP TABLE kept AS SELECT unnest({sorted(kept)}) AS doc_id")
    sql = ORACLE["op2_line_dedup"].replace("FROM documents", "FROM (SELECT * FROM documents SEMI JOIN kept USING (doc_id))")
    cut = {r[0]: r[3] for r in con.execute(sql).fetchall()}
    assert set(cut) == kept
    roots = near_classes(cut)
    items = [x for (x,) in con.execute("SELECT text FROM benchmark").fetchall()]
    clean = {i for i in cut if roots[i] == i and not any(x in cut[i] for x in items)}
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    got = {r["doc_id"] for r in rows}
    assert len(rows) == len(got) and got <= {i for i in cut if roots[i] == i}
    # an edited copy of an item goes too; the operator's own test covers it
    assert got <= clean and len(clean - got) <= 3
    import hashlib
    for r in rows:
        assert r["decoded_sha256"] == hashlib.sha256(cut[r["doc_id"]].encode()).hexdigest()
