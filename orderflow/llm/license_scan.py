"""Licence scan: Dice coefficient over word bigrams.

Every line of a text, and the text as a whole, is normalised (lower case, runs of
other characters than a-z and 0-9 become one blank) and compared with each licence
template by the Dice coefficient of their sets of word bigrams. A pair can reach
the threshold t only if the smaller set has t/(2-t) of the larger, so a unit meets
only the templates whose size fits; most meet none. No shuffle is needed.

Texts without such a match are searched for windows of consecutive words, over line
ends and inside lines, and for whole licence texts (``licences/*.txt``) too. The best
window starts and ends with bigrams of the template, so only those are compared, by the
same coefficient. A notice's bigrams with numbers must all be in a window, as it could
otherwise end before a different version.

Defined cases: null text, empty text and units of one word match nothing; of equal
coefficients the template that comes first wins, then the unit that comes first;
lines and whole texts come before windows;
repeated rows give repeated results.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import repeat
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import in_small_batches, kept

THRESHOLD = 0.8
#: Notices by which texts name their licence.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("All-Rights-Reserved", "All rights reserved."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the \"Software\"), to deal in the Software "
            "without restriction, including without limitation the rights to use, copy, modify, "
            "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions:"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed "
                   "under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied."),
)


def normalised(text: str) -> str:
    return re.sub("[^a-z0-9]+", " ", text.lower()).strip()


def bigrams(text: str) -> set[str]:
    words = normalised(text).split(" ")
    return {f"{a} {b}" for a, b in zip(words, words[1:])}


def template_array(templates=TEMPLATES) -> Column:
    def row(i: int, name: str, text: str) -> Column:
        own = sorted(bigrams(text))
        return F.struct(F.lit(-i).alias("rank"), F.lit(name).alias("license"),
                        F.lit(len(own)).alias("n"), F.array(*map(F.lit, own)).alias("own"))

    return F.array(*(row(i, *t) for i, t in enumerate(templates)))


@lru_cache(maxsize=1)
def full_texts() -> tuple[tuple[str, str], ...]:
    """Licence and text of the complete licences."""
    files = sorted((Path(__file__).parent / "licences").glob("*.txt"))
    return tuple((f.stem, f.read_text(encoding="utf-8")) for f in files)


class Windows:
    """Finds the window of words that is most like a template."""

    def __init__(self, templates, threshold: float, notices: int):
        self.names, self.threshold = [n for n, _ in templates], threshold
        own = [bigrams(t) for _, t in templates]
        self.sizes = np.array([len(o) for o in own])
        self.number: dict[str, int] = {}
        for word in sorted({w for o in own for b in o for w in b.split(" ")}):
            self.number[word] = len(self.number) + 1
        self.base = len(self.number) + 1
        pairs = sorted((self._code(b), b) for b in set().union(*own))
        self.codes = np.array([c for c, _ in pairs])
        self.holds = np.array([[b in o for o in own] for _, b in pairs])
        digits = np.array([any(c.isdigit() for c in b) for _, b in pairs])
        self.needed = self.holds & digits[:, None] & (np.arange(len(own)) < notices)

    def _code(self, pair: str) -> int:
        a, b = pair.split(" ")
        return self.number[a] * self.base + self.number[b]

    def best(self, text: str) -> tuple[str, float, int] | None:
        """Licence, coefficient and first line of the best window."""
        words = re.findall("[a-z0-9]+", text.lower())
        if len(words) < 2:
            return None
        ids = np.fromiter(map(self.number.get, words, repeat(0)), np.int64, len(words))
        code = ids[:-1] * self.base + ids[1:]
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        known = self.codes[at] == code
        there = np.unique(at[known])
        low = self.threshold / (2 - self.threshold)
        fitting = np.flatnonzero((self.holds[there].sum(0) >= low * self.sizes - 1e-9)
                                 & (self.needed[there].sum(0) == self.needed.sum(0)))
        if not len(fitting):
            return None
        # place of the same pair before, for all pairs
        own: dict[tuple[str, str], int] = {}
        before = np.empty(len(code), np.int64)
        for i, pair in enumerate(zip(words, words[1:])):
            before[i] = own.get(pair, -1)
            own[pair] = i
        found = max((m for t in fitting for m in self._windows(int(t), at, known, before)), default=None)
        if found is None:
            return None
        dice, rank, start = found
        place = next(m.start() for i, m in enumerate(re.finditer("[a-z0-9]+", text.lower())) if i == -start)
        return self.names[-rank], dice, text.lower().count("\n", 0, place)

    def _windows(self, t: int, at, known, before):
        n, needs = int(self.sizes[t]), int(self.needed[:, t].sum())
        hit, need = known & self.holds[at, t], known & self.needed[at, t]
        most = (2 - self.threshold) / self.threshold * n
        for s in np.flatnonzero(hit & ~np.concatenate([[False], hit[:-1]])).tolist():
            length = 4 * n + 64
            while True:
                new = before[s : s + length] < s
                size = np.cumsum(new)
                if s + length >= len(hit) or size[-1] > most:
                    break
                length *= 2
            dice = 2.0 * np.cumsum(new & hit[s : s + length]) / (size + n)
            if needs:
                dice[np.cumsum(new & need[s : s + length]) < needs] = 0
            top = float(dice.max())
            if top >= self.threshold:
                yield top, -t, -s


def in_windows(text: Column, session, templates, threshold: float, texts) -> Column:
    """license, dice, line of the best window of ``text``."""
    shared = session.sparkContext.broadcast((tuple(templates) + tuple(texts), threshold, len(templates)))

    @F.pandas_udf("license string, dice double, line int")
    def search(column: pd.Series) -> pd.DataFrame:
        windows = kept(("licences", shared.value), lambda: Windows(*shared.value))
        found = [windows.best(x) if x else None for x in column]
        none = (None, None, None)
        out = pd.DataFrame([f or none for f in found], columns=["license", "dice", "line"])
        return out.astype({"license": object, "dice": float, "line": "Int32"})

    return search(text)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
         threshold: float = THRESHOLD, templates=TEMPLATES, texts=None) -> DataFrame:
    """doc_id, license, dice, line_no of every row: its best unit and template.

    ``line_no`` counts from 0; -1 stands for the whole text, and a window has the line
    where it starts. Without a match all three are null.
    """
    sizes = [len(bigrams(t)) for _, t in templates]
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    least, most = int(min(sizes) * low), int(max(sizes) * high) + 1
    units = F.expr("concat(array(text), split(text, '\\n'))")
    # words are kept as a set first: a set of n words makes at least n - 1 bigrams
    words = F.expr(
        "transform(units, (x, i) -> struct(i - 1 AS line_no, split(trim("
        "regexp_replace(lower(x), '[^a-z0-9]+', ' ')), ' ') AS words))"
    )
    fitting = F.expr(
        f"filter(worded, u -> size(u.words) > {least} AND size(array_distinct(u.words)) - 1 <= {most})"
    )
    paired = F.expr(
        "transform(fitting, u -> struct(u.line_no AS line_no, array_distinct(transform("
        "sequence(1, size(u.words) - 1), i -> concat(u.words[i - 1], ' ', u.words[i]))) AS pairs))"
    )
    best = F.expr(
        f"""array_max(filter(flatten(transform(paired, u -> transform(
              filter(templates, t -> size(u.pairs) >= t.n * {low!r}D AND size(u.pairs) <= t.n * {high!r}D),
              t -> struct(2D * size(array_intersect(u.pairs, t.own)) / (size(u.pairs) + t.n) AS dice,
                          t.rank AS rank, -u.line_no AS line, t.license AS license)))),
              m -> m.dice >= {threshold!r}D))"""
    )
    lined = (
        in_small_batches(docs).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
        .select("doc_id", "text", units.alias("units"))
        .select("doc_id", "text", words.alias("worded"))
        .select("doc_id", "text", fitting.alias("fitting"))
        .select("doc_id", "text", paired.alias("paired"), template_array(templates).alias("templates"))
        .select("doc_id", "text", best.alias("best"))
    )
    left = F.when(F.col("best").isNull(), F.col("text"))
    window = in_windows(left, docs.sparkSession, templates, threshold,
                        full_texts() if texts is None else texts)
    return lined.select("doc_id", "best", window.alias("window")).select(
        "doc_id", F.coalesce("best.license", "window.license").alias("license"),
        F.coalesce("best.dice", "window.dice").alias("dice"),
        F.coalesce(-F.col("best.line"), "window.line").alias("line_no"))
