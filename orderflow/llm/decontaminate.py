"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit distance.

Texts are compared as bytes, with A-Z in lower case and every run of other ASCII
characters than letters and digits as one blank. The CGK random walk reads a window
byte by byte: step j writes the byte at hand, and a random bit for (j, byte) decides
whether to move on. After an edit two walks soon fall into step again, so that small
edit distances become small Hamming distances of what is written. A sample of
positions of the walk is a key of the LSH; ``WALKS`` walks with ``SAMPLES`` samples
each are the repetitions, and a pair of windows is a candidate if one key agrees.

The samples lie in the first ``STEPS`` steps, so only these are walked, and they are
the same for windows of any item's size. Items enter the table with the windows at
all their words, and documents are asked at all of theirs, so each word of an item
adds repetitions.

Walks start at words and need some 28 bytes without many edits, so a second source of
candidates covers what they miss: the q-grams that an item and a text share, at every
byte of both, so that unspaced scripts are searched like others. Those of a true pair
lie near one diagonal (place in the text less place in the item). A pair is a candidate
if two neighbouring bands of diagonals hold as many shared q-grams as ``SEEDS`` asks of
the item's size. Below 56 bytes these are the trigrams that (1 - similarity) edits leave
at least, so none is missed; above, the counts are set for 99 of 100 pairs with as many
random edits as verification allows.

A candidate must have the trigrams that so few edits leave at least (each
edit breaks three), which passes all true ones. Then the item's edit distance to the
best place around is computed exactly (bit-parallel); up to (1 - similarity) of the item's size is a leak.

No text is shuffled. Items go to the tasks in blocks of at most ``BLOCK`` items, so
the broadcast has a bound; more blocks mean more passes over the documents.

Defined cases: null text has no leaks; items of fewer than ``LEAST`` bytes are too
short to be evidence and are not searched; repeated rows give repeated results; an
item found at several places is reported for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import in_small_batches

SIMILARITY = 0.8
STEPS, WALKS, SAMPLES, BITS = 56, 2, 2, 16
#: Shorter items are sampled from fewer steps.
LEAST, SHORT_STEPS, SHORT_BITS = 8, 14, 6
SHORT = 32
#: Items from so many bytes on: q, shared q-grams at that size, and more for each byte beyond it.
SEEDS = ((8, 3, None, None), (56, 5, 9, 0.4), (88, 6, 12, 0.22), (145, 8, 9, 0.15))
#: Up to this size the band of diagonals holds all of a pair's, as many as its edits can shift.
SURE = 56
KEY_BITS = 20
BLOCK = 10_000
#: Bytes of text that are walked at once.
SLICE = 1_000_000
FILTER_BITS = 20
#: Trigrams are counted in 2**CELL_BITS cells.
CELL_BITS = 12
LEAK = "array<struct<item_id:long,start:long,stop:long,distance:int>>"
BLANK = 32


def _alphabet() -> np.ndarray:
    table = np.full(256, BLANK, np.uint8)
    for b in range(256):
        c = chr(b).lower()
        if b >= 128 or c.isalnum():
            table[b] = b if b >= 128 else ord(c)
    return table


ALPHABET = _alphabet()


def normalised(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised bytes and their places in ``data``."""
    mapped = ALPHABET[data]
    blank = mapped == BLANK
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    return mapped[keep], np.flatnonzero(keep)


@dataclass(frozen=True)
class Table:
    """Keys of the items' windows for one length of the walk."""

    steps: int
    bits: int
    keys: tuple[np.ndarray, ...]
    item: tuple[np.ndarray, ...]
    offset: tuple[np.ndarray, ...]
    met: tuple[np.ndarray, ...]


def walk_keys(data: np.ndarray, starts: np.ndarray, steps: int, bits: int) -> Iterator[np.ndarray]:
    """The keys of all repetitions at ``starts``; ``data`` has ``steps`` bytes to spare."""
    for walk in range(WALKS):
        rng = np.random.default_rng([walk, steps])
        moves = rng.integers(0, 2, (steps, 256), np.uint8).astype(np.int32)
        samples = [set(rng.choice(steps, bits, replace=False).tolist()) for _ in range(SAMPLES)]
        factor = rng.integers(1, 1 << 63, (steps, 256), np.uint64)
        at = starts.astype(np.int32)
        keys = [np.zeros(len(starts), np.uint64) for _ in range(SAMPLES)]
        for step in range(steps):
            written = data[at]
            weighed = None
            for k, own in zip(keys, samples):
                if step in own:
                    weighed = factor[step][written] if weighed is None else weighed
                    k += weighed
            at += moves[step][written]
        yield from keys


def _word_starts(data: np.ndarray) -> np.ndarray:
    return np.flatnonzero(data[:-1] == BLANK) + 1


def _table(items: list[tuple[int, np.ndarray]], steps: int, bits: int) -> Table | None:
    if not items:
        return None
    data, where, number, offset, at = [], [], [], [], 0
    for i, body in items:
        # the last windows of an item would read beyond it
        own = np.concatenate([[0], _word_starts(body)])
        own = own[own <= max(0, len(body) - steps // 2)]
        where.append(own + at)
        number.append(np.full(len(own), i))
        offset.append(own)
        data.append(body)
        at += len(body)
    joined = np.concatenate([*data, np.zeros(steps + 1, np.uint8)])
    number, offset = np.concatenate(number), np.concatenate(offset)
    keys, item, place, met = [], [], [], []
    for key in walk_keys(joined, np.concatenate(where), steps, bits):
        order = np.argsort(key, kind="stable")
        seen = np.zeros(1 << FILTER_BITS, bool)
        seen[key >> np.uint64(64 - FILTER_BITS)] = True
        keys.append(key[order])
        item.append(number[order])
        place.append(offset[order])
        met.append(seen)
    return Table(steps, bits, tuple(keys), tuple(item), tuple(place), tuple(met))


@dataclass(frozen=True)
class Seeds:
    """Places of the q-grams of the items of one size class, by key."""

    q: int
    met: np.ndarray
    first: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    number: np.ndarray
    least: np.ndarray
    shift: np.ndarray
    size: np.ndarray


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as a number; zeros follow the end."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    out = np.empty(n, np.uint64)
    for r in range(min(8, n)):
        many = (n - r + 7) // 8
        out[r::8] = padded[r : r + 8 * many].view("<u8")
    return out


def seed_keys(wide: np.ndarray, q: int) -> np.ndarray:
    own = wide[: max(0, len(wide) - q + 1)] << np.uint64(64 - 8 * q)
    return (own * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - KEY_BITS)).astype(np.int32)


def _seeds(items: list[tuple[int, np.ndarray]], similarity: float) -> list[Seeds]:
    out = []
    for k, (low, q, base, more) in enumerate(SEEDS):
        high = SEEDS[k + 1][0] if k + 1 < len(SEEDS) else None
        own = [(i, b) for i, b in items if low <= len(b) and (high is None or len(b) < high)]
        if not own:
            continue
        least, shift = [], []
        for _, body in own:
            edits = int((1 - similarity) * len(body) + 1e-9)
            sure = len(body) - q + 1 - q * edits
            least.append(max(1, sure, 0 if base is None else int(base + more * (len(body) - low))))
            shift.append(max(2, (2 * edits - 1).bit_length()) if len(body) < SURE else 4 + (low >= 145))
        keys = [seed_keys(eight_bytes(b), q) for _, b in own]
        key = np.concatenate(keys)
        order = np.argsort(key, kind="stable")
        counts = np.bincount(key, minlength=1 << KEY_BITS)
        out.append(Seeds(
            q, counts > 0, np.concatenate([[0], np.cumsum(counts)]).astype(np.int32),
            np.repeat(np.arange(len(own)), [len(x) for x in keys])[order],
            np.concatenate([np.arange(len(x)) for x in keys])[order],
            np.array([i for i, _ in own]), np.array(least), np.array(shift),
            np.array([len(b) for _, b in own])))
    return out


def banded(wide: np.ndarray, seeds: Seeds) -> np.ndarray:
    """Rows (item, middle, half width) of the pairs of bands with enough shared q-grams."""
    key = seed_keys(wide, seeds.q)
    at = np.flatnonzero(seeds.met[key])
    if not len(at):
        return np.zeros((0, 3), np.int64)
    low = seeds.first[key[at]]
    many = seeds.first[key[at] + 1] - low
    flat = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
    item = seeds.item[flat]
    longest = int(seeds.size.max())
    diagonal = np.repeat(at, many) - seeds.offset[flat] + longest
    # a free band after the last of each item keeps neighbours apart
    bands = ((len(wide) + longest) >> int(seeds.shift.min())) + 2
    cell = item * bands + (diagonal >> seeds.shift[item])
    total = len(seeds.number) * bands
    if total <= min(8 * len(cell), 1 << 24):
        counts = np.bincount(cell, minlength=total + 1)
        cell = np.flatnonzero(counts)
        both = counts[cell] + counts[cell + 1]
    else:
        cell.sort()
        edge = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        both = np.diff(np.concatenate([edge, [len(cell)]]))
        cell = cell[edge]
        both[:-1] += np.where(cell[1:] == cell[:-1] + 1, both[1:], 0)
    good = both >= seeds.least[cell // bands]
    item, band = np.divmod(cell[good], bands)
    width = 1 << seeds.shift[item]
    return np.stack([seeds.number[item], (band + 1) * width - longest, width], 1)


def edit_ends(pattern: bytes, text: bytes) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to any part of ``text``, and the end of that part."""
    places: dict[int, int] = {}
    for i, c in enumerate(pattern):
        places[c] = places.get(c, 0) | 1 << i
    n = len(pattern)
    every, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score = every, 0, n
    best, end = n, 0
    for j, c in enumerate(text, 1):
        here = places.get(c, 0)
        across = here | down
        diagonal = (((here & up) + up) ^ up) | here
        plus = down | (every & ~(diagonal | up))
        minus = up & diagonal
        score += bool(plus & top) - bool(minus & top)
        plus, minus = plus << 1, minus << 1
        up = (minus & every) | (every & ~(across | plus))
        down = plus & across & every
        if score < best:
            best, end = score, j
    return best, end


def best_place(pattern: bytes, text: bytes, most: int) -> tuple[int, int, int] | None:
    """distance, start, stop of the best place of ``pattern`` in ``text``, up to ``most`` edits."""
    distance, stop = edit_ends(pattern, text)
    if distance > most:
        return None
    _, back = edit_ends(pattern[::-1], text[:stop][::-1])
    return distance, stop - back, stop


def trigram_cells(data: np.ndarray) -> np.ndarray:
    """The cell of the trigram at every place; different trigrams may share one of 2**CELL_BITS."""
    wide = data.astype(np.uint32)
    code = wide[:-2] | wide[1:-1] << np.uint32(8) | wide[2:] << np.uint32(16)
    return (code * np.uint32(2654435761) >> np.uint32(32 - CELL_BITS)).astype(np.int32)


class Searcher:
    """Finds items in slices of concatenated texts."""

    def __init__(self, items: list[tuple[int, str]], similarity: float):
        self.items: dict[int, bytes] = {}
        self.ids: dict[int, int] = {}
        self.trigrams: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.similarity = similarity
        bodies = []
        for number, (item_id, text) in enumerate(items):
            body, _ = normalised(np.frombuffer(text.strip().encode(), np.uint8))
            if len(body) >= LEAST:
                self.items[number], self.ids[number] = body.tobytes(), item_id
                bodies.append((number, body))
                self.trigrams[number] = np.unique(trigram_cells(body), return_counts=True)
        self.tables = [t for t in (
            _table([x for x in bodies if len(x[1]) >= SHORT], STEPS, BITS),
            _table([x for x in bodies if len(x[1]) < SHORT], SHORT_STEPS, SHORT_BITS),
        ) if t]
        self.seeds = _seeds(bodies, similarity)
        self.longest = max((len(b) for _, b in bodies), default=0)

    def seeded(self, data: np.ndarray) -> np.ndarray:
        """Rows (item, middle of the expected starts, half width) by shared q-grams."""
        found = [np.zeros((0, 3), np.int64)]
        # a pair lies whole in one of the overlapping pieces
        for a in range(0, len(data), SLICE):
            wide = eight_bytes(data[a : a + SLICE + 3 * self.longest])
            found += [banded(wide, s) + np.array([0, a, 0]) for s in self.seeds]
        return np.unique(np.concatenate(found), axis=0)

    def candidates(self, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Rows (item, expected start) of windows that share a key with an item's window."""
        first = np.concatenate([[False], data[:-1] == BLANK])
        first[begins[begins < len(data)]] = True
        starts, found = np.flatnonzero(first), []
        padded = np.concatenate([data, np.zeros(STEPS + 1, np.uint8)])
        for table in self.tables:
            for r, key in enumerate(walk_keys(padded, starts, table.steps, table.bits)):
                at = np.flatnonzero(table.met[r][key >> np.uint64(64 - FILTER_BITS)])
                low = np.searchsorted(table.keys[r], key[at], "left")
                high = np.searchsorted(table.keys[r], key[at], "right")
                many = high - low
                flat = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many)
                flat = flat + np.arange(many.sum())
                found.append(np.stack([table.item[r][flat],
                                       np.repeat(starts[at], many) - table.offset[r][flat]], 1))
        return np.concatenate(found) if found else np.zeros((0, 2), np.int64)

    def may_hold(self, item: int, cells: np.ndarray, most: int) -> bool:
        """False only if more than ``most`` edits are needed, by the count of trigrams.

        Trigrams that share a cell can only raise the count, so no true place is refused.
        """
        own, counts = self.trigrams[item]
        there = np.bincount(cells, minlength=1 << CELL_BITS)[own]
        return np.minimum(counts, there).sum() >= counts.sum() - 3 * most

    def search(self, data: np.ndarray, bounds: np.ndarray) -> list[list[dict]]:
        """Leaks of each text; text i is data[bounds[i]:bounds[i + 1]]."""
        out: list[list[dict]] = [[] for _ in range(len(bounds) - 1)]
        if not len(data) or not self.tables:
            return out
        own, place = normalised(data)
        edges = np.searchsorted(place, bounds)
        walked = self.candidates(own, edges[:-1])
        rows = np.concatenate([np.insert(walked, 2, 0, axis=1), self.seeded(own)])
        if not len(rows):
            return out
        # the document of a candidate is that of the item's middle; near its edge, each it may be
        half = np.array([len(self.items.get(i, b"")) // 2 for i in range(max(self.items) + 1)])
        middle = rows[:, 1] + half[rows[:, 0]]
        placed = [np.searchsorted(edges, np.clip(middle + side * rows[:, 2], 0, len(own) - 1), "right") - 1
                  for side in (-1, 0, 1)]
        rows = np.unique(np.concatenate([np.column_stack([doc, rows]) for doc in placed]), axis=0)
        cells = trigram_cells(own)  # once for all candidates of the slice
        tried: dict[tuple[int, int], list[tuple[int, int]]] = {}
        places: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for d, i, start, width in rows.tolist():
            body = self.items[i]
            most = int((1 - self.similarity) * len(body) + 1e-9)
            low = max(edges[d], start - width - most)
            high = min(edges[d + 1], start + width + len(body) + most)
            spans, known = tried.setdefault((d, i), []), places.setdefault((d, i), [])
            if any(a <= start - width and start + width <= b for a, b in spans):
                continue
            spans.append((start - width - most // 4, start + width + most // 4))
            parts = [(low, high)]
            while parts:
                low, high = parts.pop()
                if high - low < len(body) - most:
                    continue
                got = self.may_hold(i, cells[low : high - 2], most) and best_place(
                    body, own[low:high].tobytes(), most)
                if not got:
                    continue
                distance, a, b = got[0], low + got[1], low + got[2]
                parts += [(low, a), (b, high)]
                if any(min(b, y) - max(a, x) > len(body) // 2 for x, y in known):
                    continue
                known.append((a, b))
                spans.append((a - most, b - len(body) // 2))
                first, last = place[a], place[b - 1]
                before, length = data[bounds[d] : first], data[first : last + 1]
                chars = int(((before & 0xC0) != 0x80).sum())
                out[d].append({"item_id": self.ids[i], "start": chars,
                               "stop": chars + int(((length & 0xC0) != 0x80).sum()), "distance": distance})
        return out


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, str]]]:
    rows = benchmark.select(item_id, text).where(F.col(text).isNotNull()).toLocalIterator()
    block: list[tuple[int, str]] = []
    for row in rows:
        block.append((row[0], row[1]))
        if len(block) == BLOCK:
            yield block
            block = []
    if block:
        yield block


def mark_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
               item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with ``leaks``: item_id, start, stop (characters) and distance of every leak."""
    kept = [c for c in docs.columns if c != "leaks"]
    out = docs.select(*kept, F.expr(f"cast(array() AS {LEAK})").alias("leaks"))
    for block in _blocks(benchmark, item_id, item_text):
        out = _mark_block(out, block, text, similarity)
    return out


def _mark_block(docs: DataFrame, items: list[tuple[int, str]], text: str, similarity: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()),
                               ("distance", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(shared.value, similarity)
        for batch in batches:
            column = batch.column(text).cast(pa.large_string())
            ends = np.concatenate([[0], np.cumsum(
                [x or 0 for x in pa.compute.binary_length(column).to_pylist()], dtype=np.int64)])
            a = 0
            while a < batch.num_rows:
                b = max(a + 1, int(np.searchsorted(ends, ends[a] + SLICE, "right")) - 1)
                part = pa.compute.fill_null(column.slice(a, b - a), "")
                data = np.frombuffer("".join(part.to_pylist()).encode(), np.uint8)
                found = searcher.search(data, ends[a : b + 1] - ends[a])
                rest = batch.slice(a, b - a)
                before = rest.column("leaks").to_pylist()
                both = pa.array([x + y for x, y in zip(before, found)], kind)
                yield pa.RecordBatch.from_arrays(
                    [*(c for c, n in zip(rest.columns, rest.schema.names) if n != "leaks"), both],
                    [*(n for n in rest.schema.names if n != "leaks"), "leaks"])
                a = b

    return in_small_batches(docs).mapInArrow(run, docs.schema)


def is_clean() -> Column:
    return F.size("leaks") == 0


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
          similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, start, stop, distance: one row per leak."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = mark_leaks(own, benchmark, similarity=similarity)
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
