"""Byte-level BPE with the tokenizers library over Arrow batches.

A rank file lists byte strings by rank. Its merges follow from the ranks: the last
pair that merging a token's own bytes leaves. Words match the pattern, are written
in the byte alphabet (one printable character for each byte) and merged; a word
that is itself a token becomes that token at once. Decoding reverses the alphabet,
joins the bytes, and so restores characters that tokens have split.

Words are found by the regex library, which has the same classes of characters but
for those that are newer in one of the two (some 17,000, nearly all of rare scripts); a text with one of these goes whole to
the tokenizers library. Each new word goes to the library's model; workers keep the
ids of words they have seen, up to a bounded number. Batches are encoded in slices of
about a million characters, and a longer text in parts, cut before a blank between
two other characters, where the pattern always begins a new word.

Defined cases: null text is encoded as empty text, to no ids; repeated rows give
repeated results; other columns are kept, but for those with the names of results.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from orderflow.llm.common import in_small_batches, kept

#: Characters that are encoded at once.
SLICE = 1_000_000
#: Words whose ids a worker keeps; then it starts anew.
KNOWN_WORDS = 200_000
#: A longer text is encoded in parts of about this many characters.
PART = 250_000
BREAK = re.compile(r"(?<=\S) (?=\S)")


def byte_alphabet() -> list[str]:
    """A printable character for each byte: itself, or the next free one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in set(own) else chr(next(free)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def last_pair(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts that merging by lower ranks leaves of ``token``; None if not two."""
    parts, own = [token[i : i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        best = min((ranks.get(parts[i] + parts[i + 1], own), i) for i in range(len(parts) - 1))
        if best[0] >= own:
            return None
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


def tokenizer_json(path: str, pattern: str) -> str:
    """All that workers need of a rank file and its pattern, with its tokenizers form."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks, letters = read_ranks(path), byte_alphabet()
    write = lambda token: "".join(letters[b] for b in token)
    pairs = (last_pair(t, ranks) for t in sorted(ranks, key=ranks.get) if len(t) > 1)
    made = Tokenizer(models.BPE(
        vocab={write(t): r for t, r in ranks.items()},
        merges=[(write(a), write(b)) for a, b in filter(None, pairs)],
        ignore_merges=True,
    ))
    made.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
    ])
    return json.dumps(
        {"tokenizer": made.to_str(), "pattern": pattern, "odd": odd_characters(pattern)})


def odd_characters(pattern: str, block: int = 4_096) -> str:
    """Characters that a class of ``pattern`` holds in only one of the two libraries.

    Code points are compared in blocks, so the driver never holds them all.
    """
    import regex
    from tokenizers import Regex, pre_tokenizers

    names = sorted(set(re.findall(r"\\p\{\w+\}|\\s", pattern)))
    both = [(pre_tokenizers.Split(Regex(n), "removed"), regex.compile(n)) for n in names]
    odd: set[str] = set()
    for start in range(0, 0x110000, block):
        text = "".join(chr(c) for c in range(start, start + block) if not 0xD800 <= c < 0xE000)
        if not text:
            continue
        for split, own in both:
            left = "".join(part for part, _ in split.pre_tokenize_str(text))
            right = own.sub("", text)
            if left != right:
                odd |= set(left) ^ set(right)
    return "".join(sorted(odd))


class _Known(dict):
    """The packed ids of a word, asked of the library's model once."""

    def __init__(self, model):
        super().__init__()
        self.model = model
        self.letters = dict(enumerate(byte_alphabet()))

    def __missing__(self, word: str) -> bytes:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        written = word.encode().decode("latin-1").translate(self.letters)
        got = self[word] = array("I", [t.id for t in self.model.tokenize(written)]).tobytes()
        return got


def _coder(made: str):
    """Tokenizer, known words, the expression of words, odd characters."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import regex
    from tokenizers import Tokenizer

    parts = json.loads(made)
    tokenizer = Tokenizer.from_str(parts["tokenizer"])
    return tokenizer, _Known(tokenizer.model), regex.compile(parts["pattern"]), set(parts["odd"])


def _table(made: str) -> list[bytes]:
    """The bytes of every id, by reversing the byte alphabet."""
    back = {c: b for b, c in enumerate(byte_alphabet())}
    vocab = json.loads(json.loads(made)["tokenizer"])["model"]["vocab"]
    table = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        table[i] = bytes(back[c] for c in token)
    return table


def _loaded(made: str):
    """What :func:`_coder` gives, the table of bytes, and their numbers."""
    def load():
        table = _table(made)
        return (*_coder(made), table, np.array(list(map(len, table)), np.int64))

    return kept(("bpe", made), load)


def parts_of(text: str, most: int = PART) -> Iterator[str]:
    at = 0
    while len(text) - at > most and (cut := BREAK.search(text, at + most)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def _slices(texts: list[str], size: int = SLICE) -> Iterator[tuple[int, int]]:
    begin = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > size:
            yield begin, i
            begin, held = i, 0
        held += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def encode_texts(texts: list[str], made: str) -> list[bytes]:
    """The ids of each text as little-endian unsigned 32-bit integers."""
    tokenizer, known, word, odd, *_ = _loaded(made)

    def ids(part: str) -> bytes:
        if not (part.isascii() or odd.isdisjoint(part)):
            return array("I", tokenizer.encode(part, add_special_tokens=False).ids).tobytes()
        return b"".join(map(known.__getitem__, word.findall(part)))

    return [b"".join(map(ids, parts_of(text))) for text in texts]


def decode_ids(ids: bytes, made: str) -> bytes:
    table = _loaded(made)[-2]
    return b"".join(map(table.__getitem__, array("I", ids)))


def char_spans(ids: bytes, made: str) -> list[tuple[int, int]]:
    """First character and end of every token; a split character is in each part's span."""
    (spans,) = spans_of([ids], made)
    return list(map(tuple, spans.tolist()))


def spans_of(ids: list[bytes], made: str) -> list[np.ndarray]:
    """For each text, a row (first character, end) for every token."""
    table, lengths = _loaded(made)[-2:]
    numbers = np.frombuffer(b"".join(ids), np.uint32)
    data = np.frombuffer(b"".join(map(table.__getitem__, numbers.tolist())), np.uint8)
    inside = np.append((data & 0xC0) == 0x80, False)
    # characters that have begun before each byte
    begun = np.zeros(len(data) + 1, np.int32)
    np.cumsum(~inside[:-1], out=begun[1:], dtype=np.int32)
    sizes = lengths[numbers]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    spans = np.stack([begun[starts] - inside[starts], begun[ends]], 1).astype(np.int32)
    out, at, byte = [], 0, 0
    for own in ids:
        upto = at + len(own) // 4
        end = int(ends[upto - 1]) if upto else 0
        out.append(spans[at:upto] - begun[byte])
        at, byte = upto, end
    return out


def _with(df: DataFrame, fields: list[StructField]) -> tuple[list[str], StructType]:
    others = [c for c in df.columns if c not in {f.name for f in fields}]
    return others, StructType([*(df.schema[c] for c in others), *fields])


def _shared(df: DataFrame, made: str):
    return df.sparkSession.sparkContext.broadcast(made)


def encode(df: DataFrame, made: str, text: str = "text", decoded: bool = False,
           spans: bool = False) -> DataFrame:
    """``df`` with n_tokens and ids (packed little-endian unsigned 32-bit integers).

    ``decoded`` also decodes the ids in the same task, as :func:`decode` does apart;
    ``spans`` adds the first character and the end of every token, packed like the ids.
    """
    fields = [StructField("n_tokens", LongType()), StructField("ids", BinaryType())]
    fields += [StructField("decoded", BinaryType())] * decoded + [StructField("spans", BinaryType())] * spans

    def results(texts: list[str], made: str) -> list[pa.Array]:
        ids = encode_texts(texts, made)
        out = [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
        if decoded:
            out.append(pa.array([decode_ids(x, made) for x in ids], pa.binary()))
        if spans:
            out.append(pa.array([x.tobytes() for x in spans_of(ids, made)], pa.binary()))
        return out

    return _in_slices(df, made, text, fields, results)


def digest(df: DataFrame, made: str, text: str = "text") -> DataFrame:
    """``df`` with n_tokens and the SHA-256 of ids, of decoded bytes and of spans, made in the task."""
    names = ("ids_sha256", "decoded_sha256", "spans_sha256")
    fields = [StructField("n_tokens", LongType()), *(StructField(n, StringType()) for n in names)]

    def results(texts: list[str], made: str) -> list[pa.Array]:
        ids = encode_texts(texts, made)
        shown = (ids, (decode_ids(x, made) for x in ids), (x.tobytes() for x in spans_of(ids, made)))
        return [pa.array([len(x) // 4 for x in ids], pa.int64()),
                *(pa.array([hashlib.sha256(x).hexdigest() for x in own], pa.string()) for own in shown)]

    return _in_slices(df, made, text, fields, results)


def _in_slices(df: DataFrame, made: str, text: str, fields: list[StructField],
               results: Callable[[list[str], str], list[pa.Array]]) -> DataFrame:
    """``df`` with the columns ``fields`` that ``results`` makes of slices of its texts."""
    others, schema = _with(df, fields)
    shared = _shared(df, made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or "" for x in batch.column(text).to_pylist()]
            for a, b in _slices(texts):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in others), *results(texts[a:b], shared.value)], schema.names)

    return in_small_batches(df).mapInArrow(run, schema)


def decode(df: DataFrame, made: str, ids: str = "ids") -> DataFrame:
    """``df`` with decoded: the bytes of the ids."""
    others, schema = _with(df, [StructField("decoded", BinaryType())])
    shared = _shared(df, made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                got = [decode_ids(x, shared.value) if x else b"" for x in part.column(ids).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in others), pa.array(got, pa.binary())], [*others, "decoded"]
                )

    return in_small_batches(df).mapInArrow(run, schema)
