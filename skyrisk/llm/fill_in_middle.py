"""Fill-in-the-middle documents with a compressed set of cut positions.

The positions where a text may be cut (its start and the end of each token) are kept
as a set of integers in containers of 2^16 values each: a sorted array while few, a
bitmap when dense, a list of runs where that is smaller.  Cumulative cardinalities
over the containers find the one that holds the k-th position, a select inside it the
position itself; both cuts of a document are two such selects.

A document's draws come from the sha256 of ``seed:doc_id``, so they depend on neither
order nor partitioning.  Texts that hold a marker stay plain, which makes every output
reversible.  Null texts count as empty, a null id as the empty string; repeated rows
come out each; very long texts are cut whole; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyrisk.llm.common import keyed_text, slices, starts

BLANKS = np.array([0x20, *range(0x09, 0x0E)], np.uint32)
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FEW = 4096  # an array of more 16-bit values is larger than a bitmap


class ArrayContainer:
    kind = 0

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])

    def rank(self, value: int) -> int:
        return int(np.searchsorted(self.low, value, side="right"))

    def raw(self) -> bytes:
        return self.low.astype("<u2").tobytes()


class BitmapContainer:
    """2^16 bits in 64-bit words; ``before``: how many are set before each word."""
    kind = 1

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = starts(np.bitwise_count(words).astype(np.int64))

    @classmethod
    def of(cls, low: np.ndarray) -> BitmapContainer:
        bits = np.zeros(1 << 16, bool)
        bits[low] = True
        return cls(np.packbits(bits, bitorder="little").view("<u8"))

    def _bits(self, word: int) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(self.words[word:word + 1].view(np.uint8), bitorder="little"))

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, side="right")) - 1
        return 64 * word + int(self._bits(word)[k - self.before[word]])

    def rank(self, value: int) -> int:
        word = value >> 6
        return int(self.before[word]) + int(np.searchsorted(self._bits(word), value & 63, side="right"))

    def raw(self) -> bytes:
        return self.words.astype("<u8").tobytes()


class RunContainer:
    """Runs of consecutive values; ``before``: how many values precede each run."""
    kind = 2

    def __init__(self, first: np.ndarray, length: np.ndarray):
        self.first, self.length = first.astype(np.int64), length.astype(np.int64)
        self.before = starts(self.length)

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.first[run] + k - self.before[run])

    def rank(self, value: int) -> int:
        run = int(np.searchsorted(self.first, value, side="right")) - 1
        return 0 if run < 0 else int(self.before[run] + min(value - self.first[run] + 1, self.length[run]))

    def raw(self) -> bytes:
        return np.stack([self.first, self.length - 1], axis=1).astype("<u2").tobytes()


def container(low: np.ndarray):
    """The smallest of the three for sorted distinct 16-bit values."""
    cut = np.flatnonzero(np.diff(low) != 1) + 1
    first = np.append(0, cut)
    if 4 * len(first) < min(2 * len(low), 1 << 13):
        return RunContainer(low[first], np.diff(np.append(first, len(low))))
    return ArrayContainer(low) if len(low) <= FEW else BitmapContainer.of(low)


class BoundarySet:
    """A set of sorted positions with ``select`` (the k-th) and ``rank`` (how many are not larger)."""

    def __init__(self, highs: list[int], containers: list, sizes: list[int]):
        self.highs, self.containers = np.array(highs, np.int64), containers
        self.before = starts(np.array(sizes, np.int64))

    @classmethod
    def of(cls, values: np.ndarray) -> BoundarySet:
        high = values >> 16
        cut = [0, *(np.flatnonzero(np.diff(high)) + 1).tolist(), len(values)] if len(values) else [0]
        return cls([int(high[i]) for i in cut[:-1]], [container(values[i:j] & 0xFFFF) for i, j in zip(cut, cut[1:])], np.diff(cut).tolist())

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        if not 0 <= k < len(self):
            raise IndexError(k)
        c = int(np.searchsorted(self.before, k, side="right")) - 1
        return (int(self.highs[c]) << 16) + self.containers[c].select(k - int(self.before[c]))

    def rank(self, value: int) -> int:
        c = int(np.searchsorted(self.highs, value >> 16))
        if c < len(self.highs) and self.highs[c] == value >> 16:
            return int(self.before[c]) + self.containers[c].rank(value & 0xFFFF)
        return int(self.before[c])

    def to_bytes(self) -> bytes:
        """Per container: high part, kind, cardinality, bytes; little-endian 32-bit each, then the bytes."""
        out = []
        for h, c, n in zip(self.highs.tolist(), self.containers, np.diff(self.before).tolist()):
            raw = c.raw()
            out += [np.array([h, c.kind, n, len(raw)], "<u4").tobytes(), raw]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, data: bytes) -> BoundarySet:
        highs, found, sizes, at = [], [], [], 0
        while at < len(data):
            h, kind, n, size = np.frombuffer(data, "<u4", 4, at).tolist()
            raw = data[at + 16:at + 16 + size]
            pairs = np.frombuffer(raw, "<u2").astype(np.int64)
            found.append(ArrayContainer(pairs) if kind == 0 else BitmapContainer(np.frombuffer(raw, "<u8")) if kind == 1
                         else RunContainer(pairs[::2], pairs[1::2] + 1))
            highs.append(h)
            sizes.append(n)
            at += 16 + size
        return cls(highs, found, sizes)


def boundaries(points: np.ndarray) -> np.ndarray:
    """0 and the end of every token: words with the blanks before them, then blanks at the end."""
    if not len(points):
        return np.zeros(1, np.int64)
    blank = np.isin(points, BLANKS)
    ends = np.flatnonzero(~blank & np.append(blank[1:], True)) + 1
    tail = [len(points)] if blank[-1] else []
    return np.concatenate([[0], ends, tail]).astype(np.int64)


@dataclass(frozen=True)
class Rates:
    """Seed and, in percent, how many texts are rearranged and how many of those suffix first."""
    seed: int = 42
    rearranged: int = 50
    suffix_first: int = 80


def draws(seed: int, key: int | None) -> tuple[int, ...]:
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return tuple(int(digest[8 * i:8 * i + 8], 16) for i in range(4))


def arrange(text: str, a: int, b: int, form: str) -> str:
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if form == "psm":
        return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}" if form == "spm" else text


def restore(output: str, form: str) -> str:
    """The text again.  No part holds a marker and no marker begins like it ends, so the
    first place of a marker is where it was put."""
    if form == "plain":
        return output
    one, two = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    first, rest = output[len(one):].split(two, 1)
    second, middle = rest.split(MIDDLE, 1)
    return first + middle + second if form == "psm" else second + middle + first


def transformed(docs: DataFrame, rates: Rates = Rates(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output, boundaries) of every row:
    n tokens; form plain, psm or spm; lengths in code points (null if plain); the set's bytes."""
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, boundaries binary"
    names = [c.split()[0] for c in schema.split(", ")]

    def one(doc, text):
        cuts = BoundarySet.of(boundaries(np.frombuffer(text.encode("utf-32-le"), np.uint32)))
        n = len(cuts) - 1
        h1, h2, h3, h4 = draws(rates.seed, doc)
        if not text or h3 % 100 >= rates.rearranged or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
            return doc, n, "plain", None, None, text, cuts.to_bytes()
        a, b = (cuts.select(k) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
        form = "spm" if h4 % 100 < rates.suffix_first else "psm"
        return doc, n, form, a, b - a, arrange(text, a, b, form), cuts.to_bytes()

    def run(batches):
        for s in slices(batches):
            rows = [one(*r) for r in zip(s.column("doc_id").to_pylist(), s.column("text").to_pylist())]
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
    return keyed_text(docs, key, text).mapInArrow(run, schema)


def restored(out: DataFrame) -> DataFrame:
    """``out`` of ``transformed`` with the text rebuilt from output and form alone."""
    put_back = F.when(F.col("form") == "plain", F.col("output"))
    for form, one, two in (("psm", PREFIX, SUFFIX), ("spm", SUFFIX, PREFIX)):
        inner = F.expr(f"substr(output, {len(one) + 1})")
        at = F.locate(two, inner)
        rest = F.substring(inner, at + len(two), F.length(inner))
        mid = F.locate(MIDDLE, rest)
        first, second = F.substring(inner, F.lit(1), at - 1), F.substring(rest, F.lit(1), mid - 1)
        middle = F.substring(rest, mid + len(MIDDLE), F.length(rest))
        put_back = put_back.when(F.col("form") == form, F.concat(*([first, middle, second] if form == "psm" else [second, middle, first])))
    return out.withColumn("restored", put_back)


def digested(docs: DataFrame, rates: Rates = Rates()) -> DataFrame:
    """The transformed rows with digests in place of the texts."""
    sha = [F.sha2(F.encode(c, "UTF-8"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return restored(transformed(docs, rates)).select("doc_id", "n", "form", "prefix_chars", "middle_chars", *sha)
