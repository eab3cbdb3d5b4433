"""Document fingerprints by winnowing.

Hashes of all k-grams of code points, the minimum of every window of ``w``
hashes (the rightmost of equal ones) and its position.  Two texts that share a
run of at least ``k + w - 1`` code points share a chosen hash; nothing shorter
than ``k`` counts as shared.  A text of 1 to ``k`` code points has one hash (of all
of it), one of fewer than ``w`` k-grams one window; an empty text none.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyrisk.llm.common import keyed_text, slices, starts

GRAM, WINDOW = 16, 24
BASE = 0x9E3779B97F4A7C15  # odd multiplier of the rolling hash
CHUNK = 1 << 20
RANGE_BYTES, RANGES = 16 << 20, 20_000
CHOICE = np.dtype([("hash", ">u8"), ("position", ">u4")])  # one choice of a shown fingerprint


def gram_hashes(cp: np.ndarray, k: int = GRAM) -> np.ndarray:
    """64-bit hash of every k-gram: sum of code * BASE^(k-1-j), mixed.

    Hashes of length a and b give those of a + b, so k-grams take log(k) steps.
    """
    one, done, length, size = cp.astype(np.uint64) + np.uint64(1), None, 0, 1
    left = k
    while left:
        if left & 1:
            if done is None:
                done = one
            else:
                n = len(cp) - length - size + 1
                done = done[:n] * np.uint64(pow(BASE, size, 1 << 64)) + one[length:length + n]
            length += size
        left >>= 1
        if left:
            n = len(cp) - 2 * size + 1
            one = one[:n] * np.uint64(pow(BASE, size, 1 << 64)) + one[size:size + n]
            size *= 2
    h = done ^ (done >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def window_minima(h: np.ndarray, w: int = WINDOW) -> np.ndarray:
    """Position of the rightmost minimum of every window of ``w`` (one window if fewer)."""
    w = min(w, len(h))
    low, size = np.arange(len(h)), 1
    value = h
    while size < w:
        step = min(size, w - size)  # windows may overlap: the minimum does not mind
        n = len(value) - step
        right = value[step:step + n] <= value[:n]
        low = np.where(right, low[step:step + n], low[:n])
        value = np.where(right, value[step:step + n], value[:n])
        size += step
    return low


def winnow(cp: np.ndarray, k: int = GRAM, w: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(chosen hashes, their positions) of one text, in order of position.

    Texts are walked in overlapping chunks, so memory does not grow with them."""
    if not len(cp):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k = min(k, len(cp))
    grams = len(cp) - k + 1
    if grams <= CHUNK:
        h = gram_hashes(cp, k)
        at = window_minima(h, w)
        at = at[np.append(True, at[1:] != at[:-1])]
        return h[at], at
    hs, ats = [], []
    for lo in range(0, grams - w + 1, CHUNK):  # windows that begin in [lo, lo + CHUNK)
        h = gram_hashes(cp[lo:lo + CHUNK + w - 1 + k - 1], k)
        at = window_minima(h, w)
        at = at[np.append(True, at[1:] != at[:-1])]
        if ats and len(at) and ats[-1][-1] == at[0] + lo:
            at = at[1:]
        hs.append(h[at])
        ats.append(at + lo)
    return np.concatenate(hs), np.concatenate(ats)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of two sets of chosen hashes (sorted, distinct); two empty ones: 1."""
    if not len(a) and not len(b):
        return 1.0
    both = len(a) + len(b) - len(np.union1d(a, b))
    return both / (len(a) + len(b) - both)


def shown(h: np.ndarray, at: np.ndarray) -> str:
    """A fingerprint as text: hash and position of every choice in hexadecimal."""
    out = np.empty(len(h), CHOICE)
    out["hash"], out["position"] = h, at
    return out.tobytes().hex()


def read_shown(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of a fingerprint's text."""
    got = np.frombuffer(bytes.fromhex(fingerprint), CHOICE)
    return got["hash"].astype(np.uint64), got["position"].astype(np.int64)


def shown_likeness(a: str, b: str) -> float:
    return likeness(*(np.unique(read_shown(x)[0]) for x in (a, b)))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def document_fingerprints(docs: DataFrame, k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """(doc_id, hashes, positions) of every row's whole text; null texts count as empty."""
    def run(batches):
        for s in slices(batches):
            got = [winnow(code_points(t), k, w) for t in s.column("text").to_pylist()]
            cut = pa.array(starts(np.array([len(p) for _, p in got], np.int64)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [s.column("doc_id"), *(pa.ListArray.from_arrays(cut, pa.array(np.concatenate([g[i] for g in got]).astype(np.int64))) for i in (0, 1))],
                names=["doc_id", "hashes", "positions"])
    return keyed_text(docs).mapInArrow(run, "doc_id long, hashes array<long>, positions array<long>")


def neighbour_ranges(docs: DataFrame) -> DataFrame:
    """(bucket, doc_id, text, halo): texts in ranges of descending id, each range
    closed by the first row of the next one (the last by the very first).

    Range borders are quantiles of the ids, one range for ``RANGE_BYTES`` of text (a few
    for each core at least, ``RANGES`` at most: a range is streamed, so its size bounds no
    memory); only they reach the driver.  The table of each range's first
    row (an id and a hash) has as many rows, so it is broadcast.  Rows of one id
    follow each other by text hash, ids that are null come last.
    """
    spark = docs.sparkSession
    d = keyed_text(docs).withColumn("h", F.xxhash64("text")).withColumn("place", F.col("doc_id").cast("double"))
    size = d.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    n = min(RANGES, max(2 * spark.sparkContext.defaultParallelism, size // RANGE_BYTES))
    q = sorted(set(d.approxQuantile("place", [i / n for i in range(1, n)], 1 / (4 * n))))
    if len(q) > 0:
        d = Bucketizer(splits=[float("-inf"), *q, float("inf")], inputCol="place", outputCol="above", handleInvalid="keep").transform(d)
        d = d.withColumn("bucket", F.when(F.col("doc_id").isNull(), len(q)).otherwise(len(q) - F.col("above")).cast("int"))
    else:
        d = d.withColumn("bucket", F.lit(0))
    # the first row of a range: the largest id, and of equal ids the smallest hash
    first = F.max(F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("i"), F.bitwise_not("h").alias("g")))
    heads = d.groupBy("bucket").agg(first.alias("m"))
    every, order = Window.partitionBy(F.lit(0)), Window.partitionBy(F.lit(0)).orderBy("bucket")
    heads = heads.select("bucket", F.col("m.i").alias("first_id"), F.bitwise_not("m.g").alias("first_h"),
                         F.coalesce(F.lag("bucket").over(order), F.max("bucket").over(every)).alias("before"))
    d = d.join(F.broadcast(heads), "bucket")
    is_head = (F.coalesce("doc_id", F.lit(-(1 << 63))) == F.col("first_id")) & (F.col("h") == F.col("first_h"))
    own = F.struct(F.col("bucket").alias("b"), F.lit(False).alias("halo"))
    both = d.select("doc_id", "h", "text", F.explode(F.when(is_head, F.array(own, F.struct(F.col("before").alias("b"), F.lit(True).alias("halo"))))
                                                     .otherwise(F.array(own))).alias("s"))
    return both.select(F.col("s.b").alias("bucket"), "doc_id", "h", "text", F.col("s.halo").alias("halo")) \
        .repartitionById(len(q) + 1, F.col("bucket")) \
        .sortWithinPartitions("bucket", "halo", F.col("doc_id").desc_nulls_last(), "h") \
        .select("bucket", "doc_id", "text", "halo")


def edited(text: str, nxt: str) -> str:
    """``text`` with its last third replaced by as many first code points of ``nxt``."""
    k = len(text) // 3
    return text[:len(text) - k] + nxt[:k]


def compared(docs: DataFrame, k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """Each row's fingerprint against its edited text's and the next document's.

    ``fingerprint`` strings list the chosen hashes in order of position: 16 hex digits of
    the hash and 8 of its position each.  ``near_*`` are the likeness of the sets of those
    hashes (``shown_likeness`` gives it from the strings).  The next of the only row is itself.
    """
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    names = [c.split()[0] for c in schema.split(", ")]

    def one(text):
        h, at = winnow(code_points(text), k, w)
        return shown(h, at), np.unique(h)

    def run(batches):
        held = None
        for s in slices(batches):
            out = []
            for bucket, doc, text, halo in zip(*(s.column(c).to_pylist() for c in ("bucket", "doc_id", "text", "halo"))):
                name, own = one(text)
                if held is not None and held[0] == bucket:
                    _, prev, t, f, a = held
                    e = edited(t, text)
                    fe, b = one(e)
                    out.append((prev, len(t), hashlib.sha256(e.encode()).hexdigest(), f, fe, likeness(a, b), likeness(a, own)))
                held = None if halo else (bucket, doc, text, name, own)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), _OUT)], names=names)
    return neighbour_ranges(docs).mapInArrow(run, schema)


_OUT = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
