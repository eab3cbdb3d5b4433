"""SimHash near-duplicates: pigeonhole blocks, Hamming check, components.

Fingerprints at most ``bits`` apart agree on at least ``BLOCKS - bits`` of
``BLOCKS`` blocks, so each choice of that many blocks is a join key and every
close pair meets under one of them.  Equal fingerprints are collapsed before,
and a bucket yields a spanning forest of its links instead of all pairs.
Buckets of over ``LARGE`` fingerprints are dealt again by the same rule on the
bits their key leaves free; after three rounds a bucket cannot be large, so
the search is exact whatever the skew.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyrisk.llm.common import keyed_text
from skyrisk.session import scratch_path

BLOCKS, LARGE = 6, 4096


def fingerprint(text: str, shingle: int = 3) -> int:
    """64-bit SimHash of one text; no word: 0."""
    words = text.encode().lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not words:
        return 0
    joined, k = b" ".join(words), min(shingle, len(words))
    at = [0]
    for w in words:
        at.append(at[-1] + len(w) + 1)
    h = np.array([xxhash.xxh64_intdigest(joined[at[i]:at[i + k] - 1], 42) for i in range(len(words) - k + 1)], ">u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 4096):
        ones += np.unpackbits(h[i:i + 4096].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): one row per document row; null and blank texts have fingerprint 0."""
    return _fingerprinted(keyed_text(docs), shingle)


def _fingerprinted(keyed: DataFrame, shingle: int) -> DataFrame:
    """The rows of ``keyed`` with ``fp`` in place of ``text``."""
    names = [c for c in keyed.columns if c != "text"]

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(fp.view(np.int64))], names=[*names, "fp"])
    return keyed.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in keyed.dtypes if c != "text") + ", fp long")


def masks(free: int, bits: int = 3) -> list[int]:
    """Key masks over the bits set in ``free``: all but ``bits`` of BLOCKS blocks each."""
    at = [i for i in range(64) if free >> i & 1]
    blocks = [sum(1 << int(i) for i in part) for part in np.array_split(at, BLOCKS + max(0, bits - 3))]
    return [sum(c) for c in combinations(blocks, len(blocks) - bits)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def spanning(fps: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """(member, smallest of its group) of distinct fingerprints linked at ``bits`` or fewer.

    Each fingerprint reached is compared with those not yet reached only.
    """
    left, out = np.sort(fps), []
    while len(left):
        root, todo, left = left[0], [left[0]], left[1:]
        while todo and len(left):
            near = np.bitwise_count((left ^ todo.pop()).view(np.uint64)) <= bits
            if near.any():
                found = left[near]
                left = left[~near]
                todo.extend(found)
                out.extend((int(x), int(root)) for x in found)
    return out


def _linked(bits: int):
    """Runs over rows sorted by (mask, key); a bucket never spans partitions."""
    def run(batches):
        held, kept = [], None
        out = []

        def close():
            out.extend(spanning(np.concatenate(held), bits))
        for b in batches:
            if not b.num_rows:
                continue
            mask, key, fp = (np.asarray(b.column(c)) for c in ("mask", "key", "fp"))
            cut = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
            for lo, hi in zip(np.append(0, cut), np.append(cut, len(fp))):
                now = (mask[lo], key[lo])
                if held and now != kept:
                    close()
                    held = []
                kept = now
                held.append(fp[lo:hi])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*out)], names=["u", "v"])
                out.clear()
        if held:
            close()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*out)], names=["u", "v"])
    return run


def _keyed(df: DataFrame, pairs: list[tuple[int, int]]) -> DataFrame:
    """Rows (outer, fp) under each finer mask of their outer mask (a fixed table
    of at most a few hundred or, in the third round, a few thousand masks)."""
    spark = df.sparkSession
    if len({a for a, _ in pairs}) == 1:
        each = F.explode(F.array(*[F.lit(signed(b)) for _, b in pairs])).alias("mask")
        return df.select("fp", each).select("mask", F.expr("fp & mask").alias("key"), "fp")
    finer = spark.createDataFrame([(signed(a), signed(b)) for a, b in pairs], "outer long, mask long")
    return df.join(F.broadcast(finer), "outer").select("mask", F.expr("fp & mask").alias("key"), "fp")


def links(fps: DataFrame, bits: int = 3) -> DataFrame:
    """Spanning links (u, v), v < u, of distinct fingerprints column ``fp``."""
    spark = fps.sparkSession
    full = (1 << 64) - 1
    rows, outer = fps.select(F.lit(0).cast("long").alias("outer"), "fp"), [0]
    found = None
    for level in range(3):
        pairs = [(m, m | x) for m in outer for x in masks(full & ~m, bits)]
        at = scratch_path(spark, f"simhash-keys-{level}")
        _keyed(rows, pairs).write.parquet(at)
        keyed = spark.read.schema("mask long, key long, fp long").parquet(at)
        large = keyed.groupBy("mask", "key").count().where(F.col("count") > LARGE).select("mask", "key")
        if level < 2 and not large.isEmpty():
            small = keyed.join(large, ["mask", "key"], "left_anti")
            rows = keyed.join(large, ["mask", "key"], "left_semi").select(F.col("mask").alias("outer"), "fp")
            outer = sorted({b for _, b in pairs})
        else:
            small, rows = keyed, None
        part = small.repartition("mask", "key").sortWithinPartitions("mask", "key") \
            .mapInArrow(_linked(bits), "u long, v long")
        found = part if found is None else found.unionByName(part)
        if rows is None:
            return found
    return found


def components(edges: DataFrame) -> DataFrame:
    """(u, root) of all linked nodes, root the smallest of its component.

    Alternating large-star and small-star rounds; each is written to the shared
    folder, so a lost executor costs no more than its part of one round.
    """
    spark = edges.sparkSession

    def keep(df, name):
        at = scratch_path(spark, name)
        df.write.parquet(at)
        return spark.read.schema("u long, v long").parquet(at)

    def digest(df):
        r = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        return r["n"], r["s"]

    now = keep(edges.distinct(), "links")
    before = digest(now)
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = keep(large.where("u <> v").distinct(), "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v") \
            .union(low.select("u", F.col("m").alias("v"))).distinct()
        now = keep(small, "small-star")
        after = digest(now)
        if after == before:
            return now.select("u", F.col("v").alias("root"))
        before = after


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) of every document row.

    component_id is the smallest doc_id reachable over links of at most
    ``bits`` differing bits, the document itself included.  Rows repeated under
    one id all stay.  Rows without id get the component of their fingerprint
    (null if no row of it has an id).
    """
    spark = docs.sparkSession
    at = scratch_path(spark, "fingerprints")
    fingerprints(docs, shingle).write.parquet(at)
    fps = spark.read.schema("doc_id long, fp long").parquet(at)
    distinct = scratch_path(spark, "distinct")
    fps.groupBy("fp").agg(F.min("doc_id").alias("low")).write.parquet(distinct)
    reps = spark.read.schema("fp long, low long").parquet(distinct)
    root = components(links(reps, bits))
    linked = reps.join(root.select(F.col("u").alias("fp"), "root"), "fp", "left") \
        .select("fp", "low", F.coalesce("root", "fp").alias("root"))
    whole = linked.groupBy("root").agg(F.min("low").alias("component_id"))
    ids = linked.join(whole, "root").select("fp", "component_id")
    return fps.join(ids, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, bits: int = 3) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: one row of each component stays, that
    of the smallest id (rows without id last), then of the smallest text hash.

    A row is known by its id and text, so one id may stand on several texts.  Rows
    without id and words are like each other only, not like blank ones that have an id.
    """
    spark, names = docs.sparkSession, docs.columns
    at = scratch_path(spark, "fingerprints")
    keyed = keyed_text(docs).withColumn("hash", F.md5("text"))
    _fingerprinted(keyed, shingle).write.parquet(at)
    schema = "doc_id long, hash string, fp long"
    fps = spark.read.schema(schema).parquet(at).withColumn("bare", F.expr("doc_id is null and fp = 0"))
    distinct = scratch_path(spark, "distinct")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "hash")
    fps.groupBy("fp", "bare").agg(F.min(order).alias("low")).write.parquet(distinct)
    reps = spark.read.schema("fp long, bare boolean, low struct<last:boolean,doc_id:long,hash:string>").parquet(distinct)
    root = components(links(reps.where("not bare"), bits))
    linked = reps.join(root.select(F.col("u").alias("fp"), "root"), "fp", "left") \
        .select("fp", "bare", "low", F.coalesce("root", "fp").alias("root"))
    stays = linked.groupBy("root", "bare").agg(F.min("low").alias("stays"))
    stays = linked.join(stays, ["root", "bare"]).select("fp", "bare", "stays")
    gone = fps.join(stays, ["fp", "bare"]).where("not (doc_id <=> stays.doc_id and hash = stays.hash)") \
        .select(F.col("doc_id").alias("gone_id"), F.col("hash").alias("gone_hash")).distinct()
    again = not fps.groupBy("doc_id", "hash").count().where("count > 1").isEmpty()
    flat = docs.toDF(*[f"_{i}" for i in range(len(names))])
    key, text = f"_{names.index('doc_id')}", f"_{names.index('text')}"
    flat = flat.withColumns({"row_id": F.col(key).cast("long"), "row_hash": F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))})
    kept = flat.join(gone, flat["row_id"].eqNullSafe(gone["gone_id"]) & (flat["row_hash"] == gone["gone_hash"]), "left_anti")
    if again:
        kept = kept.dropDuplicates(["row_id", "row_hash"])
    return kept.drop("row_id", "row_hash").toDF(*names)


def marked(docs: DataFrame, shingle: int = 3, bits: int = 3) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id)."""
    d = near_duplicates(docs, shingle, bits)
    return d.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
