"""Token-id files: canonical length-limited Huffman codes, independent blocks.

Layout under ``path``: ``codebook`` (id, bits: the whole canonical code) and
``blocks/shard=<k>`` (one row per block of at most ``BLOCK`` ids).  Shards and
the blocks in them ascend by document id.  A block holds its bits, the bit
offset of every ``STEP``-th id, and which documents its ids belong to, so any
block decodes alone.  Both are Parquet, so Spark's commit protocol
decides which attempt's files count.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyrisk.llm.common import keyed_text, slices, starts
from skyrisk.llm.tokens import encoder

BLOCK, STEP, LIMIT = 1 << 16, 64, 16
IDS = "shard int, doc_id long, at long, n long, ids binary, counts binary"
BLOCKS = ("shard int, start long, n_ids int, bits long, checkpoints binary, payload binary, "
          "doc_id array<long>, doc_start array<long>, doc_ids array<long>, doc_from array<long>, doc_count array<int>")
PIECES = "doc_id long, start long, n_tokens long, from long, count int, crc long"


# ------------------------------------------------------------------- code
def code_lengths(counts: np.ndarray, limit: int | None = None) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); 0: unused id.  By
    default ``LIMIT``, or as many bits as that many different ids need."""
    used = np.flatnonzero(counts)
    limit = limit or max(LIMIT, (len(used) - 1).bit_length())
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids do not fit into {limit} bits")
    out = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        out[used] = 1
        return out
    used = used[np.argsort(counts[used], kind="stable")]
    w, prev, levels = counts[used].astype(np.int64), np.zeros(0, np.int64), []
    for _ in range(limit):
        both = np.concatenate([w, prev[:len(prev) // 2 * 2].reshape(-1, 2).sum(axis=1)])
        order = np.argsort(both, kind="stable")
        levels.append(order < len(w))
        prev = both[order]
    length, take = np.zeros(len(w), np.uint8), 2 * len(w) - 2
    for leaf in reversed(levels):
        k = int(np.count_nonzero(leaf[:take]))
        length[:k] += 1
        take = 2 * (take - k)
    out[used] = length
    return out


def _width(lengths: np.ndarray) -> int:
    return max(LIMIT, int(lengths.max(initial=0)))


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in the order of (length, id)."""
    width = _width(lengths)
    codes = np.zeros(len(lengths), np.uint32)
    used = np.flatnonzero(lengths)
    used = used[np.argsort(lengths[used], kind="stable")]
    if len(used):
        step = (1 << (width - lengths[used].astype(np.int64)))
        codes[used] = (starts(step)[:-1] >> (width - lengths[used].astype(np.int64))).astype(np.uint32)
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each prefix as long as the longest code (``LIMIT`` bits at least) the id and its length."""
    width = _width(lengths)
    used = np.flatnonzero(lengths)
    used = used[np.argsort(lengths[used], kind="stable")]
    span = 1 << (width - lengths[used].astype(np.int64))
    ids, bits = np.zeros(1 << width, np.uint32), np.ones(1 << width, np.uint8)
    ids[:span.sum()] = np.repeat(used, span)
    bits[:span.sum()] = np.repeat(lengths[used], span)
    return ids, bits


def encode_block(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, int, np.ndarray]:
    """(bits as big-endian words, number of bits, bit offset of every STEP-th id)."""
    at = starts(lengths[ids])
    total, at = int(at[-1]), at[:-1]
    word, used = at >> 5, (at & 31) + lengths[ids]
    value = codes[ids].astype(np.uint64) << (64 - used).astype(np.uint64)
    n = (total + 31) // 32 + 2
    out = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), n)
    out += np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), n)
    return out.astype(">u4").tobytes(), total, at[::STEP].astype("<u4")


def decode_block(payload: bytes, n: int, checkpoints: np.ndarray, ids: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """All runs between checkpoints advance together, one id a step."""
    words = np.frombuffer(payload, ">u4").astype(np.uint64)
    pairs = (words[:-1] << np.uint64(32)) | words[1:]
    lanes, width = len(checkpoints), len(ids).bit_length() - 1
    out, pos = np.zeros((STEP, lanes), np.uint32), checkpoints.astype(np.int64)
    last = n - (lanes - 1) * STEP
    for k in range(STEP):
        live = lanes if k < last else lanes - 1
        if not live:
            break
        p = pos[:live]
        look = (pairs[p >> 5] >> (64 - width - (p & 31)).astype(np.uint64)) & np.uint64((1 << width) - 1)
        out[k, :live] = ids[look]
        p += bits[look]
    return out.T.reshape(-1)[:n]


# ----------------------------------------------------------------- writing
def _tokenise(path: str, end_id: int):
    def run(batches):
        shard, at = TaskContext.get().partitionId(), 0
        tok = encoder(path)
        counts = np.zeros(tok.tok.get_vocab_size(with_added_tokens=True) + 1, np.int64)
        schema = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n", pa.int64()),
                            ("ids", pa.binary()), ("counts", pa.binary())])
        for b in slices(batches, size=4 << 20):
            ids, per = tok.encode(b.column("text"))
            counts += np.bincount(ids, minlength=len(counts))
            counts[end_id] += len(per)
            cut, rows, begins = starts(per), [], []
            for i in range(len(per)):
                rows.append(np.append(ids[cut[i]:cut[i + 1]], np.uint32(end_id)).astype("<u2" if len(counts) <= 1 << 16 else "<u4").tobytes())
                begins.append(at)
                at += int(per[i]) + 1
            m = len(rows)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m, shard, np.int32)), b.column("doc_id"), pa.array(begins, pa.int64()),
                                              pa.array(per + 1), pa.array(rows, pa.binary()), pa.nulls(m, pa.binary())], schema=schema)
        if at:
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.nulls(1, pa.int64()), pa.array([at]), pa.array([0]),
                                              pa.nulls(1, pa.binary()), pa.array([counts.tobytes()], pa.binary())], schema=schema)
    return run


def _counted(batches):
    for b in batches:
        for raw in b.column("counts").to_pylist():
            c = np.frombuffer(raw, np.int64)
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(c[at])], names=["id", "n"])


def _to_blocks(lengths: np.ndarray, first: dict[int, int], wide: bool):
    codes = canonical(lengths)

    def block(shard, docs):
        ids = np.concatenate([d[3] for d in docs])
        payload, bits, marks = encode_block(ids, codes, lengths)
        return {"shard": shard, "start": docs[0][1] + docs[0][4], "n_ids": len(ids), "bits": bits, "checkpoints": marks.tobytes(),
                "payload": payload, "doc_id": [d[0] for d in docs], "doc_start": [d[1] for d in docs], "doc_ids": [d[2] for d in docs],
                "doc_from": [d[4] for d in docs], "doc_count": [len(d[3]) for d in docs]}

    def run(batches):
        held, size, shard, ready = [], 0, None, []
        for b in batches:
            for s, doc, at, n, raw in zip(*(b.column(c).to_pylist() for c in ("shard", "doc_id", "at", "n", "ids"))):
                ids = np.frombuffer(raw, "<u4" if wide else "<u2").astype(np.int64)
                for cut in range(0, len(ids), BLOCK):
                    part = ids[cut:cut + BLOCK]
                    if held and (s != shard or size + len(part) > BLOCK):
                        ready.append(block(shard, held))
                        held, size = [], 0
                    shard = s
                    held.append((doc, first[s] + at, n, part, cut))
                    size += len(part)
            if ready:
                yield pa.RecordBatch.from_pylist(ready, schema=_BLOCKS)
                ready = []
        if held:
            yield pa.RecordBatch.from_pylist([block(shard, held)], schema=_BLOCKS)
    return run


_BLOCKS = pa.schema([("shard", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int32()), ("bits", pa.int64()), ("checkpoints", pa.binary()),
                     ("payload", pa.binary()), ("doc_id", pa.list_(pa.int64())), ("doc_start", pa.list_(pa.int64())),
                     ("doc_ids", pa.list_(pa.int64())), ("doc_from", pa.list_(pa.int64())), ("doc_count", pa.list_(pa.int32()))])


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Encodes whole texts, ends each with ``end_id`` and writes them under ``path``.

    Null text: only the end id.  Rows ascend by id (null first), equal ids by
    text hash.  An empty table gives an empty code and no block.  Tokenised
    rows are written once (``path/ids``): the counts of all ids must be known
    before the first code is.  On the driver: one count per id of the
    vocabulary and one total per shard.
    """
    spark = docs.sparkSession
    text = keyed_text(docs)
    text.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text")) \
        .mapInArrow(_tokenise(tokenizer, end_id), IDS).write.option("compression", "zstd").parquet(f"{path}/ids")
    rows = spark.read.schema(IDS).parquet(f"{path}/ids")
    tails = rows.where("counts is not null")
    counts = tails.select("counts").mapInArrow(_counted, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    totals = sorted((r["shard"], r["at"]) for r in tails.select("shard", "at").collect())
    first = dict(zip([s for s, _ in totals], starts(np.array([t for _, t in totals], np.int64)).tolist()))
    table = np.zeros(max([r["id"] for r in counts], default=0) + 1, np.int64)
    for r in counts:
        table[r["id"]] = r["n"]
    lengths = code_lengths(table)
    from tokenizers import Tokenizer
    wide = Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True) + 1 > 1 << 16
    spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths) if n], "id int, bits int").coalesce(1) \
        .write.parquet(f"{path}/codebook")
    rows.where("counts is null").drop("counts").mapInArrow(_to_blocks(lengths, first, wide), BLOCKS) \
        .sortWithinPartitions("shard", "start").write.partitionBy("shard").option("compression", "uncompressed").parquet(f"{path}/blocks")


# ----------------------------------------------------------------- reading
def _decoded(lengths: np.ndarray, visit):
    def run(batches):
        ids, bits = decode_table(lengths)
        for b in batches:
            for i in range(b.num_rows):
                r = {c: b.column(c)[i] for c in b.schema.names}
                got = decode_block(r["payload"].as_buffer(), r["n_ids"].as_py(), np.frombuffer(r["checkpoints"].as_buffer(), "<u4"), ids, bits)
                per = [np.asarray(r[c].values) for c in ("doc_id", "doc_start", "doc_ids", "doc_from", "doc_count")]
                yield visit(got, r["doc_id"].values, *per[1:])
    return run


def _crc_pieces(got, doc_id, start, n, begin, count):
    cut = starts(count)
    raw = got.astype("<u4").tobytes()
    crc = [zlib.crc32(raw[4 * cut[i]:4 * cut[i + 1]]) for i in range(len(count))]
    return pa.RecordBatch.from_arrays([doc_id, pa.array(start), pa.array(n), pa.array(begin), pa.array(count), pa.array(crc, pa.int64())],
                                      names=["doc_id", "start", "n_tokens", "from", "count", "crc"])


def _id_pieces(got, doc_id, start, n, begin, count):
    cut = starts(count)
    return pa.RecordBatch.from_arrays([doc_id, pa.array(start), pa.array(n), pa.array(begin),
                                       pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(got.astype(np.int64)))],
                                      names=["doc_id", "start", "n_tokens", "from", "ids"])


def codebook(spark: SparkSession, path: str) -> np.ndarray:
    """Code lengths by id, from the files (as many rows as the vocabulary at most)."""
    rows = spark.read.schema("id int, bits int").parquet(f"{path}/codebook").collect()
    out = np.zeros(max([r["id"] for r in rows], default=0) + 1, np.uint8)
    for r in rows:
        out[r["id"]] = r["bits"]
    return out


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(f"{path}/blocks").drop("shard", "start", "bits")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Pieces (doc_id, start, n_tokens, from, ids) of all documents; one per document
    unless it is longer than a block."""
    return _blocks(spark, path).mapInArrow(_decoded(codebook(spark, path), _id_pieces),
                                           "doc_id long, start long, n_tokens long, from long, ids array<long>")


def crc_join(a: int, b: int, b_bytes: int) -> int:
    """crc32 of two byte runs from their own crc32 values."""
    def times(m, v):
        out, k = 0, 0
        while v:
            if v & 1:
                out ^= m[k]
            v >>= 1
            k += 1
        return out
    bit = [0xEDB88320] + [1 << k for k in range(31)]  # one zero bit; the polynomial is a fixed value
    for _ in range(3):
        bit = [times(bit, x) for x in bit]  # eight of them
    while b_bytes:
        if b_bytes & 1:
            a = times(bit, a)
        bit = [times(bit, x) for x in bit]
        b_bytes >>= 1
    return a ^ b


def _joined(batches):
    for b in batches:
        out = []
        for pieces in b.column("pieces").to_pylist():
            pieces.sort(key=lambda p: p["from"])
            crc = pieces[0]["crc"]
            for p in pieces[1:]:
                crc = crc_join(crc, p["crc"], 4 * p["count"])
            out.append(crc)
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(out, pa.int64())],
                                         names=["doc_id", "start", "n_tokens", "ids_crc32"])


def document_checksums(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files; a document longer than
    a block is put together from 16 bytes per block."""
    return _blocks(spark, path).mapInArrow(_decoded(codebook(spark, path), _crc_pieces), PIECES) \
        .groupBy("doc_id", "start", "n_tokens") \
        .agg(F.collect_list(F.struct("from", "count", "crc")).alias("pieces")) \
        .mapInArrow(_joined, "doc_id long, start long, n_tokens long, ids_crc32 long")
