"""Hard negatives by anchor-clustered shared lists (after MAXIMUS).

Anchors are clustered by direction.  For a cluster with centre c whose members lie
within the angle t of it, no row x has a larger inner product with a member a than
|a| |x| cos(max(0, angle(x, c) - t)).  Rows are sorted by |x| cos(...) once for the
cluster, and every member walks that one list until the bound of the next row cannot
reach its worst answer any more: the answers are exact, not approximate.

Rows are dealt by a hash into blocks; every anchor visits every block, streamed by
cluster, so a task holds one block and a batch of anchors, however large a cluster
is.  Two walks are made: one for the positives (same label), one for the negatives
(other labels) within each positive's score band.

Rows: one for each ``vec_id``; of repeated ids the row with the smallest label, then
vector, counts.  Rows without id, label or vector, or with a null or non-finite
component take no part.  Shorter vectors count as padded with zeros.  Ties of the
score go to the smaller id.  A vector whose scaled components make scores beyond a
64-bit integer possible is an error.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyrisk.llm.common import key_hash, pick, thin
from skyrisk.session import scratch_path

SAMPLE = 4096         # anchors that the clusters are fitted on, at most
MEMBERS = 32          # anchors a cluster on average, as long as there are fewer than
CLUSTERS = 64         # so many clusters
ROUNDS = 8
BLOCK_CELLS = 1 << 24  # components of a block, at most
NONE = np.iinfo(np.int64).min
ANCHOR = "block int, kind int, cluster int, vec_id long, label int, v binary, scores array<long>"


def scaled(df: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """(vec_id, label, v, dim, norm2): floor(scale * x) of each component as little-endian int32."""
    def run(batches):
        for b in batches:
            lists = b.column("vector")
            size = np.asarray(pc.fill_null(pc.list_value_length(lists), -1), dtype=np.int64)
            flat = pc.fill_null(lists.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
            ends = np.cumsum(np.maximum(size, 0))
            bad = np.append(0, np.cumsum(~np.isfinite(flat)))
            ok = (size >= 0) & (bad[ends] == bad[ends - np.maximum(size, 0)])
            flat = np.floor(np.where(np.isfinite(flat), flat, 0.0) * scale)
            wide = np.append(0, np.cumsum(np.abs(flat) >= 2**31))
            if (ok & (wide[ends] != wide[ends - np.maximum(size, 0)])).any():
                raise ValueError("a scaled component does not fit 32 bits")
            square = np.append(0.0, np.cumsum(flat * flat))
            raw = flat.astype("<i4").tobytes()
            at = np.flatnonzero(ok)
            lo, hi = (ends - np.maximum(size, 0))[at], ends[at]
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").take(pa.array(at)), b.column("label").take(pa.array(at)),
                 pa.array([raw[4 * i:4 * j] for i, j in zip(lo.tolist(), hi.tolist())], pa.binary()),
                 pa.array(hi - lo, pa.int32()), pa.array(square[hi] - square[lo], pa.float64())],
                names=["vec_id", "label", "v", "dim", "norm2"])
    rows = pick(df, vec_id=key, label=label, vector=vector).where("vec_id is not null and label is not null and vector is not null") \
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), F.col("vector").cast("array<double>").alias("vector"))
    one = rows.mapInArrow(run, "vec_id long, label int, v binary, dim int, norm2 double") \
        .groupBy("vec_id").agg(F.min(F.struct("label", "v", "dim", "norm2")).alias("r"))
    return one.select("vec_id", "r.*")


def matrix(column: pa.Array, dim: int, dtype: str) -> np.ndarray:
    """Rows of little-endian int32 bytes, padded with zeros to ``dim`` columns."""
    out = np.zeros((len(column), dim), dtype)
    size = np.asarray(pc.binary_length(column), dtype=np.int64) // 4
    flat = np.frombuffer(b"".join(column.to_pylist()), "<i4")
    if len(size) and (size == dim).all():
        out[:] = flat.reshape(len(size), dim)
    else:
        at = np.append(0, np.cumsum(size))
        for i, n in enumerate(size.tolist()):
            out[i, :n] = flat[at[i]:at[i] + n]
    return out


def norms(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64, copy=False)
    return np.sqrt(np.einsum("ij,ij->i", x, x))


def angles(x: np.ndarray, length: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Angle of each row to a centre of length 1; rows of length 0 have angle 0."""
    dot = np.empty(len(x))
    for lo in range(0, len(x), 1 << 14):  # in doubles, a stretch at a time
        dot[lo:lo + (1 << 14)] = x[lo:lo + (1 << 14)].astype(np.float64) @ centre
    return np.arccos(np.clip(np.divide(dot, length, out=np.ones(len(x)), where=length > 0), -1.0, 1.0))


def centres(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means: k directions, from the first k rows that differ in direction."""
    x = x.astype(np.float64)
    n = norms(x)
    unit = np.unique(x[n > 0] / n[n > 0, None], axis=0) if (n > 0).any() else np.zeros((0, x.shape[1]))
    if not len(unit):
        return np.eye(1, x.shape[1])
    mid = unit[:: max(1, len(unit) // k)][:k]
    for _ in range(ROUNDS):
        own = np.argmax(unit @ mid.T, axis=1)
        total = np.zeros_like(mid)
        np.add.at(total, own, unit)
        n = norms(total)
        mid = np.where(n[:, None] > 1e-9, total / np.maximum(n, 1e-9)[:, None], mid)
    return mid


class Best:
    """The ``k`` best (score, id) of each member: larger scores, then smaller ids."""

    def __init__(self, members: int, k: int):
        self.k = k
        self.score = np.full((members, k), NONE, np.int64)
        self.key = np.full((members, k), np.iinfo(np.int64).max, np.int64)

    def worst(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, rows: np.ndarray, score: np.ndarray, keys: np.ndarray) -> None:
        """``score``: one row for each of ``rows``, NONE where a candidate does not count."""
        least = self.score[rows, -1]
        if score.shape[1] > self.k:
            least = np.maximum(least, np.partition(score, -self.k, axis=1)[:, -self.k])
        r, c = np.nonzero((score >= least[:, None]) & (score != NONE))
        who = np.unique(r)
        if not len(who):
            return
        owner = np.concatenate([np.repeat(who, self.k), r])
        value = np.concatenate([self.score[rows[who]].ravel(), score[r, c]])
        key = np.concatenate([self.key[rows[who]].ravel(), keys[c]])
        order = np.lexsort((key, ~value, owner))  # ~value: descending without overflow
        owner, value, key = owner[order], value[order], key[order]
        first = np.searchsorted(owner, who)
        take = first[:, None] + np.arange(self.k)
        self.score[rows[who]], self.key[rows[who]] = value[take], key[take]


class Block:
    """Rows of one block and, for the cluster last asked for, their shared list."""

    def __init__(self, keys: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.keys, self.labels, self.x, self.length = keys, labels, x, norms(x)
        self.cluster, self.order, self.bound = None, None, None

    def shared_list(self, cluster: int, centre: np.ndarray, spread: float) -> None:
        """Sorts the block by the bound for all members within ``spread`` of the centre."""
        if cluster == self.cluster:
            return
        away = np.maximum(0.0, angles(self.x, self.length, centre) - spread - 1e-7)  # 1e-7: rounding of arccos
        bound = self.length * np.cos(away)
        self.order = np.argsort(-bound, kind="stable")
        self.bound, self.cluster = bound[self.order], cluster

    def walk(self, a: np.ndarray, visit, needed) -> None:
        """Members ``a`` walk the list in growing steps.  ``visit(rows, scores, at)`` takes the
        exact scores of list rows ``at``; ``needed()`` is the score from which on a row still
        matters to each member: once the bound is below it, the member is done."""
        reach, at, step = norms(a) * (1 + 1e-9), 0, 256
        while at < len(self.order):
            rows = np.flatnonzero(self.bound[at] * reach + 1e-3 >= needed())
            if not len(rows):
                return
            take = self.order[at:at + step]
            visit(rows, (a[rows] @ self.x[take].T).astype(np.int64), take)
            at += step
            step = min(2 * step, 4096)


def _positives(block: Block, a: np.ndarray, keys: np.ndarray, labels: np.ndarray, scores, k: int, low, n: int) -> Iterator[tuple]:
    best = Best(len(a), k)

    def visit(rows, s, at):
        s[(block.labels[at] != labels[rows, None]) | (block.keys[at] == keys[rows, None])] = NONE
        best.add(rows, s, block.keys[at])
    block.walk(a, visit, best.worst)
    m, j = np.nonzero(best.score != NONE)
    yield keys[m], np.zeros(len(m), np.int32), best.key[m, j], best.score[m, j]


def _negatives(block: Block, a: np.ndarray, keys: np.ndarray, labels: np.ndarray, scores, k: int, low: tuple[int, int], n: int) -> Iterator[tuple]:
    """Bands [ceil(low * p), p] for each positive's score p, as many as the anchor has positives."""
    top, least = np.full((len(a), k), NONE), np.full((len(a), k), np.iinfo(np.int64).max)
    for i, own in enumerate(scores):
        for j, p in enumerate(own):
            top[i, j], least[i, j] = p, min(-(-low[0] * p // low[1]), np.iinfo(np.int64).max)
    best = [Best(len(a), n) for _ in range(k)]

    def needed():
        return np.min([np.maximum(least[:, j], best[j].worst()) for j in range(k)], axis=0)

    def visit(rows, s, at):
        s[block.labels[at] == labels[rows, None]] = NONE
        for j in range(k):
            best[j].add(rows, np.where((s <= top[rows, j, None]) & (s >= least[rows, j, None]), s, NONE), block.keys[at])
    block.walk(a, visit, needed)
    for j, b in enumerate(best):
        m, i = np.nonzero(b.score != NONE)
        yield keys[m], np.full(len(m), j, np.int32), b.key[m, i], b.score[m, i]


def _search(answer, centre: np.ndarray, spread: dict[int, float], dim: int, dtype: str, k: int, low, n: int):
    names = ["anchor_id", "nth", "found_id", "score"]

    def members(block, part):
        ids, labels = (part.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
        cluster = part.column("cluster").to_numpy(zero_copy_only=False)
        a, scores = matrix(part.column("v"), dim, dtype), part.column("scores").to_pylist()
        for c in np.unique(cluster).tolist():
            block.shared_list(c, centre[c], spread[c])
            at = np.flatnonzero(cluster == c)
            for lo in range(0, len(at), 256):
                m = at[lo:lo + 256]
                for cols in answer(block, a[m], ids[m], labels[m], [scores[i] for i in m.tolist()], k, low, n):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=names)

    def run(batches):
        held, block, number = [], None, None
        for b in batches:
            mark = np.asarray(b.column("block")).astype(np.int64) * 2 + np.asarray(b.column("kind"))
            cuts = [0, *(np.flatnonzero(mark[1:] != mark[:-1]) + 1).tolist(), len(mark)]
            for lo, hi in zip(cuts, cuts[1:]):
                part = b.slice(lo, hi - lo)
                if hi == lo:
                    continue
                if mark[lo] // 2 != number:
                    held, block, number = [], None, mark[lo] // 2
                if mark[lo] % 2 == 0:
                    held.append((*(part.column(c).to_numpy(zero_copy_only=False).copy() for c in ("vec_id", "label")), matrix(part.column("v"), dim, dtype)))
                elif block is None and held:
                    block = Block(*(np.concatenate(c) for c in zip(*held)))
                    held = []
                if mark[lo] % 2 and block is not None:
                    yield from members(block, part)
    return run


def block_count(rows: int, dim: int) -> int:
    """Blocks of about 32 sqrt(rows) rows: shuffled copies of the anchors then grow
    like the rows do, and a block stays within BLOCK_CELLS components."""
    size = min(max(4096, 32 * isqrt(rows)), max(1, BLOCK_CELLS // max(dim, 1)))
    return max(1, -(-rows // size))


def mined(df: DataFrame, is_anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256,
          positives: int = 5, negatives: int = 5, low: tuple[int, int] = (80, 100)) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor``: which rows are anchors, on column ``vec_id``.  An anchor's positives are
    its ``positives`` best other rows of its label; for each, the ``negatives`` best rows of
    other labels with low[0] / low[1] * positive_score <= score <= positive_score.
    """
    spark = df.sparkSession
    paths = [scratch_path(spark, "hard-negatives-" + n) for n in ("rows", "anchors")]
    scaled(df, key, vector, label, scale).write.parquet(paths[0])
    rows = spark.read.parquet(paths[0])
    total = rows.agg(F.count("*").alias("n"), F.max("dim").alias("dim"), F.max("norm2").alias("norm2"),
                     F.count(F.when(is_anchor, 1)).alias("anchors")).first()
    dim, bound = max(1, total["dim"] or 0), total["norm2"] or 0.0  # no sum in a product exceeds the largest square
    if bound >= 2.0**63:
        raise ValueError("scores beyond 64 bits are possible")
    dtype = "float32" if bound < 2**24 else "float64" if bound < 2**53 else "int64"

    anchors = rows.where(is_anchor).select("vec_id", "label", "v")
    some = thin(anchors, "vec_id", SAMPLE).orderBy(key_hash("vec_id"), "vec_id").limit(SAMPLE).select("v").toArrow()
    centre = centres(matrix(pa.chunked_array(some.column("v")).combine_chunks() if some.num_rows else pa.array([], pa.binary()), dim, "float64"),
                     min(CLUSTERS, max(1, total["anchors"] // MEMBERS)))

    def assign(batches):
        for b in batches:
            x = matrix(b.column("v"), dim, "float64")
            own = np.argmax(x @ centre.T, axis=1) if len(x) else np.zeros(0, np.int64)
            length, away = norms(x), np.zeros(len(x))
            for c in np.unique(own).tolist():
                away[own == c] = angles(x[own == c], length[own == c], centre[c])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own.astype(np.int32)), pa.array(away)], names=["vec_id", "label", "v", "cluster", "away"])
    anchors.mapInArrow(assign, "vec_id long, label int, v binary, cluster int, away double").write.parquet(paths[1])
    anchors = spark.read.parquet(paths[1])
    spread = {r["cluster"]: r["away"] for r in anchors.groupBy("cluster").agg(F.max("away").alias("away")).collect()}  # CLUSTERS rows at most

    blocks = block_count(total["n"], dim)
    dealt = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), F.lit(0).alias("cluster"),
                        "vec_id", "label", "v", F.lit(None).cast("array<long>").alias("scores"))

    def search(asked: DataFrame, answer) -> DataFrame:
        visits = asked.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "cluster", "vec_id", "label", "v", "scores")
        return dealt.unionByName(visits).repartition(blocks, "block").sortWithinPartitions("block", "kind", "cluster", "vec_id") \
            .mapInArrow(_search(answer, centre, spread, dim, dtype, positives, low, negatives), "anchor_id long, nth int, found_id long, score long")

    def ranked(found: DataFrame, k: int, *group: str) -> DataFrame:
        order = Window.partitionBy(*group).orderBy(F.desc("score"), "found_id")  # groups: k rows a block at most
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    near = ranked(search(anchors.withColumn("scores", F.lit(None).cast("array<long>")), _positives), positives, "anchor_id") \
        .groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "score", "found_id"))).alias("near"))
    own = scratch_path(spark, "hard-negatives-positives")
    near.write.parquet(own)
    near = spark.read.parquet(own)
    asked = anchors.join(near, anchors["vec_id"] == near["anchor_id"]).withColumn("scores", F.col("near.score"))
    far = ranked(search(asked, _negatives), negatives, "anchor_id", "nth")
    return far.join(near, "anchor_id").select(
        "anchor_id", F.expr("near[nth].found_id").alias("positive_id"), "rank", F.col("found_id").alias("negative_id"),
        F.expr("near[nth].score").alias("positive_score"), F.col("score").alias("negative_score"))
