"""Packing by Karmarkar-Karp multiway differencing.

Documents are cut into full windows and a rest of small pieces.  Pieces of a
group become partial partitions into k windows; the two with the largest
differences are merged, large sums onto small ones, until one is left.  If a
window of it exceeds the capacity, k rises by one and the group is dealt again.
Every task packs what it reads, so nothing is shuffled.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from skyrisk.llm.common import keyed_text, slices, starts
from skyrisk.llm.tokens import encoder

CAPACITY, PIECE, GROUP = 2048, 256, 128  # tokens a window, tokens a piece at most, windows a group
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Indices of ``sizes`` in k windows of near-equal sums.

    A partial partition lists its non-empty windows, largest first; sums count
    from its smallest window (0 while some are empty).
    """
    if k == 1:
        return [list(range(len(sizes)))]
    heap = [(-s, i, [s], [[i]]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    tick = len(sizes)
    while len(heap) > 1:
        _, _, a, ga = heapq.heappop(heap)
        _, _, b, gb = heapq.heappop(heap)
        over = len(a) + len(b) - k
        if over > 0:  # the last ``over`` windows of a take those of b, smallest with largest
            cut = k - len(b)
            s = a[:cut] + [a[cut + j] + b[len(b) - 1 - j] for j in range(over)] + b[:len(b) - over]
            g = ga[:cut] + [ga[cut + j] + gb[len(b) - 1 - j] for j in range(over)] + gb[:len(b) - over]
        else:
            s, g = a + b, ga + gb
        order = sorted(range(len(s)), key=s.__getitem__, reverse=True)
        least = s[order[-1]] if len(s) == k else 0
        s, g = [s[i] - least for i in order], [g[i] for i in order]
        heapq.heappush(heap, (-s[0] + (s[-1] if len(s) == k else 0), tick, s, g))
        tick += 1
    return heap[0][3] if heap else []


def windows(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """As few windows as differencing finds for pieces of at most ``capacity``."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        got = differencing(sizes, k)
        if all(sum(sizes[i] for i in w) <= capacity for w in got):
            return got
        k += 1


def _pack(path: str, end_id: int, capacity: int, piece: int, group: int):
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches):
        tok = encoder(path, word_ends=True)
        sequence = TaskContext.get().partitionId() << 40
        out, held, total = [], [], 0

        def emit():
            cols = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in cols], names=names)

        def deal():
            nonlocal sequence
            for w in windows([h[2] for h in held], capacity):
                at = 0
                for i in sorted(w):
                    out.append((*held[i], sequence, at))
                    at += held[i][2]
                sequence += 1
            held.clear()
        for b in slices(batches, size=4 << 20):
            ids, per = tok.encode(b.column("text"))
            cut = starts(per)
            for i, doc in enumerate(b.column("doc_id").to_pylist()):
                own = np.append(ids[cut[i]:cut[i + 1]], np.uint32(end_id)).astype("<u4")
                n, raw, at = len(own), own.tobytes(), 0
                while at < n:
                    full = n - at >= capacity
                    size = capacity if full else min(piece, n - at)
                    row = (doc, at, size, zlib.crc32(raw[4 * at:4 * (at + size)]), n)
                    if full:
                        out.append((*row, sequence, 0))
                        sequence += 1
                    else:
                        held.append(row)
                        total += size
                    at += size
                if total >= group * capacity:
                    deal()
                    total = 0
            if out:
                yield emit()
        if held:
            deal()
        if out:
            yield emit()
    return run


def packed(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY, piece: int = PIECE, group: int = GROUP) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    Each row's ids end with ``end_id``; a null text has only that.  Repeated rows
    are packed each.  Windows come in groups of ``group`` per task, so only the
    last group of a task can leave a window partly empty.
    """
    return keyed_text(docs).mapInArrow(_pack(tokenizer, end_id, capacity, piece, group), SCHEMA)
