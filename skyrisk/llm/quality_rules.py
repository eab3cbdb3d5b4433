"""Quality rules: base limits, then an isolation forest on the rule statistics.

Trees split random subsamples at random; odd documents are alone after few
splits.  The forest learns the labelled good documents, so a split may fall
beyond the rows of its node, by their range at most: what lies out there is
alone at once.  The score above which a document counts as an anomaly is
calibrated on the labelled rows; where no bad one is odder than the good ones, on the
good ones alone.  Without labelled good rows the base rules decide alone.

All labelled rows outside the held-out fold count, however many: they are measured, put in
order and scored by Spark tasks.  The driver gets the rows that the trees drew (at most
``TREES`` times ``SUBSAMPLE``) and counts of score ranges, from which the limit is exact.

Rows: null, empty and blank texts have no words and fail the base rules; repeated rows are
judged each and alike; texts of any length are read whole; a score equal to the limit is
kept; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyrisk.llm.common import keyed_text, training_labels, whole_rows
from skyrisk.llm.docstats import NAMES, statistics
from skyrisk.session import scratch_path

TREES, SUBSAMPLE, SEED = 100, 256, 17
#: The rule statistics: word lengths, symbols, upper case, repeats and line shapes;
#: digits, marks and alphabets are not faults.
RULES = tuple(c for c in NAMES if c not in ("digits", "marks", "non_ascii", "marked_words"))
COLUMNS = [NAMES.index(c) for c in RULES]
FLOOR = 0.05  # least range of a share: good documents may all have the same
WORDS = 50  # base rule: least number of words
LOSS = 0.002  # share of labelled good documents the threshold may reject
RANGES = 4096  # score ranges counted at a time
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points."""
    n = np.asarray(n, float)
    big = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(big - 1) + np.euler_gamma) - 2 * (big - 1) / big, np.where(n == 2, 1.0, 0.0))


@dataclass
class Isolation:
    """Full trees in arrays by (tree, node): split feature and value; ``path`` holds a
    leaf's path length, also at all nodes below it.  ``limit``: highest score kept."""
    feature: np.ndarray
    cut: np.ndarray
    path: np.ndarray
    norm: float
    limit: float = np.inf

    def score(self, x: np.ndarray) -> np.ndarray:
        """2^(-mean path / norm) of each row: near 1 odd, below 0.5 ordinary."""
        trees, nodes = self.feature.shape
        at, base, rows = np.zeros((len(x), trees), np.int64), np.arange(trees) * nodes, np.arange(len(x))[:, None]
        for _ in range(int(np.log2(nodes + 1)) - 1):
            k = base + at
            at = 2 * at + 1 + (x[rows, self.feature.ravel()[k]] > self.cut.ravel()[k])
        return 2.0 ** (-self.path.ravel()[base + at].mean(axis=1, dtype=float) / self.norm)


def fit(x: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = SEED, drawn: np.ndarray | None = None) -> Isolation:
    """An isolation forest on rows ``x``; no rows: every score is equal.  ``drawn``: the
    places in ``x`` of each tree's rows, if they were drawn before."""
    rng = np.random.default_rng(seed)
    m = min(subsample, len(x))
    depth = int(np.ceil(np.log2(max(2, m)))) + 3
    nodes = (1 << (depth + 1)) - 1
    out = Isolation(np.zeros((trees, nodes), np.int16), np.full((trees, nodes), np.inf, np.float32), np.zeros((trees, nodes), np.float32),
                    max(1.0, float(expected_path(m))))
    for t in range(trees if m else 0):
        todo = [(0, 0, x[rng.choice(len(x), m, replace=False) if drawn is None else drawn[t]])]
        while todo:
            node, level, rows = todo.pop()
            low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (np.zeros(x.shape[1]),) * 2
            if level < depth and len(rows) > 1:
                f = int(rng.integers(x.shape[1]))
                wide = max(FLOOR, high[f] - low[f])
                c = np.float32(rng.uniform(low[f] - wide, high[f] + wide))
                out.feature[t, node], out.cut[t, node] = f, c
                right = rows[:, f] > c
                todo += [(2 * node + 1, level + 1, rows[~right]), (2 * node + 2, level + 1, rows[right])]
            else:
                lo, hi = node, node
                while lo < nodes:
                    out.path[t, lo:hi + 1] = level + float(expected_path(len(rows)))
                    lo, hi = 2 * lo + 1, 2 * hi + 2
    return out


class Ranks:
    """The scores of a table (column ``anomaly``, from 0 to 1, none null) as a sorted array
    has them: by rank, exactly.  Spark counts the rows of ``RANGES`` score ranges, then those
    of the parts of the range that holds the rank, until that has a single value."""

    def __init__(self, rows: DataFrame):
        self.rows, self.n = rows, rows.count()

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, rank: int) -> float:
        rows, low, high = self.rows, 0.0, 1.0
        while low < high:
            part = F.floor((F.col("anomaly") - low) / ((high - low) / RANGES))
            for r in sorted(rows.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min("anomaly").alias("low"), F.max("anomaly").alias("high")).collect()):
                if rank < r["n"]:
                    break
                rank -= r["n"]
            low, high = r["low"], r["high"]
            rows = rows.where(F.col("anomaly").between(low, high))
        return low

    def searchsorted(self, value: float, side: str = "right") -> int:
        return self.rows.where(F.col("anomaly") <= value if side == "right" else F.col("anomaly") < value).count()


def calibrate(good: np.ndarray | Ranks, bad: np.ndarray | Ranks, loss: float = LOSS) -> float:
    """The score limit that rejects most bad rows, at most ``loss`` of the good ones;
    halfway to the next score, so that good rows much like those seen pass.  Without a
    bad row beyond them it is the good rows' own quantile; of too few good rows to tell
    that quantile, as far beyond their largest score as that is from their median."""
    good, bad = (np.sort(s) if isinstance(s, np.ndarray) else s for s in (good, bad))
    n = len(good)
    if not n:
        return np.inf
    top = good[max(0, int(np.ceil(n * (1 - loss))) - 1)]
    first = int(bad.searchsorted(top, side="right"))
    if first == len(bad):
        return float(top if n * loss >= 1 else 2 * top - (good[(n - 1) // 2] + good[n // 2]) / 2)
    at = 0.1 * (len(bad) - first - 1)  # a tenth of the bad rows beyond lie below this place among them
    pair = [bad[first + int(at)], bad[min(first + int(at) + 1, len(bad) - 1)]]
    return float((top + np.quantile(pair, at - int(at))) / 2)


def _vectors(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES)) if isinstance(column, pa.Array) else \
        np.concatenate([np.zeros((0, len(NAMES)), np.float32), *map(_vectors, column.chunks)])


def _base(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rule counts, whether the base rules fail, statistics) of each text."""
    got = [statistics(t) for t in texts]
    base = np.array([g[0] for g in got], np.int64).reshape(-1, 5)
    return base, (base[:, 0] < WORDS) | (100 * base[:, 4] > 50 * base[:, 0]), np.array([g[1] for g in got], np.float32).reshape(-1, len(NAMES))


def _odd(x: np.ndarray, forest: Isolation) -> np.ndarray:
    x = x[:, COLUMNS]
    return np.concatenate([np.zeros(0), *(forest.score(x[i:i + 512]) for i in range(0, len(x), 512))])


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, the five rule counts, base_failed, x: the statistics) of every row."""
    def run(batches):
        for b in batches:
            base, failed, x = _base(b.column("text").to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(NAMES)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(base[:, i]) for i in range(5)), pa.array(failed), lists],
                                             names=["doc_id", *BASE, "base_failed", "x"])
    return keyed_text(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, x array<float>")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _numbered(rows: DataFrame, *keys: str) -> tuple[DataFrame, int]:
    """``rows`` with ``place``, their rank from 0 in the order of the keys, and their number.
    Sorted tasks count their own rows; the driver adds up one count a task."""
    rows = _written(rows.orderBy(*keys).withColumn("at", F.monotonically_increasing_id()), "rules-in-order") \
        .withColumn("task", F.shiftright("at", 33))
    starts, n = [], 0
    for task, count in sorted(map(tuple, rows.groupBy("task").count().collect())):
        starts.append((task, n))
        n += count
    starts = rows.sparkSession.createDataFrame(starts, "task long, start long")
    return rows.join(F.broadcast(starts), "task").withColumn("place", F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1)), n


def grown(rows: DataFrame, n: int) -> Isolation:
    """A forest on ``n`` rows (place, x), place from 0.  Rows that all trees together could
    draw come to the driver as they are; of more, each tree draws its places among all
    of them and only rows that were drawn come."""
    drawn = None
    if n > TREES * SUBSAMPLE:
        drawn = np.array([np.random.default_rng((SEED, t)).choice(n, SUBSAMPLE, replace=False) for t in range(TREES)])
        asked = np.unique(drawn)
        drawn = np.searchsorted(asked, drawn)
        rows = rows.join(F.broadcast(rows.sparkSession.createDataFrame([(int(i),) for i in asked], "place long")), "place")
    got = rows.select("place", "x").toArrow()
    return fit(_vectors(got.column("x"))[np.argsort(got.column("place").to_numpy())][:, COLUMNS], TREES, SUBSAMPLE, SEED, drawn)


def learned(rows: DataFrame, labels: DataFrame) -> Isolation:
    """Forest and limit from all labelled ones of the ``measured`` rows that pass the base rules.

    Half of the good rows grow the trees, the others and the bad ones set the limit."""
    rows = rows.where(~F.col("base_failed")).join(training_labels(labels, "quality"), "doc_id")
    rows = _written(rows.select("doc_id", "x", "n_words", (F.col("label") >= 1).alias("good")), "rules-labelled")
    good, n = _numbered(rows.where("good"), "doc_id", "x", "n_words")
    half = F.shiftright("place", 1).alias("place")
    forest = grown(good.where("place % 2 = 0").select(half, "x"), (n + 1) // 2)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("good"), pa.array(_odd(_vectors(b.column("x")), forest))], names=["good", "anomaly"])
    scores = good.where("place % 2 = 1").select("good", "x").union(rows.where("not good").select("good", "x"))
    scores = _written(scores.mapInArrow(run, "good boolean, anomaly double"), "rules-scores")
    forest.limit = calibrate(Ranks(scores.where("good")), Ranks(scores.where("not good")))
    return forest


def train(docs: DataFrame, labels: DataFrame) -> Isolation:
    return learned(measured(docs), labels)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, the five rule counts, base_failed, kept, anomaly) of every row.

    Null and empty texts have no words, so they fail the base rules."""
    rows = _written(measured(docs), "rules-measured")
    forest = learned(rows, labels)

    def run(batches):
        for b in batches:
            odd = _odd(_vectors(b.column("x")), forest)
            kept = ~b.column("base_failed").to_numpy(zero_copy_only=False) & (odd <= forest.limit)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", *BASE, "base_failed")), pa.array(kept), pa.array(odd)],
                                             names=["doc_id", *BASE, "base_failed", "kept", "anomaly"])
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, kept boolean, anomaly double")


def keep_passing(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, all columns as they are."""
    forest, at = train(docs, labels), docs.columns.index("text")

    def run(batches):
        for b in batches:
            _, failed, x = _base([t or "" for t in b.column(at).to_pylist()])
            yield b.filter(pa.array(~failed & (_odd(x, forest) <= forest.limit)))
    return whole_rows(docs, run)
