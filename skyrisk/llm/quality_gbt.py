"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are full binary trees of one depth, flattened into arrays by node
number, so a batch of documents walks all of them together.

Rows: null, empty and blank texts have statistics of 0 and a score like any other; repeated
rows are scored each and alike; texts of any length are read whole; of splits of equal gain
the first statistic's lowest cut counts, and a value equal to a cut goes left; an empty table
gives no rows.  At most ``SAMPLE`` labelled rows are learned from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyrisk.llm.common import fold, keyed_text, labelled_texts, whole_rows
from skyrisk.llm.docstats import NAMES, statistics

SAMPLE = 20_000  # labelled rows the trees are fitted on, at most
THRESHOLD = 0.3
TREES, DEPTH, BINS, RATE, LEAST, RIDGE = 80, 4, 64, 0.15, 8.0, 1.0


@dataclass
class Forest:
    """``feature`` and ``cut`` by (tree, inner node), ``leaf`` by (tree, leaf); node i has children 2i+1, 2i+2."""
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        trees, inner = self.feature.shape
        at, base = np.zeros((len(x), trees), np.int64), np.arange(trees) * inner
        rows = np.arange(len(x))[:, None]
        for _ in range(int(np.log2(inner + 1))):
            k = base + at
            at = 2 * at + 1 + (x[rows, self.feature.ravel()[k]] > self.cut.ravel()[k])
        leaf = self.leaf.ravel()[np.arange(trees) * (inner + 1) + at - inner]
        return 1 / (1 + np.exp(-(self.prior + leaf.sum(axis=1))))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """Second-order boosting of log-loss; splits are found on histograms of
    quantile bins.  Without both labels all scores equal the (smoothed) share of 1."""
    inner = (1 << depth) - 1
    share = (y.sum() + 1) / (len(y) + 2)
    out = Forest(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf, np.float32),
                 np.zeros((trees, inner + 1)), float(np.log(share / (1 - share))))
    if len(y) < 2 * LEAST or len(set(y.tolist())) < 2:
        return out
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1]).astype(np.float32)) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)])
    raw = np.full(len(y), out.prior)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            width, first = 1 << level, (1 << level) - 1
            tg, th = np.bincount(node, g, width), np.bincount(node, h, width)
            best = np.full(width, 1e-6)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                key = node * BINS + binned[f]
                lg = np.bincount(key, g, width * BINS).reshape(width, BINS).cumsum(axis=1)[:, :len(e)]
                lh = np.bincount(key, h, width * BINS).reshape(width, BINS).cumsum(axis=1)[:, :len(e)]
                rg, rh = tg[:, None] - lg, th[:, None] - lh
                gain = lg ** 2 / (lh + RIDGE) + rg ** 2 / (rh + RIDGE) - (tg ** 2 / (th + RIDGE))[:, None]
                gain[(lh < 0.05) | (rh < 0.05)] = 0
                top = gain.argmax(axis=1)
                won = gain[np.arange(width), top] > best
                best[won] = gain[np.arange(width), top][won]
                out.feature[t, first:first + width][won] = f
                out.cut[t, first:first + width][won] = e[top[won]]
            f, c = out.feature[t, first + node], out.cut[t, first + node]
            node = 2 * node + (x[np.arange(len(y)), f] > c)
        width = 1 << depth
        out.leaf[t] = -RATE * np.bincount(node, g, width) / (np.bincount(node, h, width) + RIDGE)
        raw += out.leaf[t][node]
    return out


def _labelled(batches):
    for b in batches:
        got = [statistics(t) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([x.tolist() for _, x in got], pa.list_(pa.float32())), b.column("label"),
                                          pa.array([base[0] for base, _ in got], pa.int64())], names=["doc_id", "x", "label", "n_words"])


def sample(docs: DataFrame, labels: DataFrame, label: str, limit: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(statistics, labels, numbers of words) of at most ``limit`` labelled training rows, on the driver
    in an order that does not depend on the partitions."""
    rows = labelled_texts(docs, labels, label, limit).select("doc_id", "text", "label") \
        .mapInArrow(_labelled, "doc_id long, x array<float>, label int, n_words long").collect()
    rows = sorted((r["doc_id"], r["x"], r["label"], r["n_words"]) for r in rows)
    return (np.array([r[1] for r in rows], np.float32).reshape(-1, len(NAMES)), np.array([min(1, max(0, r[2])) for r in rows], np.float64),
            np.array([r[3] for r in rows], np.int64))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: int = SAMPLE) -> Forest:
    return fit(*sample(docs, labels, label, limit)[:2])


def _scores(texts: list[str], forest: Forest) -> np.ndarray:
    x = np.array([statistics(t)[1] for t in texts], np.float32).reshape(-1, len(NAMES))
    return np.concatenate([forest.score(x[i:i + 512]) for i in range(0, len(x), 512)]) if len(x) else np.zeros(0)


def score(docs: DataFrame, forest: Forest) -> DataFrame:
    """(doc_id, score) of every row; null and empty texts get a score like any other."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(_scores(b.column("text").to_pylist(), forest))], names=["doc_id", "score"])
    return keyed_text(docs).mapInArrow(run, "doc_id long, score double")


def classified(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted)."""
    return score(docs, train(docs, labels, limit=limit)).select(
        "doc_id", (fold("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that score at least THRESHOLD, all columns as they are."""
    forest, at = train(docs, labels, limit=limit), docs.columns.index("text")

    def run(batches):
        for b in batches:
            s = _scores([t or "" for t in b.column(at).to_pylist()], forest)
            yield b.filter(pa.array(s >= THRESHOLD))
    return whole_rows(docs, run)
