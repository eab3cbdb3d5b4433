import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyrisk.llm import quality_gbt as G
from skyrisk.llm import quality_rules as R
from skyrisk.llm.docstats import NAMES, rules, statistics


def slow_rules(text):
    words, w = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            if w:
                words.append(w)
            w = ""
        else:
            w += c
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit)


def test_rules_against_brute_force():
    rng = random.Random(6)
    for _ in range(400):
        text = "".join(rng.choice("ab #|é😀 \n\t\x1c　") for _ in range(rng.randint(0, 120)))
        assert rules(text) == slow_rules(text)
    assert rules("a b c d a b c") == (7, 7, 0, 0, 6)
    assert rules("a a a a") == (4, 4, 0, 0, 4)


def test_statistics_are_finite(odd_docs):
    for r in odd_docs.collect():
        base, x = statistics(r[1] or "")
        assert x.shape == (len(NAMES),) and np.isfinite(x).all() and base == (slow_rules(r[1]) if len(r[1] or "") < 1000 else base)


def walk(forest, x, leaf):
    """One row at a time, node by node."""
    trees, inner = forest.feature.shape
    out = []
    for t in range(trees):
        i = 0
        while i < leaf(inner):
            i = 2 * i + 1 + int(x[forest.feature[t, i]] > forest.cut[t, i])
        out.append(i)
    return out


def test_flat_trees_walk_as_nodes():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    f = G.fit(x, y, trees=20, depth=3)
    s = f.score(x)
    assert ((s > 0.5) == y).mean() > 0.9
    inner = f.feature.shape[1]
    for i in range(40):
        z = f.prior + sum(f.leaf[t, k - inner] for t, k in enumerate(walk(f, x[i], lambda n: n)))
        assert abs(1 / (1 + np.exp(-z)) - s[i]) < 1e-9


def test_isolation_scores_walk_as_nodes():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 3)).astype(np.float32)
    f = R.fit(x, trees=20, subsample=64)
    s = f.score(x)
    for i in range(30):
        ends = walk(f, x[i], lambda n: (n - 1) // 2)
        assert abs(2.0 ** (-np.mean([f.path[t, k] for t, k in enumerate(ends)]) / f.norm) - s[i]) < 1e-5
    assert f.score(np.full((1, 3), 9.0, np.float32))[0] > s.max()


def test_expected_path():
    assert R.expected_path(1) == 0 and R.expected_path(2) == 1 and abs(R.expected_path(256) - 10.244) < 0.01


@pytest.mark.parametrize("y", [[], [1.0] * 30, [0.0, 1.0]])
def test_without_both_labels(y):
    f = G.fit(np.zeros((len(y), len(NAMES)), np.float32), np.array(y))
    assert 0 < f.score(np.zeros((1, len(NAMES)), np.float32))[0] < 1


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    d, lab = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = G.classified(d, lab).join(lab, "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(held) > 50 and np.mean([r["predicted"] == r["quality"] for r in held]) > 0.95
    judged = R.judged(d, lab).join(lab, "doc_id").collect()
    fine = [r for r in judged if not r["base_failed"]]
    assert np.mean([r["kept"] for r in fine if r["quality"] == 1]) > 0.98
    assert np.mean([not r["kept"] for r in fine if r["quality"] == 0]) > 0.9


def test_short_rows_do_not_train(spark):
    """Labelled rows that fail the base rules change neither the trees nor the limit."""
    sf = "/root/testdata/sf0.01"
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    lab = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    long = lab.join(d.where("size(filter(split(text, '[ \t\n\r\f]+'), w -> w <> '')) >= 50"), "doc_id", "left_semi")
    odd = spark.createDataFrame([(10**6 + i, "TITLE " * (i + 1) + "$$ a", 1) for i in range(30)], "doc_id long, text string, quality int")
    want = R.train(d, long)
    for docs, labels in ((d, lab), (d.union(odd.select("doc_id", "text")), lab.union(odd.select("doc_id", "quality")))):
        got = R.train(docs, labels)
        assert got.limit == want.limit and (got.path == want.path).all() and (got.cut == want.cut).all()


def test_every_rule_statistic_counts(spark):
    """Good documents with repeated lines, or with words run together, are anomalies; with other line ends they are not."""
    sf = "/root/testdata/sf0.01"
    d, lab = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    good = [r["text"].split() for r in d.join(lab.where("quality = 1"), "doc_id").select("doc_id", "text").orderBy("doc_id").limit(60).collect()]
    rows = []
    for w in (g for g in good if len(g) > 100):
        lines = [" ".join(w[k:k + 10]) for k in range(0, len(w), 10)]
        rows += [("wrapped", "\n".join(lines)), ("repeated", "\n".join(lines + lines[:1] * (len(lines) // 2))),
                 ("joined", " ".join(x * 20 if k % 5 == 0 else x for k, x in enumerate(w)))]
    made = spark.createDataFrame([(10**6 + i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in R.judged(d.select("doc_id", "text").union(made), lab).where("doc_id >= 1000000").collect()}
    for kind, least in (("wrapped", 0.0), ("repeated", 0.9), ("joined", 0.9)):
        part = [got[10**6 + i] for i, (k, _) in enumerate(rows) if k == kind]
        share = np.mean([not r["kept"] for r in part if not r["base_failed"]])
        assert share > least if least else share < 0.1, (kind, share)


def test_rule_query(docs, labels):
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in R.judged(docs, labels).collect():
        t = text[r["doc_id"]]
        if len(t) < 4000:
            n, chars, sym, dup, rep = slow_rules(t)
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, sym, dup, rep)
            assert r["base_failed"] == (n < 50 or 100 * rep > 50 * n)
        assert not (r["kept"] and r["base_failed"])


def test_odd_rows(odd_docs, odd_labels, empty_docs, no_labels):
    for lab in (odd_labels, no_labels):
        assert len(G.classified(odd_docs, lab).collect()) == odd_docs.count()
        rows = R.judged(odd_docs, lab).collect()
        assert len(rows) == odd_docs.count() and all(r["base_failed"] for r in rows if r["doc_id"] in (1, 2, 3, None))
        for keep in (G.keep_good, R.keep_passing):
            out = keep(odd_docs, lab)
            assert out.columns == odd_docs.columns and out.count() <= odd_docs.count()
        assert G.classified(empty_docs, lab).count() == 0 and R.judged(empty_docs, lab).count() == 0


def test_limit_without_bad_rows_beyond_the_good_ones():
    rng = np.random.default_rng(2)
    good = rng.normal(0.4, 0.02, 5000)
    none = np.zeros(0)
    limit = R.calibrate(good, none)
    assert 0 < (good > limit).mean() <= R.LOSS and limit == R.calibrate(good, np.full(50, 0.1))
    few = R.calibrate(good[:20], none)
    assert good[:20].max() < few < 1 and R.calibrate(none, good) == np.inf
    assert R.calibrate(good, np.full(50, 0.9)) > limit


def test_splits_against_brute_force():
    """Every node of a tree has the best of all splits between values, one value after another."""
    rng = np.random.default_rng(9)
    for seed in range(5):
        x = rng.integers(0, 8, (600, 4)).astype(np.float32)
        y = (rng.random(600) < 0.15 + 0.7 * ((x[:, seed % 4] > 4) ^ (x[:, (seed + 1) % 4] > 2))).astype(float)
        f = G.fit(x, y, trees=1, depth=3)
        p = 1 / (1 + np.exp(-f.prior))
        g, h = p - y, np.full(len(y), p * (1 - p))

        def gain(rows, right):
            parts = [(g[r].sum(), h[r].sum()) for r in (rows & ~right, rows & right, rows)]
            if min(parts[0][1], parts[1][1]) < 0.05:
                return 0.0
            one, two, all_ = (a * a / (b + G.RIDGE) for a, b in parts)
            return one + two - all_
        todo = [(0, np.ones(len(y), bool))]
        while todo:
            node, rows = todo.pop()
            if node >= f.feature.shape[1]:
                leaf = node - f.feature.shape[1]
                assert np.isclose(f.leaf[0, leaf], -G.RATE * g[rows].sum() / (h[rows].sum() + G.RIDGE))
                continue
            best = max(gain(rows, x[:, c] > v) for c in range(4) for v in range(7))
            right = x[:, f.feature[0, node]] > f.cut[0, node]
            assert gain(rows, right) >= best - 1e-9 or best <= 1e-6
            todo += [(2 * node + 1, rows & ~right), (2 * node + 2, rows & right)]


def test_limit_of_all_labelled_rows(spark):
    """Of more labelled rows than any fixed number, every one outside the held-out fold sets the limit."""
    n, filler = 27_000, " ".join(f"w{i}" for i in range(60))
    d = spark.range(n).select(F.col("id").alias("doc_id"), F.expr(f"""concat('{filler} ', repeat('Aa#b, ', cast(pmod(xxhash64(id), 40) as int)),
        repeat('x', cast(pmod(xxhash64(id, 1), 300) as int)), if(id % 9 = 0, repeat(' $', 45), ''))""").alias("text"))
    lab = d.select("doc_id", F.when(F.col("doc_id") % 9 != 0, 1).otherwise(0).alias("quality"))
    forest = R.train(d, lab)
    rows = [r for r in R.judged(d, lab).orderBy("doc_id").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 and not r["base_failed"]]
    good, bad = (np.array([r["anomaly"] for r in rows if (r["doc_id"] % 9 != 0) == y]) for y in (True, False))
    assert len(good) > 15_000 and len(good) + len(bad) > 20_000
    top = np.sort(good[1::2])[int(np.ceil(len(good[1::2]) * (1 - R.LOSS))) - 1]
    assert (bad > top).any() and forest.limit == (top + np.quantile(bad[bad > top], 0.1)) / 2
    assert forest.limit == R.calibrate(good[1::2], bad)


def test_trees_draw_from_all_rows(spark, monkeypatch):
    """Of more rows than all trees hold, each tree still draws its own among all of them."""
    monkeypatch.setattr(R, "TREES", 20)
    monkeypatch.setattr(R, "SUBSAMPLE", 16)
    x = np.random.default_rng(3).random((2000, len(NAMES))).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "place long, x array<float>").repartition(5)
    got = R.grown(rows, 2000)
    drawn = np.array([np.random.default_rng((R.SEED, t)).choice(2000, 16, replace=False) for t in range(20)])
    want = R.fit(x[:, R.COLUMNS], 20, 16, R.SEED, drawn)
    assert (got.path == want.path).all() and (got.cut == want.cut).all() and drawn.max() > 1900 > 100 > drawn.min()
    few = R.grown(rows.where("place < 320"), 320)
    want = R.fit(x[:320, R.COLUMNS], 20, 16)
    assert (few.path == want.path).all() and (few.cut == want.cut).all()


def test_ranks_of_a_table(spark):
    """Order statistics as of the sorted array, with equal, neighbouring and extreme scores."""
    rng = np.random.default_rng(4)
    for s in (rng.random(300), np.r_[np.full(50, 0.5), np.nextafter(0.5, 1), np.nextafter(0.5, 0), 1.0, 1e-9], np.array([1.0])):
        ranks, s = R.Ranks(spark.createDataFrame([(float(v),) for v in s], "anomaly double")), np.sort(s)
        assert len(ranks) == len(s) and ranks.searchsorted(float(s[len(s) // 2]), side="right") == s.searchsorted(s[len(s) // 2], side="right")
        for k in {0, len(s) // 3, len(s) // 2, len(s) - 2, len(s) - 1} - {-1}:
            assert ranks[k] == s[k]


def test_numbering_in_order(spark):
    rows = spark.range(0, 3000, numPartitions=7).select((F.col("id") * 7919 % 3000).alias("doc_id"), (F.col("id") % 2).alias("x"))
    got, n = R._numbered(rows.union(rows.limit(10)), "doc_id", "x")
    got = sorted((r["place"], r["doc_id"]) for r in got.collect())
    assert n == 3010 and [p for p, _ in got] == list(range(3010)) and [k for _, k in got] == sorted(k for _, k in got)
    assert R._numbered(rows.where("false"), "doc_id")[1] == 0
