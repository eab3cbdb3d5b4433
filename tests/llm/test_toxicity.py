import re

import numpy as np
import pyarrow as pa

from skyrisk.llm import toxicity as T


def test_votes():
    v = T.Voters(["lowei", "veq"])
    texts = ["You are an IDIOT! such a moron", "idiotic plan", "loweisch und loweian", "", "shut up", "VEQU"]
    got = [{v.names[i] for i in np.flatnonzero(r)} for r in v.votes(pa.array(texts))]
    assert {"word_idiot", "word_moron", "you_insult", "insult_shout", "two_hits", "hit_in_50"} <= got[0]
    assert got[1] == set() and got[3] == set() and got[4] == {"get_lost"}
    assert {"stem_lowei", "two_hits"} <= got[2] and got[5] == set()  # one word of a stem says nothing


def slow_votes(v, text):
    """Voters that speak, from the module's rules, word by word."""
    low = text.lower()
    own = set(re.findall(r"[\w]+", low))
    out = {f"word_{w}" for w in own if w in T.WORDS}
    hits = len(out)
    for stem in v.learned:
        n = sum(w.startswith(stem) for w in own)
        if n >= 2:
            out.add(f"stem_{stem}")
            hits += n
    if hits or "get_lost" in {n for n, p in zip(T.PATTERNS, T._PATTERNS) if p.search(low)}:
        out |= {n for n, p in zip(T.PATTERNS, T._PATTERNS) if p.search(low)}
    length = len(re.split(r"[^\w]+", low))
    out |= {"two_hits"} if hits >= 2 else set()
    out |= {"three_hits"} if hits >= 3 else set()
    return out | {f"hit_in_{n}" for n in (400, 200, 100, 50) if hits * n > length}


def test_votes_against_a_slow_voter(docs):
    rng = np.random.default_rng(5)
    v = T.Voters(["lowei", "achlich"])
    parts = ["idiot", "You are", "a", "moron!", "loweia", "loweib", "achlichst", "achlichen", "shut up", "vile", "kind", "word, ", "such an", "\n", "é"]
    texts = [" ".join(rng.choice(parts, rng.integers(0, 40))) for _ in range(400)] + [r["text"] or "" for r in docs.collect()]
    got = v.votes(pa.array(texts))
    assert set(np.unique(got)) <= {0, 1}
    for t, row in zip(texts, got):
        assert {v.names[i] for i in np.flatnonzero(row)} == slow_votes(v, t), t[:80]


def test_posterior_by_enumeration():
    """Without correlations the posterior is Bayes' rule over the two classes."""
    rng = np.random.default_rng(1)
    v = (rng.random((50, 4)) < 0.4).astype(float)
    m = T.LabelModel(np.array([[0.1, 0.2, 0.05, 0.3], [0.6, 0.5, 0.4, 0.35]]), np.ones(4), 0.2, np.zeros((4, 4)))
    for row, z in zip(v, m.log_odds(v)):
        p = [(0.2 if c else 0.8) * np.prod([m.fire[c, j] if x else 1 - m.fire[c, j] for j, x in enumerate(row)]) for c in (0, 1)]
        assert abs(1 / (1 + np.exp(-z)) - p[1] / sum(p)) < 1e-12


def test_label_model_finds_accuracy_and_copies_from_votes_alone():
    rng = np.random.default_rng(0)
    y = (rng.random(6000) < 0.2).astype(float)
    good = (rng.random((6000, 6)) < np.where(y[:, None] > 0, 0.6, 0.03)).astype(float)
    poor = (rng.random((6000, 1)) < 0.3).astype(float)
    v = np.concatenate([good, good[:, :1], good[:, :1], poor], axis=1)
    model, q = T.fit_label_model(v)
    assert np.abs(model.fire[1, 1:6] - 0.6).max() < 0.07 and np.abs(model.fire[0, 1:6] - 0.03).max() < 0.02
    assert abs(model.fire[1, 8] - model.fire[0, 8]) < 0.1 and abs(model.prior - 0.2) < 0.03
    assert model.correlation[0, 6] > 0.9 and abs(model.correlation[1, 2]) < 0.15
    assert model.share[0] < 0.4 < 0.8 < model.share[1]
    assert ((q > 0.5) == y).mean() > 0.97


def test_labels_orient_and_scale_only():
    z, y = np.array([-3.0, -2.0, -1.0, 2.0, 3.0]), np.array([0, 0, 1, 1, 1.0])
    slope, shift = T.fit_scale(z, y)
    assert slope > 0 and (1 / (1 + np.exp(-(slope * z + shift))) >= 0.5).tolist() == [False, False, True, True, True]


def test_stems_are_learned_once(spark):
    rows = [(f"xx zorba{a} zorba{b} y{i}", 1) for i, (a, b) in enumerate([("k", "m"), ("lo", "ne"), ("m", "pi"), ("k", "ta"), ("su", "ne")])]
    rows += [(f"plain words number{i} numbers", 0) for i in range(60)] + [("one zorbak only", 0)] * 10
    assert T.learn_stems(spark.createDataFrame(rows, "text string, label int")) == ["zorba"]


def test_held_out(spark):
    sf = "/root/testdata/sf0.01"
    d, lab = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = T.classified(d, lab).join(lab, "doc_id").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    clean = [r for r in got if r["toxic"] == 0]
    assert np.mean([r["predicted"] for r in clean]) < 0.01
    assert np.mean([r["predicted"] for r in got if r["toxic"] == 1]) > 0.75


def test_labels_of_the_held_out_fold_do_not_matter(spark, docs, labels):
    from pyspark.sql import functions as F

    from skyrisk.llm.common import fold
    flipped = labels.withColumn("toxic", F.when(fold("doc_id") == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, T.classified(docs, x).collect())) for x in (labels, flipped))
    assert a == b


def test_odd_rows(odd_docs, odd_labels, empty_docs, no_labels):
    for lab in (odd_labels, no_labels):
        rows = T.classified(odd_docs, lab).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert T.classified(empty_docs, lab).count() == 0


def test_lexicon_alone(spark, no_labels):
    d = spark.createDataFrame([(1, "you stupid worthless idiot"), (2, "a kind word")], "doc_id long, text string")
    assert {r["doc_id"]: r["predicted"] for r in T.classified(d, no_labels).collect()} == {1: 1, 2: 0}
