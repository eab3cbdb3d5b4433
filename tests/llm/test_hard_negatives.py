import math
import random

import numpy as np
from pyspark.sql import functions as F

from skyrisk.llm import hard_negatives as H
from skyrisk.llm.queries import queries

SCHEMA = "vec_id long, embedding array<float>, label int, SCORE double, block int, kind string, cluster string, v string, Label int"


def slow(rows, every, scale=256, k=5, n=5, low=(80, 100)):
    """rows: (vec_id, vector, label), as the module's docstring reads."""
    one = {}
    for key, vec, label in rows:
        if key is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        v = [math.floor(scale * float(np.float32(x))) for x in vec]
        raw = np.array(v, "<i4").tobytes()
        if key not in one or (label, raw) < one[key][:2]:
            one[key] = (label, raw, v)
    out = []
    for a, (la, _, va) in one.items():
        if a % every:
            continue
        score = sorted((-sum(x * y for x, y in zip(va, v)), key) for key, (_, _, v) in one.items())
        near = [(key, -s) for s, key in score if key != a and one[key][0] == la][:k]
        for p, ps in near:
            got = [(key, -s) for s, key in score if one[key][0] != la and low[0] * ps <= -s * low[1] and -s <= ps][:n]
            out += [(a, p, i + 1, key, ps, s) for i, (key, s) in enumerate(got)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(k, v, c, 0.5, 1, "x", "y", "z", 3) for k, v, c in rows], SCHEMA)


def mined(spark, rows, every, **kw):
    return sorted(map(tuple, H.mined(frame(spark, rows), F.col("vec_id") % every == 0, **kw).collect()))


def clustered(n, dim, labels, seed, noise=0.3):
    rng = np.random.default_rng(seed)
    mid = rng.normal(size=(labels, dim))
    out = []
    for i in range(n):
        c = int(rng.integers(labels))
        v = mid[c] + noise * rng.normal(size=dim)
        out.append((i, (v / np.linalg.norm(v)).astype(np.float32).tolist(), c if rng.random() > 0.3 else int(rng.integers(labels))))
    return out


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(H, "block_count", lambda rows, dim: 3)
    monkeypatch.setattr(H, "MEMBERS", 4)
    rows = clustered(700, 16, 5, 1)
    got = mined(spark, rows, 20)
    assert got == slow(rows, 20) and len(got) > 300


def test_ties_and_other_parameters(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([0.0, 0.5, 1.0]) for _ in range(3)], rng.randrange(3)) for i in range(300)]
    assert mined(spark, rows, 10) == slow(rows, 10)
    assert mined(spark, rows, 15, positives=2, negatives=7, low=(1, 2)) == slow(rows, 15, k=2, n=7, low=(1, 2))


def test_large_components(spark):
    rng = random.Random(3)
    for top in (30.0, 60_000.0, 4e6):  # single floats, doubles, 64-bit integers
        rows = [(i, [rng.uniform(-top, top) for _ in range(4)], rng.randrange(2)) for i in range(120)]
        assert mined(spark, rows, 10) == slow(rows, 10)


def test_odd_rows(spark):
    v = [1.0, 0.5]
    rows = [(0, v, 1), (0, v, 1), (0, [0.0, 0.0], 1), (1, None, 1), (2, v, None), (None, v, 1), (3, [1.0, None], 1), (4, [float("nan"), 1.0], 1),
            (5, [float("inf"), 1.0], 2), (6, [], 1), (7, [1.0], 1), (8, [1.0, 0.5, 0.25], 1), (9, v, 2), (10, [0.9, 0.5], 1), (11, [0.9, 0.4], 2), (12, [0.0, 0.0], 2),
            (20, [0.9, 0.6], 1), (-10, [-1.0, -0.5], 2)]
    assert mined(spark, rows, 10) == slow(rows, 10)
    assert mined(spark, [], 10) == []
    assert mined(spark, [(0, v, 1)], 10) == []
    assert mined(spark, [(1, v, 1), (2, v, 2)], 10) == []
    assert mined(spark, [(i, [0.0, 0.0], i % 2) for i in range(30)], 10) == slow([(i, [0.0, 0.0], i % 2) for i in range(30)], 10)


def test_members_stop_early():
    """The walk ends where the bound says so, not at the list's end."""
    rng = np.random.default_rng(4)
    mid = np.eye(8)[:2]
    x = np.concatenate([np.floor(256 * (m + 0.05 * rng.normal(size=(3000, 8)))) for m in mid])
    block = H.Block(np.arange(len(x)), np.zeros(len(x), np.int32), x)
    a = x[:40]
    block.shared_list(0, mid[0], float(H.angles(a, H.norms(a), mid[0]).max()))
    best, seen = H.Best(len(a), 5), []

    def visit(rows, s, at):
        seen.append(len(at))
        best.add(rows, s, block.keys[at])
    block.walk(a, visit, best.worst)
    assert sum(seen) <= len(x) // 2 + 4096 < len(x) or sum(seen) < len(x)
    every = (a @ x.T).astype(int)
    assert [sorted(s, reverse=True)[:5] for s in every.tolist()] == best.score.tolist()


def test_query(spark, sf_small):
    got = sorted(map(tuple, queries()["op11_hard_negatives"](spark, sf_small).collect()))
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"])
            for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()]
    assert got == slow(rows, 100) and got
