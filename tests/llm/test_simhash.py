import random

import numpy as np
import pytest
import xxhash

from skyrisk.llm import simhash as S
from tests.llm.conftest import odd


def slow_fingerprint(text):
    words, out = [], ""
    for c in text:
        if c in " \t\n\x0b\x0c\r":
            words.append(out)
            out = ""
        else:
            out += c.lower() if "A" <= c <= "Z" else c
    words = [w for w in words + [out] if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(fps, bits=3):
    """fps: list of (doc_id, fingerprint); smallest reachable id of each row."""
    n, low = len(fps), list(range(len(fps)))

    def root(i):
        while low[i] != i:
            i = low[i]
        return i
    for i in range(n):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= bits:
                low[root(i)] = root(j)
    best = {}
    for i, (d, _) in enumerate(fps):
        if d is not None:
            best[root(i)] = min(d, best.get(root(i), d))
    return [best.get(root(i)) for i in range(n)]


def compare(df):
    rows = [(r[0], r[1] or "") for r in df.collect()]
    fps = [(d, slow_fingerprint(t)) for d, t in rows]
    want = sorted((str(d), f"{f:016x}", str(c)) for (d, f), c in zip(fps, slow_components(fps)))
    assert sorted((str(r[0]), r[1], str(r[2])) for r in S.marked(df).collect()) == want


def test_documents(docs):
    compare(docs)


def test_odd_rows(odd_docs, empty_docs):
    compare(odd_docs)
    assert S.marked(empty_docs).count() == 0 and S.keep_one(empty_docs).count() == 0


@pytest.mark.parametrize("large", [2, 8, 4096])
def test_links_of_dense_fingerprints(spark, monkeypatch, large):
    """Clusters, chains and far ones; small LARGE deals hot buckets again."""
    monkeypatch.setattr(S, "LARGE", large)
    rng = random.Random(large)
    fps = set()
    for _ in range(6):
        x = rng.getrandbits(64)
        fps.add(x)
        for _ in range(60):
            y = x
            for b in rng.sample(range(64), rng.randint(1, 5)):
                y ^= 1 << b
            fps.add(y)
            if rng.random() < 0.3:
                x = y
    fps = sorted(fps)
    df = spark.createDataFrame([(S.signed(f),) for f in fps], "fp long")
    root = {r["u"] % 2**64: r["root"] % 2**64 for r in S.components(S.links(df)).collect()}
    group = {}
    for f, c in zip(fps, slow_components([(f, f) for f in fps])):
        group.setdefault(c, set()).add(f)
    found = {}
    for f in fps:
        found.setdefault(root.get(f, f), set()).add(f)
    assert sorted(map(sorted, group.values())) == sorted(map(sorted, found.values()))


def test_masks_cover_every_pattern():
    rng = random.Random(0)
    keys = S.masks((1 << 64) - 1)
    for _ in range(2000):
        diff = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(not diff & m for m in keys)


def test_spanning_is_a_forest():
    rng = np.random.default_rng(5)
    fps = np.unique(rng.integers(0, 1 << 12, 300))
    got = S.spanning(fps, 1)
    assert len({u for u, _ in got}) == len(got)


def test_one_of_each_group_stays(spark, odd_docs):
    kept = S.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r[0] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 7, 8, 9] and ids.count(None) == 2


def test_rows_are_told_apart_by_id_and_text(spark):
    """One id on several texts, copies without id: of each component one row stays."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    df = odd(spark, [(1, a), (2, a), (2, b), (3, b), (4, c), (4, a), (None, c), (None, "no id, but a copy"), (None, "no id, but a copy"),
                     (None, " "), (None, None), (5, "")])
    stay = sorted((str(r[0]), r[1] or "") for r in S.keep_one(df).collect() if (r[1] or "").strip())
    assert stay == sorted([("1", a), ("2", b), ("4", c), ("None", "no id, but a copy")])
    blank = [r[0] for r in S.keep_one(df).collect() if not (r[1] or "").strip()]
    assert len(blank) == 2 and 5 in blank and None in blank


def test_hot_group_of_copies(spark):
    df = odd(spark, [(i, "one text that a third of all rows share, word for word") for i in range(400)] + [(1000 + i, f"other text number {i} of many, all of them apart") for i in range(50)])
    compare(df)
