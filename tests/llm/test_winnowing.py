import hashlib
import random

import numpy as np

from skyrisk.llm import winnowing as W
from tests.llm.conftest import odd


def slow(text, k, w):
    if not text:
        return []
    k = min(k, len(text))
    hs = []
    for i in range(len(text) - k + 1):
        v = 0
        for c in text[i:i + k]:
            v = (v * W.BASE + ord(c) + 1) % 2**64
        v ^= v >> 32
        v = v * 0xD6E8FEB86659FD93 % 2**64
        hs.append(v ^ v >> 32)
    w, out = min(w, len(hs)), []
    for i in range(len(hs) - w + 1):
        low = min(hs[i:i + w])
        at = max(j for j in range(i, i + w) if hs[j] == low)
        if not out or out[-1][1] != at:
            out.append((low, at))
    return out


def fast(text, k, w):
    h, p = W.winnow(W.code_points(text), k, w)
    return list(zip(map(int, h), map(int, p)))


def test_against_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("ab😀") for _ in range(rng.randint(0, 200)))
        k, w = rng.randint(1, 30), rng.randint(1, 20)
        assert fast(text, k, w) == slow(text, k, w)


def test_chunks_change_nothing(monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(W, "CHUNK", 50)
    for n in (54, 55, 60, 100, 149, 150, 151, 500):
        text = "".join(rng.choice("ab") for _ in range(n))
        assert fast(text, 5, 7) == slow(text, 5, 7)


def test_match_guarantee():
    rng = random.Random(3)
    shared = "".join(rng.choice("abcdefgh ") for _ in range(W.GRAM + W.WINDOW - 1))
    for _ in range(50):
        a, b = ("".join(rng.choice("xyz") for _ in range(rng.randint(0, 90))) for _ in range(2))
        one = {h for h, _ in fast(a + shared + b, W.GRAM, W.WINDOW)}
        assert one & {h for h, _ in fast(b + shared + a, W.GRAM, W.WINDOW)}


def want(rows):
    rows = sorted(rows, key=lambda r: -r[0])
    out = []
    for i, (doc, text) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        k = len(text) // 3
        e = text[:len(text) - k] + nxt[:k]
        f, fe, fn = (slow(t, W.GRAM, W.WINDOW) for t in (text, e, nxt))
        def near(a, b):
            a, b = {h for h, _ in a}, {h for h, _ in b}
            return len(a & b) / len(a | b) if a | b else 1.0
        out.append((doc, len(text), hashlib.sha256(e.encode()).hexdigest(), "".join(f"{h:016x}{p:08x}" for h, p in f),
                    "".join(f"{h:016x}{p:08x}" for h, p in fe), near(f, fe), near(f, fn)))
    return sorted(out)


def test_compared(spark):
    rng = random.Random(5)
    for n in (1, 2, 17):
        rows = [(3 * i + rng.randint(0, 1), "".join(rng.choice("abc ") for _ in range(rng.randint(0, 300)))) for i in range(n)]
        rows.append((1000, rows[-1][1]))
        got = W.compared(odd(spark, rows)).collect()
        assert sorted(tuple(r) for r in got) == want(rows)
    only = W.compared(odd(spark, [(4, "alone in here, but long enough to tell")])).collect()[0]
    assert only["near_next"] == 1.0


def test_odd_rows(odd_docs, empty_docs, spark):
    got = W.compared(odd_docs).collect()
    assert len(got) == odd_docs.count()
    same = {r["fingerprint"] for r in got if r["doc_id"] in (4, 5)}
    assert len(same) == 1
    order = [r["doc_id"] for r in got if r["doc_id"] is not None]
    assert sorted(order) == [1, 2, 3, 4, 5, 5, 7, 8, 9]
    assert W.compared(empty_docs).count() == 0
    plain = {r["doc_id"]: r for r in W.document_fingerprints(odd_docs).collect()}
    assert plain[1]["hashes"] == [] and len(plain[7]["hashes"]) == len(plain[7]["positions"]) > 1000
    assert (np.diff(plain[7]["positions"]) > 0).all()


def test_documents(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: r for r in W.compared(docs).collect()}
    order = sorted(rows, reverse=True)
    assert len(got) == len(rows)
    for (doc, text), (_, nxt) in zip(order, order[1:] + order[:1]):
        k = len(text) // 3
        assert got[doc]["edited_sha256"] == hashlib.sha256((text[:len(text) - k] + nxt[:k]).encode()).hexdigest()
        assert got[doc]["n_chars"] == len(text)


def test_likeness_follows_from_what_is_shown(docs):
    got = W.compared(docs).collect()
    by_next = sorted((r for r in got), key=lambda r: -r["doc_id"])
    for r, nxt in zip(by_next, by_next[1:] + by_next[:1]):
        assert r["near_edited"] == W.shown_likeness(r["fingerprint"], r["edited_fingerprint"])
        assert r["near_next"] == W.shown_likeness(r["fingerprint"], nxt["fingerprint"])
    whole = {r["doc_id"]: r for r in W.document_fingerprints(docs).collect()}
    for r in got[:50]:
        h, at = W.read_shown(r["fingerprint"])
        assert h.astype(np.int64).tolist() == whole[r["doc_id"]]["hashes"] and at.tolist() == whole[r["doc_id"]]["positions"]
