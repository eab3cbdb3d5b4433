import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from skyrisk.llm import packing as P
from tests.llm.conftest import odd

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_differencing_keeps_every_piece():
    rng = random.Random(0)
    for _ in range(300):
        sizes, k = [rng.randint(1, 40) for _ in range(rng.randint(1, 25))], rng.randint(1, 6)
        got = P.differencing(sizes, k)
        assert len(got) <= k and sorted(i for w in got for i in w) == list(range(len(sizes)))


def test_two_way_as_published():
    """8, 7, 6, 5, 4 differences to 2: sums 16 and 14."""
    got = P.differencing([8, 7, 6, 5, 4], 2)
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in got) == [14, 16]


def test_three_way_is_near_equal():
    rng = random.Random(1)
    for _ in range(30):
        sizes = [rng.randint(1, 256) for _ in range(120)]
        sums = [sum(sizes[i] for i in w) for w in P.differencing(sizes, 3)]
        assert max(sums) - min(sums) <= 8


def test_windows_rise_with_capacity():
    sizes = [6, 6, 6, 6]
    assert len(P.windows(sizes, 8)) == 4 and len(P.windows(sizes, 12)) == 2 and P.windows([], 8) == [[]] or P.windows([], 8) == []
    rng = random.Random(2)
    for _ in range(50):
        sizes = [rng.randint(1, 50) for _ in range(rng.randint(1, 60))]
        got = P.windows(sizes, 50)
        assert all(sum(sizes[i] for i in w) <= 50 for w in got) and sorted(i for w in got for i in w) == list(range(len(sizes)))


def check(df):
    tok = Tokenizer.from_file(PATH)
    want = {}
    for r in df.collect():
        ids = np.array(tok.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4")
        want.setdefault(r[0], []).append(ids)
    rows = P.packed(df, PATH).collect()
    for doc, all_ids in want.items():
        own = [r for r in rows if r["doc_id"] == doc]
        n = len(all_ids)
        assert sum(r["length"] for r in own) == sum(map(len, all_ids))
        if len({len(x) for x in all_ids}) == 1 and len({x.tobytes() for x in all_ids}) == 1:
            ids = all_ids[0]
            marks = sorted((r["start"], r["length"]) for r in own)
            assert marks[0][0] == 0 and all(b[0] in (a[0], a[0] + a[1]) for a, b in zip(marks, marks[1:])) and len(marks) % n == 0
            for r in own:
                assert r["doc_tokens"] == len(ids)
                assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append(r)
    for part in by.values():
        at = 0
        for r in sorted(part, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= P.CAPACITY
    return by


def test_documents(docs):
    by = check(docs)
    used = [sum(r["length"] for r in p) for p in by.values()]
    assert 1 - sum(used) / (P.CAPACITY * len(used)) < 0.03


def test_odd_rows(spark, odd_docs, empty_docs):
    check(odd_docs)
    check(odd(spark, [(1, "a <|endoftext|> b"), (2, "<|startoftext|>Word,"), (3, "<|ENDOFTEXT|> H\u0331")]))
    assert P.packed(empty_docs, PATH).count() == 0
