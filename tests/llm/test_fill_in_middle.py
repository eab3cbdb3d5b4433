import hashlib
import random
import re

import numpy as np

from skyrisk.llm import fill_in_middle as M
from skyrisk.llm.common import keyed_text
from skyrisk.llm.queries import queries
from tests.llm.conftest import odd

TOKEN = re.compile("[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def slow(doc, text):
    """One row of the query, as its contract reads."""
    text = text or ""
    tokens = TOKEN.findall(text)
    assert "".join(tokens) == text
    n = len(tokens)
    digest = sha(f"42:{'' if doc is None else doc}")
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc, n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(t) for t in (tokens[:a], tokens[a:b], tokens[b:]))
    form = "spm" if h[3] % 100 < 80 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc, n, form, len(p), len(m), sha(out), sha(text)


def same(df, rows):
    return sorted(map(tuple, df.collect()), key=str) == sorted((slow(d, t) for d, t in rows), key=str)


def test_containers_against_sorted_lists():
    rng = random.Random(1)
    sets = [range(0, 300_000, 2), range(65_530, 65_545), range(200_000), sorted(rng.sample(range(400_000), 9_000)), [0], [65_535, 65_536, 131_072], [],
            [*range(10, 5_000), *range(70_000, 70_010), *range(1 << 17, (1 << 17) + 9_000, 3), 5_000_000]]
    kinds = set()
    for values in sets:
        values = np.array(list(values), np.int64)
        one = M.BoundarySet.of(values)
        for got in (one, M.BoundarySet.from_bytes(one.to_bytes())):
            assert len(got) == len(values)
            kinds |= {type(c) for c in got.containers}
            for k in {0, len(values) - 1, *(rng.randrange(len(values)) for _ in range(300))} if len(values) else ():
                assert got.select(k) == values[k]
            for v in {0, 70_005, 1 << 23, *(rng.randrange(500_000) for _ in range(300))}:
                assert got.rank(v) == np.searchsorted(values, v, side="right")
            for k in (-1, len(values)):
                try:
                    got.select(k)
                    raise AssertionError
                except IndexError:
                    pass
    assert kinds == {M.ArrayContainer, M.BitmapContainer, M.RunContainer}


def test_boundaries_against_the_pattern():
    rng = random.Random(2)
    for _ in range(500):
        text = "".join(rng.choice("ab\n\t  😀\x1c") for _ in range(rng.randint(0, 30)))
        ends = np.cumsum([0] + [len(t) for t in TOKEN.findall(text)])
        assert M.boundaries(np.frombuffer(text.encode("utf-32-le"), np.uint32)).tolist() == ends.tolist()


def test_round_trip_of_nasty_parts():
    rng = random.Random(3)
    for _ in range(500):
        text = "".join(rng.choice(["<", "P", ">", "S", "M", " ", "<<", "P>"]) for _ in range(rng.randint(1, 20)))
        if any(m in text for m in ("<P>", "<S>", "<M>")):
            continue
        a, b = sorted(rng.randint(0, len(text)) for _ in range(2))
        for form in ("psm", "spm", "plain"):
            assert M.restore(M.arrange(text, a, b, form), form) == text


def test_odd_rows(spark, odd_docs, empty_docs):
    rows = [(r["doc_id"], r["text"]) for r in keyed_text(odd_docs).collect()]
    assert same(M.digested(odd_docs), rows)
    assert M.digested(empty_docs).count() == 0
    texts = ["a<P>b c", "<", "x <", "P> <", "<P", "one", " one", "one ", "\n", " <S> ", "é 😀😀 中 文 z\x1c q"]
    rows = [(100 * i + j, t) for i, t in enumerate(texts) for j in range(40)]
    out = M.restored(M.transformed(odd(spark, rows)))
    assert {r["doc_id"]: r["restored"] for r in out.collect()} == dict(rows)
    assert {r["form"] for r in out.collect()} == {"plain", "psm", "spm"}
    assert same(M.digested(odd(spark, rows)), rows)


def test_rates(spark):
    rows = [(i, "some words here") for i in range(2000)]
    got = {r["form"]: r["count"] for r in M.transformed(odd(spark, rows), M.Rates(seed=7, rearranged=100, suffix_first=25)).groupBy("form").count().collect()}
    assert "plain" not in got and 400 < got["spm"] < 600


def test_query(spark, sf_small, docs):
    assert same(queries()["op12_fill_in_middle"](spark, sf_small), [(r["doc_id"], r["text"]) for r in docs.collect()])
