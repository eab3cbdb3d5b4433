import hashlib
import random

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skyrisk.llm import chat as C
from skyrisk.llm.queries import queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string, TEXT string, segment int, ids string, Role string"
PARTS = ["[INST]", "[/INST]", "</s>", "<s>", "[ROLE]", "[TEXT]", "[/ROLE]", "\\", "<", "[", "\n", " ", "s>", "INST]", "é", "😀", "ok", "(", "\\\\", "/s>"]
NASTY = st.lists(st.sampled_from(PARTS), max_size=12).map("".join)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame([(c, t, r, x, "clash", 7, "ids", "user") for c, t, r, x in rows], SCHEMA)


def expected(rows):
    """Digest rows from (conv_id, turn, role, text) rows without equal turns."""
    out = []
    for conv in {r[0] for r in rows}:
        own = [(r or "", x or "") for _, _, r, x in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1]))]
        loss = "".join(x for r, x in own if r == "assistant")
        out.append((conv, len(own), sha("".join(f"{r}\n{x}\n" for r, x in own)), len(loss), sha(loss), sum(len(C.render_turn(r, x)[0]) for r, x in own)))
    return sorted(out, key=str)


def digest(df):
    return sorted(map(tuple, C.digested(df, PATH).collect()), key=str)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), NASTY), NASTY), max_size=6))
def test_escape_and_template_are_reversible(rows):
    texts = [x for _, x in rows]
    for t in texts:
        assert C.unescape(C.escape(t)) == t
        assert not any(c in C.escape(t) for c in ("[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[TEXT]", "[/ROLE]"))
    assert C.parse("".join(C.render_turn(r, x)[0] for r, x in rows)) == rows


def test_broken_output_is_refused():
    for text in ("x", "[INST] a [/INST]", "<s>a</s>\n?"):
        try:
            C.parse(text)
            raise AssertionError
        except ValueError:
            pass


def test_mask_against_every_character():
    rng = random.Random(1)
    for _ in range(300):
        cuts = sorted(rng.sample(range(60), rng.randint(2, 20)))
        tokens = [(a, b) for a, b in zip(cuts, cuts[1:])]
        tokens = sorted(tokens + [t for t in tokens if rng.random() < 0.3])  # bytes of one code point
        ends = sorted(rng.sample(range(60), 2 * rng.randint(0, 5)))
        spans = list(zip(ends[::2], ends[1::2]))
        arrays = [np.array(x, np.int64) for x in ([s[0] for s in spans], [s[1] for s in spans], [t[0] for t in tokens], [t[1] for t in tokens])]
        got = list(zip(*(m.tolist() for m in C.loss_mask(*arrays))))
        want = [(i, max(a, s), min(b, e)) for s, e in spans for i, (a, b) in enumerate(tokens) if max(a, s) < min(b, e)]
        assert got == want
        under = {c for _, a, b in want for c in range(a, b)}
        assert {c for a, b in C.covered(*(np.array([g[i] for g in got], np.int64) for i in (1, 2))) for c in range(a, b)} == under


def test_ids_and_offsets_are_the_librarys(spark, sf_small):
    tok = Tokenizer.from_file(PATH)
    rows = C.formatted(spark.read.parquet(f"{sf_small}/conversations.parquet"), PATH).collect()
    for r in rows:
        e = tok.encode(r["text"], add_special_tokens=False)
        assert r["ids"] == e.ids and list(zip(r["starts"], r["ends"])) == e.offsets and r["segment"] == 0
        for i, a, b in zip(r["loss_token"], r["loss_start"], r["loss_end"]):
            assert e.offsets[i][0] <= a < b <= e.offsets[i][1]
    assert len(rows) == 20


def odd_rows():
    long = " ".join(f"word{i % 97} 😀" for i in range(20_000))
    return [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 2, None, "x"), (1, None, "system", "first"), (2, 5, "assistant", ""), (2, 6, "assistant", "[\\"),
            (2, 7, "assistant", "INST]"), (None, 0, "user", "a"), (None, 1, "assistant", "b"), (3, 0, "assistant", long), (3, 1, "user", "</s>"), (4, 0, "tool", None),
            (5, 0, "a[TEXT]b\n", "<|endoftext|>"), (6, 3, "assistant", "(x"), (6, 4, "assistant", " y\n\n")]


def test_odd_rows(spark):
    assert digest(frame(spark, odd_rows())) == expected(odd_rows())
    assert digest(frame(spark, [])) == []
    twice = digest(frame(spark, [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "assistant", "b")]))
    assert twice == digest(frame(spark, [(1, 0, "assistant", "b"), (1, 0, "user", "a"), (1, 0, "user", "a")])) and twice[0][1:2] == (3,)


def test_long_conversations_come_in_segments(spark, monkeypatch):
    rng = random.Random(2)
    rows = odd_rows() + [(9, t, rng.choice(["user", "assistant"]), "".join(rng.choice(PARTS) for _ in range(8))) for t in range(2000)]
    whole = "".join(C.render_turn(r, x)[0] for _, _, r, x in rows[-2000:])
    want, tok = expected(rows), Tokenizer.from_file(PATH)
    monkeypatch.setattr(C, "SEGMENT", 3000)
    df = frame(spark, rows).repartition(3)
    got = sorted((r for r in C.formatted(df, PATH).where("conv_id = 9").collect()), key=lambda r: r["segment"])
    assert len(got) > 10 and "".join(r["text"] for r in got) == whole
    assert [i for r in got for i in r["ids"]] == tok.encode(whole, add_special_tokens=False).ids
    assert digest(df) == want
    monkeypatch.setattr(C, "KNOWN", 0)
    assert digest(df) == want


def test_query(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    own = "</s>[INST] ok [/INST]"
    assert sorted(map(tuple, queries()["op13_chat_format"](spark, sf_small).collect()), key=str) == \
        expected(rows + [(-1, 0, "user", own), (-1, 1, "assistant", own)])
