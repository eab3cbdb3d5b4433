import base64
import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from skyrisk.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(texts):
    ids, per, _, _ = bpe.bpe(PATH).encode(pa.array(texts, pa.string()))
    cut = bpe.starts(per)
    return [ids[cut[i]:cut[i + 1]].tolist() for i in range(len(texts))]


def test_random_texts_as_the_library(library):
    rng = random.Random(4)
    letters = "ab' 's're'll\n\t  1²é中’ 　.!'lvemdt'😀\x1c\x85"
    texts = ["", " ", "'", "'s", " 's", "''s", "a's's", "it'll've", "x  y", "x \n y", "end  "] \
        + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    assert ids_of(texts) == [library.encode_ordinary(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(), min_size=1, max_size=5))
def test_any_text(library, texts):
    assert ids_of(texts) == [library.encode_ordinary(t) for t in texts]


def test_scan_over_many_runs(library):
    text = "don't " * 700 + "'" * 600 + "x" * 600
    assert ids_of([text]) == [library.encode_ordinary(text)]


def test_round_trip(library, docs, odd_docs):
    for d in (docs, odd_docs):
        rows = sorted((str(r[0]), r[1] or "") for r in d.collect())
        got = sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.round_trip(d, PATH).collect())
        want = []
        for doc, text in rows:
            ids = library.encode_ordinary(text)
            want.append((doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
        assert got == sorted(want)


def test_offsets_give_the_slices(odd_docs, library):
    enc = bpe.encode_texts(odd_docs, PATH)
    row = enc.where("doc_id = 8").first()
    raw = odd_docs.where("doc_id = 8").collect()[0][1].encode()
    ends = row["offsets"][1:] + [len(raw)]
    assert [raw[a:b] for a, b in zip(row["offsets"], ends)] == [library.decode_single_token_bytes(i) for i in row["ids"]]
    assert bpe.decode_ids(enc, PATH).where("doc_id = 8").first()["bytes"] == raw


def test_empty_table(empty_docs):
    assert bpe.round_trip(empty_docs, PATH).count() == 0
