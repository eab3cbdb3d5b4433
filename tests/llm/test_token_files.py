import heapq
import zlib
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skyrisk.llm import token_files as T
from skyrisk.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_ids(text):
    tok = Tokenizer.from_file(PATH)
    return tok.encode(text or "", add_special_tokens=False).ids + [0]


def huffman_cost(counts):
    heap, cost = sorted(c for c in counts if c), 0
    while len(heap) > 1:
        s = heapq.heappop(heap) + heapq.heappop(heap)
        cost += s
        heapq.heappush(heap, s)
    return cost


def test_lengths_are_optimal_without_pressure():
    rng = np.random.default_rng(3)
    for _ in range(20):
        counts = rng.integers(0, 50, 30)
        lengths = T.code_lengths(counts)
        assert (lengths * counts).sum() == huffman_cost(counts.tolist())


def test_lengths_under_a_limit():
    for counts in product((1, 2, 9, 40), repeat=5):
        counts = np.array(sorted(counts))
        best = min((np.array(ls) * counts).sum() for ls in product((1, 2, 3), repeat=5) if sum(2.0 ** -x for x in ls) <= 1)
        lengths = T.code_lengths(counts, 3)
        assert lengths.max() <= 3 and (lengths * counts).sum() == best
    with pytest.raises(ValueError):
        T.code_lengths(np.ones(9), 3)


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 129, 5000])
def test_block_round_trip(n):
    rng = np.random.default_rng(n)
    ids = (rng.pareto(0.5, n) % 3000).astype(np.int64)
    lengths = T.code_lengths(np.bincount(ids, minlength=3001))
    payload, bits, marks = T.encode_block(ids, T.canonical(lengths), lengths)
    assert bits == lengths[ids].sum() and len(marks) == -(-n // T.STEP)
    assert (T.decode_block(payload, n, marks, *T.decode_table(lengths)) == ids).all()


def test_crc_join():
    a, b = b"some bytes", b"and others" * 99
    assert T.crc_join(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert T.crc_join(zlib.crc32(a), 0, 0) == zlib.crc32(a)


def check(spark, docs, rows):
    """Against the library on each whole text, in ascending order of ids."""
    want, at = {}, 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = plain_ids(text)
        want.setdefault(doc, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    path = scratch_path(spark, "t")
    T.write_token_files(docs, path, PATH)
    got = sorted(T.document_checksums(spark, path).collect(), key=lambda r: r["start"])
    assert len(got) == len(rows)
    for r in got:
        want[r["doc_id"]].remove((r["n_tokens"], r["ids_crc32"]))
    ends = np.cumsum([r["n_tokens"] for r in got]) if got else np.array([0])
    assert [r["start"] for r in got] == [0, *ends[:-1].tolist()][:len(got)] and ends[-1] == at
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    return path


def test_files_of_documents(spark, docs):
    path = check(spark, docs, [(r["doc_id"], r["text"]) for r in docs.collect()])
    pieces = T.read_token_files(spark, path).where("doc_id = 3").collect()
    assert pieces[0]["ids"] == plain_ids(docs.where("doc_id = 3").first()["text"])
    shards = spark.read.parquet(f"{path}/blocks").select("shard", "start").orderBy("shard", "start").collect()
    assert [r["start"] for r in shards] == sorted(r["start"] for r in shards)


def test_odd_rows(spark, odd_docs):
    check(spark, odd_docs, [(r[0], r[1]) for r in odd_docs.collect()])


def test_document_longer_than_a_block(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 1 << 16)
    long = odd_docs.where("doc_id = 7")
    path = check(spark, long, [(7, long.collect()[0][1])])
    assert T.read_token_files(spark, path).count() > 1


def test_empty_table(spark, empty_docs):
    path = scratch_path(spark, "t")
    T.write_token_files(empty_docs, path, PATH)
    assert T.document_checksums(spark, path).count() == 0


def test_more_ids_than_sixteen_bits_number():
    rng = np.random.default_rng(8)
    ids = np.concatenate([np.arange(150_000), rng.integers(0, 3000, 60_000)])
    lengths = T.code_lengths(np.bincount(ids, minlength=160_000))
    assert lengths.max() > 16 and (2.0 ** -lengths[lengths > 0].astype(float)).sum() == 1
    codes, table = T.canonical(lengths), T.decode_table(lengths)
    for lo in range(0, len(ids), T.BLOCK):
        part = ids[lo:lo + T.BLOCK]
        payload, _, marks = T.encode_block(part, codes, lengths)
        assert (T.decode_block(payload, len(part), marks, *table) == part).all()


@pytest.mark.parametrize("name, word_ends", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_cached_encoder_as_the_library(name, word_ends, docs):
    """Chunks and single words give the ids of the whole text; a small cache turns over."""
    import random

    import pyarrow as pa

    from skyrisk.llm.common import starts
    from skyrisk.llm.tokens import CachedEncoder
    rng = random.Random(3)
    letters = "ab' 's're'llÀé\n\t  1²中’ 　.!'ßÿǅİΣσς×÷ªº😀\x1c\x85\x01\x02|\"é"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["x" + a + m + "y " + a + m for a in "HJTWYAK" for m in "\u0331\u030c\u0308\u030a\u02be\u0301"]
    texts += ["a <|endoftext|> b", "<|startoftext|>", "Word.<|endoftext|>. <|ENDOFTEXT|> don't", 'the "Word", <|']
    texts += [" À", "\nword", "<|endoftext|> x", "Ünïcode ÀÉ straße", "", "\n", " "] + [r["text"] for r in docs.limit(60).collect()]
    tok = Tokenizer.from_file(public_tokenizers.path(name))
    enc = CachedEncoder(public_tokenizers.path(name), word_ends, cache=1000)
    for lo in range(0, len(texts), 200):
        part = texts[lo:lo + 200]
        ids, per = enc.encode(pa.array(part))
        cut = starts(per)
        for i, x in enumerate(tok.encode_batch(part, add_special_tokens=False)):
            assert x.ids == ids[cut[i]:cut[i + 1]].tolist(), part[i]
