"""Byte-level BPE over whole texts without regular expressions.

Code points become symbols by class arrays; a small transducer over those
symbols marks where a token may start.  Its transition functions compose
associatively, so many runs are scanned at once and their functions are
joined afterwards.  The slices between marks are found equal in Arrow and
merged once each; ids and byte offsets give back the text.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skyrisk.llm.common import keyed_text, slices, spread, starts

# symbols: what a code point is to the transducer
(LETTER, NUMBER, MARK, SHORT, LONG, BLANK, GAP, CUT) = range(8)
# states: the token that is open
(NONE, IN_LETTERS, IN_NUMBERS, IN_MARKS, LEAD, CLITIC2, CLITIC1, CLITIC_END) = range(8)
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
RUN = 256


def transitions() -> tuple[np.ndarray, np.ndarray]:
    """(next state, starts a token) by symbol and state.

    SHORT and LONG are apostrophes before one (s t m d) or two (re ve ll)
    letters; BLANK is a space before a non-space, GAP any other white space
    (runs are handled by their edges), CUT ends a text.
    """
    go, new = np.zeros((8, 8), np.uint8), np.zeros((8, 8), bool)
    for sym, same in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (MARK, IN_MARKS)):
        go[sym], new[sym] = same, True
        new[sym, [same, LEAD]] = False
    go[LETTER, CLITIC2], go[LETTER, CLITIC1] = CLITIC1, CLITIC_END
    new[LETTER, [CLITIC2, CLITIC1]] = False
    for sym, then in ((SHORT, CLITIC1), (LONG, CLITIC2)):
        go[sym], new[sym] = then, True
        go[sym, [IN_MARKS, LEAD]] = IN_MARKS
        new[sym, [IN_MARKS, LEAD]] = False
    go[BLANK], new[BLANK] = LEAD, True
    go[GAP], go[CUT], new[CUT] = NONE, NONE, True
    return go, new


def classes() -> np.ndarray:
    """LETTER, NUMBER, GAP or MARK of every code point, by its general category."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], MARK) for c in range(0x110000)), np.uint8, 0x110000)
    out[WHITE] = GAP
    return out


def symbols(cp: np.ndarray, ends: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, white-space starts) of texts in a row, each closed by a CUT at ``ends``."""
    sym = table[cp]
    sym[ends] = CUT
    gap = sym == GAP
    nxt = np.append(sym[1:], CUT)
    last = gap & (nxt != GAP) & (nxt != CUT)  # last white space before a non-space
    before = np.append(False, gap[:-1])
    begins = gap & (~before | last)
    sym[last & (cp == 32)] = BLANK
    at = np.flatnonzero(cp == 39)
    at = at[sym[at] != CUT]
    if len(at):
        pad = np.append(cp, [0, 0])
        pad[ends] = 0
        a, b = pad[at + 1], pad[at + 2]
        short = np.isin(a, [ord(c) for c in "stmd"])
        long = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        sym[at[short]], sym[at[long]] = SHORT, LONG
    return sym, begins


def scan(sym: np.ndarray, go: np.ndarray) -> np.ndarray:
    """State before each symbol, from NONE: runs of RUN symbols are composed as
    functions of their first state side by side, then joined, then replayed."""
    n, lanes = len(sym), -(-len(sym) // RUN)
    grid = np.full(lanes * RUN, CUT, np.uint8)
    grid[:n] = sym
    grid = np.ascontiguousarray(grid.reshape(lanes, RUN).T) * np.uint8(8)
    flat = go.reshape(-1)
    f = np.tile(np.arange(8, dtype=np.uint8), (lanes, 1))
    for t in range(RUN):
        f = flat[grid[t][:, None] + f]
    state, first = 0, np.zeros(lanes, np.uint8)
    for i in range(lanes):
        first[i] = state
        state = f[i, state]
    out = np.empty((RUN, lanes), np.uint8)
    s = first
    for t in range(RUN):
        out[t] = s
        s = flat[grid[t] + s]
    return out.T.reshape(-1)[:n]


class Bpe:
    """Ranks of one vocabulary; ``encode`` a column of texts, ``decode`` runs of ids."""

    def __init__(self, path: str, cache: int = 100_000):
        """cache: slices kept in each of two generations."""
        import public_tokenizers
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.merge = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                       special_tokens={})._core_bpe.encode_single_piece
        words = [b""] * (max(ranks.values()) + 1)
        for w, i in ranks.items():
            words[i] = w
        size = np.array([len(w) for w in words], np.int64)
        self.bytes, self.size, self.first = np.frombuffer(b"".join(words), np.uint8), size, starts(size)[:-1]
        self.table, (self.go, self.new) = classes(), transitions()
        self.young, self.old, self.cache = {}, {}, cache

    def cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """(slices of all texts in a row, number of slices of each text)."""
        joined = "\n".join(texts.to_pylist()) + "\n"  # one code point closes each text
        cp = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        chars = np.asarray(pa.compute.utf8_length(texts), dtype=np.int64)
        ends = np.cumsum(chars + 1) - 1
        sym, white = symbols(cp, ends, self.table)
        begin = self.new[sym, scan(sym, self.go)] | white
        width = 1 + (cp >= 0x80).astype(np.int64) + (cp >= 0x800) + (cp >= 0x10000)
        offset = starts(width)
        at = np.flatnonzero(begin)
        closing = np.zeros(len(cp), bool)
        closing[ends] = True
        keep = ~closing[at]
        bounds = np.append(offset[at], offset[-1])
        raw = pa.BinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(joined.encode())]) \
            .filter(pa.array(keep)).cast(pa.binary())
        return raw, np.diff(np.searchsorted(at[keep], np.append(0, ends + 1)))

    def merged(self, pieces: list[bytes]) -> list[tuple[bytes, bytes]]:
        """(ids as little-endian 32-bit, ids as decimals with commas) of slices."""
        out = []
        for w in pieces:
            v = self.young.get(w)
            if v is None:
                v = self.old.get(w)
                if v is None:
                    ids = self.merge(w)
                    v = (array("I", ids).tobytes(), (",".join(map(str, ids)) + ",").encode())
                self.young[w] = v
            out.append(v)
        if len(self.young) > self.cache:
            self.old, self.young = self.young, {}
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, bytes, np.ndarray]:
        """(ids of all texts in a row, ids per text, their decimals, bytes of decimals per text)."""
        raw, per = self.cut(texts)
        which = raw.dictionary_encode()
        got, at = self.merged(which.dictionary.to_pylist()), which.indices.to_numpy(zero_copy_only=False)
        of, out = starts(per), []
        for k, kind in ((0, np.uint32), (1, np.uint8)):
            flat = np.frombuffer(b"".join(v[k] for v in got), kind)
            size = np.fromiter((len(v[k]) for v in got), np.int64, len(got)) // flat.itemsize
            count = size[at]
            out += [spread(flat, starts(size)[:-1][at], count), np.diff(starts(count)[of])]
        return out[0], out[1], out[2].tobytes(), out[3]

    def decode(self, ids: np.ndarray, per: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(bytes of all ids in a row, offset of each text's first byte and the end)."""
        size = self.size[ids]
        return spread(self.bytes, self.first[ids], size).tobytes(), starts(size)[starts(per)]


_BPE: dict[str, Bpe] = {}


def bpe(path: str) -> Bpe:
    """This Python worker's tables and cache."""
    if path not in _BPE:
        _BPE[path] = Bpe(path)
    return _BPE[path]


def encode_texts(docs: DataFrame, ranks: str) -> DataFrame:
    """(doc_id, ids, offsets): ids of the whole text and each id's first byte in it.

    Null and empty texts have no ids; repeated rows stay; null ids stay null.
    """
    def run(batches):
        b = bpe(ranks)
        for s in slices(batches):
            ids, per, _, _ = b.encode(s.column("text"))
            cut = pa.array(starts(per).astype(np.int32))
            at = starts(b.size[ids])
            offsets = at[:-1] - np.repeat(at[starts(per)[:-1]], per)
            yield pa.RecordBatch.from_arrays([s.column("doc_id"), pa.ListArray.from_arrays(cut, pa.array(ids.astype(np.int32))),
                                              pa.ListArray.from_arrays(cut, pa.array(offsets))], names=["doc_id", "ids", "offsets"])
    return keyed_text(docs).mapInArrow(run, "doc_id long, ids array<int>, offsets array<long>")


def decode_ids(encoded: DataFrame, ranks: str) -> DataFrame:
    """(doc_id, bytes) of (doc_id, ids)."""
    def run(batches):
        b = bpe(ranks)
        for s in batches:
            ids = s.column("ids")
            per = np.asarray(pa.compute.list_value_length(ids), dtype=np.int64)
            raw, at = b.decode(np.asarray(ids.flatten(), dtype=np.int64), per)
            yield pa.RecordBatch.from_arrays([s.column("doc_id"), pa.array([raw[at[i]:at[i + 1]] for i in range(len(per))], pa.binary())],
                                             names=["doc_id", "bytes"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, ranks: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode, decode and digest in one pass."""
    def run(batches):
        b = bpe(ranks)
        sha = hashlib.sha256
        for s in slices(batches):
            ids, per, text, size = b.encode(s.column("text"))
            cut = starts(size)
            raw, at = b.decode(ids, per)
            yield pa.RecordBatch.from_arrays(
                [s.column("doc_id"), pa.array(per),
                 pa.array([sha(text[cut[i]:max(cut[i], cut[i + 1] - 1)]).hexdigest() for i in range(len(per))], pa.string()),
                 pa.array([sha(raw[at[i]:at[i + 1]]).hexdigest() for i in range(len(per))], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return keyed_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
