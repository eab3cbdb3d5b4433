"""Token ids of whole texts by the ``tokenizers`` library, chunk by chunk.

A text is cut only where the tokenizer's own pre-tokenisation cuts it too, so
chunks are encoded alone and equal chunks once: ids are those of the whole
text.  Cutting and finding equal chunks run in Arrow.
"""

from __future__ import annotations

from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from skyrisk.llm.common import spread, starts

# White space as the tokenizers' regular expressions see it (fixed values).
SPACES = r"\t\n\x0b\x0c\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# Texts whose white space is more than single blanks and single line ends
# between words, or that hold the two marks used below: encoded whole.
IRREGULAR = (r"[\x01\x02]|^[ \n]|[ \n][ \n]|[ \n]$|[\t\x0b\x0c\r\x{85}\x{a0}\x{1680}"
             r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
TAIL = "([A-Za-zÀ-ÖØ-öø-ÿ])([.,!#%&*$|\"]+ )"  # a word's closing marks are a token of their own
# Tokenizers that drop white space: a run of letters ends before a mark, and a mark other
# than an apostrophe before a letter.  Texts that may hold a literal marker are not touched,
# nor those with combining marks: a few join a small letter, but not its capital.
CLOSING, OPENING, UNTOUCHED = r"([A-Za-zÀ-ÖØ-öø-ÿ])([!-/:-@\[-`{-~])", r"([!-&(-/:-@\[-`{-~])([A-Za-zÀ-ÖØ-öø-ÿ])", r"<\||\p{M}|\x{2be}"
# One word of these letters is one token of the pre-tokenisation, and normalisation
# changes nothing in it but its case: the library's model may have it at once.
WORD = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"


def byte_letters() -> np.ndarray:
    """The letter (code point) that stands for each byte in byte-level vocabularies: printable
    Latin-1 characters for themselves, the others from 256 upwards in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return np.array([b if b in own else next(rest) for b in range(256)], "<u2")


class CachedEncoder:
    """``encode(texts)`` -> ids of all texts in a row and each text's number of ids.

    Literal markers in a text get the ids that the library gives them.  Chunks are kept
    as numbers into one array of ids; a full cache is begun anew.
    """

    def __init__(self, path: str, word_ends: bool = False, cache: int = 400_000):
        """word_ends: the tokenizer drops white space (else byte-level with leading blanks).
        cache: chunks kept at most, besides those of one call."""
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        self.word_ends, self.cache = word_ends, cache
        self.words = Tokenizer(self.tok.model)  # takes words, one a line, spelt in byte letters
        self.words.pre_tokenizer = pre_tokenizers.Split("\n", "removed")
        self.letters = byte_letters()
        self.letters[10] = 10
        size = self.tok.get_vocab_size()
        spelt = [self.tok.id_to_token(i) or "" for i in range(size)]
        self.mark = np.array([t.endswith("</w>") if word_ends else t.startswith("\u0120") for t in spelt])
        self._begin()

    def _begin(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.at, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _chunks(self, texts: pa.Array) -> pa.ListArray:
        if self.word_ends:
            cut = pc.replace_substring_regex(pc.replace_substring_regex(pc.ascii_lower(texts), CLOSING, "\\1 \\2"), OPENING, "\\1 \\2")
            x = pc.if_else(pc.match_substring_regex(texts, UNTOUCHED), texts, cut)
            return pc.split_pattern(pc.replace_substring_regex(x, f"[{SPACES}]+", " "), " ")
        odd = pc.match_substring_regex(texts, IRREGULAR)
        whole = pa.array([f"\x02{i}" for i in range(len(texts))], pa.string())
        x = pc.binary_join_element_wise("\x01", pc.replace_substring(texts, "\n", " \n \x01"), "")
        x = pc.replace_substring_regex(x, TAIL, "\\1 \x01\\2")
        return pc.split_pattern(pc.if_else(odd, whole, x), " ")

    @staticmethod
    def _strings(chunks: pa.Array) -> list[str]:
        """Chunks as Python strings, made from one: none holds the blank they were cut at."""
        if not len(chunks):
            return []
        ends = pa.array([0, len(chunks)], pa.int32())
        return pc.binary_join(pa.ListArray.from_arrays(ends, chunks), " ")[0].as_py().split(" ")

    def _source(self, chunk: str, texts: pa.Array) -> str:
        if self.word_ends or chunk == "\n":
            return chunk
        if chunk[:1] == "\x02":
            return texts[int(chunk[1:])].as_py()
        return chunk[1:] if chunk[:1] == "\x01" else " " + chunk

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters (byte-level: each after a blank) and their numbers."""
        if not words:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        spelt = []
        for i in range(0, len(words), 4000):
            lines = "\n".join(words[i:i + 4000]).lower() if self.word_ends else " " + "\n ".join(words[i:i + 4000])
            spelt.append(self.letters[np.frombuffer(lines.encode(), np.uint8)].tobytes().decode("utf-16-le"))
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.words.encode_batch_fast(spelt, add_special_tokens=False)])
        edge = np.flatnonzero(self.mark[ids])
        return ids, np.diff(np.append(-1, edge) if self.word_ends else np.append(edge, len(ids)))

    def _learn(self, new: list[str], texts: pa.Array) -> None:
        plain = pc.match_substring_regex(pa.array(new, pa.string()), WORD).to_numpy(zero_copy_only=False)
        words = [new[i] for i in np.flatnonzero(plain).tolist()]
        rest = [new[i] for i in np.flatnonzero(~plain).tolist()]
        ids, size = self._encode_words(words)
        got = [e.ids for e in self.tok.encode_batch_fast([self._source(c, texts) for c in rest], add_special_tokens=False)]
        sizes = np.concatenate([size, np.fromiter(map(len, got), np.int64, len(got))])
        self.known.update(zip(chain(words, rest), range(len(self.size), len(self.size) + len(new))))
        self.at = np.concatenate([self.at, len(self.flat) + starts(sizes)[:-1]])
        self.size = np.concatenate([self.size, sizes])
        self.flat = np.concatenate([self.flat, ids, np.fromiter(chain.from_iterable(got), np.uint32)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts.cast(pa.string()), "")
        lists = self._chunks(texts)
        which = lists.flatten().dictionary_encode()
        chunks = self._strings(which.dictionary)
        if len(self.known) > self.cache:
            self._begin()
        number = np.fromiter(map(self.known.get, chunks, repeat(-1)), np.int64, len(chunks))
        new = np.flatnonzero(number < 0)
        if len(new):
            names = [chunks[i] for i in new.tolist()]
            self._learn(names, texts)
            number[new] = np.fromiter(map(self.known.get, names), np.int64, len(new))
            if not self.word_ends:
                for c in names:
                    if c[:1] == "\x02":  # stands for another text in the next call
                        del self.known[c]
        at = number[which.indices.to_numpy(zero_copy_only=False)]
        count = self.size[at]
        first = np.asarray(lists.offsets, dtype=np.int64)
        per_text = np.diff(starts(count)[first - first[0]])
        return spread(self.flat, self.at[at], count), per_text


_ENCODERS: dict[tuple, CachedEncoder] = {}


def encoder(path: str, word_ends: bool = False) -> CachedEncoder:
    """This Python worker's encoder; its cache lives as long as the worker."""
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    key = (path, word_ends)
    if key not in _ENCODERS:
        _ENCODERS[key] = CachedEncoder(path, word_ends)
    return _ENCODERS[key]
