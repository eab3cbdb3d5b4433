"""Secret scans: fixed rules, and a linear-chain conditional random field.

The rules find assignments, access keys and long hex runs.  The field tags every
token of a text as outside, begin or inside of a secret from the shapes of the
token and its neighbours and from features of the file; Viterbi decodes the tags.
It learns from lines that the rules tag and from made-up secrets of other shapes
set into sampled lines, and adds the spans that lie within no span of a rule.

A chain is a whole line, of any length.  Token scores depend on the token's
string and its neighbours' strings only, so they are computed once per string.

Rows: null and empty texts have no spans; repeated rows and rows without id are scanned
each; equal lines in files of equal features get equal tags, ties going to the lower tag;
an empty table gives no rows, its field being fitted on made-up secrets alone.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyrisk.llm.common import key_hash, keyed_text, slices, starts, thin, whole_rows
from skyrisk.session import scratch_path

# The base rules. Groups and least lengths as given; ASCII case only.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs, so the same as runs of 24 or more
KINDS = ("assign", "access", "hex")
_MAYBE = r"(?i)password|passwd|secret|token|api_?key"

SEPARATORS = "\t\x0b\x0c\r \"',;()<>|"
TOKEN = re.compile(f"[^{re.escape(SEPARATORS)}=:\n]+|[=:\n]")
OUT, BEGIN, INSIDE = range(3)
DOCS, LINES = 4000, 400  # documents and lines to learn from, at most
FEW = 6  # chains left over that advance faster one by one
REACH = (-2, -1, 0, 1)  # neighbours whose shapes count


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points by start, then kind as listed."""
    out = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return [(a, b, KINDS[k]) for a, b, k in sorted(out, key=lambda x: (x[0], x[2]))]


def values(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """(start, end) of the secrets themselves: for assignments, what is assigned."""
    return [ASSIGN.match(text, a).span(2) if kind == "assign" else (a, b) for a, b, kind in spans]


class Reach:
    """How far spans go that start at or before a place."""

    def __init__(self, spans: list[tuple[int, int]]):
        spans = sorted(spans)
        self.starts, self.ends = [a for a, _ in spans], list(accumulate((b for _, b in spans), max))

    def end(self, at: int) -> int:
        """The largest end of the spans that start at ``at`` or before; none: -1."""
        i = bisect_right(self.starts, at)
        return self.ends[i - 1] if i else -1


# ---------------------------------------------------------------- features
_SHAPES = ("lower", "upper", "title", "digits", "letters_digits", "three_kinds", "hex", "base64", "dotted", "dashed", "at_sign", "slash",
           "non_ascii", "keyword", "has_keyword", "long_name", "prefix", "equals", "colon", "line_end", "edge")
_SIZES, _ENTROPY, _DIGITS = (1, 3, 6, 9, 12, 16, 20, 24, 32, 48), (2.0, 2.7, 3.2, 3.6, 4.0), (0.01, 0.2, 0.4, 0.7)
WIDTH = len(_SHAPES) + len(_SIZES) + len(_ENTROPY) + len(_DIGITS)
_NAMES = re.compile(r"(?i)^(?:.*[_.-])?(?:password|passwd|pwd|secret|token|api_?key|auth|credential|access_?key|private_?key|bearer)$", re.A)
_IN_NAME = re.compile(r"(?i)passw|secret|token|key|auth|cred", re.A)
_PREFIX = re.compile(r"^(?:AKIA|ASIA|gh[pousr]_|xox[abp]-|sk[-_]|pk[-_]|eyJ|AIza|glpat-)")
_PLAIN = re.compile(r"[A-ZÀ-ÖØ-Þ]?[a-zß-öø-ÿ]+[.!?]*")
EDGE = np.zeros(WIDTH, np.float32)
EDGE[_SHAPES.index("edge")] = 1


def key(w: str) -> str | tuple[int, bool]:
    """What the features of a token depend on: ordinary words of up to 15 code points
    differ by length and first letter only, all other strings count as they are."""
    if len(w) < 16 and _PLAIN.fullmatch(w) and not _IN_NAME.search(w):
        return len(w), w[0].isupper()
    return w


def shape(w: str) -> np.ndarray:
    """Feature vector of one token string."""
    out = np.zeros(WIDTH, np.float32)
    k = key(w)
    n, end = len(w), len(_SHAPES)
    out[end + max(0, sum(n >= s for s in _SIZES) - 1)] = 1
    if k is not w:
        out[2 if k[1] else 0] = 1
        return out
    up, low, dig = (bool(re.search(p, w)) for p in ("[A-Z]", "[a-z]", "[0-9]"))
    out[:20] = (w.islower(), w.isupper(), w.istitle(), w.isdigit(), (up or low) and dig, up and low and dig,
                dig and re.fullmatch("[0-9a-f]{6,}|[0-9A-F]{6,}", w) is not None, n >= 16 and re.fullmatch("[A-Za-z0-9+/_-]+", w) is not None,
                "." in w, "-" in w or "_" in w, "@" in w, "/" in w, not w.isascii(), _NAMES.match(w) is not None, _IN_NAME.search(w) is not None,
                n > 3 and ("_" in w or w.isupper()), _PREFIX.match(w) is not None, w == "=", w == ":", w == "\n")
    end += len(_SIZES)
    if n >= 6:
        e = -sum(c / n * math.log2(c / n) for c in Counter(w).values())
        at = sum(e >= s for s in _ENTROPY)
        if at:
            out[end + at - 1] = 1
    end += len(_ENTROPY)
    at = sum(sum(c.isdigit() for c in w) / n >= s for s in _DIGITS) if n else 0
    if at:
        out[end + at - 1] = 1
    return out


def file_features(equals: np.ndarray, colons: np.ndarray, lines: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """By document: share of tokens that are = or :, whether lines are short, whether it is short."""
    n = np.maximum(tokens, 1)
    return np.stack([equals / n > 0.02, colons / n > 0.02, n / (lines + 1) < 6, n < 50], axis=1).astype(np.float32)


def file_counts(text: str) -> list[int]:
    """Numbers of =, :, line ends and tokens of one whole text, as ``file_features`` takes them."""
    return [text.count("="), text.count(":"), text.count("\n"), sum(1 for _ in TOKEN.finditer(text))]


# ---------------------------------------------------------------- the field
@dataclass
class Field:
    """``own[r]``: scores (feature, tag) of the token REACH[r] away; ``file``: (file feature, tag);
    ``move[a, b]``: from tag a to b; ``first``: a chain's first tag."""
    own: np.ndarray
    file: np.ndarray
    move: np.ndarray
    first: np.ndarray


FORBID = -1e4  # inside must follow begin or inside


def lanes(first: np.ndarray, size: np.ndarray):
    """Chains by falling length, and how many are longer than t for each t."""
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    live = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")
    return first, size, live


def viterbi(emit: np.ndarray, first: np.ndarray, size: np.ndarray, field: Field) -> np.ndarray:
    """Best tag of every token; chains (first token, number of tokens) advance together,
    the last FEW of them one by one."""
    tags = np.zeros(len(emit), np.uint8)
    first, size, live = lanes(first, size)
    if not len(size):
        return tags
    back = np.zeros((len(emit), 3), np.uint8)
    score = emit[first] + field.first
    together = max(1, int(np.searchsorted(-live, -FEW, side="left")))
    for t in range(1, together):
        k = live[t]
        a, b, c = (score[:k, i, None] + field.move[i] for i in range(3))
        ab, which = np.maximum(a, b), (b > a).astype(np.uint8)
        back[first[:k] + t] = np.where(c > ab, np.uint8(2), which)
        score[:k] = np.maximum(ab, c) + emit[first[:k] + t]
    tags[first + size - 1] = score.argmax(axis=1)
    for i in range(live[together] if together < len(live) else 0):
        alone(emit, back, tags, first[i] + together, first[i] + size[i], score[i], field.move)
    for t in range(together - 1, 0, -1):
        at = first[:live[t]] + t
        tags[at - 1] = back[at, tags[at]]
    return tags


def alone(emit: np.ndarray, back: np.ndarray, tags: np.ndarray, lo: int, hi: int, score: np.ndarray, move: np.ndarray) -> None:
    """``viterbi`` of one chain's tokens lo to hi, from the scores of the token before,
    whose tag is set too; in plain numbers, block by block."""
    now, into = score.tolist(), move.T.tolist()
    for at in range(lo, hi, 4096):
        part = bytearray()
        for own in emit[at:min(hi, at + 4096)].tolist():
            a, b, c = now
            for j, (x, y, z) in enumerate(into):
                best, which, z = a + x, 0, c + z
                if b + y > best:
                    best, which = b + y, 1
                if z > best:
                    best, which = z, 2
                part.append(which)
                now[j] = best + own[j]
        back[at:at + len(part) // 3] = np.frombuffer(bytes(part), np.uint8).reshape(-1, 3)
    tag = now.index(max(now))
    for end in range(hi, lo, -4096):
        begin = max(lo, end - 4096)
        got, part = bytearray(end - begin), back[begin:end].tobytes()
        for t in range(end - begin - 1, -1, -1):
            got[t] = tag
            tag = part[3 * t + tag]
        tags[begin:end] = np.frombuffer(bytes(got), np.uint8)
    tags[lo - 1] = tag


def marginals(emit: np.ndarray, first: np.ndarray, size: np.ndarray, field: Field):
    """(tag probabilities of each token, expected moves, expected first tags, log of the normaliser)."""
    first, size, live = lanes(first, size)
    fwd, rev = np.zeros_like(emit), np.zeros_like(emit)

    def add(x, axis):
        m = x.max(axis=axis, keepdims=True)
        return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)
    fwd[first] = emit[first] + field.first
    for t in range(1, len(live)):
        at = first[:live[t]] + t
        fwd[at] = add(fwd[at - 1][:, :, None] + field.move, 1) + emit[at]
    for t in range(len(live) - 1, 0, -1):
        at = first[:live[t]] + t
        rev[at - 1] = add((rev[at] + emit[at])[:, None, :] + field.move, 2)
    z = add(fwd[first + size - 1], 1)
    by = np.zeros(len(emit))
    for t in range(len(live)):
        by[first[:live[t]] + t] = z[:live[t]]
    moves = np.zeros((3, 3))
    for t in range(1, len(live)):
        at = first[:live[t]] + t
        moves += np.exp(fwd[at - 1][:, :, None] + field.move + (rev[at] + emit[at])[:, None, :] - by[at][:, None, None]).sum(axis=0)
    p = np.exp(fwd + rev - by[:, None])
    return p, moves, p[first].sum(axis=0), z.sum()


def fit(x: np.ndarray, g: np.ndarray, y: np.ndarray, first: np.ndarray, size: np.ndarray, rounds: int = 50, ridge: float = 0.05) -> Field:
    """Maximum likelihood with a ridge, by Adam on the full gradient.

    x: (token, REACH, feature), g: (token, file feature), y: tags."""
    f = x.reshape(len(x), -1)
    both = np.concatenate([f, g], axis=1, dtype=np.float32)
    w, move, start = np.zeros((both.shape[1], 3)), np.zeros((3, 3)), np.zeros(3)
    move[OUT, INSIDE] = start[INSIDE] = FORBID
    seen = both.T @ np.eye(3, dtype=np.float32)[y]
    later = np.setdiff1d(np.arange(len(y)), first)
    seen_move, seen_first = np.zeros((3, 3)), np.bincount(y[first], minlength=3)
    np.add.at(seen_move, (y[later - 1], y[later]), 1)
    parts = [[v, np.zeros_like(v), np.zeros_like(v)] for v in (w, move, start)]
    for t in range(1, rounds + 1):
        field = Field(parts[0][0][:f.shape[1]].reshape(len(REACH), -1, 3), parts[0][0][f.shape[1]:], parts[1][0], parts[2][0])
        p, moves, begins, _ = marginals((both @ parts[0][0].astype(np.float32)).astype(float), first, size, field)
        grads = (both.T @ p.astype(np.float32) - seen, moves - seen_move, begins - seen_first)
        for part, gr in zip(parts, grads):
            gr = np.where(part[0] <= FORBID / 2, 0, gr / len(size) + ridge / len(size) * part[0])
            part[1] = 0.9 * part[1] + 0.1 * gr
            part[2] = 0.99 * part[2] + 0.01 * gr ** 2
            part[0] = part[0] - 0.3 * (part[1] / (1 - 0.9 ** t)) / (np.sqrt(part[2] / (1 - 0.99 ** t)) + 1e-8)
    return Field(parts[0][0][:f.shape[1]].reshape(len(REACH), -1, 3), parts[0][0][f.shape[1]:], parts[1][0], parts[2][0])


# ---------------------------------------------------------------- learning
_ODD = re.compile("[0-9].{6}")  # strings with digits that no rule calls a secret


_MAIL = re.compile(r"[^@]+@[^@]+\.[A-Za-z]+\W*")


def _unknown(w: str) -> bool:
    """Random-looking strings with letters and digits: no rule calls them secrets, but they
    may be, so nothing is learned from their lines."""
    n = len(w)
    if n < 16 or not re.search("[0-9]", w) or not re.search("[A-Za-z]", w) or _MAIL.fullmatch(w):
        return False
    return -sum(c / n * math.log2(c / n) for c in Counter(w).values()) >= 3.2


_ALPHABETS = ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
              "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", "abcdefghijklmnopqrstuvwxyz0123456789-_")
_KEYS = ("password", "pwd", "secret", "token", "api_key", "auth_token", "client_secret", "access_key", "DB_PASSWORD", "bearer", "private_key")


def made_up(rng: np.random.Generator) -> tuple[list[str], list[int]]:
    """Tokens and tags of one made-up secret with or without a name before it."""
    letters = _ALPHABETS[rng.integers(len(_ALPHABETS))]
    value = "".join(letters[i] for i in rng.integers(0, len(letters), rng.integers(16, 48)))
    named = rng.random() < 0.8
    name = [_KEYS[rng.integers(len(_KEYS))], "=" if rng.random() < 0.6 else ":"] if named else []
    if not named:
        value = ("AKIA", "ghp_", "sk-", "xoxb-")[rng.integers(4)] + value
    return name + [value], [OUT] * len(name) + [BEGIN]


def tagged_lines(text: str) -> list[tuple[list[str], list[int]]]:
    """Token strings and tags of each line, tags from the base rules."""
    spans = values(text, base_spans(text))
    out, words, tags, last = [], [], [], None
    for m in TOKEN.finditer(text):
        if m[0] == "\n":
            out.append((words, tags))
            words, tags, last = [], [], None
            continue
        of = next((i for i, (a, b) in enumerate(spans) if m.start() < b and m.end() > a and m[0] not in "=:"), None)
        words.append(m[0])
        tags.append(OUT if of is None else INSIDE if of == last else BEGIN)
        last = of
    out.append((words, tags))
    return [(w, t) for w, t in out if w]


def _sampled(batches):
    """A few lines of each sampled document, with the counts of the whole document, by kind:
    with secrets, with other strings of digits, and the one of smallest hash."""
    for b in batches:
        rows = []
        for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            found = tagged_lines(text)
            plain = sorted((x for x in found if not any(x[1]) and not any(map(_unknown, x[0]))), key=lambda x: hashlib.md5(" ".join(x[0][:64]).encode()).digest())
            odd = [x for x in plain if any(map(_ODD.search, x[0]))]
            for kind, group in enumerate((plain[:1], odd[:2], [x for x in found if any(x[1])][:8])):
                for words, tags in group:
                    at = next((i for i, w in enumerate(words) if (tags[i] if kind == 2 else kind and _ODD.search(w))), 0)
                    lo = max(0, at - 24)
                    rows.append((doc, kind, words[lo:lo + 64], tags[lo:lo + 64], file_counts(text)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                                              pa.array([r[2] for r in rows], pa.list_(pa.string())), pa.array([r[3] for r in rows], pa.list_(pa.int32())),
                                              pa.array([r[4] for r in rows], pa.list_(pa.int64()))], names=["doc_id", "kind", "words", "tags", "file"])


def train(docs: DataFrame, documents: int = DOCS, most: int = LINES) -> Field:
    """The field, from lines of at most ``documents`` documents (smallest id hashes),
    at most ``most`` of each kind, plus made-up secrets, each in a line of its document
    and in a text of that line only: few sampled documents are that short.

    A document gives at most 8 lines with secrets, 2 with other strings of digits and one
    plain line, each cut to the 64 tokens from 24 before its first such string on.  Lines
    with random-looking strings that no rule knows are left out."""
    d = keyed_text(docs)
    ids = thin(d.select("doc_id").where("doc_id is not null"), "doc_id", documents).distinct() \
        .orderBy(key_hash("doc_id"), "doc_id").limit(documents)
    at = scratch_path(docs.sparkSession, "secret-lines")
    schema = "doc_id long, kind int, words array<string>, tags array<int>, file array<long>"
    d.join(F.broadcast(ids), "doc_id").select("doc_id", "text").mapInArrow(_sampled, schema).write.parquet(at)
    got = []
    for kind in range(3):
        part = docs.sparkSession.read.schema(schema).parquet(at).where(F.col("kind") == kind)
        got += [(list(r["words"]), list(r["tags"]), list(r["file"])) for r in part.orderBy(F.xxhash64("doc_id", "words"), "doc_id").limit(most).collect()]
    rng = np.random.default_rng(11)
    plain = [(w, f) for w, t, f in got if not any(t)] or [(["lorem", "ipsum", "dolor", "sit", "amet"], [0, 0, 0, 5])]
    for i in range(max(200, most)):
        base, file = plain[i % len(plain)]
        k = int(rng.integers(len(base) + 1))
        words, tags = made_up(rng)
        line, marks = base[:k] + words + base[k:], [OUT] * k + tags + [OUT] * (len(base) - k)
        file = [n + m for n, m in zip(file, (words.count("="), words.count(":"), 0, len(words)))]
        got += [(line, marks, file), (line, marks, [line.count("="), line.count(":"), 0, len(line)])]
    return fit(*design(got))


def design(chains: list[tuple[list[str], list[int], list[int]]]):
    """(token features with neighbours, file features, tags, first tokens, sizes) of training
    chains: their tokens, tags and the ``file_counts`` of the documents they are from."""
    size = np.array([len(w) for w, _, _ in chains], np.int64)
    first = starts(size)[:-1]
    of = {w: shape(w) for ws, _, _ in chains for w in ws}
    x = np.zeros((int(size.sum()), len(REACH), WIDTH), np.float32)
    for f, (ws, _, _) in zip(first, chains):
        own = np.stack([of[w] for w in ws])
        for r, d in enumerate(REACH):
            x[f:f + len(ws), r] = EDGE
            lo, hi = max(0, -d), min(len(ws), len(ws) - d)
            if lo < hi:
                x[f + lo:f + hi, r] = own[lo + d:hi + d]
    g = file_features(*np.array([n for _, _, n in chains]).T)
    return x, np.repeat(g, size, axis=0), np.concatenate([np.array(t, np.int64) for _, t, _ in chains]), first, size


# ---------------------------------------------------------------- scanning
class Scanner:
    """Tags the tokens of many texts; scores of token strings are kept between calls."""

    def __init__(self, field: Field, cache: int = 100_000):
        self.field, self.cache = field, cache
        self.known: dict[str | tuple, np.ndarray] = {}
        self.weights = field.own.transpose(1, 0, 2).reshape(WIDTH, -1)
        self.edge = EDGE @ self.weights

    def tags(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(tag of every token in a row, number of tokens of each text)."""
        x = texts
        for c in "=:\n":
            x = pc.replace_substring(x, c, f" {c} ")
        x = pc.replace_substring_regex(x, f"[{re.escape(SEPARATORS)}]+", " ")
        lists = pc.split_pattern(pc.utf8_trim(x, " "), " ")
        which = lists.flatten().dictionary_encode()
        words = which.dictionary.to_pylist()
        if len(self.known) > self.cache:
            self.known = {}
        rows = []
        for w in words:
            k = key(w)
            row = self.known.get(k)
            if row is None:
                row = self.known[k] = shape(w) @ self.weights
            rows.append(row)
        code = which.indices.to_numpy(zero_copy_only=False)
        n = np.diff(np.asarray(lists.offsets, dtype=np.int64))
        empty = n == 1
        if empty.any():  # an empty text splits into one empty string
            at = starts(n)[:-1][empty]
            empty[np.flatnonzero(empty)] = [words[code[i]] == "" for i in at]
            keep = np.ones(len(code), bool)
            keep[starts(n)[:-1][empty]] = False
            code, n = code[keep], np.where(empty, 0, n)
        if not len(code):
            return np.zeros(0, np.uint8), n
        place = {w: i for i, w in enumerate(words)}
        mark = [code == place.get(c, -1) for c in "=:\n"]
        cut = starts(n)
        total = [np.diff(starts(m.astype(np.int64))[cut]) for m in mark]
        emit = np.repeat(file_features(*total, n) @ self.field.file, n, axis=0)
        table = np.stack(rows).reshape(len(words), len(REACH), 3)
        side = self.edge.reshape(len(REACH), 3)
        line_end = mark[2]
        # a neighbour counts if it is in the same line of the same text
        begins = np.zeros(len(code), bool)
        begins[cut[:-1][n > 0]] = True
        begins |= np.append(False, line_end[:-1]) | line_end
        line = np.cumsum(begins)
        for r, d in enumerate(REACH):
            got = np.broadcast_to(side[r], emit.shape).copy()
            lo, hi = max(0, -d), min(len(code), len(code) - d)
            same = np.flatnonzero(line[lo:hi] == line[lo + d:hi + d]) + lo
            got[same] = table[code[same + d], r]
            emit += got
        first = np.flatnonzero(begins)
        return viterbi(emit, first, np.diff(np.append(first, len(code))), self.field), n

    def spans(self, texts: pa.Array) -> list[list[tuple[int, int, str]]]:
        """All spans of each text: the base ones, and those of the field that no base span
        contains.  As in training, a token that a base value touches is secret as a whole."""
        out: list[list] = [[] for _ in range(len(texts))]
        maybe = pc.or_(pc.match_substring_regex(texts, _MAYBE), pc.or_(pc.match_substring(texts, "AKIA"), pc.match_substring_regex(texts, "[0-9a-f]{24}")))
        for i in np.flatnonzero(np.asarray(maybe)):
            out[i] = base_spans(texts[int(i)].as_py())
        tags, n = self.tags(texts)
        cut = starts(n)
        hot = np.diff(starts((tags > 0).astype(np.int64))[cut]) > 0
        hot |= np.fromiter(map(bool, out), bool, len(out))
        for i in np.flatnonzero(hot):
            base, got, text = out[i], [], texts[int(i)].as_py()
            within, value = Reach([(a, b) for a, b, _ in base]), Reach(values(text, base))
            for m, tag in zip(TOKEN.finditer(text), tags[cut[i]:cut[i + 1]]):
                a, b = m.span()
                if tag == INSIDE and got:
                    got[-1][1] = b
                elif tag == BEGIN or m[0] not in "=:\n" and value.end(b - 1) > a:
                    got.append([a, b])
            got = [(a, b, "crf") for a, b in got if within.end(a) < b]
            rank = {k: j for j, k in enumerate((*KINDS, "crf"))}
            out[i] = sorted(base + got, key=lambda x: (x[0], rank[x[2]], x[1]))
        return out


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scanned(docs: DataFrame, documents: int = DOCS) -> DataFrame:
    """(doc_id, spans) of every row's whole text: structs (start, end, kind) in code
    points, end exclusive, kind ``crf`` for added ones.  Null texts count as empty."""
    field = train(docs, documents)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def run(batches):
        scan = Scanner(field)
        for b in slices(batches):
            got = [[{"start": a, "end": e, "kind": k} for a, e, k in s] for s in scan.spans(b.column("text").cast(pa.string()))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(got, kind)], names=["doc_id", "spans"])
    return keyed_text(docs).mapInArrow(run, "doc_id long, spans array<struct<start:long,end:long,kind:string>>")


def digested(docs: DataFrame, documents: int = DOCS) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) from ``scanned``."""
    def of(kind):
        return F.filter("spans", lambda s: s["kind"] == kind)

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != "crf")
    return scanned(docs, documents).select("doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS],
                                           F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def redacted(text: str, spans: list[tuple[int, int, str]], mark: str = "[secret]") -> str:
    """The text with every run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for a, b, _ in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, documents: int = DOCS) -> DataFrame:
    """``docs`` with secrets replaced in ``text`` and ``n_chars`` (if there) counted anew."""
    field, names = train(docs, documents), docs.columns
    at, count = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches):
        scan = Scanner(field)
        for b in batches:
            if not b.num_rows:
                continue
            cols = list(b.columns)
            old = cols[at].to_pylist()
            new, clean = list(old), pa.array([t or "" for t in old], pa.string())
            i = 0
            for part in slices([pa.RecordBatch.from_arrays([clean], names=["text"])]):
                for s in scan.spans(part.column("text")):
                    if s:
                        new[i] = redacted(old[i], s)
                    i += 1
            cols[at] = pa.array(new, cols[at].type)
            if count is not None:
                n = cols[count].to_pylist()
                cols[count] = pa.array([len(t) if t is not o else k for t, o, k in zip(new, old, n)], cols[count].type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)
    return whole_rows(docs, run)
