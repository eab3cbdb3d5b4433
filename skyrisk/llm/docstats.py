"""Statistics of one whole text, as used by the quality operators."""

from __future__ import annotations

import numpy as np

SYMBOLS = b"#*$%&|<>"
#: Columns of ``statistics``: shares and means, none of them the length itself.
NAMES = ("mean_word", "long_words", "short_words", "symbols", "digits", "upper", "marks", "non_ascii", "blanks", "repeat_words",
         "distinct_words", "top_word", "dup_lines", "line_words", "line_spread", "upper_words", "marked_words", "ended_lines", "same_next")


def rules(text: str) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words); words are
    maximal runs without the six ASCII blanks."""
    return _measure(text)[0]


def _repeated(ids: np.ndarray) -> np.ndarray:
    """Which words stand in a three-word window found twice or more."""
    n = len(ids)
    out = np.zeros(n, bool)
    if n < 4:
        return out
    m = int(ids.max()) + 1
    if m < 1 << 20:
        key = (ids[:-2] * m + ids[1:-1]) * m + ids[2:]
    else:
        _, pair = np.unique(ids[:-2] * m + ids[1:-1], return_inverse=True)
        key = pair * m + ids[2:]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    at = np.concatenate([order[1:][same], order[:-1][same]])
    for k in range(3):
        out[at + k] = True
    return out


def _measure(text: str):
    """(rules, words, lines with a word, byte counts, code points, blanks among them,
    each word's number, the numbers) of one text."""
    raw = text.encode()
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    chars = int(count.sum() - count[0x80:0xC0].sum())
    blanks = int(count[9:14].sum() + count[32])
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    hit = _repeated(ids)
    base = (len(words), chars - blanks, sum(int(count[c]) for c in SYMBOLS), len(lines) - len(set(lines)), int(hit.sum()))
    return base, words, lines, count, chars, blanks, ids, number


def statistics(text: str) -> tuple[tuple[int, int, int, int, int], np.ndarray]:
    """(rules, one value per name in NAMES); all values of a text without words are 0."""
    base, words, lines, count, chars, blanks, ids, number = _measure(text)
    n = len(words)
    if not n:
        return base, np.zeros(len(NAMES), np.float32)
    size = np.fromiter(map(len, words), np.int64, n)
    solid = max(1, chars - blanks)
    per = np.array([len(x.split()) for x in lines], np.float64)
    last = np.fromiter((w[-1] for w in words), np.uint8, n)
    marked = ((last >= 33) & (last <= 47) | (last >= 58) & (last <= 64)) & (last != 44) & (last != 46)
    upper = sum(w.isupper() and len(w) > 1 for w in number) / len(number)
    marks = count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum()
    return base, np.array([
        size.mean(), (size > 24).mean(), (size == 1).mean(), base[2] / solid, count[48:58].sum() / solid, count[65:91].sum() / solid,
        marks / solid, (chars - count[:128].sum()) / solid, blanks / chars, base[4] / n, len(number) / n, np.bincount(ids).max() / n,
        base[3] / max(1, len(lines)), per.mean(), per.std() / per.mean(), upper, marked.mean(),
        sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines) / len(lines), (ids[1:] == ids[:-1]).mean() if n > 1 else 0.0], np.float32)
