"""Toxicity by weak supervision.

Many voters, one per lexicon word, learned stem or pattern, each say "toxic" or nothing.
A generative model of the votes given a hidden class estimates how often each voter
fires on either class and how strongly pairs fire together beyond that; correlated
voters share their evidence.  It is fitted by expectation-maximisation on the votes alone,
over a sample of all documents.  Its posterior labels train a linear classifier, which
scores every document.  Labels only say which stems of invented words become voters, which
of the two classes is the toxic one, and where the score's scale lies.

Bounds (parameters): ``SAMPLE`` documents and as many labelled rows are learned from, the
smallest by a hash of the id; ``LEARNED`` stems become voters, the best of 20 times as
many candidates.

Rows: null, empty and blank texts have no votes; repeated rows come out each and count
each in the sample; rows without id are scored and never learned from; texts of any length
are read whole; equal votes give equal scores.  Without labels of both kinds the lexicon
alone speaks; without documents the result is empty.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyrisk.llm.common import fold, key_hash, keyed_text, labelled_texts, slices, thin
from skyrisk.session import scratch_path

SAMPLE = 20_000  # documents the label model is fitted on, and labelled rows, at most each

# Insults and slurs of the four languages of the corpus, lower case.
LEXICON = {
    "en": """idiot idiots moron morons stupid dumb loser losers scum trash garbage worthless pathetic disgusting clown clowns
        imbecile jerk fool fools freak filth filthy vermin pig pigs bastard bitch crap damn hate ugly liar lunatic maggot parasite
        psycho retard scumbag shit sucker traitor useless vile whore wretch""",
    "de": """arschloch blödmann depp dreckig dumm dummkopf ekelhaft erbärmlich feigling hässlich hure idioten
        lügner miststück narr scheiße schlampe schwachkopf schwein trottel versager wertlos widerlich""",
    "fr": """abruti bâtard connard connasse crétin débile dégoûtant imbécile merde minable ordure pathétique pourriture
        putain pute raté salaud salope stupide""",
    "es": """asqueroso basura cabrón cerdo despreciable estúpido gilipollas idiota imbécil inútil maldito mierda
        patético perdedor puta zorra""",
}
WORDS = sorted({w for line in LEXICON.values() for w in line.split()})
#: Shapes that go with abuse, on the lower-cased text; INSULT stands for any lexicon word.
PATTERNS = {
    "you_insult": r"\byou(?:'re| are)?(?: an?| such an?| the)? INSULT\b",
    "insult_pair": r"\bINSULT(?:[ ,]+(?:and |the |of |an? ){0,2})INSULT\b",
    "insult_shout": r"\bINSULT ?[!?]{1,}",
    "article_insult": r"\b(?:an?|the|such|what|total|complete|der|die|das|le|la|un|une|el|los) INSULT\b",
    "get_lost": r"\b(?:shut up|get lost|go to hell|drop dead|kill yourself)\b",
}
#: Voters on the number of different words hit in a text, of lexicon words and learned stems together.
COUNTS = ("two_hits", "three_hits", "hit_in_400", "hit_in_200", "hit_in_100", "hit_in_50")
SHORTEST, LONGEST = 3, 10  # code points of a learned stem
WORDS_OF_STEM = 2  # different words of a stem that make its voter speak: one may be an ordinary word
LEARNED = 256  # learned stems, at most
_ANY = "(?:" + "|".join(map(re.escape, sorted(WORDS, key=len, reverse=True))) + ")"
_PATTERNS = [re.compile(p.replace("INSULT", _ANY)) for p in PATTERNS.values()]


def words(texts: pa.Array) -> pa.ListArray:
    """Lower-cased runs of letters, digits and underscores; empty strings at the edges."""
    return pc.split_pattern(pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\p{L}\p{N}_]+", " "), " ")


def beginnings(word: str) -> list[str]:
    return [word[:k] for k in range(SHORTEST, min(LONGEST, len(word)) + 1)]


class Voters:
    """All voters: lexicon words, learned stems, patterns, counts of hits."""

    def __init__(self, learned: list[str]):
        self.learned = sorted(learned)
        self.names = [f"word_{w}" for w in WORDS] + [f"stem_{w}" for w in self.learned] + list(PATTERNS) + list(COUNTS)
        self.word = {w: i for i, w in enumerate(WORDS)}
        self.begin = {w: len(WORDS) + i for i, w in enumerate(self.learned)}

    def hits(self, word: str) -> list[int]:
        """Voters that a word sets off."""
        out = [self.begin[x] for x in beginnings(word) if x in self.begin]
        if word in self.word:
            out.append(self.word[word])
        return out

    def votes(self, texts: pa.Array) -> np.ndarray:
        """0/1 of every voter (columns) on every whole text (rows)."""
        out = np.zeros((len(texts), len(self.names)), np.float32)
        lists = words(texts)
        which = lists.flatten().dictionary_encode()
        of = [self.hits(w) for w in which.dictionary.to_pylist()]
        first = np.asarray(lists.offsets, dtype=np.int64)
        length = np.diff(first)
        hit = np.fromiter(map(bool, of), bool, len(of))
        code = which.indices.to_numpy(zero_copy_only=False)
        at = np.flatnonzero(hit[code]) if len(code) else np.zeros(0, np.int64)
        row = np.searchsorted(first - first[0], at, side="right") - 1
        row, at = np.divmod(np.unique(row * max(1, len(of)) + code[at]), max(1, len(of)))  # each word once a text
        for r, c in zip(row, at):
            out[r, of[c]] += 1
        stems = out[:, len(WORDS):len(WORDS) + len(self.learned)]
        stems[stems < WORDS_OF_STEM] = 0  # a silent stem's words are no hits either
        k = len(WORDS) + len(self.learned)
        number = out[:, :k].sum(axis=1).astype(np.int64)
        np.minimum(stems, 1, out=stems)
        for r in np.flatnonzero(number | np.asarray(pc.match_substring_regex(pc.utf8_lower(texts), PATTERNS["get_lost"]))):
            low = texts[int(r)].as_py().lower()
            out[r, k:k + len(PATTERNS)] = [p.search(low) is not None for p in _PATTERNS]
        k += len(PATTERNS)
        out[:, k:] = np.stack([number >= 2, number >= 3, *(number * n > length for n in (400, 200, 100, 50))], axis=1)
        return out


@dataclass
class LabelModel:
    """``fire[c, j]``: how often voter j fires on class c; ``share``: what part of its own
    evidence each voter keeps besides those it goes along with; ``prior`` of class 1."""
    fire: np.ndarray
    share: np.ndarray
    prior: float
    correlation: np.ndarray

    def log_odds(self, v: np.ndarray) -> np.ndarray:
        on = np.log(self.fire[1] / self.fire[0]) * self.share
        off = np.log((1 - self.fire[1]) / (1 - self.fire[0])) * self.share
        return np.log(self.prior / (1 - self.prior)) + v @ on + (1 - v) @ off


def fit_label_model(v: np.ndarray, rounds: int = 60) -> tuple[LabelModel, np.ndarray]:
    """(model, posterior of class 1 for each row) by expectation-maximisation on votes alone.

    It begins with the rows that two or more voters speak on as class 1, then each round
    estimates firing rates by class from the posterior, the correlation of every two voters
    within the classes, and the posterior anew.  A voter's share is 1 over 1 plus its
    positive correlations with the others, so a clique of copies counts once.
    """
    q = np.where(v.sum(axis=1) >= 2, 0.9, 0.02)
    model = None
    for _ in range(rounds):
        w = np.stack([1 - q, q])
        fire = np.clip((w @ v + 0.1) / (w.sum(axis=1, keepdims=True) + 1.0), 1e-5, 1 - 1e-5)
        within = np.zeros((v.shape[1],) * 2)
        for c in (0, 1):
            d = (v - fire[c]) * np.sqrt(w[c])[:, None]
            within += d.T @ d
        scale = np.sqrt(np.maximum(np.diag(within), 1e-9))
        corr = within / scale[:, None] / scale[None, :]
        np.fill_diagonal(corr, 0)
        share = 1 / (1 + np.where(corr > 0.05, corr, 0).sum(axis=1))
        model = LabelModel(fire, share, float(np.clip(q.mean(), 1e-3, 0.5)), corr)
        new = 1 / (1 + np.exp(-np.clip(model.log_odds(v), -50, 50)))
        moved = np.abs(new - q).max()
        q = new
        if moved < 1e-4:
            break
    return model, q


@dataclass
class Linear:
    weight: np.ndarray
    bias: float

    def score(self, v: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(v @ self.weight + self.bias, -50, 50)))


def fit_linear(v: np.ndarray, q: np.ndarray, prior: np.ndarray, steps: int = 20, ridge: float = 2.0) -> Linear:
    """Logistic regression on posterior labels by Newton's method; weights are held
    near ``prior``, so voters that the sample never sets off keep theirs."""
    x = np.column_stack([v, np.ones(len(v))])
    w, first = np.append(prior, -4.0), np.append(prior, -4.0)
    hold = np.append(np.full(len(prior), ridge), 1e-3)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        grad = x.T @ (p - q) + hold * (w - first)
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(hold), grad)
        w = w - step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-4:
            break
    return Linear(w[:-1], float(w[-1]))


def fit_scale(z: np.ndarray, y: np.ndarray, steps: int = 30) -> tuple[float, float]:
    """(slope, shift) so that 1 / (1 + exp(-(slope * z + shift))) fits the labels y (Newton's method,
    held near slope 1 and shift 0)."""
    x, w = np.column_stack([z, np.ones(len(z))]), np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        grad = x.T @ (p - y) + 1e-2 * (w - [1.0, 0.0])
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2), grad)
        w = w - step * min(1.0, 2 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return float(max(w[0], 0.05)), float(w[1])


def _mined(batches):
    """(stem, toxic documents, other documents) of this task's labelled texts, of documents
    with as many different words of the stem as its voter needs."""
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for b in batches:
        for own, label in zip(words(b.column("text").cast(pa.string())).to_pylist(), b.column("label").to_pylist()):
            of = Counter(x for w in set(own) for x in beginnings(w))
            seen[label > 0].update([x for x, n in of.items() if n >= WORDS_OF_STEM])
    names = list(seen[0].keys() | seen[1].keys())
    for i in range(0, len(names), 100_000):
        part = names[i:i + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(part), *(pa.array([seen[k][n] for n in part], pa.int64()) for k in (1, 0))],
                                         names=["begin", "toxic", "other"])


def learn_stems(texts: DataFrame, most: int = LEARNED) -> list[str]:
    """Stems whose words mark toxic texts in (text, label) rows.

    Kept are those whose documents are toxic more often than not, judged by
    the lower bound of their log odds against the others, and found in four or
    more (and one in 200) of the toxic documents, so that a few copies of one
    text teach nothing; of stems of one another only the one that tells
    most, the longer on a tie.
    """
    n = texts.agg(F.sum(F.when(F.col("label") > 0, 1).otherwise(0)).alias("t"), F.count("*").alias("n")).first()
    t, c = n["t"] or 0, (n["n"] or 0) - (n["t"] or 0)
    if not t or not c:
        return []
    z = F.log((F.col("toxic") + 0.5) / (t + 1.0)) - F.log((F.col("other") + 0.5) / (c + 1.0)) \
        - 1.64 * F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("other") + 0.5))
    rows = texts.select("text", "label").mapInArrow(_mined, "begin string, toxic long, other long").groupBy("begin") \
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).where(F.col("toxic") >= max(4, t // 200)) \
        .withColumn("z", z).where("z > 1.5").orderBy(F.desc(F.col("z") + 0.3 * F.log("toxic")), "begin").limit(20 * most).collect()
    worth = {r["begin"]: r["z"] * r["toxic"] ** 0.5 for r in rows}
    kept: list[str] = []
    for w in sorted(worth, key=lambda w: (-worth[w], -len(w), w)):
        if not any(w.startswith(k) or k.startswith(w) for k in kept):
            kept.append(w)
    return kept[:most]


def _voted(voters: Voters):
    def run(batches):
        for b in slices(batches):
            v = voters.votes(b.column("text").cast(pa.string()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([np.flatnonzero(r).tolist() for r in v], pa.list_(pa.int32())), b.column("label")],
                                             names=["doc_id", "on", "label"])
    return run


def _votes(texts: DataFrame, voters: Voters) -> tuple[np.ndarray, np.ndarray]:
    """(votes, label or -1) of at most ``SAMPLE`` rows of (doc_id, text, label), in an order of their own."""
    rows = texts.mapInArrow(_voted(voters), "doc_id long, on array<int>, label int").collect()
    rows = sorted((r["doc_id"], r["on"], -1 if r["label"] is None else r["label"]) for r in rows)
    v = np.zeros((len(rows), len(voters.names)))
    for i, r in enumerate(rows):
        v[i, r[1]] = 1
    return v, np.array([r[2] for r in rows], np.float64)


@dataclass
class Toxicity:
    voters: Voters
    model: LabelModel | None
    linear: Linear


def train(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> Toxicity:
    """Voters from at most ``limit`` labelled rows outside the held-out fold, the label model
    and classifier from the votes on at most ``limit`` of all documents.

    Without rows of both labels the lexicon alone speaks, every voter alike."""
    spark = docs.sparkSession
    at = [scratch_path(spark, "toxic-" + n) for n in ("labelled", "sample")]
    labelled_texts(docs, labels, "toxic", limit).select("doc_id", "text", "label").write.parquet(at[0])
    some = thin(keyed_text(docs).where("doc_id is not null"), "doc_id", limit)
    some.orderBy(key_hash("doc_id"), "doc_id", "text").limit(limit).select("doc_id", "text", F.lit(None).cast("int").alias("label")).write.parquet(at[1])
    known, some = (spark.read.schema("doc_id long, text string, label int").parquet(p) for p in at)
    voters = Voters(learn_stems(known))
    v, y = _votes(known, voters)
    prior = np.array([1.0 if n.startswith("word_") else 0.0 for n in voters.names])
    if not len(y) or not 0 < y.sum() < len(y):
        prior[[i for i, n in enumerate(voters.names) if n.startswith("word_")]] = 4.5
        return Toxicity(voters, None, Linear(prior, -4.0))
    votes, _ = _votes(some, voters)
    model, q = fit_label_model(votes)
    linear = fit_linear(votes, q, prior)
    z = v @ linear.weight + linear.bias
    if z[y == 1].mean() < z[y == 0].mean():  # class 1 is the other one
        linear = Linear(-linear.weight, -linear.bias)
        z = -z
    slope, shift = fit_scale(z, y)
    return Toxicity(voters, model, Linear(linear.weight * slope, linear.bias * slope + shift))


def score(docs: DataFrame, toxicity: Toxicity) -> DataFrame:
    """(doc_id, score) of every row; null and empty texts have no votes."""
    voters, linear = toxicity.voters, toxicity.linear

    def run(batches):
        for b in slices(batches):
            v = voters.votes(b.column("text").cast(pa.string())).astype(float)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(linear.score(v))], names=["doc_id", "score"])
    return keyed_text(docs).mapInArrow(run, "doc_id long, score double")


def classified(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted)."""
    return score(docs, train(docs, labels, limit)).select(
        "doc_id", (fold("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
