"""Chat formatting with a loss mask aligned to token offsets.

A conversation is rendered whole, turn after turn, and encoded once with offsets.  The
spans of the assistant texts and of the tokens are both sorted, so binary search finds
the tokens that meet each assistant text; where a token reaches beyond it, the mask keeps
only the part inside.  What stands under the mask is each assistant text, no more, no less.

Template (fixed): a user turn is ``[INST] text [/INST]``, an assistant turn
``<s>text</s>``, any other role ``[ROLE]role[TEXT]text[/ROLE]``, each closed by a line end.
A control string inside a role or text gets a backslash after its first character, one
with backslashes there gets one more; taking one away restores it.

Rows: turns are ordered by turn (null first), equal ones by a hash of role and text;
repeated rows are turns of their own.  Null roles and texts count as empty, rows with a null conv_id are one
conversation.  An empty table gives no rows.  A conversation of over ``SEGMENT`` bytes is
dealt over tasks by its turns and comes out as several rows (``segment`` ascending), cut
between turns, where the line ends make the tokenizer cut too: ids and masks of its
segments in a row are those of the whole.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyrisk.llm.common import pick, starts
from skyrisk.session import scratch_path

SEGMENT = 4 << 20    # bytes
KNOWN = 100_000      # ids of long conversations that may be broadcast
ENCODE = 1 << 20     # code points encoded at once
CONTROL = re.compile(r"([\[<])(\\*)(/?INST\]|/?ROLE\]|TEXT\]|/?s>)")
ESCAPED = re.compile(r"([\[<])\\(\\*)(/?INST\]|/?ROLE\]|TEXT\]|/?s>)")
TURN = re.compile(r"\[INST\] (.*?) \[/INST\]\n|<s>(.*?)</s>\n|\[ROLE\](.*?)\[TEXT\](.*?)\[/ROLE\]\n", re.S)
FORMATTED = {"conv_id": "long", "segment": "long", "n_turns": "int", "text": "string", "ids": "array<int>", "starts": "array<int>",
             "ends": "array<int>", "loss_token": "array<int>", "loss_start": "array<int>", "loss_end": "array<int>"}
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: str) -> str:
    return CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn's text and where the escaped text that is trained on begins and ends in it."""
    if role == "user":
        return f"[INST] {escape(text)} [/INST]\n", 0, 0
    if role == "assistant":
        body = escape(text)
        return f"<s>{body}</s>\n", 3, 3 + len(body)
    return f"[ROLE]{escape(role)}[TEXT]{escape(text)}[/ROLE]\n", 0, 0


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a rendered text."""
    out, at = [], 0
    for m in TURN.finditer(text):
        if m.start() != at:
            break
        user, assistant, role, other = m.groups()
        out.append(("user", unescape(user)) if user is not None else ("assistant", unescape(assistant)) if assistant is not None
                   else (unescape(role), unescape(other)))
        at = m.end()
    if at != len(text):
        raise ValueError(f"no turn at {at}")
    return out


def loss_mask(span_start, span_end, token_start, token_end) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, start, end): the tokens that meet a span and their parts inside it.

    Spans are sorted and disjoint; token starts and ends ascend (the bytes of one code
    point may be several tokens with the same offsets)."""
    first = np.searchsorted(token_end, span_start, side="right")
    last = np.searchsorted(token_start, span_end, side="left")
    count = np.maximum(last - first, 0)
    own = np.repeat(np.arange(len(count)), count)
    token = np.arange(int(count.sum())) - np.repeat(starts(count)[:-1], count) + first[own]
    lo, hi = np.maximum(token_start[token], span_start[own]), np.minimum(token_end[token], span_end[own])
    some = hi > lo
    return token[some], lo[some], hi[some]


def covered(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Union of the parts under a mask, as disjoint stretches."""
    if not len(start):
        return []
    far = np.maximum.accumulate(end)
    cut = np.flatnonzero(start[1:] > far[:-1]) + 1
    return list(zip(start[np.append(0, cut)].tolist(), far[np.append(cut - 1, len(far) - 1)].tolist()))


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, tie, role, text); ``tie`` orders equal turns by keys of fixed width."""
    d = pick(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    return d.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *text) \
        .select("conv_id", "turn", F.xxhash64("role", "text").alias("tie"), "role", "text")


def _column(values, kind: pa.DataType) -> pa.Array:
    """An Arrow column; lists are put together at once."""
    if not pa.types.is_list(kind):
        return pa.array(values, kind)
    ends = starts(np.fromiter(map(len, values), np.int64, len(values)))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.asarray(v, np.int32) for v in values])))


_TOKENIZERS: dict[str, object] = {}


def _tokenizer(path: str):
    if path not in _TOKENIZERS:
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True  # the library's own markers are ordinary text here
        _TOKENIZERS[path] = tok
    return _TOKENIZERS[path]


ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}


def _format(path: str, several: bool, names: list[str]):
    """Formatted rows; of their columns only ``names`` leave the task."""
    types = [ARROW[FORMATTED[n]] for n in names]

    def encoded(ready):
        rows = []
        for (conv, segment, text, spans), e in zip(ready, _tokenizer(path).encode_batch([r[2] for r in ready], add_special_tokens=False)):
            at = np.fromiter(chain.from_iterable(e.offsets), np.int32, 2 * len(e)).reshape(-1, 2)
            span = np.array([s for s in spans if s[1] > s[0]], np.int64).reshape(-1, 2)
            mask = loss_mask(span[:, 0], span[:, 1], at[:, 0], at[:, 1])
            lists = [m.astype(np.int32) for m in mask]
            row = dict(zip(FORMATTED, (conv, segment, len(spans), text, e.ids if "ids" in names else None, at[:, 0], at[:, 1], *lists)))
            rows.append([row[n] for n in names])
        return pa.RecordBatch.from_arrays([_column(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches):
        base, number, held = TaskContext.get().partitionId() << 32, 0, 0
        ready, parts, spans, size, weight, conv = [], [], [], 0, 0, None

        def close():
            nonlocal number, held, size, weight, parts, spans
            ready.append((conv, base + number if several else 0, "".join(parts), spans))
            number, held, size, weight, parts, spans = number + 1, held + size, 0, 0, [], []
        for b in batches:
            for key, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if spans and (key != conv or several and weight > SEGMENT):
                    close()
                if held > ENCODE:
                    yield encoded(ready)
                    ready, held = [], 0
                conv = key
                part, lo, hi = render_turn(role, text)
                parts.append(part)
                spans.append((size + lo, size + hi))
                size, weight = size + len(part), weight + 4 * len(part)
        if spans:
            close()
        if ready:
            yield encoded(ready)
    return run


def _split(conversations: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary conversations and, if there are any, of long ones."""
    rows = turns(conversations)
    size = rows.groupBy("conv_id").agg(F.sum(F.octet_length("text") + F.octet_length("role") + 24).alias("size"))
    path = scratch_path(rows.sparkSession, "long-conversations")
    size.where(F.col("size") > SEGMENT).select(F.col("conv_id").alias("long_id")).write.parquet(path)
    long = rows.sparkSession.read.parquet(path)
    n = long.count()
    if not n:
        return rows, None
    long = F.broadcast(long) if n <= KNOWN else long
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))
    return rows.join(long, same, "left_anti"), rows.join(long, same, "left_semi")


def _formatted(conversations: DataFrame, tokenizer: str, names: list[str]) -> tuple[DataFrame, DataFrame | None]:
    order, schema = ["conv_id", "turn", "tie"], ", ".join(f"{n} {FORMATTED[n]}" for n in names)
    few, many = _split(conversations)
    few = few.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_format(tokenizer, False, names), schema)
    if many is not None:
        many = many.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_format(tokenizer, True, names), schema)
    return few, many


def formatted(conversations: DataFrame, tokenizer: str) -> DataFrame:
    """(conv_id, segment, n_turns, text, ids, starts, ends, loss_token, loss_start, loss_end): offsets
    in code points of ``text``; loss_* list the tokens trained on and their parts under the mask."""
    few, many = _formatted(conversations, tokenizer, list(FORMATTED))
    return few if many is None else few.unionAll(many)


def _read_back(batches):
    names = [c.split()[0] for c in DIGEST.split(", ")]
    conv, state = None, None

    def row():
        n, h, chars, loss, size = state
        return conv, n, h.hexdigest(), chars, loss.hexdigest(), size
    for b in batches:
        out = []
        for key, text, lo, hi in zip(*(b.column(c).to_pylist() for c in ("conv_id", "text")), b.column("loss_start"), b.column("loss_end")):
            if state is None or key != conv:
                if state is not None:
                    out.append(row())
                conv, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            found = parse(text)
            state[0] += len(found)
            state[1].update("".join(f"{r}\n{t}\n" for r, t in found).encode())
            for a, z in covered(*(np.asarray(x.values) for x in (lo, hi))):
                loss = unescape(text[a:z])
                state[2] += len(loss)
                state[3].update(loss.encode())
            state[4] += len(text)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], schema=_digest_schema(names))
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row(), _digest_schema(names).types)], names=names)


def _digest_schema(names):
    return pa.schema(list(zip(names, [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()])))


def digested(conversations: DataFrame, tokenizer: str) -> DataFrame:
    """What the formatted rows say, read back from them alone: one row a conversation.

    A long conversation's segments pass through one task in order, as a digest is
    sequential; the task holds one batch of segments at a time."""
    few, many = _formatted(conversations, tokenizer, ["conv_id", "segment", "text", "loss_start", "loss_end"])
    out = few.mapInArrow(_read_back, DIGEST)
    if many is not None:
        segments = many.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
        out = out.unionAll(segments.mapInArrow(_read_back, DIGEST))
    return out
