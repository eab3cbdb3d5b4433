"""Partition-independent pseudo-random columns.

``rand(seed)`` depends on how rows are split into partitions, so re-running a
job on a different cluster shape gives other numbers.  Here each draw is a
function of (row key, seed, stream): the same key always gives the same
value, on any partitioning, and recomputing a lost task reproduces it.

The hash is integer arithmetic on 31-bit values (xor-shift / multiply
rounds, every product below 2^62), so it never overflows a BIGINT and any
SQL engine can state the same draws.  The key's low half is mixed with the
stream before its high half joins, so two keys that meet in one stream part
in the others.  Each round is a separate projection:
a round reads its input twice, and separate projections keep the plan from
duplicating the earlier rounds (Catalyst does not collapse projections that
would repeat non-trivial expressions).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MASK31 = 2 ** 31 - 1
MIX = 73244475                 # odd multiplier of the mixing rounds
SEED_MUL, STREAM_MUL = 1640531527, 1013904223
TWO_PI = 2.0 * math.pi


def stream_constant(seed: int, stream: int) -> int:
    return (seed * SEED_MUL + stream * STREAM_MUL) & MASK31


def with_uniforms(df: DataFrame, key: str, seed: int, streams: list[int],
                  prefix: str = "__u") -> DataFrame:
    """Add ``{prefix}{s}``: a uniform double in [0, 1) per stream ``s``."""
    k = F.col(key).cast("long")
    low, high = k.bitwiseAND(F.lit(MASK31)), F.shiftright(k, 31).bitwiseAND(F.lit(MASK31))
    keep = [F.col(c) for c in df.columns]
    out = df.select(*keep, *[low.bitwiseXOR(F.lit(stream_constant(seed, s))).alias(f"{prefix}{s}")
                             for s in streams])
    for i in range(3):
        mixed = {s: (F.col(f"{prefix}{s}").bitwiseXOR(F.shiftright(F.col(f"{prefix}{s}"), 16))
                     * F.lit(MIX)).bitwiseAND(F.lit(MASK31)) for s in streams}
        out = out.select(*keep, *[(m.bitwiseXOR(high) if i == 0 else m).alias(f"{prefix}{s}")
                                  for s, m in mixed.items()])
    return out.select(*keep, *[
        (F.col(f"{prefix}{s}").bitwiseXOR(F.shiftright(F.col(f"{prefix}{s}"), 16))
         .cast("double") / F.lit(float(2 ** 31))).alias(f"{prefix}{s}") for s in streams])


def gaussian(u1: Column, u2: Column, mean: float = 0.0, sd: float = 1.0) -> Column:
    """Normal draw by Box-Muller from two independent uniforms in [0, 1)."""
    z = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u1)) * F.cos(F.lit(TWO_PI) * u2)
    return F.lit(mean) + F.lit(sd) * z


def choice(u: Column, values: list) -> Column:
    """Uniform pick from a fixed list."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.get(arr, F.floor(u * len(values)).cast("int"))
