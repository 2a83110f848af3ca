"""A space-filling key over several columns, of built-in expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a rank: a column is cut into 2^BITS stretches of about as many rows.
BITS = 6


def _rank(value: Column, cuts: list) -> Column:
    """How many of the ascending ``cuts``, repeated ones included, the value reaches, by halving."""
    if not cuts:
        return F.lit(0)
    mid = len(cuts) // 2
    return F.when(value < F.lit(cuts[mid]), _rank(value, cuts[:mid])).otherwise(F.lit(mid + 1) + _rank(value, cuts[mid + 1:]))


def interleave(ranks: list[Column], bits: int = BITS) -> Column:
    """Bit b of the k-th of n ranks becomes bit b * n + (n - 1 - k) of the key: rows
    near in all columns get near keys, and a stretch of keys is narrow in each."""
    n = len(ranks)
    moved = [F.shiftleft(F.shiftright(r, b).bitwiseAND(F.lit(1)).cast("long"), b * n + n - 1 - k) for k, r in enumerate(ranks) for b in range(bits)]
    return reduce(lambda a, b: a.bitwiseOR(b), moved)


def curve_key(rows: DataFrame, columns: list[str], bits: int = BITS) -> Column:
    """The key of numeric columns. Ranks come from approximate quantiles (at most
    2^bits - 1 cuts a column reach the driver), so uneven values and outliers do
    not spoil them; a value that holds many rows keeps one rank and takes up its
    share of them. Nulls rank lowest."""
    shares = F.array(*[F.lit(k / 2**bits) for k in range(1, 2**bits)])
    found = rows.agg(*[F.percentile_approx(F.col(c).cast("long"), shares, 10_000).alias(c) for c in columns]).first()
    return interleave([F.when(F.col(c).isNull(), F.lit(0)).otherwise(_rank(F.col(c).cast("long"), found[c] or [])) for c in columns], bits)
