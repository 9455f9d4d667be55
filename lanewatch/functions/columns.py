"""Small Column builders shared by the operators (all JVM-side expressions)."""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den, default: float = 0.0) -> Column:
    """num/den where den > 0, else ``default`` (ANSI-safe: no division by 0)."""
    num, den = col_(num), col_(den)
    return F.when(den > 0, num / den).otherwise(F.lit(default))


def clip(c, lo: float | None = None, hi: float | None = None) -> Column:
    """Clamp to [lo, hi]; nulls stay null."""
    c = col_(c)
    out = c
    if lo is not None:
        out = F.when(out < lo, F.lit(float(lo))).otherwise(out)
    if hi is not None:
        out = F.when(out > hi, F.lit(float(hi))).otherwise(out)
    return out


def lookup(mapping: dict, c) -> Column:
    """Literal map lookup; null when the key is absent."""
    pairs = list(chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    return F.create_map(*pairs)[col_(c)]


def sum_cols(cols) -> Column:
    return reduce(lambda a, b: a + b, [col_(c) for c in cols])


def minmax_scaled(c, lo: Column, hi: Column) -> Column:
    """(c - lo) / (hi - lo), 0 when the range is empty; lo/hi are scalars."""
    c = col_(c)
    return F.when(hi > lo, (c - lo) / (hi - lo)).otherwise(F.lit(0.0))


def safe_corr(a, b) -> Column:
    """Pearson r as an aggregate; null (not an error) where one side is constant."""
    a, b = col_(a), col_(b)
    spread = F.stddev_pop(a) * F.stddev_pop(b)
    return F.when(spread > 0, F.covar_pop(a, b) / spread)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column (used at result boundaries for stable compares)."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def md5_uniform(*parts) -> Column:
    """Deterministic U[0,1) from md5 of the '|'-joined parts.

    First 32 bits of the digest / 2^32; DuckDB computes the same value with
    ('0x' || substr(md5(s), 1, 8))::BIGINT / 4294967296.
    """
    s = F.concat_ws("|", *[col_(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shuffled_position(i, n: int, *label, walks: int = 64) -> Column:
    """A keyed bijection of 0..n-1: where position ``i`` goes under the shuffle named by ``label``.

    Positions are pairs in a grid of about sqrt(n) x sqrt(n) cells; four additive Feistel rounds (md5 of the label, the round and
    the other half) permute the grid, and a result outside 0..n-1 is permuted again (at most about one in sqrt(n) is, and a
    walk passes no cell twice). Shuffles need no sort, and SQL computes the same.
    """
    a = max(1, int(-(-(n ** 0.5) // 1)))
    b = max(1, -(-n // a))

    def number(step: int, x: Column) -> Column:
        text = F.concat_ws("|", *[col_(p).cast("string") for p in label], F.lit(str(step)), x.cast("string"))
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")

    def once(x: Column) -> Column:
        left, right = F.floor(x / b).cast("bigint"), F.pmod(x, F.lit(b))
        return let((left + number(0, right)) % a, lambda l1: let((right + number(1, l1)) % b, lambda r1: let(
            (l1 + number(2, r1)) % a, lambda l2: l2 * b + (r1 + number(3, l2)) % b)))

    first = once(col_(i).cast("bigint"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(walks)), first, lambda x, _: F.when(x < n, x).otherwise(once(x)))
