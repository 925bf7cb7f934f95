"""Column-expression helpers shared by the jobs.

All of these build Catalyst expressions, so they run inside whole-stage
codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridewise import config as C


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_np(c, k: int = 2) -> Column:
    """Round half to even at ``k`` decimals, the way NumPy/pandas do.

    ``rint(x * 10^k) / 10^k`` — Spark's ``round`` rounds half up and
    ``bround`` works on the decimal value, both of which disagree with the
    float arithmetic of the reference on ties.
    """
    s = float(10 ** k)
    return F.rint(col_(c) * F.lit(s)) / F.lit(s)


def clip(c, lo: float | None = None, hi: float | None = None) -> Column:
    """Clip into [lo, hi] and keep nulls null (greatest/least skip nulls)."""
    x = col_(c)
    out = x
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(out)


def not_in(c, values: Sequence) -> Column:
    """True when the value is outside ``values`` — null counts as outside."""
    return ~F.coalesce(col_(c).isin(list(values)), F.lit(False))


def flag(cond: Column) -> Column:
    """Boolean condition as 0/1 int."""
    return cond.cast("int")


def season(month_col) -> Column:
    m = col_(month_col)
    e = None
    for name, months in C.SEASON_MONTHS.items():
        e = F.when(m.isin(months), F.lit(name)) if e is None else e.when(m.isin(months), F.lit(name))
    return e.otherwise(F.lit(C.SEASON_OTHER))


def right_closed_band(c, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """pandas.cut(right=True) as a column; outside the edges or null → 'nan'."""
    x = col_(c)
    e = F.when(x.isNull() | (x <= F.lit(edges[0])) | (x > F.lit(edges[-1])), F.lit("nan"))
    for hi, lab in zip(edges[1:], labels):
        e = e.when(x <= F.lit(hi), F.lit(lab))
    return e.otherwise(F.lit("nan"))


def surge_band(c="surge_multiplier") -> Column:
    return right_closed_band(c, C.SURGE_BAND_EDGES, C.SURGE_BAND_LABELS)


def wait_band(c="wait_time_min") -> Column:
    return right_closed_band(c, C.WAIT_BAND_EDGES, C.WAIT_BAND_LABELS)


def ordinal(c, order: Sequence[str]) -> Column:
    """Position of a value in a fixed category order (for ordered sorts)."""
    x = col_(c)
    e = None
    for i, v in enumerate(order):
        e = F.when(x == F.lit(v), F.lit(i)) if e is None else e.when(x == F.lit(v), F.lit(i))
    return e.otherwise(F.lit(len(order)))


def lookup(c, mapping: Mapping, default=None) -> Column:
    """Literal map lookup (small fixed dictionaries) with an optional default."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    m = F.create_map(*pairs)
    v = F.try_element_at(m, col_(c))
    return v if default is None else F.coalesce(v, F.lit(default))


def portable_hash(c="ride_id") -> Column:
    """32-bit hash that DuckDB can reproduce: first 8 hex digits of md5."""
    return F.conv(F.substring(F.md5(col_(c)), 1, 8), 16, 10).cast("bigint")


def pct(num: Column, den: Column) -> Column:
    """num / den guarded against a zero denominator (ANSI mode raises)."""
    return num / F.nullif(den, F.lit(0))
