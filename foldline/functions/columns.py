"""Null-safe Column builders used by the feature and encoding steps.

All of them return plain Spark expressions, so a whole feature step stays a
single ``select`` inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nz(c: Column | str, default=0) -> Column:
    """``c`` with NULL replaced by ``default`` (pandas ``fillna`` before arithmetic)."""
    return F.coalesce(col(c), F.lit(default))


def weighted_sum(terms: Sequence[tuple[Column | str, float]] | Sequence[Column | str],
                 fill=0) -> Column:
    """Sum of ``w * c`` with every NULL counted as ``fill``."""
    out = None
    for t in terms:
        c, w = (t if isinstance(t, tuple) else (t, 1))
        term = nz(c, fill) if w == 1 else F.lit(w) * nz(c, fill)
        out = term if out is None else out + term
    return out


def clamp_min(c: Column | str, low=0) -> Column:
    """``max(low, c)``; a NULL ``c`` gives ``low`` (as Python's ``max(0, nan)``)."""
    return F.greatest(F.lit(low), col(c))


def positive_flag(c: Column | str) -> Column:
    """``(coalesce(c, 0) > 0)`` as int."""
    return (nz(c) > 0).cast("int")


def equals_flag(c: Column | str, value) -> Column:
    """``(c == value)`` as int, NULL counts as not equal."""
    return F.coalesce(col(c) == F.lit(value), F.lit(False)).cast("int")


def not_equal_flag(a: Column | str, b: Column | str) -> Column:
    """``(a != b)`` as int where any NULL side counts as different (NaN != x)."""
    return F.coalesce(col(a) != col(b), F.lit(True)).cast("int")


def member_flag(c: Column | str, values: Iterable) -> Column:
    """``c in values`` as int, NULL -> 0."""
    return F.coalesce(col(c).isin(list(values)), F.lit(False)).cast("int")


def guarded_ratio(num: Column | str, den: Column | str, fill_num: bool = True,
                  fill_den: bool = True) -> Column:
    """``num / den`` where a zero (or, with ``fill_den``, NULL) denominator becomes 1."""
    n = nz(num) if fill_num else col(num)
    d = nz(den) if fill_den else col(den)
    return n.cast("double") / F.when(d == 0, F.lit(1)).otherwise(d).cast("double")


def right_closed_bins(c: Column | str, edges: Sequence[float], labels: Sequence[float],
                      default: float = 0.0) -> Column:
    """pandas ``cut(right=True)``: ``(edges[i], edges[i+1]] -> labels[i]``, else default."""
    x = col(c)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > F.lit(lo)) & (x <= F.lit(hi))
        expr = F.when(cond, F.lit(float(lab))) if expr is None else expr.when(cond, F.lit(float(lab)))
    return expr.otherwise(F.lit(float(default)))


def map_values(c: Column | str, mapping: Mapping, default=None) -> Column:
    """Dictionary lookup as a CASE chain; unseen values and NULL give ``default``."""
    x = col(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(x == F.lit(k), F.lit(v)) if expr is None else expr.when(x == F.lit(k), F.lit(v))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, NUMERIC_TYPES)


def numeric_columns(schema: T.StructType, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in schema.fields if is_numeric(f.dataType) and f.name not in ex]


def string_columns(schema: T.StructType, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in ex]
