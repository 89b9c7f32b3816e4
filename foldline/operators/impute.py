"""Imputers and row filters of the cleaning step.

Fitted statistics (modes, medians) come from shuffled aggregates of bounded
size: one value per column (collected), or one row per group key, joined
back with :func:`foldline.operators.joins.lookup_join` (broadcast under a
measured row bound, shuffle join otherwise).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldline.functions.columns import col
from foldline.operators.quantiles import mode_from_counts, percentile_from_counts, value_counts


def present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Schema guard: the subset of ``cols`` that exists in ``df``."""
    have = set(df.columns)
    return [c for c in cols if c in have]


def fill_constant(df: DataFrame, cols: Sequence[str], value) -> DataFrame:
    """``fillna(value)`` on the listed columns that exist."""
    cols = present(df, cols)
    return df.fillna(value, subset=cols) if cols else df


def stacked_counts(df: DataFrame, cols: Sequence[str], extra_keys: Sequence[str] = (),
                   value_type: str = "string") -> DataFrame:
    """Counts of ``(extra_keys..., name, value)`` for many columns in one shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast(value_type).alias("value"))
                      for c in cols])
    long = df.select(*extra_keys, F.inline(pairs))
    return value_counts(long, [*extra_keys, "name"], "value")


@dataclass
class FillModeModel:
    values: dict

    def transform(self, df: DataFrame) -> DataFrame:
        vals = {c: v for c, v in self.values.items() if c in df.columns and v is not None}
        return df.fillna(vals) if vals else df


class FillMode:
    """Most frequent value (ties -> smallest, NULL ignored) per column."""

    def __init__(self, cols: Sequence[str]):
        self.cols = list(cols)

    def fit(self, df: DataFrame) -> FillModeModel:
        cols = present(df, self.cols)
        strings = [c for c in cols if isinstance(df.schema[c].dataType, T.StringType)]
        got = {}
        if strings:  # all string columns in one shuffle
            modes = mode_from_counts(stacked_counts(df, strings), ["name"], "value").collect()
            got.update({r["name"]: r["mode"] for r in modes})
        for c in cols:  # other types keep their own ordering for ties
            if c not in strings:
                row = mode_from_counts(value_counts(df, [], c), [], c).first()
                got[c] = row["mode"] if row else None
        return FillModeModel({c: got.get(c) for c in cols})


def fill_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Stateless variant used by the cleaning step: statistics from ``df`` itself."""
    return FillMode(cols).fit(df).transform(df)


def _median_type(df: DataFrame, col: str) -> T.DataType:
    """Type of a median-filled column: whole numbers become double, as a median may fall between two."""
    dtype = df.schema[col].dataType
    return T.DoubleType() if isinstance(dtype, T.IntegralType) else dtype


@dataclass
class GroupMedianModel:
    value_col: str
    key_col: str
    medians: DataFrame            # key, _gmed
    global_median: float | None
    keep_null_key_values: bool = False
    n_groups: int | None = None

    def group_filled(self, df: DataFrame) -> Column:
        v, k = F.col(self.value_col), F.col(self.key_col)
        filled = F.coalesce(v, F.col("_gmed"))
        if self.keep_null_key_values:
            return filled
        # pandas groupby drops NULL keys: those rows come back missing.
        return F.when(k.isNotNull(), filled)

    def transform(self, df: DataFrame, with_global: bool = True) -> DataFrame:
        from foldline.operators.joins import lookup_join
        joined = lookup_join(df, self.medians, [self.key_col], n_rows=self.n_groups)
        out = self.group_filled(joined)
        if with_global and self.global_median is not None:
            out = F.coalesce(out, F.lit(self.global_median))
        return joined.withColumn(self.value_col, out.cast(_median_type(df, self.value_col))).drop("_gmed").select(df.columns)


class FillGroupMedian:
    """Fill ``value_col`` with the exact median of its ``key_col`` group, then
    with the global median of the group-filled column (imputed values count)."""

    def __init__(self, value_col: str, key_col: str, keep_null_key_values: bool = False):
        self.value_col, self.key_col = value_col, key_col
        self.keep_null_key_values = keep_null_key_values

    def fit(self, df: DataFrame) -> GroupMedianModel:
        """One pass over ``df``: ``(key, value) -> count`` (NULLs included,
        partial aggregation) is materialised, and everything else is derived
        from that table: the group medians, the key list (groups without any
        value keep a NULL median) and the global median of the group-filled
        column, whose distribution is the original counts plus each group's
        NULL count placed at the group's median."""
        from foldline.operators.joins import measured
        from foldline.session import cut_lineage
        k, v = self.key_col, self.value_col
        dtype = _median_type(df, v)
        allc = cut_lineage(df.groupBy(k, v).agg(F.count(F.lit(1)).alias("_w")))
        counts = allc.where(F.col(k).isNotNull() & F.col(v).isNotNull())
        med = percentile_from_counts(counts, [k], v, 0.5, "_gmed")
        groups = allc.where(F.col(k).isNotNull()).select(k).distinct()
        med, n = measured(groups.join(med, [k], "left"))
        own = counts.select(F.col(v).cast("double").alias("_v"), "_w")
        filled = (allc.where(F.col(k).isNotNull() & F.col(v).isNull()).drop(v)
                  .join(med.where(F.col("_gmed").isNotNull()), [k])
                  .select(F.col("_gmed").cast(dtype).cast("double").alias("_v"), "_w"))
        parts = own.unionByName(filled)
        if self.keep_null_key_values:
            parts = parts.unionByName(allc.where(F.col(k).isNull() & F.col(v).isNotNull())
                                      .select(F.col(v).cast("double").alias("_v"), "_w"))
        glob = parts.groupBy("_v").agg(F.sum("_w").alias("_w"))
        row = percentile_from_counts(glob, [], "_v", 0.5, "m").first()
        return GroupMedianModel(v, k, med, row["m"] if row else None,
                                self.keep_null_key_values, n)


def fill_group_median(df: DataFrame, value_col: str, key_col: str) -> DataFrame:
    return FillGroupMedian(value_col, key_col).fit(df).transform(df)


def outlier_condition(df: DataFrame, rules: Sequence[tuple[str, str, float]]) -> Column:
    """AND of ``(column, op, threshold)`` rules with op in ``> >= < <=``."""
    ops = {">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
           "<": lambda a, b: a < b, "<=": lambda a, b: a <= b}
    cond = None
    for c, op, t in rules:
        term = ops[op](F.col(c), F.lit(t))
        cond = term if cond is None else cond & term
    return cond


def remove_outliers(df: DataFrame, cond: Column) -> DataFrame:
    """Drop rows where ``cond`` is true; rows where it is NULL are kept."""
    return df.where(~F.coalesce(cond, F.lit(False)))


def count_outliers(df: DataFrame, cond: Column) -> DataFrame:
    return df.agg(F.count_if(F.coalesce(cond, F.lit(False))).alias("n_removed"))


def cast_to_string(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    cols = present(df, cols)
    return df.withColumns({c: F.col(c).cast("string") for c in cols}) if cols else df


def category_prep(df: DataFrame, numeric_cols: Sequence[str],
                  categorical_cols: Sequence[str]) -> DataFrame:
    """Categories as strings with NULL -> ``'Missing'``; numerics NULL -> 0."""
    cats = {c: F.coalesce(col(c).cast("string"), F.lit("Missing")) for c in present(df, categorical_cols)}
    nums = {c: F.coalesce(col(c), F.lit(0).cast(df.schema[c].dataType))
            for c in present(df, numeric_cols)}
    return df.withColumns({**cats, **nums})
