"""Exact grouped percentiles and modes that never hold a whole group in one task.

``F.median`` keeps a value -> count map per group and merges it in a single
task, so a hot group with continuous values (a third of a 100 TB table)
would need one giant buffer. Here the work is:

1. pre-aggregate ``(group, value) -> count`` (map-side combine);
2. range-partition those counts on ``(group, value)`` so a hot group is cut
   into many contiguous partitions, then pin the partition ids with a
   reliable checkpoint;
3. running counts inside each ``(partition, group)`` slice (bounded by the
   partition size) plus per-slice offsets computed from a table with one
   row per slice;
4. keep only the (at most two) value rows that cover the wanted ranks and
   interpolate, as ``quantile_cont`` does.

Weights let callers feed counts that were derived additively, e.g. the
training-fold counts ``total - own fold`` (see :func:`complement_counts`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldline.session import cut_lineage


def value_counts(df: DataFrame, group_cols: Sequence[str], value_col: str,
                 weight_col: str | None = None) -> DataFrame:
    """``(group..., value, _w)`` for non-NULL values and non-NULL group keys
    (as pandas ``groupby``); partial aggregation first."""
    w = F.sum(weight_col) if weight_col else F.count(F.lit(1))
    cond = F.col(value_col).isNotNull()
    for g in group_cols:
        cond = cond & F.col(g).isNotNull()
    return (df.where(cond)
            .groupBy(*group_cols, value_col)
            .agg(w.cast("long").alias("_w"))
            .where(F.col("_w") > 0))


def complement_counts(counts: DataFrame, fold_col: str, k: int,
                      out_col: str = "fold") -> DataFrame:
    """Turn per-fold counts into training-fold counts.

    A row counted in fold ``f`` is a training row of every other fold, so
    it is sent to the ``k - 1`` other fold ids; the result holds, for
    held-out fold ``i``, the counts over rows with ``fold != i``.
    """
    others = F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: i != F.col(fold_col))
    keys = [c for c in counts.columns if c not in (fold_col, "_w")]
    return (counts.withColumn(out_col + "__t", F.explode(others))
            .groupBy(F.col(out_col + "__t").alias(out_col), *keys)
            .agg(F.sum("_w").alias("_w")))


def percentile_from_counts(counts: DataFrame, group_cols: Sequence[str], value_col: str,
                           p: float = 0.5, out_col: str = "percentile",
                           num_partitions: int | None = None) -> DataFrame:
    """Exact interpolated percentile per group from ``(group..., value, _w)``."""
    g = list(group_cols)
    if not g:  # a constant group key keeps every step a keyed join
        counts, g = counts.withColumn("_all", F.lit(0)), ["_all"]
    # Without an explicit count AQE sizes the range partitions; coalescing only
    # merges neighbouring ranges, so partition ids stay in value order.
    parts = [num_partitions] if num_partitions else []
    ranged = (counts.repartitionByRange(*parts, *g, value_col)
              .withColumn("_pid", F.spark_partition_id()))
    # The slice ids must be identical for both consumers below.
    ranged = cut_lineage(ranged)

    w_local = (Window.partitionBy("_pid", *g).orderBy(value_col)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.withColumn("_cum", F.sum("_w").over(w_local))
    # The window output is already clustered by (_pid, group): the slice
    # totals reuse that partitioning, so the counts are shuffled only once.
    slices = local.groupBy("_pid", *g).agg(F.max("_cum").alias("_slice"))
    # One row per (slice, group): small even for a hot group.
    w_off = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(
        "_pid", *g, F.coalesce(F.sum("_slice").over(w_off), F.lit(0)).alias("_off"),
        F.sum("_slice").over(Window.partitionBy(*g)).alias("_n"))

    pos = (F.col("_n") - 1) * F.lit(float(p))
    located = local.join(offsets, ["_pid", *g])
    hi_cum = F.col("_off") + F.col("_cum")           # rows <= value
    lo_cum = hi_cum - F.col("_w")                    # rows <  value
    lo_rank, hi_rank = F.floor(pos), F.ceil(pos)
    cover = lambda r: (lo_cum <= r) & (r < hi_cum)
    picked = located.where(cover(lo_rank) | cover(hi_rank)).select(
        *g, F.when(cover(lo_rank), F.col(value_col)).alias("_vlo"),
        F.when(cover(hi_rank), F.col(value_col)).alias("_vhi"),
        (pos - lo_rank).alias("_frac"))
    agg = picked.groupBy(*g).agg(F.max("_vlo").alias("_vlo"), F.max("_vhi").alias("_vhi"),
                                 F.max("_frac").alias("_frac"))
    value = (F.col("_vlo").cast("double")
             + (F.col("_vhi").cast("double") - F.col("_vlo").cast("double")) * F.col("_frac"))
    keep = [c for c in g if c != "_all"]
    return agg.select(*keep, value.alias(out_col))


def grouped_percentile(df: DataFrame, group_cols: Sequence[str], value_col: str,
                       p: float = 0.5, out_col: str = "percentile") -> DataFrame:
    """Exact percentile of ``value_col`` per group (NULL values ignored; a
    group with no value at all is kept with a NULL result, as pandas does)."""
    result = percentile_from_counts(value_counts(df, group_cols, value_col),
                                    group_cols, value_col, p, out_col)
    if not group_cols:
        return result
    keyed = df.select(*group_cols)
    for g in group_cols:
        keyed = keyed.where(F.col(g).isNotNull())
    # distinct keys: partial aggregation, one row per group
    return keyed.distinct().join(result, list(group_cols), "left")


def grouped_median(df: DataFrame, group_cols: Sequence[str], value_col: str,
                   out_col: str = "median") -> DataFrame:
    return grouped_percentile(df, group_cols, value_col, 0.5, out_col)


def global_median(df: DataFrame, value_col: str) -> float | None:
    """Exact median of a column as a driver scalar (one row is collected)."""
    rows = grouped_percentile(df, [], value_col, 0.5, "m").collect()
    return rows[0]["m"] if rows else None


def mode_from_counts(counts: DataFrame, group_cols: Sequence[str], value_col: str,
                     out_col: str = "mode") -> DataFrame:
    """Most frequent value per group, ties -> smallest value.

    ``min(struct(-count, value))`` is a declarative aggregate, so the pick
    is combined map-side and a hot group costs nothing extra.
    """
    best = F.min(F.struct((-F.col("_w")).alias("neg"), F.col(value_col).alias("v")))
    return counts.groupBy(*group_cols).agg(best["v"].alias(out_col))


def grouped_mode(df: DataFrame, group_cols: Sequence[str], value_col: str,
                 out_col: str = "mode") -> DataFrame:
    return mode_from_counts(value_counts(df, group_cols, value_col), group_cols, value_col, out_col)


def global_positions(df: DataFrame, order_col: str, out_col: str = "_pos",
                     num_partitions: int | None = None) -> DataFrame:
    """0-based position of every row in the global order of ``order_col``.

    Range partitioning spreads the order over many tasks; each task numbers
    its own rows and adds the row count of all earlier partitions (a table
    with one row per partition). No step sees more than one partition.
    """
    parts = [num_partitions] if num_partitions else []
    ranged = cut_lineage(df.repartitionByRange(*parts, order_col)
                         .withColumn("_pid", F.spark_partition_id()))
    local = ranged.withColumn(
        "_lrn", F.row_number().over(Window.partitionBy("_pid").orderBy(order_col)) - 1)
    # clustered by _pid already: no second shuffle of the rows
    sizes = local.groupBy("_pid").agg((F.max("_lrn") + 1).alias("_sz"))
    w = Window.partitionBy(F.lit(0)).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_sz").over(w), F.lit(0)).alias("_off"),
                           F.sum("_sz").over(Window.partitionBy(F.lit(0))).alias("_total"))
    return (local.join(offsets, "_pid")
            .withColumn(out_col, (F.col("_off") + F.col("_lrn")).cast("long"))
            .drop("_pid", "_lrn", "_off"))
