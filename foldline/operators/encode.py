"""Categorical encodings: ordinal maps, flags, tier lookup, target encoding, one-hot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldline.functions.columns import equals_flag, map_values
from foldline.operators.impute import present
from foldline.operators.joins import lookup_join, measured
from foldline.operators.quantiles import complement_counts
from foldline.session import cut_lineage


@dataclass
class OrdinalMap:
    """``col.map(mapping).fillna(default).astype(int)`` for each listed column."""
    cols: Sequence[str]
    mapping: Mapping[str, int]
    default: int = 0

    def transform(self, df: DataFrame) -> DataFrame:
        cols = present(df, self.cols)
        return df.withColumns({c: map_values(c, self.mapping, self.default).cast("int")
                               for c in cols}) if cols else df


def flag_equals(df: DataFrame, column: str, value, out_col: str | None = None) -> DataFrame:
    """``(col == value)`` as int, NULL -> 0, replacing the column by default."""
    if column not in df.columns:
        return df
    return df.withColumn(out_col or column, equals_flag(column, value))


@dataclass
class TierLookup:
    """Map a category to a small integer tier; unseen / NULL -> ``default``.

    The mapping is a fixed recipe value, so it is inlined as a CASE
    expression: no join and no broadcast at all.
    """
    column: str
    mapping: Mapping[str, int]
    default: int
    out_col: str

    def transform(self, df: DataFrame) -> DataFrame:
        if self.column not in df.columns:
            return df
        return df.withColumn(self.out_col, map_values(self.column, self.mapping,
                                                      self.default).cast("int"))


@dataclass
class TargetEncoderModel:
    column: str
    out_col: str
    fold_col: str
    oof: DataFrame          # column, fold, _te   (mean over the other folds)
    full: DataFrame         # column, _te_full    (mean over all training rows)
    global_mean: float
    oof_rows: int | None = None
    full_rows: int | None = None

    def transform_train(self, df: DataFrame) -> DataFrame:
        j = lookup_join(df, self.oof, [self.column, self.fold_col], n_rows=self.oof_rows)
        return j.withColumn(self.out_col, F.coalesce(F.col("_te"), F.lit(self.global_mean))) \
            .drop("_te").select(*df.columns, self.out_col)

    def transform_score(self, df: DataFrame) -> DataFrame:
        j = lookup_join(df, self.full, [self.column], n_rows=self.full_rows)
        return j.withColumn(self.out_col, F.coalesce(F.col("_te_full"), F.lit(self.global_mean))) \
            .drop("_te_full").select(*df.columns, self.out_col)


class TargetEncoder:
    """Out-of-fold target mean encoding.

    One aggregation gives ``(category, fold) -> (sum, count)``; the training
    mean for held-out fold ``f`` is ``(total - own fold)`` of those additive
    sums, so every fold is served by the same pass instead of one pass per
    fold. The statistics table has ``|categories| x k`` rows; it is joined
    back with :func:`lookup_join` (broadcast under a measured row bound,
    shuffle join with AQE skew splitting above it).
    """

    def __init__(self, column: str, label: str, fold_col: str = "fold",
                 out_col: str | None = None):
        self.column, self.label, self.fold_col = column, label, fold_col
        self.out_col = out_col or f"{column}_te"

    def fit(self, df: DataFrame) -> TargetEncoderModel:
        """One aggregation of the rows, ``(category, fold)``; the per-category
        totals and the global mean are sums over that small, materialised table."""
        c, y, f = self.column, self.label, self.fold_col
        every, _ = measured(df.groupBy(c, f).agg(F.sum(y).alias("_fold_sum"), F.count(y).alias("_fold_n")))
        per = every.where(F.col(c).isNotNull())
        tot = per.groupBy(c).agg(F.sum("_fold_sum").alias("_all_sum"), F.sum("_fold_n").alias("_all_n"))
        grand = every.agg(F.sum("_fold_sum").alias("s"), F.sum("_fold_n").alias("n")).first()
        gmean = grand["s"] / grand["n"] if grand["n"] else None
        rest_n = F.col("_all_n") - F.col("_fold_n")
        oof = per.join(tot, on=c).select(
            c, f, F.when(rest_n > 0, (F.col("_all_sum") - F.col("_fold_sum")) / rest_n).alias("_te"))
        full = tot.select(c, F.when(F.col("_all_n") > 0, F.col("_all_sum") / F.col("_all_n")).alias("_te_full"))
        oof, n_oof = measured(oof)
        full, n_full = measured(full)
        return TargetEncoderModel(c, self.out_col, f, oof, full, gmean, n_oof, n_full)


_ALL = "__all_rows__"


@dataclass
class MultiTargetEncoderModel:
    columns: list
    fold_col: str
    oof: DataFrame          # name, value, fold, _te
    full: DataFrame         # name, value, _te_full
    global_mean: float
    oof_rows: int
    full_rows: int

    def _apply(self, df: DataFrame, table: DataFrame, n: int, keys: list, col_name: str) -> DataFrame:
        for c in self.columns:
            part = table.where(F.col("name") == F.lit(c)).drop("name") \
                .withColumnRenamed("value", c).withColumnRenamed(col_name, f"{c}_te")
            joined = lookup_join(df, part, [c, *keys], n_rows=n)
            te = F.coalesce(F.col(f"{c}_te"), F.lit(self.global_mean)).alias(f"{c}_te")
            df = joined.select(*df.columns, te)
        return df

    def transform_train(self, df: DataFrame) -> DataFrame:
        return self._apply(df, self.oof, self.oof_rows, [self.fold_col], "_te")

    def transform_score(self, df: DataFrame) -> DataFrame:
        return self._apply(df, self.full, self.full_rows, [], "_te_full")


class MultiTargetEncoder:
    """:class:`TargetEncoder` for several columns from one aggregation pass.

    The columns are stacked into ``(name, value)`` pairs so a single
    ``groupBy(name, value, fold)`` (partial aggregation first) yields every
    column's per-fold sums; the rest is the same additive ``total - own
    fold`` rule. Values are compared as strings.
    """

    def __init__(self, columns: Sequence[str], label: str, fold_col: str = "fold"):
        self.columns, self.label, self.fold_col = list(columns), label, fold_col

    def fit(self, df: DataFrame) -> MultiTargetEncoderModel:
        cols, y, f = present(df, self.columns), self.label, self.fold_col
        # one constant pseudo-column rides along: its totals are the global
        # label mean (no separate pass over the data)
        pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value"))
                          for c in cols],
                        F.struct(F.lit(_ALL).alias("name"), F.lit("").alias("value")))
        long = df.select(f, y, F.inline(pairs)).where(F.col("value").isNotNull())
        per = long.groupBy("name", "value", f).agg(F.sum(y).alias("_fold_sum"),
                                                    F.count(y).alias("_fold_n"))
        tot = per.groupBy("name", "value").agg(F.sum("_fold_sum").alias("_all_sum"),
                                               F.sum("_fold_n").alias("_all_n"))
        rest_n = F.col("_all_n") - F.col("_fold_n")
        oof = per.join(tot, ["name", "value"]).select(
            "name", "value", f,
            F.when(rest_n > 0, (F.col("_all_sum") - F.col("_fold_sum")) / rest_n).alias("_te"))
        full = tot.select("name", "value", F.when(F.col("_all_n") > 0, F.col("_all_sum") / F.col("_all_n")).alias("_te_full"))
        oof, n_oof = measured(oof)
        full, n_full = measured(full)
        row = full.where(F.col("name") == F.lit(_ALL)).first()
        gmean = row["_te_full"] if row else None
        return MultiTargetEncoderModel(cols, f, oof, full, gmean, n_oof, n_full)


def target_encode(train: DataFrame, score: DataFrame | None, columns: Sequence[str],
                  label: str, fold_col: str = "fold"):
    """OOF target encoding of every present column (one aggregation pass for
    all of them); the scoring table gets full-training means. Returns
    ``(train, score)``."""
    cols = [c for c in present(train, columns)
            if isinstance(train.schema[c].dataType, T.StringType)]
    others = [c for c in present(train, columns) if c not in cols]
    if cols:
        model = MultiTargetEncoder(cols, label, fold_col).fit(train)
        train = model.transform_train(train)
        if score is not None:
            score = model.transform_score(score)
    for c in others:  # non-string keys keep their own type
        m = TargetEncoder(c, label, fold_col).fit(train)
        train = m.transform_train(train)
        if score is not None:
            score = m.transform_score(score)
    return train, score


def ordered_target_stats(df: DataFrame, columns: Sequence[str], label: str, id_col: str, seed: int = 42,
                         prior_rows: float = 1.0, num_partitions: int | None = None) -> DataFrame:
    """``{column}_ots`` for each column: the label mean of the row's category over the rows before it in a hash order,
    with ``prior_rows`` rows of the global mean, so that no row sees its own label.

    The order is md5 of seed and id, ties by id. Every column's rows are
    range-partitioned by (column, category, order), so a hot category spans many
    partitions; a row's sum is the running one of its slice (partition and
    category) plus those of the slices before, from a table with a row for each
    slice. NULL is a category; a NULL label adds nothing. Ids must be unique.
    """
    cols, y = present(df, columns), F.col(label).cast("double")
    grand = df.agg(F.avg(y)).first()[0]
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    pairs = F.array(*[F.struct(F.lit(c).alias("_name"), F.col(c).cast("string").alias("_value")) for c in cols])
    long = df.select(F.col(id_col).alias("_id"), y.alias("_y"), order.alias("_order"), F.inline(pairs))
    parts = [num_partitions] if num_partitions else []
    ranged = cut_lineage(long.repartitionByRange(*parts, "_name", F.col("_value").asc_nulls_first(), "_order", "_id").withColumn("_pid", F.spark_partition_id()))
    within = Window.partitionBy("_pid", "_name", "_value").orderBy("_order", "_id").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumns({"_s": F.coalesce(F.sum("_y").over(within), F.lit(0.0)), "_n": F.count("_y").over(within)})
    slices = ranged.groupBy("_pid", "_name", "_value").agg(F.coalesce(F.sum("_y"), F.lit(0.0)).alias("_ss"), F.count("_y").alias("_sn"))
    before = Window.partitionBy("_name", "_value").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(F.col("_pid").alias("_p"), F.col("_name").alias("_k"), F.col("_value").alias("_v"),
                            F.coalesce(F.sum("_ss").over(before), F.lit(0.0)).alias("_so"), F.coalesce(F.sum("_sn").over(before), F.lit(0)).alias("_no"))
    same = (F.col("_pid") == F.col("_p")) & (F.col("_name") == F.col("_k")) & F.col("_value").eqNullSafe(F.col("_v"))
    stat = (F.col("_s") + F.col("_so") + F.lit(prior_rows * (grand or 0.0))) / (F.col("_n") + F.col("_no") + F.lit(prior_rows))
    stats = local.join(offsets, same).groupBy("_id").agg(*[F.max(F.when(F.col("_name") == c, stat)).alias(f"{c}_ots") for c in cols])
    return df.join(stats, df[id_col] == stats["_id"], "left").drop("_id")


@dataclass
class FoldCategoriesModel:
    """Sorted training categories per held-out fold and column."""
    categories: dict = field(default_factory=dict)   # (fold, name) -> [values]

    def index_expr(self, fold: int, name: str):
        """0-based position of the value among the fold's training categories;
        unseen and NULL give NULL (an all-zero one-hot row)."""
        cats = self.categories.get((fold, name), [])
        return map_values(name, {v: i for i, v in enumerate(cats)}, None)

    def one_hot_columns(self, fold: int, name: str) -> dict:
        cats = self.categories.get((fold, name), [])
        return {f"{name}_{v}": F.coalesce((F.col(name) == F.lit(v)).cast("int"), F.lit(0))
                for v in cats}


class FoldCategories:
    """One-hot vocabulary per training fold (handle_unknown='ignore').

    The distinct ``(fold, column, value)`` set is computed in one shuffle;
    the vocabulary of held-out fold ``i`` is the values seen in the other
    folds. The result (bounded by column cardinality x k) is collected; a
    guard refuses columns whose cardinality would not fit a one-hot layout.
    """

    def __init__(self, cols: Sequence[str], fold_col: str = "fold", k: int = 5,
                 max_categories: int = 10_000):
        self.cols, self.fold_col, self.k = list(cols), fold_col, k
        self.max_categories = max_categories

    def training_values(self, df: DataFrame) -> DataFrame:
        from foldline.operators.impute import stacked_counts
        counts = stacked_counts(df, present(df, self.cols), [self.fold_col])
        return cut_lineage(complement_counts(counts, self.fold_col, self.k, "fold")
                           .select("fold", "name", "value"))

    def fit(self, df: DataFrame) -> FoldCategoriesModel:
        train = self.training_values(df)
        # size guard before anything groups a column's values together
        sizes = train.groupBy("name").agg(F.count(F.lit(1)).alias("m")).collect()
        too_big = [r["name"] for r in sizes if r["m"] > self.k * self.max_categories]
        if too_big:
            raise ValueError(f"one-hot vocabulary too large for {too_big}; "
                             f"use a target encoding for these columns")
        w = Window.partitionBy("fold", "name").orderBy("value")
        vocab = train.withColumn("idx", (F.row_number().over(w) - 1).cast("int"))
        cats: dict = {}
        for r in vocab.orderBy("fold", "name", "idx").collect():
            cats.setdefault((r["fold"], r["name"]), []).append(r["value"])
        return FoldCategoriesModel(cats)


@dataclass
class FoldDictionaryModel:
    """The training categories of every held-out fold as a table (fold, name, value, idx), idx dense from 0 in value order."""
    table: DataFrame
    sizes: dict                     # (fold, name) -> number of categories
    fold_col: str

    def index(self, df: DataFrame, names: Sequence[str], fill: Mapping | None = None, suffix: str = "_index") -> DataFrame:
        """``df`` with ``{name}_index``: the place of the value among the categories that the row's held-out fold knows; NULL if it knows none such.

        ``fill`` has the value of (fold, name) that stands for NULL. One join a
        column on (fold, value), broadcast by AQE if the table is small, split by it
        if a category is hot.
        """
        out, columns = df, list(df.columns)
        for c in present(df, names):
            value = F.col(c).cast("string")
            for (f, name), v in (fill or {}).items():
                if name == c and v is not None:
                    value = F.when(F.col(c).isNull() & (F.col(self.fold_col) == F.lit(f)), F.lit(str(v))).otherwise(value)
            known = self.table.where(F.col("name") == F.lit(c)).select(F.col("fold").alias("_f"), F.col("value").alias("_v"), F.col("idx").alias(f"{c}{suffix}"))
            keyed = out.withColumn("_value", value)
            out = keyed.join(known, (keyed[self.fold_col] == known["_f"]) & (keyed["_value"] == known["_v"]), "left").select(*columns, f"{c}{suffix}")
            columns.append(f"{c}{suffix}")
        return out

    def one_hot(self, df: DataFrame, name: str, fold: int, out_col: str, fill: Mapping | None = None) -> DataFrame:
        """``df`` with a sparse one-hot vector over the categories of one fold; unseen and NULL give no ones."""
        from pyspark.ml.feature import OneHotEncoder
        n = self.sizes.get((fold, name), 0)
        held = self.index(df.withColumn("_own_fold", F.col(self.fold_col)).withColumn(self.fold_col, F.lit(fold)), [name], fill, "_place")
        place = F.coalesce(F.col(f"{name}_place"), F.lit(n)).cast("double").alias("_place", metadata={"ml_attr": {"type": "nominal", "name": name, "num_vals": n + 1}})
        keep = [F.col("_own_fold").alias(c) if c == self.fold_col else F.col(c) for c in df.columns]
        wide = held.select(*keep, place)
        encoder = OneHotEncoder(inputCols=["_place"], outputCols=[out_col], dropLast=True, handleInvalid="error")
        return encoder.fit(wide).transform(wide).drop("_place")


class FoldDictionary(FoldCategories):
    """One-hot categories of any number: nothing is collected but their counts.

    The distinct (fold, column, value) rows are range-partitioned, numbered within
    their partition, and offset by the counts of the slices before, so no task
    sees a whole column's values.
    """

    def fit(self, df: DataFrame) -> FoldDictionaryModel:
        group = ["fold", "name"]
        ranged = cut_lineage(self.training_values(df).repartitionByRange(*group, "value").withColumn("_pid", F.spark_partition_id()))
        local = ranged.withColumn("_at", F.row_number().over(Window.partitionBy("_pid", *group).orderBy("value")) - 1)
        slices = local.groupBy("_pid", *group).agg((F.max("_at") + 1).alias("_n"))
        before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
        offsets = slices.select("_pid", *group, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
        table = cut_lineage(local.join(offsets, ["_pid", *group]).select(*group, "value", (F.col("_at") + F.col("_off")).cast("int").alias("idx")))
        sizes = {(r["fold"], r["name"]): r["n"] for r in table.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).collect()}
        return FoldDictionaryModel(table, sizes, self.fold_col)
