"""CSV source and sink.

``read_csv_na``: header CSV with an explicit schema, ``NA`` read as missing
and the other pandas default missing tokens normalised to NULL on string
columns. ``read_csv_typed``: several files of one layout without a schema; types
are inferred over all of them together. ``write_submission``: ``Id,SalePrice`` with a header, written by the
executors as a directory of parts (one file only when asked for).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tokens read as missing by pandas' CSV reader by default.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def read_csv_na(spark: SparkSession, path: str, schema: T.StructType | str,
                keep_tokens: tuple[str, ...] = ("None",)) -> DataFrame:
    """Read a header CSV; ``NA`` and the default missing tokens become NULL.

    ``keep_tokens`` stay literal strings (``"None"`` is a real category of
    several housing columns).
    """
    df = (spark.read.option("header", True).option("nullValue", "NA")
          .option("mode", "FAILFAST").schema(schema).csv(path))
    tokens = [t for t in NA_TOKENS if t not in keep_tokens]
    fixes = {f.name: F.when(~F.col(f.name).isin(tokens), F.col(f.name))
             for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.withColumns(fixes) if fixes else df


#: Column of ``read_csv_typed`` that lists a row's cells that don't fit their column's type.
REJECTED = "_rejected"


def read_csv_typed(spark: SparkSession, *paths: str, keep_tokens: tuple[str, ...] = ("None",),
                   max_rejected: float = 0.01) -> list[DataFrame]:
    """A frame for each header CSV, a column having the same type in all of them.

    Missing tokens become NULL before types are inferred: bigint if all cells
    of a column, but for a share of ``max_rejected``, are whole numbers, else
    double likewise, else string; a column without any cell is a string. A cell
    that doesn't fit becomes NULL and is listed in ``_rejected``, array of
    (column, value), so that a stray token neither ends the run nor turns a
    number column into text. One aggregate over each file.
    """
    tokens = [t for t in NA_TOKENS if t not in keep_tokens]
    raw = []
    for path in paths:
        df = spark.read.option("header", True).csv(path)
        raw.append(df.select(*[F.when(~F.trim(_cell(c)).isin(tokens), _cell(c)).alias(c) for c in df.columns]))
    seen: dict[str, list[int]] = {}
    for df in raw:
        counts = df.agg(*[a.alias(f"{kind}{i}") for i, c in enumerate(df.columns) for kind, a in (
            ("n", F.count(_cell(c))), ("l", F.count(_cell(c).try_cast("bigint"))), ("d", F.count(_cell(c).try_cast("double"))))]).first()
        for i, c in enumerate(df.columns):
            own = seen.setdefault(c, [0, 0, 0])
            for k, kind in enumerate("nld"):
                own[k] += counts[f"{kind}{i}"]
    types = {c: next((t for t, fit in (("bigint", whole), ("double", number)) if n and n - fit <= max_rejected * n), "string") for c, (n, whole, number) in seen.items()}
    out = []
    for df in raw:
        typed = {c: _cell(c).try_cast(types[c]) for c in df.columns}
        bad = [F.when(_cell(c).isNotNull() & typed[c].isNull(), F.struct(F.lit(c).alias("column"), _cell(c).alias("value"))) for c in df.columns if types[c] != "string"]
        listed = F.filter(F.array(*bad), lambda x: x.isNotNull()) if bad else F.array().cast("array<struct<column:string,value:string>>")
        out.append(df.select(*[x.alias(c) for c, x in typed.items()], listed.alias(REJECTED)))
    return out


def _cell(name: str):
    return F.col(f"`{name}`")


def write_csv_na(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("nullValue", "NA").csv(path)


def write_submission(df: DataFrame, path: str, id_col: str = "Id", pred_col: str = "SalePrice",
                     single_file: bool = False) -> None:
    out = df.select(F.col(id_col).alias("Id"), F.col(pred_col).alias("SalePrice"))
    if single_file:  # only for small scoring tables: one task writes the file
        out = out.repartition(1)  # the rows are still made in parallel
    out.write.mode("overwrite").option("header", True).csv(path)
