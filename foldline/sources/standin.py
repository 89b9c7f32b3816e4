"""A housing-shaped table derived from the driver tables.

The housing recipe (``foldline.plans.housing``) expects the columns of the
house-sales data dictionary. This module only *lays out rows in that
schema* from the order frame: real columns where the driver tables have a
counterpart (price, nation key as neighbourhood, line quantities, dates), and
codes read off real columns for the rest: priority, status, segment, nation,
dates, quantities and amounts name the place in a column's code list. Orders
without lines, and one place beyond the list, are missing, so every imputer has
work. It computes nothing of the recipe itself; the recipe runs on it through
the library's own steps.

The same spec renders the DuckDB SQL used by the oracle (``standin_sql``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldline.functions.columns import map_values
from foldline.functions.hashing import bucket, sql_bucket
from foldline.sources.tables import ORDER_FRAME_SQL, order_frame

# Category domains of the house-sales data dictionary.
DOMAINS = {
    "MSZoning": ["A", "C", "FV", "I", "RH", "RL", "RP", "RM"],
    "Street": ["Grvl", "Pave"],
    "Alley": ["Grvl", "Pave"],
    "LotShape": ["Reg", "IR1", "IR2", "IR3"],
    "Utilities": ["AllPub", "NoSewr", "NoSeWa", "ELO"],
    "LandSlope": ["Gtl", "Mod", "Sev"],
    "Condition1": ["Artery", "Feedr", "Norm", "RRNn", "RRAn", "PosN", "PosA", "RRNe", "RRAe"],
    "HouseStyle": ["1Story", "1.5Fin", "1.5Unf", "2Story", "2.5Fin", "2.5Unf", "SFoyer", "SLvl"],
    "Exterior1st": ["AsbShng", "AsphShn", "BrkComm", "BrkFace", "CBlock", "CemntBd", "HdBoard",
                    "ImStucc", "MetalSd", "Other", "Plywood", "PreCast", "Stone", "Stucco",
                    "VinylSd", "Wd Sdng", "WdShing"],
    "Exterior2nd": ["AsbShng", "AsphShn", "BrkComm", "BrkFace", "CBlock", "CemntBd", "HdBoard",
                    "ImStucc", "MetalSd", "Other", "Plywood", "PreCast", "Stone", "Stucco",
                    "VinylSd", "Wd Sdng", "WdShing"],
    "MasVnrType": ["BrkCmn", "BrkFace", "CBlock", "None", "Stone"],
    "ExterQual": ["Ex", "Gd", "TA", "Fa", "Po"],
    "ExterCond": ["Ex", "Gd", "TA", "Fa", "Po"],
    "BsmtQual": ["Ex", "Gd", "TA", "Fa", "Po"],
    "BsmtCond": ["Ex", "Gd", "TA", "Fa", "Po"],
    "BsmtExposure": ["Gd", "Av", "Mn", "No"],
    "BsmtFinType1": ["GLQ", "ALQ", "BLQ", "Rec", "LwQ", "Unf"],
    "BsmtFinType2": ["GLQ", "ALQ", "BLQ", "Rec", "LwQ", "Unf"],
    "HeatingQC": ["Ex", "Gd", "TA", "Fa", "Po"],
    "CentralAir": ["N", "Y"],
    "Electrical": ["SBrkr", "FuseA", "FuseF", "FuseP", "Mix"],
    "KitchenQual": ["Ex", "Gd", "TA", "Fa", "Po"],
    "Functional": ["Typ", "Min1", "Min2", "Mod", "Maj1", "Maj2", "Sev", "Sal"],
    "FireplaceQu": ["Ex", "Gd", "TA", "Fa", "Po"],
    "GarageType": ["2Types", "Attchd", "Basment", "BuiltIn", "CarPort", "Detchd"],
    "GarageFinish": ["Fin", "RFn", "Unf"],
    "GarageQual": ["Ex", "Gd", "TA", "Fa", "Po"],
    "GarageCond": ["Ex", "Gd", "TA", "Fa", "Po"],
    "PavedDrive": ["Y", "P", "N"],
    "PoolQC": ["Ex", "Gd", "TA", "Fa"],
    "Fence": ["GdPrv", "MnPrv", "GdWo", "MnWw"],
    "MiscFeature": ["Elev", "Gar2", "Othr", "Shed", "TenC"],
    "SaleType": ["WD", "CWD", "VWD", "New", "COD", "Con", "ConLw", "ConLI", "ConLD", "Oth"],
}

# Neighbourhood codes (code spelling), laid out by nation key.
NEIGHBORHOODS = ["Blmngtn", "Blueste", "BrDale", "BrkSide", "ClearCr", "CollgCr", "Crawfor",
                 "Edwards", "Gilbert", "IDOTRR", "MeadowV", "Mitchel", "NAmes", "NoRidge",
                 "NPkVill", "NridgHt", "NWAmes", "OldTown", "SWISU", "Sawyer", "SawyerW",
                 "Somerst", "StoneBr", "Timber", "Veenker"]
# Nation whose rows carry no LotFrontage at all (forces the global fallback).
BARE_NATION = 24

# Code columns laid out from real columns: name -> (kind, modulus, scale, masked).
# kind "int": place * scale as int; "dbl": place * scale as double.
# masked: one extra place becomes NULL, and so does an order without lines.
CODED_NUMERIC = {
    "MSSubClass": ("int", 16, 10, False),
    "OverallQual": ("int1", 10, 1, False),
    "OverallCond": ("int1", 10, 1, False),
    "MasVnrArea": ("dbl", 12, 25.0, True),
    "BsmtUnfSF": ("dbl", 20, 30.0, True),
    "BsmtFullBath": ("dbl", 3, 1.0, True),
    "BsmtHalfBath": ("dbl", 2, 1.0, True),
    "FullBath": ("int", 4, 1, False),
    "HalfBath": ("int", 3, 1, False),
    "KitchenAbvGr": ("int1", 3, 1, True),
    "Fireplaces": ("int", 4, 1, False),
    "GarageYrBlt": ("dbl", 60, 1.0, True),
    "GarageCars": ("dbl", 5, 1.0, True),
    "GarageArea": ("dbl", 9, 120.0, True),
    "WoodDeckSF": ("int", 8, 40, False),
    "OpenPorchSF": ("int", 6, 25, False),
    "EnclosedPorch": ("int", 10, 15, False),
    "3SsnPorch": ("int", 20, 12, False),
    "ScreenPorch": ("int", 12, 20, False),
    "PoolArea": ("int", 25, 30, False),
    "MiscVal": ("int", 10, 100, False),
}

# Code columns where one extra place is NULL (absent equipment or a gap).
MASKED_CATEGORIES = {
    "MSZoning", "Alley", "Exterior1st", "Exterior2nd", "MasVnrType", "BsmtQual", "BsmtCond",
    "BsmtExposure", "BsmtFinType1", "BsmtFinType2", "Electrical", "KitchenQual", "Functional",
    "FireplaceQu", "GarageType", "GarageFinish", "GarageQual", "GarageCond", "PoolQC", "Fence",
    "MiscFeature", "SaleType",
}


# Whole numbers read off the order frame, in words that Spark and DuckDB share.
SOURCES = {
    "priority": "CAST(substr(o_orderpriority, 1, 1) AS BIGINT)",
    "status": "CAST(instr('FOP', o_orderstatus) AS BIGINT)",
    "segment": "CAST(instr('ABFHM', substr(c_mktsegment, 1, 1)) AS BIGINT)",
    "nation": "CAST(c_nationkey AS BIGINT)",
    "day": "CAST(year(o_orderdate) * 372 + month(o_orderdate) * 31 + day(o_orderdate) AS BIGINT)",
    "price": "CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT)",
    "balance": "CAST(floor(c_acctbal * 100 + 0.5) AS BIGINT) + 100000",
    "lines": "CAST(n_lines AS BIGINT)",
    "quantity": "CAST(qty AS BIGINT)",
    "discount": "CAST(floor(disc * 10000) AS BIGINT)",
    "amount": "CAST(floor(ext * 100 + 0.5) AS BIGINT)",
}
# Which of them add up to a column's place, dealt in turn: (sources, divisor) for short and long code lists and for numbers.
_SHORT = [(("priority",), 1), (("segment",), 1), (("priority", "status"), 1), (("segment", "status"), 1), (("priority", "segment"), 1),
          (("priority", "nation"), 1), (("segment", "lines"), 1), (("priority", "quantity"), 1), (("status", "day"), 1), (("segment", "day"), 1)]
_LONG = [(("priority", "nation"), 1), (("segment", "day"), 1), (("nation", "quantity"), 1), (("status", "day"), 1), (("priority", "quantity"), 1)]
_NUMBER = [(("price",), 1), (("balance",), 1), (("quantity",), 1), (("amount",), 1), (("day",), 1), (("discount",), 1), (("price",), 100), (("amount",), 100), (("balance",), 100)]


def _layout():
    """name -> (sources, divisor, modulus, masked)."""
    lay = {}
    for i, (name, spec) in enumerate(CODED_NUMERIC.items()):
        lay[name] = (*_NUMBER[i % len(_NUMBER)], spec[1] + spec[3], spec[3])
    for i, (name, values) in enumerate(DOMAINS.items()):
        masked = name in MASKED_CATEGORIES
        rule = _SHORT if len(values) <= 6 else _LONG
        lay[name] = (*rule[i % len(rule)], len(values) + masked, masked)
    return lay


LAYOUT = _layout()


def _place(name, division):
    sources, divisor, modulus, masked = LAYOUT[name]
    total = " + ".join(f"_{x}" if masked else f"coalesce(_{x}, 0)" for x in sources)
    return f"CAST((({total}) {division} {divisor}) % {modulus} AS INTEGER)"


def _place_spark(name):
    return F.expr(_place(name, "div"))


def _place_sql(name):
    return _place(name, "//")


def _coded_numeric_spark(name, spec):
    kind, m, scale, masked = spec
    b = _place_spark(name)
    if kind == "int":
        v = (b * F.lit(scale)).cast("int")
    elif kind == "int1":
        v = (b + F.lit(1)).cast("int")
    else:
        v = b.cast("double") * F.lit(float(scale))
    return F.when(b < F.lit(m), v) if masked else v


def _coded_numeric_sql(name, spec):
    kind, m, scale, masked = spec
    b = _place_sql(name)
    if kind == "int":
        v = f"CAST({b} * {scale} AS INTEGER)"
    elif kind == "int1":
        v = f"CAST({b} + 1 AS INTEGER)"
    else:
        v = f"CAST({b} AS DOUBLE) * {float(scale)}"
    return f"CASE WHEN {b} < {m} THEN {v} END" if masked else v


def _category_spark(name, values):
    return map_values(_place_spark(name), dict(enumerate(values)), None)


def _category_sql(name, values):
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {_place_sql(name)} {arms} END"


def housing_standin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in the housing schema (train side: ``SalePrice`` included)."""
    of = order_frame(spark, sf_dir)
    hood = map_values("c_nationkey", dict(enumerate(NEIGHBORHOODS)), None)
    cols = [
        F.col("o_orderkey").alias("Id"),
        F.col("o_totalprice").alias("SalePrice"),
        F.when(bucket(F.col("o_orderkey"), "Neighborhood", 40) > 0, hood).alias("Neighborhood"),
        F.when(F.col("c_nationkey") != F.lit(BARE_NATION), F.col("qty")).alias("LotFrontage"),
        F.floor(F.col("c_acctbal") + F.lit(1000.0)).cast("int").alias("LotArea"),
        F.floor(F.col("ext") / F.lit(100.0)).cast("int").alias("GrLivArea"),
        (F.col("qty") * F.lit(10.0)).alias("TotalBsmtSF"),
        (F.col("qty") * F.lit(10.0) * (F.lit(1.0) - F.col("disc"))).alias("BsmtFinSF1"),
        F.col("n_lines").cast("double").alias("BsmtFinSF2"),
        F.floor(F.col("ext") / F.lit(200.0)).cast("int").alias("1stFlrSF"),
        (F.col("c_nationkey") * F.lit(10)).cast("int").alias("2ndFlrSF"),
        F.year("o_orderdate").alias("YrSold"),
        F.month("o_orderdate").alias("MoSold"),
        F.year("sd_first").alias("YearBuilt"),
        F.year("sd").alias("YearRemodAdd"),
    ]
    frame = of.select(*cols, *[F.expr(sql).alias(f"_{name}") for name, sql in SOURCES.items()])
    extra = [_coded_numeric_spark(n, s).alias(n) for n, s in CODED_NUMERIC.items()]
    extra += [_category_spark(n, v).alias(n) for n, v in DOMAINS.items()]
    base = [c for c in frame.columns if not c.startswith("_")]
    return frame.select(*base, *extra)


def standin_sql() -> str:
    """DuckDB SQL producing exactly :func:`housing_standin`."""
    hood = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(NEIGHBORHOODS))
    inner = f"""
SELECT f.o_orderkey AS "Id", f.o_totalprice AS "SalePrice",
       CASE WHEN {sql_bucket('f.o_orderkey', 'Neighborhood', 40)} > 0
            THEN CASE f.c_nationkey {hood} END END AS "Neighborhood",
       CASE WHEN f.c_nationkey <> {BARE_NATION} THEN f.qty END AS "LotFrontage", CAST(floor(f.c_acctbal + 1000.0) AS INTEGER) AS "LotArea",
       CAST(floor(f.ext / 100.0) AS INTEGER) AS "GrLivArea",
       f.qty * 10.0 AS "TotalBsmtSF", f.qty * 10.0 * (1.0 - f.disc) AS "BsmtFinSF1",
       CAST(f.n_lines AS DOUBLE) AS "BsmtFinSF2",
       CAST(floor(f.ext / 200.0) AS INTEGER) AS "1stFlrSF",
       CAST(f.c_nationkey * 10 AS INTEGER) AS "2ndFlrSF",
       CAST(year(f.o_orderdate) AS INTEGER) AS "YrSold",
       CAST(month(f.o_orderdate) AS INTEGER) AS "MoSold",
       CAST(year(f.sd_first) AS INTEGER) AS "YearBuilt",
       CAST(year(f.sd) AS INTEGER) AS "YearRemodAdd",
       {", ".join(f"{sql} AS _{name}" for name, sql in SOURCES.items())}
FROM ({ORDER_FRAME_SQL}) f"""
    extra = [f'{_coded_numeric_sql(n, s)} AS "{n}"' for n, s in CODED_NUMERIC.items()]
    extra += [f'{_category_sql(n, v)} AS "{n}"' for n, v in DOMAINS.items()]
    return (f"SELECT b.* EXCLUDE ({', '.join(f'_{name}' for name in SOURCES)}), {', '.join(extra)} "
            f"FROM ({inner}) b")


# Numeric columns laid out from real driver columns: (name, is_double).
REAL_NUMERIC = [("Id", False), ("SalePrice", True), ("LotFrontage", True), ("LotArea", False),
                ("GrLivArea", False), ("TotalBsmtSF", True), ("BsmtFinSF1", True),
                ("BsmtFinSF2", True), ("1stFlrSF", False), ("2ndFlrSF", False), ("YrSold", False),
                ("MoSold", False), ("YearBuilt", False), ("YearRemodAdd", False)]


def numeric_layout() -> list[tuple[str, bool]]:
    """Numeric columns of the stand-in in column order, flagged when double."""
    return REAL_NUMERIC + [(n, s[0] == "dbl") for n, s in CODED_NUMERIC.items()]


def standin_columns() -> list[str]:
    real = ["Id", "SalePrice", "Neighborhood"] + [c for c, _ in REAL_NUMERIC[2:]]
    return real + list(CODED_NUMERIC) + list(DOMAINS)
