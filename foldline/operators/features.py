"""Derived row-wise features of the housing recipe.

Each step is one projection (``withColumns``): the new columns are Column
expressions that reference each other directly, so Catalyst collapses them
into a single codegen'd stage and eliminates the shared sub-expressions.
Steps are schema-guarded exactly like the recipe they mirror: optional
inputs are skipped when absent, the required ones fail at analysis time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldline.functions.columns import (clamp_min, guarded_ratio, is_numeric, member_flag, not_equal_flag,
                                        nz, positive_flag, right_closed_bins, weighted_sum)

# Inputs of the basic feature step that are filled with 0 first.
BASIC_FILL_ZERO = [
    "TotalBsmtSF", "1stFlrSF", "2ndFlrSF",
    "FullBath", "HalfBath", "BsmtFullBath", "BsmtHalfBath",
    "OpenPorchSF", "EnclosedPorch", "3SsnPorch", "ScreenPorch",
    "PoolArea", "GarageArea", "Fireplaces",
]
# Squared area columns.
SQUARE_COLUMNS = ["GrLivArea", "TotalBsmtSF", "1stFlrSF", "2ndFlrSF", "GarageArea", "LotArea",
                  "MasVnrArea", "TotalSF"]
# Quality columns summed into TotalQualScore.
QUALITY_SCORE_COLUMNS = ["OverallQual", "ExterQual", "KitchenQual", "BsmtQual"]
# The ten domain features.
ADVANCED_FEATURES = ["HasBeenRemodeled", "BathPerSF", "KitchenValue", "TotalQualScore",
                     "SeasonSold", "Has2ndFloor", "GarageValue", "AgeBin", "FinishedBsmtRatio",
                     "OverallGrade"]
# Age bins (right-closed) and their labels; high-season months.
AGE_BIN_EDGES = [-1, 5, 15, 30, 50, 200]
AGE_BIN_LABELS = [4, 3, 2, 1, 0]
HIGH_SEASON_MONTHS = [3, 4, 5, 6]


def _numeric(df: DataFrame, c: str) -> bool:
    return c in df.columns and is_numeric(df.schema[c].dataType)


def add_features(df: DataFrame) -> DataFrame:
    """Totals, ages, flags, interactions, guarded ratios and quality scores."""
    for c in BASIC_FILL_ZERO + ["YrSold", "YearBuilt", "YearRemodAdd"]:
        if c not in df.columns:
            raise ValueError(f"add_features needs column {c!r}")
    has = set(df.columns)
    total_sf = weighted_sum(["TotalBsmtSF", "1stFlrSF", "2ndFlrSF"])
    porch = weighted_sum(["OpenPorchSF", "EnclosedPorch", "3SsnPorch", "ScreenPorch"])
    new = {
        "TotalSF": total_sf,
        "TotalBath": weighted_sum([("FullBath", 1), ("HalfBath", 0.5), ("BsmtFullBath", 1),
                                   ("BsmtHalfBath", 0.5)]),
        "Age": clamp_min(F.col("YrSold") - F.col("YearBuilt")),
        "RemodAge": clamp_min(F.col("YrSold") - F.col("YearRemodAdd")),
        "TotalPorchSF": porch,
        "HasPool": positive_flag("PoolArea"),
        "HasGarage": positive_flag("GarageArea"),
        "HasBasement": positive_flag("TotalBsmtSF"),
        "HasFireplace": positive_flag("Fireplaces"),
    }
    if "OverallQual" in has:
        oq = nz("OverallQual")
        new["QualSF"] = oq * total_sf
        if "GrLivArea" in has:
            new["QualFinishSF"] = oq * nz("GrLivArea")
        if "OverallCond" in has:
            new["OverallScore"] = oq * nz("OverallCond")
    if "GarageCars" in has and "GarageArea" in has:
        new["GarageInteraction"] = nz("GarageCars") * nz("GarageArea")
    if "BsmtFinSF1" in has and "TotalBsmtSF" in has:
        new["BsmtFinRatio"] = guarded_ratio("BsmtFinSF1", "TotalBsmtSF")
    if "GrLivArea" in has and "LotArea" in has:
        new["LivAreaRatio"] = guarded_ratio("GrLivArea", "LotArea")
    if "WoodDeckSF" in has:
        new["TotalOutdoorSF"] = nz("WoodDeckSF") + porch
    if _numeric(df, "BsmtQual"):
        new["BsmtScore"] = F.col("BsmtQual") * nz("TotalBsmtSF")
    if _numeric(df, "GarageQual"):
        new["GarageScore"] = F.col("GarageQual") * nz("GarageArea")
    if _numeric(df, "ExterQual"):
        new["ExterScore"] = F.col("ExterQual") * total_sf
    return df.withColumns(new)


def add_poly_features(df: DataFrame) -> DataFrame:
    """``{col}_sq`` of the area columns (as double) and TotalSF x OverallQual."""
    new = {}
    for c in SQUARE_COLUMNS:
        if c in df.columns:
            x = nz(c).cast("double")
            new[f"{c}_sq"] = x * x
    if "TotalSF" in df.columns and "OverallQual" in df.columns:
        new["TotalSF_x_OverallQual"] = nz("TotalSF") * nz("OverallQual")
    return df.withColumns(new) if new else df


def add_advanced_features(df: DataFrame) -> DataFrame:
    """The ten domain features (each skipped when its inputs are absent)."""
    has = set(df.columns)
    new = {}
    if "YearRemodAdd" in has and "YearBuilt" in has:
        new["HasBeenRemodeled"] = not_equal_flag("YearRemodAdd", "YearBuilt")
    if "TotalBath" in has and "TotalSF" in has:
        new["BathPerSF"] = guarded_ratio("TotalBath", "TotalSF", fill_num=False, fill_den=False)
    if "KitchenQual" in has and "KitchenAbvGr" in has and _numeric(df, "KitchenQual"):
        new["KitchenValue"] = F.col("KitchenQual") * nz("KitchenAbvGr", 1)
    quals = [c for c in QUALITY_SCORE_COLUMNS if _numeric(df, c)]
    if quals:
        new["TotalQualScore"] = weighted_sum(quals)
    if "MoSold" in has:
        new["SeasonSold"] = member_flag("MoSold", HIGH_SEASON_MONTHS)
    if "2ndFlrSF" in has:
        new["Has2ndFloor"] = positive_flag("2ndFlrSF")
    if "GarageCars" in has and "GarageFinish" in has and _numeric(df, "GarageFinish"):
        new["GarageValue"] = nz("GarageCars") * F.col("GarageFinish")
    if "Age" in has:
        new["AgeBin"] = right_closed_bins("Age", AGE_BIN_EDGES, AGE_BIN_LABELS, 0.0)
    if "BsmtFinSF1" in has and "TotalBsmtSF" in has:
        fin = nz("BsmtFinSF1") + (nz("BsmtFinSF2") if "BsmtFinSF2" in has else F.lit(0))
        new["FinishedBsmtRatio"] = guarded_ratio(fin, "TotalBsmtSF", fill_num=False)
    if "OverallQual" in has and "OverallCond" in has:
        new["OverallGrade"] = F.col("OverallQual") * F.col("OverallCond")
    return df.withColumns(new) if new else df


def count_advanced_features(df: DataFrame) -> int:
    """How many of the ten domain features exist (schema only, no job)."""
    return len(set(df.columns) & set(ADVANCED_FEATURES))
