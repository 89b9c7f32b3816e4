"""The housing recipe: the column lists and code maps of the sale-price study,
expressed with the generic operators. ``clean_data``, ``encode_ordinals``,
``add_spatial_clusters`` are ``df -> df`` steps for :func:`run_steps`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from foldline.operators.encode import OrdinalMap, TierLookup, flag_equals
from foldline.operators.features import add_advanced_features, add_features, add_poly_features
from foldline.operators.impute import (cast_to_string, fill_constant, fill_group_median,
                                       fill_mode, outlier_condition)

# ---- Fixed values (cleaning) -------------------------------------------------
NONE_FILL_COLUMNS = [
    "PoolQC", "MiscFeature", "Alley", "Fence", "FireplaceQu",
    "GarageType", "GarageFinish", "GarageQual", "GarageCond",
    "BsmtQual", "BsmtCond", "BsmtExposure", "BsmtFinType1", "BsmtFinType2",
    "MasVnrType",
]
ZERO_FILL_COLUMNS = [
    "GarageYrBlt", "GarageArea", "GarageCars",
    "BsmtFinSF1", "BsmtFinSF2", "BsmtUnfSF", "TotalBsmtSF", "BsmtFullBath", "BsmtHalfBath",
    "MasVnrArea",
]
MODE_FILL_COLUMNS = ["MSZoning", "Electrical", "KitchenQual", "Exterior1st", "Exterior2nd",
                     "SaleType"]
FUNCTIONAL_DEFAULT = "Typ"
CODE_AS_STRING = ["MSSubClass"]
# Outlier rule: GrLivArea > 4000 and SalePrice < 300000.
OUTLIER_RULES = [("GrLivArea", ">", 4000), ("SalePrice", "<", 300000)]

# ---- Fixed values (ordinal maps) ---------------------------------------------
QUALITY_MAP = {"None": 0, "Po": 1, "Fa": 2, "TA": 3, "Gd": 4, "Ex": 5}
QUALITY_COLUMNS = ["ExterQual", "ExterCond", "BsmtQual", "BsmtCond", "HeatingQC", "KitchenQual",
                   "FireplaceQu", "GarageQual", "GarageCond", "PoolQC"]
BSMT_EXPOSURE_MAP = {"None": 0, "No": 1, "Mn": 2, "Av": 3, "Gd": 4}
BSMT_FIN_TYPE_MAP = {"None": 0, "Unf": 1, "LwQ": 2, "Rec": 3, "BLQ": 4, "ALQ": 5, "GLQ": 6}
GARAGE_FINISH_MAP = {"None": 0, "Unf": 1, "RFn": 2, "Fin": 3}
FENCE_MAP = {"None": 0, "MnWw": 1, "GdWo": 2, "MnPrv": 3, "GdPrv": 4}
FUNCTIONAL_MAP = {"Sal": 1, "Sev": 2, "Maj2": 3, "Maj1": 4, "Mod": 5, "Min2": 6, "Min1": 7,
                  "Typ": 8}
PAVED_DRIVE_MAP = {"N": 0, "P": 1, "Y": 2}
LOT_SHAPE_MAP = {"IR3": 0, "IR2": 1, "IR1": 2, "Reg": 3}
LAND_SLOPE_MAP = {"Sev": 0, "Mod": 1, "Gtl": 2}

ORDINAL_STEPS = [
    OrdinalMap(QUALITY_COLUMNS, QUALITY_MAP, 0),
    OrdinalMap(["BsmtExposure"], BSMT_EXPOSURE_MAP, 0),
    OrdinalMap(["BsmtFinType1", "BsmtFinType2"], BSMT_FIN_TYPE_MAP, 0),
    OrdinalMap(["GarageFinish"], GARAGE_FINISH_MAP, 0),
    OrdinalMap(["Fence"], FENCE_MAP, 0),
    OrdinalMap(["Functional"], FUNCTIONAL_MAP, 8),
    OrdinalMap(["PavedDrive"], PAVED_DRIVE_MAP, 0),
    OrdinalMap(["LotShape"], LOT_SHAPE_MAP, 0),
    OrdinalMap(["LandSlope"], LAND_SLOPE_MAP, 2),
]

# ---- Fixed values (price tiers of neighbourhoods) -----------------------------
NEIGHBORHOOD_TIERS = {
    "MeadowV": 0, "IDOTRR": 0, "BrDale": 0, "OldTown": 0, "Edwards": 0, "BrkSide": 0,
    "Sawyer": 0, "Blueste": 0, "SWISU": 0,
    "NAmes": 1, "NPkVill": 1, "Mitchel": 1, "SawyerW": 1, "Gilbert": 1, "NWAmes": 1,
    "Blmngtn": 1, "CollgCr": 1,
    "ClearCr": 2, "Crawfor": 2, "Veenker": 2, "Somerst": 2, "Timber": 2,
    "StoneBr": 3, "NoRidge": 3, "NridgHt": 3,
}
NEIGHBORHOOD_TIER_DEFAULT = 1

# ---- Fixed values (run configuration) -----------------------------------------
DROP_FEATURES = ["Utilities", "Street", "PoolQC", "PoolArea", "MiscFeature", "MiscVal", "Id",
                 "HouseStyle_1.5Unf"]
TARGET_ENCODE_COLUMNS = ["Neighborhood", "Condition1", "Exterior1st", "Exterior2nd"]
ACTIVE_MODELS = ["XGBoost", "CatBoost", "ExtraTrees", "LightGBM", "Linear_Ridge", "Linear_Lasso"]
RANDOM_STATE = 42
N_SPLITS = 5


def clean_data(df: DataFrame) -> DataFrame:
    """Constant, zero, mode, default and group-median fills, then code casts.

    The step fits its statistics on its own input (several passes over it);
    the runner hands it a materialised table.
    """
    out = fill_constant(df, NONE_FILL_COLUMNS, "None")
    out = fill_constant(out, ZERO_FILL_COLUMNS, 0)
    out = fill_mode(out, MODE_FILL_COLUMNS)
    out = fill_constant(out, ["Functional"], FUNCTIONAL_DEFAULT)
    if "LotFrontage" in out.columns and "Neighborhood" in out.columns:
        out = fill_group_median(out, "LotFrontage", "Neighborhood")
    return cast_to_string(out, CODE_AS_STRING)


def encode_ordinals(df: DataFrame) -> DataFrame:
    """Quality and level codes to ordered ints; CentralAir to a 0/1 flag."""
    out = df
    for step in ORDINAL_STEPS:
        out = step.transform(out)
    return flag_equals(out, "CentralAir", "Y")


def add_spatial_clusters(df: DataFrame) -> DataFrame:
    return TierLookup("Neighborhood", NEIGHBORHOOD_TIERS, NEIGHBORHOOD_TIER_DEFAULT,
                      "Neighborhood_Clustered").transform(df)


def outlier_rule(df: DataFrame):
    return outlier_condition(df, OUTLIER_RULES)


@dataclass
class Recipe:
    """Configuration of one end-to-end run."""
    steps: list = field(default_factory=lambda: [clean_data, encode_ordinals, add_features,
                                                 add_advanced_features])
    drop_features: list = field(default_factory=lambda: list(DROP_FEATURES))
    target_encode_cols: list = field(default_factory=lambda: list(TARGET_ENCODE_COLUMNS))
    active_models: list = field(default_factory=lambda: list(ACTIVE_MODELS))
    id_col: str = "Id"
    target_col: str = "SalePrice"
    random_state: int = RANDOM_STATE
    n_splits: int = N_SPLITS
    skew_threshold: float = 0.75
    model_params: dict = field(default_factory=dict)


# Settings of the registered queries and entry(), smaller than the registry's: each boosted
# model takes longer steps, so that it meets its best round after tens of rounds, with a
# patience to match; the forest has 20 trees of depth 8.
_LONG_STEPS = {"maxIter": 500, "stepSize": 0.1, "patience": 10}
REDUCED_PARAMS = {"XGBoost": _LONG_STEPS, "CatBoost": _LONG_STEPS, "LightGBM": _LONG_STEPS,
                  "ExtraTrees": {"numTrees": 20, "maxDepth": 8}}


OPTIONAL_STEPS = {"add_spatial_clusters": add_spatial_clusters,
                  "add_poly_features": add_poly_features}
