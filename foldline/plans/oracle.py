"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark plans: plain SQL over the pre-registered
driver tables, with the hold-out fold means computed by correlated
sub-queries / non-equi joins instead of the additive statistics the Spark
side uses.
"""

from __future__ import annotations

from foldline.functions.hashing import sql_bucket, sql_sort_hash
from foldline.operators import features
from foldline.plans import housing
from foldline.sources.standin import numeric_layout, standin_columns, standin_sql

ORACLE: dict[str, str] = {}
K, SEED = 5, 42


def q(c: str) -> str:
    return f'"{c}"'


def nz(c: str, d=0) -> str:
    return f"coalesce({q(c)}, {d})"


def case_map(c: str, mapping: dict, default) -> str:
    arms = " ".join(f"WHEN '{k}' THEN {v}" for k, v in mapping.items())
    return f"CAST(CASE {q(c)} {arms} ELSE {default} END AS INTEGER)"


H = f"h AS ({standin_sql()})"


def encode_sql(src: str = "h") -> str:
    """Ordinal step over ``src``; other columns pass through."""
    maps = {c: (housing.QUALITY_MAP, 0) for c in housing.QUALITY_COLUMNS}
    maps.update({"BsmtExposure": (housing.BSMT_EXPOSURE_MAP, 0),
                 "BsmtFinType1": (housing.BSMT_FIN_TYPE_MAP, 0),
                 "BsmtFinType2": (housing.BSMT_FIN_TYPE_MAP, 0),
                 "GarageFinish": (housing.GARAGE_FINISH_MAP, 0),
                 "Fence": (housing.FENCE_MAP, 0), "Functional": (housing.FUNCTIONAL_MAP, 8),
                 "PavedDrive": (housing.PAVED_DRIVE_MAP, 0), "LotShape": (housing.LOT_SHAPE_MAP, 0),
                 "LandSlope": (housing.LAND_SLOPE_MAP, 2)})
    repl = [f"{case_map(c, m, d)} AS {q(c)}" for c, (m, d) in maps.items()]
    repl.append(f"CAST(coalesce({q('CentralAir')} = 'Y', false) AS INTEGER) AS {q('CentralAir')}")
    return f"SELECT * REPLACE ({', '.join(repl)}) FROM {src}"


def ratio(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) / CAST(CASE WHEN {den} = 0 THEN 1 ELSE {den} END AS DOUBLE)"


def clamp0(expr: str) -> str:
    return f"CASE WHEN ({expr}) IS NULL OR ({expr}) < 0 THEN 0 ELSE ({expr}) END"


def basic_sql(src: str) -> str:
    tsf = f"({nz('TotalBsmtSF')} + {nz('1stFlrSF')} + {nz('2ndFlrSF')})"
    porch = f"({nz('OpenPorchSF')} + {nz('EnclosedPorch')} + {nz('3SsnPorch')} + {nz('ScreenPorch')})"
    cols = {
        "TotalSF": tsf,
        "TotalBath": f"({nz('FullBath')} + 0.5::DOUBLE * {nz('HalfBath')} + {nz('BsmtFullBath')}"
                     f" + 0.5::DOUBLE * {nz('BsmtHalfBath')})",
        "Age": clamp0(f'"YrSold" - "YearBuilt"'),
        "RemodAge": clamp0(f'"YrSold" - "YearRemodAdd"'),
        "TotalPorchSF": porch,
        "HasPool": f"CAST({nz('PoolArea')} > 0 AS INTEGER)",
        "HasGarage": f"CAST({nz('GarageArea')} > 0 AS INTEGER)",
        "HasBasement": f"CAST({nz('TotalBsmtSF')} > 0 AS INTEGER)",
        "HasFireplace": f"CAST({nz('Fireplaces')} > 0 AS INTEGER)",
        "QualSF": f"{nz('OverallQual')} * {tsf}",
        "QualFinishSF": f"{nz('OverallQual')} * {nz('GrLivArea')}",
        "OverallScore": f"{nz('OverallQual')} * {nz('OverallCond')}",
        "GarageInteraction": f"{nz('GarageCars')} * {nz('GarageArea')}",
        "BsmtFinRatio": ratio(nz('BsmtFinSF1'), nz('TotalBsmtSF')),
        "LivAreaRatio": ratio(nz('GrLivArea'), nz('LotArea')),
        "TotalOutdoorSF": f"{nz('WoodDeckSF')} + {porch}",
        "BsmtScore": f'"BsmtQual" * {nz("TotalBsmtSF")}',
        "GarageScore": f'"GarageQual" * {nz("GarageArea")}',
        "ExterScore": f'"ExterQual" * {tsf}',
    }
    return f"SELECT *, {', '.join(f'{v} AS {q(k)}' for k, v in cols.items())} FROM {src}"


def advanced_sql(src: str) -> str:
    bins = " ".join(f'WHEN "Age" > {lo} AND "Age" <= {hi} THEN {float(lab)}'
                    for lo, hi, lab in zip(features.AGE_BIN_EDGES[:-1], features.AGE_BIN_EDGES[1:],
                                           features.AGE_BIN_LABELS))
    cols = {
        "HasBeenRemodeled": 'CAST(coalesce("YearRemodAdd" <> "YearBuilt", true) AS INTEGER)',
        "BathPerSF": ratio('"TotalBath"', '"TotalSF"'),
        "KitchenValue": f'"KitchenQual" * {nz("KitchenAbvGr", 1)}',
        "TotalQualScore": " + ".join(nz(c) for c in features.QUALITY_SCORE_COLUMNS),
        "SeasonSold": 'CAST(coalesce("MoSold" IN (3, 4, 5, 6), false) AS INTEGER)',
        "Has2ndFloor": f"CAST({nz('2ndFlrSF')} > 0 AS INTEGER)",
        "GarageValue": f'{nz("GarageCars")} * "GarageFinish"',
        "AgeBin": f"CAST(CASE {bins} ELSE 0.0 END AS DOUBLE)",
        "FinishedBsmtRatio": ratio(f"({nz('BsmtFinSF1')} + {nz('BsmtFinSF2')})", nz('TotalBsmtSF')),
        "OverallGrade": '"OverallQual" * "OverallCond"',
    }
    return f"SELECT *, {', '.join(f'{v} AS {q(k)}' for k, v in cols.items())} FROM {src}"


def r6(expr: str) -> str:
    return f"(floor(({expr}) * 1e6 + 0.5) / 1e6)"


def sel(cols, doubles=()) -> str:
    return ", ".join(f"{r6(q(c))} AS {q(c)}" if c in doubles else q(c) for c in cols)


def mode_sql(col: str, src: str = "h") -> str:
    return (f"(SELECT v FROM (SELECT {q(col)} AS v, count(*) AS n FROM {src} "
            f"WHERE {q(col)} IS NOT NULL GROUP BY 1) ORDER BY n DESC, v ASC LIMIT 1)")


# ---------------------------------------------------------------- cleaning
ORACLE["fill_const"] = (
    f"WITH {H} SELECT \"Id\", "
    + ", ".join(f"coalesce({q(c)}, 'None') AS {q(c)}" for c in housing.NONE_FILL_COLUMNS)
    + ", coalesce(\"Functional\", 'Typ') AS \"Functional\" FROM h")

ORACLE["fill_zero"] = (
    f"WITH {H} SELECT \"Id\", "
    + ", ".join(f"coalesce({q(c)}, 0) AS {q(c)}" for c in housing.ZERO_FILL_COLUMNS) + " FROM h")

ORACLE["fill_mode"] = (
    f"WITH {H} SELECT \"Id\", "
    + ", ".join(f"coalesce({q(c)}, {mode_sql(c)}) AS {q(c)}" for c in housing.MODE_FILL_COLUMNS)
    + " FROM h")

ORACLE["mode_smallest"] = f"WITH {H} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {mode_sql(c)} AS \"mode\"" for c in housing.MODE_FILL_COLUMNS)

GROUP_MEDIAN_FILL = """
gm AS (SELECT "Neighborhood" AS k, median("LotFrontage") AS m FROM {src}
       WHERE "Neighborhood" IS NOT NULL GROUP BY 1),
s1 AS (SELECT s.*, CASE WHEN s."Neighborhood" IS NOT NULL THEN coalesce(s."LotFrontage", gm.m) END AS lf1
       FROM {src} s LEFT JOIN gm ON s."Neighborhood" = gm.k),
s2 AS (SELECT s1.* REPLACE (coalesce(lf1, (SELECT median(lf1) FROM s1)) AS "LotFrontage") FROM s1)
"""

ORACLE["fill_group_median"] = (
    f"WITH {H}, {GROUP_MEDIAN_FILL.format(src='h')} "
    "SELECT \"Id\", \"Neighborhood\", " + r6('"LotFrontage"') + " AS \"LotFrontage\" FROM s2")

ORACLE["group_median"] = (
    f"WITH {H} SELECT \"Neighborhood\", " + r6('median("LotFrontage")') + " AS median_lot_frontage "
    "FROM h WHERE \"Neighborhood\" IS NOT NULL GROUP BY 1")

ORACLE["cast_code"] = f"WITH {H} SELECT \"Id\", CAST(\"MSSubClass\" AS VARCHAR) AS \"MSSubClass\" FROM h"

ORACLE["drop_outliers"] = (
    f"WITH {H} SELECT \"Id\", \"GrLivArea\", \"SalePrice\" FROM h "
    "WHERE NOT coalesce(\"GrLivArea\" > 4000 AND \"SalePrice\" < 300000, false)")

ORACLE["outlier_count"] = (
    f"WITH {H} SELECT count(*) FILTER (WHERE \"GrLivArea\" > 4000 AND \"SalePrice\" < 300000) "
    "AS n_removed FROM h")


def clean_sql(src: str = "h") -> str:
    """CTEs c1..c3 (last: ``cleaned``) reproducing the cleaning step."""
    fills = [f"coalesce({q(c)}, 'None') AS {q(c)}" for c in housing.NONE_FILL_COLUMNS]
    fills += [f"coalesce({q(c)}, 0) AS {q(c)}" for c in housing.ZERO_FILL_COLUMNS]
    c1 = f"c1 AS (SELECT * REPLACE ({', '.join(fills)}) FROM {src})"
    modes = [f"coalesce({q(c)}, {mode_sql(c, 'c1')}) AS {q(c)}" for c in housing.MODE_FILL_COLUMNS]
    modes.append("coalesce(\"Functional\", 'Typ') AS \"Functional\"")
    c2 = f"c2 AS (SELECT * REPLACE ({', '.join(modes)}) FROM c1)"
    gmf = GROUP_MEDIAN_FILL.format(src="c2")
    c3 = ("cleaned AS (SELECT * EXCLUDE (lf1) REPLACE (CAST(\"MSSubClass\" AS VARCHAR) AS "
          "\"MSSubClass\") FROM s2)")
    return f"{c1}, {c2}, {gmf}, {c3}"


ORACLE["clean_data"] = (
    f"WITH {H}, {clean_sql()} SELECT \"Id\", \"MSZoning\", \"KitchenQual\", \"SaleType\", "
    "\"Functional\", \"PoolQC\", \"GarageYrBlt\", \"MSSubClass\", "
    + r6('"LotFrontage"') + " AS \"LotFrontage\" FROM cleaned")

# ---------------------------------------------------------------- encodings
ORDINAL_OUT = housing.QUALITY_COLUMNS + ["BsmtExposure", "BsmtFinType1", "BsmtFinType2",
                                         "GarageFinish", "Fence", "Functional", "PavedDrive",
                                         "CentralAir", "LotShape", "LandSlope"]
ENC = f"{H}, p AS ({encode_sql('h')})"
ORACLE["ordinal_encode"] = f"WITH {ENC} SELECT \"Id\", {sel(ORDINAL_OUT)} FROM p"
ORACLE["ordinal_default"] = (
    f"WITH {H} SELECT \"Id\", {case_map('Functional', housing.FUNCTIONAL_MAP, 8)} AS \"Functional\", "
    f"{case_map('LandSlope', housing.LAND_SLOPE_MAP, 2)} AS \"LandSlope\" FROM h")
ORACLE["flag_equals"] = (
    f"WITH {H} SELECT \"Id\", CAST(coalesce(\"CentralAir\" = 'Y', false) AS INTEGER) AS \"CentralAir\" FROM h")
ORACLE["tier_lookup"] = (
    f"WITH {H} SELECT \"Id\", \"Neighborhood\", "
    f"{case_map('Neighborhood', housing.NEIGHBORHOOD_TIERS, 1)} AS \"Neighborhood_Clustered\" FROM h")

# ---------------------------------------------------------------- features
FEAT = f"{ENC}, fb AS ({basic_sql('p')}), fa AS ({advanced_sql('fb')})"
DOUBLE_FEATURES = {"TotalSF", "TotalBath", "QualSF", "GarageInteraction", "BsmtFinRatio",
                   "LivAreaRatio", "BsmtScore", "GarageScore", "ExterScore", "BathPerSF",
                   "GarageValue", "AgeBin", "FinishedBsmtRatio"}
BASIC = ["TotalSF", "TotalBath", "Age", "RemodAge", "TotalPorchSF", "HasPool", "HasGarage",
         "HasBasement", "HasFireplace", "QualSF", "QualFinishSF", "OverallScore",
         "GarageInteraction", "BsmtFinRatio", "LivAreaRatio", "TotalOutdoorSF", "BsmtScore",
         "GarageScore", "ExterScore"]
ORACLE["features_basic"] = f"WITH {FEAT} SELECT \"Id\", {sel(BASIC, DOUBLE_FEATURES)} FROM fb"
ORACLE["features_advanced"] = (
    f"WITH {FEAT} SELECT \"Id\", {sel(features.ADVANCED_FEATURES, DOUBLE_FEATURES)} FROM fa")

FEATURE_GROUPS = {
    "feat_sum": ["TotalSF", "TotalBath", "TotalPorchSF", "TotalOutdoorSF"],
    "feat_age": ["Age", "RemodAge"],
    "feat_flags": ["HasPool", "HasGarage", "HasBasement", "HasFireplace", "Has2ndFloor"],
    "feat_product": ["QualSF", "QualFinishSF", "OverallScore", "GarageInteraction", "BsmtScore",
                     "GarageScore", "ExterScore", "KitchenValue", "GarageValue", "OverallGrade"],
    "feat_ratio": ["BsmtFinRatio", "LivAreaRatio", "BathPerSF", "FinishedBsmtRatio"],
    "feat_not_equal": ["HasBeenRemodeled"],
    "feat_rowsum_dynamic": ["TotalQualScore"],
    "feat_season": ["SeasonSold"],
    "feat_bin": ["AgeBin"],
}
for _n, _cols in FEATURE_GROUPS.items():
    ORACLE[_n] = f"WITH {FEAT} SELECT \"Id\", {sel(_cols, DOUBLE_FEATURES)} FROM fa"

_SQ = [f"{c}_sq" for c in features.SQUARE_COLUMNS]
ORACLE["feat_square"] = (
    f"WITH {ENC}, fb AS ({basic_sql('p')}) SELECT \"Id\", "
    + ", ".join(f"{r6(f'CAST({nz(c)} AS DOUBLE) * CAST({nz(c)} AS DOUBLE)')} AS {q(c + '_sq')}"
                for c in features.SQUARE_COLUMNS)
    + ", " + r6('coalesce("TotalSF", 0) * coalesce("OverallQual", 0)') + " AS \"TotalSF_x_OverallQual\" FROM fb")

_CHAIN = ["LotFrontage", "MSZoning", "KitchenQual", "Functional", "MSSubClass", "TotalSF",
          "TotalBath", "Age", "QualSF", "BsmtScore", "BathPerSF", "KitchenValue",
          "TotalQualScore", "AgeBin", "FinishedBsmtRatio"]
ORACLE["recipe_chain"] = (
    f"WITH {H}, {clean_sql()}, p AS ({encode_sql('cleaned')}), fb AS ({basic_sql('p')}), "
    f"fa AS ({advanced_sql('fb')}) SELECT \"Id\", {sel(_CHAIN, DOUBLE_FEATURES | {'LotFrontage'})} FROM fa")

# ---------------------------------------------------------------- folds, target encoding
FOLD = sql_bucket("o_orderkey", str(SEED), K)
OT = (f"ot AS (SELECT o_orderkey, o_orderstatus, o_totalprice, ln(1 + o_totalprice) AS label, "
      f"CASE WHEN {sql_bucket('o_orderkey', 'prio_mask', 20)} > 0 THEN o_orderpriority END AS o_orderpriority, "
      f"{FOLD} AS fold FROM orders)")

ORACLE["kfold_assign"] = f"SELECT o_orderkey, {FOLD} AS fold FROM orders"
ORACLE["kfold_balanced"] = (
    f"SELECT o_orderkey, CAST(ntile({K}) OVER (ORDER BY {sql_sort_hash('o_orderkey', str(SEED))}) - 1 "
    "AS INTEGER) AS fold FROM orders")

_TE_OOF = ("coalesce((SELECT avg(b.label) FROM ot b WHERE b.o_orderpriority = a.o_orderpriority "
           "AND b.fold <> a.fold), (SELECT avg(label) FROM ot))")
ORACLE["target_encode_oof"] = (
    f"WITH {OT} SELECT a.o_orderkey, a.fold, {r6(_TE_OOF)} AS o_orderpriority_te FROM ot a")

HOLD = sql_bucket("o_orderkey", "holdout", 10)
ORACLE["target_encode_full"] = (
    f"WITH {OT}, tr AS (SELECT * FROM ot WHERE {HOLD} <> 0), sc AS (SELECT * FROM ot WHERE {HOLD} = 0) "
    "SELECT s.o_orderkey, " + r6("coalesce((SELECT avg(t.label) FROM tr t WHERE t.o_orderpriority = "
                                 "s.o_orderpriority), (SELECT avg(label) FROM tr))")
    + " AS o_orderpriority_te FROM sc s")

_TE = housing.TARGET_ENCODE_COLUMNS
ORACLE["target_encode_multi"] = (
    f"WITH {H}, t AS (SELECT *, ln(1 + \"SalePrice\") AS label, {sql_bucket(q('Id'), str(SEED), K)} AS fold FROM h) "
    "SELECT a.\"Id\", "
    + ", ".join(r6(f"coalesce((SELECT avg(b.label) FROM t b WHERE b.{q(c)} = a.{q(c)} AND b.fold <> a.fold), "
                   f"(SELECT avg(label) FROM t))") + f" AS {q(c + '_te')}" for c in _TE)
    + " FROM t a")

ORACLE["global_mean"] = f"WITH {OT} SELECT {r6('avg(label)')} AS mean_label FROM ot"
ORACLE["group_mean"] = (
    f"WITH {OT} SELECT o_orderstatus, {r6('avg(label)')} AS mean_label, count(*) AS n "
    "FROM ot GROUP BY 1")

# ---------------------------------------------------------------- projections
_NUM = numeric_layout()
_DBL = {c for c, is_d in _NUM if is_d}
ORACLE["select_numeric"] = f"WITH {H} SELECT {sel([c for c, _ in _NUM], _DBL)} FROM h"
_DROP = [c for c in housing.DROP_FEATURES if c in standin_columns()]
ORACLE["drop_tolerant"] = (
    f"WITH {H} SELECT * EXCLUDE ({', '.join(q(c) for c in _DROP)}) REPLACE ("
    + ", ".join(f"{r6(q(c))} AS {q(c)}" for c in sorted(_DBL) if c not in _DROP) + ") FROM h")
ORACLE["head_n"] = (
    f"WITH {H} SELECT \"Id\", \"Neighborhood\", \"GrLivArea\", \"SalePrice\" FROM h "
    "ORDER BY \"Id\" LIMIT 2")


# ---------------------------------------------------------------- linear stacking on the order frame
from foldline.sources.tables import ORDER_FRAME_SQL  # noqa: E402

EPS = 2.220446049250313e-16
RIDGE_ALPHA, META_ALPHA = 10.0, 1.0
BLEND_WEIGHTS = [0.9, 0.8, 0.7, 0.6]
TUNE_ALPHAS = [1e-4, 1e-3, 1e-2, 1e-1, 1.0]


def em1(x: str) -> str:
    return f"(exp({x}) - 1)"


def ae(y: str, p: str) -> str:
    return f"abs({em1(y)} - {em1(p)})"


def pe(y: str, p: str) -> str:
    return f"(abs({em1(y)} - {em1(p)}) / greatest(abs({em1(y)}), {EPS}))"


def ridge2_stats(src: str, x1: str, x2: str, y: str = "label") -> str:
    """Centred sums of a 2-feature design over ``src`` (with ``g`` grouping)."""
    return (f"count(*) AS n, avg({x1}) AS m1, avg({x2}) AS m2, avg({y}) AS my, "
            f"var_pop({x1}) * count(*) AS s11, var_pop({x2}) * count(*) AS s22, "
            f"covar_pop({x1}, {x2}) * count(*) AS s12, covar_pop({x1}, {y}) * count(*) AS s1y, "
            f"covar_pop({x2}, {y}) * count(*) AS s2y")


def ridge2_coefs(alpha: str) -> str:
    det = f"(((s11 + {alpha}) * (s22 + {alpha})) - s12 * s12)"
    w1 = f"(((s22 + {alpha}) * s1y - s12 * s2y) / {det})"
    w2 = f"(((s11 + {alpha}) * s2y - s12 * s1y) / {det})"
    return f"{w1} AS w1, {w2} AS w2, my - {w1} * m1 - {w2} * m2 AS b"


MF = (f"mf AS (SELECT o_orderkey, ln(1 + o_totalprice) AS label, coalesce(qty, 0.0) AS x_qty, "
      f"coalesce(disc, 0.0) * 100.0 AS x_disc, "
      f"CASE WHEN {sql_bucket('o_orderkey', 'prio_mask', 20)} > 0 THEN o_orderpriority END AS prio, "
      f"{sql_bucket('o_orderkey', 'holdout', 10)} = 0 AS scoring, "
      f"{sql_bucket('o_orderkey', str(SEED), K)} AS fold FROM ({ORDER_FRAME_SQL}) z)")
TR = "tr AS (SELECT * FROM mf WHERE NOT scoring), fi AS (SELECT unnest(range(5)) AS i)"
RC = (f"rs AS (SELECT fi.i, {ridge2_stats('t', 't.x_qty', 't.x_disc', 't.label')} "
      "FROM fi JOIN tr t ON t.fold <> fi.i GROUP BY fi.i), "
      f"rc AS (SELECT i, {ridge2_coefs(str(RIDGE_ALPHA))} FROM rs)")
OOF = "oof AS (SELECT t.*, rc.b + rc.w1 * t.x_qty + rc.w2 * t.x_disc AS pred FROM tr t JOIN rc ON rc.i = t.fold)"
BASE = f"WITH {MF}, {TR}, {RC}, {OOF}"
TE_OOF = ("coalesce((SELECT avg(b.label) FROM tr b WHERE b.prio = o.prio AND b.fold <> o.fold), "
          "(SELECT avg(label) FROM tr))")
TE_FULL = "coalesce((SELECT avg(b.label) FROM tr b WHERE b.prio = s.prio), (SELECT avg(label) FROM tr))"
ST = (f"st AS (SELECT o.o_orderkey, o.fold, o.label, o.pred AS ridge, {TE_OOF} AS te FROM oof o), "
      f"sp AS (SELECT s.o_orderkey, (SELECT avg(rc.b + rc.w1 * s.x_qty + rc.w2 * s.x_disc) FROM rc) "
      f"AS ridge, {TE_FULL} AS te FROM mf s WHERE s.scoring)")
STACK = f"{BASE}, {ST}"
META = (f"ms AS (SELECT {ridge2_stats('st', 'ridge', 'te')} FROM st), "
        f"mc AS (SELECT {ridge2_coefs(str(META_ALPHA))} FROM ms)")
LONG = ("lp AS (SELECT o_orderkey, fold, label, 'ridge' AS model, ridge AS pred FROM st "
        "UNION ALL SELECT o_orderkey, fold, label, 'te' AS model, te AS pred FROM st)")
MT = (f"mt0 AS (SELECT model, fold, avg({ae('label', 'pred')}) AS mae, avg({pe('label', 'pred')}) AS mape "
      "FROM lp GROUP BY ROLLUP (model, fold)), "
      "mt AS (SELECT model, fold, 'mae' AS metric, mae AS value FROM mt0 WHERE model IS NOT NULL "
      "UNION ALL SELECT model, fold, 'mape' AS metric, mape AS value FROM mt0 WHERE model IS NOT NULL)")

ORACLE["ridge_oof"] = f"{BASE} SELECT o_orderkey, fold, {r6('pred')} AS pred FROM oof"
_MAE_OOF = r6("avg(" + ae("label", "pred") + ")")
_MAPE_OOF = r6("avg(" + pe("label", "pred") + ")")
ORACLE["mae_by_fold"] = f"{BASE} SELECT fold, {_MAE_OOF} AS mae FROM oof GROUP BY ROLLUP (fold)"
ORACLE["mape"] = f"{BASE} SELECT fold, {_MAPE_OOF} AS mape FROM oof GROUP BY ROLLUP (fold)"
ORACLE["metric_table"] = f"{STACK}, {LONG}, {MT} SELECT model, fold, metric, {r6('value')} AS value FROM mt"
ORACLE["cv_summary"] = (
    f"{STACK}, {LONG}, {MT} SELECT model, {r6('avg(value)')} AS mae_mean, "
    f"{r6('stddev_pop(value)')} AS mae_std, count(*) AS n_folds FROM mt "
    "WHERE fold IS NOT NULL AND metric = 'mae' GROUP BY model")
ORACLE["meta_matrix"] = (
    f"{STACK} SELECT o_orderkey, fold, {r6('label')} AS label, {r6('ridge')} AS ridge, "
    f"{r6('te')} AS te FROM st")
ORACLE["meta_ridge"] = (
    f"{STACK}, {META} SELECT term, floor(coef * 1e4 + 0.5) / 1e4 AS coef FROM ("
    "SELECT 'ridge' AS term, w1 AS coef FROM mc UNION ALL SELECT 'te', w2 FROM mc "
    "UNION ALL SELECT 'intercept', b FROM mc)")
def blend(w: float) -> str:
    """``w * ridge + (1 - w) * te`` with the same double constants as Spark."""
    return f"({w!r}::DOUBLE * ridge + {1.0 - w!r}::DOUBLE * te)"


ORACLE["blend_sweep"] = f"{STACK} " + " UNION ALL ".join(
    f"SELECT {r6(f'{w!r}::DOUBLE')} AS weight, " + r6("avg(" + ae("label", blend(w)) + ")") + " AS mae FROM st"
    for w in BLEND_WEIGHTS)
_CANDS = (" UNION ALL ".join(
    [f"SELECT 'ridge' AS candidate, avg({ae('label', 'ridge')}) AS mae, 0 AS priority FROM st",
     f"SELECT 'te' AS candidate, avg({ae('label', 'te')}) AS mae, 1 AS priority FROM st"]
    + [f"SELECT 'blend_{w!r}' AS candidate, avg({ae('label', blend(w))}) AS mae, {i + 2} AS priority FROM st"
       for i, w in enumerate(BLEND_WEIGHTS)]))
ORACLE["best_candidate"] = (
    f"{STACK} SELECT candidate, {r6('mae')} AS mae FROM ({_CANDS}) ORDER BY mae, priority LIMIT 1")
ORACLE["fold_mean_pred"] = f"{STACK} SELECT o_orderkey, {r6('ridge')} AS pred FROM sp"
ORACLE["oof_coverage"] = (
    f"WITH {MF}, {TR} SELECT o_orderkey, fold, model, CAST(1 AS BIGINT) AS n_preds FROM tr, (SELECT unnest(['Linear_Ridge', 'Linear_Lasso']) AS model)")

_GRID = ("ga AS (SELECT t AS trial, a AS alpha FROM (SELECT unnest(range(" + str(len(TUNE_ALPHAS)) +
         ")) AS t, unnest([" + ", ".join(f"{a!r}::DOUBLE" for a in TUNE_ALPHAS) + "]) AS a))")
_TUNE = (f"{STACK}, {_GRID}, "
         f"gs AS (SELECT ga.trial, ga.alpha, fi.i, {ridge2_stats('st', 's.ridge', 's.te', 's.label')} "
         "FROM ga, fi JOIN st s ON s.fold <> fi.i GROUP BY ga.trial, ga.alpha, fi.i), "
         f"gc AS (SELECT trial, alpha, i, {ridge2_coefs('alpha * n')} FROM gs), "
         f"gm AS (SELECT gc.trial, gc.alpha, avg({ae('s.label', 'gc.b + gc.w1 * s.ridge + gc.w2 * s.te')}) AS mae "
         "FROM gc JOIN st s ON s.fold = gc.i GROUP BY gc.trial, gc.alpha)")
ORACLE["tune_grid"] = f"{_TUNE} SELECT alpha, 0.0::DOUBLE AS l1_ratio, {r6('mae')} AS mae FROM gm"
ORACLE["tune_best"] = (
    f"{_TUNE} SELECT alpha, 0.0::DOUBLE AS l1_ratio, {r6('mae')} AS mae FROM gm ORDER BY mae, trial LIMIT 1")

_ONE = (f"r1 AS (SELECT fi.i, count(*) AS n, avg(t.x_qty) AS m1, avg(t.label) AS my, "
        "var_pop(t.x_qty) * count(*) AS s11, covar_pop(t.x_qty, t.label) * count(*) AS s1y "
        "FROM fi JOIN tr t ON t.fold <> fi.i GROUP BY fi.i), "
        f"c1 AS (SELECT i, s1y / (s11 + {RIDGE_ALPHA}) AS w, my - s1y / (s11 + {RIDGE_ALPHA}) * m1 AS b FROM r1), "
        "o1 AS (SELECT t.o_orderkey, t.label, c1.b + c1.w * t.x_qty AS pred FROM tr t JOIN c1 ON c1.i = t.fold)")
ORACLE["ablation_delta"] = (
    f"{BASE}, {_ONE}, ab AS (SELECT (SELECT avg({ae('label', 'pred')}) FROM oof) AS full_mae, "
    f"(SELECT avg({ae('label', 'pred')}) FROM o1) AS less_mae) "
    f"SELECT 'full' AS variant, {r6('full_mae')} AS mae, 0.0::DOUBLE AS delta FROM ab UNION ALL "
    f"SELECT 'without_x_disc', {r6('less_mae')}, {r6('less_mae - full_mae')} FROM ab")


# ---------------------------------------------------------------- skew, scaling, per-fold preprocessing
PREP_NUMERIC = ["LotFrontage", "MasVnrArea", "GarageArea", "TotalBsmtSF", "GarageYrBlt"]
PREP_CATEGORICAL = ["MSZoning", "KitchenQual", "GarageType", "Electrical"]
STANDARDIZE_COLUMNS = ["LotFrontage", "GrLivArea", "TotalBsmtSF", "OverallQual"]
_SKEW_COLS = [c for c, _ in numeric_layout() if c not in ("Id", "SalePrice")]


def _skew_row(c: str) -> str:
    d = f"(CAST({q(c)} AS DOUBLE) - (SELECT avg({q(c)}) FROM h))"
    m2, m3 = f"avg({d} * {d})", f"avg({d} * {d} * {d})"
    return (f"SELECT '{c}' AS \"column\", CASE WHEN {m2} = 0 THEN NULL ELSE {m3} / pow({m2}, 1.5) END "
            f"AS skewness, coalesce(bool_and({q(c)} >= 0), true) AS non_negative FROM h "
            f"WHERE {q(c)} IS NOT NULL")


SK = f"{H}, sk AS ({' UNION ALL '.join(_skew_row(c) for c in _SKEW_COLS)})"
ORACLE["skewness_all"] = f"WITH {SK} SELECT \"column\", {r6('skewness')} AS skewness, non_negative FROM sk"
ORACLE["skew_select"] = (
    f"WITH {SK} SELECT \"column\" FROM sk WHERE coalesce(abs(skewness) > 0.75, false) AND non_negative")
ORACLE["skew_apply"] = (
    f"WITH {SK}, sel AS (SELECT \"column\" FROM sk WHERE coalesce(abs(skewness) > 0.75, false) "
    "AND non_negative) SELECT \"Id\", "
    + ", ".join(r6(f"CASE WHEN EXISTS (SELECT 1 FROM sel WHERE sel.column = '{c}') "
                   f"THEN ln(1 + CAST({q(c)} AS DOUBLE)) ELSE CAST({q(c)} AS DOUBLE) END") + f" AS {q(c)}"
                for c in _SKEW_COLS) + " FROM h")
ORACLE["log_target"] = f"WITH {H} SELECT \"Id\", {r6('ln(1 + \"SalePrice\")')} AS label FROM h"
ORACLE["roundtrip_log"] = (
    f"WITH {H} SELECT \"Id\", floor((exp(ln(1 + \"SalePrice\")) - 1) * 100.0 + 0.5) / 100.0 AS \"SalePrice\" FROM h")
ORACLE["standardize"] = f"WITH {H} SELECT \"Id\", " + ", ".join(
    r6(f"({q(c)} - (SELECT avg({q(c)}) FROM h)) / (SELECT CASE WHEN coalesce(stddev_pop({q(c)}), 0) = 0 "
       f"THEN 1 ELSE stddev_pop({q(c)}) END FROM h)") + f" AS {q(c)}" for c in STANDARDIZE_COLUMNS) + " FROM h"

HF = (f"{H}, hf AS (SELECT *, {sql_bucket(q('Id'), str(SEED), K)} AS fold FROM h), "
      "fi AS (SELECT unnest(range(5)) AS i)")
FM = ("fm AS (SELECT fi.i, " + ", ".join(f"median(CAST(hf.{q(c)} AS DOUBLE)) AS {q(c)}" for c in PREP_NUMERIC)
      + " FROM fi JOIN hf ON hf.fold <> fi.i GROUP BY fi.i)")


def _mode_cte(c: str) -> str:
    return (f"mo_{c} AS (SELECT i, v AS mode FROM (SELECT fi.i, hf.{q(c)} AS v, row_number() OVER "
            f"(PARTITION BY fi.i ORDER BY count(*) DESC, hf.{q(c)}) AS rn FROM fi JOIN hf ON hf.fold <> fi.i "
            f"WHERE hf.{q(c)} IS NOT NULL GROUP BY fi.i, hf.{q(c)}) WHERE rn = 1)")


MODES = ", ".join(_mode_cte(c) for c in PREP_CATEGORICAL)
ORACLE["impute_median_fold"] = f"WITH {HF} " + " UNION ALL ".join(
    f"SELECT CAST(fi.i AS INTEGER) AS fold, '{c}' AS \"column\", {r6(f'median(CAST(hf.{q(c)} AS DOUBLE))')} AS median "
    f"FROM fi JOIN hf ON hf.fold <> fi.i GROUP BY fi.i" for c in PREP_NUMERIC)
ORACLE["impute_mode_fold"] = f"WITH {HF}, {MODES} " + " UNION ALL ".join(
    f"SELECT CAST(i AS INTEGER) AS fold, '{c}' AS \"column\", mode FROM mo_{c}" for c in PREP_CATEGORICAL)
ORACLE["preprocess_tree"] = (
    f"WITH {HF}, {FM}, {MODES} SELECT hf.\"Id\", hf.fold, "
    + ", ".join(f"{r6(f'coalesce(CAST(hf.{q(c)} AS DOUBLE), fm.{q(c)})')} AS {q(c)}" for c in PREP_NUMERIC) + ", "
    + ", ".join(f"coalesce(hf.{q(c)}, mo_{c}.mode) AS {q(c)}" for c in PREP_CATEGORICAL)
    + " FROM hf JOIN fm ON fm.i = hf.fold "
    + " ".join(f"LEFT JOIN mo_{c} ON mo_{c}.i = hf.fold" for c in PREP_CATEGORICAL))
FZ = ("fz AS (SELECT fi.i, " + ", ".join(
    f"avg(coalesce(CAST(hf.{q(c)} AS DOUBLE), fm.{q(c)})) AS {q('m_' + c)}, "
    f"stddev_pop(coalesce(CAST(hf.{q(c)} AS DOUBLE), fm.{q(c)})) AS {q('s_' + c)}" for c in PREP_NUMERIC)
    + " FROM fi JOIN fm ON fm.i = fi.i JOIN hf ON hf.fold <> fi.i GROUP BY fi.i)")
ORACLE["preprocess_linear"] = (
    f"WITH {HF}, {FM}, {FZ} SELECT hf.\"Id\", hf.fold, "
    + ", ".join(r6(f"(coalesce(CAST(hf.{q(c)} AS DOUBLE), fm.{q(c)}) - fz.{q('m_' + c)}) / "
                   f"CASE WHEN fz.{q('s_' + c)} = 0 THEN 1 ELSE fz.{q('s_' + c)} END") + f" AS {q(c)}"
                for c in PREP_NUMERIC)
    + " FROM hf JOIN fm ON fm.i = hf.fold JOIN fz ON fz.i = hf.fold")


def _vocab_cte(c: str) -> str:
    return (f"vo_{c} AS (SELECT i, v, CAST(row_number() OVER (PARTITION BY i ORDER BY v) - 1 AS INTEGER) "
            f"AS idx FROM (SELECT DISTINCT fi.i, hf.{q(c)} AS v FROM fi JOIN hf ON hf.fold <> fi.i "
            f"WHERE hf.{q(c)} IS NOT NULL))")


ORACLE["one_hot"] = (
    f"WITH {HF}, {MODES}, {', '.join(_vocab_cte(c) for c in PREP_CATEGORICAL)} "
    + " UNION ALL ".join(
        f"SELECT hf.\"Id\", hf.fold, '{c}' AS \"column\", vo_{c}.idx AS hot_index FROM hf "
        f"LEFT JOIN mo_{c} ON mo_{c}.i = hf.fold LEFT JOIN vo_{c} ON vo_{c}.i = hf.fold "
        f"AND vo_{c}.v = coalesce(hf.{q(c)}, mo_{c}.mode)" for c in PREP_CATEGORICAL))
ORACLE["category_prep"] = (
    f"WITH {H} SELECT \"Id\", "
    + ", ".join(f"{r6(f'coalesce({q(c)}, 0)')} AS {q(c)}" for c in PREP_NUMERIC) + ", "
    + ", ".join(f"coalesce(CAST({q(c)} AS VARCHAR), 'Missing') AS {q(c)}"
                for c in PREP_CATEGORICAL + ["MSSubClass"]) + " FROM h")


# ---------------------------------------------------------------- boosting, ordered statistics, meta selection
_BT = (f"bt0 AS (SELECT o_orderkey, ln(1 + o_totalprice) AS label, n_lines, o_orderstatus, c_mktsegment, "
       f"{sql_bucket('o_orderkey', str(SEED), K)} AS fold FROM ({ORDER_FRAME_SQL}) z WHERE {sql_bucket('o_orderkey', 'holdout', 10)} <> 0), "
       "fi AS (SELECT unnest(range(5)) AS i), "
       "bm AS (SELECT i, avg(label) AS base, median(CAST(n_lines AS DOUBLE)) AS med FROM fi JOIN bt0 ON fold <> i GROUP BY i), "
       # bins from 1 in the order of all values; a missing count goes to the bin of the fold's median
       "nl AS (SELECT n_lines AS v, row_number() OVER (ORDER BY n_lines) AS bin FROM (SELECT DISTINCT n_lines FROM bt0 WHERE n_lines IS NOT NULL)), "
       "so AS (SELECT o_orderstatus AS v, row_number() OVER (ORDER BY o_orderstatus) AS bin FROM (SELECT DISTINCT o_orderstatus FROM bt0)), "
       "ms AS (SELECT c_mktsegment AS v, row_number() OVER (ORDER BY c_mktsegment) AS bin FROM (SELECT DISTINCT c_mktsegment FROM bt0)), "
       "bx AS (SELECT bm.i, bm.base, t.fold, t.label, coalesce(nl.bin, (SELECT least(count(*) + 1, (SELECT max(bin) FROM nl)) FROM nl WHERE nl.v < bm.med)) AS b0, "
       "so.bin AS b1, ms.bin AS b2 FROM bm, bt0 t LEFT JOIN nl ON nl.v = t.n_lines LEFT JOIN so ON so.v = t.o_orderstatus LEFT JOIN ms ON ms.v = t.c_mktsegment)")


def _thresholded(g: str) -> str:
    return f"(sign({g}) * greatest(abs({g}) - 0.5, 0))"


def _score(g: str, h: str) -> str:
    return f"({_thresholded(g)} * {_thresholded(g)} / ({h} + 2.0))"


def _candidate(name: str, column: str, place: int, left: str) -> str:
    return (f"SELECT x.i, '{name}' AS feature, {place} AS place, c.t, sum(x.base - x.label) FILTER ({left}) AS gl, count(*) FILTER ({left}) AS hl, "
            f"sum(x.base - x.label) AS g, count(*) AS h FROM bx x, (SELECT DISTINCT {column} AS t FROM bx) c WHERE x.fold <> x.i GROUP BY x.i, c.t")


ORACLE["boost_stump"] = (
    f"WITH {_BT}, ca AS ({_candidate('n_lines', 'b0', 0, 'WHERE x.b0 <= c.t')} UNION ALL {_candidate('o_orderstatus', 'b1', 1, 'WHERE x.b1 = c.t')} "
    f"UNION ALL {_candidate('c_mktsegment', 'b2', 2, 'WHERE x.b2 = c.t')}), "
    f"ga AS (SELECT *, {_score('gl', 'hl')} + {_score('(g - gl)', '(h - hl)')} - {_score('g', 'h')} AS gain FROM ca WHERE hl >= 10 AND h - hl >= 10), "
    "be AS (SELECT * FROM ga QUALIFY row_number() OVER (PARTITION BY i ORDER BY gain DESC, place, t) = 1), "
    f"lv AS (SELECT *, -{_thresholded('gl')} / (hl + 2.0) AS lval, -{_thresholded('(g - gl)')} / (h - hl + 2.0) AS rval FROM be), "
    "er AS (SELECT x.i, avg((x.base - x.label) ** 2) AS e0, avg((x.base + 0.1 * CASE WHEN CASE place WHEN 0 THEN b0 <= t WHEN 1 THEN b1 = t ELSE b2 = t END "
    "THEN lval ELSE rval END - x.label) ** 2) AS e1 FROM bx x JOIN lv USING (i) WHERE x.fold = x.i GROUP BY x.i) "
    "SELECT CAST(i AS INTEGER) AS fold, feature, CAST(t AS INTEGER) AS threshold, "
    + ", ".join(f"floor({c} * 1e4 + 0.5) / 1e4 AS {n}" for c, n in (("gain", "gain"), ("lval", "left_value"), ("rval", "right_value"),
                                                                     ("e0", "error_before"), ("e1", "error_after")))
    + " FROM lv JOIN er USING (i)")


def _ots(c: str) -> str:
    w = f"(PARTITION BY {c} ORDER BY {sql_sort_hash('o_orderkey', str(SEED))}, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return r6(f"(coalesce(sum(label) OVER {w}, 0) + (SELECT avg(label) FROM ot)) / (count(label) OVER {w} + 1)") + f" AS {c}_ots"


ORACLE["ordered_target_stats"] = f"WITH {OT} SELECT o_orderkey, {_ots('o_orderpriority')}, {_ots('o_orderstatus')} FROM ot"


def enet2(src: str, keys: str, l1: str, l2: str) -> str:
    """(keys, w1, w2, b): the exact elastic net on two columns from centred sums, by trying all nine sign patterns."""
    a, c, b, p, q_ = "(s11 / n)", "(s22 / n)", "(s12 / n)", "(s1y / n)", "(s2y / n)"
    r1, r2 = f"({p} - {l1} * g1)", f"({q_} - {l1} * g2)"
    det = f"(({a} + {l2}) * ({c} + {l2}) - {b} * {b})"
    w1 = f"CASE WHEN g1 = 0 THEN 0 WHEN g2 = 0 THEN {r1} / ({a} + {l2}) ELSE (({c} + {l2}) * {r1} - {b} * {r2}) / {det} END"
    w2 = f"CASE WHEN g2 = 0 THEN 0 WHEN g1 = 0 THEN {r2} / ({c} + {l2}) ELSE (({a} + {l2}) * {r2} - {b} * {r1}) / {det} END"
    cost = f"0.5 * ({a} * w1 * w1 + 2 * {b} * w1 * w2 + {c} * w2 * w2) - {p} * w1 - {q_} * w2 + {l1} * (abs(w1) + abs(w2)) + {l2} / 2 * (w1 * w1 + w2 * w2)"
    return (f"SELECT {keys}, w1, w2, my - w1 * m1 - w2 * m2 AS b FROM (SELECT *, {w1} AS w1, {w2} AS w2 FROM {src}, "
            "(SELECT unnest([-1, 0, 1]) AS g1) t1, (SELECT unnest([-1, 0, 1]) AS g2) t2) "
            f"WHERE sign(w1) = g1 AND sign(w2) = g2 QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {cost}) = 1")


_LT = (f"lt AS (SELECT o_orderkey, ln(1 + o_totalprice) AS label, CAST(n_lines AS DOUBLE) AS u1, disc * 100.0 AS u2, {sql_bucket('o_orderkey', 'holdout', 10)} = 0 AS scoring, "
       f"{sql_bucket('o_orderkey', str(SEED), K)} AS fold FROM ({ORDER_FRAME_SQL}) z), fi AS (SELECT unnest(range(5)) AS i), "
       "lm AS (SELECT i, median(u1) AS d1, median(u2) AS d2 FROM fi JOIN lt ON fold <> i AND NOT scoring GROUP BY i), "
       "lx AS (SELECT i, o_orderkey, fold, scoring, label, coalesce(u1, d1) AS v1, coalesce(u2, d2) AS v2 FROM lt, lm), "
       "lz AS (SELECT i, avg(v1) AS a1, stddev_pop(v1) AS c1, avg(v2) AS a2, stddev_pop(v2) AS c2 FROM lx WHERE fold <> i AND NOT scoring GROUP BY i), "
       "ls AS (SELECT lx.*, (v1 - a1) / c1 AS x1, (v2 - a2) / c2 AS x2 FROM lx JOIN lz USING (i)), "
       f"lg AS (SELECT i, {ridge2_stats('ls', 'x1', 'x2')} FROM ls WHERE fold <> i AND NOT scoring GROUP BY i), "
       f"lr AS (SELECT i, {ridge2_coefs(str(RIDGE_ALPHA))} FROM lg)")
ORACLE["linear_ridge_two"] = f"WITH {_LT} SELECT o_orderkey, fold, {r6('b + w1 * x1 + w2 * x2')} AS pred FROM ls JOIN lr USING (i) WHERE fold = i AND NOT scoring"
ORACLE["lasso_two"] = (f"WITH {_LT}, ll AS ({enet2('lg', 'i', '0.0005', '0.0')}) SELECT o_orderkey, fold, {r6('b + w1 * x1 + w2 * x2')} AS pred "
                       "FROM ls JOIN ll USING (i) WHERE fold = i AND NOT scoring")
ORACLE["oof_score_mean"] = f"WITH {_LT} SELECT o_orderkey, {r6('avg(b + w1 * x1 + w2 * x2)')} AS pred FROM ls JOIN lr USING (i) WHERE scoring GROUP BY o_orderkey"

_R4 = "floor({} * 1e4 + 0.5) / 1e4"
_MS = (f"{STACK}, ms AS (SELECT 0 AS one, {ridge2_stats('st', 'ridge', 'te')} FROM st), rf AS (SELECT {ridge2_coefs(str(META_ALPHA))} FROM ms), "
       f"ef AS ({enet2('ms', 'one', '0.0005', '0.0005')}), "
       "pr AS (SELECT label, rf.b + rf.w1 * ridge + rf.w2 * te AS pr, ef.b + ef.w1 * ridge + ef.w2 * te AS pe FROM st, rf, ef), "
       f"er AS (SELECT avg({ae('label', 'pr')}) AS r, avg({ae('label', 'pe')}) AS e, avg({pe('label', 'pr')}) AS rp, avg({pe('label', 'pe')}) AS ep FROM pr)")
ORACLE["meta_select"] = (
    f"{_MS} SELECT CASE WHEN e < r THEN 'ElasticNet' ELSE 'Ridge' END AS meta_name, {_R4.format('least(e, r)')} AS mae, "
    f"{_R4.format('(CASE WHEN e < r THEN ep ELSE rp END)')} AS mape, {_R4.format('r')} AS ridge_mae, {_R4.format('e')} AS enet_mae, "
    "round_even(CASE WHEN e < r THEN ef.w1 ELSE rf.w1 END, 4) AS coef_ridge, round_even(CASE WHEN e < r THEN ef.w2 ELSE rf.w2 END, 4) AS coef_te FROM er, rf, ef")


def _trials() -> str:
    from foldline.operators.tune import sample_candidates
    return "SELECT * FROM (VALUES " + ", ".join(f"({t}, {a!r}::DOUBLE, {r!r}::DOUBLE)" for t, (a, r) in enumerate(sample_candidates(100, SEED))) + ") v(trial, alpha, l1_ratio)"


ORACLE["tune_enet"] = (
    f"{STACK}, tq AS ({_trials()}), ts AS (SELECT i, {ridge2_stats('st', 's.ridge', 's.te', 's.label')} FROM fi JOIN st s ON s.fold <> fi.i GROUP BY i), "
    f"tx AS (SELECT * FROM tq, ts), tc AS ({enet2('tx', 'trial, alpha, l1_ratio, i', '(alpha * l1_ratio)', '(alpha * (1 - l1_ratio))')}) "
    f"SELECT CAST(trial AS INTEGER) AS trial, alpha, l1_ratio, {_R4.format('avg(' + ae('s.label', 'tc.b + tc.w1 * s.ridge + tc.w2 * s.te') + ')')} AS mae "
    "FROM tc JOIN st s ON s.fold = tc.i GROUP BY trial, alpha, l1_ratio")

ORACLE["submission_frame"] = (
    f"{_MS} SELECT o_orderkey AS \"Id\", floor({em1('CASE WHEN e < r THEN ef.b + ef.w1 * sp.ridge + ef.w2 * sp.te ELSE rf.b + rf.w1 * sp.ridge + rf.w2 * sp.te END')} "
    "* 100.0 + 0.5) / 100.0 AS \"SalePrice\" FROM sp, er, rf, ef")

# ---------------------------------------------------------------- CSV round trips
ORACLE["read_csv_na"] = f"WITH {H} SELECT {sel(standin_columns(), _DBL)} FROM h"
ORACLE["read_csv_typed"] = (
    f"WITH {H} SELECT \"Id\", CASE WHEN \"Id\" % 997 <> 0 THEN CAST(\"LotArea\" AS BIGINT) END AS \"LotArea\", "
    f"CASE WHEN \"Id\" % 991 <> 0 THEN {r6(q('LotFrontage'))} END AS \"LotFrontage\", CAST(\"BsmtFinSF2\" AS BIGINT) AS n_lines, \"Neighborhood\", \"MasVnrType\", "
    "CAST(CASE WHEN \"Id\" % 997 = 0 THEN 1 ELSE 0 END + CASE WHEN \"Id\" % 991 = 0 THEN 1 ELSE 0 END AS BIGINT) AS n_rejected FROM h")
