"""End-to-end pieces: submission sink, user model factory, user objective."""

import os
import tempfile

from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from foldline.operators.models import ModelSpec, register_model, resolve
from foldline.sources.csv import read_csv_na, write_submission


def test_submission_sink_writes_header_and_rows(spark):
    df = spark.createDataFrame([(1461, 123.5), (1462, 99.0)], "Id int, SalePrice double")
    out = os.path.join(tempfile.mkdtemp(prefix="foldline-sub-"), "sub")
    write_submission(df, out, single_file=True)
    parts = [p for p in os.listdir(out) if p.endswith(".csv")]
    assert len(parts) == 1
    lines = open(os.path.join(out, parts[0])).read().splitlines()
    assert lines[0] == "Id,SalePrice" and len(lines) == 3


def test_csv_na_tokens(spark):
    d = tempfile.mkdtemp(prefix="foldline-csv-")
    path = os.path.join(d, "t.csv")
    with open(path, "w") as f:
        f.write("Id,MasVnrType,LotFrontage\n1,None,NA\n2,NA,65\n3,nan,70\n")
    df = read_csv_na(spark, path, "Id int, MasVnrType string, LotFrontage double")
    got = {r["Id"]: (r["MasVnrType"], r["LotFrontage"]) for r in df.collect()}
    assert got == {1: ("None", None), 2: (None, 65.0), 3: (None, 70.0)}


def test_user_model_factory(spark):
    reg = {}
    register_model(ModelSpec("MyOLS", "linear", lambda ctx, p: LinearRegression()), reg)
    assert [s.name for s in resolve(["MyOLS", "Nope"], reg)] == ["MyOLS"]


def test_user_objective_in_search(spark):
    from foldline.operators.tune import elastic_net_search
    rows = [(i, i % 5, float(i % 7), float(i % 3), float(i % 7) * 0.5 + float(i % 3)) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, fold int, a double, b double, label double")
    sq = elastic_net_search(df, ["a", "b"], [(0.01, 0.0)], objective=lambda y, p: (y - p) * (y - p))
    assert sq.first()["mae"] < 1e-3


def test_command_line_writes_submission(spark, sf_dir):
    from foldline.plans.runner import main
    out = os.path.join(tempfile.mkdtemp(prefix="foldline-cli-"), "sub")
    main(["--sf-dir", sf_dir, "--out", out, "--models", "Linear_Ridge", "--single-file"])
    parts = [p for p in os.listdir(out) if p.endswith(".csv")]
    lines = open(os.path.join(out, parts[0])).read().splitlines()
    assert lines[0] == "Id,SalePrice" and len(lines) > 1
    assert all(float(x.split(",")[1]) > 0 for x in lines[1:])


def test_types_come_from_both_files_and_stray_cells_are_listed(spark):
    from foldline.sources.csv import REJECTED, read_csv_typed
    d = tempfile.mkdtemp(prefix="foldline-csv-")
    train, test = os.path.join(d, "train.csv"), os.path.join(d, "test.csv")
    lines = [f"{i},{i if i % 10 else 'NA'},{i / 2},None,{i}" for i in range(1, 301)]
    lines[4] = "5,five,2.5,x,5"
    open(train, "w").write("Id,Whole,Half,Word,SalePrice\n" + "\n".join(lines) + "\n")
    open(test, "w").write("Id,Whole,Half,Word\n" + "\n".join(f"{i},{i},{i}," for i in range(301, 401)) + "\n")
    a, b = read_csv_typed(spark, train, test)
    kinds = {"Id": "bigint", "Whole": "bigint", "Half": "double", "Word": "string"}
    assert dict(a.drop(REJECTED, "SalePrice").dtypes) == dict(b.drop(REJECTED).dtypes) == kinds
    rows = {r.Id: r for r in a.collect()}
    assert rows[5].Whole is None and [tuple(x) for x in rows[5][REJECTED]] == [("Whole", "five")]
    assert rows[10].Whole is None and rows[10][REJECTED] == [] and rows[1].Word == "None" and b.where("Word is not null").count() == 0


def test_user_step_in_a_recipe(spark):
    from foldline.operators.features import count_advanced_features
    from foldline.plans.recipe import run_steps
    df = spark.createDataFrame([(1, 2.0)], "Id int, MoSold double")
    out = run_steps(df, [lambda d: d.withColumn("Twice", F.col("MoSold") * 2), lambda d: d.withColumn("SeasonSold", F.lit(1))])
    assert out.columns == ["Id", "MoSold", "Twice", "SeasonSold"] and out.first()["Twice"] == 4.0
    assert count_advanced_features(out) == 1 and count_advanced_features(df) == 0


def test_ablation_runs_the_steps_before_once(spark, sf_dir):
    from foldline.plans.housing import Recipe
    from foldline.plans.runner import ablation, split_standin
    recipe, calls = Recipe(), []

    def counted(step):
        def run(df):
            calls.append(step.__name__)
            return step(df)
        run.__name__ = step.__name__
        return run
    recipe.steps = [counted(s) for s in recipe.steps]
    row = ablation(*split_standin(spark, sf_dir), recipe, "add_advanced_features").first()
    assert row["model"] == "Linear_Ridge" and row["mae_with"] > 0 and row["delta"] == row["mae_without"] - row["mae_with"]
    assert {s: calls.count(s) for s in set(calls)} == {"clean_data": 2, "encode_ordinals": 2, "add_features": 2, "add_advanced_features": 2}


def test_models_of_each_kind_are_routed_to_their_preprocessor():
    from foldline.operators.models import REGISTRY
    assert {n: s.prep for n, s in REGISTRY.items()} == {"XGBoost": "tree", "CatBoost": "native", "ExtraTrees": "tree", "LightGBM": "tree",
                                                        "Linear_Ridge": "linear", "Linear_Lasso": "linear"}
