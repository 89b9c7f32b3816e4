"""Category dictionaries of any size."""

from pyspark.sql import functions as F

from foldline.operators.encode import FoldDictionary


def test_a_hundred_thousand_categories(spark):
    df = spark.range(300_000).select("id", (F.col("id") % 3).cast("int").alias("fold"), F.concat(F.lit("v"), F.lpad((F.col("id") % 100_000).cast("string"), 6, "0")).alias("c"))
    model = FoldDictionary(["c"], "fold", 3).fit(df)
    assert set(model.sizes) == {(f, "c") for f in range(3)} and all(n == 100_000 for n in model.sizes.values())
    out = model.index(df, ["c"])
    assert out.count() == 300_000
    assert out.where(F.col("c_index") != F.substring("c", 2, 6).cast("int")).count() == 0 and out.where("c_index is null").count() == 0
    row = model.one_hot(df.where("id = 7"), "c", 1, "hot").first()
    assert row.hot.size == 100_000 and row.hot.indices.tolist() == [7] and row.fold == 1


def test_unseen_missing_and_filled(spark):
    rows = [(1, 0, "a"), (2, 1, "b"), (3, 1, None), (4, 0, "only 0"), (5, 1, "a"), (6, 0, None)]
    df = spark.createDataFrame(rows, "id int, fold int, c string")
    model = FoldDictionary(["c", "absent"], "fold", 2).fit(df)
    assert model.sizes == {(0, "c"): 2, (1, "c"): 2}   # fold 0 knows a, b; fold 1 knows a, only 0
    got = {r.id: r.c_index for r in model.index(df, ["c"], {(0, "c"): "b", (1, "c"): "zz"}).collect()}
    assert got == {1: 0, 2: None, 3: None, 4: None, 5: 0, 6: 1}
    hot = {r.id: (r.fold, r.hot.toArray().tolist()) for r in model.one_hot(df, "c", 0, "hot").collect()}
    assert hot[1] == (0, [1.0, 0.0]) and hot[2] == (1, [0.0, 1.0]) and hot[3] == (1, [0.0, 0.0]) and hot[4] == (0, [0.0, 0.0])
    assert FoldDictionary(["c"], "fold", 2).fit(df.where("1 = 0")).sizes == {}
