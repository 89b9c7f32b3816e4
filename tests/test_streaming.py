"""A fitted recipe gives the same rows on a stream as on the batch table."""

import os
import tempfile

from foldline.sources.standin import housing_standin
from foldline.streaming.scoring import fitted_recipe, prepare_stream
from foldline.plans.recipe import run_steps


def test_stream_matches_batch(spark, sf_dir):
    base = housing_standin(spark, sf_dir)
    train = base.where("Id % 4 <> 0")
    fresh = base.where("Id % 4 = 0").drop("SalePrice")
    steps = fitted_recipe(train)
    d = tempfile.mkdtemp(prefix="foldline-stream-")
    src = os.path.join(d, "in")
    fresh.write.parquet(src)
    stream = spark.readStream.schema(fresh.schema).parquet(src)
    q = (prepare_stream(stream, steps).writeStream.format("memory").queryName("prepared_stream")
         .option("checkpointLocation", os.path.join(d, "ckpt")).start())
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT * FROM prepared_stream")
    want = run_steps(spark.read.parquet(src), steps)
    cols = ["Id", "LotFrontage", "MSZoning", "TotalSF", "AgeBin", "KitchenValue"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    assert got.count() == fresh.count() > 0
