"""Sign codes hold every element of a vector, or there is an error."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from foldline.llm import hamming_search


def test_sign_code_of_all_elements(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("embedding", hamming_search.sign_code(F.col("embedding")).alias("code")).collect()
    assert rows and all(r.code % (1 << 64) == sum(1 << i for i, x in enumerate(r.embedding) if x > 0) for r in rows)
    odd = spark.createDataFrame([([0.5, None, 1.0],), ([],)], "v array<double>")
    assert [r.code for r in odd.select(hamming_search.sign_code(F.col("v")).alias("code")).collect()] == [5, 0]


def test_sign_code_of_longer_vectors_is_an_error(spark):
    longer = spark.createDataFrame([([1.0] * 65,)], "v array<double>")
    with pytest.raises(PySparkException, match="64 elements"):
        longer.select(hamming_search.sign_code(F.col("v")).alias("code")).collect()
