"""The pipeline on the smallest tables: names, order and what each stage leaves."""

import corpus_pipeline
from foldline.llm import exact_dedup, ngram_join


def test_stages(spark, sf_dir):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_join", "sentence_spans", "packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = [{r.doc_id for r in docs.collect()}]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns
        ids.append({r.doc_id for r in docs.collect()})
        assert ids[-1] <= ids[-2]
    start = spark.read.parquet(f"{sf_dir}/documents.parquet").where(f"doc_id IN ({', '.join(map(str, ids[1]))})")
    assert ids[2] == {r.doc_id for r in exact_dedup.exact_dedup(start).where("kept").collect()}
    start = start.where(f"doc_id IN ({', '.join(map(str, ids[2]))})")
    assert ids[3] == {r.component_id for r in ngram_join.components_of(start, 5, 80).collect()}
    assert ids[4] == ids[3]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == ids[4]
