"""Faults found in review: each failed before it was mended."""


import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from foldline.llm import components, exact_dedup, packing, toxicity
from foldline.llm.shared import Scratch, crc_bucket, scratch_path


def test_a_batch_added_again_keeps_no_row(spark, frame):
    docs = frame([(1, "a"), (2, "A"), (3, "b"), (None, "c")])
    index = exact_dedup.DigestIndex(spark, scratch_path(spark, "index"), buckets=4)
    first = exact_dedup.exact_dedup(docs, index)
    assert first.where("kept").count() == 3
    again = exact_dedup.exact_dedup(docs, index)
    assert again.where("kept").count() == 0 and again.count() == 4
    index.close()


def test_ids_far_apart(frame):
    low, high = -(1 << 63), (1 << 63) - 1
    rows = exact_dedup.exact_dedup(frame([(low, "a"), (high, "a"), (0, "b"), (low, "b")])).collect()
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in rows) == [(low, 0, False), (low, high, False), (0, 0, True), (high, high, True)]


def test_the_index_of_a_run_goes(spark, frame):
    before = {t.name for t in spark.catalog.listTables()}
    exact_dedup.exact_dedup(frame([(1, "a"), (2, "a")])).count()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_a_clean_text_that_shares_a_toxic_id_stays(spark, frame):
    bad, good = "you are a total moron zzqx and I will hurt you", "the garden is green and calm in spring"
    docs = [(i, f"{bad if i % 2 else good} {i}") for i in range(200)] + [(1, good)]
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(200)], "doc_id long, quality int, toxic int")
    kept = toxicity.drop_toxic(frame(docs), labels, crc_bucket(F.col("doc_id"), 4) != 2, 0.3)
    left = sorted((r.doc_id, r.text) for r in kept.collect())
    assert (1, good) in left and not any("moron" in t for _, t in left) and len(left) == 101


def test_special_tokens_in_texts(frame):
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["a <|endoftext|> b", "x<|startoftext|>y <|ENDOFTEXT|>", "plain words", None, "<|endoftext|>", "Q" * 50 + " <|endoftext|"]
    tokenizer = Tokenizer.from_file(path)
    got = {r.doc_id: r.ids for r in packing.tokenize(frame(list(enumerate(texts))), path).collect()}
    for i, t in enumerate(texts):
        expected = tokenizer.encode(t or "", add_special_tokens=False).ids + [packing.END]
        assert np.frombuffer(bytes(got[i]), np.uint16).tolist() == expected


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1001 + i) for i in range(200)] + [(5000 + i, 5000 + (i * 7) % 90) for i in range(90)]
    links += [(3, 3), (None, 4), (301, None)]
    df = spark.createDataFrame(links, "a long, b long").repartition(7)
    scratch = Scratch(spark, "test")
    got = {r.node: r.root for r in components.components(df, scratch).collect()}
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in links:
        if a is not None and b is not None:
            x, y = sorted((root(a), root(b)))
            up[y] = x
    assert got == {x: root(x) for x in up if root(x) != x}


def test_texts_that_share_an_id_are_several_documents(spark):
    from foldline.llm import sentence_spans
    copy = "one two three four five six seven eight. nine ten eleven twelve thirteen fourteen fifteen."
    other = "alpha beta gamma delta epsilon zeta eta theta. iota kappa lambda mu nu xi omicron pi rho."
    rows = [(1, copy, 0, "r", None, 7), (2, copy, 1, "r", None, 7), (2, other, 2, "r", None, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ranges int, passages string, span_dedup string, span_doc_id long")
    got = sentence_spans.drop_repeated_sentences(docs)
    assert got.columns == ["doc_id", "text", "ranges", "passages", "span_doc_id", "span_dedup"]
    assert sorted((r.doc_id, r.ranges, r.text, r.span_dedup.n_sentences, r.span_dedup.n_removed) for r in got.collect()) == [
        (1, 0, copy, 2, 0), (2, 1, "", 2, 2), (2, 2, other, 2, 0)]


def test_the_order_of_a_clause_counts():
    insult, threat, target, no, said = toxicity.INSULT, toxicity.THREAT, toxicity.TARGET, toxicity.NEGATION, toxicity.REPORT

    def score(*tags):
        return round(toxicity.clause_score(list(tags), [4.0 if t in (insult, threat) else 0.0 for t in tags]), 6)
    assert score(insult) == 4.0 and score(threat) == 2.0
    assert score(target, insult) == 5.0 and score(insult, target) == 5.0        # you moron, moron you
    assert score(target, no, insult) == 3.0 and score(target, insult, no) == 5.0  # you are not a moron, you are a moron, no
    assert score(no, insult, target) == 3.0 and score(insult, no, target) == 4.0
    assert score(said, insult) == 2.8 and score(insult, said) == 4.0            # he said moron, moron, he said
    assert score(no, no, insult) == 4.0 and score(no, insult, insult) == 6.4
    assert score(target, threat) == 4.0 and score(threat, target) == 4.0 and score(threat, said, target) == 2.0
    assert score(said, target, no, threat, insult) == round(4 * 0.7 * 0.6 + 4 * 0.7 * 1.25, 6)


def test_a_rare_language_has_long_pieces(spark):
    from foldline.llm import language_id
    rows = [(i, "a" * 2000, "common") for i in range(500)] + [(1000 + i, "b" * 2000, "rare") for i in range(10)] + [(2000, None, "none"), (2001, "", "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    size = {k: len(v) for k, v in language_id.learn_dictionaries(docs, F.lit(True), per_language=400, dictionary_bytes=1 << 14).items()}
    assert set(size) == {"common", "rare"} and 0.9 < size["rare"] / (1 << 14) < 1.1 and 0.9 < size["common"] / (1 << 14) < 1.1
