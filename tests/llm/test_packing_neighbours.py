"""Neighbours anywhere in the table come into one shard, as brute-force BM25 over all documents finds them."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from foldline.llm import packing

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_shared_runs_are_kept_by_both():
    rng = np.random.default_rng(3)
    shared = rng.integers(3, 49_000, packing.RUN + packing.SPREAD - 1)
    texts = [np.concatenate([rng.integers(3, 49_000, a), shared, rng.integers(3, 49_000, b)]) for a, b in ((0, 0), (5, 400), (333, 0), (70, 71))]
    texts += [rng.integers(3, 49_000, n) for n in (0, 1, packing.RUN - 1, packing.RUN, packing.RUN + 1, 70, 200)]
    ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    runs = [set(r) for r in packing.least_runs(np.concatenate(texts).astype(np.uint16), ends).to_pylist()]
    assert set.intersection(*runs[:4])
    assert [len(r) for r in runs[4:10]] == [0, 0, 0, 1, 1, 1] and len(runs[10]) > 1
    assert not set.union(*runs[:4]) & set.union(*runs[4:])
    alone = [packing.least_runs(t.astype(np.uint16), np.array([0, len(t)])).to_pylist()[0] for t in texts]
    assert [set(r) for r in alone] == runs  # a document's runs don't depend on those beside it
    repeated = np.tile(np.arange(3, 20), 100).astype(np.uint16)
    assert len(packing.least_runs(repeated, np.array([0, len(repeated)])).to_pylist()[0]) == 1
    assert packing.least_runs(np.zeros(0, np.uint16), np.zeros(1, np.int64)).equals(pa.array([], pa.list_(pa.int64())))


def test_neighbours_share_a_shard(frame, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_DOCUMENTS", 40)
    rng = random.Random(21)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(3000)]
    texts = [rng.choices(vocabulary, k=rng.randint(20, 200)) for _ in range(600)]
    planted = rng.sample(range(600), 300)
    for a in range(0, 300, 5):  # passages of 40 words, in two and three documents
        for group in (planted[a:a + 2], planted[a + 2:a + 5]):
            passage = rng.choices(vocabulary, k=40)
            for i in group:
                texts[i] = texts[i][:10] + passage + texts[i][10:]
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = packing.pack(frame(docs), WORDS, window=1024).toPandas()
    shards = got.groupby("doc_id")["shard"].agg(set)
    assert got["shard"].nunique() >= 15
    tokenizer = Tokenizer.from_file(WORDS)
    ids = [np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2]) for _, t in docs]
    often = np.bincount(np.concatenate([np.unique(x) for x in ids]), minlength=50_000)
    index = packing.Bm25Shard(ids, np.log1p((600 - often + 0.5) / (often + 0.5)), sum(map(len, ids)) / 600)
    found = 0
    for k in planted:
        scores = index.scores(k)
        scores[k] = -1.0
        found += bool(shards[k] & shards[int(scores.argmax())])
    assert found >= 0.9 * len(planted), found


def test_one_passage_in_a_third_of_all_rows(frame, monkeypatch):
    """The group spans many shards; every id is packed once, rows that repeat are packed each."""
    monkeypatch.setattr(packing, "SHARD_DOCUMENTS", 10)
    passage = " ".join(f"common{i}" for i in range(60))
    docs = [(i, f"{passage} own{i}") for i in range(60)] + [(i, f"word{i} " * (i % 50)) for i in range(60, 170)] + [(7, passage)] * 4 + [(None, None), (170, "")]
    got = packing.pack(frame(docs), WORDS, window=256).toPandas()
    want = {r.doc_id: r.n for r in packing.tokenize(frame(docs), WORDS).selectExpr("doc_id", "length(ids) DIV 2 n").groupBy("doc_id").agg({"n": "sum"}).toDF("doc_id", "n").collect()}
    assert {None if k != k else int(k): v for k, v in got.groupby("doc_id", dropna=False).length.sum().items()} == want
    assert got["shard"].nunique() >= 17
