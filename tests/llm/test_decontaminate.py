"""FM-index search and decontamination against brute force on small tables with odd rows."""

import random
import re

import numpy as np
import pytest

from foldline.llm import decontaminate

LOWER = {i: i + 32 for i in range(65, 91)}
ODD = [(900, None), (901, ""), (902, " \n\t!"), (903, "x"), (None, "no id w1 w2 w3"), (904, "one two THREE"), (904, "É\x00ß one-two, three"), (905, "w1 " * 400)]


def words_of(text):
    return [(m.start(), m.end(), m[0]) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))]


def brute(docs, bench, n):
    windows = []
    for item, text in bench:
        w = [x[2] for x in words_of(text)]
        if item is not None and w:
            windows += [(str(item), tuple(w[i:i + n])) for i in range(max(1, len(w) - n + 1))]
    out = []
    for doc, text in docs:
        w = [x[2] for x in words_of(text)]
        hit, items = set(), set()
        for item, p in windows:
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i:i + len(p)]) == p:
                    hit.update(range(i, i + len(p)))
                    items.add(item)
        spans = []
        for i in sorted(hit):
            if spans and spans[-1][1] == i - 1:
                spans[-1][1] = i
            else:
                spans.append([i, i])
        at = words_of(text)
        spans = tuple((a, b, len((text or "")[:at[a][0]].encode()), len((text or "")[:at[b][1]].encode())) for a, b in spans)
        out.append((doc, len(w), len(hit), tuple(sorted(items)), spans))
    return sorted(out, key=str)


def found(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), tuple(tuple(s) for s in r["spans"])) for r in df.collect()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    text = lambda n, v=12: rng.choice([" ", "-", ", "]).join(rng.choice(["w", "W", "é"]) + str(rng.randrange(v)) for _ in range(n))
    bench = [(i, text(rng.randint(8, 20))) for i in range(8)] + [(50, "one two three"), ("50", "One two three"), (51, None), (52, "!!"), (None, "x"), (53, "the end")]
    docs = list(ODD)
    for i in range(60):
        own = text(rng.randint(0, 60), 40)
        if rng.random() < 0.6:
            own += " " + rng.choice(bench[:8])[1].upper().replace("É", "é") + " " + text(rng.randint(0, 9), 40)
        docs.append((i, own))
    return docs + docs[10:14], [(None if i is None else str(i), t) for i, t in bench]


@pytest.mark.parametrize("seed,n,block,symbols", [(1, 10, 0, 1 << 20), (2, 4, 0, 30), (3, 6, 100, 1 << 20)])
def test_contamination(spark, frame, monkeypatch, seed, n, block, symbols):
    monkeypatch.setattr(decontaminate, "SHARD_SYMBOLS", symbols)
    docs, bench = corpus(seed)
    table = spark.createDataFrame([(*b, 1, "s") for b in bench], "item_id string, text string, n_hit long, spans string")
    out = decontaminate.contamination(frame(docs), table, n, benchmark_bytes=block)
    expected = brute(docs, bench, n)
    assert found(out) == expected and sum(x[2] for x in expected) > 100
    cut = {(r["doc_id"], r["n_hit"], r["text"]) for r in decontaminate.without_contamination(frame(docs), table, n, benchmark_bytes=block).collect()}
    for doc, text in docs:
        hits = next(x for x in brute([(doc, text)], bench, n))
        raw = (text or "").encode()
        for _, _, a, b in reversed(hits[4]):
            raw = raw[:a] + raw[b:]
        assert (doc, hits[2], None if text is None else raw.decode()) in cut


def test_empty(spark, frame):
    none = spark.createDataFrame([], "item_id long, text string")
    assert found(decontaminate.contamination(frame(ODD), none)) == brute(ODD, [], 10)
    assert decontaminate.contamination(frame([]), none).count() == 0


def test_a_shared_hash_is_no_match(spark, frame, monkeypatch):
    real = decontaminate.tb.span_hashes
    monkeypatch.setattr(decontaminate.tb, "span_hashes", lambda data, start, end: real(data, start, np.minimum(end, start + 2)))
    import pyarrow as pa
    phrases = decontaminate.Phrases([("1", "aaa bbb ccc")], 10)
    data, offsets = decontaminate.tb.flat(pa.array(["aaa bbx ccc aaa bbb ccc"]), lower=True)
    start, end, _ = decontaminate.word_bounds(data, offsets)
    symbols = phrases.symbols(data, start, end)
    assert (symbols > 0).all() and phrases.differ(data, start, end, symbols).tolist() == [False, True, False, False, False, False]


@pytest.mark.parametrize("seed", range(4))
def test_fm_index(seed):
    rng = np.random.default_rng(seed)
    text = np.concatenate([[0], rng.integers(0, 4 if seed % 2 else 60, 700), [1, 2, 3] * 90, [0], [1, 2, 3] * 90, [0]])
    index = decontaminate.FmIndex(text, 60)
    for size in (1, 2, 5):
        patterns = np.concatenate([rng.integers(1, 61, (40, size)), [text[i:i + size] for i in range(1, 500, 7) if (text[i:i + size] > 0).all()]])
        low, count = index.search(patterns)
        for p, a, k in zip(patterns, low, count, strict=True):
            expected = [i for i in range(len(text) - size + 1) if (text[i:i + size] == p).all()]
            assert sorted(index.locate(np.arange(a, a + k)).tolist()) == expected
