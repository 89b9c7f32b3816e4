"""Ranges of repeated words, joined by document."""

import time

import numpy as np
import pyarrow as pa

from foldline.llm.sentence_spans import _joined, _merged

KIND = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def plain(own):
    out = []
    for a, b in own:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def column(rows):
    return pa.array([[{"start": a, "end": b} for a, b in own] for own in rows], KIND)


def test_joined_ranges_are_those_of_a_plain_loop():
    rng = np.random.default_rng(3)
    rows = [sorted({(int(a), int(a + n)) for a, n in zip(rng.integers(0, 60, size), rng.integers(1, 9, size), strict=True)}) for size in rng.integers(0, 12, 400)]
    rows += [[], [(0, 5), (5, 7)], [(0, 9), (1, 2), (9, 10)], [(0, 1)], [(0, 1)], []]
    want = [plain(own) for own in rows]
    for a, b in ((0, len(rows)), (7, 300), (len(rows) - 1, len(rows)), (3, 3)):
        got = _joined(column(rows).slice(a, b - a)).to_pylist()
        assert [[(r["start"], r["end"]) for r in own] for own in got] == want[a:b]


def test_windows_of_a_batch_are_joined_without_an_object_each():
    start = np.tile(np.arange(1000, dtype=np.int32), 2000)
    ranges = pa.StructArray.from_arrays([pa.array(start), pa.array(start + 50)], ["start", "end"])
    lists = pa.ListArray.from_arrays(pa.array(np.arange(2001, dtype=np.int32) * 1000), ranges)
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(2000)), pa.array(np.arange(2000)), lists], ["doc_id", "text_key", "ranges"])
    began = time.process_time()
    out = next(_merged(iter([batch])))
    assert time.process_time() - began < 1  # two million dicts took 5 s and more
    assert out.column(2).to_pylist() == [[{"start": 0, "end": 1049}]] * 2000
