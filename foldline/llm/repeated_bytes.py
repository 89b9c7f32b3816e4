"""Byte strings that occur more than once, by anchored contexts.

Triggers of a rolling hash cut every text: the trigger of a window of ``length``
bytes is the position of its smallest gram hash, so equal windows have equal
triggers wherever they stand. Grams that occur once rule their windows out. At the
others, the bytes that the windows of a trigger span are its context. Equal contexts
are counted first: a context met twice is repeated whole, and one of its kind goes
on. The contexts that are left of a gram are sorted by what follows the trigger and,
reversed, by what precedes it; both orders with their common prefix lengths tell
which windows are equal. A gram of very many different contexts is first split by
what its windows share (see ``split_grams``).

This takes the place of the dictionary and parse suffix arrays of prefix-free
parsing: the order of the whole corpus isn't needed for strings of one length, and
anchored groups are independent of each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldline.llm import textbytes as tb
from foldline.llm.shared import Scratch

#: Different contexts of one gram that a task takes; a gram of more is split.
HOT = 4000
_SALTS = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))
_POSITION = np.uint64(0xFFFFFFFF)


def triggers(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(row, trigger, first window, last window, gram hash) of every run of windows that share a trigger; positions in ``data``."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none.astype(np.uint64)
    span = length - gram + 1
    at = np.arange(len(data) - gram + 1)
    hashes = tb.span_hash(tb.prefix_hash(data), at, at + gram)
    # the smallest of each span, with its leftmost place in the low bits: block-wise minima from both sides
    low = (hashes & ~_POSITION) | at.astype(np.uint64)
    padded = np.concatenate([low, np.full(-len(low) % span + span, ~np.uint64(0))]).reshape(-1, span)
    ahead = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(padded, axis=1).ravel()
    windows = len(data) - length + 1
    place = (np.minimum(ahead[:windows], behind[span - 1:span - 1 + windows]) & _POSITION).astype(np.int64)
    row = np.searchsorted(offsets, np.arange(windows), "right") - 1
    inside = np.flatnonzero(np.arange(windows) + length <= offsets[row + 1])
    if not len(inside):
        return none, none, none, none, none.astype(np.uint64)
    place, row = place[inside], row[inside]
    new = np.append(True, (place[1:] != place[:-1]) | (row[1:] != row[:-1]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(inside)) - 1
    return row[first], place[first], inside[first], inside[last], hashes[place[first]]


def equal_windows(key: np.ndarray, left: list[bytes], right: list[bytes], length: int, span: int) -> np.ndarray:
    """For each occurrence and each l < span: does its window that starts l bytes before the trigger occur at another one of its key?"""
    n = len(key)
    last = np.array([len(x) for x in left])  # most bytes before the trigger
    first = length - np.array([len(x) for x in right])  # fewest
    prefix = key.astype(">u8").tobytes()

    def order(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each suffix in sorted order, and the common prefix with the one before."""
        width = 8 + max(map(len, parts))
        rows = np.frombuffer(b"".join((prefix[8 * i:8 * i + 8] + x).ljust(width, b"\0") for i, x in enumerate(parts)), np.uint8).reshape(n, width)
        sort = np.argsort(rows.view(f"S{width}").ravel(), kind="stable")
        differ = rows[sort[1:]] != rows[sort[:-1]]
        common = np.where(differ.any(1), differ.argmax(1), width) - 8
        rank = np.empty(n, np.int64)
        rank[sort] = np.arange(n)
        return rank, np.append(-1, common)

    rank_r, common_r = order(right)
    rank_l, common_l = order([x[::-1] for x in left])
    out = np.zeros((n, span), bool)
    for at in range(span):
        has = np.flatnonzero((first <= at) & (at <= last))
        if len(has) < 2:
            continue
        same_r = np.cumsum(common_r < length - at)[rank_r[has]]
        same_l = np.cumsum(common_l < at)[rank_l[has]]
        pair = same_r * (n + 1) + same_l
        sort = np.argsort(pair, kind="stable")
        equal = pair[sort[1:]] == pair[sort[:-1]]
        twice = np.append(equal, False) | np.append(False, equal)
        out[has[sort[twice]], at] = True
    return out


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, text_key: a null id counts as the smallest long, a null text as empty; the key tells apart texts that share an id."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every span of bytes."""
    prefix = tb.prefix_hash(data)
    one = tb.span_hash(prefix, start, end)
    back = np.zeros(len(data) + 1, np.uint64)  # the second from running sums of other values
    np.cumsum((tb.mix(data.astype(np.uint64) + _SALTS[0]) | np.uint64(1)) * tb.powers(len(data))[0][:len(data)], out=back[1:])
    return one.view(np.int64), tb.mix(tb.span_hash(back, start, end) ^ _SALTS[1]).view(np.int64)


def split_grams(contexts: DataFrame, length: int, span: int, scratch: Scratch) -> DataFrame:
    """(doc_id, text_key, start, end): the repeated windows of different contexts (doc_id, text_key, at, left, right) of any number.

    The places l that a window may start before the trigger are quartered again and
    again. What all windows of a part share, its core, tells apart contexts that have
    no window in common there. Contexts that agree on all the windows' bytes, the
    part's hull, repeat it whole, and one of them goes on; so does what agrees on
    the core alone, with the quarters of the part. Groups are only ever counted, so no
    task sees a group, and a context costs a few rows a level. Equality is that of
    two 64-bit hashes.
    """
    place = ["doc_id", "text_key", "at"]
    size = max(1, (1 << (span - 1).bit_length()) // 4)
    rows = contexts.select(*place, "left", "right", F.explode(F.array(*[F.lit(k) for k in range(0, span, size)])).alias("a"))
    found = []
    while True:
        def hashed(batches: Iterator[pa.RecordBatch], size: int = size) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                left, right = (batch[c].cast(pa.large_binary()).fill_null(b"") for c in ("left", "right"))
                n_left, n_right = (pc.binary_length(x).to_numpy().astype(np.int64) for x in (left, right))
                low = batch["a"].to_numpy().astype(np.int64)
                high = low + size - 1
                first, last = length - n_right, n_left  # the places that the context has
                use = np.flatnonzero((low <= last) & (first <= high))
                if not len(use):
                    continue
                raw = b"".join(x for i in use.tolist() for x in (left[i].as_py(), right[i].as_py()))
                data = np.frombuffer(raw, np.uint8)
                total = (n_left + n_right)[use]
                mid = np.cumsum(total) - total + n_left[use]  # the trigger
                low, high, first, last = low[use], high[use], first[use], last[use]
                k1, k2 = _hashes(data, mid - low, mid + length - np.minimum(high, span - 1))
                whole = (first <= low) & (np.minimum(high, span - 1) <= last)
                h1, h2 = _hashes(data, mid - np.where(whole, np.minimum(high, span - 1), 0), mid + length - np.where(whole, low, first))
                # a context that lacks some of the windows is alike to none
                own = [batch[c].take(pa.array(use)) for c in place]
                alone = tb.mix(np.stack([c.to_numpy().astype(np.int64) for c in own]).view(np.uint64) * np.array([[1], [3], [5]], np.uint64)).sum(0, dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*own, *(batch[c].take(pa.array(use)) for c in ("left", "right", "a")), pa.array(k1), pa.array(k2), pa.array(np.where(whole, h1, alone)), pa.array(np.where(whole, h2, 0)), pa.array(whole)],
                    [*place, "left", "right", "a", "k1", "k2", "h1", "h2", "whole"])

        core, hull = ["a", "k1", "k2"], ["a", "k1", "k2", "h1", "h2", "whole"]
        known = scratch.write(rows.mapInArrow(hashed, "doc_id long, text_key long, at long, left binary, right binary, a int, k1 long, k2 long, h1 long, h2 long, whole boolean"), "parts")
        alike = known.groupBy(*hull).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*place)).alias("one"))
        kinds = alike.groupBy(*core).agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("members")).where("members > 1")
        met = scratch.write(known.join(alike.join(kinds, core), hull).select(*place, "left", "right", "a", "whole", "n", "one", "kinds"), "alike")
        high = F.least(F.col("a") + size - 1, F.lit(span - 1))
        found.append(met.where("whole AND n > 1").select("doc_id", "text_key", (F.col("at") - high).alias("start"), (F.col("at") - F.col("a") + length).alias("end")))
        if size == 1:
            return reduce(DataFrame.unionByName, found)
        on = met.where((F.struct(*place) == F.col("one")) & (F.col("kinds") > 1)).select(*place, "left", "right", "a")
        size, before = max(1, size // 4), size
        rows = on.select(*place, "left", "right", F.explode(F.array(*[F.col("a") + k for k in range(0, before, size)])).alias("a"))


def repeated_spans(docs: DataFrame, length: int = 200, gram: int = 80) -> DataFrame:
    """(doc_id, text_key, spans): the maximal byte ranges covered by strings of ``length`` bytes that start anywhere else too.

    Texts are bytes in UTF-8; matches do not cross documents, overlaps count.
    Only documents with such a range have a row. Every input row is a document,
    so rows that repeat a text repeat all its strings; texts shorter than
    ``length`` have no range.
    """
    span = length - gram + 1
    scratch = Scratch(docs.sparkSession, "repeated-bytes")
    rows = keyed(docs)
    sizes = rows.select("doc_id", "text_key", F.octet_length("text").alias("n"))
    copies = sizes.groupBy("text_key", "n").agg(F.count(F.lit(1)).alias("copies")).where((F.col("copies") > 1) & (F.col("n") >= length))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tb.flat(batch.column(1))
            ids, keys = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            once = np.zeros(len(keys), bool)  # the smallest id of a text stands for its copies
            order = np.lexsort((ids, keys))
            once[order] = np.append(True, keys[order][1:] != keys[order][:-1])
            for a, b in tb.blocks(offsets):
                base = offsets[a:b + 1]
                row, at, first, last, gram_hash = triggers(data[base[0]:base[-1]], base - base[0], length, gram)
                use = once[row + a]
                row, at, first, last, gram_hash = row[use], at[use], first[use], last[use], gram_hash[use]
                start = (base - base[0])[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram_hash.view(np.int64)), pa.array(keys[row + a]), pa.array((at - start).astype(np.int64)), pa.array(ids[row + a]),
                     pa.array(((at - last) | (at - first) << 16).astype(np.int32))], ["gram", "text_key", "at", "doc_id", "reach"])

    def repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows sorted by gram, text and place: one for each text and place, if the gram has another."""
        held, seen = None, False  # the last row so far, and whether one of its gram was before it
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch])
            gram_, text, at = (table.column(i).to_numpy() for i in range(3))
            one = np.append(True, (gram_[1:] != gram_[:-1]) | (text[1:] != text[:-1]) | (at[1:] != at[:-1]))
            table, gram_ = table.filter(pa.array(one)), gram_[one]
            same = gram_[1:] == gram_[:-1]
            known = np.append(seen, same)
            keep = known | np.append(same, False)
            held, seen = table.slice(len(table) - 1).combine_chunks().to_batches()[0], bool(known[-1])
            yield from table.slice(0, len(table) - 1).filter(pa.array(keep[:-1])).combine_chunks().to_batches()
        if held is not None and seen:
            yield held

    schema = "gram long, text_key long, at long, doc_id long, reach int"
    parsed = rows.mapInArrow(parse, schema)
    met = scratch.write(parsed.repartition("gram").sortWithinPartitions("gram", "text_key", "at", "doc_id").mapInArrow(repeats, schema), "repeated-grams")
    by_text = met.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("gram", "at", "reach")).alias("places"))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bytes that the windows of each trigger span, and their hashes."""
        for batch in batches:
            ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, (text, places) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                raw = text.as_buffer().to_pybytes()
                gram_, at, reach = (places.values.field(k).to_numpy(zero_copy_only=False) for k in range(3))
                low, high = (reach & 0xFFFF).astype(np.int64), (reach >> 16).astype(np.int64)
                c1, c2 = _hashes(np.frombuffer(raw, np.uint8), at - high, at - low + length)
                left = [raw[a - h:a] for a, h in zip(at.tolist(), high.tolist(), strict=True)]
                right = [raw[a:a - x + length] for a, x in zip(at.tolist(), low.tolist(), strict=True)]
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram_), pa.array(at), pa.array(left, pa.binary()), pa.array(right, pa.binary()), pa.array(c1), pa.array(tb.mix(c2.view(np.uint64) ^ (high << 20 | low).astype(np.uint64)).view(np.int64)),
                     pa.array([ids[i]] * n, pa.int64()), pa.array([keys[i]] * n, pa.int64())], ["gram", "at", "left", "right", "c1", "c2", "doc_id", "text_key"])

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Start ranges of the repeated windows, from rows sorted by gram; several grams at once, each whole."""
        held: list[pa.Table] = []
        for batch in _with_end(batches):
            if batch is not None:
                held.append(pa.Table.from_batches([batch]))
                if sum(t.num_rows for t in held) < 3 * HOT:
                    continue
            if not held:
                continue
            table = pa.concat_tables(held).combine_chunks()
            keys = table.column(0).to_numpy()
            end = len(table) if batch is None else int(np.searchsorted(keys, keys[-1], "left"))
            held = [table.slice(end)] if end < len(table) else []
            if end:
                table = table.slice(0, end)
                twice = equal_windows(keys[:end].view(np.uint64), table.column(2).to_pylist(), table.column(3).to_pylist(), length, span)
                edge = np.diff(twice.astype(np.int8), axis=1, prepend=0, append=0)
                row, low = np.nonzero(edge == 1)
                high = np.nonzero(edge == -1)[1] - 1
                at = table.column(1).to_numpy()[row]
                yield pa.RecordBatch.from_arrays([table.column(4).take(pa.array(row)).combine_chunks(), table.column(5).take(pa.array(row)).combine_chunks(),
                                                  pa.array(at - high), pa.array(at - low + length)], ["doc_id", "text_key", "start", "end"])

    found_schema = "doc_id long, text_key long, start long, end long"
    near = rows.join(by_text, ["doc_id", "text_key"]).select("doc_id", "text_key", F.col("text").cast("binary").alias("text"), "places").mapInArrow(
        contexts, "gram long, at long, left binary, right binary, c1 long, c2 long, doc_id long, text_key long")
    near = scratch.write(near, "contexts")
    place = F.struct("doc_id", "text_key", "at")
    kinds = scratch.write(near.groupBy("gram", "c1", "c2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("one"), F.first("left").alias("left"), F.first("right").alias("right")), "kinds")
    several = kinds.where("n > 1").select("gram", "c1", "c2")
    reach = near.select("gram", "c1", "c2", "doc_id", "text_key", (F.col("at") - F.length("left")).alias("start"), (F.col("at") + F.length("right")).alias("end"))
    equal = reach.join(several, ["gram", "c1", "c2"]).select("doc_id", "text_key", "start", "end")
    sizes_ = kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    left = scratch.write(kinds.join(sizes_, "gram").select("gram", "one.at", "left", "right", "one.doc_id", "one.text_key", "m"), "different")
    cold = left.where(F.col("m") <= HOT).drop("m").repartition("gram").sortWithinPartitions("gram").mapInArrow(order, found_schema)
    hot = left.where(F.col("m") > HOT)
    if not hot.isEmpty():
        cold = cold.unionByName(split_grams(hot, length, span, scratch))
    whole = sizes.join(copies, ["text_key", "n"]).select("doc_id", "text_key", F.lit(0).cast("long").alias("start"), F.col("n").cast("long").alias("end")).distinct()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ranges in batch.column(2):
                start, end = (ranges.values.field(k).to_numpy() for k in range(2))
                reach = np.maximum.accumulate(end)
                new = np.append(True, start[1:] > reach[:-1])
                out.append([{"start": a, "end": b} for a, b in zip(start[new].tolist(), reach[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)].tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                                             ["doc_id", "text_key", "spans"])

    ranges = cold.unionByName(equal).unionByName(whole).groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("ranges"))
    return scratch.result(ranges.mapInArrow(merge, "doc_id long, text_key long, spans array<struct<start:long,end:long>>"), "spans")


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def without_repeats(docs: DataFrame, length: int = 200, gram: int = 80) -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (removed byte ranges), kept (the remaining bytes).

    Null and empty texts, and texts without a repeated string, have no spans
    and keep all bytes. Other columns are ignored.
    """
    spans = repeated_spans(docs, length, gram)
    joined = keyed(docs).join(spans, ["doc_id", "text_key"], "left").select("doc_id", F.col("text").cast("binary").alias("text"), "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for text, ranges in zip(batch.column(1), batch.column(2), strict=True):
                raw = text.as_py()
                if ranges.is_valid:
                    at, parts = 0, []
                    for r in ranges.as_py():
                        parts.append(raw[at:r["start"]])
                        at = r["end"]
                    raw = b"".join([*parts, raw[at:]])
                kept.append(raw)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(kept, pa.binary())], ["doc_id", "text", "spans", "kept"])

    cut_rows = joined.mapInArrow(cut, "doc_id long, text binary, spans array<struct<start:long,end:long>>, kept binary")
    return cut_rows.select(F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")).alias("doc_id"), F.length("text").cast("long").alias("n_bytes"),
                           F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"), "kept")


def digests(cut: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of what ``without_repeats`` returns."""
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
