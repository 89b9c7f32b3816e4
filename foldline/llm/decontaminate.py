"""Benchmark decontamination: passages of benchmark items found in documents by an FM-index of each shard.

A shard is a run of a task's documents. Its words become symbols of the benchmark's
vocabulary (a word that no item has ends a run; runs too short for any window hold
none). The shard's suffixes are sorted, their preceding symbols go into a wavelet
matrix, and all windows are searched backwards at once by its ranks. Occurrences
are located by stepping back to sampled suffix positions, and the words they cover
merge into removal spans.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldline.llm import textbytes as tb
from foldline.llm.shared import Scratch, documents

#: UTF-8 bytes of benchmark texts that are broadcast at once.
BENCHMARK_BYTES = 4 << 20
#: UTF-8 bytes of documents (one at least), and symbols, in a shard.
SHARD_BYTES, SHARD_SYMBOLS = 1 << 22, 1 << 20
#: Every so many text positions one has its place stored.
SAMPLE = 16
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_SPAN = "array<struct<first: long, last: long, start: long, end: long>>"
_FOUND = f"doc_id long, key string, n_words long, n_hit long, items array<string>, spans {_SPAN}"


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order, by prefix doubling; 0 separates, and an earlier 0 is the smaller.

    Only suffixes that still tie are sorted again.
    """
    n, gaps = len(symbols), symbols == 0
    rank = np.where(gaps, np.cumsum(gaps) - 1, symbols + int(gaps.sum())).astype(np.int64)
    bits = int(rank.max()).bit_length()
    depth = max(1, 63 // bits)
    ahead = np.concatenate([rank, np.zeros(depth, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(depth):
        key = (key << bits) | ahead[k:n + k]
    order = np.argsort(key, kind="stable")
    at, tied = np.arange(n), key[order]
    while True:
        starts = np.append(True, tied[1:] != tied[:-1])
        rank[order[at]] = at[np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))]
        alone = starts & np.append(starts[1:], True)
        at = at[~alone]
        if not len(at):
            return order
        rows = order[at]
        key = rank[rows] * (n + 1) + rank[np.minimum(rows + depth, n - 1)]
        again = np.argsort(key, kind="stable")
        order[at], tied = rows[again], key[again]
        depth *= 2


class WaveletMatrix:
    """Symbols by bits, highest first; each level keeps how many ones lie before each place."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.bits = max(1, int(top).bit_length())
        self.ones, self.zeros = [], []
        for b in range(self.bits - 1, -1, -1):
            bit = (symbols >> b) & 1
            ones = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(symbols) - int(ones[-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def place(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where ``at`` leads among the places of ``symbol``; the difference of two such is a difference of ranks."""
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            up = (symbol >> (self.bits - 1 - k)) & 1
            at = np.where(up == 1, zeros + ones[at], at - ones[at])
        return at

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at ``at`` and where they lead."""
        symbol = np.zeros(len(at), np.int64)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            up = ones[at + 1] - ones[at]
            symbol = 2 * symbol + up
            at = np.where(up == 1, zeros + ones[at], at - ones[at])
        return symbol, at


class FmIndex:
    """Full-text index of symbols 1..top in runs that 0 separates; begins and ends with 0."""

    def __init__(self, symbols: np.ndarray, top: int):
        order = suffix_order(symbols)
        before = symbols[order - 1]
        self.tree = WaveletMatrix(before, top)
        every = np.arange(top + 1)
        counts = np.bincount(symbols, minlength=top + 1)
        #: what turns a place in the wavelet matrix into a suffix rank
        self.shift = np.cumsum(counts) - counts - self.tree.place(every, np.zeros(top + 1, np.int64))
        kept = (order % SAMPLE == 0) | (before == 0)  # what follows a separator is sampled, so no step passes one
        self.kept, self.stored = np.concatenate([[0], np.cumsum(kept)]), order[kept]
        self.size = len(symbols)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First rank and number of suffixes that begin with each row of ``patterns``, all of one length."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size)
        live = np.arange(len(patterns))
        for k in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[live, k]
            a, b = (self.tree.place(c, x[live]) + self.shift[c] for x in (low, high))
            low[live], high[live] = a, b
            live = live[b > a]
        return low, np.maximum(high - low, 0)

    def locate(self, rank: np.ndarray) -> np.ndarray:
        """Text positions of suffixes by rank."""
        out, steps, live = np.empty(len(rank), np.int64), np.zeros(len(rank), np.int64), np.arange(len(rank))
        rank = rank.copy()
        while len(live):
            r = rank[live]
            found = self.kept[r + 1] > self.kept[r]
            out[live[found]] = self.stored[self.kept[r[found]]] + steps[live[found]]
            live = live[~found]
            symbol, place = self.tree.access(rank[live])
            rank[live] = place + self.shift[symbol]
            steps[live] += 1
        return out


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row of all words of lower-cased texts: runs of a-z, 0-9 and bytes from 0x80."""
    solid = np.append(_WORD[data], False)
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    begin = solid.copy()
    begin[1:] &= ~solid[:-1] | cut[1:]
    stop = solid[:-1] & (~solid[1:] | cut[1:])
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


class Phrases:
    """The distinct windows of a block of items, over a vocabulary of its words numbered from 1."""

    def __init__(self, items: list[tuple[str, str | None]], n: int):
        data, offsets = tb.flat(pa.array([t for _, t in items], pa.string()), lower=True)
        start, end, row = word_bounds(data, offsets)
        number: dict[bytes, int] = {}
        ids = np.array([number.setdefault(w, len(number) + 1) for w in tb.pieces(data, start, end)], np.int64)
        words = list(number)
        self.top = len(words)
        self.bytes = np.frombuffer(b"".join(words), np.uint8)
        self.length = np.array([len(w) for w in words], np.int64)
        self.start = np.cumsum(self.length) - self.length
        hashes = tb.span_hashes(self.bytes, self.start, self.start + self.length)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two words of the benchmark share a hash")
        owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
        first = np.searchsorted(row, np.arange(len(items) + 1))
        for k, (item, _) in enumerate(items):
            own = ids[first[k]:first[k + 1]].tolist()
            for i in range(max(1, len(own) - n + 1) if own else 0):
                owners[tuple(own[i:i + n])].add(item)
        by: dict[int, list[tuple[int, ...]]] = defaultdict(list)
        for p in owners:
            by[len(p)].append(p)
        #: by length, the windows and the items of each
        self.windows = {size: (np.array(p, np.int64), [sorted(owners[x]) for x in p]) for size, p in sorted(by.items())}

    def symbols(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of each word, 0 if the items don't have it."""
        h = tb.span_hashes(data, start, end)
        at = np.minimum(np.searchsorted(self.hashes, h), max(0, self.top - 1))
        return np.where(self.hashes[at] == h, self.order[at] + 1, 0) if self.top else np.zeros(len(h), np.int64)

    def differ(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Whether words are others than the ones whose hash they share."""
        same = end - start == self.length[symbol - 1]
        s, length, v = start[same], (end - start)[same], self.start[symbol[same] - 1]
        wrong = data[tb.ragged(s, length)] != self.bytes[tb.ragged(v, length)]
        same[same] = np.bincount(np.repeat(np.arange(len(s)), length), weights=wrong, minlength=len(s)) == 0
        return ~same


def occurrences(symbols: np.ndarray, row: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, list[set[str]]]:
    """Which words of a shard lie in an occurrence of a window, and the items found in each row."""
    hit, items = np.zeros(len(symbols) + 1, np.int64), defaultdict(set)
    least, longest = min(phrases.windows), max(phrases.windows)
    known = symbols > 0
    begins = known & np.append(True, ~known[:-1] | (row[1:] != row[:-1]))[:len(known)]
    run = np.cumsum(begins) - 1
    length = np.bincount(run[known], minlength=int(begins.sum()))
    words = np.flatnonzero(known)
    words = words[length[run[words]] >= least]
    if len(words):
        fresh = np.append(True, run[words[1:]] != run[words[:-1]])
        at = np.arange(len(words)) + np.cumsum(fresh)
        text = np.zeros(at[-1] + 2, np.int64)
        place = np.zeros(len(text), np.int64)
        text[at], place[at] = symbols[words], words
        for start in range(0, len(text), SHARD_SYMBOLS):  # the next part begins so early that no occurrence is cut
            part = text[start:start + SHARD_SYMBOLS + longest - 1]
            index = FmIndex(np.concatenate([[0], part, [0]]), phrases.top)
            for size, (windows, owners) in phrases.windows.items():
                low, count = index.search(windows)
                which = np.repeat(np.arange(len(windows)), count)
                first = place[index.locate(tb.ragged(low, count)) - 1 + start]
                np.add.at(hit, first, 1)
                np.add.at(hit, first + size, -1)
                found = np.unique(row[first] * len(windows) + which) if len(first) else first
                for r, w in zip((found // len(windows)).tolist(), (found % len(windows)).tolist(), strict=True):
                    items[r].update(owners[w])
    return np.cumsum(hit[:-1]) > 0, items


def _spans(hit: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of each run of hit words of one row."""
    same = np.append(row[1:] == row[:-1], False) if len(row) else np.zeros(0, bool)
    opens = hit & ~np.append(False, hit[:-1] & same[:-1])[:len(hit)]
    shuts = hit & ~(same & np.append(hit[1:], False))[:len(hit)]
    return np.flatnonzero(opens), np.flatnonzero(shuts)


def _search(shared):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    schema = to_arrow_schema(_parse_datatype_string(_FOUND))

    def shard(texts: pa.Array, ids: pa.Array, keys: pa.Array, phrases: Phrases) -> pa.RecordBatch:
        data, offsets = tb.flat(texts, lower=True)
        start, end, row = word_bounds(data, offsets)
        hit, items = np.zeros(len(start), bool), {}
        if phrases.windows and len(start):
            symbols = phrases.symbols(data, start, end)
            while True:  # once more without a word that only shared a hash
                hit, items = occurrences(symbols, row, phrases)
                at = np.flatnonzero(hit)
                wrong = at[phrases.differ(data, start[at], end[at], symbols[at])]
                if not len(wrong):
                    break
                symbols[wrong] = 0
        a, b = _spans(hit, row)
        n = len(texts)
        spans = [{"first": f, "last": g, "start": s, "end": e} for f, g, s, e in zip(*(x.tolist() for x in (
            a - np.searchsorted(row, row[a]), b - np.searchsorted(row, row[a]), start[a] - offsets[row[a]], end[b] - offsets[row[a]])), strict=True)]
        cut = np.searchsorted(row[a], np.arange(n + 1)).tolist()
        return pa.RecordBatch.from_pydict({
            "doc_id": ids, "key": keys, "n_words": np.bincount(row, minlength=n), "n_hit": np.bincount(row[hit], minlength=n),
            "items": [sorted(items.get(r, ())) for r in range(n)], "spans": [spans[x:y] for x, y in zip(cut, cut[1:], strict=False)]}, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = shared.value
        for batch in batches:
            _, offsets = tb.flat(batch["text"])
            for first, last in tb.blocks(offsets, SHARD_BYTES):
                part = batch.slice(first, last - first)
                yield shard(part["text"], part["doc_id"], part["key"], phrases)
    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans and items of one document from several blocks of items, as one list each."""
    for batch in batches:
        rows = batch.to_pylist()
        for row in rows:
            spans: list[dict] = []
            for x in sorted((x for part in row["spans"] for x in part), key=lambda x: x["first"]):
                if spans and x["first"] <= spans[-1]["last"] + 1:
                    if x["last"] > spans[-1]["last"]:
                        spans[-1] |= {"last": x["last"], "end": x["end"]}
                else:
                    spans.append(dict(x))
            row |= {"spans": spans, "items": sorted({i for part in row["items"] for i in part}), "n_hit": sum(x["last"] - x["first"] + 1 for x in spans)}
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("doc_id", pa.int64()), ("key", pa.string()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), (
            "spans", pa.list_(pa.struct([(k, pa.int64()) for k in ("first", "last", "start", "end")])))]))


def _digest() -> Column:
    return F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)


def _or_empty(name: str, kind: str) -> Column:
    return F.coalesce(name, F.array().cast(kind)).alias(name)


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, benchmark_bytes: int = 0, keyed: bool = False) -> DataFrame:
    """(doc_id, key, n_words, n_hit, items, spans) of every document: what windows of ``n`` words of ``benchmark`` cover.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; further columns
    count for nothing. Words are runs of a-z (A-Z lower-cased), 0-9 and characters
    from U+0080 on. An item of fewer than n words is one window; without words, or
    without an id, it has none. ``items`` are the ids as strings, in order, of items
    with a window in the document. ``spans`` are maximal runs of covered words,
    first and last word and start and end byte of the UTF-8 text. Null and empty
    texts have no words; repeated rows get a row each; an empty benchmark hits nothing.

    A task indexes its documents about 4 MB at a time. The items are broadcast in
    blocks of at most ``benchmark_bytes`` (4 MB) of text, a longer item alone, each
    block in a pass over the documents; what several passes find is joined by doc_id
    and the text's digest, ``key`` (null where one block holds all items, unless ``keyed``).
    """
    spark = docs.sparkSession
    asked = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).dropna()
    total = asked.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    blocks = max(1, -(-total // (benchmark_bytes or BENCHMARK_BYTES)))
    own = documents(docs).withColumn("key", _digest() if keyed or blocks > 1 else F.lit(None).cast("string"))
    passes = []
    for block in range(blocks):
        held = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        shared = spark.sparkContext.broadcast(Phrases([tuple(r) for r in held.toLocalIterator()], n))
        passes.append(own.mapInArrow(_search(shared), _FOUND))
    if blocks == 1:
        return passes[0]
    scratch = Scratch(spark, "decontaminate")
    passes = [scratch.write(x, "pass") for x in passes]
    found = reduce(DataFrame.unionByName, (x.where("n_hit > 0").dropDuplicates(["doc_id", "key"]) for x in passes))
    groups = found.groupBy("doc_id", "key").agg(F.collect_list("items").alias("items"), F.collect_list("spans").alias("spans"))
    merged = groups.select("doc_id", "key", F.lit(0).cast("long").alias("n_hit"), "items", "spans").mapInArrow(
        _merge, f"doc_id long, key string, n_hit long, items array<string>, spans {_SPAN}").withColumnsRenamed({"doc_id": "d", "key": "k"})
    rows = passes[0].select("doc_id", "key", "n_words")
    joined = rows.join(merged, rows["doc_id"].eqNullSafe(merged["d"]) & (rows["key"] == merged["k"]), "left")
    out = joined.select("doc_id", "key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), _or_empty("items", "array<string>"), _or_empty("spans", _SPAN))
    return scratch.result(out, "contamination")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their spans."""
    for batch in batches:
        texts = batch["text"].to_pylist()
        for k, spans in enumerate(batch["spans"].to_pylist()):
            if spans:
                raw = texts[k].encode()
                edges = [0, *(e for x in spans for e in (x["start"], x["end"])), len(raw)]
                texts[k] = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)).decode()
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string()), batch["n_hit"], batch["items"]], ["doc_id", "text", "n_hit", "items"])


def without_contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, benchmark_bytes: int = 0) -> DataFrame:
    """(doc_id, text, n_hit, items) of every document, its spans (see ``contamination``) cut out of the text.

    Texts and spans meet by doc_id and the text's digest. A null text stays null.
    """
    found = contamination(docs, benchmark, n, benchmark_bytes, keyed=True).where("n_hit > 0").dropDuplicates(["doc_id", "key"])
    found = found.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), "n_hit", "items", "spans")
    own = documents(docs).withColumn("key", _digest())
    joined = own.join(found, own["doc_id"].eqNullSafe(found["d"]) & (own["key"] == found["k"]), "left")
    return joined.select("doc_id", "text", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), _or_empty("items", "array<string>"), "spans").mapInArrow(
        _cut, "doc_id long, text string, n_hit long, items array<string>")
