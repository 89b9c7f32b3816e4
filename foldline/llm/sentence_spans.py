"""Substring deduplication over sliding spans of sentences, and of words where a repeat is long.

Spans of whole sentences find short repeats. A passage of PASSAGE words or more
is found wherever it begins and ends: of every window of so many words the
smallest hash of GRAM words is an anchor, so that equal windows have equal
anchors. If all the words that an anchor's windows touch are the same wherever it
is met, those repeat whole; else the windows are compared themselves.

Texts are parsed to arrays of word hashes; the hash of any run of words is one
subtraction of running sums. Places are words, and a document is its id together
with its text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldline.llm import textbytes as tb
from foldline.llm.shared import Scratch

#: A sentence ends after such punctuation and the white space behind it, or after line breaks.
_END = re.compile(r"[.!?]+\s+|\n\s*")
#: A word and the white space around it that no word before it has.
_WORD = re.compile(r"^\s*\S+\s*|\S+\s*")
#: White space beyond that of textbytes, and the bytes that such a character may begin with.
_WIDE = r"[\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_MAYBE_WIDE = np.isin(np.arange(256), [0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3])
_STOP = np.isin(np.arange(256), list(b".!?"))
_SALTS = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))


def sentences(text: str) -> list[str]:
    """The sentences of a text, with what stands between them at their ends; joined they give the text."""
    cuts = [0, *(m.end() for m in _END.finditer(text))]
    if cuts[-1] < len(text):
        cuts.append(len(text))
    return [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


#: A sentence of so many words is a run by itself.
LONG = 25
#: A repeat of so many words goes, also where it begins or ends within a sentence.
PASSAGE = 50
#: Words of an anchor.
GRAM = 10
_SLICE = 1 << 17


def spans(text: str, min_sentences: int, min_words: int) -> Iterator[tuple[bytes, int, int]]:
    """(digest, first sentence, end) of every run of one text: from each sentence the shortest run of both sizes.

    A sentence of ``LONG`` words or more is also a run by itself. Sentences
    compare in lower case and with single spaces. What the operator does for whole
    columns, in words that are easy to check.
    """
    words = [s.lower().split() for s in sentences(text)]
    digests = [xxhash.xxh3_128_digest(" ".join(w)) for w in words]
    total = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    ends = np.maximum(np.searchsorted(total, total[:-1] + min_words), np.arange(len(words)) + min_sentences).tolist()
    for i, end in enumerate(ends):
        if end > len(words):
            break
        yield xxhash.xxh3_128_digest(b"".join(digests[i:end])), i, end
    yield from ((digests[i], i, i + 1) for i, w in enumerate(words) if len(w) >= LONG)


class Words:
    """The words of some texts, lower-cased: rows, places in them, sentence ends, and hashes of any run."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        start, end, self.row = tb.words(data, offsets)
        self.n = len(start)
        self.first = np.searchsorted(self.row, np.arange(len(offsets)))  # of each row, and the number of words
        self.place = np.arange(self.n) - self.first[self.row]
        breaks = np.concatenate([[0], np.cumsum(data == 10)])
        after = np.append(start[1:], len(data)) if self.n else start
        last = np.append(self.row[1:] != self.row[:-1], True)[:self.n]
        self.stops = _STOP[data[end - 1]] | (breaks[after] > breaks[end]) | last if self.n else np.zeros(0, bool)
        hashes = tb.span_hashes(data, start, end)
        self.sums = []
        for salt in _SALTS:
            out = np.zeros(self.n + 1, np.uint64)
            np.cumsum((tb.mix(hashes ^ salt) | np.uint64(1)) * tb.powers(self.n)[0][:self.n], out=out[1:])
            self.sums.append(out)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
        """Two 64-bit hashes of every run of words start..end."""
        return [tb.span_hash(s, start, end).view(np.int64) for s in self.sums]

    def runs(self, min_sentences: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and end of every run, as in ``spans``."""
        end = np.flatnonzero(self.stops) + 1
        start = np.concatenate([[0], end[:-1]]) if len(end) else end
        edge = np.append(start, self.n)
        stop = np.maximum(np.searchsorted(edge, start + min_words), np.arange(len(start)) + min_sentences)
        fits = np.flatnonzero(stop <= len(start))
        fits = fits[self.row[start[fits]] == self.row[end[stop[fits] - 1] - 1]]
        alone = np.flatnonzero(end - start >= LONG)
        return np.concatenate([start[fits], start[alone]]), np.concatenate([end[stop[fits] - 1], end[alone]])

    def anchors(self) -> Iterator[tuple[np.ndarray, ...]]:
        """(hash, word, first window, last window) of the anchors of all windows of PASSAGE words, named by their first word."""
        more = PASSAGE - 1
        for a in range(0, self.n - more, _SLICE):
            b = min(self.n, a + _SLICE + more)
            at = np.arange(a, b - GRAM + 1)
            grams = tb.span_hash(self.sums[0], at, at + GRAM)
            window = np.arange(b - a - more)
            at = np.lib.stride_tricks.sliding_window_view(grams, PASSAGE - GRAM + 1).argmin(axis=1) + window
            inside = self.row[window + a] == self.row[window + a + more]
            window, at, code = window[inside] + a, at[inside] + a, grams[at[inside]]
            new = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else at
            last = window[np.append(new[1:], len(at)) - 1] if len(at) else at
            yield code[new].view(np.int64), at[new], window[new], last


def _parsed(column: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """(first row, end, words) of the texts of a column, a block at a time."""
    column = pc.utf8_lower(column.cast(pa.large_string()))
    data, offsets = tb.flat(column)
    if _MAYBE_WIDE[data].any():
        data, offsets = tb.flat(pc.replace_substring_regex(column, pattern=_WIDE, replacement=" "))
    for a, b in tb.blocks(offsets):
        at = offsets[a:b + 1]
        yield a, b, Words(data[at[0]:at[-1]], at - at[0])


def _batch(columns: dict, types: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns.values(), types, strict=True)], list(columns))


def _text_key(text: Column) -> Column:
    return F.xxhash64(text.cast("string"))


def _rows(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_key(text).alias("text_key"), text.alias("text")).where(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull())


_DOC = ["doc_id", "text_key"]
_LONG, _INT = pa.int64(), pa.int32()


def repeated_spans(docs: DataFrame, min_sentences: int = 2, min_words: int = 12) -> DataFrame:
    """(doc_id, text_key, start, end): words of sentence runs that occur before, at a smaller doc_id or earlier in the document.

    The first occurrence of a span is the one with the smallest (doc_id,
    text_key, word). Rows without an id or text have no spans, nor have texts
    too short for any; rows that repeat a doc_id and its text are one document,
    texts that share an id are several.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(k).to_numpy() for k in range(2))
            for a, _, words in _parsed(batch.column(2)):
                start, end = words.runs(min_sentences, min_words)
                row = words.row[start]
                h1, h2 = words.hashes(start, end)
                place = words.place[start]
                yield _batch({"h1": h1, "h2": h2, "doc_id": ids[row + a], "text_key": keys[row + a], "start": place, "end": place + end - start}, (_LONG,) * 4 + (_INT,) * 2)

    scratch = Scratch(docs.sparkSession, "sentence-spans")
    every = scratch.write(_rows(docs).mapInArrow(run, "h1 long, h2 long, doc_id long, text_key long, start int, end int"), "spans")
    place = F.struct(*_DOC, "start")
    # a span met once, or only at one place by rows that repeat, is no repeat
    firsts = scratch.write(every.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first != last").select("h1", "h2", "first"), "repeats")
    return scratch.result(every.join(firsts, ["h1", "h2"]).where(place != F.col("first")).select(*_DOC, "start", "end").distinct(), "repeated-spans")


def _joined(column: pa.ListArray) -> pa.ListArray:
    """Sorted ranges of each row, those that overlap or touch as one; no row is null."""
    own = column.flatten()
    start, end = (own.field(k).to_numpy().astype(np.int64) for k in range(2))
    length = column.value_lengths().to_numpy()
    # rows lie apart on one line, so that one running maximum serves all of them
    far = np.repeat(np.arange(len(column)), length) * (int(end.max(initial=0)) + 2)
    reach = np.maximum.accumulate(end + far)
    new = np.append(True, (start + far)[1:] > reach[:-1])[:len(start)]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start))[:len(first)] - 1
    ranges = pa.StructArray.from_arrays([pa.array(start[first], _INT), pa.array((reach - far)[last], _INT)], ["start", "end"])
    places = np.concatenate([[0], np.cumsum(length)])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(first, places), _INT), ranges)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with their ranges ``_joined``."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _joined(batch.column(2))], [*_DOC, "ranges"])


def merged(ranges: DataFrame) -> DataFrame:
    """(doc_id, text_key, ranges): one row a document, its word ranges sorted and apart."""
    own = ranges.groupBy(*_DOC).agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("ranges"))
    return own.mapInArrow(_merged, "doc_id long, text_key long, ranges array<struct<start:int,end:int>>")


def repeated_passages(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """(doc_id, text_key, start, end): ranges of PASSAGE words that occur before and that ``ranges`` (see ``merged``) leave a word of.

    An occurrence that overlaps the first one is none. Rows and their order are as in ``repeated_spans``.
    """
    def anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(k).to_numpy() for k in range(2))
            for a, _, words in _parsed(batch.column(2)):
                for code, at, first, last in words.anchors():
                    row = words.row[at] + a
                    c1, c2 = words.hashes(first, last + PASSAGE)
                    yield _batch({"anchor": code, "doc_id": ids[row], "text_key": keys[row], "word": words.place[at], "first": words.place[first], "last": words.place[last], "c1": c1, "c2": c2},
                                 (_LONG,) * 3 + (_INT,) * 3 + (_LONG,) * 2)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(k).to_numpy() for k in range(2))
            for a, b, words in _parsed(batch.column(2)):
                wanted = batch.column(3).slice(a, b - a)
                low, high = (wanted.flatten().field(k).to_numpy().astype(np.int64) for k in range(2))
                row = np.repeat(np.arange(b - a), wanted.value_lengths().to_numpy())
                asked = np.unique(tb.ragged(low + words.first[row], high - low + 1))
                row = words.row[asked]
                for i in range(0, len(asked), _SLICE):
                    own, r = asked[i:i + _SLICE], row[i:i + _SLICE]
                    w1, w2 = words.hashes(own, own + PASSAGE)
                    yield _batch({"w1": w1, "w2": w2, "doc_id": ids[r + a], "text_key": keys[r + a], "start": words.place[own]}, (_LONG,) * 4 + (_INT,))

    rows = _rows(docs)
    scratch = Scratch(docs.sparkSession, "passages")
    every = scratch.write(rows.mapInArrow(anchored, "anchor long, doc_id long, text_key long, word int, first int, last int, c1 long, c2 long"), "anchors")
    place, context = F.struct(*_DOC, "word"), F.struct("c1", "c2")
    twice = every.groupBy("anchor").agg(F.min(place).alias("least"), F.max(place).alias("most"), (F.min(context) == F.max(context)).alias("alike")).where("least != most")
    met = scratch.write(every.drop("c1", "c2").join(twice.drop("most"), "anchor"), "met")
    # where all contexts of an anchor are equal, so are their windows, one for one
    same = (F.col("doc_id") == F.col("least.doc_id")) & (F.col("text_key") == F.col("least.text_key"))
    later = ~same | (F.col("word") >= F.col("least.word") + PASSAGE)
    whole = met.where("alike").where(later).select(*_DOC, F.col("first").alias("start"), (F.col("last") + PASSAGE).alias("end"))
    # copies that the spans of sentences take away whole need no windows
    gone = F.exists("ranges", lambda r: (r["start"] <= F.col("first")) & (F.col("last") + PASSAGE <= r["end"]))
    left = met.where(~F.col("alike") & (place != F.col("least"))).join(ranges, _DOC, "left").where(F.col("ranges").isNull() | ~gone)
    wanted = met.join(left.select("anchor").distinct(), "anchor", "left_semi").groupBy(*_DOC).agg(F.collect_set(F.struct("first", "last")).alias("wanted"))
    seen = rows.join(scratch.write(wanted, "wanted"), _DOC).select(*_DOC, "text", "wanted")
    seen = scratch.write(seen.mapInArrow(windows, "w1 long, w2 long, doc_id long, text_key long, start int"), "windows")
    place = F.struct(*_DOC, "start")
    firsts = seen.groupBy("w1", "w2").agg(F.min(place).alias("least"), F.max(place).alias("most")).where("least != most").select("w1", "w2", "least")
    same = (F.col("doc_id") == F.col("least.doc_id")) & (F.col("text_key") == F.col("least.text_key"))
    apart = ~same | (F.col("start") >= F.col("least.start") + PASSAGE)  # the first occurrence itself stays
    again = seen.join(firsts, ["w1", "w2"]).where(apart)
    return scratch.result(again.select(*_DOC, "start", (F.col("start") + PASSAGE).alias("end")).unionByName(whole).distinct(), "repeated-passages")


def without(text: str, ranges: list[dict]) -> tuple[str, int, int]:
    """The text without the words of sorted ranges, its number of sentences, and of those of which nothing is left.

    A sentence whose words all go takes what stands behind it along.
    """
    parts = sentences(text)
    gone, at, k = 0, 0, 0
    for i, part in enumerate(parts):
        own = _WORD.findall(part)
        end = at + len(own)
        while k < len(ranges) and ranges[k]["end"] <= at:
            k += 1
        if k < len(ranges) and ranges[k]["start"] < end and own:
            cut = {w for r in ranges[k:] if r["start"] < end for w in range(max(at, r["start"]), min(end, r["end"]))} if ranges[k]["end"] < end or ranges[k]["start"] > at else range(at, end)
            left = [w for w, word in zip(range(at, end), own, strict=True) if w not in cut]
            gone += not left
            parts[i] = "".join(own[w - at] for w in left)
        at = end
    return "".join(parts), len(parts), gone


def drop_repeated_sentences(docs: DataFrame, min_sentences: int = 2, min_words: int = 12) -> DataFrame:
    """``docs``, all columns, without the sentences that any non-first repeated span covers, nor the words of non-first passages.

    Texts without such a span, null and empty ones too, stay as they are. Adds
    struct column ``span_dedup`` (n_sentences, n_removed: those of which
    nothing is left), which replaces a column of that name; other columns may have
    any names.
    """
    docs = docs.select(*[c for c in docs.columns if c != "span_dedup"])
    scratch = Scratch(docs.sparkSession, "spans-of-documents")
    runs = repeated_spans(docs, min_sentences, min_words)
    passages = repeated_passages(docs, scratch.write(merged(runs), "runs"))
    found = scratch.result(merged(runs.unionByName(passages)), "ranges").toDF("_doc", "_key", "_ranges")
    names = docs.columns
    own = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at, id_at = names.index("text"), names.index("doc_id")
    same = (F.col(f"c{id_at}").cast("long") == F.col("_doc")) & (_text_key(F.col(f"c{at}")) == F.col("_key"))
    joined = own.join(found, same, "left").select(*own.columns, "_ranges")
    out_names = [*own.columns, "_counts"]
    counts = F.struct(F.lit(0).alias("n_sentences"), F.lit(0).alias("n_removed"))
    schema = own.select("*", counts.alias("_counts")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("n_sentences", pa.int32()), ("n_removed", pa.int32())])
        for batch in batches:
            column = batch.column(at)
            ends = pc.match_substring_regex(column, r"(?:[.!?]\s+|\n\s*)$").fill_null(False).to_numpy(zero_copy_only=False)
            n = pc.count_substring_regex(column, _END.pattern).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            n = n + (~ends & (pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False) > 0))
            removed = np.zeros(len(n), np.int64)
            ranges = batch.column(len(names))
            hit = np.flatnonzero(ranges.is_valid().to_numpy(zero_copy_only=False)).tolist()
            if hit:
                texts = column.to_pylist()
                for k in hit:
                    texts[k], n[k], removed[k] = without(texts[k], ranges[k].as_py())
                column = pa.array(texts, column.type)
            columns = batch.columns[:len(names)]
            columns[at] = column
            counted = pa.StructArray.from_arrays([pa.array(n, pa.int32()), pa.array(removed, pa.int32())], fields=list(kind))
            yield pa.RecordBatch.from_arrays([*columns, counted], out_names)

    return joined.mapInArrow(run, schema).toDF(*names, "span_dedup")
