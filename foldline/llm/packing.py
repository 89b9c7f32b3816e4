"""Lexical retrieval packing: training sequences filled with the neighbours of a seed document.

Documents are tokenised once. Runs of ids that documents share tell which of
them are neighbours anywhere in the corpus (``neighbour_paths``); the table is
sorted so that neighbours follow each other, and dealt into shards in that
order. A shard has a BM25 inverted index over token ids, with document
frequencies and the average length of the whole corpus. A seed opens a sequence;
the unused documents of the shard that score best for it fill the rest.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from foldline.llm import textbytes as tb
from foldline.llm.shared import documents, written

#: Closes every document.
END = 2
#: A shard ends with the document that takes it past one of these.
SHARD_TOKENS, SHARD_DOCUMENTS = 2_000_000, 1000
K1, B = 1.2, 0.75
#: Of every ``SPREAD`` runs of ``RUN`` ids that follow each other, the one with the least hash is kept:
#: two documents that share ``RUN + SPREAD - 1`` ids in a row share a kept run.
RUN, SPREAD = 8, 64
#: Times that the way from a document to its neighbour is doubled; 3 give up to 8 steps.
DOUBLINGS = 3
#: Partitions hold this many shards, or more beyond ``PARTITIONS``.
SHARDS_EACH, PARTITIONS = 4, 20_000
#: Chunks of words that a worker remembers; beyond it, it starts anew.
CACHED_WORDS = 1_500_000
#: Short pieces of words, such as a comma, whose ids a worker remembers.
MARKS = 1 << 14
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: What the tokenizer takes for its special tokens wherever a text has it.
_SPECIAL = r"<\|(?:startoftext|endoftext)\|>"
_PLAIN = regex.compile("[!-~¡-įı-ɏ]*")  # U+0130 has no lower case of one character
#: Kinds of bytes: white space, letters and digits, marks but the apostrophe (it may open a piece such as 's), others.
_WHITE, _ALNUM, _MARK, _OTHER = 8, 1, 2, 16
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[0x21:0x7F] = _MARK
_KIND[[c for c in range(0x80) if chr(c).isalnum()]] = _ALNUM
_KIND[ord("'")] = _OTHER
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = _WHITE


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts, cut between a letter or digit and a mark.

    The tokenizer's pieces never cross such a bound, so a chunk's ids don't
    depend on its neighbours. Letters are those of ASCII and U+00C0 to U+00FF;
    words of others are cut less.
    """
    kind = _KIND[data]
    latin = np.flatnonzero(data[:-1] == 0xC3)
    latin = latin[(data[latin + 1] != 0x97) & (data[latin + 1] != 0xB7)]  # × and ÷ are no letters
    kind[latin] = kind[latin + 1] = _ALNUM
    cut = np.zeros(len(data) + 1, bool)
    np.equal(kind[1:] + kind[:-1], _ALNUM + _MARK, out=cut[1:-1])
    cut[offsets] = True
    solid = kind != _WHITE
    begin = solid.copy()
    begin[1:] &= ~solid[:-1] | cut[1:-1]
    stop = solid.copy()
    stop[:-1] &= ~solid[1:] | cut[1:-1]
    return np.flatnonzero(begin), np.flatnonzero(stop) + 1


class WordEncoder:
    """Ids of whole texts by a tokenizer whose words never cross ASCII white space and ignore letter case."""

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)  # as it is, for texts with special tokens
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.width = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: byte_level.pre_tokenize_str(chr(c))[0][0] for c in range(0x21, 0x250)}  # those of ASCII are themselves
        self.model = self.tokenizer.model
        self.marks: dict[str, list[int]] = {}
        self.forget()

    def forget(self) -> None:
        """No chunk is known: ``slot`` of a hash in ``known`` (sorted) tells its bounds in ``ids``."""
        self.known, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.bounds, self.ids = np.zeros(1, np.int64), np.zeros(0, self.width)

    def word(self, word: str) -> list[int]:
        plain = word.isascii()
        if plain and word.isalpha():
            return [t.id for t in self.model.tokenize(word.lower())]
        if not _PLAIN.fullmatch(word):
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        if plain:
            pieces = _PIECES.findall(word.lower())
        else:
            word = unicodedata.normalize("NFC", word).lower()
            pieces = [x.translate(self.letters) for x in ([word] if word.isalpha() else _PIECES.findall(word))]
        out: list[int] = []
        for piece in pieces:
            ids = self.marks.get(piece)
            if ids is None:
                ids = [t.id for t in self.model.tokenize(piece)]
                if len(piece) < 3 and len(self.marks) < MARKS:
                    self.marks[piece] = ids
            out += ids
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (in lower case) one after another, and each text's number of ids."""
        start, end = chunks(data, offsets)
        coded = pa.array(tb.span_hashes(data, start, end)).dictionary_encode()  # hashed, not sorted
        hashes, code = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        if len(self.known) + len(hashes) > CACHED_WORDS:
            self.forget()
        order = np.argsort(hashes)
        hashes = hashes[order]
        at = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != hashes[inside]
        slot = np.empty(len(hashes), np.int64)  # in the order of ``code``
        slot[order[~new]] = self.slot[at[~new]]
        if new.any():
            slot[order[new]] = added = len(self.known) + np.arange(new.sum())
            first = np.empty(len(hashes), np.int64)
            first[code[::-1]] = np.arange(len(code))[::-1]
            first = first[order[new]]
            made: list[int] = []
            ends: list[int] = []
            for w in tb.pieces(data, start[first], end[first]):
                made += self.word(w.decode())
                ends.append(len(made))
            self.bounds = np.concatenate([self.bounds, len(self.ids) + np.array(ends, np.int64)])
            self.ids = np.concatenate([self.ids, np.array(made, self.width)])
            self.known, self.slot = np.insert(self.known, at[new], hashes[new]), np.insert(self.slot, at[new], added)
        begin = self.bounds[slot]
        size = (self.bounds[slot + 1] - begin)[code]
        total = np.concatenate([[0], np.cumsum(size)])
        return self.ids[tb.ragged(begin[code], size)], np.diff(total[np.searchsorted(start, offsets)])


@functools.lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """A worker's encoder, kept for its later tasks."""
    return WordEncoder(path)


def least_runs(ids: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    """Distinct hashes of the runs that each document keeps; those under ``RUN`` ids have none.

    ``ends`` are the documents' bounds in ``ids``, from 0.
    """
    size = np.diff(ends)
    run = tb.mix(ids.astype(np.uint64) + np.uint64(1))
    step = 1
    while step < RUN:  # hashes of runs of 2, 4, ... ids
        run = run[:max(0, len(run) - step)] * np.uint64(0x9E3779B97F4A7C15 + 2 * step) + run[step:]
        step *= 2
    run = tb.mix(run)
    least, step = run, 1
    while step < SPREAD:
        least = np.minimum(least[:max(0, len(least) - step)], least[step:])
        step *= 2
    begin = np.flatnonzero(size >= RUN + SPREAD - 1)
    windows = size[begin] - (RUN + SPREAD - 2)
    found = least[tb.ragged(ends[begin], windows)]
    row = np.repeat(begin, windows)
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (row[1:] != row[:-1])
    short = np.flatnonzero((size >= RUN) & (size < RUN + SPREAD - 1))
    value = np.concatenate([found[new], np.array([run[ends[k]:ends[k + 1] - RUN + 1].min() for k in short.tolist()], np.uint64)])
    row = np.concatenate([row[new], short])
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    once = np.ones(len(value), bool)
    once[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    offsets = np.searchsorted(row[once], np.arange(len(ends))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(value[once].view(np.int64)))


def tokenize(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, runs): ids of every whole text, without special tokens, then END, as little-endian unsigned integers.

    They have 16 bits if the vocabulary of the tokenizer file ``path`` has room
    in that, else 32. Null and empty texts have END alone. ``runs`` are the
    hashes of ``least_runs``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        for batch in batches:
            data, offsets = tb.flat(batch.column(1), lower=True)
            for a, b in tb.blocks(offsets):
                at = offsets[a:b + 1]
                ids, counts = encoder.encode(data[at[0]:at[-1]], at - at[0])
                special = np.flatnonzero(pc.match_substring_regex(batch.column(1).slice(a, b - a), _SPECIAL, ignore_case=True).fill_null(False).to_numpy(zero_copy_only=False))
                if len(special):
                    parts = np.split(ids, np.cumsum(counts)[:-1])
                    for k in special.tolist():
                        parts[k] = np.array(encoder.whole.encode(batch.column(1)[a + k].as_py(), add_special_tokens=False).ids, encoder.width)
                    ids, counts = np.concatenate(parts), np.array([len(x) for x in parts])
                ids = np.insert(ids, np.cumsum(counts), encoder.width(END))
                ends = np.concatenate([[0], np.cumsum(counts + 1)]) * ids.itemsize
                raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), raw.cast(pa.binary()), least_runs(ids, ends // ids.itemsize)],
                                                 ["doc_id", "ids", "runs"])

    return documents(docs).mapInArrow(run, "doc_id long, ids binary, runs array<long>")


def neighbour_paths(tokens: DataFrame, documents_: int) -> DataFrame:
    """(key, path): the way to each document that shares a run with another one, from its neighbours' neighbours.

    A run that several documents keep votes, with its inverse document
    frequency, for the one with the least key; the most voted for is a
    document's parent. The path holds up to ``2 ** DOUBLINGS`` ancestors, then the
    key, so that paths in order put a document's descendants behind it. A run
    that very many documents share is one row for each of them, counted map-side
    and joined to a single row, which AQE splits.
    """
    runs = tokens.select("key", F.explode("runs").alias("run"))
    shared = runs.groupBy("run").agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1")
    weight = F.round(1024 * F.log2(F.lit(documents_ + 1.0) / F.col("n"))).cast("long")
    votes = runs.join(shared, "run").groupBy("key", "first").agg(F.sum(weight).alias("votes"))
    parent = votes.groupBy("key").agg(F.max_by("first", F.struct("votes", "first")).alias("parent"))
    paths = written(parent.select("key", F.when(F.col("parent") == F.col("key"), F.array("key")).otherwise(F.array("parent", "key")).alias("path")), "paths")
    for _ in range(DOUBLINGS):
        above = paths.select(F.col("key").alias("head"), F.col("path").alias("above"))
        longer = paths.withColumn("head", F.col("path")[0]).join(above, "head")
        paths = written(longer.select("key", F.concat("above", F.slice("path", 2, 1 << 20)).alias("path")), "paths")
    return paths


def in_neighbourhoods(tokens: DataFrame, documents_: int, total: int) -> DataFrame:
    """(doc_id, ids) in partitions of a few shards, neighbours behind each other; documents without one as they were read.

    Keys are row numbers, so a task's share of the paths is a small part of its share of the ids: it is
    hashed, and the ids aren't sorted by key first.
    """
    shards = max(total / SHARD_TOKENS, documents_ / SHARD_DOCUMENTS)
    placed = tokens.select("doc_id", "ids", "key").join(neighbour_paths(tokens, documents_).hint("shuffle_hash"), "key", "left")
    placed = placed.withColumn("path", F.coalesce("path", F.array("key")))
    by = F.col("path"), F.col("doc_id")
    return placed.repartitionByRange(min(PARTITIONS, int(shards / SHARDS_EACH) + 1), *by).sortWithinPartitions(*by).select("doc_id", "ids")


def corpus_statistics(tokens: DataFrame, width: type, vocabulary: int) -> tuple[np.ndarray, int, int]:
    """Document frequency of every token id, the number of documents and of ids, over all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, last = np.zeros(vocabulary + 2, np.int64), np.zeros(vocabulary, np.int64)
        for batch in batches:
            for x in batch.column(0):
                ids = np.frombuffer(x.as_buffer(), width)
                place = np.arange(len(ids))
                last[ids] = place
                count[ids[last[ids] == place]] += 1  # each distinct id where it stands last
                count[-2:] += 1, len(ids)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(count[at])], ["id", "n"])

    out = np.zeros(vocabulary + 2, np.int64)
    for row in tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():  # a row an id of the vocabulary
        out[row["id"]] = row["n"]
    return out[:-2], int(out[-2]), int(out[-1])


class Bm25Shard:
    """Inverted index of a shard: the documents and weights of every token id in it."""

    def __init__(self, texts: list[np.ndarray], idf: np.ndarray, average: float):
        own = [np.unique(x, return_counts=True) for x in texts]
        self.terms = [t for t, _ in own]
        term = np.concatenate(self.terms)
        doc = np.repeat(np.arange(len(texts)), [len(t) for t in self.terms])
        often = np.concatenate([c for _, c in own]).astype(np.float64)
        size = np.array([len(x) for x in texts])[doc]
        weight = idf[term] * often * (K1 + 1) / (often + K1 * (1 - B + B * size / average))
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        self.ids, self.first = np.unique(term[order], return_index=True)
        self.size = np.diff(np.append(self.first, len(term)))

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document of the shard for the seed's distinct ids."""
        at = np.searchsorted(self.ids, self.terms[seed])
        postings = tb.ragged(self.first[at], self.size[at])
        return np.bincount(self.doc[postings], self.weight[postings], len(self.terms))


def pack_shard(texts: list[np.ndarray], index: Bm25Shard, window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length); all are full but the last ones, which have power-of-two lengths.

    A document that outgrows its sequence opens the next one as its seed.
    """
    unused = np.ones(len(texts), bool)
    sequences: list[list[tuple[int, int, int]]] = []
    pieces: list[tuple[int, int, int]] = []
    space, upcoming, rest = window, 0, None
    while True:
        if rest is None:  # no document is begun: the next unused one is the seed
            while upcoming < len(texts) and not unused[upcoming]:
                upcoming += 1
            if upcoming == len(texts):
                break
            unused[upcoming], rest = False, (upcoming, 0)
        seed, scores = rest[0], None
        while space and rest is not None:
            doc, start = rest
            length = min(space, len(texts[doc]) - start)
            pieces.append((doc, start, length))
            space -= length
            rest = (doc, start + length) if start + length < len(texts[doc]) else None
            if space and rest is None:
                if scores is None:
                    scores = np.where(unused, index.scores(seed), -1.0)
                best = int(scores.argmax())
                if scores[best] >= 0:
                    unused[best], scores[best], rest = False, -1.0, (best, 0)
        if not space:
            sequences.append(pieces)
            pieces, space = [], window
    left = window - space
    for power in (1 << k for k in range(left.bit_length() - 1, -1, -1)):
        if left & power:  # what fills no window is cut into sequences that need no padding
            own, need = [], power
            while need:
                doc, start, length = pieces[0]
                take = min(need, length)
                own.append((doc, start, take))
                pieces[0] = (doc, start + take, length - take)
                need -= take
                if take == length:
                    pieces.pop(0)
            sequences.append(own)
    return sequences


def pack(docs: DataFrame, path: str, window: int = 4096) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian unsigned 32-bit), shard.

    Every id of every document, END after each, lies in exactly one piece;
    pieces follow each other in a sequence from offset 0 without gaps. Null
    and empty texts are END alone; rows that repeat are packed each; an empty
    table has no pieces. Of equal BM25 scores the first document of the shard wins.
    Sequence and shard ids are the task's number and a counter. A document has one
    place in the order, so of two groups of neighbours that share nothing else
    the one with more runs in common is near.
    """
    encoder = Tokenizer.from_file(path)
    vocabulary = encoder.get_vocab_size()
    width = np.uint16 if vocabulary <= 1 << 16 else np.uint32
    tokens = written(tokenize(docs, path).withColumn("key", F.monotonically_increasing_id()), "tokens", compression="zstd")
    often, documents_, total = corpus_statistics(tokens, width, vocabulary)
    idf = np.log1p((documents_ - often + 0.5) / (often + 0.5))
    average = total / max(1, documents_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made, shard = TaskContext.get().partitionId() << 32, 0, 0
        names: list[int] = []
        texts: list[np.ndarray] = []

        def done() -> Iterator[pa.RecordBatch]:
            nonlocal made, shard
            rows: list[tuple] = []
            for sequence in pack_shard(texts, Bm25Shard(texts, idf, average), window) if texts else []:
                offset = 0
                for doc, start, length in sequence:
                    rows.append((names[doc], start, length, len(texts[doc]), base + made, offset, texts[doc][start:start + length].astype("<u4").tobytes(), base + shard))
                    offset += length
                made += 1
            shard += 1
            types = [pa.int64()] * 6 + [pa.binary(), pa.int64()]
            for a in range(0, len(rows), 500):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[a:a + 500], strict=True), types, strict=True)],
                                                 ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids", "shard"])
            names.clear(), texts.clear()

        held = 0
        for batch in batches:
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                names.append(name)
                texts.append(np.frombuffer(ids.as_py(), width))
                held += len(texts[-1])
                if held >= SHARD_TOKENS or len(texts) >= SHARD_DOCUMENTS:
                    yield from done()
                    held = 0
        yield from done()

    ordered = in_neighbourhoods(tokens, documents_, total)
    return ordered.mapInArrow(run, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary, shard long")


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
