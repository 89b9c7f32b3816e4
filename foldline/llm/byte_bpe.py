"""Byte-level BPE encoding and decoding by corpus-level merge replay.

Each task holds a shard of the corpus as its distinct words. An inverted index
from merge rank to the word positions whose token pair that merge joins is
replayed in rank order over all words at once; a merge touches only the pairs
left and right of it. A word's tokens depend on that word alone, so shards give
the tokens that one replay over the whole corpus would.
"""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldline.llm import textbytes as tb
from foldline.llm.shared import documents

_NONE = np.int64(1 << 40)
#: A task's shard of the corpus ends with the text that takes it past so many bytes.
SHARD_BYTES = 1 << 22
#: A worker that remembers ids of words beyond half of it forgets them before it learns a shard's new ones.
CACHED_IDS = 3_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a ``.tiktoken`` file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class MergeReplay:
    """Encodes many words at once by the ranks of a byte-level BPE."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {(a << 32) | b: rank for token, rank in ranks.items() for i in range(1, len(token))
                 if (a := ranks.get(token[:i])) is not None and (b := ranks.get(token[i:])) is not None}
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        # a merge after which a neighbour pair of lower rank may appear is applied once a word at a time
        least = np.full(max(ranks.values()) + 1, _NONE)
        np.minimum.at(least, self.keys >> 32, self.values)
        np.minimum.at(least, self.keys & 0xFFFFFFFF, self.values)
        self.safe = least > np.arange(len(least))

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], _NONE)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and the n + 1 offsets. Words are not empty."""
        whole = [self.ranks.get(w) for w in words]
        counts = np.ones(len(words), np.int64)
        rest = [i for i, rank in enumerate(whole) if rank is None]
        ids, own = self._replay([words[i] for i in rest])
        counts[rest] = own
        offsets = np.concatenate([[0], np.cumsum(counts)])
        out = np.empty(offsets[-1], np.uint32)
        is_whole = np.ones(len(words), bool)
        is_whole[rest] = False
        out[offsets[:-1][is_whole]] = [rank for rank in whole if rank is not None]
        out[tb.ragged(offsets[:-1][rest], own)] = ids
        return out, offsets

    def _replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        length = np.array([len(w) for w in words], np.int64)
        first = np.cumsum(length) - length
        token = self.bytes[np.frombuffer(b"".join(words), np.uint8)]
        n = len(token)
        word = np.repeat(np.arange(len(words)), length)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[first + length - 1], before[first] = n, -1
        rank = np.full(n + 1, _NONE)
        open_ = np.flatnonzero(after < n)
        rank[open_] = self.pair_ranks(token[open_], token[open_ + 1])
        alive = np.ones(n, bool)
        token = np.append(token, 0)
        before = np.append(before, -1)

        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def post(at: np.ndarray) -> None:
            of = rank[at]
            at, of = at[of < _NONE], of[of < _NONE]
            if not len(at):
                return
            order = np.argsort(of, kind="stable")
            at, of = at[order], of[order]
            cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(at)]
            for k, a, b in zip(of[cuts[:-1]].tolist(), cuts, cuts[1:], strict=False):
                if k not in index:
                    index[k] = []
                    heapq.heappush(heap, k)
                index[k].append(at[a:b])

        post(open_)
        while heap:
            merge = heapq.heappop(heap)
            lists = index.pop(merge)
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            at = at[rank[at] == merge]
            if len(at) > 1:
                at = np.unique(at)
                if self.safe[merge]:
                    chained = np.append(False, at[1:] == after[at[:-1]])
                    if chained.any():  # overlapping pairs: every second of a chain, from its left
                        head = np.maximum.accumulate(np.where(chained, 0, np.arange(len(at))))
                        at = at[(np.arange(len(at)) - head) % 2 == 0]
                else:
                    once = np.append(True, word[at[1:]] != word[at[:-1]])
                    if not once.all():
                        index[merge] = [at[~once]]
                        heapq.heappush(heap, merge)
                        at = at[once]
            if not len(at):
                continue
            gone = after[at]
            then = after[gone]
            token[at] = merge
            after[at] = then
            before[then] = at  # position n is a spare one
            alive[gone] = False
            rank[gone] = _NONE
            rank[at] = np.where(then < n, self.pair_ranks(np.full(len(at), merge), token[then]), _NONE)
            left = before[at]
            left = left[left >= 0]
            rank[left] = self.pair_ranks(token[left], token[after[left]])
            post(np.concatenate([at, left]))
        kept = np.flatnonzero(alive)
        return token[kept], np.add.reduceat(alive.astype(np.int64), first)


class ShardEncoder:
    """Ids of whole texts; remembers a shard's chunks, and up to half of CACHED_IDS ids of earlier ones."""

    def __init__(self, path: str, pattern: str):
        self.replay = MergeReplay(read_ranks(path))
        # white space as in Unicode's property, which leaves out U+001C to U+001F
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.forget()

    def forget(self) -> None:
        self.known, self.start = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.length, self.ids = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def learn(self, hashes: np.ndarray, chunks: list[bytes]) -> None:
        """Encode new chunks; each match of the pattern in them is a word."""
        split = [[m.encode() for m in self.pattern.findall(c.decode())] for c in chunks]
        place: dict[bytes, int] = {}
        parts = np.array([place.setdefault(w, len(place)) for words in split for w in words], np.int64)
        ids, offsets = self.replay.encode(list(place))
        size = np.diff(offsets)[parts]
        number = np.array([len(words) for words in split], np.int64)
        total = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(number)])]
        start = np.concatenate([self.start, total[:-1] + len(self.ids)])
        length = np.concatenate([self.length, np.diff(total)])
        known = np.concatenate([self.known, hashes])
        self.ids = np.concatenate([self.ids, ids[tb.ragged(offsets[:-1][parts], size)]])
        order = np.argsort(known)
        self.known, self.start, self.length = known[order], start[order], length[order]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and each text's number of ids."""
        start = chunk_starts(data, offsets)
        end = np.append(start[1:], len(data))
        hashes, first, code = np.unique(tb.span_hashes(data, start, end), return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known, hashes), max(0, len(self.known) - 1))
        new = self.known[at] != hashes if len(self.known) else np.ones(len(hashes), bool)
        if new.any():
            if len(self.ids) > CACHED_IDS // 2:
                self.forget()
                new[:] = True  # what was known before too
            self.learn(hashes[new], tb.pieces(data, start[first[new]], end[first[new]]))
        at = np.searchsorted(self.known, hashes)[code] if len(hashes) else np.zeros(0, np.int64)
        size = self.length[at]
        total = np.concatenate([[0], np.cumsum(size)])
        return self.ids[tb.ragged(self.start[at], size)], np.diff(total[np.searchsorted(start, offsets)])


@functools.lru_cache(maxsize=2)
def shard_encoder(path: str, pattern: str) -> ShardEncoder:
    """A worker's encoder, kept for its later tasks."""
    return ShardEncoder(path, pattern)


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where a run of white space and what follows it begins: no match of the pattern crosses such a place.

    A cut needs ASCII white space after something that isn't white space, so
    that the whole run, whatever its characters, stays with what follows it.
    """
    space = tb._SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = space[1:] & ~space[:-1]
    at = np.flatnonzero(cut[:-1])
    at = at[data[at - 1] >= 0x80]  # after U+0085, U+00A0, U+1680, U+2000-200A, 2028, 2029, 202F, 205F or U+3000 the run goes on
    if len(at):
        two = data[at - 2].astype(np.int64) << 8 | data[at - 1]
        three = data[np.maximum(at - 3, 0)].astype(np.int64) << 16 | two
        wide = [0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080]
        cut[at[np.isin(two, [0xC285, 0xC2A0]) | np.isin(three, wide)]] = False
    cut[offsets] = True
    return np.flatnonzero(cut[:-1])


@functools.lru_cache(maxsize=2)
def tokens_of(path: str) -> dict[int, bytes]:
    """Rank to token bytes, kept for a worker's later tasks."""
    return {rank: token for token, rank in read_ranks(path).items()}


Batches = Iterator[pa.RecordBatch]


def encoding(path: str, pattern: str) -> Callable[[Batches], Batches]:
    """(doc_id, text) batches to (doc_id, ids) batches, a shard at a time."""
    def run(batches: Batches) -> Batches:
        encoder = shard_encoder(path, pattern)
        for batch in batches:
            data, offsets = tb.flat(batch.column(1))
            for a, b in tb.blocks(offsets, SHARD_BYTES):
                at = offsets[a:b + 1]
                ids, counts = encoder.encode(data[at[0]:at[-1]], at - at[0])
                ends = np.concatenate([[0], np.cumsum(counts)]) * 4
                raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids.astype("<u4"))])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), raw.cast(pa.binary())], ["doc_id", "ids"])

    return run


def decoding(path: str) -> Callable[[Batches], Batches]:
    """(doc_id, ids) batches to (doc_id, ids, decoded) batches."""
    def run(batches: Batches) -> Batches:
        table = tokens_of(path)
        for batch in batches:
            out = [b"".join(map(table.__getitem__, np.frombuffer(x.as_buffer(), "<u4").tolist())) if x.is_valid else b"" for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["doc_id", "ids", "decoded"])

    return run


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids): each whole text's ids as little-endian unsigned 32-bit integers.

    ``path`` names a ``.tiktoken`` file that every executor can open,
    ``pattern`` the regular expression whose matches are encoded one by one.
    Null and empty texts have no ids; rows and ids of rows may repeat; other
    columns are ignored.
    """
    return documents(docs).mapInArrow(encoding(path, pattern), "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds ``decoded`` (the bytes that the ids stand for) to (doc_id, ids); null ids give no bytes."""
    return encoded.select("doc_id", "ids").mapInArrow(decoding(path), "doc_id long, ids binary, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, and SHA-256 of its ids and of the decoded bytes.

    Both steps run in one worker, so that a task holds one encoder.
    """
    there, back = encoding(path, pattern), decoding(path)
    both = documents(docs).mapInArrow(lambda batches: back(there(batches)), "doc_id long, ids binary, decoded binary")
    return both.select(
        "doc_id", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
