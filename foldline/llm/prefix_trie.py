"""Prefix trie of conversations: who shares which first turns, and what keeping a shared start once saves.

Conversations, as sequences of turn digests, are range-partitioned in
lexicographic order, so that every node's members are neighbours. A shard (a
bounded run of them) writes its trie as balanced parentheses. ``find_close``, over
blocks that keep their least excess, delimits every node's subtree; the rank of
leaf pairs ``()`` counts its leaves, and cumulative arrays along the preorder give
members and savings. Nodes on a path that two neighbouring shards share, the spine,
come out as partial sums and are merged by their prefix.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldline.llm.shared import Scratch, crc_bucket
from foldline.session import cut_lineage

#: Bytes of a turn's digest.
DIGEST = 16
#: Parentheses in a block of the excess index.
BLOCK = 64
#: Turns and conversations after which a shard ends; bounds a task's memory whatever its partition holds.
SHARD_TURNS = 1 << 16
_NONE = np.iinfo(np.int64).max
_NODES = ("spine boolean, node binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
          "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, first_end long, ends binary")
_SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")


class BalancedParentheses:
    """A trie in preorder, True for an opening parenthesis, with the least excess of every block and of pairs of blocks above."""

    def __init__(self, bits: np.ndarray):
        excess = np.cumsum(np.where(bits, 1, -1), dtype=np.int32)
        grid = np.full(-(-len(bits) // BLOCK) * BLOCK, np.iinfo(np.int32).max, np.int32)
        grid[:len(bits)] = excess
        self.bits, self.excess, self.grid = bits, excess, grid.reshape(-1, BLOCK)
        self.levels = [self.grid.min(1)]
        while len(self.levels[-1]) > 1:
            if len(self.levels[-1]) % 2:
                self.levels[-1] = np.append(self.levels[-1], np.iinfo(np.int32).max)
            self.levels.append(self.levels[-1].reshape(-1, 2).min(1))
        pair = bits.copy()
        pair[:-1] &= ~bits[1:]
        self.pairs = np.concatenate([[0], np.cumsum(pair)])

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """Positions of the parentheses that close those opened at ``at``."""
        parts = [self._find_close(at[i:i + (1 << 14)]) for i in range(0, len(at), 1 << 14)]
        return np.concatenate(parts) if parts else at

    def _first(self, block: np.ndarray, target: np.ndarray, after: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        hit = (self.grid[block] <= target[:, None]) & (np.arange(BLOCK) > np.reshape(after, (-1, 1)))
        return hit.any(1), block * BLOCK + hit.argmax(1)

    def _find_close(self, at: np.ndarray) -> np.ndarray:
        target = self.excess[at] - 1
        found, out = self._first(at // BLOCK, target, at % BLOCK)
        far = np.flatnonzero(~found)
        if not len(far):
            return out
        target, node = target[far], at[far] // BLOCK
        level = np.full(len(far), -1)
        for k, low in enumerate(self.levels[:-1]):  # climb until the right sibling dips low enough
            open_ = level < 0
            ends = open_ & (node % 2 == 0) & (low[np.minimum(node + 1, len(low) - 1)] <= target)
            node = np.where(ends, node + 1, np.where(open_, node // 2, node))
            level[ends] = k
        for k in range(len(self.levels) - 2, -1, -1):  # then descend to the leftmost block that does
            down = level > k
            left = np.where(down, 2 * node, 0)
            node = np.where(down, left + (self.levels[k][left] > target), node)
        out[far] = self._first(node, target, -1)[1]
        return out

    def leaf_pairs(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Leaf pairs that open in start..stop."""
        return self.pairs[stop] - self.pairs[start]


def _range_least(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Least value of every start..stop (not empty), from the least of all runs of a power of two."""
    out, runs, width = np.empty(len(start), values.dtype), values, 1
    level = np.frexp((stop - start).astype(float))[1] - 1
    for k in range(int(level.max(initial=0)) + 1):
        own = level == k
        out[own] = np.minimum(runs[start[own]], runs[stop[own] - width])
        runs = np.minimum(runs[:-width], runs[width:]) if len(runs) > width else runs
        width *= 2
    return out


def _common(a: bytes, b: bytes) -> int:
    """Turns that two sequences begin with in common."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // DIGEST
    return int((np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)).argmax()) // DIGEST


def _coded(ids: np.ndarray) -> bytes:
    return zlib.compress(np.diff(ids, prepend=0).astype("<i8").tobytes(), 1)


def _decoded(ends: bytes) -> str:
    return ",".join(map(str, np.cumsum(np.frombuffer(zlib.decompress(ends), "<i8")).tolist()))


def shard_nodes(keys: list[bytes], sizes: list[np.ndarray], ids: np.ndarray, before: int, after: int) -> dict[str, list]:
    """All nodes of one shard, as columns.

    ``keys`` ascend, and ``ids`` where keys are equal. ``before`` and ``after``
    are the turns in common with the conversation before and behind the shard, -1
    if there is none: nodes up there are the spine, and what they count is what
    this shard adds.
    """
    starts = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]]
    texts = [keys[i] for i in starts]
    depth = np.array([len(k) // DIGEST for k in texts])
    shared = np.array([0] + [_common(a, b) for a, b in zip(texts, texts[1:], strict=False)])
    opens, closes = depth - shared, np.concatenate([[0], depth[:-1] - shared[1:]])
    runs = np.stack([closes, opens], 1).ravel()
    bits = np.concatenate([[True], np.repeat(np.tile([False, True], len(texts)), runs), np.zeros(depth[-1] + 1, bool)])
    tree = BalancedParentheses(bits)
    at = np.flatnonzero(bits)
    close = tree.find_close(at)
    n = len(at)
    pre = np.arange(n)
    stop = pre + (close - at + 1) // 2
    end = np.cumsum(opens)  # the node that a sequence ends at

    parent, path = np.zeros(n, np.int64), [0]
    parent[1:] = pre[:-1]
    for first, low, high in zip((end - opens + 1).tolist(), shared.tolist(), depth.tolist(), strict=True):
        if high > low:
            parent[first] = path[low]
            path[low + 1:] = range(first, first + high - low)
    size = np.concatenate([[0], *(sizes[i][a:] for i, a in zip(starts, shared.tolist(), strict=True))]).astype(np.int64)

    owned = pre > before  # the first path is 0, 1, 2, ... in preorder; what it shares was counted by the shard before
    spine = ~owned
    spine[path[:after + 1]] = True
    count, least = np.zeros(n, np.int64), np.full(n, _NONE)
    count[end], least[end] = np.diff([*starts, len(keys)]), ids[starts]
    members = np.concatenate([[0], np.cumsum(count)])
    n_convs = members[stop] - members[pre]
    saved = np.concatenate([[0], np.cumsum((n_convs - owned) * size)])
    leaves = tree.leaf_pairs(at, close)
    if after == depth[-1]:  # the next shard goes on where this one's last conversation ends: no leaf yet
        leaves[path] -= 1
    conv = _range_least(least, pre, stop)
    up = conv[parent]

    key_of, digest = {}, {}  # a spine node's own name: depth and md5 of its turns
    for line, shared_path in ((texts[0], range(before + 1)), (texts[-1], path[:after + 1])):
        h = hashlib.md5(usedforsecurity=False)
        for d, node in enumerate(shared_path):
            key_of[node] = d.to_bytes(8, "big") + h.digest()
            h.update(line[d * DIGEST:(d + 1) * DIGEST])
    own_end = dict(zip(end.tolist(), zip(starts, [*starts[1:], len(keys)], strict=True), strict=True))
    empty = hashlib.sha256().hexdigest()
    for node, (a, b) in own_end.items():
        digest[node] = _coded(ids[a:b]) if spine[node] else hashlib.sha256(",".join(map(str, ids[a:b].tolist())).encode()).hexdigest()
    nodes = pre.tolist()
    shown = [None if p == 0 and k == 0 else key_of.get(p) for k, p in zip(nodes, parent.tolist(), strict=True)]
    return {
        "spine": spine.tolist(), "node": [key_of.get(k) for k in nodes], "parent": shown, "conv_id": conv.tolist(), "depth": (tree.excess[at] - 1).tolist(),
        "parent_conv_id": [None if not k or s else u for k, s, u in zip(nodes, shown, up.tolist(), strict=True)],
        "n_convs": n_convs.tolist(), "n_children": np.bincount(parent[1:][owned[1:]], minlength=n).tolist(), "n_leaves": leaves.tolist(),
        "saved_tokens": (saved[stop] - saved[pre]).tolist(),
        "ends_sha256": [None if s else digest.get(k, empty) for k, s in zip(nodes, spine.tolist(), strict=True)],
        "first_end": [int(ids[own_end[k][0]]) if s and k in own_end else None for k, s in zip(nodes, spine.tolist(), strict=True)],
        "ends": [digest.get(k) if s else None for k, s in zip(nodes, spine.tolist(), strict=True)],
    }


def _bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First and last sequence of a partition."""
    shard, first, last = None, None, None
    for batch in batches:
        if len(batch):
            shard = batch["shard"][0].as_py() if shard is None else shard
            first = batch["key"][0].as_py() if first is None else first
            last = batch["key"][len(batch) - 1].as_py()
    if shard is not None:
        yield pa.RecordBatch.from_pydict({"shard": [shard], "first": [first], "last": [last]}, pa.schema([("shard", pa.int32()), ("first", pa.binary()), ("last", pa.binary())]))


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns that the end of each partition has in common with the start of the next."""
    shard, last = -1, b""
    for batch in batches:
        for row in batch.to_pylist():
            if shard >= 0:
                yield pa.RecordBatch.from_pydict({"left": [shard], "right": [row["shard"]], "turns": [_common(last, row["first"])]},
                                                 pa.schema([("left", pa.int32()), ("right", pa.int32()), ("turns", pa.int64())]))
            shard, last = row["shard"], row["last"]


def _tries(before: dict[int, int], after: dict[int, int], limit: int):
    """The nodes of every shard of a sorted partition; a shard ends after ``limit`` turns and conversations."""
    import pyspark.sql.types as T
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = to_arrow_schema(T._parse_datatype_string(_NODES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[bytes] = []
        sizes: list[np.ndarray] = []
        ids: list[int] = []
        held, lead, shard = 0, None, None

        def trie(behind: int) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_pydict(shard_nodes(keys, sizes, np.array(ids, np.int64), lead, behind), schema)
            yield from table.to_batches(1 << 14)

        for batch in batches:
            length = batch["sizes"].flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(batch["sizes"].value_lengths().to_numpy(zero_copy_only=False))
            for key, stop, conv, number in zip(batch["key"].to_pylist(), ends.tolist(), batch["conv_id"].to_pylist(), batch["shard"].to_pylist(), strict=True):
                turns = len(key) // DIGEST
                if shard is None:
                    shard, lead = number, before.get(number, -1)
                elif held >= limit:
                    common = _common(keys[-1], key)
                    yield from trie(common)
                    keys, sizes, ids, held, lead = [], [], [], 0, common
                keys.append(key)
                sizes.append(length[stop - turns:stop])
                ids.append(conv)
                held += turns + 1
        if keys:
            yield from trie(after.get(shard, -1))
    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the partial rows of each spine node, which lie together, ends in ascending order."""
    names = ("node", "parent", "conv_id", "depth", *_SUMS, "ends_sha256")
    schema = pa.schema([("node", pa.binary()), ("parent", pa.binary()), *((k, pa.int64()) for k in names[2:-1]), ("ends_sha256", pa.string())])
    held, h = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({k: [v] for k, v in (held | {"ends_sha256": h.hexdigest()}).items()}, schema)

    for batch in batches:
        for part in batch.to_pylist():
            if held is None or held["node"] != part["node"]:
                if held is not None:
                    yield row()
                held, h, any_ = {k: part[k] for k in names[:-1]}, hashlib.sha256(), False
            else:
                held["conv_id"] = min(held["conv_id"], part["conv_id"])
                for k in _SUMS:
                    held[k] += part[k]
            if part["ends"] is not None:
                h.update(("," * any_ + _decoded(part["ends"])).encode())
                any_ = True
    if held is not None:
        yield row()


def branched(conversations: DataFrame, scratch: Scratch, family: int = 5, heads: int = 9) -> DataFrame:
    """(conv_id, key, sizes): each conversation begun by the first turns of its family's first one.

    Of conversation c - c % ``family`` the first h = crc32(c) % ``heads`` turns
    are taken (all if there are fewer), then c's own from h on. ``key`` has a
    128-bit digest for each turn, ``sizes`` the UTF-8 bytes of its text.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), digest.alias("digest"), F.octet_length(text).cast("long").alias("size"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t")).where(F.col("conv_id").isNotNull())
    turns = F.array_sort(F.collect_list("t"))
    own = rows.groupBy("conv_id").agg(turns.alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("turns"))
    own = scratch.write(own, "turns")
    head = own.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("first"), F.slice("turns", 1, heads - 1).alias("head"))
    h = crc_bucket(F.col("conv_id"), heads).cast("int")
    joined = own.withColumn("first", F.col("conv_id") - F.col("conv_id") % family).join(head, "first", "left")
    start = F.when(F.col("head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("head", F.lit(1), h))
    joined = joined.select("conv_id", F.concat(start, F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns"))
    return joined.select("conv_id", F.unhex(F.array_join(F.col("turns.digest"), "")).alias("key"), F.col("turns.size").alias("sizes"))


def trie(sequences: DataFrame, scratch: Scratch, limit: int = 0) -> DataFrame:
    """One row for each distinct prefix of ``sequences`` (conv_id, key, sizes), the empty one included.

    conv_id: the least member; depth; parent_conv_id: the parent's conv_id, null for
    the root; n_convs; n_children; n_leaves: childless nodes at or below; saved_tokens:
    over the subtree, (n_convs - 1) times the bytes of the node's last turn;
    ends_sha256: digest of the ids, ascending and joined by commas, of the sequences
    that end here. No sequences, no rows.

    Sequences of one text that recur any number of times spread over shards, since
    the id belongs to the sort key. The digest of the ids that end at one node is by
    its nature one pass over them: they come as compressed runs and stream through
    the merge of that node. The driver gets two numbers for each shard; range
    partitioning samples keys, 16 bytes a turn.
    """
    limit = limit or SHARD_TURNS
    total = sequences.agg(F.coalesce(F.sum(F.size("sizes") + 1), F.lit(0))).first()[0]
    shards = max(1, -(-total // limit))
    dealt = sequences.repartitionByRange(shards, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    dealt = cut_lineage(dealt.withColumn("shard", F.spark_partition_id()))
    edges = dealt.select("shard", "key").mapInArrow(_bounds, "shard int, first binary, last binary")
    near = edges.repartition(1).sortWithinPartitions("shard").mapInArrow(_neighbours, "left int, right int, turns long").collect()
    before, after = {x["right"]: x["turns"] for x in near}, {x["left"]: x["turns"] for x in near}
    nodes = scratch.write(dealt.mapInArrow(_tries(before, after, limit), _NODES), "nodes")

    parts = nodes.where("spine").select("node", "parent", "conv_id", "depth", *_SUMS, "first_end", "ends")
    merged = parts.repartition("node").sortWithinPartitions("node", "first_end").mapInArrow(
        _merged, "node binary, parent binary, conv_id long, depth long, " + ", ".join(f"{k} long" for k in _SUMS) + ", ends_sha256 string")
    spine = scratch.write(merged, "spine")
    above = spine.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", *_SUMS, "ends_sha256"]
    whole = nodes.where("NOT spine")
    inner = whole.where("parent IS NULL").select(*columns)
    below = whole.where("parent IS NOT NULL").drop("parent_conv_id").join(above, "parent").select(*columns)
    return inner.unionByName(below).unionByName(spine.join(above, "parent", "left").select(*columns))


def prefix_trie(conversations: DataFrame, family: int = 5, heads: int = 9, limit: int = 0) -> DataFrame:
    """The trie (see ``trie``) of all conversations, each begun as ``branched`` says.

    ``conversations`` has conv_id, turn, role and text; further columns count for
    nothing. Turns are ordered by turn, null first, then by role and digest; a null
    role or text is empty. Rows without a conv_id take no part, repeated rows are
    turns of their own, and an empty table gives no rows. One conversation's
    digests, 16 bytes a turn, are one row.
    """
    scratch = Scratch(conversations.sparkSession, "trie")
    found = trie(scratch.write(branched(conversations, scratch, family, heads), "sequences"), scratch, limit)
    return scratch.result(found, "trie")
