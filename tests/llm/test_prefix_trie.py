"""Prefix trie against brute force on small tables with odd rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from foldline.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, n_convs long, node string"
ODD = [(None, 0, "user", "no id"), (7, None, None, None), (7, 1, "user", None), (7, 1, "user", "x"), (8, 3, None, "É" * 30), (40, 0, "user", ""), (-3, 0, "user", "minus")]


def brute(rows, family=5, heads=9):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0), role, digest, text))
    turns = {c: [(x[1], x[3]) for x in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % heads
        first = c - (abs(c) % family) * (1 if c >= 0 else -1)
        line = tuple(turns.get(first, [])[:h] + turns[c][h:])
        for d in range(len(line) + 1):
            members[line[:d]].append(c)
        ends[line].append(c)
    out = []
    for node in members:
        below = [x for x in members if x[:len(node)] == node]
        child = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(len(y) == len(x) + 1 and y[:len(x)] == x for y in below)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x)
        out.append((members[node][0], len(node), members[node[:-1]][0] if node else None, len(members[node]), len(child), len(leaves), saved,
                    hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest()))
    return sorted(out, key=str)


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, "n") for r in rows], SCHEMA).repartition(3)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("limit", [1, 7, 40, 1 << 16])
def test_trie(spark, limit):
    rng = random.Random(limit)
    rows = list(ODD)
    for c in range(45):
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "bb", "cé"])) for t in range(rng.randint(0, 12))]
    for c in range(100, 130):  # one conversation, many times
        rows += [(c, t, "user", f"same {t}") for t in range(10)]
    rows += [(131, t, "user", f"same {t}") for t in range(14)] + [(135, t, "user", "long") for t in range(300)]
    rows += rows[20:30]
    assert rows_of(prefix_trie.prefix_trie(frame_of(spark, rows), limit=limit)) == brute(rows)


def test_empty_and_turnless(spark):
    assert prefix_trie.prefix_trie(frame_of(spark, [])).count() == 0
    rows = [(c, 0, "user", "only") for c in range(1, 9)]  # no first of a family: their first h turns are none
    assert rows_of(prefix_trie.prefix_trie(frame_of(spark, rows), limit=3)) == brute(rows)


def test_find_close():
    rng = random.Random(3)
    for n in (1, 2, 50, 3000):
        bits, depth, opened = [True], 1, 1
        while opened < n or depth > 1:
            up = opened < n and (depth == 1 or rng.random() < 0.55)
            bits.append(up)
            depth, opened = depth + (1 if up else -1), opened + up
        bits.append(False)
        stack, close = [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                close[stack.pop()] = i
        at = np.flatnonzero(bits)
        assert prefix_trie.BalancedParentheses(np.array(bits)).find_close(at).tolist() == [close[i] for i in at.tolist()]
