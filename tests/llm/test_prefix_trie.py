import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from skyops.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, depth string, x string, rank string, j string"


def plain_rebuilt(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in convs.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def plain_trie(convs):
    if not convs:
        return []
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, who in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(who) - 1) * (len(node[-1][1]) if node else 0)
    out = []
    for node, who in members.items():
        ends = sorted(c for c in who if len(convs[c]) == len(node))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out.append((min(who), len(node), parent, len(who), children[node], leaves[node], saved[node], digest))
    return sorted(out, key=str)


def check(spark, rows, segment, block, parts=5):
    turns = spark.createDataFrame([(*r, "", "", "", "") for r in rows], SCHEMA).repartition(parts)
    got = pt.prefix_trie(*pt.rebuilt(turns), segment, block)
    assert sorted(map(tuple, got.collect()), key=str) == plain_trie(plain_rebuilt(rows))


@pytest.mark.parametrize(("segment", "block"), [(64, 1 << 18), (2, 7)])
def test_against_a_plain_trie(spark, segment, block):
    rng = random.Random(segment)
    pick = lambda: (rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", None, "", "\U0001f9ff c"]))
    rows = []
    for conv in [*range(-5, 40), *range(100, 130), 250, 10**12, None]:
        rows += [(conv, rng.choice([None, *range(9)]), *pick()) for _ in range(rng.randrange(1, 12))]
    # Copies of one conversation of eleven turns, which end at one node, and a prefix of it.
    rows += [(conv, i, "user", f"t{i}") for conv in range(2000, 2060) for i in range(11)]
    rows += [(3000, i, "user", f"t{i}") for i in range(8)] + [(4000, 0, "user", "gone"), (4001, 0, "user", "gone"), (4001, 0, "user", "gone")]
    check(spark, rows, segment, block)


def test_long_conversations_that_part_late(spark):
    long = [(c, i, "user", f"turn {i}" if i < 9000 else f"{c}") for c in (0, 100) for i in range(9003)]
    got = pt.prefix_trie(*pt.rebuilt(spark.createDataFrame([(*r, "", "", "", "") for r in long], SCHEMA)))
    rows = {(r.conv_id, r.depth): r for r in got.collect()}
    shared = {c: plain_rebuilt(long)[c] for c in (0, 100)}
    same = next(d for d in range(9003) if shared[0][d] != shared[100][d])
    assert len(rows) == 1 + same + 2 * (9003 - same)
    lengths = [len(t) for _, t in shared[0][:same]]
    assert all(rows[0, d].saved_tokens == sum(lengths[max(d, 1) - 1 :]) and rows[0, d].n_leaves == 2 for d in range(same + 1))
    assert rows[0, same].n_children == 2 and rows[100, same + 1].parent_conv_id == 0


@pytest.mark.parametrize("rows", [[], [(7, None, None, None)], [(None, 1, "user", "x")], [(101, 0, "a", "b"), (102, 0, "a", "b")]])
def test_few_rows(spark, rows):
    check(spark, rows, 64, 1 << 18, 1)


def test_range_minima():
    rng = np.random.default_rng(2)
    for size in (0, 1, 2, 7, 64, 100):
        values = rng.integers(0, 6, size)
        table = pt.RangeMinimum(values)
        if size:
            low, high = (np.sort(rng.integers(0, size, (2, 50)), axis=0))
            assert table.between(low, high).tolist() == [values[a : b + 1].min() for a, b in zip(low, high)]
        start, least = rng.integers(0, size + 1, 50), rng.integers(1, 6, 50)
        for got_left, got_right, s, d in zip(table.reach_left(start, least), table.reach_right(start, least), start, least):
            left, right = s, s
            while left > 0 and values[left - 1] >= d:
                left -= 1
            while right < size and values[right] >= d:
                right += 1
            assert (got_left, got_right) == (left, right)
