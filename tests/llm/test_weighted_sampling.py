import hashlib
import math
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
import xxhash

from skyops.llm import weighted_sampling as ws

SCHEMA = "doc_id long, text string, part string, kind string, fingerprint string"
MASK = (1 << 64) - 1


def mixed(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def plain_signature(text, samples):
    """Each sample's least term, drawn one by one."""
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    out = []
    for k in range(samples):
        best = (math.inf, 0)
        for word, weight in Counter(words).items():
            key = xxhash.xxh64_intdigest(word.encode(), 42)
            u = []
            for i in range(3):
                x = mixed((key + (3 * k + i) * 0x9E3779B97F4A7C15) & MASK)
                u += [((x >> 32) + 0.5) / 2**32, ((x & 0xFFFFFFFF) + 0.5) / 2**32]
            rate, rank = -math.log(u[0] * u[1]), -math.log(u[2] * u[3])
            level = math.floor(math.log(weight) / rate + u[4])
            name = mixed(key ^ mixed((level + (k << 32)) & MASK)) >> 32
            best = min(best, (math.log(rank) - rate * (level - u[4]) - rate, name % 65535 + 1))
        out.append(best[1])
    return out


def plain_rows(rows, samples):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, ws_key(r[1]))
    rows = sorted(rows, key=key)
    hexed = lambda s: "".join(f"{v:04x}" for v in s)
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        made = text[: len(text) - half] + after[:half]
        own, changed, other = (plain_signature(t, samples) for t in (text, made, after))
        share = lambda a, b: sum(x == y for x, y in zip(a, b)) / samples
        yield i, len(text), hashlib.sha256(made.encode()).hexdigest(), hexed(own), hexed(changed), share(own, changed), share(own, other)


def ws_key(text):
    value = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return value - (1 << 64) if value >> 63 else value


def random_texts(rng, n):
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "Ab", "AB", "x" * 300]
    pick = lambda: rng.choice([None, "", " \n ", " ".join(rng.choices(vocabulary, k=rng.randrange(1, 60)))])
    return [pick() for _ in range(n)]


@pytest.mark.parametrize("parts", [1, 7])
def test_against_plain_samples(spark, parts):
    rng = random.Random(5)
    texts = random_texts(rng, 50)
    rows = [(rng.choice([None, *range(-20, 30)]), t) for t in texts] + [(7, "same words here"), (7, "same words here"), (8, "w1 " * 30_000)]
    docs = spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA).repartition(parts)
    got = sorted(map(tuple, ws.compare_with_next(docs, 16).collect()), key=str)
    assert got == sorted(plain_rows(rows, 16), key=str)


def test_small_slices_and_many_ranges(spark, monkeypatch):
    """Rows that end a slice or a range meet the row after them all the same."""
    rng = random.Random(6)
    rows = [(i, t) for i, t in enumerate(random_texts(rng, 90))]
    docs = spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    try:
        for key, value in zip(before, ("17", "false", "3")):
            spark.conf.set(key, value)
        got = sorted(map(tuple, ws.compare_with_next(docs, 4).collect()), key=str)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert got == sorted(plain_rows(rows, 4), key=str)


def test_collision_rate_is_generalised_jaccard():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    samples = 3000
    for _ in range(5):
        a, b = (rng.gamma(1.0, 2.0, 60) * (rng.random(60) < 0.7) for _ in range(2))
        rows = [ws.signatures(keys[w > 0], w[w > 0], np.array([(w > 0).sum()]), samples) for w in (a, b)]
        wanted = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        assert abs(ws.likeness(*rows)[0] - wanted) < 4 * math.sqrt(wanted * (1 - wanted) / samples)


def test_terms_are_told_apart_at_the_cost_of_plain_sorts():
    """Finding the distinct pairs of term and weight takes a few sorts of numbers, not one of records."""
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 1 << 63, 50_000).astype(np.uint64)[rng.integers(0, 50_000, 600_000)]
    weights = rng.integers(1, 6, len(keys)).astype(float)

    def seconds(call):
        began = time.process_time()
        call()
        return time.process_time() - began

    plain = min(seconds(lambda: np.unique(keys, return_inverse=True)) for _ in range(3))
    whole = min(seconds(lambda: ws.signatures(keys, weights, np.full(600, 1000), 1)) for _ in range(3))
    assert whole < 8 * plain


def test_fingerprints_alone(spark):
    rows = [(1, "a b b"), (2, "A\tb  b"), (3, None), (4, ""), (None, "c")]
    got = {r.doc_id: r.fingerprint for r in ws.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()}
    assert got[1] == got[2] != got[None] and got[3] == got[4] == "0" * 32


@pytest.mark.parametrize("rows", [[], [(3, "only one here")], [(3, None)]])
def test_few_rows(spark, rows):
    got = ws.compare_with_next(spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA), 4).collect()
    assert [tuple(r) for r in got] == list(plain_rows(rows, 4))
