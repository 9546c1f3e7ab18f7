import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from skyops.llm import simhash
from skyops.llm.components import components


def fingerprint(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[i : i + n]) for i in range(len(words) - n + 1)} or ({" ".join(words)} if words else set())


def similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def classes(items, linked):
    parent = {i: i for i in items}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in items:
        for b in items:
            if a < b and linked(a, b):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: root(i) for i in items}


def texts():
    rng = random.Random(3)
    vocabulary = [f"W{i}é" for i in range(40)]
    out = {}
    for i in range(120):
        kind = rng.random()
        if i and kind < 0.3:
            words = (out[rng.randrange(i)] or "").split(" ")
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
            out[i] = " ".join(words)
        elif i and kind < 0.4:
            out[i] = out[rng.randrange(i)]
        else:
            out[i] = " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 2, 3, 8, 60, 400])))
    out[120], out[121], out[122] = None, "\t\n", "one\x0btwo  three\x1cfour"
    return out


@pytest.mark.parametrize(("n", "max_bits", "bucket"), [(3, 2, 64), (3, 2, 1), (5, 1, 64), (5, 1, 1), (3, 0, 64)])
def test_against_all_pairs(spark, n, max_bits, bucket):
    rows = texts()
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows.items()], "doc_id long, text string, fp string")
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs, n, max_bits, bucket).collect()}
    prints = {i: fingerprint(t, n) for i, t in rows.items()}
    want = classes(rows, lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= max_bits)
    assert got == {i: (prints[i], want[i]) for i in rows}


def test_dense_fingerprints(spark):
    """Many values within few bits of each other: large buckets, long chains."""
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(6)]
    values = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) for b in base for _ in range(60)}
    values = {v - (1 << 64) if v >> 63 else v for v in (x % (1 << 64) for x in values)}
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    want = classes(sorted(values), lambda a, b: bin((a ^ b) % (1 << 64)).count("1") <= 2)
    for bucket in (1, 8, 1000):
        got = {r.node: r.component for r in components(simhash.linked(fps, 2, bucket), "a", "b").collect()}
        assert {v: got.get(v, v) for v in values} == want


def test_similar_texts(spark):
    """Near copies from 0.5 to 1: none below 0.8 are linked, and those above are found."""
    rng = random.Random(9)
    rows = {}
    for family in range(25):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([60, 150, 400]))]
        rows[len(rows)] = " ".join(words)
        for _ in range(5):
            copy = list(words)
            for _ in range(rng.randrange(1 + len(copy) // 40)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(5000)}"
            rows[len(rows)] = " ".join(copy)
    start = len(rows)
    rows |= {start: None, start + 1: " ", start + 2: "one two", start + 3: "One\ttwo", start + 4: "one three"}
    sets = {i: shingles(t, 5) for i, t in rows.items()}
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows.items()], "doc_id long, text string, fp int").repartition(4)
    got = {r.doc_id: r.component_id for r in simhash.similar_duplicates(docs).collect()}
    assert got == classes(rows, lambda a, b: similarity(sets[a], sets[b]) >= 0.8)
    assert simhash.similar_duplicates(docs.limit(0)).collect() == []
    odd = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (4, "q r s t u v"), (None, "x")], "doc_id long, text string")
    assert sorted(str(r.component_id) for r in simhash.similar_duplicates(odd).collect()) == ["4", "4", "4", "None"]


def edited_family(seed, copies, words, edits, shared=0):
    """Copies of one text, each edited on its own; with ``shared`` words in front that are never edited."""
    rng = random.Random(seed)
    text = [f"w{rng.randrange(5000)}" for _ in range(words)]
    for _ in range(copies):
        copy = list(text)
        for _ in range(edits):
            copy[rng.randrange(shared, words)] = f"x{rng.randrange(10**6)}"
        yield " ".join(copy)


@pytest.mark.parametrize(("few_pairs", "block"), [(simhash.FEW_PAIRS, simhash.BLOCK), (0, 7)])
def test_independent_edits(spark, few_pairs, block):
    """Copies that are similar to some others but seldom to the first: the components of all pairs."""
    families = [edited_family(1, 150, 176, 2), edited_family(2, 100, 255, 3), edited_family(3, 100, 160, 2, 100)]
    rows = dict(enumerate(t for family in families for t in family))
    sets = {i: shingles(t, 5) for i, t in rows.items()}
    want = classes(rows, lambda a, b: similarity(sets[a], sets[b]) >= 0.8)
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in simhash.similar_duplicates(docs, few_pairs=few_pairs, block=block).collect()}
    assert len(set(want.values())) < len(rows) - 100 and got == want


def hashes(text):
    return np.unique(np.array([xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(text, 5)], np.uint64))


def test_sketches_of_long_sets(spark):
    """Sketches grow with their sets and fold to one another: they never differ in more bits than sets do in hashes, and long texts
    that have little in common are ruled out by them alone."""
    rng = np.random.default_rng(5)
    pool = rng.integers(-(2**63), 2**63, 40_000, dtype=np.int64)
    rows = []
    for x, y, both in [(10, 12, 8), (1000, 1100, 950), (1020, 1030, 1015), (2000, 2100, 1900), (900, 9000, 850), (5000, 5200, 100), (17_000, 16_000, 9000)]:
        x, y = pool[:x], np.concatenate((pool[:both], pool[20_000 : 20_000 + y - both]))
        rows.append((len(np.setxor1d(x, y)), len(x) + len(y), simhash._parities(x).tolist(), simhash._parities(y).tolist()))
    frame = spark.createDataFrame(rows, "differ int, total int, a array<long>, b array<long>")
    got = frame.select("*", simhash._parity_difference(F.col("a"), F.col("b")).alias("bits")).collect()
    assert all(r.bits <= r.differ for r in got) and got[0].bits >= got[0].differ - 2
    # Sizes too far apart, the fifth pair, are ruled out by themselves.
    assert [r.bits > r.total / 9 for r in got if r.total != 9900] == [r.differ > r.total / 9 for r in got if r.total != 9900]


def test_rounds_that_spare_few_pairs_end(spark, monkeypatch):
    """Rounds that join a pair of texts each but leave the groups as large as they were aren't gone through one by one."""
    passage = " ".join(f"p{i}" for i in range(100))
    text = lambda k, e: f"{passage} " + " ".join(f"k{k}x{i}" for i in range(80)) + f" e{e}"
    rows = {2 * k + e: text(k, e) for k in range(8) for e in (0, 1)}
    turns = []

    def one_pair(apart, turn, min_similarity):
        turns.append(turn)
        keys = [xxhash.xxh64_intdigest(hashes(text((turn - 1) % 8, e)).tobytes(), 42) for e in (0, 1)]
        ends = sorted(int(np.uint64(x).view(np.int64)) for x in keys)
        return spark.createDataFrame([ends], "a long, b long")

    monkeypatch.setattr(simhash, "_hub_pairs", one_pair)
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    found = simhash.similar_duplicates(docs, max_bits=0, bins=1, sample=64, few_pairs=0)
    assert {r.doc_id: r.component_id for r in found.collect()} == {i: i - i % 2 for i in rows}
    assert 1 <= len(turns) <= 2


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 1), (7, 7), (9, 8), (None, 4), (5, None), *[(100 + i, 101 + i) for i in range(60)], *[(500, 501 + i) for i in range(40)], (540, 20)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    want = {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, 20: 20} | {100 + i: 100 for i in range(61)} | {500 + i: 20 for i in range(41)}
    assert got == want


def test_ids_and_no_rows(spark):
    schema = "doc_id long, text string"
    docs = spark.createDataFrame([(None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (4, "zz yy xx ww vv"), (None, "q r s t")], schema)
    got = simhash.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in got) == [("4", "4"), ("4", "4"), ("4", "4"), ("None", "4"), ("None", "None")]
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_long_text(spark):
    text = " ".join(f"w{i % 977}" for i in range(600_000))
    docs = spark.createDataFrame([(1, text), (2, text + " end"), (3, "x" * 3_000_000)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3}
