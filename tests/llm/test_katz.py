import math
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from skyops.llm import katz

SCHEMA = "doc_id long, text string, held_out boolean, w string"
K = katz.MAX_DISCOUNTED


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), "\n"]


class Recursive:
    """The model as its formulas say, in dictionaries."""

    def __init__(self, texts):
        self.c, self.pair, self.h = Counter(), Counter(), Counter()
        for text in texts:
            own = tokens(text)
            self.c.update(own)
            self.pair.update(zip([" ", *own], own))
            self.h.update([" ", *own[:-1]])
        self.n = sum(self.c.values())
        self.d1, self.d2 = (katz.discounts([sum(v == r for v in x.values()) for r in range(1, K + 2)]) for x in (self.c, self.pair))
        self.follow = defaultdict(set)
        for h, w in self.pair:
            self.follow[h].add(w)
        self.unknown = 1 - sum(map(self.single, self.c))

    def single(self, w):
        c = self.c[w]
        return self.d1[c if c <= K else 0] * c / (self.n + 1) if c else self.unknown

    def seen(self, h, w):
        r = self.pair[h, w]
        return self.d2[r if r <= K else 0] * r / (self.h[h] + 1)

    def chance(self, h, w):
        if self.pair[h, w]:
            return self.seen(h, w)
        if not self.h[h]:
            return self.single(w)
        left = 1 - sum(self.seen(h, x) for x in self.follow[h])
        return left / (1 - sum(self.single(x) for x in self.follow[h])) * self.single(w)

    def score(self, text):
        own = tokens(text)
        return sum(math.log10(self.chance(h, w)) for h, w in zip([" ", *own], own))


def texts(n=150):
    rng = random.Random(1)
    vocabulary = [f"W{int(rng.paretovariate(0.7))}" for _ in range(400)] + ["the"] * 200
    out = {i: " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60))) for i in range(n)}
    return out | {n: None, n + 1: "", n + 2: " \x0bTheé the\x1cx\n"}


def test_chances_sum_to_one():
    model = Recursive(list(texts().values())[:60])
    for h in [" ", "the", "w1", "never seen", *list(model.h)[:20]]:
        assert sum(model.chance(h, w) for w in model.c) + model.chance(h, "never seen") == pytest.approx(1, abs=1e-9)


@pytest.mark.parametrize(("at_once", "hot_share"), [(katz.TOKENS, katz.HOT_SHARE), (300, 1 / 20), (100, 2.0)])
def test_scores(spark, at_once, hot_share):
    rows = texts()
    held = lambda i: i % 4 == 1
    docs = spark.createDataFrame([(i, t, i % 2 == 0, "x") for i, t in rows.items()], SCHEMA).repartition(4)
    got = katz.katz_scores(docs, F.col("doc_id") % 4 == 1, at_once, hot_share).collect()
    assert sorted(r.doc_id for r in got) == sorted(rows)
    model = Recursive([t for i, t in rows.items() if not held(i)])
    for r in got:
        own = tokens(rows[r.doc_id])
        base = sum(math.log10((model.c[w] + 1) / (model.n + len(model.c) + 1)) for w in own)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(own), sum(model.c[w] > 0 for w in own), model.n)
        assert r.base_score == pytest.approx(base, rel=1e-7, abs=1e-5)
        assert r.score == pytest.approx(model.score(rows[r.doc_id]), rel=1e-7, abs=1e-5)


def test_repeats_nulls_and_nothing_to_learn(spark):
    rows = [(1, "a b", False, ""), (1, "a b", False, ""), (None, "a c", True, ""), (None, None, None, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted(katz.katz_scores(docs, F.col("held_out")).collect(), key=str)
    model = Recursive(["a b", "a b", None])
    want = sorted((i, bool(h), model.score(t)) for i, t, h, _ in rows if i)
    assert sorted((r.doc_id, r.held_out, pytest.approx(r.score, abs=1e-5)) for r in got if r.doc_id) == want
    assert [r.n_tokens for r in got if r.doc_id is None and r.held_out] == [3]
    alone = katz.katz_scores(docs, F.lit(True)).collect()
    assert len(alone) == 4 and all((r.train_tokens, r.n_known, r.base_score, r.score) == (0, 0, 0, 0) for r in alone)
    assert katz.katz_scores(docs.limit(0), F.col("held_out")).collect() == []


def test_packing():
    columns = [np.array([], np.uint64), np.array([0, 0]), np.array([1, 2**64 - 1, 255], np.uint64), np.arange(1000) * 65536]
    for a, b in zip(columns, katz.unpack(katz.pack(*columns))):
        assert a.tolist() == b.tolist()


def test_a_bucket_leaves_in_small_rows_and_batches(monkeypatch):
    """However many tokens of a batch belong to one bucket, no row and no batch that crosses to Spark is large."""
    rng = np.random.default_rng(1)
    monkeypatch.setattr(katz, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda self: 0})())}))
    text = [" ".join(map(str, rng.integers(0, 1 << 60, 100_000))) for _ in range(12)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(12)), "text": text, "held_out": [False] * 12})
    model = katz.Unigrams(1_200_012, 1_200_001, (1_200_000, 0, 0, 0, 0, 0), np.array([katz._START], np.uint64), np.array([0]), katz.TOKENS)
    sent = list(katz._send(model)(iter([batch])))
    sizes = [len(b) for part in sent for b in part.column("blob").to_pylist()]
    assert max(sizes) < 1 << 19 and max(part.nbytes for part in sent) < 6 * 1024 * 1024
    table = pa.Table.from_batches(sent).filter(pc.equal(pc.field("family"), 1))
    tracemalloc.start()
    made = katz._count(model)((pa.scalar(1), pa.scalar(0)), table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    blobs = dict(zip(made.column("kind").to_pylist(), made.column("totals").to_pylist()))
    assert blobs["counts"][0] == 1_200_012 and peak < 280 * 1_200_012
    assert max(map(len, made.column("blob").to_pylist())) < 1 << 20


def test_better_than_single_tokens_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    scored = katz.katz_scores(docs, F.col("doc_id") % 5 == 0).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert scored[0] > scored[1]
