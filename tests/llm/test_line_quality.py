import random
import re
import tracemalloc
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from skyops.llm import quality

SCHEMA = "doc_id long, text string, kept string, quality int"


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def texts():
    rng = random.Random(6)
    out = {}
    for i in range(200):
        vocabulary = [f"{rng.choice('aÉ#*$|<')}{j}" for j in range(rng.choice([3, 10, 500]))]
        lines = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(14))) for _ in range(rng.randrange(12))]
        out[i] = rng.choice(["\n", "\n\n", "\r\n", " \n\t"]).join(lines + rng.choices(lines, k=2) if lines else [])
    return out | {200: None, 201: "", 202: " \n ", 203: "w" * 200_000, 204: "a b c " * 50_000, 205: "x\x1cy z"}


def test_counts(spark):
    rows = texts()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows.items()] + [(None, "a", "", 0), (1, rows[1], "", 0)], SCHEMA)
    got = quality.measured(docs, quality.ALL_CONTENT).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        if r.doc_id is not None:
            want = counts(rows[r.doc_id])
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
            assert r.kept == (not want[-1])
    kept = quality.keep_good(docs, quality.ALL_CONTENT)
    assert kept.columns == docs.columns
    assert sorted(x.doc_id for x in kept.collect()) == sorted(r.doc_id for r in got if r.kept)
    assert quality.measured(docs.limit(0), quality.ALL_CONTENT).collect() == []


def test_best_path():
    rng = np.random.default_rng(1)
    for _ in range(60):
        model = quality.LineModel(rng.normal(size=4), rng.normal(size=(2, 2)))
        features = rng.integers(0, 2, (rng.integers(1, 7), 4))
        gain = features @ model.lines

        def score(path):
            return sum(g for g, s in zip(gain, path) if s) + sum(model.moves[a, b] for a, b in zip(path, path[1:]))

        best = max(score(p) for p in product((0, 1), repeat=len(features)))
        assert score(quality.content_lines(features, model).astype(int).tolist()) == pytest.approx(best)


def test_fit_follows_the_likelihood():
    """The fitted chain is at a maximum of the penalised likelihood, worked out over all label sequences."""
    rng = np.random.default_rng(2)
    texts_ = [rng.integers(0, 2, (rng.integers(1, 6), 3)).astype(float) for _ in range(25)]
    labels = [rng.integers(0, 2, len(t)).astype(bool) for t in texts_]
    total = sum(map(len, texts_))

    def value(lines, moves):
        out = 0.0
        for x, y in zip(texts_, labels):
            def score(path):
                return sum(float(r @ lines) for r, s in zip(x, path) if s) + sum(moves[a, b] for a, b in zip(path, path[1:]))
            scores = [score(p) for p in product((0, 1), repeat=len(x))]
            out += score(y.astype(int).tolist()) - np.logaddexp.reduce(scores)
        return out / total - 0.005 * (lines @ lines + (moves * moves).sum())

    model = quality._ascend(texts_, labels, np.zeros(3), 600, 0.01)
    best = value(model.lines, model.moves)
    for _ in range(40):
        assert value(model.lines + rng.normal(size=3) * 0.05, model.moves + rng.normal(size=(2, 2)) * 0.05) <= best + 1e-6


def test_fit_holds_the_lines_there_are():
    """One long text among many short ones doesn't make the fit hold as many lines of each."""
    rng = np.random.default_rng(4)
    texts_ = [rng.integers(0, 2, (n, 15)).astype(np.uint8) for n in [200, *[2] * 3000]]
    tracemalloc.start()
    model = quality.fit_chain(texts_, rng.integers(0, 2, len(texts_)), steps=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.isfinite(model.lines).all() and peak < 16 * 1024 * 1024


def test_features():
    lines, starts, n_words, repeats, features = quality._lines(pa.array(["One two.\n\n## 12 % |\nOne two.", None, "END"]))
    assert lines.to_pylist() == ["One two.", "## 12 % |", "One two.", "END"] and starts.tolist() == [0, 3, 3, 4]
    assert n_words.tolist() == [2, 4, 2, 1] and repeats.tolist() == [False, False, True, False]
    named = [{f for f, on in zip(quality.FEATURES, row) if on} for row in features]
    assert named[0] == {"always", "1-2 words", "ends a sentence", "first line", "short words"} - ({"short words"} if 80 >= 70 else set())
    assert named[1] >= {"3-5 words", "symbols > 10 %", "digits > 15 %"} and named[3] >= {"upper case > 40 %", "first line", "last line"}


def test_held_out_labels(spark):
    """Fitted on one half of the labels: clean documents of the other half stay, bad ones go more often."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = quality.fit_lines(docs, labels.where("doc_id % 2 = 0"))
    rows = quality.measured(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").where("NOT base_failed").groupBy("quality").agg({"kept": "count", "content_share": "avg"}).collect()
    judged = quality.measured(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id")
    good = judged.where("quality = 1 AND NOT base_failed")
    assert len(rows) == 2 and good.where("kept").count() > 0.98 * good.count()
    bad = judged.where("quality = 0")
    assert bad.where("NOT kept").count() > 0.5 * bad.count()


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "a", "", 0)], SCHEMA)
    for rows in ([], [(1, 1)], [(None, 0), (1, None), (1, 1)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int")
        assert quality.fit_lines(docs, labels) is quality.ALL_CONTENT
