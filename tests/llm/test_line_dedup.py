import random
import re

import pytest

from skyops.llm import line_dedup

SCHEMA = "doc_id long, text string, th string, n_lines int"


def words(line):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), line))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def by_all_pairs(rows, min_words, edit_words):
    """Kept lines of every (doc_id, text), in the order of doc_id; ids are distinct here."""
    seen, out = [], {}
    for doc_id, text in sorted(rows.items()):
        kept = []
        for line in (text or "").split("\n"):
            own = words(line)
            dropped = len(own) >= min_words and any(
                own == w or (len(own) >= edit_words and len(w) >= edit_words and distance(own, w) <= 1) for w in seen
            )
            if len(own) >= min_words:
                seen.append(own)
            if not dropped:
                kept.append(line)
        out[doc_id] = None if text is None else "\n".join(kept)
    return out


def texts(seed, n):
    rng = random.Random(seed)
    vocabulary = ["A", "bb", "Cé", "d.", "E"]
    lines, out = [], {}
    for i in range(n):
        own = []
        for _ in range(rng.randrange(7)):
            line = list(rng.choice(lines)) if lines and rng.random() < 0.6 else [rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 3, 4, 5, 6, 7, 11, 12, 13, 14]))]
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at, kind = rng.randrange(len(line) + 1), rng.randrange(3)
                line[at : at + (kind != 1)] = [] if kind == 0 else [rng.choice(vocabulary)]
            lines.append(line)
            own.append(rng.choice(["", " ", "\t"]) + rng.choice([" ", "  ", "\x0b"]).join(line) + rng.choice(["", "\r"]))
        out[i] = "\n".join(own)
    return out | {n: None, n + 1: "", n + 2: "\n\n"}


@pytest.mark.parametrize("seed", range(3))
def test_against_all_pairs(spark, seed):
    rows = texts(seed, 120)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows.items()], SCHEMA).repartition(5)
    got = line_dedup.dedup_lines(docs).collect()
    assert {r.doc_id: r.text for r in got} == by_all_pairs(rows, 1, 5)
    assert got[0].th == "x" and got[0].asDict().keys() == {"doc_id", "text", "th", "n_lines", "n_dropped"}
    for r in got:
        before = rows[r.doc_id]
        assert r.n_lines == (0 if before is None else before.count("\n") + 1)
        left = 0 if before is None else r.n_lines - r.n_dropped
        assert (r.text or "").count("\n") == max(0, left - 1)


def test_templates_share_a_hot_neighbourhood(spark):
    """Thousands of lines that differ in one word: linked to the first one only."""
    rows = [(i, f"this page has been read exactly n{i} times since we last counted all of them") for i in range(3000)]
    docs = spark.createDataFrame([(i, t, "", 0) for i, t in rows], SCHEMA)
    got = line_dedup.dedup_lines(docs)
    assert [r.doc_id for r in got.where("n_dropped = 0").collect()] == [0]


def test_long_lines(spark):
    long = [f"w{i % 701}" for i in range(60_000)]
    other = [*long[:30_000], *long[30_001:]]
    docs = spark.createDataFrame([(2, " ".join(other)), (1, " ".join(long)), (3, " ".join(long[:100]))], "doc_id long, text string")
    assert {r.doc_id: r.n_dropped for r in line_dedup.dedup_lines(docs).collect()} == {1: 0, 2: 1, 3: 0}


def test_repeated_rows_and_null_ids(spark):
    line = "one two three four five six"
    rows = [(3, line, "", 0), (3, line, "", 0), (None, "quite other " + line, "", 0), (4, "quite other " + line, "", 0), (3, "x\n" + line, "", 0)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    kept = sorted((str(r.doc_id), r.n_lines, r.n_dropped) for r in got)
    # The two equal rows are one document; of the three texts with id 3, one keeps the line.
    assert sorted(x[2] for x in kept if x[0] == "3") in ([0, 0, 1], [0, 1, 1]) and ("None", 1, 0) in kept and ("4", 1, 1) in kept


def test_no_rows(spark):
    assert line_dedup.dedup_lines(spark.createDataFrame([], SCHEMA)).collect() == []
