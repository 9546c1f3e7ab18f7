import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skyops.llm import fill_in_middle as fm

SCHEMA = "doc_id long, text string, n long, form string, digest string"
TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def kinds(members):
    return {type(c).__name__ for c in members.containers}


def test_boundary_set_selects_like_a_list():
    rng = np.random.default_rng(3)
    sparse = rng.choice(1 << 16, 900, replace=False)
    dense = (1 << 17) + rng.choice(1 << 16, 30_000, replace=False)
    runs = (5 << 16) + np.concatenate([np.arange(10, 9000), np.arange(9500, 9503), np.arange(60_000, 65_536)])
    positions = np.sort(np.concatenate([sparse, dense, runs]))
    members = fm.BoundarySet(positions)
    assert kinds(members) == {"_Array", "_Bitmap", "_Runs"} and len(members) == len(positions)
    asked = np.concatenate([rng.integers(0, len(positions), 3000), [0, 899, 900, 30_899, 30_900, len(positions) - 1]])
    assert [members.select(int(k)) for k in asked] == positions[asked].tolist()
    with pytest.raises(IndexError):
        members.select(len(positions))
    assert len(fm.BoundarySet(np.array([], dtype=np.int64))) == 0


def units(text, unit):
    return list(text) if unit == "char" else TOKEN.findall(text)


def plain(doc_id, text, unit, seed, fim, spm):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    parts = units(text, unit)
    n = len(parts)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim:
        return doc_id, text, n, "plain", None, None, text
    if h[3] % 100 < spm:
        return doc_id, text, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, text, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts(rng):
    alphabet = ["a", "bé", "\U0001f9ff", " ", "\n", "\t\x0b", "\x00", "\x85", " ", "<", "<S", ">", "P>", "<M>"]
    made = ["".join(rng.choices(alphabet, k=rng.randrange(0, 40))) for _ in range(150)]
    return [*made, None, "", " ", " \n", "x", "word " * 40_000, "é" * 70_000 + " end"]


@pytest.mark.parametrize(("unit", "seed", "fim", "spm"), [("token", 42, 50, 80), ("token", 7, 100, 50), ("char", 42, 100, 50)])
def test_against_plain_cuts(spark, unit, seed, fim, spm):
    rng = random.Random(seed)
    rows = [(rng.choice([None, i, i, -i]), t) for i, t in enumerate(texts(rng))] + [(5, "twice the same"), (5, "twice the same")]
    docs = spark.createDataFrame([(*r, 0, "", "") for r in rows], SCHEMA).repartition(3)
    made = fm.fill_in_middle(docs, unit, seed, fim, spm)
    got = made.withColumn("again", fm.restore(F.col("output"), F.col("form"))).collect()
    assert sorted((tuple(r)[:-1] for r in got), key=str) == sorted((plain(*r, unit, seed, fim, spm) for r in rows), key=str)
    assert all(r.again == r.text for r in got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_boundaries_of_a_sliced_column():
    column = pa.array(["zz z", " a b ", None, "", "é é", "tail"]).slice(1, 4)
    assert [b.tolist() for b in fm.boundaries(column)] == [[2, 4, 5], [], [], [1, 3]]
    assert [b.tolist() for b in fm.boundaries(column, "char")] == [[1, 2, 3, 4, 5], [], [], [1, 2, 3]]


def test_no_rows(spark):
    assert fm.fill_in_middle(spark.createDataFrame([], SCHEMA)).collect() == []
