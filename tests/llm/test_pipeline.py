"""The stages over a small table, each against brute force on the stage's own input."""

import random
import time
import tracemalloc
import uuid

import corpus_pipeline as cp
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from test_decontaminate import by_alignment
from test_line_dedup import by_all_pairs, words
from test_mixing import by_resharing
from test_line_quality import counts
from test_simhash import classes, shingles, similarity

from skyops.llm import common, mixing, quality, simhash
from skyops.llm.common import stored, text_slices


def table(rng):
    vocabulary = [f"w{i}" for i in range(300)]
    line = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)).capitalize() + "."
    benchmark = [(i, line(20)) for i in range(5)]
    docs = {}
    for i in range(90):
        docs[i] = "\n".join(line(rng.randrange(8, 30)) for _ in range(6))
        kind = i % 9
        if kind == 1:
            docs[i] = docs[i - 1]
        elif kind == 2:
            docs[i] = docs[i - 2].replace("w1", "w2")
        elif kind == 3:
            docs[i] = docs[i].replace(" ", " w5 ", 1) + " " + rng.choice(benchmark)[1] + " " + line(9)
        elif kind == 4:
            docs[i] = "| a | b |\n" * 40
        elif kind == 5:
            docs[i] = line(10)
    return {**docs, 90: None, 91: ""}, benchmark


def test_stages(spark, tmp_path):
    docs, benchmark = table(random.Random(3))
    rows = [(i, t, "en", f"s{i % 3}" if i % 10 else None, len(t or "")) for i, t in docs.items()]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    labels = [(i, int(i % 9 not in (4, 5)), 0) for i in range(60)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    sf_dir = str(tmp_path)

    frame, text = spark.read.parquet(f"{sf_dir}/documents.parquet"), docs
    results = []
    for name, stage in cp.STAGES:
        frame = stored(stage(spark, frame, sf_dir), name)
        results.append({r.doc_id: r for r in frame.collect()})
        assert name == cp.STAGES[-1][0] or frame.columns == [f.split()[0] for f in schema.split(', ')]
    good, lines, near, clean, mix = results

    # Quality: what fails the counts goes; the clean documents all stay.
    assert set(good) <= {i for i, t in text.items() if not counts(t)[-1]}
    assert {i for i in range(90) if i % 9 not in (4, 5)} <= set(good)
    # Lines.
    kept = by_all_pairs({i: r.text for i, r in good.items()}, 1, 5)
    alive = {i: t for i, t in kept.items() if t == good[i].text or words(t)}
    assert {i: r.text for i, r in lines.items()} == alive and all(r.n_chars == len(r.text) for r in lines.values())
    assert not set(range(1, 90, 9)) & set(lines)
    # Near-duplicates.
    sets = {i: shingles(r.text, 5) for i, r in lines.items()}
    of = classes(sets, lambda a, b: similarity(sets[a], sets[b]) >= 0.8)
    assert {i: r.text for i, r in near.items()} == {i: r.text for i, r in lines.items() if of[i] == i}
    # Leaks.
    bad = {int(d) for d, *_ in by_alignment([(i, r.text) for i, r in near.items()], benchmark)}
    assert set(clean) == set(near) - bad and set(range(3, 90, 9)) & set(near) <= bad
    # Mix.
    sizes = {s: sum(len(words(r.text)) for r in clean.values() if r.source == s) for s in {r.source for r in clean.values()}}
    target = by_resharing(sizes)
    for source in sizes:
        own = [r for r in mix.values() if r.source == source]
        assert abs(sum(r.taken for r in own) - target[source]) <= 30 and all(r.copies in (1, 2) for r in own)
    assert set(mix) <= set(clean) and all(r.text == clean[i].text for i, r in mix.items())
    again = {r.doc_id: r for r in cp.run(spark, sf_dir).collect()}
    assert again == mix


def test_short_lines_of_their_own(spark):
    """A document of short lines stays without the footer that it shares; one whose lines have all been said goes."""
    footer, short = "all rights reserved by the authors", [f"rose {i}" for i in range(40)]
    texts = {0: footer, 1: "\n".join([*short, footer]), 2: "\n".join([*short[5:9], "", footer]), 3: "thorn\nrose 3\n" + footer, 4: "\n \n"}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in cp.dedup_lines(spark, docs, "").collect()}
    want = {0: footer, 1: "\n".join(short), 3: "thorn", 4: "\n \n"}
    assert got == {i: (t, len(t)) for i, t in want.items()}


WIDE = "doc_id long, text string, lang string, source string, n_chars long, th string, size string, line_no int, _id long, row string"


def wide(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), f"x{k}", "y", 3, 4, "z") for k, (i, t, s) in enumerate(rows)], WIDE)


def test_rows_go_by_row(spark):
    """Null ids, repeated ids and repeated rows: of each group of similar texts one row stays, all others stay as they are."""
    a, b, c = ("one two three four five six seven", "red green blue black white grey pink", "north south east west up down left")
    rows = [(None, a, "s"), (None, b, "s"), (3, a, "s"), (5, c, "s"), (5, c, "s"), (7, b, "s"), (7, "quite another text", "s"), (None, "alone here", None), (None, None, "s"), (None, "", "s")]
    docs = wide(spark, rows)
    got = cp.near_dedup(spark, docs, "")
    assert got.columns == docs.columns and {r["row"] for r in got.collect()} == {"z"}
    want = [("3", a), ("5", c), ("7", b), ("7", "quite another text"), ("None", "alone here"), ("None", "")]
    assert sorted((str(r.doc_id), r.text or "") for r in got.collect()) == sorted(want)
    assert cp.near_dedup(spark, wide(spark, []), "").collect() == []


def test_mix_of_repeated_ids(spark):
    rows = [(1, "w " * 2000, "a"), (1, "w " * 2000, "b"), (None, "w " * 10, "a"), (None, "v " * 10, None), (2, "w", "a"), (2, "w", "a"), (3, None, "a")]
    got = cp.mixed(spark, wide(spark, rows), "").collect()
    plain = mixing.mix(wide(spark, rows)).where("copies > 0").collect()
    figures = lambda frame: sorted((str(r.doc_id), str(r.source), r.size, r.target, r.copies, r.taken) for r in frame)
    assert figures(got) == figures(plain) and {r["row"] for r in got} == {"z"}
    assert cp.mixed(spark, wide(spark, []), "").collect() == []


def test_other_stages_with_odd_rows(spark, tmp_path):
    line = "the quick brown fox jumps over the lazy dog again today"
    rows = [(None, line, "s"), (None, "x\n" + line, "s"), (4, line, "s"), (4, line, "s"), (4, None, "s"), (9, "", "s"), (9, "only here " * 40, "s")]
    docs = wide(spark, rows)
    lines = cp.dedup_lines(spark, docs, "")
    assert lines.columns == docs.columns and {r["row"] for r in lines.collect()} == {"z"}
    texts = [r.text for r in lines.collect()]
    # The null id comes first: one of its two texts keeps the line, the rows that repeat it have no word left and go.
    assert sum(line in (t or "") for t in texts) == 1 and sum("only here" in (t or "") for t in texts) == 1
    assert len(texts) == (4 if "x" not in texts else 5) and None in texts and "" in texts
    spark.createDataFrame([(1, "What is the colour of " + line + " ?")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(9, 1, 0), (4, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    clean = cp.decontaminated(spark, docs, str(tmp_path))
    assert clean.columns == docs.columns and len([r for r in clean.collect() if r.text != line and r.text != "x\n" + line]) == 3
    good = cp.quality_rules(spark, docs, str(tmp_path))
    assert good.columns == docs.columns and all(r.doc_id == 9 for r in good.collect())
    for stage in (cp.dedup_lines, cp.decontaminated, cp.quality_rules):
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []


def folder_for(monkeypatch, tmp_path):
    monkeypatch.setattr(common, "workspace", lambda spark, label: f"{tmp_path}/{label}-{uuid.uuid4().hex}")


def test_near_stage_leaves_only_what_it_returns_from(spark, tmp_path, monkeypatch):
    """Shingle sets, candidates and rounds go once the groups are stored; the result doesn't need them."""
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[i % 3 :]) + f" x{i % 6}", "s") for i in range(12)]
    folder_for(monkeypatch, tmp_path)
    got = cp.near_dedup(spark, wide(spark, rows), "")
    assert {p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()} == {"pipeline-near", "simhash-winners"}
    assert [r.doc_id for r in got.collect()] == [0]


def test_shuffle_files_go_with_their_query(spark, tmp_path, monkeypatch):
    """Inside ``scratch`` what a query shuffled goes as soon as its table is stored; afterwards the setting is as it was."""
    folder_for(monkeypatch, tmp_path)
    env = spark._jsc.sc().env()
    files = lambda: {x for x in env.blockManager().diskBlockManager().getAllFiles().mkString(",").split(",") if "/shuffle_" in x}
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = files(), spark.conf.get(name, None)
    with common.scratch(spark):
        assert stored(spark.range(10_000).groupBy((F.col("id") % 500).alias("k")).count(), "sums").count() == 500
        for _ in range(50):
            if not files() - before:
                break
            time.sleep(0.1)
        assert not files() - before
    assert spark.conf.get(name, None) == setting


def test_prefixes_of_one_component_are_not_kept(spark, tmp_path, monkeypatch):
    """Shingles that only texts of one component share need no further comparison; those that others share do."""
    family = lambda x: [f"{x}0 " + " ".join(f"{x}{i}" for i in range(1, 60)) + f" {x}{end}" for end in ("a", "b", "c")]
    folder_for(monkeypatch, tmp_path)
    stored_rows = lambda: sum(pq.read_table(p).num_rows for p in tmp_path.glob("simhash-prefixes-*/*.parquet"))
    alike = wide(spark, [(i, t, "s") for i, t in enumerate(family("v") + family("w"))])
    assert sorted(r.component_id for r in simhash.similar_duplicates(alike).collect()) == [0, 0, 0, 3, 3, 3]
    assert stored_rows() == 0
    half = [f"{x}{i}" for x in range(6) for i in range(16)]
    rows = [(2 * k + e, " ".join([*half[16 * k : 16 * k + 16], *[f"{end}{k}{i}" for i in range(8)]]), "s") for k in range(6) for e, end in enumerate("yz")]
    assert sorted(r.component_id for r in simhash.similar_duplicates(wide(spark, rows)).collect()) == list(range(12))
    assert stored_rows() > 0


def test_batches_bound_what_python_steps_hold(spark):
    """Of long texts a Python step gets about a megabyte at a time, and what quality rules make of it stays small."""
    docs = wide(spark, [(i, "some words of a line\n" * 20_000, "s") for i in range(12)]).coalesce(1)
    cp._small_batches(spark)
    sizes = docs.select("text").mapInArrow(lambda it: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in it), "n long")
    assert max(r.n for r in sizes.collect()) <= 4
    batch = pa.RecordBatch.from_pydict({"text": [f"line {i} of some words\n" * 20 for i in range(9_000)]})
    tracemalloc.start()
    for part in text_slices(batch, "text", quality._PIECE_BYTES):
        quality._measure(part.column("text"), quality.ALL_CONTENT)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 * 1024 * 1024


def test_row_groups_of_shingle_sets(spark, tmp_path, monkeypatch):
    """Whoever writes or reads the stored sets holds a row group, not a file."""
    sets = spark.range(400).select(F.transform(F.sequence(F.lit(1), F.lit(6000)), lambda i: F.xxhash64("id", i)).alias("shingles")).coalesce(1)
    folder_for(monkeypatch, tmp_path)
    assert stored(sets, "sets", simhash._GROUP_BYTES).count() == 400
    (file,) = tmp_path.glob("sets-*/*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert max(meta.row_group(i).total_byte_size for i in range(meta.num_row_groups)) < 12 * 1024 * 1024
