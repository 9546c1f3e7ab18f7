"""Histories and dimensions against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from skyops.operators import cdc
from skyops.operators.skew import hot_keys, is_small, mark_hot, measured_bytes

SCHEMA = "k string, day date, seq timestamp_ntz, src string, v int, note string"


def brute(rows, track=None):
    """rows: (k, day, seq, src, v, note) with everything comparable; None sorts first."""
    def rank(r):
        return tuple((x is not None, x) for x in (r[3], *r[4:]))

    winners = {}
    for r in rows:
        at = (r[0], r[2])
        if at not in winners or rank(r) > rank(winners[at]):
            winners[at] = r
    out = []
    for key in {r[0] for r in rows}:
        versions = sorted((r for r in winners.values() if r[0] == key), key=lambda r: r[2])
        if track:
            state = [tuple(r[i] for i in track) for r in versions]
            versions = [r for i, r in enumerate(versions) if i == 0 or state[i] != state[i - 1]]
        for i, r in enumerate(versions):
            out.append((*r, r[2], versions[i + 1][2] if i + 1 < len(versions) else None))
    return sorted(out, key=repr)


def make(n, keys, seed, weights=None):
    import datetime as dt

    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for _ in range(n):
        k = rnd.choices(keys, weights)[0]
        rows.append((
            k, dt.date(2024, 1, 1 + (hash_of(k) % 3)), base + dt.timedelta(minutes=rnd.randrange(n // 2)),
            rnd.choice(["a", "b", None]), rnd.choice([None, 1, 2]), rnd.choice(["x", None]),
        ))
    return rows + rnd.sample(rows, n // 5)  # copies


def rows_of(rows, k):
    return sum(r[0] == k for r in rows)


def hash_of(k):
    return 0 if k is None else sum(map(ord, k))


def result(df):
    got = df.select("k", "day", "seq", "src", "v", "note", cdc.START, cdc.END)
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("track", [None, ["v"]])
@pytest.mark.parametrize("cluster_by", [(), ("day",)])
@pytest.mark.parametrize("hot_rows", [1, 20, 10_000])
def test_history_equals_brute_force(spark, track, cluster_by, hot_rows):
    """With the lowest limit all keys are cut, one or a few rows a slice; with 20 the heavy ones, NULL among them."""
    rows = make(600, ["hot", "warm", None, *[f"k{i}" for i in range(120)]], 7, [200, 60, 40, *[2] * 120])
    df = spark.createDataFrame(rows, SCHEMA)
    hot = hot_keys(df, ["k"], hot_rows)
    assert ({r.k for r in hot.collect()} if hot is not None else set()) == {r[0] for r in rows if rows_of(rows, r[0]) > hot_rows}
    got = cdc.scd2_history(df, ["k"], "seq", ["src"], track, cluster_by, hot_rows)
    assert result(got) == brute(rows, track and [4])


def test_row_order_and_repeats_do_not_matter(spark):
    rows = make(300, [f"k{i}" for i in range(20)], 3)
    expected = result(cdc.scd2_history(spark.createDataFrame(rows, SCHEMA), ["k"], "seq", ["src"]))
    for seed in (1, 2):
        shuffled = rows + rows[:50]
        random.Random(seed).shuffle(shuffled)
        assert result(cdc.scd2_history(spark.createDataFrame(shuffled, SCHEMA), ["k"], "seq", ["src"])) == expected


def test_versions_tile_time(spark):
    rows = make(400, [f"k{i}" for i in range(10)], 5)
    history = cdc.scd2_history(spark.createDataFrame(rows, SCHEMA), ["k"], "seq")
    assert cdc.current_of(history).count() == history.select("k").distinct().count()
    starts = history.groupBy("k").agg(F.sort_array(F.collect_list(cdc.START)).alias("s"),
                                      F.sort_array(F.collect_list(cdc.END)).alias("e"))
    for r in starts.collect():
        assert r.s[1:] == [x for x in r.e if x is not None] and len(set(r.s)) == len(r.s)


def test_missing_sequence_is_an_error(spark):
    df = spark.createDataFrame([("a", None)], "k string, seq timestamp_ntz")
    with pytest.raises(Exception, match="change without a seq"):
        cdc.scd2_history(df, ["k"], "seq").collect()


def test_cold_history_needs_one_shuffle(spark):
    rows = make(300, [f"k{i}" for i in range(300)], 3)
    for cluster_by in ((), ("day",)):
        df = cdc.scd2_history(spark.createDataFrame(rows, SCHEMA), ["k"], "seq", ["src"], ["v"], cluster_by)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def test_dedup_takes_the_newest_then_the_greatest(spark):
    df = spark.createDataFrame(
        [("a", 1, "p1", 5), ("a", 2, "p1", 1), ("a", 2, "p2", 0), ("b", 1, None, None), ("b", 1, None, 3)],
        "k string, ts int, path string, v int",
    )
    got = sorted(tuple(r) for r in cdc.dedup_latest(df, ["k"], ["ts", "path"]).collect())
    assert got == [("a", 2, "p2", 0), ("b", 1, None, 3)]


def test_snapshots_in_turn_equal_the_last_one(spark):
    rnd = random.Random(11)
    state = spark.createDataFrame([], "a string, b int, v string")
    before = {}
    for _ in range(4):
        after = {(f"k{i}", i % 3): rnd.choice(["x", "y", None]) for i in range(30) if rnd.random() < 0.7}
        snapshot = spark.createDataFrame([(*k, v) for k, v in after.items()], "a string, b int, v string")
        diff = {(r.a, r.b): r.change for r in cdc.snapshot_diff(state, snapshot, ["a", "b"]).collect()}
        for key in before.keys() | after.keys():
            expected = (
                "insert" if key not in before else "delete" if key not in after
                else "unchanged" if before[key] == after[key] else "update"
            )
            assert diff[key] == expected
        rows = cdc.scd1_apply(state, snapshot, ["a", "b"]).collect()
        assert {(r.a, r.b): r.v for r in rows} == after
        state, before = spark.createDataFrame(rows, "a string, b int, v string"), after


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_changes_are_those_of_the_whole_comparison(spark, limit):
    schema = "a string, b int, v string, w string"
    old = [("k", i, rows[0], rows[1]) for i, rows in enumerate([("x", None), (None, "x"), ("x", "y"), (None, None), ("same", "same")])]
    new = [("k", 0, None, "x"), ("k", 1, None, "x"), ("k", 2, "x", "z"), ("k", 3, "", None), ("new", 4, "x", "y"), (None, 1, "x", "y")]
    current, snapshot = spark.createDataFrame([*old, (None, 1, "x", "y")], schema), spark.createDataFrame(new, schema)
    key = lambda rows: sorted(map(str, rows))
    want = cdc.snapshot_diff(current, snapshot, ["a", "b"]).where("change <> 'unchanged'").collect()
    got = cdc.snapshot_changes(current, snapshot, ["a", "b"], limit)
    assert len(want) == 7 and key(got.collect()) == key(want)
    for one, other in ((current, current.limit(0)), (current.limit(0), snapshot)):
        assert cdc.snapshot_changes(one, other, ["a", "b"], limit).count() == max(one.count(), other.count())
    plain = current.where("a IS NOT NULL")
    assert cdc.snapshot_changes(plain, plain, ["a", "b"], limit).collect() == []


def test_measured_size(spark):
    df = spark.createDataFrame([("é", 1), (None, 2)], "s string, n int")
    assert measured_bytes(df) == 2 * 32 + 2
    assert is_small(df) and not is_small(df, limit=10)
    assert not is_small(spark.sql("SELECT array(1) AS a"))


def test_hot_keys_are_the_frequent_ones(spark):
    df = spark.range(10_000).withColumn("k", F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")))
    assert [tuple(r) for r in hot_keys(df, ["k"], 1000).collect()] == [(None, 3334)]
    assert hot_keys(df, ["k"]) is hot_keys(spark.range(10_000), ["id"], 1000) is hot_keys(spark.range(0), ["id"]) is None


def test_a_key_above_the_limit_is_split_whatever_the_table_size(spark):
    for others in (0, 20_000, 200_000):
        df = spark.range(16).select(F.lit(-1).cast("long").alias("k")).union(spark.range(others))
        assert [tuple(r) for r in hot_keys(df, ["k"], 15).collect()] == [(-1, 16)]
    rows = [("hot", None, f"2024-01-{i:02d}", None, i, None) for i in range(1, 17)]
    text = "k string, day date, seq string, src string, v int, note string"
    plan = cdc.scd2_history(spark.createDataFrame(rows, text), ["k"], "seq", hot_rows=15)._jdf.queryExecution().toString()
    assert "_slice" in plan


@pytest.mark.parametrize("limit", [10**9, 0])
def test_hot_rows_are_marked_with_and_without_broadcast(spark, limit):
    df = spark.range(1000).select(F.when(F.col("id") % 2 == 0, None).otherwise(F.col("id") % 10).alias("k"), "id")
    hot = hot_keys(df, ["k"], 150)
    got = {(r.k, r.flag) for r in mark_hot(df, ["k"], hot, "flag", limit).select("k", "flag").collect()}
    assert got == {(None, True), *[(k, False) for k in (1, 3, 5, 7, 9)]} and mark_hot(df, ["k"], hot, "flag", limit).count() == 1000


def test_text_sequences_give_the_same_versions_hot_and_cold(spark):
    rows = [("a", None, f"2024-01-{1 + i % 14:02d}T00", "s", i, None) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, day date, seq string, src string, v int, note string")
    for track in (None, ["v"]):
        cold, hot = (result(cdc.scd2_history(df, ["k"], "seq", ["src"], track, hot_rows=n)) for n in (10**6, 5))
        assert cold == hot == brute(rows, track and [4]) and (track or len(cold) == 14)
