from collections import defaultdict
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skyops.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, target int"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 12), st.integers(0, 3)), min_size=1, max_size=4, unique_by=lambda x: x[0]), st.integers(0, 60))
def test_counts_fit_as_well_as_any(lengths, budget):
    sizes, counts = zip(*lengths)
    taken = mixing.fit_counts(sizes, counts, budget)
    assert all(0 <= t <= n for t, n in zip(taken, counts))
    every = {sum(s * k for s, k in zip(sizes, ks)) for ks in product(*[range(n + 1) for n in counts])}
    assert abs(sum(s * t for s, t in zip(sizes, taken)) - budget) == min(abs(x - budget) for x in every)


def test_large_budgets_are_met_exactly():
    sizes, counts = list(range(1, 2000)), [3000] * 1999
    budget = 1_234_567_891
    assert sum(s * t for s, t in zip(sizes, mixing.fit_counts(sizes, counts, budget))) == budget


def by_resharing(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Shares by weight; what is above a cap is shared again, until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > cap * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: cap * sizes[s] for s in full}
        left -= sum(cap * sizes[s] for s in full)
        open_ -= full
    return target


def rows(spark, n=300):
    made = [(i, " ".join(["w"] * (i * 7 % 31)), ["b", "a", None, "Z", "é"][i % 5 if i % 3 else 0], "x", 1) for i in range(n)]
    made += [(None, None, "a", None, None), (None, "", None, None, None), (5, "w w", "b", "x", 1), (5, "w w", "b", "x", 1)]
    return spark.createDataFrame(made, SCHEMA), made


def test_mix(spark):
    docs, made = rows(spark)
    got = mixing.mix(docs).collect()
    assert len(got) == len(made)
    sizes = defaultdict(int)
    for _, text, source, _, _ in made:
        sizes[source] += len((text or "").split())
    want = by_resharing(sizes)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        taken[r.source] += r.taken
    for source, target in want.items():
        assert abs(taken[source] - target) <= 1
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_hash_ranges_take_the_least_hashes(spark):
    """One length only, so every document is ranked in ranges."""
    docs = spark.range(5000).selectExpr("id AS doc_id", "'a b c' AS text", "IF(id < 4000, 's', 't') AS source")
    got = mixing.mix(docs).selectExpr("*", f"xxhash64({mixing.SEED}, doc_id) AS h").collect()
    for source in "st":
        own = [r for r in got if r.source == source]
        extra = {r.copies for r in own}
        assert abs(sum(r.taken for r in own) - own[0].target) <= 2 and len(extra) <= 2
        if len(extra) == 2:
            more = [r.h % (1 << 52) for r in own if r.copies == max(extra)]
            less = [r.h % (1 << 52) for r in own if r.copies == min(extra)]
            assert max(more) < min(less) + (1 << 52) / 31  # up to the order inside the last range


def test_no_rows(spark):
    assert mixing.mix(rows(spark)[0].limit(0)).collect() == []
    blank = spark.createDataFrame([(1, " ", "a", "", 0), (2, None, None, "", 0)], SCHEMA)
    assert [(r.size, r.target, r.taken) for r in mixing.mix(blank).collect()] == [(0, 0.0, 0)] * 2


def test_long_documents_are_fitted_to_the_nearest_sum():
    assert mixing.fit_counts([3_000_000], [10], 1_600_000) == [1]
    assert mixing.fit_counts([3_000_000], [10], 1_400_000) == [0]
    assert mixing.fit_counts([2_000_000, 3_000_000], [1, 4], 4_900_000) == [1, 1]
    assert mixing.fit_counts([70_000, 900_000], [2, 1], 1_000_000) == [1, 1]
