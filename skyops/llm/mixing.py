"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length. Each source's word budget is first met by whole passes over the source, then by an
even share of every length, and the remainder by a bounded-knapsack dynamic programme over lengths. Seeded hashes decide
which documents of a length are taken.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyops.llm.common import sized, stored, words_of

WEIGHTS = (3, 1, 2)
BUDGET_SHARE = 1.5
MAX_REPEATS = 2
SEED = 11
# The even share leaves about this many words to the dynamic programme, whose table has twice as many entries.
_REMAINDER = 1 << 16


def source_targets(
    totals: DataFrame, weights: Sequence[float] = WEIGHTS, budget_share: float = BUDGET_SHARE, cap: float = MAX_REPEATS
) -> DataFrame:
    """``totals`` (``source``, ``source_size``) plus ``target``.

    Sources in code point order, null last, take the weights in turn. A target is the source's weighted share, at most
    ``cap`` times its size; what is cut off goes to the others by weight. With sources in order of size per weight, the
    common words per weight are the largest of the levels that hold if all earlier sources are at their cap. The windows see
    one row per source, never documents.
    """
    turn = Window.orderBy(F.col("source").isNull(), "source")
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = totals.withColumn(
        "weight",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(turn) - 1) % len(weights) + 1),
    )
    zero = F.lit(0.0)
    left = F.sum("source_size").over(everything) * budget_share - F.coalesce(F.sum("source_size").over(earlier), zero) * cap
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), zero)
    levels = ranked.withColumn("level", left / weight_left)
    level = F.max("level").over(everything)
    target = F.greatest(F.least(F.col("source_size") * F.lit(float(cap)), level * F.col("weight")), zero)
    return levels.withColumn("target", target).select("source", "source_size", "target")


def fit_counts(sizes: Sequence[int], counts: Sequence[int], budget: int) -> list[int]:
    """How many documents of each length to take, at most ``counts``, so that their words come nearest to ``budget``.

    Every length first gives its even share (rounded down). Longest lengths first, more are taken until the rest is small;
    a bounded knapsack over the documents left then fits the rest, over or under. Ties go to the smaller sum.
    """
    order = sorted((i for i in range(len(sizes)) if sizes[i] > 0 and counts[i] > 0), key=lambda i: -sizes[i])
    total = sum(sizes[i] * counts[i] for i in order)
    taken = [0] * len(sizes)
    if budget <= 0 or not total:
        return taken
    if budget >= total:
        return [n if s > 0 else 0 for s, n in zip(sizes, counts)]
    left = budget
    if left > _REMAINDER:
        share = left - _REMAINDER
        for i in order:
            taken[i] = counts[i] * share // total
            left -= taken[i] * sizes[i]
    for i in order:
        if left > _REMAINDER:
            more = min(counts[i] - taken[i], left // sizes[i], -(-(left - _REMAINDER) // sizes[i]))
            taken[i] += more
            left -= more * sizes[i]
    if left > _REMAINDER:
        # Every document that is left is longer than the rest: nothing more, or the shortest of them.
        i = min((i for i in order if taken[i] < counts[i]), key=lambda i: sizes[i])
        taken[i] += abs(sizes[i] - left) < left
        return taken
    # Nothing beyond twice the rest comes nearer to it than taking nothing more.
    limit = 2 * left
    # last[s]: the item that first reached the sum s; items are halving multiples of one length, each usable once.
    last = np.full(limit + 1, -1, dtype=np.int32)
    reached = np.zeros(limit + 1, dtype=bool)
    reached[0] = True
    items: list[tuple[int, int]] = []
    for i in order:
        spare, multiple = min(counts[i] - taken[i], limit // sizes[i]), 1
        while spare > 0 and not (left <= limit and reached[left]):
            multiple = min(multiple, spare)
            step = multiple * sizes[i]
            if step <= limit:
                new = reached[:-step] & ~reached[step:]
                at = np.flatnonzero(new) + step
                last[at] = len(items)
                reached[at] = True
                items.append((i, multiple))
            spare -= multiple
            multiple *= 2
    sums = np.flatnonzero(reached)
    at = int(sums[np.argmin(np.abs(sums - left))])
    while at:
        i, multiple = items[last[at]]
        taken[i] += multiple
        at -= multiple * sizes[i]
    return taken


def _fit_source(lengths: pd.DataFrame) -> pd.DataFrame:
    lengths = lengths.sort_values("size")
    sizes, counts = [int(x) for x in lengths["size"]], [int(x) for x in lengths["n"]]
    total, target = int(lengths["source_size"].iloc[0]), float(lengths["target"].iloc[0])
    passes = min(MAX_REPEATS, int(target // total)) if total else 0
    chosen = fit_counts(sizes, counts, round(target) - passes * total) if passes < MAX_REPEATS else [0] * len(sizes)
    return lengths[["source", "size", "n"]].assign(passes=passes, chosen=chosen)


def mix(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, budget_share: float = BUDGET_SHARE, seed: int = SEED,
    whole_rows: bool = False,
) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``, ``source`` are read, other columns are left alone):
    ``doc_id, source, size, source_size, target, copies, taken``. With ``whole_rows`` all columns of ``docs`` come along, but
    the five new ones replace columns of these names.

    ``size`` is the number of words, 0 for a null or blank text; such a document is never drawn beyond whole passes. A null
    source is a source. ``copies`` is how often the mix takes the document, at most ``MAX_REPEATS``. Documents of one length
    and source are taken in the order of a seeded hash of ``doc_id``; rows that repeat an id, null included, are documents
    of their own. An empty table gives an empty result.

    What one task gets of a source is its lengths with their counts, never its documents: at most as many rows as the
    longest document has words. Documents are ranked only in one of about sqrt(n) hash ranges of the n documents of a length.
    """
    carried = [F.struct("*").alias("row")] if whole_rows else []
    lengths = docs.select("doc_id", "source", F.size(words_of(F.col("text"))).cast("long").alias("size"), *carried)
    lengths = stored(lengths, "mix-lengths")
    counted = lengths.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    totals = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = stored(source_targets(totals, weights, budget_share), "mix-targets")
    target_of = targets.select(F.col("source").alias("_source"), "source_size", "target")
    with_target = counted.join(sized(target_of), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    schema = "source string, size long, n long, passes long, chosen long"
    plan = stored(with_target.groupBy("source").applyInPandas(_fit_source, schema), "mix-plan")

    same = [F.col("source").eqNullSafe(F.col("_source")), F.col("size") == F.col("_size")]
    keyed = plan.withColumnsRenamed({"source": "_source", "size": "_size"})
    order = F.xxhash64(F.lit(seed), "doc_id")
    ranges = F.ceil(F.sqrt("n"))
    part = F.least(F.floor(F.pmod(order, F.lit(1 << 52)) / F.lit(float(1 << 52)) * ranges), ranges - 1)
    planned = lengths.join(keyed, same).drop("_source", "_size").withColumn("_part", part)
    split = (F.col("chosen") > 0) & (F.col("chosen") < F.col("n"))

    # The hash range in which the last document of a length is taken, and how many that range still gives.
    group = ["source", "size"]
    counts = planned.where(split).groupBy(*group, "chosen", "_part").agg(F.count(F.lit(1)).alias("_rows"))
    running = F.sum("_rows").over(Window.partitionBy(*group).orderBy("_part"))
    edges = counts.withColumn("_upto", running).where(
        (F.col("_upto") >= F.col("chosen")) & (F.col("_upto") - F.col("_rows") < F.col("chosen"))
    ).select(
        F.col("source").alias("_source"), F.col("size").alias("_size"), F.col("_part").alias("_edge"),
        (F.col("chosen") - F.col("_upto") + F.col("_rows")).alias("_need"),
    )
    placed = planned.join(edges, same, "left").drop("_source", "_size")
    at_edge = F.coalesce(F.col("_part") == F.col("_edge"), F.lit(False))
    rank = F.row_number().over(Window.partitionBy(*group, "_part").orderBy(order, "doc_id"))
    inside = placed.where(at_edge).withColumn("_extra", (rank <= F.col("_need")).cast("long"))
    whole = F.when(split, F.col("_part") < F.col("_edge")).otherwise(F.col("chosen") > 0)
    outside = placed.where(~at_edge).withColumn("_extra", whole.cast("long"))
    drawn = inside.unionByName(outside).withColumn("copies", F.col("passes") + F.col("_extra"))
    result = drawn.join(sized(target_of), F.col("source").eqNullSafe(F.col("_source")))
    new = ["size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")]
    if whole_rows:
        kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies", "taken")]
        return result.select(*[F.col("row").getField(c).alias(c) for c in kept], *new)
    return result.select("doc_id", "source", *new)
