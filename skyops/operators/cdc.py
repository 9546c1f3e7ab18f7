"""Change capture: version histories (type 2), current-state dimensions (type 1) and the dedup both rest on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyops.operators.skew import BROADCAST_BYTES, HOT_ROWS, hot_keys, is_small, mark_hot
from skyops.session import workspace

START, END = "__START_AT", "__END_AT"


def dedup_latest(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """One row per key: greatest ``newest_by``, then greatest remaining values, so the winner never depends on row order.

    A plain aggregate: copies of a key collapse to one row per map task before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest_by]
    best = F.max(F.struct(*newest_by, *rest)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*[F.col(c) if c in keys else F.col(f"_best.{c}") for c in df.columns])


def _required(sequence: str) -> Column:
    return F.coalesce(F.col(sequence), F.raise_error(F.lit(f"change without a {sequence}")))


def scd2_history(
    changes: DataFrame, keys: Sequence[str], sequence: str, tie: Sequence[str] = (), track: Sequence[str] | None = None,
    cluster_by: Sequence[str] = (), hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Versions of every key: ``__START_AT`` is the row's own sequence, ``__END_AT`` that of the next version.

    Rows may come in any order and more than once. Of several rows with one key and sequence, the greatest ``tie`` wins,
    then the greatest row content. Without ``track`` every event is a version; with it, an event that leaves the tracked
    columns as they were adds none.

    ``cluster_by`` names columns that the key determines (such as a date inside the key); they may stand in front of the key.

    Cold keys need one shuffle and one sort. A key of more than ``hot_rows`` rows is cut into slices of the sequence, see
    ``_sliced``; the sequence may have any type that can be sorted.
    """
    group = [*cluster_by, *keys]
    rows = changes.withColumn(START, _required(sequence))
    hot = hot_keys(changes, keys, hot_rows)
    content = [*tie, *[c for c in changes.columns if c not in (sequence, *group, *tie)]]
    if hot is None:
        return _versions(rows, group, [START, *content], track)
    marked = mark_hot(rows, keys, hot, "_is_hot")
    cold = _versions(marked.where("NOT _is_hot").drop("_is_hot"), group, [START, *content], track)
    hot_count = hot.agg(F.sum("rows")).first()[0]
    sliced = _sliced(marked.where("_is_hot").drop("_is_hot"), group, content, track, 1 + hot_count // hot_rows)
    return cold.unionByName(sliced.withColumn(sequence, F.col(START)))


def _versions(rows: DataFrame, group: Sequence[str], order: Sequence[str], track: Sequence[str] | None) -> DataFrame:
    """One sort serves all steps: within a key, the last row of each sequence is its tie winner, and the row after it
    starts the next version."""
    by_key = Window.partitionBy(*group).orderBy(*order)
    following = rows.withColumn(END, F.lead(START).over(by_key))
    versions = following.where(F.col(END).isNull() | (F.col(END) != F.col(START)))
    if track is None:
        return versions
    state = F.struct(*track)
    changed = versions.withColumn("_before", F.lag(state).over(by_key)).where(
        F.col("_before").isNull() | ~F.col("_before").eqNullSafe(state)
    )
    return changed.drop("_before").withColumn(END, F.lead(START).over(by_key))


def _sliced(
    rows: DataFrame, group: Sequence[str], content: Sequence[str], track: Sequence[str] | None, slices: int
) -> DataFrame:
    """The same result for hot keys, without giving any task all rows of a key.

    Copies and ties collapse first, in a partial aggregate. What is left is dealt out by ranges of key and sequence, as many
    as ``slices`` at least, so a range holds its share of the rows whatever the keys; it is written down, as ranges come from
    a sample and must not move. Neighbours are found inside a slice; the neighbour of a slice's edge row is the edge of the
    nearest slice of its key, looked up in a table of one row per key and slice.
    """
    spark = rows.sparkSession
    unique = rows.groupBy(*group, START).agg(F.max(F.struct(*content)).alias("_best")).select(*group, START, "_best.*")
    parts = max(slices, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = unique.repartitionByRange(parts, *group, START).withColumn("_slice", F.spark_partition_id())
    path = workspace(spark, "slices")
    ranged.write.parquet(path)
    sliced = spark.read.schema(ranged.schema).parquet(path)

    versions = sliced
    if track is not None:
        state = F.struct(*track)
        versions = _neighbour(sliced, group, state, "_before", track, forward=False).where(
            F.col("_before").isNull() | ~F.col("_before").eqNullSafe(state)
        ).drop("_before")
    return _neighbour(versions, group, F.col(START), END, (), forward=True).drop("_slice")


def _neighbour(
    rows: DataFrame, group: Sequence[str], value: Column, name: str, needs: Sequence[str], forward: bool
) -> DataFrame:
    """``value`` (made of ``__START_AT`` and ``needs``) of the next or previous row of the key, across slices.

    Each slice is lent the edge row of the nearest non-empty slice on that side. It sorts beyond all rows of the slice, so
    one window inside slices finds every neighbour, and the lent rows are taken out again. No join is needed.
    """
    inside = Window.partitionBy(*group, "_slice").orderBy(START)
    across = Window.partitionBy(*group).orderBy("_slice")
    edge, step = (F.min_by, F.lead) if forward else (F.max_by, F.lag)
    edges = rows.groupBy(*group, "_slice").agg(edge(F.struct(START, *needs), F.col(START)).alias("_edge"))
    lent = edges.withColumn("_edge", step("_edge").over(across)).where("_edge IS NOT NULL").select(
        *group, "_slice", "_edge.*", F.lit(True).alias("_lent")
    )
    both = rows.withColumn("_lent", F.lit(False)).unionByName(lent, allowMissingColumns=True)
    return both.withColumn(name, step(value).over(inside)).where("NOT _lent").drop("_lent")


def current_of(history: DataFrame) -> DataFrame:
    """The open version of every key."""
    return history.where(F.col(END).isNull())


def snapshot_diff(current: DataFrame, snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What a full snapshot does to a dimension: keys, ``change`` (insert, update, delete, unchanged), and the values
    ``before`` and ``after`` as structs. Both sides hold one row per key."""
    values = [c for c in snapshot.columns if c not in keys]
    before = current.select(*keys, F.struct(*values).alias("before"))
    after = snapshot.select(*keys, F.struct(*values).alias("after"))
    change = (
        F.when(F.col("before").isNull(), "insert")
        .when(F.col("after").isNull(), "delete")
        .when(F.col("before").eqNullSafe(F.col("after")), "unchanged")
        .otherwise("update")
    )
    return before.join(after, list(keys), "full_outer").withColumn("change", change)


def _row_print(columns: Sequence[str]) -> Column:
    """128 bits that tell the rows apart; nulls count, which the hash alone passes over."""
    parts = [F.col(c).isNull() for c in columns] + [F.col(c) for c in columns]
    return F.struct(*[F.xxhash64(F.lit(seed), *parts).alias(f"h{seed}") for seed in (1, 2)])


def snapshot_changes(
    current: DataFrame, snapshot: DataFrame, keys: Sequence[str], limit: int = BROADCAST_BYTES
) -> DataFrame:
    """The rows of ``snapshot_diff`` that are not unchanged, for wide dimensions of which few rows change.

    Keys and row hashes are compared first, so that the one shuffle of both sides is narrow. Whole rows are taken only for the
    keys that differ: these are a stored table, broadcast if it is small, and joined by a shuffle if not. Rows with a null in
    their key are inserts or deletes, as in ``snapshot_diff``.
    """
    values = [c for c in snapshot.columns if c not in keys]
    before, after = (df.select(*keys, _row_print(values).alias(n)) for df, n in ((current, "_before"), (snapshot, "_after")))
    changed = before.join(after, list(keys), "full_outer").where(~F.col("_before").eqNullSafe(F.col("_after")))
    names = [f"_changed_{k}" for k in keys]
    changed = changed.select(*[F.col(k).alias(n) for k, n in zip(keys, names)]).distinct()
    path = workspace(current.sparkSession, "changed-keys")
    changed.write.parquet(path)
    changed = current.sparkSession.read.schema(changed.schema).parquet(path)
    if is_small(changed, limit):
        changed = F.broadcast(changed)
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    diff = snapshot_diff(current.join(changed, same, "left_semi"), snapshot.join(changed, same, "left_semi"), keys)
    return diff.where("change <> 'unchanged'")


def scd1_apply(current: DataFrame, snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The dimension after a full snapshot: new keys in, changed rows overwritten, absent keys out."""
    diff = snapshot_diff(current, snapshot, keys).where(F.col("change") != "delete")
    return diff.select(*[F.col(c) if c in keys else F.col(f"after.{c}").alias(c) for c in snapshot.columns])
