"""Chat formatting by multi-party perspective rotation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyops.llm.common import stored

# Turns of one rendered stretch of a dialogue; a longer dialogue gives several stretches.
STRETCH = 256


def numbered(rows: DataFrame, group: str, order: list[str], label: str) -> DataFrame:
    """``rows`` with ``rank``, from 0, inside ``group``, whatever the size of a group.

    Rows are cut into ranges of (group, order), so a large group spans several ranges; ranks inside a range are moved by the
    rows that earlier ranges hold of the group.
    """
    ranges = rows.repartitionByRange(F.col(group).asc_nulls_first(), *order).withColumn("_range", F.spark_partition_id())
    ranges = stored(ranges, label)
    inside = Window.partitionBy("_range", group).orderBy(*order)
    local = ranges.withColumn("_local", F.row_number().over(inside) - 1)
    held = ranges.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_range")) - F.col("_n")
    moved = held.select(F.col(group).alias("_group"), F.col("_range").alias("_at"), before.alias("_before"))
    joined = local.join(moved, (F.col("_range") == F.col("_at")) & F.col(group).eqNullSafe(F.col("_group")))
    return joined.withColumn("rank", (F.col("_local") + F.col("_before")).cast("long")).drop(
        "_range", "_local", "_group", "_at", "_before"
    )


def _piece(turn: Column, speaker: Column) -> Column:
    own = turn["speaker"] == speaker
    head = F.when(own, F.lit("<|assistant|>\n")).otherwise(F.concat(F.lit("<|user name="), turn["speaker"], F.lit("|>\n")))
    return F.struct(own.alias("own"), head.alias("head"), F.concat(turn["text"], F.lit("<|end|>\n")).alias("body"))


def _starts(turns: DataFrame) -> DataFrame:
    """``conv_id, stretch, speaker, start``: for every stretch and everyone who speaks in the dialogue the characters ahead of it.

    A stretch is as long for all, but that an own turn has another head; so lengths are sums, and no text is looked at twice.
    """
    user = F.length(F.concat(F.lit("<|user name="), F.col("speaker"), F.lit("|>\n")))
    length = F.length("text") + len("<|end|>\n") + user
    by_speaker = turns.groupBy("conv_id", "stretch", "speaker").agg(F.count(F.lit(1)).alias("n"), F.sum(length.cast("long")).alias("chars"))
    by_speaker = stored(by_speaker, "chat-lengths")
    whole = by_speaker.groupBy("conv_id", "stretch").agg(F.sum("chars").alias("chars"))
    speakers = by_speaker.select(F.col("conv_id").alias("_conv"), "speaker").distinct()
    every = whole.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    own = by_speaker.select(F.col("conv_id").alias("_conv"), F.col("stretch").alias("_stretch"), F.col("speaker").alias("_speaker"), "n")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("stretch") == F.col("_stretch")) & (F.col("speaker") == F.col("_speaker"))
    held = every.join(own, same, "left").withColumn(
        "chars", F.col("chars") - F.coalesce("n", F.lit(0)) * (user - len("<|assistant|>\n"))
    )
    before = F.sum("chars").over(Window.partitionBy("conv_id", "speaker").orderBy("stretch")) - F.col("chars")
    return held.select("conv_id", "stretch", "speaker", before.alias("start"))


def perspectives(turns: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """``conv_id, stretch, speaker, n_turns, n_own, rendered, mask`` for every stretch of a dialogue and everyone who speaks in the
    dialogue.

    Reads ``conv_id, turn, role, text``. Turns come in the order of ``turn`` (null first), then role, then text; repeated
    rows are turns of their own. A null role is the speaker ``unknown``, a null text is empty, the rows of a null
    ``conv_id`` are one dialogue. ``<|`` inside a text or a role becomes ``<\\|``, so a text never opens a turn. The speaker's
    turns are the assistant's, all others those of named users. ``mask`` has a (start, length) in characters for every own
    turn: its text and end mark, which are what a model is to learn. An empty table gives an empty result.

    A dialogue is rendered in stretches of ``stretch`` turns, so no task gathers more turns than that of a dialogue. The
    stretches of a speaker, one after the other, are the whole dialogue as that speaker sees it, and ``mask`` counts from its
    start; a stretch without an own turn has an empty mask.
    """
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("<\\|"))
    read = turns.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        safe(F.coalesce(F.col("role"), F.lit("unknown"))).alias("speaker"), safe(F.coalesce(F.col("text"), F.lit(""))).alias("text"),
    )
    ranked = numbered(read, "conv_id", ["turn", "speaker", "text"], "chat-turns")
    cut = ranked.withColumn("stretch", F.floor(F.col("rank") / stretch).cast("long"))
    cut = stored(cut, "chat-cut")
    grouped = cut.groupBy("conv_id", "stretch").agg(F.sort_array(F.collect_list(F.struct("rank", "speaker", "text"))).alias("turns"))
    starts = _starts(cut).withColumnsRenamed({"conv_id": "_conv", "stretch": "_stretch"})
    each = grouped.join(starts, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("stretch") == F.col("_stretch")))
    pieces = each.withColumn("pieces", F.transform("turns", lambda t: _piece(t, F.col("speaker"))))
    start = F.aggregate(
        "pieces",
        F.struct(F.col("start").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["head"]) + F.length(p["body"])).alias("at"),
            F.when(
                p["own"],
                F.concat(acc["spans"], F.array(F.struct(
                    (acc["at"] + F.length(p["head"])).alias("start"), F.length(p["body"]).cast("long").alias("length")
                ))),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return pieces.select(
        "conv_id", "stretch", "speaker", F.size("turns").cast("long").alias("n_turns"),
        F.size(F.filter("pieces", lambda p: p["own"])).cast("long").alias("n_own"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), "").alias("rendered"),
        start.alias("mask"),
    )
