"""Prefix trie of conversations, from sorted sequences and range minima over their common prefixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyops.llm.chat import numbered
from skyops.llm.common import sized, stored

# Turns of one row: a longer conversation gives several rows, each sorted below the node where it starts.
SEGMENT = 64
# Turns that a task holds at once.
BLOCK_TURNS = 1 << 18
# Nodes of one conversation that one window sums up.
_STRIDE = 4096
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()

_PART = (
    "depth long, x long, y long, px long, py long, conv_id long, n_convs long, chars long, n_ends long, ends_sha256 string, "
    "ends string, first_end long"
)
_KEY = ["depth", "x", "y"]


class RangeMinimum:
    """Sparse table: minima of all ranges of two to the k values."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        step = 1
        while 2 * step <= len(values):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def between(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minimum of the values ``low`` to ``high``, both included, for each pair."""
        power = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        result = np.empty(len(low), dtype=self.rows[0].dtype)
        for k, row in enumerate(self.rows):
            at = np.flatnonzero(power == k)
            result[at] = np.minimum(row[low[at]], row[high[at] - (1 << k) + 1])
        return result

    def reach_left(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """How far down from ``start`` (not included) all values are at least ``least``: a binary search for each."""
        at = start.copy()
        for k in range(len(self.rows) - 1, -1, -1):
            row = self.rows[k]
            low = at - (1 << k)
            held = row[np.clip(low, 0, len(row) - 1)] if len(row) else np.zeros(len(at))
            at = np.where((low >= 0) & (held >= least), low, at) if len(row) else at
        return at

    def reach_right(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """How far up from ``start`` (included) all values are at least ``least``."""
        at = start.copy()
        for k in range(len(self.rows) - 1, -1, -1):
            row = self.rows[k]
            held = row[np.clip(at, 0, len(row) - 1)] if len(row) else np.zeros(len(at))
            at = np.where((at < len(row)) & (held >= least), at + (1 << k), at) if len(row) else at
        return at


def _common(turns: tuple[np.ndarray, np.ndarray], starts: np.ndarray, lengths: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row with the next, 0 where ``same`` says that they start at different nodes."""
    counts = np.where(same, np.minimum(lengths[:-1], lengths[1:]), 0)
    begins = np.cumsum(counts) - counts
    step = np.arange(counts.sum()) - np.repeat(begins, counts)
    a, b = np.repeat(starts[:-1], counts) + step, np.repeat(starts[1:], counts) + step
    equal = (turns[0][a] == turns[0][b]) & (turns[1][a] == turns[1][b])
    result = counts.copy()
    some = np.flatnonzero(counts)
    if len(some):
        differ = np.where(equal, np.iinfo(np.int64).max, step)
        result[some] = np.minimum(counts[some], np.minimum.reduceat(differ, begins[some]))
    return result


def _prefix_keys(turns: np.ndarray, starts: np.ndarray, lengths: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Key of the prefix up to each turn: all turns' keys and the key of the node where the row starts, combined."""
    total = np.bitwise_xor.accumulate(turns) if len(turns) else turns
    before = np.where(starts > 0, total[np.maximum(starts - 1, 0)], 0) if len(turns) else np.zeros(len(starts), np.int64)
    return total ^ np.repeat(before ^ base, lengths)


def _columns(rows: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    flat = lambda name: rows.column(name).flatten().to_numpy()
    plain = lambda name: rows.column(name).to_numpy(zero_copy_only=False)
    lengths = rows.column("xs").value_lengths().to_numpy().astype(np.int64)
    return lengths, np.cumsum(lengths) - lengths, flat("xs"), flat("ys"), *(plain(c) for c in ("j", "x", "y"))


def _pieces(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """Batches of rows cut so that a piece has about ``block`` turns."""
    for batch in batches:
        if not batch.num_rows:
            continue
        upto = np.cumsum(batch.column("xs").value_lengths().to_numpy().astype(np.int64))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + block, side="right")))
            yield batch.slice(start, end - start)
            start = end


def _nodes_of(rows: pa.RecordBatch, segment: int) -> pa.RecordBatch:
    """The nodes that some sorted rows show, with the members among these rows. A node whose interval touches an end of the rows
    may have more members elsewhere: it carries the ids that end there, any other their digest."""
    lengths, starts, xs, ys, level, x, y = _columns(rows)
    convs, last = rows.column("conv_id").to_numpy(), rows.column("last").to_numpy(zero_copy_only=False)
    chars = rows.column("chars").flatten().to_numpy()
    n = len(convs)
    same = (level[:-1] == level[1:]) & (x[:-1] == x[1:]) & (y[:-1] == y[1:])
    common = _common((xs, ys), starts, lengths, same)
    minima, least_conv = RangeMinimum(common), RangeMinimum(convs)

    row = np.repeat(np.arange(n), lengths)
    depth = np.arange(len(row)) - np.repeat(starts, lengths) + 1
    left, right = minima.reach_left(row, depth), minima.reach_right(row, depth)
    # All members of an interval find the same one; its first member tells it.
    own = np.flatnonzero(left == row)
    left, right, depth, row = left[own], right[own], depth[own], row[own]

    # Rows of equal sequences are neighbours, the sequences that end at a node come first in its interval.
    repeats = np.zeros(n, dtype=bool)
    repeats[1:] = (common == lengths[1:]) & (lengths[:-1] == lengths[1:])
    run_start = np.flatnonzero(~repeats)
    run_end = np.append(run_start[1:], n)
    ends_at = np.zeros(n, dtype=np.int64)
    ends_at[run_start] = run_end
    edge = (left == 0) | (right == n - 1)
    n_ends, digests, texts, first_end = np.zeros(len(own), np.int64), [_EMPTY_SHA] * len(own), [None] * len(own), [None] * len(own)
    for i in np.flatnonzero(lengths[left] == depth):
        ids = convs[left[i] : ends_at[left[i]]][last[left[i] : ends_at[left[i]]]]
        if len(ids):
            n_ends[i] = len(ids)
            joined = ",".join(map(str, ids.tolist()))
            if edge[i]:
                texts[i], first_end[i] = joined, int(ids[0])
            else:
                digests[i] = hashlib.sha256(joined.encode()).hexdigest()
    for i in np.flatnonzero(edge):
        digests[i] = None

    key_x, key_y = _prefix_keys(xs, starts, lengths, x), _prefix_keys(ys, starts, lengths, y)
    parent = np.maximum(own - 1, 0)
    top = depth == 1
    return pa.RecordBatch.from_arrays(
        [
            pa.array(level[row] * segment + depth), pa.array(key_x[own]), pa.array(key_y[own]),
            pa.array(np.where(top, x[row], key_x[parent])), pa.array(np.where(top, y[row], key_y[parent])),
            pa.array(least_conv.between(left, right)), pa.array(right - left + 1), pa.array(chars[own].astype(np.int64)),
            pa.array(n_ends), pa.array(digests, pa.string()), pa.array(texts, pa.string()), pa.array(first_end, pa.int64()),
        ],
        [field.split()[0] for field in _PART.split(", ")],
    )


def _joined_digests(parts: DataFrame) -> DataFrame:
    """``depth, x, y, joined``: SHA-256 of the ids of all parts of a node, which are read one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            keys, shas = [], []
            for *key, text in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "ends"))):
                if key != now:
                    if now is not None:
                        keys.append(now)
                        shas.append(digest.hexdigest())
                    now, digest = key, hashlib.sha256()
                    digest.update(text.encode())
                else:
                    digest.update(b"," + text.encode())
            if keys:
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in zip(*keys)), pa.array(shas)], [*_KEY, "joined"])
        if now is not None:
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([c], pa.int64()) for c in now), pa.array([digest.hexdigest()])], [*_KEY, "joined"]
            )

    dealt = parts.where("ends is not null").select(*_KEY, "first_end", "ends").repartition(*_KEY)
    return dealt.sortWithinPartitions(*_KEY, "first_end").drop("first_end").mapInArrow(run, "depth long, x long, y long, joined string")


def _segments(turns: DataFrame, segment: int) -> DataFrame:
    """``conv_id, j, x, y, xs, ys, chars, last``: every conversation cut into rows of ``segment`` turns, with the key (``x, y``) of
    the node where the row starts."""
    parts = [F.xxhash64(F.lit(i), "depth", "role", "text").alias(name) for i, name in ((1, "tx"), (2, "ty"))]
    keyed = turns.select("conv_id", "depth", F.length("text").alias("chars"), *parts, F.floor((F.col("depth") - 1) / segment).cast("long").alias("j"))
    rows = keyed.groupBy("conv_id", "j").agg(
        F.sort_array(F.collect_list(F.struct("depth", "tx", "ty", "chars"))).alias("turns"),
        F.bit_xor("tx").alias("sx"), F.bit_xor("ty").alias("sy"),
    )
    rows = stored(rows.select("conv_id", "j", "sx", "sy", F.col("turns.tx").alias("xs"), F.col("turns.ty").alias("ys"), F.col("turns.chars").alias("chars")), "trie-segments")
    # Only conversations of several rows need the keys of the rows before.
    ends = rows.groupBy("conv_id").agg(F.max("j").alias("end")).where("end > 0")
    earlier = Window.partitionBy("conv_id").orderBy("j").rowsBetween(Window.unboundedPreceding, -1)
    slim = rows.select("conv_id", "j", "sx", "sy").join(sized(ends), "conv_id")
    begin = slim.select(
        F.col("conv_id").alias("_conv"), F.col("j").alias("_j"), "end", F.bit_xor("sx").over(earlier).alias("x"), F.bit_xor("sy").over(earlier).alias("y")
    )
    joined = rows.join(sized(stored(begin, "trie-begins")), (F.col("conv_id") == F.col("_conv")) & (F.col("j") == F.col("_j")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return joined.select("conv_id", "j", zero("x"), zero("y"), "xs", "ys", "chars", (F.col("j") == F.coalesce("end", F.lit(0))).alias("last"))


def _ancestors(segments: DataFrame, reps: DataFrame, segment: int, block: int) -> DataFrame:
    """``depth, x, y, leaves, saved``: what each conversation that is the first of some nodes adds to the nodes above those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _pieces(batches, block):
            lengths, starts, xs, ys, level, x, y = _columns(rows)
            depth = np.repeat(level * segment, lengths) + np.arange(len(xs)) - np.repeat(starts, lengths) + 1
            given = [np.repeat(rows.column(c).to_numpy(), lengths) for c in ("first_depth", "leaves", "saved")]
            above = depth < given[0]
            columns = [depth, _prefix_keys(xs, starts, lengths, x), _prefix_keys(ys, starts, lengths, y), *given[1:]]
            yield pa.RecordBatch.from_arrays([pa.array(c[above]) for c in columns], [*_KEY, "leaves", "saved"])

    telling = reps.where("first_depth > 1 and (leaves > 0 or saved > 0)")
    met = segments.join(telling, "conv_id").where(F.col("j") * segment < F.col("first_depth") - 1)
    return met.select("j", "x", "y", "xs", "ys", "first_depth", "leaves", "saved").mapInArrow(
        run, "depth long, x long, y long, leaves long, saved long"
    )


def prefix_trie(turns: DataFrame, members: DataFrame, segment: int = SEGMENT, block: int = BLOCK_TURNS) -> DataFrame:
    """The trie of the sequences of (``role``, ``text``) of conversations: one row per distinct prefix, the empty one included, with
    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``members`` has the distinct ``conv_id`` of all conversations, ``turns`` their turns: ``conv_id, depth`` (1, 2, ...), ``role``,
    ``text``; nothing null. A node is named by its least member. ``n_leaves`` counts the childless nodes below or at it,
    ``saved_tokens`` sums (members - 1) times the characters of the last text over the nodes below and at it, and
    ``ends_sha256`` is the digest of the ascending ids of the conversations that end there, joined by commas. Conversations
    without a turn end at the root. No members: no rows.

    Conversations are sorted as rows of at most ``segment`` turns; a longer one has several, each sorted under the key of the node
    where it starts, so its length bounds nothing. Blocks of sorted rows are worked out apart: common prefixes of neighbours, a
    sparse table of their minima, and for each prefix of each row a binary search to both sides. Intervals that touch a block's
    end are added up by node. Sums over subtrees: a conversation's nodes are those it is the least member of, a chain; chains are
    summed from below, and each adds its total to the nodes above it. Turns are compared by 128-bit hashes.
    """
    segments = stored(_segments(turns, segment), "trie-rows")
    order = [F.col(c) for c in ("j", "x", "y", "xs", "ys", "conv_id")]
    sorted_rows = segments.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _pieces(batches, block):
            yield _nodes_of(rows, segment)

    parts = stored(sorted_rows.mapInArrow(run, _PART), "trie-parts")
    edges = parts.where("ends_sha256 is null")
    summed = edges.groupBy(*_KEY).agg(
        F.min("px").alias("px"), F.min("py").alias("py"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.min("chars").alias("chars"), F.sum("n_ends").alias("n_ends"),
    )
    summed = summed.join(_joined_digests(edges), _KEY, "left").withColumn("ends_sha256", F.coalesce("joined", F.lit(_EMPTY_SHA)))
    columns = [*_KEY, "px", "py", "conv_id", "n_convs", "chars", "n_ends", "ends_sha256"]
    nodes = parts.where("ends_sha256 is not null").select(*columns).unionByName(summed.select(*columns))
    leaf = (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaf")
    nodes = stored(nodes.select("*", leaf, ((F.col("n_convs") - 1) * F.col("chars")).alias("weight")), "trie-nodes")

    reps = nodes.groupBy("conv_id").agg(F.min("depth").alias("first_depth"), F.sum("leaf").alias("leaves"), F.sum("weight").alias("saved"))
    reps = stored(reps, "trie-chains")
    above = _ancestors(segments, reps, segment, block)
    zero = F.lit(0).cast("long")
    given = above.withColumn("children", zero).unionByName(nodes.select(
        (F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y"), zero.alias("leaves"), zero.alias("saved"), F.lit(1).cast("long").alias("children")
    ))
    given = given.groupBy(*_KEY).agg(*[F.sum(c).alias(c) for c in ("leaves", "saved", "children")])

    # Own chain from below, in strides: sums inside a stride and the strides after it.
    stride = F.floor(F.col("depth") / _STRIDE).alias("stride")
    some = nodes.where("n_convs > 1").select("conv_id", *_KEY, "weight", stride)
    inside = F.sum("weight").over(Window.partitionBy("conv_id", "stride").orderBy(F.desc("depth")))
    strides = some.groupBy("conv_id", "stride").agg(F.sum("weight").alias("held"))
    after = F.sum("held").over(Window.partitionBy("conv_id").orderBy(F.desc("stride"))) - F.col("held")
    chain = some.withColumn("inside", inside).join(strides.withColumn("after", after).drop("held"), ["conv_id", "stride"])
    chain = chain.select(*_KEY, (F.col("inside") + F.col("after")).alias("own_saved"))

    named = nodes.join(reps.select("conv_id", F.col("leaves").alias("own_leaves")), "conv_id")
    whole = named.join(given, _KEY, "left").join(chain, _KEY, "left")
    filled = lambda *names: sum((F.coalesce(n, zero) for n in names[1:]), F.coalesce(names[0], zero))
    # Nodes of one member have no weight, and none below them has.
    result = whole.select(
        "conv_id", "depth", "x", "y", "px", "py", "n_convs", filled("children").alias("n_children"),
        filled("leaves", "own_leaves").alias("n_leaves"), filled("saved", "own_saved").alias("saved_tokens"), "ends_sha256",
    )
    lone = members.join(segments.where("j = 0").select("conv_id"), "conv_id", "left_anti")
    at_root = [zero.alias(c) for c in _KEY]
    digest = _joined_digests(_id_parts(lone, at_root))
    # One row of sums over all members, all nodes and the digest.
    all_rows = members.select("conv_id", F.lit(1).alias("n")).unionByName(
        nodes.select("leaf", "weight", (F.col("depth") == 1).alias("top")), allowMissingColumns=True
    ).unionByName(digest.select("joined"), allowMissingColumns=True)
    root = all_rows.agg(
        F.min("conv_id").alias("conv_id"), F.coalesce(F.sum("n"), zero).alias("n_convs"), F.count_if("top").alias("n_children"),
        F.greatest(F.coalesce(F.sum("leaf"), zero), F.lit(1).cast("long")).alias("n_leaves"),
        F.coalesce(F.sum("weight"), zero).alias("saved_tokens"), F.coalesce(F.max("joined"), F.lit(_EMPTY_SHA)).alias("ends_sha256"),
    )
    root = stored(root.where("n_convs > 0").select("*", *at_root, F.lit(None).cast("long").alias("parent_conv_id")), "trie-root")
    keys = nodes.select("conv_id", *_KEY).unionByName(root.select("conv_id", *_KEY))
    parents = keys.select(F.col("conv_id").alias("parent_conv_id"), (F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return result.join(parents, ["depth", "px", "py"]).select(*out).unionByName(root.select(*out))


def _id_parts(convs: DataFrame, key: list) -> DataFrame:
    """Ids in ascending order as the parts of one node: ranges of ids, cut so that a part is short."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("conv_id").to_pylist()
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids[:1], pa.int64()), pa.array([",".join(map(str, ids))])], ["first_end", "ends"])

    ranges = convs.select("conv_id").repartitionByRange("conv_id").sortWithinPartitions("conv_id")
    return ranges.mapInArrow(run, "first_end long, ends string").select(*key, "first_end", "ends")


def rebuilt(conversations: DataFrame, lend: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """``turns`` and ``members`` for ``prefix_trie``: every conversation with its opening exchanged for that of another.

    Conversation c takes the first h turns of conversation c - c % ``lend`` (all if it has fewer, none if it is absent), then its own
    turns after its first h; h is crc32 of c in decimals, modulo ``most``. Turns come in the order of ``turn`` (null first), then
    role, then text; repeated rows are turns of their own. Null roles and texts are empty; rows without a ``conv_id`` belong to
    no conversation and are left out.
    """
    read = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    ranked = stored(numbered(read, "conv_id", ["turn", "role", "text"], "trie-turns").drop("turn"), "trie-ranked")
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h")
    sizes = stored(ranked.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "trie-sizes")
    base = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = sizes.select("conv_id", taken, (F.col("conv_id") - F.col("conv_id") % lend).alias("base")).join(base, "base", "left")
    convs = stored(convs.select("conv_id", "h", "base", F.least("h", F.coalesce("base_n", F.lit(0))).alias("lent")), "trie-openings")

    own = ranked.join(sized(convs.select("conv_id", "h", "lent")), "conv_id").where("rank >= h").select(
        "conv_id", (F.col("rank") - F.col("h") + F.col("lent") + 1).alias("depth"), "role", "text"
    )
    openings = ranked.where(F.col("rank") < most).select(F.col("conv_id").alias("base"), "rank", "role", "text")
    lent = openings.join(sized(convs.where("lent > 0").select("conv_id", "h", "base")), "base").where("rank < h").select(
        "conv_id", (F.col("rank") + 1).alias("depth"), "role", "text"
    )
    return own.unionByName(lent), sizes.select("conv_id")
