"""SimHash near-duplicates with pigeonring filtering."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyops.llm.common import hash_texts, list_slices, sized, split_words, stored, text_hash, text_slices
from skyops.llm.components import components

HASH_SEED = 42
BITS = 64
# Pairs are formed inside a bucket of at most this many fingerprints; a larger one is linked through shared neighbours.
BUCKET = 64
# Texts that share a needed shingle are compared in blocks of about so many, and without further rounds if so few pairs are left.
BLOCK = 1024
FEW_PAIRS = 5_000_000
# Shingles whose frequency is known when sets are put in order; any number gives the same result.
COMMON = 1 << 16
# What a Python step on shingle sets holds at a time: bytes of text, or shingles.
_SET_BYTES = 512 * 1024
_SET_SHINGLES = 1 << 17
_SHINGLE_STEP = 1 << 18
# Row groups of the table of shingle sets.
_GROUP_BYTES = 8 * 1024 * 1024
# Longs in the parity sketch of a shingle set, at least; any power of two gives the same result.
PARITIES = 16
# A round that leaves more than this share of the pairs is the last one; any share gives the same result.
WORTH = 0.9


def _shingle_hashes(words: pa.Array, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles and, for each text, how many it has. A text of fewer words is one shingle."""
    per_text = np.diff(starts)
    counts = np.where(per_text == 0, 0, np.maximum(per_text - n + 1, 1))
    first = np.repeat(starts[:-1] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    short = np.repeat(per_text < n, counts)
    out = np.empty(len(first), dtype=np.uint64)
    at = np.flatnonzero(~short)
    for part in np.array_split(at, max(1, -(-len(at) // _SHINGLE_STEP))):
        shingles = pc.binary_join_element_wise(*[words.take(pa.array(first[part] + i)) for i in range(n)], " ")
        out[part] = hash_texts(shingles, HASH_SEED)
    if short.any():
        texts = np.repeat(np.arange(len(per_text)), counts)[short]
        joined = [" ".join(words.slice(starts[t], per_text[t]).to_pylist()) for t in texts]
        out[short] = hash_texts(pa.array(joined, pa.string()), HASH_SEED)
    return out, counts


def _set_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each run of hashes the 64-bit value whose bits are set in more than half of them."""
    result = np.zeros(len(counts), dtype=np.uint64)
    ends = np.cumsum(counts)
    some = np.flatnonzero(counts)
    step, at = 0, 0
    while at < len(some):
        upto = max(at + 1, int(np.searchsorted(ends[some], step + _SHINGLE_STEP, side="right")))
        group = some[at:upto]
        a, b = ends[group[0]] - counts[group[0]], ends[group[-1]]
        totals = np.zeros((len(group), BITS), dtype=np.int64)
        if len(group) == 1:
            for x in range(a, b, _SHINGLE_STEP):
                part = hashes[x : min(b, x + _SHINGLE_STEP)]
                bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                totals[0] += bits.sum(axis=0, dtype=np.int64)
        else:
            bits = np.unpackbits(hashes[a:b].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            totals = np.add.reduceat(bits, ends[group] - counts[group] - a, axis=0, dtype=np.int32)
        more = (2 * totals > counts[group][:, None]).astype(np.uint8)
        result[group] = np.packbits(more, axis=1, bitorder="little").view(np.uint64).ravel()
        step, at = b, upto
    return result


def fingerprints(docs: DataFrame, n: int) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long) for every row; texts without words, null included, have 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                words, starts = split_words(part.column("text"), lower=True)
                bits = _set_bits(*_shingle_hashes(words, starts, n))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(bits.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def _segment(x: Column, i: int, m: int) -> Column:
    """Segment ``i`` of the ring of ``m`` segments."""
    start, end = BITS * (i % m) // m, BITS * (i % m + 1) // m
    return F.shiftrightunsigned(x, start).bitwiseAND(F.lit((1 << (end - start)) - 1))


def _in_ring(difference: Column, max_bits: int, m: int) -> Column:
    """Does some start have every chain of consecutive segments within its proportional share of ``max_bits``?"""
    counts = [F.bit_count(_segment(difference, i, m)) for i in range(m)]
    starts = F.lit(False)
    for i in range(m):
        chain, total = F.lit(True), F.lit(0)
        for length in range(1, m + 1):
            total = total + counts[(i + length - 1) % m]
            chain = chain & (total <= length * max_bits // m)
        starts = starts | chain
    return starts


def linked(fps: DataFrame, max_bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Links ``a, b`` that join exactly the distinct values ``fp`` of ``fps`` which differ in at most ``max_bits`` (0 to 2)
    bits, directly or through others.

    The ring has ``max_bits + 2`` segments. A chain of three segments then has at most one difference and starts with an
    equal segment, so the first and the second or the first and the third are equal: these pairs of segments are the keys.
    Inside a bucket, pairs must pass the ring filter and then the full count. In a bucket of more than ``bucket`` values no
    pairs are formed: two values within 2 bits share a value within 1 bit of both, so each value is sent to itself and its
    64 neighbours, and the at most 65 values that meet at one place (all within 2 bits) are tied to the least.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2")
    fps = fps.select("fp").distinct()
    if max_bits == 0:
        return fps.where("false").select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    m = max_bits + 2
    pairs = sorted({tuple(sorted((i, (i + d) % m))) for i in range(m) for d in (1, 2)})
    keys = F.array(*[F.struct(F.lit(k).alias("k"), _segment(F.col("fp"), i, m).alias("x"), _segment(F.col("fp"), j, m).alias("y")) for k, (i, j) in enumerate(pairs)])
    keyed = fps.select("fp", F.explode(keys).alias("key")).select("fp", "key.*")
    full = keyed.groupBy("k", "x", "y").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    shared = stored(keyed.join(full, ["k", "x", "y"]), "simhash-buckets")

    few = shared.where(F.col("_n") <= bucket)
    pair = few.select("k", "x", "y", F.col("fp").alias("a")).join(few.select("k", "x", "y", F.col("fp").alias("b")), ["k", "x", "y"])
    difference = F.col("a").bitwiseXOR(F.col("b"))
    close = pair.where("a < b").where(_in_ring(difference, max_bits, m)).where(F.bit_count(difference) <= max_bits)

    many = shared.where(F.col("_n") > bucket).select("fp").distinct()
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63))) for b in range(BITS)])
    reach = 1 if max_bits == 2 else 0
    # With one bit allowed, only a value and the places of its neighbours that are values themselves count.
    met = many.select("fp", F.explode(flips).alias("place"))
    if reach:
        least = F.min("fp").over(Window.partitionBy("place"))
        star = met.withColumn("a", least).where("a <> fp").select("a", F.col("fp").alias("b"))
    else:
        star = met.join(many.select(F.col("fp").alias("place")), "place").where("place < fp").select(F.col("place").alias("a"), F.col("fp").alias("b"))
    return close.select("a", "b").union(star).distinct()


def near_duplicates(docs: DataFrame, n: int = 3, max_bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """One row per row of ``docs`` (``doc_id`` and ``text`` are read): ``doc_id, fp, component_id``.

    Texts are lower-cased (A-Z) and cut into words; a fingerprint bit is set if more than half of the ``n``-word shingles,
    repeats included, have it in their XXH64. Fewer words than ``n``: the whole sequence is the shingle; none (null, empty,
    blank): fingerprint 0, linked like any other. ``component_id`` is the least ``doc_id`` that links lead to, itself
    included; null only if all ids of the component are null. Rows that repeat an id belong together only if their
    fingerprints do. An empty table gives an empty result.

    Equal fingerprints collapse before any link is formed, so a group of copies costs one row.
    """
    prints = stored(fingerprints(docs, n), "simhash-prints")
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-classes")
    links = stored(linked(classes, max_bits, bucket), "simhash-links")
    found = components(links, "a", "b")
    # Components are of fingerprints; each is named by its least document.
    member = classes.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "least_id", F.coalesce("component", "fp").alias("component")
    )
    member = stored(member, "simhash-members")
    names = member.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_print = member.join(names, "component").select("fp", "component_id")
    return prints.join(of_print, "fp").select("doc_id", "fp", "component_id")


def _samples(hashes: np.ndarray, counts: np.ndarray, bins: int, size: int) -> np.ndarray:
    """For each text and bin (a residue of the shingles' hashes) the fingerprint of the ``size`` least distinct hashes."""
    group = np.repeat(np.arange(len(counts)), counts) * bins + (hashes % np.uint64(bins)).astype(np.int64)
    order = np.lexsort((hashes, group))
    group, hashes = group[order], hashes[order]
    new = np.ones(len(group), dtype=bool)
    new[1:] = (group[1:] != group[:-1]) | (hashes[1:] != hashes[:-1])
    group, hashes = group[new], hashes[new]
    first = np.searchsorted(group, np.arange(len(counts) * bins + 1))
    rank = np.arange(len(group)) - np.repeat(first[:-1], np.diff(first))
    chosen = rank < size
    return _set_bits(hashes[chosen], np.bincount(group[chosen], minlength=len(counts) * bins)).reshape(len(counts), bins)


def _parities(x: np.ndarray) -> np.ndarray:
    """Whether an odd number of the distinct hashes ``x`` falls to each place, as longs; at least a place per hash, ``PARITIES`` times
    64 or that doubled."""
    places = 64 * PARITIES
    while places < len(x):
        places *= 2
    odd = np.bincount(x & (places - 1), minlength=places) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _parity_difference(a: Column, b: Column) -> Column:
    """Bits in which two parity sketches differ, the longer one folded to the places of the shorter. Their sets differ in at least as
    many hashes."""
    n = F.least(F.size(a), F.size(b))

    def folded(x: Column) -> Column:
        none = F.array_repeat(F.lit(0).cast("long"), n)
        return F.aggregate(
            F.sequence(F.lit(1), F.size(x), n), none, lambda sums, at: F.zip_with(sums, F.slice(x, at, n), lambda u, v: u.bitwiseXOR(v))
        )

    bits = F.zip_with(folded(a), folded(b), lambda u, v: F.bit_count(u.bitwiseXOR(v)))
    return F.aggregate(bits, F.lit(0), lambda total, x: total + x)


def _verified(pairs: DataFrame, sketches: DataFrame, sets: DataFrame, min_similarity: float) -> DataFrame:
    """The ``pairs`` (``a, b``) whose whole shingle sets are similar enough. Sizes and parity sketches rule out nearly all others
    before whole sets are moved."""
    met = sized(pairs.select(F.col("a").alias("whole")).union(pairs.select("b")).distinct())
    sketches = sketches.join(met, "whole", "left_semi")
    side = [sketches.select(*[F.col(c).alias(f"{c}_{end}") for c in sketches.columns]) for end in ("a", "b")]
    met = pairs.join(side[0], F.col("a") == F.col("whole_a")).join(side[1], F.col("b") == F.col("whole_b"))
    # At similarity s, sets of x + y hashes differ in (1 - s) / (1 + s) of x + y, and their sizes differ by no more than that.
    most = F.lit((1 - min_similarity) / (1 + min_similarity)) * (F.col("size_a") + F.col("size_b")) + 1e-6
    met = met.where((F.abs(F.col("size_a") - F.col("size_b")) <= most) & (_parity_difference(F.col("parities_a"), F.col("parities_b")) <= most))
    close = stored(met.select("a", "b"), "simhash-close")

    ids = sized(close.select(F.col("a").alias("whole")).union(close.select("b")).distinct())
    sets = sets.join(ids, "whole", "left_semi")
    of_a = sets.select(F.col("whole").alias("a"), F.col("shingles").alias("of_a"))
    of_b = sets.select(F.col("whole").alias("b"), F.col("shingles").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    counted = close.join(of_a, "a").join(of_b, "b").select("a", "b", both.alias("both"), (F.size("of_a") + F.size("of_b")).alias("sum"))
    return counted.where(F.col("both") / (F.col("sum") - F.col("both")) >= min_similarity).select("a", "b")


def _common(sets: DataFrame) -> np.ndarray:
    """Shingles that many sets hold, the most frequent last, from one set in 16. They only set an order: results don't depend
    on them."""
    some = sets.where(F.pmod(F.xxhash64("whole"), F.lit(16)) == 0).select(F.explode("shingles").alias("shingle"))
    counted = some.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 3")
    rows = counted.orderBy(F.desc("n"), "shingle").limit(COMMON).toArrow()
    return rows["shingle"].to_numpy()[::-1].astype(np.int64)


def _prefixes(sets: DataFrame, found: DataFrame, min_similarity: float) -> DataFrame:
    """``whole, size, shingle, pos``: of each set the shingles one of which any similar set shares, with their place.

    In one order for all sets, common shingles last, sets of ``size`` shingles that have ``c`` or more in common with another
    share one of their first ``size - c + 1``. Only shingles that sets of several components in ``found`` have there are kept:
    components only grow, so no other shingle is needed again, and copies make up most of the others.
    """
    last = _common(sets)
    by_value = np.argsort(last)
    values = last[by_value]

    def prefix(x: np.ndarray) -> np.ndarray:
        rank = np.zeros(len(x), dtype=np.int64)
        if len(values):
            at = np.minimum(np.searchsorted(values, x), len(values) - 1)
            rank = np.where(values[at] == x, by_value[at] + 1, 0)
        return x[np.lexsort((x, rank))[: len(x) - math.ceil(min_similarity * len(x) - 1e-9) + 1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in list_slices(batch, "shingles", _SET_SHINGLES):
                lengths = pc.list_value_length(part.column("shingles")).to_numpy()
                flat, ends = part.column("shingles").flatten().to_numpy(), np.cumsum(lengths)
                found = [prefix(flat[e - n : e]) for e, n in zip(ends, lengths)]
                counts = np.array([len(x) for x in found])
                places = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(part.column("whole").to_numpy(), counts)), pa.array(np.repeat(lengths, counts)),
                     pa.array(np.concatenate(found)), pa.array(places.astype(np.int32))],
                    ["whole", "size", "shingle", "pos"],
                )
        pa.default_memory_pool().release_unused()

    rows = sets.select("whole", "shingles").mapInArrow(run, "whole long, size int, shingle long, pos int")
    named = rows.select("whole", "shingle").join(sized(found), F.col("whole") == F.col("node"), "left")
    component = F.coalesce("component", "whole")
    ends = named.groupBy("shingle").agg(F.min(component).alias("low"), F.max(component).alias("high"))
    shared = ends.where("low <> high").select("shingle")
    return rows.join(sized(stored(shared, "simhash-shared")), "shingle").select("whole", "size", "shingle", "pos")


def _apart(prefixes: DataFrame, found: DataFrame) -> DataFrame:
    """``prefixes`` with their sets' ``component`` and ``n``, the members of the shingle's group; only groups that hold sets of
    several components."""
    named = prefixes.join(found, F.col("whole") == F.col("node"), "left").select(
        *prefixes.columns, F.coalesce("component", "whole").alias("component")
    )
    groups = named.groupBy("shingle").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n")
    )
    return stored(named.join(groups.where("low <> high").select("shingle", "n"), "shingle"), "simhash-apart")


def _pairs_left(apart: DataFrame) -> float:
    """Pairs that the groups make: a group of n rows makes n ** 2 / 2; each of its rows carries n."""
    return (apart.agg(F.sum("n")).first()[0] or 0) / 2


def _possible(a: str, b: str, min_similarity: float) -> Column:
    """Can the sets of two prefix rows be similar, this shingle being the first that they share? A similar pair passes at the
    first shingle that it does share."""
    x, y = F.col(f"{a}.size"), F.col(f"{b}.size")
    rest = F.least(x - F.col(f"{a}.pos"), y - F.col(f"{b}.pos"))
    least = F.lit(min_similarity / (1 + min_similarity)) * (x + y) - 1e-9
    return (F.col(f"{a}.component") != F.col(f"{b}.component")) & (rest >= least)


def _hub_pairs(apart: DataFrame, turn: int, min_similarity: float) -> DataFrame:
    """Pairs ``a, b`` of each set with one member of every group, another one each ``turn``."""
    hub = F.min(F.struct(F.xxhash64("whole", "shingle", F.lit(turn)).alias("h"), "whole", "size", "pos", "component"))
    hubs = apart.groupBy("shingle").agg(hub.alias("y"))
    met = apart.select("shingle", F.struct("whole", "size", "pos", "component").alias("x")).join(hubs, "shingle")
    pairs = met.where(_possible("x", "y", min_similarity))
    return pairs.select(F.least("x.whole", "y.whole").alias("a"), F.greatest("x.whole", "y.whole").alias("b")).distinct()


def _all_pairs(apart: DataFrame, min_similarity: float, block: int) -> DataFrame:
    """All pairs ``a, b`` of sets of different components in a group. Large groups are cut into blocks of about ``block``
    members and joined block by block, so no task owns a group."""
    blocks = F.ceil(F.col("n") / block).cast("int")
    cut = apart.withColumn("own", F.pmod(F.xxhash64("whole"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))
    )
    side = F.struct("whole", "size", "pos", "component")
    x = cut.select("shingle", F.col("own").alias("i"), F.col("other").alias("j"), side.alias("x"))
    y = cut.select("shingle", F.col("other").alias("i"), F.col("own").alias("j"), side.alias("y"))
    pairs = x.join(y, ["shingle", "i", "j"]).where(F.col("x.whole") < F.col("y.whole")).where(_possible("x", "y", min_similarity))
    return pairs.select(F.col("x.whole").alias("a"), F.col("y.whole").alias("b")).distinct()


def similar_duplicates(
    docs: DataFrame, n: int = 5, max_bits: int = 2, min_similarity: float = 0.8, bins: int = 10, sample: int = 3,
    block: int = BLOCK, few_pairs: int = FEW_PAIRS,
) -> DataFrame:
    """One row per row of ``docs`` (``doc_id`` and ``text`` are read): ``doc_id, th, component, component_id``, by similarity.
    ``th`` is ``text_hash`` of the text, ``component`` names the component also where all of its ids are null.

    Texts belong together if their sets of ``n``-word shingles have a Jaccard similarity of at least ``min_similarity``,
    directly or through others; the result is that of a comparison of all pairs. Equal sets collapse. The links of ``linked``
    between whole fingerprints and equal fingerprints of samples (shingles fall into ``bins`` by their hash, and in each bin
    the ``sample`` least hashes make a fingerprint) tie each text to one of its group and so join most copies at little cost.
    What they miss is then looked for among the shingles of which similar sets must share one (``_prefixes``), and only where
    such a shingle's texts are in several components: while that makes more than ``few_pairs`` pairs, each text meets one
    other text of the group per round, and when a round spares few pairs (``WORTH``) or few are left, all of them are formed. All
    links are verified on the whole shingle sets, those first ruled out whose sketches already differ too much (``_parities``).

    Nulls, blanks, repeated ids and the empty table as in ``near_duplicates``, with sets in place of fingerprints.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", _SET_BYTES):
                hashes, counts = _shingle_hashes(*split_words(part.column("text"), lower=True), n)
                whole, samples = _set_bits(hashes, counts), _samples(hashes, counts, bins, sample)
                ends = np.cumsum(counts)
                own = [np.unique(hashes[e - c : e]).view(np.int64) for e, c in zip(ends, counts)]
                keys = np.fromiter((xxhash.xxh64_intdigest(x.tobytes(), HASH_SEED) for x in own), np.uint64, len(own))
                lists = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("th"), pa.array(whole.view(np.int64)), pa.array(list(samples.view(np.int64)), lists),
                     pa.array(keys.view(np.int64)), pa.array([_parities(x) for x in own], lists), pa.array(own, lists)],
                    ["doc_id", "th", "fp", "samples", "whole", "parities", "shingles"],
                )
        # The worker is kept for later tasks; what it held is not.
        pa.default_memory_pool().release_unused()

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(F.col("text")).alias("th"), "text")
    made = read.mapInArrow(run, "doc_id long, th long, fp long, samples array<long>, whole long, parities array<long>, shingles array<long>")
    prints = stored(made.withColumn("row", F.monotonically_increasing_id()), "simhash-prints", _GROUP_BYTES)
    classes = stored(prints.groupBy("whole").agg(F.min("doc_id").alias("least_id"), F.min("row").alias("row")), "simhash-classes")
    of_class = prints.join(sized(classes.select("row")), "row", "left_semi").where(F.size("shingles") > 0)
    # Sets are read from the one stored copy each time.
    sets = of_class.select("whole", "shingles")
    keyed = stored(of_class.select("whole", "fp", "samples", F.size("shingles").alias("size"), "parities"), "simhash-keys")
    sketches = keyed.select("whole", "size", "parities")

    by_print = keyed.groupBy("fp").agg(F.min("whole").alias("first"))
    near = linked(keyed, max_bits)
    for end in ("a", "b"):
        near = near.join(by_print.select(F.col("fp").alias(end), F.col("first").alias(f"{end}_set")), end)
    binned = keyed.select("whole", F.posexplode("samples").alias("bin", "print")).where("print <> 0").unionByName(
        keyed.select("whole", F.lit(-1).alias("bin"), F.col("fp").alias("print"))
    )
    groups = binned.groupBy("bin", "print").agg(F.min("whole").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    alike = binned.join(groups, ["bin", "print"]).where("whole <> first").select(F.col("first").alias("a"), F.col("whole").alias("b"))
    pairs = near.select(F.least("a_set", "b_set").alias("a"), F.greatest("a_set", "b_set").alias("b")).union(alike).distinct()
    links = stored(_verified(stored(pairs, "simhash-candidates"), sketches, sets, min_similarity), "simhash-links")
    found = stored(components(links, "a", "b"), "simhash-components")

    prefixes = stored(_prefixes(sets, found, min_similarity), "simhash-prefixes")
    turn, apart = 0, _apart(prefixes, found)
    left, before = _pairs_left(apart), math.inf
    while left > few_pairs and left <= WORTH * before:
        turn += 1
        more = stored(_verified(stored(_hub_pairs(apart, turn, min_similarity), "simhash-candidates"), sketches, sets, min_similarity), "simhash-links")
        if more.isEmpty():
            break
        ties = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = stored(components(ties.unionByName(more), "a", "b"), "simhash-components")
        apart = _apart(prefixes, found)
        left, before = _pairs_left(apart), left
    rest = stored(_all_pairs(apart, min_similarity, block), "simhash-candidates")
    more = stored(_verified(rest, sketches, sets, min_similarity), "simhash-links")
    if not more.isEmpty():
        ties = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = components(ties.unionByName(more), "a", "b")

    member = classes.join(found, F.col("whole") == F.col("node"), "left").select(
        "whole", "least_id", F.coalesce("component", "whole").alias("component")
    )
    member = stored(member, "simhash-members")
    names = member.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_set = member.join(names, "component").select("whole", "component", "component_id")
    return prints.select("doc_id", "th", "whole").join(of_set, "whole").select("doc_id", "th", "component", "component_id")


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Of each component that ``similar_duplicates`` found among ``docs`` one row: the least ``doc_id`` (null last), then the least hash
    of its text. Of rows that repeat both id and text one stays."""
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("_id"), F.col("th").alias("_th"))
    counted = found.groupBy("component", "doc_id", "th").agg(F.count(F.lit(1)).alias("_n"))
    first = counted.groupBy("component").agg(F.min_by(F.struct(row.alias("r"), "_n"), row).alias("f"))
    winners = sized(stored(first.select("f.r._id", "f.r._th", "f._n"), "simhash-winners"))
    rows = docs.select(F.struct("*").alias("row"))
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("_id")) & (text_hash(F.col("row.text")) == F.col("_th"))
    kept = rows.join(winners, same)
    lone, repeated = kept.where("_n = 1").select("row"), kept.where("_n > 1")
    return lone.unionByName(repeated.groupBy("_id", "_th").agg(F.any_value("row").alias("row")).select("row")).select("row.*")
