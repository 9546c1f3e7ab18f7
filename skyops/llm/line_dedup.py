"""Line dedup by a deletion-neighbourhood join. DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyops.llm.common import BROADCAST_BYTES, SPACE_RUN, SPACES, ascii_lower, stored, text_hash
from skyops.operators.skew import is_small

# Every line with a word is compared; from EDIT_WORDS words, where four of five agree, lines may also differ by one word.
MIN_WORDS = 1
EDIT_WORDS = 5
# Word hashes of 40 bits: the sum over a line of 8 million words still fits into a long.
_MASK = (1 << 40) - 1

_AT = ["doc_id", "th", "line_no"]


def _normal(lines: Column) -> Column:
    """The words of each of an array of lines, A-Z lower-cased, with single spaces.

    Most lines have single blanks only, and many are ASCII, where the plain lower-casing is the same and quicker. Each step
    is an array of its own, so that later ones don't work it out again.
    """
    other = SPACES.replace(" ", "").replace("\n", "")
    odd = lambda x: reduce(lambda a, b: a | b, [F.contains(x, F.lit(s)) for s in ("  ", *other)])
    flat = F.transform(lines, lambda x: F.when(odd(x), F.regexp_replace(x, SPACE_RUN, " ")).otherwise(x))
    plain = lambda x: F.octet_length(x) == F.length(x)
    return F.transform(flat, lambda x: F.btrim(F.when(plain(x), F.lower(x)).otherwise(ascii_lower(x)), F.lit(SPACES)))


def _word_count(normal: Column) -> Column:
    return F.when(F.length(normal) == 0, 0).otherwise(F.size(F.split(normal, " ")))


def eligible_lines(docs: DataFrame, min_words: int, edit_words: int) -> DataFrame:
    """``doc_id, th, line_no`` (from 0), two 64-bit hashes of the normalised line, its words, and hashes of its halves.

    ``halves``: two lines within one word edit, the shorter of m words, agree in their first m // 2 or in their last m // 2
    words; m is the line's own length or one less.
    """
    lines = docs.select("doc_id", text_hash(F.col("text")).alias("th"), F.posexplode(_normal(F.split("text", "\n"))).alias("line_no", "line"))
    normal = lines.withColumn("words", _word_count(F.col("line")))
    half = lambda n, side: F.xxhash64(
        F.lit(side), n, F.call_function("substring_index", F.col("line"), F.lit(" "), n * side)
    )
    longer = F.floor(F.col("words") / 2).cast("int")
    own, less = [half(longer, 1), half(longer, -1)], [half(longer - 1, 1), half(longer - 1, -1)]
    halves = F.array_distinct(F.when(F.col("words") % 2 == 1, F.array(*own)).otherwise(F.array(*own, *less)))
    return normal.where(F.col("words") >= min_words).select(
        *_AT, F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"), "words",
        F.when(F.col("words") >= edit_words, halves).alias("halves"),
    )


def _variants(lines: DataFrame) -> DataFrame:
    """The deletion neighbourhood of each line: ``_AT, v1, v2, i``, the line without its word ``i`` (from 1), whole at 0.

    A variant's key is the sum over its words of hashes of (word, place). Without word i, earlier words keep their place and
    later ones move up by one, so running sums give all variants of a line in linear time.
    """
    words = lines.select(*_AT, F.posexplode(F.split("line", " ")).alias("p", "w"))
    place = lambda seed, shift: F.xxhash64(F.lit(seed), "w", F.col("p") + 1 - shift).bitwiseAND(F.lit(_MASK))
    by_line = Window.partitionBy(*_AT).orderBy("p")
    before, totals = by_line.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*_AT)
    sum_of = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0).cast("long"))
    hashed = words.select(*_AT, "p", *[place(s, d).alias(f"g{s}{d}") for s in (1, 2) for d in (0, 1)])
    summed = hashed.select(
        *_AT, "p",
        *[(sum_of(f"g{s}0", before) + F.sum(f"g{s}1").over(totals) - sum_of(f"g{s}1", before) - F.col(f"g{s}1")).alias(f"v{s}") for s in (1, 2)],
        *[F.sum(f"g{s}0").over(totals).alias(f"w{s}") for s in (1, 2)],
    )
    gone = F.struct(F.col("v1"), F.col("v2"), (F.col("p") + 1).alias("i"))
    whole = F.struct(F.col("w1").alias("v1"), F.col("w2").alias("v2"), F.lit(0).alias("i"))
    both = F.when(F.col("p") == 0, F.array(gone, whole)).otherwise(F.array(gone))
    return summed.select(*_AT, F.explode(both).alias("v")).select(*_AT, "v.*")


def _near_links(variants: DataFrame) -> DataFrame:
    """``_AT, i, witness, j``: a line without its word ``i`` has the key of an earlier line without its word ``j``.

    Lines that differ in word i share the key at i: all that share it are within one edit of each other, so each is linked to
    the earliest only. A line with one word more than another has, at some i, the other's whole key (j = 0): distinct lines
    have distinct whole keys, so one line answers to each key. No pairs are formed inside a group.
    """
    at = F.struct(*_AT)
    grouped = variants.groupBy("v1", "v2", "i").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n"))
    several = grouped.where("n > 1 AND i > 0").select("v1", "v2", "i", "first")
    same_place = variants.join(several, ["v1", "v2", "i"]).where(at != F.col("first")).select(
        *_AT, "i", F.col("first").alias("witness"), F.col("i").alias("j")
    )
    whole = variants.where("i = 0").select("v1", "v2", at.alias("whole"))
    # The earliest line that has the whole line's words and one more answers for all of them.
    one_more = variants.where("i > 0").join(whole, ["v1", "v2"])
    later = one_more.where(at > F.col("whole")).select(*_AT, "i", F.col("whole").alias("witness"), F.lit(0).alias("j"))
    earlier = one_more.where(at < F.col("whole")).groupBy("whole").agg(F.min(F.struct(at.alias("at"), "i")).alias("m")).select(
        "whole.*", F.lit(0).alias("i"), F.col("m.at").alias("witness"), F.col("m.i").alias("j")
    )
    return same_place.unionByName(later).unionByName(earlier)


def _without(words: Column, i: Column) -> Column:
    return F.when(i == 0, words).otherwise(F.concat(F.slice(words, F.lit(1), i - 1), F.slice(words, i + 1, F.size(words))))


def _marks(places: DataFrame) -> DataFrame:
    """``_id, _th, _marks``: per text a byte string with a 1 at the number of each of the lines, 0 between. Reading a byte of
    it takes the same time wherever it stands."""
    numbers = places.groupBy("doc_id", "th").agg(F.sort_array(F.collect_set("line_no")).alias("nos"))
    before = F.concat(F.array(F.lit(-1)), F.slice("nos", F.lit(1), F.size("nos") - 1))
    parts = F.zip_with("nos", before, lambda n, b: F.concat(F.repeat(F.lit("0"), n - b - 1), F.lit("1")))
    marks = F.array_join(parts, "").cast("binary").alias("_marks")
    made = stored(numbers.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), marks), "lines-marks")
    return F.broadcast(made) if is_small(made.withColumn("_marks", F.col("_marks").cast("string")), BROADCAST_BYTES) else made


def _marked(line_no: Column) -> Column:
    return F.coalesce(F.substring(F.col("_marks"), line_no + 1, F.lit(1)) == F.lit(b"1"), F.lit(False))


def _edited(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """Places (``_AT``) of first lines that are one word edit from an earlier first line."""
    long_lines = firsts.where("halves IS NOT NULL").select(*_AT, F.explode("halves").alias("half"))
    shared = long_lines.groupBy("half").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("half")
    # Only lines that share a half with another line can have a partner; for the rest no neighbourhood is made.
    candidates = stored(long_lines.join(shared, "half", "left_semi").select(*_AT).distinct(), "lines-candidates")
    whole = docs.select("doc_id", text_hash(F.col("text")).alias("th"), "text")
    near = whole.join(_marks(candidates), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")))
    numbered = F.transform(F.split("text", "\n"), lambda line, n: F.struct(n.alias("line_no"), line.alias("line")))
    marked = near.select("doc_id", "th", F.filter(numbered, lambda x: _marked(x["line_no"])).alias("l"))
    lines = marked.select("doc_id", "th", F.inline(F.arrays_zip(F.col("l.line_no").alias("line_no"), _normal(F.col("l.line")).alias("line"))))
    lines = stored(lines.dropDuplicates(_AT), "lines-texts")
    links = stored(_near_links(stored(_variants(lines), "lines-variants")), "lines-links")

    # Equal keys are verified on the words themselves.
    own = lines.select(F.struct(*_AT).alias("_own"), F.split("line", " ").alias("own"))
    other = lines.select(F.struct(*_AT).alias("_other"), F.split("line", " ").alias("other"))
    at = links.select(F.struct(*_AT).alias("at"), "i", "witness", "j")
    pairs = at.join(own, F.col("at").eqNullSafe(F.col("_own"))).join(other, F.col("witness").eqNullSafe(F.col("_other")))
    verified = pairs.where(_without(F.col("own"), F.col("i")) == _without(F.col("other"), F.col("j")))
    return verified.select("at.*").distinct()


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, edit_words: int = EDIT_WORDS) -> DataFrame:
    """``doc_id, th, line_no`` of the lines that repeat an earlier line; ``th`` is ``text_hash`` of the text."""
    lines = stored(eligible_lines(docs, min_words, edit_words), "lines")
    at = F.struct(*_AT)
    firsts = lines.groupBy("h1", "h2").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n"), F.any_value("halves").alias("halves"))
    firsts = stored(firsts, "lines-firsts")
    several = firsts.where("n > 1").select("h1", "h2", "first")
    copies = lines.join(several, ["h1", "h2"]).where(~at.eqNullSafe(F.col("first"))).select(*_AT)
    return copies.unionByName(_edited(docs, firsts.select("first.*", "halves"))).distinct()


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, edit_words: int = EDIT_WORDS) -> DataFrame:
    """``docs`` with ``text`` rid of the lines that repeat an earlier line, plus ``n_lines`` and ``n_dropped``.

    Lines (split at ``\\n``) are compared by their words, A-Z lower-cased. A line of at least ``min_words`` words goes if an
    earlier line of any document has the same words; one of at least ``edit_words`` words also if it becomes an earlier such
    line by one edit (one word replaced, put in or taken out). Earlier: smaller ``doc_id`` (null first), then place in the
    text. A line counts as earlier whether or not it is kept itself. The lines kept stay as they are, joined by ``\\n``.

    A null text stays null with 0 lines, an empty one has one empty line. Rows that repeat both id and text are one document
    and keep the same lines; rows that repeat the id only are ordered by a hash of the text. All other columns are carried
    along, but ``n_lines`` and ``n_dropped`` replace columns of these names. An empty table gives an empty result.
    """
    drops = stored(repeated_lines(docs, min_words, edit_words), "lines-dropped")
    rows = docs.select(F.struct("*").alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("_id")) & (text_hash(F.col("row.text")) == F.col("_th"))
    joined = rows.join(_marks(drops), same, "left").select("row", "_marks", F.col("row.text").alias("text"))
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda line, n: ~_marked(n))
    text = F.when(F.col("_marks").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines))
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return joined.select(
        *[text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in names],
        n_lines.cast("long").alias("n_lines"),
        F.when(F.col("_marks").isNull(), 0).otherwise(F.length(F.replace(F.col("_marks").cast("string"), F.lit("0")))).cast("long")
        .alias("n_dropped"),
    )
