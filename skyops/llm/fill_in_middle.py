"""Fill-in-the-middle transformation, cut at token boundaries that a compressed set holds."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyops.llm.common import text_slices

SEED = 42
FIM_PERCENT, SPM_PERCENT = 50, 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# A container holds the positions that share all but their last 16 bits, as an array up to this many.
_LOW_BITS = 16
_ARRAY_LIMIT = 4096


@dataclass(frozen=True)
class _Array:
    values: np.ndarray

    def select(self, k: int) -> int:
        return int(self.values[k])


@dataclass(frozen=True)
class _Bitmap:
    words: np.ndarray
    before: np.ndarray  # members in the words up to and with each

    @classmethod
    def of(cls, values: np.ndarray) -> _Bitmap:
        bits = np.zeros(1 << _LOW_BITS, dtype=np.uint8)
        bits[values] = 1
        words = np.packbits(bits, bitorder="little").view(np.uint64)
        return cls(words, np.cumsum(np.bitwise_count(words), dtype=np.int64))

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, side="right"))
        left = k - (int(self.before[word - 1]) if word else 0)
        bits = np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little")
        return 64 * word + int(np.flatnonzero(bits)[left])


@dataclass(frozen=True)
class _Runs:
    starts: np.ndarray
    before: np.ndarray  # members in the runs up to and with each

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, side="right"))
        return int(self.starts[run]) + k - (int(self.before[run - 1]) if run else 0)


def _container(values: np.ndarray) -> _Array | _Bitmap | _Runs:
    """The smallest form of some ascending 16-bit values."""
    breaks = np.flatnonzero(np.diff(values) != 1) + 1
    size = 2 * len(values) if len(values) <= _ARRAY_LIMIT else 1 << (_LOW_BITS - 3)
    if 4 * (len(breaks) + 1) < size:
        return _Runs(values[np.concatenate(([0], breaks))].astype(np.uint16), np.concatenate((breaks, [len(values)])))
    return _Array(values.astype(np.uint16)) if len(values) <= _ARRAY_LIMIT else _Bitmap.of(values)


class BoundarySet:
    """Ascending positions in containers by their high bits, with the members up to each container; ``select`` finds the k-th by a
    search of the containers and one inside."""

    def __init__(self, positions: np.ndarray):
        high = positions >> _LOW_BITS
        self.keys, first = np.unique(high, return_index=True)
        ends = np.append(first[1:], len(positions))
        self.upto = ends
        self.containers = [_container(positions[a:b] & ((1 << _LOW_BITS) - 1)) for a, b in zip(first, ends)]

    def __len__(self) -> int:
        return int(self.upto[-1]) if len(self.upto) else 0

    def select(self, k: int) -> int:
        """The member that ``k`` members are below."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.upto, k, side="right"))
        inside = k - (int(self.upto[at - 1]) if at else 0)
        return (int(self.keys[at]) << _LOW_BITS) + self.containers[at].select(inside)


def boundaries(texts: pa.Array, unit: str = "token") -> Iterator[np.ndarray]:
    """For each text the ascending positions (in code points) at which its units end.

    A ``token`` is a word with the white space before it, or the white space at the end; ``char`` is a code point.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    if unit == "char":
        for a, b in zip(offsets, offsets[1:]):
            yield np.arange(1, points[b] - points[a] + 1)
        return
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    ends = np.zeros(len(data), dtype=bool)
    ends[:-1] = ~space[:-1] & space[1:]
    ends[offsets[1:][offsets[1:] > offsets[:-1]] - 1] = True
    at = np.flatnonzero(ends) + 1
    lo, hi = np.searchsorted(at, offsets[:-1], side="right"), np.searchsorted(at, offsets[1:], side="right")
    for a, i, j in zip(offsets, lo, hi):
        yield points[at[i:j]] - points[a]


def _draw(digest: Column, i: int) -> Column:
    """The ``i``-th group of eight hex digits as a number."""
    return F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")


def restore(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of."""
    after = lambda text, mark: F.substr(text, F.locate(mark, text) + len(mark))
    before = lambda text, mark: F.substr(text, F.lit(1), F.locate(mark, text) - 1)
    psm = F.concat(before(after(output, PREFIX), SUFFIX), after(output, MIDDLE), before(after(output, SUFFIX), MIDDLE))
    spm = F.concat(before(after(output, PREFIX), MIDDLE), after(output, MIDDLE), before(after(output, SUFFIX), PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def unmarked(text: Column) -> Column:
    """Does the text hold none of the marks?"""
    return ~(F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE)))


def fill_in_middle(
    docs: DataFrame, unit: str = "token", seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT
) -> DataFrame:
    """``doc_id, text, n, form, prefix_chars, middle_chars, output`` for every row of ``docs``.

    A text of ``n`` units is cut at two places drawn from a hash of seed and id, and its parts are put in the order prefix,
    suffix, middle (``psm``) or suffix, prefix, middle (``spm``) with a mark before each. ``plain`` texts stay as they are:
    the empty ones, those that hold a mark, so that ``restore`` always works, and those not drawn. Null texts are empty. A null
    id draws like an empty one; rows that repeat an id share its draws. An empty table gives an empty result.

    A task holds the boundaries of a slice of texts; both cuts are looked up in the text's boundary set.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                sizes, starts, ends = [], [], []
                for found, a, b in zip(boundaries(part.column("text"), unit), part.column("a").to_pylist(), part.column("b").to_pylist()):
                    members = BoundarySet(found)
                    n = len(members)
                    low, high = sorted((a % (n + 1), b % (n + 1)))
                    sizes.append(n)
                    starts.append(members.select(low - 1) if low else 0)
                    ends.append(members.select(high - 1) if high else 0)
                made = [pa.array(x, pa.int64()) for x in (sizes, starts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text"), part.column("digest"), *made], ["doc_id", "text", "digest", "n", "cut", "end"]
                )

    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), digest.alias("digest"),
    ).withColumns({"a": _draw(F.col("digest"), 0), "b": _draw(F.col("digest"), 1)})
    cut = read.mapInArrow(run, "doc_id long, text string, digest string, n long, cut long, end long")
    text, digest = F.col("text"), F.col("digest")
    moved = (text != "") & unmarked(text) & (_draw(digest, 2) % 100 < fim_percent)
    form = F.when(~moved, F.lit("plain")).when(_draw(digest, 3) % 100 < spm_percent, F.lit("spm")).otherwise(F.lit("psm"))
    start, end = F.col("cut").cast("int"), F.col("end").cast("int")
    prefix, middle = F.substr(text, F.lit(1), start), F.substr(text, start + 1, end - start)
    suffix = F.substr(text, end + 1)
    mark = {m: F.lit(m) for m in (PREFIX, SUFFIX, MIDDLE)}
    output = (
        F.when(F.col("form") == "plain", text)
        .when(F.col("form") == "spm", F.concat(mark[SUFFIX], suffix, mark[PREFIX], prefix, mark[MIDDLE], middle))
        .otherwise(F.concat(mark[PREFIX], prefix, mark[SUFFIX], suffix, mark[MIDDLE], middle))
    )
    plain = F.col("form") == "plain"
    return cut.withColumn("form", form).select(
        "doc_id", "text", "n", "form", F.when(~plain, F.col("cut")).alias("prefix_chars"),
        F.when(~plain, F.col("end") - F.col("cut")).alias("middle_chars"), output.alias("output"),
    )
