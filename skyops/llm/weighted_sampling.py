"""Document fingerprints by consistent weighted sampling."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyops.llm.common import hash_texts, split_words, stored, text_slices

SAMPLES = 64
SEED = 42
# A sample is kept as so many hex digits; 0 is kept for texts without a word.
_DIGITS = 4
_TOP = np.uint64(1 << 32)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit value for each 64-bit value."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniforms(keys: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers strictly between 0 and 1 for each key."""
    x = _mixed(keys + np.uint64((turn * 0x9E3779B97F4A7C15) & ((1 << 64) - 1)))
    return ((x >> np.uint64(32)) + 0.5) / 2.0**32, ((x & (_TOP - np.uint64(1))) + 0.5) / 2.0**32


def draws(keys: np.ndarray, weights: np.ndarray, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """For each weighted term its rank in one sample (the least wins) and the level its weight falls to.

    Rate and rank are gamma(2, 1) variates of the term and the sample alone; levels are e to the multiples of the rate, moved
    by a uniform share. Weights between two levels draw alike, which makes the sample consistent.
    """
    (a, b), (c, d), (shift, _) = (_uniforms(keys, 3 * sample + i) for i in range(3))
    rate, rank = -np.log(a * b), -np.log(c * d)
    level = np.floor(np.log(weights) / rate + shift)
    return np.log(rank) - rate * (level - shift) - rate, level.astype(np.int64)


def signatures(keys: np.ndarray, weights: np.ndarray, counts: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """One row of ``samples`` 16-bit values for each run of ``counts`` weighted terms (64-bit ``keys``, ``weights`` above 0).

    Two rows agree at a place with the chance min-sum / max-sum of their weights, but for 1 in 65,535. No terms: zeros.
    """
    result = np.zeros((len(counts), samples), dtype=np.uint16)
    some = np.flatnonzero(counts)
    if not len(some):
        return result
    first = (np.cumsum(counts) - counts)[some]
    # A term of one weight draws alike in all texts: worked out once.
    names, name_at = np.unique(keys, return_inverse=True)
    sizes, size_at = np.unique(weights, return_inverse=True)
    distinct, place = np.unique(name_at * len(sizes) + size_at, return_inverse=True)
    terms, weighed = names[distinct // len(sizes)], sizes[distinct % len(sizes)]
    for k in range(samples):
        rank, level = draws(terms, weighed, k)
        # Rank above, name of the sample below: one minimum finds both.
        bits = rank.astype(np.float32).view(np.uint32)
        bits = np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31)).astype(np.uint64)
        name = _mixed(terms ^ _mixed(level.astype(np.uint64) + np.uint64(k << 32))) >> np.uint64(32)
        best = np.minimum.reduceat(((bits << np.uint64(32)) | name)[place], first)
        result[some, k] = (best & (_TOP - np.uint64(1))) % np.uint64(65535) + np.uint64(1)
    return result


def text_signatures(texts: pa.Array, samples: int = SAMPLES) -> np.ndarray:
    """Signatures of texts: terms are words, lower-cased (A-Z), weights their counts."""
    words, starts = split_words(texts, lower=True)
    coded = words.dictionary_encode()
    if not len(words):
        return np.zeros((len(texts), samples), dtype=np.uint16)
    keys = hash_texts(coded.dictionary, SEED)
    size = len(keys)
    text = np.repeat(np.arange(len(texts)), np.diff(starts))
    held, counts = np.unique(text * size + coded.indices.to_numpy(), return_counts=True)
    return signatures(keys[held % size], counts.astype(np.float64), np.bincount(held // size, minlength=len(texts)), samples)


def _hex(rows: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in rows.astype(">u2")]


def _values(fingerprints: pa.Array) -> np.ndarray:
    return np.array([np.frombuffer(bytes.fromhex(f), dtype=">u2") for f in fingerprints.to_pylist()])


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """``doc_id, fingerprint`` for every row: ``samples`` times four hex digits. Two fingerprints agree in the share of places
    that is the generalised Jaccard similarity of the word counts, give or take sqrt(s (1 - s) / samples).

    Null, empty and blank texts have the fingerprint of zeros. Rows that repeat an id are rows of their own. An empty table
    gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                prints = pa.array(_hex(text_signatures(part.column("text"), samples)), pa.string())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), prints], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fingerprint string")


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal samples of each pair of rows."""
    return (a == b).mean(axis=1)


def edited(text: str, donor: str) -> str:
    """``text`` with its last half replaced by as much of the start of ``donor``."""
    half = len(text) // 2
    return text[: len(text) - half] + donor[:half]


_COMPARED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(ids: pa.Array, texts: list[str], own: np.ndarray, donors: list[str], donated: np.ndarray) -> list[pa.Array]:
    """Columns of ``_COMPARED`` for texts and the texts after them."""
    made = [edited(t, d) for t, d in zip(texts, donors)]
    changed = text_signatures(pa.array(made, pa.string()), own.shape[1])
    return [
        ids, pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in made], pa.string()),
        pa.array(_hex(own), pa.string()), pa.array(_hex(changed), pa.string()),
        pa.array(likeness(own, changed)), pa.array(likeness(own, donated)),
    ]


def compare_with_next(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """For every row its fingerprint, that of its edited text (the last half replaced by the start of the next row's text), and
    its likeness to the edited text's and to the next row's.

    Rows come in ascending order of ``doc_id`` (null first; rows that repeat an id by a hash of their text), and the first one
    follows the last. Null texts are empty. A single row is its own next. An empty table gives an empty result.

    Rows are sorted by ranges and compared while they stream, one slice of text at a time. Only the first and the last row of a
    range are written with their text and meet in a second, small job.
    """
    names = [field.split()[0] for field in _COMPARED.split(", ")]
    nothing = {name: pa.nulls(1, t) for name, t in zip(names, [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2])}

    def end(kind: str, part: int, ident: pa.Array, text: str, own: np.ndarray) -> pa.RecordBatch:
        columns = nothing | {"doc_id": ident, "fingerprint": pa.array(_hex(own), pa.string())}
        extra = [pa.array([kind]), pa.array([part], pa.int32()), pa.array([text], pa.string())]
        return pa.RecordBatch.from_arrays([*columns.values(), *extra], [*names, "kind", "part", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, number = None, 0
        for batch in batches:
            for part in text_slices(batch, "text"):
                number = part.column("part")[0].as_py()
                ids, texts = part.column("doc_id"), [t or "" for t in part.column("text").to_pylist()]
                own = text_signatures(part.column("text"), samples)
                if last is None:
                    yield end("first", number, ids[:1], texts[0], own[:1])
                else:
                    ids = pa.concat_arrays([last[0], ids])
                    texts, own = [last[1], *texts], np.concatenate([last[2], own])
                last = ids[-1:], texts[-1], own[-1:]
                if len(texts) > 1:
                    n = len(texts) - 1
                    columns = _compared(ids[:-1], texts[:-1], own[:-1], texts[1:], own[1:])
                    extra = [pa.array(["row"] * n), pa.array([number] * n, pa.int32()), pa.nulls(n, pa.string())]
                    yield pa.RecordBatch.from_arrays([*columns, *extra], [*names, "kind", "part", "text"])
        if last is not None:
            yield end("last", number, *last)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                own, donated = _values(part.column("fingerprint")), _values(part.column("next_fingerprint"))
                texts, donors = part.column("text").to_pylist(), part.column("next_text").to_pylist()
                if texts:
                    yield pa.RecordBatch.from_arrays(_compared(part.column("doc_id"), texts, own, donors, donated), names)

    order = [F.col("doc_id").asc_nulls_first(), F.col("_key").asc_nulls_first()]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("_key", F.xxhash64("text"))
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    done = ranges.select("doc_id", "text", "part").mapInArrow(run, f"{_COMPARED}, kind string, part int, text string")
    done = stored(done, "weighted-ranges")
    # One row for each range from here on.
    firsts = done.where("kind = 'first'").select(
        F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint")
    )
    everything = Window.partitionBy(F.lit(0))
    follow = firsts.select(F.col("next_part").alias("at")).select(
        "at", F.coalesce(F.lead("at").over(everything.orderBy("at")), F.min("at").over(everything)).alias("next_part")
    )
    lasts = done.where("kind = 'last'").select("doc_id", "fingerprint", "text", F.col("part").alias("at"))
    met = lasts.join(follow, "at").join(firsts, "next_part").select("doc_id", "fingerprint", "text", "next_text", "next_fingerprint")
    return done.where("kind = 'row'").select(*names).unionByName(met.mapInArrow(meet, _COMPARED))
