"""Quality rules: counts of a text, and a linear-chain conditional random field that marks its lines content or boilerplate."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyops.llm.common import sized, split_words, text_slices

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# A document needs this share of its words in content lines.
MIN_CONTENT = 0.5
# The model is fitted on at most this many labelled documents of each quality and this many lines of each of them.
TRAIN_DOCS = 2000
TRAIN_LINES = 200
# Bytes of text that a Python step here holds at a time: words, lines and features take many times that.
_PIECE_BYTES = 1024 * 1024

# Fixed value: the characters that count as symbols.
SYMBOLS = r"[#*$%&|<>]"
_WORD = r"[^\x20\x09-\x0D]+"
FEATURES = (
    "always", "1-2 words", "3-5 words", "13 or more words", "symbols > 2 %", "symbols > 10 %", "digits > 15 %",
    "upper case > 40 %", "ends a sentence", "exclamations > 30 % of words", "repeats an earlier line", "short words",
    "long words", "first line", "last line",
)
BOILERPLATE, CONTENT = 0, 1


@dataclass(frozen=True)
class LineModel:
    """Weights of a two-state chain: ``lines`` per feature in favour of content, ``moves[from, to]`` between states."""

    lines: np.ndarray
    moves: np.ndarray


ALL_CONTENT = LineModel(np.eye(1, len(FEATURES))[0], np.zeros((2, 2)))


def _lines(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lines with a word of all texts, where each text's lines begin, their words, repeats and features."""
    lists = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    offsets = np.asarray(lists.offsets)
    offsets, flat = offsets - offsets[0], lists.flatten()
    n_words = np.asarray(pc.count_substring_regex(flat, _WORD), dtype=np.int64)
    real = n_words > 0
    starts = np.concatenate(([0], np.cumsum(real)))[offsets]
    flat, n_words = flat.filter(pa.array(real)), n_words[real]
    coded = np.asarray(flat.dictionary_encode().indices)
    repeats = np.zeros(len(coded), dtype=bool)
    for a, b in zip(starts, starts[1:]):
        if b - a > 1:
            repeats[a:b] = True
            repeats[a + np.unique(coded[a:b], return_index=True)[1]] = False
    return flat, starts, n_words, repeats, _features(flat, starts, n_words, repeats)


def _features(lines: pa.Array, starts: np.ndarray, n_words: np.ndarray, repeats: np.ndarray) -> np.ndarray:
    count = lambda pattern: np.asarray(pc.count_substring_regex(lines, pattern), dtype=np.int64)
    chars = np.maximum(np.asarray(pc.utf8_length(lines), dtype=np.int64), 1)
    symbols = count(SYMBOLS)
    lower, upper = count(r"\p{Ll}"), count(r"\p{Lu}")
    first, last = np.zeros(len(lines), dtype=bool), np.zeros(len(lines), dtype=bool)
    some = starts[:-1] < starts[1:]
    first[starts[:-1][some]] = True
    last[starts[1:][some] - 1] = True
    columns = (
        np.ones(len(lines), dtype=bool), n_words <= 2, (n_words > 2) & (n_words <= 5), n_words >= 13, symbols * 50 > chars,
        symbols * 10 > chars, count(r"\d") * 100 > 15 * chars, upper * 10 > 4 * (upper + lower),
        np.asarray(pc.match_substring_regex(lines, r"[.!?:;\"')\]]\s*$"), dtype=bool), count("!") * 10 > 3 * n_words, repeats,
        chars * 10 < 35 * n_words, chars > 13 * n_words, first, last,
    )
    return np.stack(columns, axis=1)


def _repeat_words(words: pa.Array, starts: np.ndarray) -> np.ndarray:
    """For each text, how many of its words stand in a three-word window that the text holds twice or more."""
    coded = words.dictionary_encode()
    ids, kinds = np.asarray(coded.indices).astype(np.int64), max(len(coded.dictionary), 1)
    found = np.zeros(len(starts) - 1, dtype=np.int64)
    if len(ids) < 3:
        return found
    pairs = ids[:-2] * kinds + ids[1:-1]
    if kinds > 2_000_000:  # else three ids fit into 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs * kinds + ids[2:]
    for t, (a, b) in enumerate(zip(starts, starts[1:])):
        if b - a > 3:
            _, at, counts = np.unique(windows[a : b - 2], return_inverse=True, return_counts=True)
            if len(counts) < b - 2 - a:
                twice = counts[at] > 1
                covered = np.zeros(b - a, dtype=bool)
                for shift in range(3):
                    covered[shift : shift + len(twice)] |= twice
                found[t] = covered.sum()
    return found


def content_lines(features: np.ndarray, model: LineModel) -> np.ndarray:
    """The best path of one text's lines (Viterbi); ties go to content."""
    gain = features @ model.lines
    (stay_b, to_c), (to_b, stay_c) = model.moves.tolist()
    n = len(gain)
    b, c = 0.0, float(gain[0])
    from_b, from_c = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)  # was the line before content?
    for i, g in enumerate(gain[1:].tolist(), 1):
        bb, cb, bc, cc = b + stay_b, c + to_b, b + to_c, c + stay_c
        from_b[i], from_c[i] = cb >= bb, cc >= bc
        b, c = max(bb, cb), max(bc, cc) + g
    labels = np.empty(n, dtype=bool)
    state = c >= b
    for i in range(n - 1, -1, -1):
        labels[i] = state
        state = from_c[i] if state else from_b[i]
    return labels


def _measure(texts: pa.Array, model: LineModel) -> dict[str, np.ndarray]:
    texts = pc.fill_null(texts, "")
    words, starts = split_words(texts, lower=False)
    n_words = np.diff(starts).astype(np.int64)
    chars = np.concatenate(([0], np.cumsum(np.asarray(pc.utf8_length(words), dtype=np.int64))))
    _, line_starts, line_words, repeats, features = _lines(texts)
    dup_lines = np.diff(np.concatenate(([0], np.cumsum(repeats)))[line_starts])
    repeat_words = _repeat_words(words, starts)
    failed = (n_words < MIN_WORDS) | (100 * repeat_words > MAX_REPEAT_PERCENT * n_words)
    share = np.zeros(len(texts))
    for t, (a, b) in enumerate(zip(line_starts, line_starts[1:])):
        if a < b:
            share[t] = line_words[a:b][content_lines(features[a:b], model)].sum() / line_words[a:b].sum()
    return {
        "n_words": n_words, "word_chars": np.diff(chars[starts]).astype(np.int64),
        "n_symbols": np.asarray(pc.count_substring_regex(texts, SYMBOLS), dtype=np.int64),
        "n_dup_lines": dup_lines.astype(np.int64), "n_repeat_words": repeat_words, "base_failed": failed,
        "content_share": share, "kept": ~failed & (share >= MIN_CONTENT),
    }


_MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "content_share double, kept boolean"
)


def measured(docs: DataFrame, model: LineModel) -> DataFrame:
    """One row per row of ``docs`` (``doc_id`` and ``text`` are read): ``doc_id`` and the counts and verdicts of ``_MEASURES``.

    ``word_chars``: characters in words. ``n_symbols``: characters of ``SYMBOLS``. ``n_dup_lines``: lines with a word that
    equal an earlier line of the text. ``n_repeat_words``: words inside a three-word window that the text holds twice or
    more. ``base_failed``: fewer than ``MIN_WORDS`` words, or more than ``MAX_REPEAT_PERCENT`` percent of them repeated.
    ``content_share``: share of the words in lines that the model marks as content. ``kept``: not ``base_failed`` and a share
    of at least ``MIN_CONTENT``. A null, empty or blank text has zeros and fails. Rows that repeat are judged each; an empty
    table gives an empty result. Whole texts are read, a few megabytes at a time, without any shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", _PIECE_BYTES):
                found = _measure(part.column("text"), model)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, found.values())], ["doc_id", *found])
        pa.default_memory_pool().release_unused()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, {_MEASURES}")


def keep_good(docs: DataFrame, model: LineModel) -> DataFrame:
    """The rows of ``docs`` that ``measured`` keeps, with all their columns, whatever these are called."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", _PIECE_BYTES):
                yield part.filter(pa.array(_measure(part.column("text"), model)["kept"]))
        # The worker is kept for later tasks; what it held is not.
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, docs.schema)


def fit_lines(docs: DataFrame, labels: DataFrame, max_docs: int = TRAIN_DOCS, max_lines: int = TRAIN_LINES) -> LineModel:
    """The model of a bounded sample of labelled documents: per quality the ``max_docs`` ids with the least hash, of each the
    first ``max_lines`` lines.

    Only these documents' feature bits reach the driver. Rows with a null id or label don't count; a document with several
    labels has the least. Without documents of both qualities there is nothing to learn and every line is content.
    """
    quality = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    good, bad = (quality.where(F.col("quality") == q).orderBy(*order).limit(max_docs) for q in (1, 0))
    chosen = good.unionByName(bad).select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("quality"))
    rows = docs.select("doc_id", "text").join(sized(chosen), F.col("doc_id") == F.col("_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", _PIECE_BYTES):
                _, starts, _, _, features = _lines(part.column("text"))
                bits = features.astype(np.int32) @ (1 << np.arange(len(FEATURES), dtype=np.int32))
                masks = [bits[a : min(b, a + max_lines)] for a, b in zip(starts, starts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("quality"), pa.array(masks, pa.list_(pa.int32()))],
                    ["doc_id", "quality", "masks"],
                )
        pa.default_memory_pool().release_unused()

    sample = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "quality").mapInArrow(
        run, "doc_id long, quality int, masks array<int>"
    )
    found = [r for r in sorted(sample.collect(), key=lambda r: (r["doc_id"], r["quality"], r["masks"])) if r["masks"]]
    if len({r["quality"] for r in found}) < 2:
        return ALL_CONTENT
    unpack = lambda masks: (np.asarray(masks)[:, None] >> np.arange(len(FEATURES))) & 1
    return fit_chain([unpack(r["masks"]).astype(np.uint8) for r in found], np.array([r["quality"] for r in found]))


def fit_chain(texts: list[np.ndarray], quality: np.ndarray, steps: int = 150, ridge: float = 1e-3) -> LineModel:
    """A chain for texts whose lines have no labels of their own.

    First the lines of good texts count as content and those of bad ones as boilerplate, both with equal weight, in a
    logistic regression. A line of a bad text then keeps its label only if it looks like boilerplate, a line of a good text
    becomes boilerplate only if it does so clearly. The chain is fitted to these labels by gradient ascent.
    """
    rows, kind = _kinds(texts)
    label = np.repeat(quality, [len(t) for t in texts])
    share = label.mean()
    # Lines of equal features count together.
    of = [np.bincount(kind[label == q], minlength=len(rows)) * (0.5 / max(share if q else 1 - share, 1e-9)) for q in (0, 1)]
    lines = np.zeros(rows.shape[1])
    for _ in range(steps):
        chance = 1 / (1 + np.exp(-rows @ lines))
        lines += 2.0 * (rows.T @ (of[1] * (1 - chance) - of[0] * chance) / len(kind) - ridge * lines)
    chance = (1 / (1 + np.exp(-rows @ lines)))[kind]
    seen = np.where(label == 1, chance > 0.1, chance > 0.5)
    ends = np.cumsum([len(t) for t in texts])
    return _ascend(texts, np.split(seen, ends[:-1]), lines, steps, ridge)


def _kinds(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of features, and for each line of all texts the one that it has."""
    rows, kind = np.unique(np.concatenate(texts), axis=0, return_inverse=True)
    return rows.astype(float), kind.ravel()


def _ascend(texts: list[np.ndarray], labels: list[np.ndarray], lines: np.ndarray, steps: int, ridge: float) -> LineModel:
    """Maximum conditional likelihood by forward-backward sums over all texts at once: the first lines of all texts, longest
    text first, then their second lines, and so on, so memory follows the lines that there are."""
    sizes = np.array([len(t) for t in texts])
    rows, kind = _kinds(texts)
    longest_first = np.argsort(-sizes, kind="stable")
    alive = len(sizes) - np.searchsorted(np.sort(sizes), np.arange(sizes.max()), side="right")  # texts with a line at each place
    at = np.concatenate(([0], np.cumsum(alive)))
    text = np.arange(at[-1]) - np.repeat(at[:-1], alive)
    place = np.repeat(np.arange(len(alive)), alive)
    line = (np.cumsum(sizes) - sizes)[longest_first][text] + place
    kind, y = kind[line], np.concatenate(labels)[line].astype(int)
    total, later = len(kind), np.arange(alive[0], at[-1])
    before = at[place[later] - 1] + text[later]
    last = at[sizes[longest_first] - 1] + np.arange(len(sizes))
    seen_moves = np.bincount(2 * y[before] + y[later], minlength=4).reshape(2, 2) / total
    seen_lines = rows.T @ np.bincount(kind[y == CONTENT], minlength=len(rows)) / total
    lines, moves = lines.copy(), np.zeros((2, 2))
    for _ in range(steps):
        gain = np.zeros((total, 2))
        gain[:, CONTENT] = (rows @ lines)[kind]
        forward, backward = gain.copy(), np.zeros((total, 2))
        for i in range(1, len(alive)):
            own, past = slice(at[i], at[i + 1]), forward[at[i - 1] : at[i - 1] + alive[i]]
            forward[own] += np.logaddexp(past[:, :1] + moves[0], past[:, 1:] + moves[1])
        for i in range(len(alive) - 2, -1, -1):
            own = slice(at[i + 1], at[i + 2])
            ahead = gain[own] + backward[own]
            backward[at[i] : at[i] + alive[i + 1]] = np.logaddexp(moves[:, 0] + ahead[:, :1], moves[:, 1] + ahead[:, 1:])
        norm = np.logaddexp(forward[last, 0], forward[last, 1])[text]
        content = np.exp(forward[:, CONTENT] + backward[:, CONTENT] - norm)
        gain += backward
        expected = np.array([
            [np.exp(forward[before, a] + moves[a, b] + gain[later, b] - norm[later]).sum() for b in (0, 1)] for a in (0, 1)
        ]) / total
        lines += 1.0 * (seen_lines - rows.T @ np.bincount(kind, content, len(rows)) / total - ridge * lines)
        moves += 1.0 * (seen_moves - expected - ridge * moves)
    return LineModel(lines, moves)
