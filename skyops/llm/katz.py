"""Bigram language model with Katz backoff: Good-Turing discounted counts and exactly normalised backoff weights.

Counts and scores come from one shuffle of the tokens. A task turns documents into token hashes and sends each token, with
the token before it and its document, to the bucket of the token. The bucket owns all occurrences of its tokens, so it knows
every count of a bigram and of a token, and returns sums by document, sums by history (what the backoff weight needs) and
counts of counts. A second shuffle brings these sums together, by document and by history, into a table partitioned by kind;
discounts follow from it, then backoff weights, then scores. Rows of both shuffles are packed arrays, as a row per token would
cost several times its content.

A token that more than ``HOT_SHARE`` of all tokens equal is dealt out by its bigram instead, and its count is looked up in a
list of at most 1 / ``HOT_SHARE`` entries. As a history, such a token (and the start of a text) has its backoff weight in the same list.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyops.llm.common import hash_texts, split_words, text_slices
from skyops.session import workspace

# Counts above this are taken as they are.
MAX_DISCOUNTED = 5
HOT_SHARE = 1 / 2000
# A task works on about this many tokens at once, in every step.
TOKENS = 2_000_000
# A packed row holds at most so many tokens or histories, so that no row is large; a task returns rows by about so many bytes.
_ROW_ENTRIES = 1 << 15
_OUT_BYTES = 4 * 1024 * 1024
_SEED = 5
# White space is in no word, so these never meet a word's hash but by chance.
_START, _END = (int(x) for x in hash_texts(pa.array([" ", "\n"]), _SEED))
_SCALE = 1e8  # sums of logarithms travel as whole numbers of this fraction
_COUNTS = 2 * (MAX_DISCOUNTED + 1)
_ROW = "family int, target long, kind string, batch long, blob binary, totals array<long>"


def pack(*columns: np.ndarray) -> bytes:
    """Unsigned arrays as compressed byte planes, each as wide as its largest value."""
    parts = [struct.pack("<I", len(columns))]
    for column in columns:
        column = np.ascontiguousarray(column, dtype=np.uint64)
        width = (int(column.max()).bit_length() + 7) // 8 if len(column) else 0
        parts += [struct.pack("<QB", len(column), width), column.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()]
    whole = b"".join(parts)
    return struct.pack("<Q", len(whole)) + pa.compress(whole, codec="zstd", asbytes=True)


def unpack(blob: bytes) -> list[np.ndarray]:
    data = pa.decompress(blob[8:], struct.unpack("<Q", blob[:8])[0], codec="zstd", asbytes=True)
    at, out = 4, []
    for _ in range(struct.unpack_from("<I", data)[0]):
        n, width = struct.unpack_from("<QB", data, at)
        planes = np.frombuffer(data, np.uint8, n * width, at + 9).reshape(width, n)
        whole = np.zeros((n, 8), np.uint8)
        whole[:, :width] = planes.T
        out.append(whole.view(np.uint64).ravel())
        at += 9 + n * width
    return out


def _steps(ascending: np.ndarray) -> np.ndarray:
    """Differences of ascending values: these are smaller, so they pack better. ``np.cumsum`` undoes it."""
    return np.diff(ascending, prepend=np.uint64(0))


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two."""
    x = a * np.uint64(0x9E3779B97F4A7C15) ^ (b + (a >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _find(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Where each value stands in the list, -1 if nowhere."""
    if not len(ascending):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)
    return np.where(ascending[at] == values, at, -1)


@dataclass(frozen=True)
class Unigrams:
    """What all tasks need to know of single tokens in the training documents."""

    total: int
    kinds: int
    counts_of_counts: tuple[int, ...]
    hot: np.ndarray
    hot_counts: np.ndarray
    bucket_tokens: int

    @property
    def buckets(self) -> int:
        return max(1, -(-self.total // self.bucket_tokens))

    @property
    def chances(self) -> np.ndarray:
        """Discounts by count up to ``MAX_DISCOUNTED``, at 0 that of the first count beyond."""
        return discounts(self.counts_of_counts)

    def mass(self, counts: np.ndarray) -> np.ndarray:
        """Probability of a token with each count. One extra token is put to the total, so something is always left for
        the unknown word, which has count 0."""
        capped = np.where(counts > MAX_DISCOUNTED, 0, counts)
        return np.where(counts > 0, self.chances[capped] * counts / (self.total + 1), self.unknown)

    @property
    def unknown(self) -> float:
        c = np.arange(1, MAX_DISCOUNTED + 1)
        few = np.array(self.counts_of_counts[:MAX_DISCOUNTED])
        return 1 - (self.total - (c * few).sum() + (self.chances[1:] * c * few).sum()) / (self.total + 1)


def discounts(counts_of_counts: Sequence[int]) -> np.ndarray:
    """Good-Turing discounts of the counts 1 to ``MAX_DISCOUNTED`` by Katz's formula; entry 0 is 1, for larger counts.

    A discount that the formula does not give, or not strictly between 0 and 1 (small or odd samples), is that of an
    absolute discount with the same counts of counts instead.
    """
    k, n = MAX_DISCOUNTED, [float(x) for x in counts_of_counts]
    absolute = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
    beyond = (k + 1) * n[k] / n[0] if n[0] else 1.0
    out = [1.0]
    for r in range(1, k + 1):
        good = ((r + 1) * n[r] / (r * n[r - 1]) - beyond) / (1 - beyond) if n[r - 1] and beyond != 1 else 0.0
        out.append(good if 0 < good < 1 else (r - absolute) / r)
    return np.array(out)


def _tokens(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, an end after each, and the number of tokens of each text."""
    words, starts = split_words(part.column("text"), lower=True)
    coded = words.dictionary_encode()
    hashes = hash_texts(coded.dictionary, _SEED)[np.asarray(coded.indices)]
    sizes = np.diff(starts) + 1
    out = np.empty(sizes.sum(), dtype=np.uint64)
    ends = np.cumsum(sizes) - 1
    is_word = np.ones(len(out), dtype=bool)
    is_word[ends] = False
    out[ends], out[is_word] = _END, hashes
    return out, sizes


def _batches(
    batches: Iterator[pa.RecordBatch], most: int
) -> Iterator[tuple[list[pa.RecordBatch], np.ndarray, np.ndarray]]:
    """Documents, tokens and sizes, until a batch has ``most`` tokens."""
    parts, tokens, sizes, n = [], [], [], 0
    for batch in batches:
        for part in text_slices(batch, "text"):
            t, s = _tokens(part)
            parts.append(part.select(["doc_id", "held_out"]))
            tokens.append(t)
            sizes.append(s)
            n += len(t)
            if n >= most:
                yield parts, np.concatenate(tokens), np.concatenate(sizes)
                parts, tokens, sizes, n = [], [], [], 0
    if parts:
        yield parts, np.concatenate(tokens), np.concatenate(sizes)


def _held(parts: list[pa.RecordBatch]) -> np.ndarray:
    return np.concatenate([np.asarray(p.column("held_out")) for p in parts])


def count_unigrams(docs: DataFrame, tokens_at_once: int = TOKENS, hot_share: float = HOT_SHARE) -> Unigrams:
    """Counts of all training tokens, exactly; only totals and the hot tokens reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts, tokens, sizes in _batches(batches, tokens_at_once):
            found, n = np.unique(tokens[np.repeat(~_held(parts), sizes)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["w", "n"])
            del parts, tokens, sizes, found, n
        _give_back()

    counts = docs.mapInArrow(run, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))
    path = workspace(docs.sparkSession, "katz-unigrams")
    counts.write.parquet(path)
    counts = docs.sparkSession.read.schema(counts.schema).parquet(path)
    first = [F.count_if(F.col("n") == r).alias(f"n{r}") for r in range(1, MAX_DISCOUNTED + 2)]
    row = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("kinds"), *first).first()
    hot = counts.where(F.col("n") > row["total"] * hot_share).toPandas()  # fewer than 1 / hot_share rows
    hashes, n = hot["w"].to_numpy(np.int64).view(np.uint64), hot["n"].to_numpy(np.int64)
    # The start is no token, but stands before one in every document.
    hashes, n = np.append(hashes, np.uint64(_START)), np.append(n, 0)
    order = np.argsort(hashes)
    return Unigrams(row["total"], row["kinds"], tuple(row)[2:], hashes[order], n[order], tokens_at_once)


def _row(family: int, target: int, kind: str, batch: int, blob: bytes, totals: Sequence[int] = ()) -> tuple:
    return family, target, kind, batch, blob, list(totals)


def _give_back() -> None:
    """The worker is kept for later tasks; what it held is not."""
    pa.default_memory_pool().release_unused()


def _made(rows: list[tuple]) -> pa.Table:
    """The rows in chunks of about ``_OUT_BYTES``: each crosses to Spark by itself."""
    groups = np.cumsum([len(row[4]) for row in rows]) // _OUT_BYTES
    edges = np.flatnonzero(np.diff(groups)) + 1
    return pa.concat_tables([_chunk(rows[a:b]) for a, b in zip([0, *edges], [*edges, len(rows)])])


def _chunk(rows: list[tuple]) -> pa.Table:
    types = [pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
    names = [x.split()[0] for x in _ROW.split(", ")]
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names)


def _grouped(values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each value that occurs, with its places."""
    order = np.argsort(values, kind="stable")
    sorted_values = values[order]
    edges = np.flatnonzero(np.diff(sorted_values)) + 1
    for places in np.split(order, edges):
        if len(places):
            yield int(values[places[0]]), places


def _pieces(places: np.ndarray) -> Iterator[np.ndarray]:
    for a in range(0, len(places), _ROW_ENTRIES):
        yield places[a : a + _ROW_ENTRIES]


def _send(unigrams: Unigrams) -> Callable:
    """Tokens to their buckets, and what is known of each document to its batch."""
    buckets = unigrams.buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for number, (parts, tokens, sizes) in enumerate(_batches(batches, unigrams.bucket_tokens)):
            batch, held = first + number, _held(parts)
            ids = pa.concat_arrays([p.column("doc_id") for p in parts])
            no_id, ids = np.asarray(pc.is_null(ids)), np.asarray(pc.fill_null(ids, 0))
            rows = [_row(0, batch, "docs", batch, pack(ids.view(np.uint64), no_id, held, sizes))]
            before = np.concatenate((np.zeros(1, np.uint64), tokens[:-1]))
            before[np.cumsum(sizes) - sizes] = _START
            doc = np.repeat((np.arange(len(sizes)) * 2 + held).astype(np.uint32), sizes)
            bucket = (tokens % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.uint64)
            hot = np.flatnonzero(_find(tokens, unigrams.hot) >= 0)
            bucket[hot] = _mixed(tokens[hot], before[hot]) % np.uint64(buckets)
            for target, places in _grouped(bucket):
                places = places[np.argsort(tokens[places], kind="stable")]
                for piece in _pieces(places):
                    own, own_n = np.unique(tokens[piece], return_counts=True)
                    histories, at = np.unique(before[piece], return_inverse=True)
                    rows.append(_row(1, target, "tokens", batch, pack(_steps(own), own_n, _steps(histories), at, doc[piece])))
            del parts, tokens, sizes, before, doc, bucket, hot
            yield from _made(rows).to_batches()
            del rows
        _give_back()

    return run


def _class_sums(groups: np.ndarray, n: int, counts: np.ndarray) -> list[np.ndarray]:
    """For each group, how many members have the counts 1 to ``MAX_DISCOUNTED``, and the sum of the larger counts."""
    few = [np.bincount(groups[counts == r], minlength=n) for r in range(1, MAX_DISCOUNTED + 1)]
    return [*few, _exact_sums(groups, np.where(counts > MAX_DISCOUNTED, counts, 0), n)]


def _exact_sums(groups: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of whole numbers by group."""
    out = np.zeros(n, dtype=np.int64)
    np.add.at(out, groups, values.astype(np.int64))
    return out


def _count(unigrams: Unigrams) -> Callable:
    """All tokens of a bucket: sums for documents and histories."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        family, bucket = key[0].as_py(), key[1].as_py()
        if family == 0:
            return table
        table = table.sort_by("batch")
        batches, token, before, doc = table.column("batch").to_pylist(), [], [], []
        for blob in table.column("blob"):
            own, own_n, histories, at, docs = unpack(blob.as_py())
            token.append(np.repeat(np.cumsum(own), own_n.astype(np.int64)))
            before.append(np.cumsum(histories)[at])
            doc.append(docs.astype(np.uint32))
        del table
        batches, first = np.unique(batches, return_index=True)
        sizes = np.add.reduceat([len(d) for d in doc], first)
        batches, ends = batches.tolist(), np.cumsum(sizes)
        token, before, doc = np.concatenate(token), np.concatenate(before), np.concatenate(doc)
        train = (doc & 1) == 0
        doc >>= 1

        pair = np.empty_like(token)
        for a in range(0, len(pair), _ROW_ENTRIES):
            pair[a : a + _ROW_ENTRIES] = _mixed(before[a : a + _ROW_ENTRIES], token[a : a + _ROW_ENTRIES])
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        begin = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
        del pair
        pair_n = np.add.reduceat(train[order], begin, dtype=np.int64)
        r = np.empty(len(token), dtype=np.int64)
        r[order] = np.repeat(pair_n, np.diff(np.append(begin, len(token))))
        kinds, kind = np.unique(token, return_inverse=True)
        del token
        kind = kind.astype(np.uint32)
        kind_n = np.bincount(kind[train], minlength=len(kinds))
        hot = _find(kinds, unigrams.hot)
        kind_n[hot >= 0] = unigrams.hot_counts[hot[hot >= 0]]

        # Distinct bigrams of the training documents.
        known = pair_n > 0
        one, one_n = order[begin[known]], pair_n[known]
        del order, begin, pair_n, known
        totals = np.bincount(np.minimum(one_n, MAX_DISCOUNTED + 2), minlength=MAX_DISCOUNTED + 3)[1 : MAX_DISCOUNTED + 2]
        rows = [_row(2, bucket, "counts", 0, b"", totals.tolist())]
        histories, of = np.unique(before[one], return_inverse=True)
        sums = [*_class_sums(of, len(histories), one_n), *_class_sums(of, len(histories), kind_n[kind[one]])]
        for target, places in _grouped(histories % np.uint64(unigrams.buckets)):
            for piece in _pieces(places):
                rows.append(_row(1, target, "history", 0, pack(_steps(histories[piece]), *[s[piece] for s in sums])))
        del one, one_n, of, histories, sums
        rows += _document_rows(unigrams, batches, ends, doc, before, r, kind_n, kind, train)
        del doc, before, r, kind, train
        _give_back()
        return _made(rows)

    return run


def _document_rows(unigrams, batches, ends, doc, before, r, kind_n, kind, train) -> list[tuple]:
    """Per document: counts of its tokens by class and sums of logarithms; and the bigrams that no training document has."""
    rows = []
    log_of = np.round(np.log10(kind_n + 1.0) * _SCALE).astype(np.int64)
    cost_of = np.round(-np.log10(unigrams.mass(kind_n)) * _SCALE).astype(np.int64)
    unseen = ~train & (r == 0)
    for batch, a, b in zip(batches, ends - np.diff(ends, prepend=0), ends):
        docs, at = np.unique(doc[a:b], return_inverse=True)
        n, own, seen = len(docs), kind[a:b], r[a:b]
        beyond = np.where(seen > MAX_DISCOUNTED, np.round(np.log10(np.maximum(seen, 1)) * _SCALE), 0)
        lost = np.where(unseen[a:b], cost_of[own], 0)
        few = [np.bincount(at[seen == x], minlength=n) for x in range(1, MAX_DISCOUNTED + 1)]
        columns = [_exact_sums(at, x, n) for x in (log_of[own], beyond, lost, kind_n[own] > 0)]
        rows.append(_row(0, batch, "sums", batch, pack(docs, *columns, *few)))
        missed = np.flatnonzero(unseen[a:b]) + a
        missed_hot = _find(before[missed], unigrams.hot)
        hot = missed_hot >= 0
        if hot.any():
            rows.append(_row(0, batch, "missed", batch, pack(doc[missed[hot]], missed_hot[hot])))
    cold = np.flatnonzero(unseen)
    cold = cold[_find(before[cold], unigrams.hot) < 0]
    part = np.searchsorted(ends, cold, side="right")
    for target, places in _grouped(before[cold] % np.uint64(unigrams.buckets)):
        for piece in _pieces(places[np.argsort(before[cold[places]], kind="stable")]):
            own = cold[piece]
            used, at = np.unique(part[piece], return_inverse=True)
            ids = np.array(batches, dtype=np.int64)[used]
            rows.append(_row(1, target, "unseen", 0, pack(_steps(before[own]), ids, at, doc[own])))
    return rows


def _gather(unigrams: Unigrams) -> Callable:
    """The sums that belong to one batch of documents, or to the histories of one bucket."""

    def of_batch(batch: int, parts: dict[str, list[list[np.ndarray]]]) -> list[tuple]:
        ids, no_id, held, sizes = parts["docs"][0]
        columns = np.zeros((4 + MAX_DISCOUNTED, len(ids)), dtype=np.uint64)
        for docs, *sums in parts.get("sums", []):
            columns[:, docs.astype(np.int64)] += np.stack(sums)
        missed = parts.get("missed", [])
        doc, hot = (np.concatenate([m[i] for m in missed]) if missed else np.zeros(0, np.uint64) for i in (0, 1))
        return [_row(0, batch, "docs", batch, pack(ids, no_id, held, sizes, *columns, doc, hot))]

    def of_histories(bucket: int, parts: dict[str, list[list[np.ndarray]]]) -> list[tuple]:
        stated = parts.get("history", [])
        if not stated:
            return []
        histories, at = np.unique(np.concatenate([np.cumsum(s[0]) for s in stated]), return_inverse=True)
        sums = [_exact_sums(at, np.concatenate([s[1 + i] for s in stated]), len(histories)) for i in range(_COUNTS)]
        of, batch, doc = [], [], []
        for steps, ids, part, docs in parts.get("unseen", []):
            place = _find(np.cumsum(steps), histories)
            met = place >= 0  # an unknown history has no backoff weight
            of.append(place[met])
            batch.append(ids[part.astype(np.int64)][met])
            doc.append(docs[met])
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.uint64)
        used, batch_at = np.unique(join(batch), return_inverse=True)
        rows = [_row(1, bucket, "backoff", 0, pack(_steps(histories), *sums, join(of), used, batch_at, join(doc)))]
        hot = np.flatnonzero(_find(histories, unigrams.hot) >= 0)
        if len(hot):
            rows.append(_row(1, bucket, "hot", 0, pack(histories[hot], *[s[hot] for s in sums])))
        return rows

    def run(key: tuple, table: pa.Table) -> pa.Table:
        family, target = key[0].as_py(), key[1].as_py()
        if family == 2:
            return table
        parts: dict[str, list[list[np.ndarray]]] = {}
        for kind, blob in zip(table.column("kind"), table.column("blob")):
            parts.setdefault(kind.as_py(), []).append(unpack(blob.as_py()))
        rows = (of_histories if family else of_batch)(target, parts)
        del table, parts
        _give_back()
        return _made(rows)

    return run


def backoff_gain(unigrams: Unigrams, pair_discounts: np.ndarray, sums: Sequence[np.ndarray]) -> np.ndarray:
    """log10 of each history's backoff weight times its count plus one, from ``_class_sums`` of its bigrams' counts and of
    the counts of the tokens that follow it.

    A history's counts are taken over its count plus one, so it always leaves mass; the weight spreads that mass over the
    tokens that never follow it, the unknown word included, in proportion to their own probabilities. The probabilities
    behind a history sum to one exactly.
    """
    r = np.arange(1, MAX_DISCOUNTED + 1)[:, None]
    pairs, singles = np.stack(sums[: MAX_DISCOUNTED + 1]).astype(float), np.stack(sums[MAX_DISCOUNTED + 1 :]).astype(float)
    count = (r * pairs[:-1]).sum(axis=0) + pairs[-1]
    given = (pair_discounts[1:, None] * r * pairs[:-1]).sum(axis=0) + pairs[-1]
    covered = ((unigrams.chances[1:, None] * r * singles[:-1]).sum(axis=0) + singles[-1]) / (unigrams.total + 1)
    return np.log10((count + 1 - given) / (1 - covered))


def _corrections(unigrams: Unigrams, pair_discounts: np.ndarray) -> Callable:
    """What backing off adds to documents, by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rows = []
            for blob in part.column("blob").to_pylist():
                _, *rest = unpack(blob)
                sums, (of, used, at, doc) = rest[:_COUNTS], rest[_COUNTS:]
                gain = backoff_gain(unigrams, pair_discounts, sums)[of.astype(np.int64)]
                for i, places in _grouped(at):
                    docs, to = np.unique(doc[places], return_inverse=True)
                    added = np.bincount(to, weights=gain[places])
                    rows.append(_row(0, int(used[i]), "gain", int(used[i]), pack(docs, added.view(np.uint64))))
            yield from _made(rows).to_batches()

    return run


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_SCORE_NAMES = [x.split()[0] for x in _SCORES.split(", ")]


def _finish(unigrams: Unigrams, pair_discounts: np.ndarray, hot_gain: np.ndarray) -> Callable:
    seen_log = np.log10(pair_discounts[1:] * np.arange(1, MAX_DISCOUNTED + 1))
    smoothed = np.log10(unigrams.total + 1.0 * (unigrams.kinds + 1))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        kinds, blobs = table.column("kind").to_pylist(), table.column("blob").to_pylist()
        ids, no_id, held, sizes, logs, beyond, lost, known, *rest = unpack(blobs[kinds.index("docs")])
        few, (doc, hot) = rest[:MAX_DISCOUNTED], rest[MAX_DISCOUNTED:]
        n = len(ids)
        gain = np.bincount(doc.astype(np.int64), weights=hot_gain[hot.astype(np.int64)], minlength=n).astype(float)
        for kind, blob in zip(kinds, blobs):
            if kind == "gain":
                docs, added = unpack(blob)
                gain[docs.astype(np.int64)] += added.view(np.float64)
        histories = logs.astype(float) / _SCALE
        seen = sum(x.astype(float) * y for x, y in zip(few, seen_log)) + beyond.astype(float) / _SCALE
        score = seen - lost.astype(float) / _SCALE + gain - histories
        base = histories - sizes.astype(float) * smoothed
        return pa.table([
            pa.array(ids.view(np.int64), mask=no_id.astype(bool)), pa.array(held.astype(bool)), pa.array(sizes.astype(np.int64)),
            pa.array(known.astype(np.int64)), pa.array(np.full(n, unigrams.total)), pa.array(base), pa.array(score),
        ], _SCORE_NAMES)

    return run


def katz_scores(docs: DataFrame, held_out: Column, tokens_at_once: int = TOKENS, hot_share: float = HOT_SHARE) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text`` and what ``held_out`` uses are read):
    ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Tokens are the words, A-Z lower-cased, and one end per text; the model learns from all documents for which ``held_out``
    is false or null. ``base_score`` is the add-one unigram score, ``score`` that of the Katz bigram model, both log10. An
    unknown word has count 0; all unknown words are one class, whose mass a word gets whole. A null, empty or blank text is
    the end alone. Rows that repeat count and are scored each; the empty table gives an empty result. With nothing to learn
    from, every word is unknown and both scores are 0.

    P(w | h) = d(c(h w)) c(h w) / (c(h) + 1) if the bigram is known, else a(h) P(w), with P(w) = d'(c(w)) c(w) / (N + 1).
    The histories' part of the score, the sum of log10(c(h) + 1), equals the sum of log10(c(w) + 1) over the tokens, as the
    start counts as often as the end and every word precedes something.
    """
    spark = docs.sparkSession
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out")
    )
    unigrams = count_unigrams(read, tokens_at_once, hot_share)
    counted = read.mapInArrow(_send(unigrams), _ROW).groupBy("family", "target").applyInArrow(_count(unigrams), _ROW)
    gathered = counted.groupBy("family", "target").applyInArrow(_gather(unigrams), _ROW)
    path = workspace(spark, "katz-model")
    gathered.write.partitionBy("kind").parquet(path)
    model = spark.read.schema(_ROW).parquet(path)

    totals = [F.coalesce(F.sum(F.get("totals", F.lit(i))), F.lit(0)) for i in range(MAX_DISCOUNTED + 1)]
    pair_discounts = discounts(tuple(model.where("kind = 'counts'").agg(*totals).first()))
    hot_gain = np.zeros(len(unigrams.hot))
    for row in model.where("kind = 'hot'").select("blob").collect():  # one entry per hot token in all
        histories, *sums = unpack(bytes(row["blob"]))
        hot_gain[_find(histories, unigrams.hot)] = backoff_gain(unigrams, pair_discounts, sums)
    gains = model.where("kind = 'backoff'").mapInArrow(_corrections(unigrams, pair_discounts), _ROW)
    documents = model.where("kind = 'docs'").unionByName(gains)
    return documents.groupBy("family", "target").applyInArrow(_finish(unigrams, pair_discounts, hot_gain), _SCORES)
