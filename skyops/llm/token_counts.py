"""Token counts of texts under a unigram vocabulary, by dynamic programming shared over a trie of pre-tokens."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyops.llm.common import split_words, text_slices

# Fixed value: the mark that the vocabulary's pieces carry at the start of a word.
WORD_START = "▁"
TRIE_NODES = 1_000_000


def vocabulary(model_file: str) -> dict[str, float]:
    """Pieces of a public sentencepiece file with log probabilities.

    The file holds ranks, not probabilities; a piece of rank r gets the Zipf probability 1 / (r H), where H makes the sum 1.
    Byte pieces, control pieces and the unknown piece are left out: see ``PieceTrie``.
    """
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=model_file)
    plain = [i for i in range(pieces.get_piece_size()) if not (pieces.is_control(i) or pieces.is_unknown(i) or pieces.is_byte(i))]
    norm = math.log(sum(1 / r for r in range(1, len(plain) + 1)))
    ranked = sorted(plain, key=lambda i: (-pieces.get_score(i), i))
    return {pieces.id_to_piece(i): -math.log(r) - norm for r, i in enumerate(ranked, 1)}


class PieceTrie:
    """Trie of pre-tokens. A node keeps the best score of its prefix and that segmentation's number of pieces, so a prefix
    that pre-tokens share is worked out once. Ties go to fewer pieces. A character that no piece covers costs its UTF-8
    bytes, one token each, at ten nats below the rarest piece per byte."""

    def __init__(self, scores: dict[str, float], max_nodes: int = TRIE_NODES):
        self.scores, self.max_nodes = scores, max_nodes
        self.longest = max(map(len, scores), default=1)
        self.per_byte = min(scores.values(), default=0.0) - 10
        self.clear()

    def clear(self) -> None:
        self.children: dict[tuple[int, str], int] = {}
        self.best, self.tokens = [0.0], [0]

    def count(self, word: str) -> int:
        """Tokens of one pre-token. Time and memory are linear in its length."""
        if len(self.best) + len(word) > self.max_nodes:
            self.clear()
        path, node = [0], 0
        for end, char in enumerate(word, 1):
            child = self.children.get((node, char))
            if child is None:
                child = self._add(word, end, path)
                self.children[node, char] = child
            path.append(child)
            node = child
        return self.tokens[node]

    def _add(self, word: str, end: int, path: list[int]) -> int:
        last = path[end - 1]
        size = len(word[end - 1].encode("utf-8", "surrogatepass"))
        score, tokens = self.best[last] + size * self.per_byte, self.tokens[last] + size
        for start in range(max(0, end - self.longest), end):
            piece = self.scores.get(word[start:end])
            if piece is not None:
                at = path[start]
                s, t = self.best[at] + piece, self.tokens[at] + 1
                if s > score or (s == score and t < tokens):
                    score, tokens = s, t
        self.best.append(score)
        self.tokens.append(tokens)
        return len(self.best) - 1


def token_counts(docs: DataFrame, model_file: str) -> DataFrame:
    """One row per row of ``docs`` (``doc_id`` and ``text`` are read): ``doc_id, n_pretokens, n_tokens``.

    Pre-tokens are the words, each with the word mark in front; white space itself costs nothing. A null, empty or blank
    text has 0 of both. Rows that repeat are counted each. An empty table gives an empty result.

    No shuffle: a task takes the distinct pre-tokens of some texts at a time, in order, through a trie that is emptied when
    it reaches ``TRIE_NODES``.
    """
    scores = vocabulary(model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PieceTrie(scores)
        for batch in batches:
            for part in text_slices(batch, "text"):
                words, starts = split_words(part.column("text"), lower=False)
                coded = words.dictionary_encode()
                counts = np.fromiter((trie.count(WORD_START + w) for w in coded.dictionary.to_pylist()), np.int64)
                running = np.concatenate(([0], np.cumsum(counts[np.asarray(coded.indices)])))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(starts).astype(np.int64)), pa.array(np.diff(running[starts]))],
                    ["doc_id", "n_pretokens", "n_tokens"],
                )

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return read.mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")
