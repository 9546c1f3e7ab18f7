import random
import re

import pytest

from skyops.llm import token_counts

PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def best(word, scores, per_byte):
    """Fewest tokens of the best segmentation, over all of them."""
    found = []

    def go(at, score, tokens):
        if at == len(word):
            found.append((-score, tokens))
            return
        for end in range(at + 1, len(word) + 1):
            if word[at:end] in scores:
                go(end, score + scores[word[at:end]], tokens + 1)
        size = len(word[at].encode())
        go(at + 1, score + size * per_byte, tokens + size)

    go(0, 0.0, 0)
    least = min(s for s, _ in found)
    return min(t for s, t in found if s <= least + 1e-9)


@pytest.mark.parametrize("max_nodes", [8, 30, 10**6])
def test_against_all_segmentations(max_nodes):
    rng = random.Random(4)
    letters = "abé▁"
    scores = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 4))): -rng.choice([1.0, 2.0, 2.5, 4.0, 7.0]) for _ in range(40)}
    trie = token_counts.PieceTrie(scores, max_nodes)
    for _ in range(300):
        word = "▁" + "".join(rng.choice(letters + "z") for _ in range(rng.randrange(8)))
        assert trie.count(word) == best(word, scores, trie.per_byte)


def test_prefixes_are_worked_out_once():
    trie = token_counts.PieceTrie({"a": -1.0, "ab": -1.5})
    trie.count("abab")
    nodes = len(trie.best)
    trie.count("aba")
    assert len(trie.best) == nodes
    trie.count("abb")
    assert len(trie.best) == nodes + 1


def test_vocabulary():
    scores = token_counts.vocabulary(PIECES)
    assert len(scores) > 31_000 and sum(2.718281828459045**s for s in scores.values()) == pytest.approx(1)
    trie = token_counts.PieceTrie(scores)
    assert trie.count("▁the") == 1 and trie.count("▁thethe") == 2 and trie.count("▁\U0001f9ff") in (5, 6)


def test_texts(spark):
    texts = {1: "The cat\x0bsat.\n\nThe cat", 2: None, 3: "", 4: "x\x1cy " * 3, 5: "q" * 300_000, 6: "naïve \U0001f9ff"}
    rows = [(i, t, "x") for i, t in texts.items()] + [(None, "The", None), (1, texts[1], "x")]
    got = token_counts.token_counts(spark.createDataFrame(rows, "doc_id long, text string, n_tokens string"), PIECES).collect()
    trie = token_counts.PieceTrie(token_counts.vocabulary(PIECES))
    want = []
    for i, text, _ in rows:
        own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        want.append((str(i), len(own), sum(trie.count("▁" + w) for w in own)))
    assert sorted((str(r.doc_id), r.n_pretokens, r.n_tokens) for r in got) == sorted(want)
    assert token_counts.token_counts(spark.createDataFrame([], "doc_id long, text string"), PIECES).collect() == []
