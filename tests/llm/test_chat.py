import random
from collections import defaultdict

import pytest

from skyops.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, rank string, speaker string"


def rendered(rows, stretch):
    key = lambda x: (x is not None, x if x is not None else 0)
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        safe = lambda s: s.replace("<|", "<\\|")
        groups[conv].append((key(turn), safe("unknown" if role is None else role), safe(text or "")))
    for conv, turns in groups.items():
        turns.sort()
        for at in range(0, len(turns), stretch):
            part = turns[at : at + stretch]
            for speaker in {s for _, s, _ in turns}:
                out, mask, ahead = "", [], sum(
                    len("<|assistant|>\n" if who == speaker else f"<|user name={who}|>\n") + len(text) + len("<|end|>\n")
                    for _, who, text in turns[:at]
                )
                for _, who, text in part:
                    out += "<|assistant|>\n" if who == speaker else f"<|user name={who}|>\n"
                    if who == speaker:
                        mask.append((ahead + len(out), len(text) + len("<|end|>\n")))
                    out += text + "<|end|>\n"
                yield conv, at // stretch, speaker, len(part), len(mask), out, tuple(mask)


@pytest.mark.parametrize("stretch", [256, 3])
def test_against_plain_rendering(spark, stretch):
    rng = random.Random(7)
    rows = [(rng.choice([1, 2, 3, None]), rng.choice([0, 1, 2, None]), rng.choice(["user", "assistant", "Zoë", None, "<|end|>"]),
             rng.choice(["hi", "é\U0001f9ff", None, "", "<|assistant|>\nno"])) for _ in range(60)]
    rows += [(9, i // 2, "ab"[i % 2], f"t{i}") for i in range(700)]
    rows += [(12, i, "system" if not i else "late" if i > 590 else f"u{i % 3}", f"t{i}") for i in range(600)] + [(10, 0, "x", "same")] * 5 + [(11, 0, "x", "long " * 50_000)]
    docs = spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA).repartition(5)
    got = chat.perspectives(docs, stretch).collect()
    flat = [(r.conv_id, r.stretch, r.speaker, r.n_turns, r.n_own, r.rendered, tuple((m.start, m.length) for m in r.mask)) for r in got]
    assert sorted(flat, key=str) == sorted(rendered(rows, stretch), key=str)


def test_no_rows(spark):
    assert chat.perspectives(spark.createDataFrame([], SCHEMA)).collect() == []
