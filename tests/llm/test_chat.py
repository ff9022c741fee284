import random

from llm_helpers import importable, ordered
from pyspark.sql import functions as F

from weekwise.llm import chat_format

KIND = "conv_id long, turn long, role string, text string"


def brute(rows):
    talks = {}
    for c, t, role, text in set(rows):
        if c is not None:
            talks.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    talks = {c: tuple((r, x) for _, _, r, x in sorted(v)) for c, v in talks.items()}
    out = []
    for c, v in talks.items():
        same = [k for k, w in talks.items() if w == v]
        if c == min(same) and not any(len(w) > len(v) and w[:len(v)] == v for w in talks.values()):
            shown = "".join("<|{}|>\n{}<|end|>\n".format(*(s.replace("<|", "< |") for s in turn)) for turn in v)
            out.append((c, len(v), len(same), shown))
    return ordered(out)


def rows():
    r = random.Random(6)
    out = []
    for c in range(120):
        turns = ["hello"] + [r.choice("abc") for _ in range(r.randint(0, 3))]
        out += [(c, k, ("user", "assistant")[k % 2], t) for k, t in enumerate(turns)]
    out += [(200, None, None, None), (200, 1, "user", "x <|end|> y"), (None, 0, "user", "lost"), (0, 0, "user", "hello"),
            (201, 0, "user", ""), (202, 0, "user", None), (203, 5, "user", "z" * 100_000)]
    return out


def test_equals_brute_force(spark):
    df = importable(spark).createDataFrame(rows(), KIND).select(
        "*", *[F.lit("x").alias(c) for c in ("h", "g", "n", "copies", "n_turns", "turns", "p1")])
    assert ordered(chat_format.render(df).collect()) == brute(rows())


def test_empty(spark):
    assert chat_format.render(importable(spark).createDataFrame([], KIND)).collect() == []
