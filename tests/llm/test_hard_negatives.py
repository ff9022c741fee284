import math
import random

import numpy as np
from llm_helpers import importable, ordered
from pyspark.sql import functions as F

from weekwise.llm.hard_negatives import Heap, mine, strassen

KIND = "vec_id long, embedding array<float>, label int"


def brute(rows, tenth=10):
    able = []
    for place, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        able.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label, place))
    out = []
    for i, v, label, place in able:
        if i is None or i % tenth:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), j is None, j or 0, other == label)
                         for j, w, other, at in able if at != place))
        for s, _, j, _ in [x for x in scored if x[3]][:5]:
            fits = [x for x in scored if not x[3] and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(i, j, k + 1, None if x[1] else x[2], -s, -x[0]) for k, x in enumerate(fits)]
    return ordered(out)


def rows(n=400, seed=2):
    r = random.Random(seed)
    centre = [[r.gauss(0, 1) for _ in range(9)] for _ in range(4)]
    out = [(k, [c + r.gauss(0, 0.7) for c in centre[r.randrange(4)]], r.randrange(4)) for k in range(n)]
    copies = [(n + k, out[3][1], k % 4) for k in range(40)]            # ties
    edges = [(900, None, 1), (910, [1.0, None], 2), (920, [float("nan")], 2), (930, [float("inf")], 0), (940, [1.0], None),
             (950, [], 1), (960, [2.0, 1.0], 1), (970, [0.0] * 9, 2), (980, out[5][1] + [3.0], 3)]
    return out + copies + edges + out[:20]                              # and repeated rows


def found(spark, data, **options):
    df = importable(spark).createDataFrame(data, KIND).select(
        "*", *[F.lit("x").alias(c) for c in ("vector", "place", "anchor", "score", "rank")])
    vec_id, label = F.col("vec_id"), F.col("label")
    return ordered(mine(df, F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label), vec_id % 10 == 0,
                        **options).collect())


def test_equals_brute_force(spark):
    assert found(spark, rows()) == brute(rows())


def test_slices_of_anchors_give_the_same(spark):
    data = rows(150, 5)
    assert found(spark, data, slice_bytes=1000) == brute(data)


def test_rows_without_an_id(spark):
    data = [(10, [1.0, 0.5], 1), (None, [1.0, 0.4], 1), (None, [0.8, 0.3], 2), (3, [0.8, 0.3], 2)]
    got = found(spark, data)
    assert [r[3] for r in got] == [3, None] or sorted(map(str, (r[3] for r in got))) == ["3", "None"]
    assert {r[1] for r in got} == {None}


def test_empty(spark):
    assert found(spark, []) == []


def test_strassen_is_exact():
    r = np.random.default_rng(0)
    for m, d, n in ((1, 1, 1), (33, 40, 65), (130, 64, 257), (70, 3, 100), (0, 4, 5), (200, 129, 140)):
        a, b = r.integers(-2**28, 2**28, (m, d)), r.integers(-2**28, 2**28, (n, d))
        assert (strassen(a, b) == a @ b.T).all()
        assert (strassen(a, b, 4) == a @ b.T).all()


def test_heaps_merge_in_any_order():
    r = np.random.default_rng(3)
    key, score, vec = r.integers(0, 5, 500), r.integers(-9, 9, 500), r.integers(0, 50, 500)
    whole = Heap(5, 3)
    whole.add(key, score, vec, np.arange(500))
    other = Heap(5, 3)
    for k in np.array_split(r.permutation(500), 9):
        other.add(key[k], score[k], vec[k], k)
    assert (whole.key == other.key).all() and (whole.place == other.place).all()
