import random
import re

import numpy as np
import pytest
from llm_helpers import documents, edge_rows, importable, lower, ordered

from weekwise.llm import overlap_join
from weekwise.llm.common import Scratch
from weekwise.llm.components import components


def brute(rows, shingle=3, threshold=(90, 100)):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets.append(set() if not w else {tuple(w)} if len(w) < shingle
                    else {tuple(w[k:k + shingle]) for k in range(len(w) - shingle + 1)})
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and threshold[1] * len(sets[a] & sets[b]) >= threshold[0] * len(sets[a] | sets[b]):
                root[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    return ordered([(i, len(sets[k]), least.get(top(k)) if sets[k] else i) for k, (i, _) in enumerate(rows)])


@pytest.mark.parametrize("shingle,threshold,block_sets", [(3, (90, 100), 1024), (5, (80, 100), 3)])
def test_equals_brute_force(spark, monkeypatch, shingle, threshold, block_sets):
    monkeypatch.setattr(overlap_join, "PIVOT_SETS", 4)
    r = random.Random(shingle)
    rows = edge_rows(7)
    text = [f"w{r.randint(0, 200)}" for _ in range(90)]
    for k in range(60):  # a hot group in which not all pairs are linked
        copy = list(text)
        for _ in range(r.randint(0, 3)):
            copy[r.randrange(90)] = f"c{r.randint(0, 5)}"
        rows.append((1000 + k, " ".join(copy[:r.randint(84, 90)])))
    expected = brute(rows, shingle, threshold)
    for slice_bytes in (overlap_join.SLICE_BYTES, 20_000):
        got = overlap_join.near_duplicates(documents(spark, rows), shingle, threshold, block_sets, slice_bytes)
        assert ordered(got.collect()) == expected


def test_linked_sets_share_a_bucket():
    r = np.random.Generator(np.random.PCG64(1))
    for threshold in ((90, 100), (80, 100)):
        for _ in range(4000):
            n = int(r.integers(2, 90))
            a = np.unique(r.integers(0, 2**63, n, dtype=np.uint64))
            b = np.unique(np.concatenate([r.permutation(a)[int(r.integers(0, 8)):],
                                          r.integers(0, 2**63, int(r.integers(0, 8)), np.uint64)]))
            common = len(np.intersect1d(a, b))
            if common >= overlap_join.needed(len(a), len(b), threshold) and common < max(len(a), len(b)):
                bands = overlap_join.Bands(threshold)
                (mine, need), (theirs, needs) = (overlap_join.bucket_names(x, bands) for x in (a, b))
                assert len(set(mine) & set(theirs)) >= max(need, needs) >= 1


@pytest.mark.parametrize("heap,probed", [(2000, 256), (0, 3), (0, 1)])
def test_divide_skip_equals_counting(monkeypatch, heap, probed):
    monkeypatch.setattr(overlap_join, "HEAP_ENTRIES", heap)
    monkeypatch.setattr(overlap_join, "PROBED", probed)
    r = random.Random(2)
    for _ in range(300):
        lists = [sorted(r.sample(range(30), r.randint(0, 25))) for _ in range(r.randint(1, 12))]
        least = r.randint(1, 12)
        members, seen = overlap_join.divide_skip([np.array(x, dtype=np.int64) for x in lists], least)
        count = {m: sum(m in x for x in lists) for m in range(30)}
        assert dict(zip(members.tolist(), seen.tolist())) == {m: c for m, c in count.items() if c >= least}


@pytest.mark.parametrize("task_links", [1_000_000, 5])
def test_components(spark, task_links):
    r = random.Random(task_links)
    links = [(r.randrange(60), r.randrange(60)) for _ in range(35)] + [(k, k + 1) for k in range(100, 130)] + [(7, 7)]
    df = importable(spark).createDataFrame(links, "a long, b long")
    found = {x.id: x.root for x in components(df, Scratch(spark, "test"), task_links).collect()}
    root = {x: x for p in links for x in p}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert {x: found.get(x, x) for x in root} == root


def test_empty_table_and_dropping(spark):
    assert overlap_join.near_duplicates(documents(spark, [])).collect() == []
    docs = documents(spark, [(1, "a b c d"), (2, "A b c d"), (3, None), (4, ""), (5, "other words stand here")])
    kept = overlap_join.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5]


def test_parity_bits_never_overstate_a_difference():
    r = np.random.default_rng(5)
    for _ in range(2000):
        a = np.unique(r.integers(0, 2**63, int(r.integers(1, 300)), dtype=np.uint64))
        b = np.unique(np.concatenate([a[:int(r.integers(0, len(a) + 1))],
                                      r.integers(0, 2**63, int(r.integers(1, 90)), dtype=np.uint64)]))
        least = overlap_join.least_difference(overlap_join.parity_bits(a), overlap_join.parity_bits(b))
        assert least <= len(np.setxor1d(a, b))
    assert overlap_join.least_difference(overlap_join.parity_bits(a), overlap_join.parity_bits(a)) == 0


def test_regular_long_words_are_told_apart(spark):
    """Thue-Morse words and their complements, which a polynomial modulo 2**64 cannot tell apart."""
    word = "a"
    while len(word) < 4096:
        word += word.translate(str.maketrans("ab", "ba"))
    rows = [(1, word), (2, word.translate(str.maketrans("ab", "ba"))), (3, word), (4, word[:1024]),
            (5, word[:1024].translate(str.maketrans("ab", "ba"))), (6, "b " + word), (7, "x" * 255), (8, "x" * 256)]
    assert ordered(overlap_join.near_duplicates(documents(spark, rows)).collect()) == brute(rows)


@pytest.mark.parametrize("written", [False, True])
def test_dropping_with_repeated_and_null_ids(spark, tmp_path, written):
    text, near = "one two three four five six seven eight nine ten " * 3, "a b c d e f g h i j k l m n o p q r s t u v"
    rows = [(1, text), (1, text), (5, text), (5, "linked with nothing here"), (None, text), (None, near), (None, near),
            (9, near + " w x"), (None, "alone and without an id"), (8, ""), (8, ""), (None, None), (3, None)]
    docs = documents(spark, rows)
    if written:
        docs.write.parquet(str(tmp_path / "docs"))
        docs = spark.read.parquet(str(tmp_path / "docs"))
    kept = overlap_join.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert ordered((r.doc_id, r.text) for r in kept.collect()) == ordered(
        [(1, text), (5, "linked with nothing here"), (9, near + " w x"), (None, "alone and without an id"),
         (8, ""), (8, ""), (None, None), (3, None)])
