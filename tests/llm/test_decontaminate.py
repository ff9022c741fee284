import hashlib
import random
import re

import pytest
from llm_helpers import documents, edge_rows, importable, lower, ordered

from weekwise.llm import decontaminate

ITEMS = [(1, "the quick brown fox jumps over the lazy dog again and again"), (2, "short item"), (3, None), (4, "..."),
         (None, "item without an id"), (10, "the QUICK brown fox jumps over the lazy dog, again!"), (2, "short item")]


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))


def brute(rows, items, n=10):
    out = []
    for i, t in rows:
        w = words(t)
        hit, ids = set(), set()
        for item, text in items:
            x = words(text)
            k = min(n, len(x))
            for s in range(len(x) - k + 1 if x else 0):
                for a in range(len(w) - k + 1):
                    if w[a:a + k] == x[s:s + k]:
                        hit.update(range(a, a + k))
                        ids.add("" if item is None else str(item))
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return ordered(out)


def rows():
    r = random.Random(4)
    fox = ITEMS[0][1]
    out = [x for x in edge_rows(9) if x[1] is None or len(x[1]) < 3000]
    out += [(500, f"before {fox.upper()} after"), (501, "quick brown fox jumps over the lazy dog again and"),
            (502, "short, item; short item"), (503, fox[:30]), (504, "item without an id"), (505, "short itemé")]
    out += [(600 + k, " ".join(r.choice(fox.split()) for _ in range(60))) for k in range(5)]
    return out


@pytest.mark.parametrize("max_bytes", [1 << 20, 30])
def test_equals_brute_force_in_one_part_and_in_many(spark, max_bytes):
    bench = importable(spark).createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.contamination(documents(spark, rows()), bench, max_bytes=max_bytes)
    assert ordered(got.collect()) == brute(rows(), ITEMS)


@pytest.mark.parametrize("max_bytes", [1 << 20, 30])
def test_cutting(spark, max_bytes):
    bench = importable(spark).createDataFrame(ITEMS, "item_id long, text string")
    docs = documents(spark, rows())
    out = decontaminate.remove_overlaps(docs, bench, max_bytes=max_bytes)
    assert out.columns == docs.columns
    texts = {r.doc_id: r for r in out.collect()}
    assert texts[500].text == "before  after" and texts[500].n_chars == 13
    assert 502 in texts and 504 not in texts and texts[505].text == "short itemé"
    clean = {r[0] for r in brute(rows(), ITEMS) if not r[2] and r[0] is not None}
    assert clean <= set(texts)
    whole = {r.doc_id for r in decontaminate.remove_overlaps(docs, bench, whole=True).collect()}
    assert whole - {None} == clean


def test_empty_tables(spark):
    bench = importable(spark).createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(documents(spark, []), bench).collect() == []
    assert decontaminate.contamination(documents(spark, [(1, "a b")]), bench).collect()[0].n_items == 0


def test_a_long_item_is_split_and_the_set_keeps_its_bound(spark):
    r = random.Random(2)
    item = [f"v{r.randrange(5000)}" for _ in range(6000)]
    rows_ = [(k, " ".join(item[a:a + 30])) for k, a in enumerate(range(0, 5900, 37))] + [(999, "v1 v2 v3")]
    bench = importable(spark).createDataFrame([(7, " ".join(item)), (8, " ".join(item[100:140]))], "item_id long, text string")
    got = decontaminate.contamination(documents(spark, rows_), bench, max_bytes=100_000)
    found = {x.doc_id: x for x in got.collect()}
    for k, a in enumerate(range(0, 5900, 37)):
        ids = ["7"] + ["8"] * any(100 <= s and s + 10 <= 140 for s in range(a, a + 21))
        assert (found[k].n_hit, found[k].items_sha256) == (30, decontaminate.item_digest(ids))
    assert not found[999].contaminated
    for items, _ in decontaminate._parts(bench, 100_000, 10):
        assert decontaminate.NgramSet(items, 10).nbytes() < 2 * 100_000


def test_null_and_empty_item_ids_are_one(spark):
    bench = importable(spark).createDataFrame([(None, "a b c"), ("", "d e f")], "item_id string, text string")
    got = decontaminate.contamination(documents(spark, [(1, "a b c d e f")]), bench).collect()[0]
    assert (got.n_items, got.items_sha256) == (1, decontaminate.item_digest([""]))
