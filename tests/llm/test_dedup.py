import hashlib

from llm_helpers import documents, edge_rows, lower, ordered
from pyspark.sql import functions as F

from weekwise.llm import block_dedup


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        stays = ids.index(keep)
        out += [(i, keep, len(ids), k == stays, hashlib.sha256(t.encode()).hexdigest()) for k, i in enumerate(ids)]
    return ordered(out)


def test_equals_brute_force_over_many_rounds(spark):
    rows = edge_rows()
    docs = documents(spark, rows)
    assert ordered(block_dedup.exact_duplicates(docs, block_bytes=64).collect()) == brute(rows)


def test_blocks_that_share_a_routing_hash(spark):
    rows = [(i, t) for i, t in edge_rows(5) if t is None or len(t) < 2000]
    docs = documents(spark, rows)
    got = block_dedup.exact_duplicates(docs, block_bytes=32, route=lambda b: F.octet_length(b) % 3)
    assert ordered(got.collect()) == brute(rows)


def test_empty_and_single(spark):
    assert block_dedup.exact_duplicates(documents(spark, [])).collect() == []
    assert block_dedup.exact_duplicates(documents(spark, [(None, None)])).collect()[0].kept


def test_dropping_keeps_one_row_and_all_columns(spark):
    docs = documents(spark, edge_rows())
    kept = block_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    texts = [lower(r.text) for r in kept.collect()]
    assert sorted(texts) == sorted({lower(t) for _, t in edge_rows()})
