"""Exact dedup by deterministic block naming; DataFrame operations only.

1. Each normalised text is cut into blocks of ``block_bytes`` bytes.  The
   distinct blocks are sorted and numbered: equal blocks, and only they, get
   one integer name.
2. Adjacent names of a document are paired; the distinct pairs are sorted and
   numbered in turn.  After ceil(log2(blocks)) rounds each document has one
   name.  Equal name after equally many rounds means equal text: no step
   rests on a hash being free of collisions.

The text crosses the network once, as blocks reduced to distinct ones before
the shuffle.  Names go back to the documents by a 64-bit routing hash; should
two different blocks share it, those blocks alone go back by their bytes.
Sort and numbering run inside hash partitions, so the names are not dense but
they are unique, and a written table fixes them before they are used.
Names that many blocks carry are joined with ``salted_lookup``.

Defined cases: a null text is empty; empty texts are equal.  Rows equal in
doc_id and text are copies of which one stays.  A null doc_id ranks below
every other; if all of a group are null, one of them stays and keep_id is null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekwise.llm.common import Scratch, fresh, lower_ascii, salted_lookup

BLOCK_BYTES = 4096


def _blocks(docs: DataFrame, block_bytes: int, route: Callable[[Column], Column]) -> DataFrame:
    raw = docs.select("doc_id", F.encode(lower_ascii(F.col("text")), "UTF-8").alias("raw"))
    n = F.greatest(F.ceil(F.octet_length("raw") / block_bytes), F.lit(1)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), n - 1),
                      lambda i: F.struct(i.alias("pos"),
                                         F.substring(F.col("raw"), i * block_bytes + 1, F.lit(block_bytes))
                                         .alias("block")))
    return (raw.select("doc_id", F.unhex(F.sha2("raw", 256)).alias("sha"), n.alias("n_blocks"),
                       F.explode(cut).alias("b"))
            .select("doc_id", "sha", "n_blocks", F.col("b.pos").alias("pos"), F.col("b.block").alias("block"))
            .withColumn("route", route(F.col("block"))))


def _named(distinct: DataFrame, keys: list[str]) -> DataFrame:
    """Sorted and numbered; deterministic, as a partition holds the keys of its hash."""
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def name_documents(docs: DataFrame, scratch: Scratch, block_bytes: int = BLOCK_BYTES,
                   route: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """(doc_id, sha, level, name, copies): one row per distinct (doc_id, text).

    ``copies`` is the number of equal input rows, (level, name) the identity
    of the text and ``sha`` its SHA-256, which tells the rows of one doc_id
    apart and is reported.
    """
    blocks = _blocks(docs, block_bytes, route)
    distinct = blocks.groupBy("route", "block").agg(F.count("*").alias("weight"))
    names = scratch.save(_named(distinct, ["route", "block"]).select("route", "name", "weight"), "block-names")
    shared = names.groupBy("route").count().filter("count > 1").select("route")
    places = blocks.drop("block")
    if shared.isEmpty():
        named = salted_lookup(places, names, ["route"], "weight", ["doc_id", "pos"])
    else:  # different blocks with one routing hash: these are told apart by their bytes
        clash = scratch.save(shared, "clashes")
        single = names.join(clash, "route", "left_anti")
        rows = blocks.join(clash, "route", "left_semi")
        own = rows.groupBy("route", "block").agg(F.count("*").alias("weight"))
        # negative names: the positive ones are taken
        own = scratch.save(_named(own, ["route", "block"]).withColumn("name", -1 - F.col("name")), "clash-names")
        named = (salted_lookup(places.join(clash, "route", "left_anti"), single, ["route"], "weight",
                               ["doc_id", "pos"])
                 .unionByName(salted_lookup(rows, own, ["route", "block"], "weight", ["doc_id", "pos"])
                              .drop("block")))
    level, done = 0, []
    rows = scratch.save(named.groupBy("doc_id", "sha", "n_blocks", "pos", "name")
                        .agg(F.count("*").alias("copies")), "level")
    while True:
        done.append(rows.filter("n_blocks = 1").select("doc_id", "sha", F.lit(level).alias("level"), "name", "copies"))
        rest = rows.filter("n_blocks > 1")
        if rest.isEmpty():
            break
        pairs = rest.groupBy("doc_id", "sha", "n_blocks", F.floor(F.col("pos") / 2).alias("pair")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("first"),
            F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("second"),
            F.max("copies").alias("copies"))
        # a last name without a partner pairs with none, which no name equals
        pairs = scratch.save(pairs.withColumn("alone", F.col("second").isNull())
                             .fillna({"second": 0}), "pairs")
        keys = ["first", "second", "alone"]
        names = scratch.save(_named(pairs.groupBy(*keys).agg(F.count("*").alias("weight")), keys), "pair-names")
        level += 1
        scratch.sweep()
        rows = scratch.save(
            salted_lookup(pairs, names, keys, "weight", ["doc_id", "pair"])
            .select("doc_id", "sha", F.ceil(F.col("n_blocks") / 2).cast("int").alias("n_blocks"),
                    F.col("pair").cast("int").alias("pos"), "name", "copies"), "level")
        scratch.drop(pairs, names)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def duplicate_groups(docs: DataFrame, scratch: Scratch, block_bytes: int = BLOCK_BYTES,
                     route: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """(doc_id, sha, keep_id, group_size, copies) per distinct (doc_id, text)."""
    rows = name_documents(docs, scratch, block_bytes, route)
    groups = scratch.save(rows.groupBy("level", "name").agg(
        F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"),
        F.count("*").alias("weight")), "groups")
    return salted_lookup(rows, groups, ["level", "name"], "weight", ["doc_id"]).select(
        "doc_id", "sha", "keep_id", "group_size", "copies")


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES,
                     route: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per document row: doc_id, keep_id, group_size, kept, text_sha256."""
    groups = duplicate_groups(docs, Scratch(docs.sparkSession, "dedup"), block_bytes, route)
    return (groups.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
                    F.lower(F.hex("sha")).alias("text_sha256")))


def drop_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, in its columns.

    Of rows that are equal in doc_id and text any one stays.
    """
    scratch = Scratch(docs.sparkSession, "dedup-kept")
    naming = Scratch(docs.sparkSession, "dedup")
    groups = duplicate_groups(docs, naming, block_bytes)
    id_, sha, copies = (fresh(docs.columns, c) for c in ("kept_id", "kept_sha", "copies"))
    kept = scratch.save(groups.filter(F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(
        F.col("doc_id").alias(id_), F.col("sha").alias(sha), F.col("copies").alias(copies)), "kept")
    naming.clear()
    own = F.unhex(F.sha2(F.encode(lower_ascii(docs["text"]), "UTF-8"), 256))
    same = docs["doc_id"].eqNullSafe(F.col(id_)) & (own == F.col(sha))
    repeated = F.col(copies) > 1
    if kept.filter(repeated).isEmpty():
        return docs.join(kept.hint("merge"), same, "left_semi")
    once = docs.join(kept.filter(~repeated).hint("merge"), same, "left_semi")
    more = docs.join(kept.filter(repeated).hint("merge"), same, "left_semi")
    text = fresh(docs.columns, "dedup_text")
    return once.unionByName(more.withColumn(text, lower_ascii(F.col("text"))).dropDuplicates(["doc_id", text]).drop(text))
