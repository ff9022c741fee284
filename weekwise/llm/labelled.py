"""A bounded sample of labelled documents for fitting, without the held-out rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekwise.llm.common import Scratch, held_out
from weekwise.llm.text_arrays import Words, alnum_words, chunks, windows

FIT_ROWS = 4000   # labelled documents of each label that a model is fitted on, at most


def _smallest_gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        words = Words(batch.column("text"), alnum_words())
        grams = words.windows(3).view(np.int64)
        offs = words.word_offs
        pairs = windows(words.hashes, 2).view(np.int64)
        own = words.hashes.view(np.int64)
        least = [int(grams[a:b - 2].min()) if b - a >= 3 else int(pairs[a]) if b - a == 2 else int(own[a]) if b > a else 0
                 for a, b in zip(offs[:-1], offs[1:])]
        yield batch.append_column("gram", pa.array(least, pa.int64()))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, scratch: Scratch,
                    rows: int = FIT_ROWS) -> tuple[DataFrame, dict[int, float]]:
    """(text, label, fold, gram), and the weight of each label's rows: at most ``rows`` of label 0 and of label 1.

    They are chosen by a hash of doc_id among the rows that are not held out.
    Of documents whose smallest word 3-gram agrees, mostly copies of each
    other, the first by that hash, doc_id and text is taken, however the rows
    are dealt; a text of one or two words counts by these.  By its gram a
    document falls into a fold, 0 to 3; (gram, label) orders the sample.  With the weights the
    labels stand to each other as among all labelled rows.  Ids with contradicting labels and null labels are
    left out.
    """
    known = (labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("other"))
             .filter("label = other").select("doc_id", F.col("label").cast("int").alias("label")))
    known = scratch.save(known, "known")
    order = F.xxhash64("doc_id")
    ids = None
    for value in (0, 1):
        part = known.filter(F.col("label") == value).orderBy(order).limit(rows)
        ids = part if ids is None else ids.unionByName(part)
    ids = scratch.save(ids, "ids")   # 2 * rows at most
    chosen = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
    grams = chosen.mapInArrow(
        _smallest_gram, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text string, label int, gram long")
    one = grams.groupBy("label", "gram").agg(F.min(F.struct(F.xxhash64("doc_id"), "doc_id", "text"))["text"].alias("text"))
    sample = scratch.save(one.select("text", "label", F.pmod("gram", F.lit(4)).cast("int").alias("fold"), "gram"), "sample")
    there = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    taken = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    scale = sum(taken.values()) / max(1, sum(there.get(k, 0) for k in taken))
    return sample, {k: there[k] / n * scale for k, n in taken.items()}
