"""Hard-negative mining by integer tile products and mergeable heaps.

Vectors become integers, and scores are inner products of an anchor and a row.
Tasks take the rows in tiles and multiply each with the anchors' tile by
Strassen's recursion: blocks are halved in all three directions, padded with
zeros, seven products stand for eight, and all additions are exact on int64.
Rows of a tile are grouped by label, so that each product is made once: the
first pass multiplies anchors with rows of their own label, the second with
those of other labels.

1. Every task keeps each anchor's best positives in a heap of ``positives``
   entries; heaps of tasks are merged by a grouped top-k.
2. A positive's score gives the window that negatives must score in.  Every
   task keeps the best ``negatives`` rows of each window, merged likewise.

Anchors reach the tasks in slices of about ``SLICE_BYTES``, one pass over the
rows each, so neither the driver nor a task holds more of them at once, and no
row is copied or shuffled for an anchor.  The work is that of all anchors
against all rows, as asked for.

Defined cases: rows with a null label, a null vector, or any null or
non-finite component take no part.  Of equal scores the smaller vec_id comes
first, a null one last.  A row is identified by its place, so a repeated row
is another row, and a repeated anchor is mined for each of its rows.  A vector
shorter than another is continued with zeros.  Components beyond 64 bits are
cut to them, and scores beyond 64 bits wrap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekwise.llm.common import Scratch

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
WINDOW = (50, 95)          # percent of the positive's score
LEAF = 32                  # blocks up to this size are multiplied as they are
TILE = 2048                # rows of a tile
SLICE_BYTES = 16 << 20     # of anchors sent to the tasks at once
TASK_PRODUCTS = 4e9        # multiplications of a task, about
LEAST = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b.T`` of int64 matrices (rows x d, columns x d)."""
    m, d, n = a.shape[0], a.shape[1], b.shape[0]
    if min(m, d, n) == 0:
        return np.zeros((m, n), np.int64)
    levels = 0
    while min(m, d, n) >> levels > leaf:
        levels += 1
    unit = 1 << levels
    up = [-(-x // unit) * unit for x in (m, d, n)]
    return _multiply(_padded(a, up[0], up[1]), _padded(b, up[2], up[1]), levels)[:m, :n]


def _padded(x: np.ndarray, rows: int, columns: int) -> np.ndarray:
    if x.shape == (rows, columns):
        return x
    out = np.zeros((rows, columns), np.int64)
    out[:x.shape[0], :x.shape[1]] = x
    return out


def _multiply(a: np.ndarray, b: np.ndarray, levels: int) -> np.ndarray:
    if levels == 0:
        return a @ b.T
    i, k, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[0] // 2
    a11, a12, a21, a22 = a[:i, :k], a[:i, k:], a[i:, :k], a[i:, k:]
    b11, b21, b12, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]   # of the transposed matrix
    down = levels - 1
    p1 = _multiply(a11 + a22, b11 + b22, down)
    p2 = _multiply(a21 + a22, b11, down)
    p3 = _multiply(a11, b12 - b22, down)
    p4 = _multiply(a22, b21 - b11, down)
    p5 = _multiply(a11 + a12, b22, down)
    p6 = _multiply(a21 - a11, b11 + b12, down)
    p7 = _multiply(a12 - a22, b21 + b22, down)
    out = np.empty((a.shape[0], b.shape[0]), np.int64)
    out[:i, :j] = p1 + p4 - p5 + p7
    out[:i, j:] = p3 + p5
    out[i:, :j] = p2 + p4
    out[i:, j:] = p1 - p2 + p3 + p6
    return out


def integer_rows(embeddings: DataFrame, label: Column, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part."""
    parts = F.transform("embedding", lambda x: x.cast("double"))
    bad = F.exists(parts, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    # each component is looked at before it is multiplied
    return (embeddings.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull())
            .select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                    F.when(~bad, F.transform(parts, lambda x: F.floor(F.lit(float(scale)) * x))).alias("vector"))
            .filter("vector is not null"))


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    offsets = vectors.offsets.to_numpy()
    flat = vectors.flatten().to_numpy()
    sizes = np.diff(offsets)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = flat
    return out


class Heap:
    """The best ``size`` entries (score, vec_id, place) of each of ``keys`` keys, merged tile by tile."""

    def __init__(self, keys: int, size: int) -> None:
        self.size = size
        self.least = np.full(keys, LEAST)       # score that a further entry must reach
        self.key = self.score = self.vec = self.place = np.zeros(0, np.int64)

    def add(self, key: np.ndarray, score: np.ndarray, vec: np.ndarray, place: np.ndarray) -> None:
        if not len(key):
            return
        key, score, vec, place = (np.concatenate(x) for x in zip(
            (self.key, self.score, self.vec, self.place), (key, score, vec, place)))
        order = np.lexsort((place, vec, ~score, key))   # ~ turns the order of scores without overflow
        key, score, vec, place = key[order], score[order], vec[order], place[order]
        first = np.searchsorted(key, key)
        rank = np.arange(len(key)) - first
        kept = rank < self.size
        self.key, self.score, self.vec, self.place = key[kept], score[kept], vec[kept], place[kept]
        full = rank[kept] == self.size - 1
        self.least[self.key[full]] = self.score[full]


def _enough(scores: np.ndarray, able: np.ndarray, size: int) -> np.ndarray:
    """``able`` without entries that as many better ones of their row as a heap holds exclude."""
    if scores.shape[1] <= size or np.count_nonzero(able) <= 4 * size * len(scores):
        return able
    held = np.where(able, scores, LEAST)
    return able & (scores >= np.partition(held, -size, axis=1)[:, -size][:, None])


def _tiles(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple]:
    """(label, matrix, vec ids, places) of rows of one label, a tile's rows at a time."""
    def dealt(batch: pa.RecordBatch) -> Iterator[tuple]:
        label = batch.column("label").to_numpy()
        vec = batch.column("vec_id").fill_null(np.iinfo(np.int64).max).to_numpy()
        place = batch.column("place").to_numpy()
        matrix = _matrix(batch.column("vector"), width)
        for value in np.unique(label):
            at = np.flatnonzero(label == value)
            yield int(value), matrix[at], vec[at], place[at]

    held, rows = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, TILE):
            piece = batch.slice(start, TILE)
            held.append(piece)
            rows += piece.num_rows
            if rows >= TILE:
                yield from dealt(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                held, rows = [], 0
    if rows:
        yield from dealt(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


class Anchors:
    """A slice of anchors as arrays."""

    def __init__(self, rows: pa.Table, width: int) -> None:
        self.place = rows.column("place").to_numpy()
        self.label = rows.column("label").to_numpy()
        self.ids = rows.column("vec_id").combine_chunks()
        self.matrix = (_matrix(rows.column("vector").combine_chunks(), width) if rows.num_rows
                       else np.zeros((0, width), np.int64))


def _positive_heaps(rows: DataFrame, anchors: Anchors, width: int, size: int) -> DataFrame:
    """(anchor, score, vec, place): each task's best rows of the anchors' own labels."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        heap = Heap(len(held.place), size)
        for label, matrix, vec, place in _tiles(batches, width):
            mine = np.flatnonzero(held.label == label)
            scores = strassen(held.matrix[mine], matrix)
            able = (scores >= heap.least[mine][:, None]) & (held.place[mine][:, None] != place[None, :])
            a, b = np.nonzero(_enough(scores, able, size))
            heap.add(mine[a], scores[a, b], vec[b], place[b])
        yield pa.RecordBatch.from_pydict({"anchor": held.place[heap.key], "score": heap.score, "vec": heap.vec,
                                          "place": heap.place})

    return rows.mapInArrow(run, "anchor long, score long, vec long, place long")


def _window_heaps(rows: DataFrame, anchors: Anchors, windows: tuple, width: int, size: int) -> DataFrame:
    """(win, score, vec, place): each task's best rows of other labels in every window.

    ``windows`` are arrays (anchor index, lowest, highest score), sorted by anchor.
    """
    shared = rows.sparkSession.sparkContext.broadcast((anchors, windows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, (owner, lowest, highest) = shared.value
        heap = Heap(len(owner), size)
        heap.least = lowest.copy()
        nth = np.arange(len(owner)) - np.searchsorted(owner, owner)   # of its anchor's windows
        for label, matrix, vec, place in _tiles(batches, width):
            other = np.flatnonzero((held.label != label) & np.isin(np.arange(len(held.place)), owner))
            scores = strassen(held.matrix[other], matrix)
            row_of = np.zeros(len(held.place), np.int64)
            row_of[other] = np.arange(len(other))
            for k in range(int(nth.max(initial=-1)) + 1):
                win = np.flatnonzero((nth == k) & (held.label[owner] != label))
                s = scores if len(win) == len(other) else scores[row_of[owner[win]]]
                able = (s >= heap.least[win][:, None]) & (s <= highest[win][:, None])
                a, b = np.nonzero(_enough(s, able, size))
                heap.add(win[a], s[a, b], vec[b], place[b])
        yield pa.RecordBatch.from_pydict({"win": heap.key, "score": heap.score, "vec": heap.vec,
                                          "place": heap.place})

    return rows.mapInArrow(run, "win long, score long, vec long, place long")


def _best(entries: DataFrame, key: str, size: int) -> DataFrame:
    """The heaps of all tasks merged: ``rank`` from 1 within each key."""
    order = Window.partitionBy(key).orderBy(F.col("score").desc(), "vec", "place")
    return entries.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)


def mine(embeddings: DataFrame, label: Column, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         window: tuple[int, int] = WINDOW, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``embeddings`` has vec_id, embedding and label; ``label`` is the label of
    a row to mine with and ``anchor`` says whether it is an anchor.
    """
    spark = embeddings.sparkSession
    scratch = Scratch(spark, "hard-negatives")
    whole = scratch.save(integer_rows(embeddings, label).withColumn("anchor", F.coalesce(anchor, F.lit(False))), "whole")
    size = whole.agg(F.count("*").alias("rows"), F.count_if("anchor").alias("anchors"),
                     F.max(F.size("vector")).alias("width")).head()
    width = max(1, size.width or 0)
    tasks = max(spark.sparkContext.defaultParallelism, int(size.rows * size.anchors * width / TASK_PRODUCTS))
    place = F.monotonically_increasing_id()
    rows = scratch.save(whole.repartition(min(tasks, max(1, size.rows // TILE))).withColumn(
        "place", F.when(F.col("vec_id").isNull(), -1 - place).otherwise(place)), "rows")   # below 0: without an id
    scratch.drop(whole)
    slices = max(1, -(-size.anchors * (8 * width + 64) // slice_bytes))
    part = F.pmod(F.xxhash64("place"), F.lit(slices))
    out = None
    for k in range(slices):
        chosen = rows.filter(F.col("anchor") & (part == k)).orderBy("place")
        held = Anchors(chosen.select("place", "vec_id", "label", "vector").toArrow(), width)
        tops = scratch.save(_best(_positive_heaps(rows, held, width, positives), "anchor", positives), "positives")
        # at most `positives` rows for each anchor of the slice
        best = tops.orderBy("anchor", "rank").select("anchor", "score", "vec", "place").toArrow()
        score, owner = best.column("score").to_numpy(), np.searchsorted(held.place, best.column("anchor").to_numpy())
        lowest, highest = _ceil_percent(score, window[0]), _floor_percent(score, window[1])
        at = np.flatnonzero(lowest <= highest)
        found = scratch.save(_best(_window_heaps(rows, held, (owner[at], lowest[at], highest[at]), width, negatives),
                                   "win", negatives), "negatives")
        ids = _known(best.column("vec").to_numpy(), best.column("place").to_numpy())
        windows = spark.createDataFrame(pa.table({
            "win": np.arange(len(at)), "anchor_id": held.ids.take(pa.array(owner[at])),
            "positive_id": ids.take(pa.array(at)), "positive_score": score[at]}))
        mined = found.join(windows, "win").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
            F.when(F.col("place") >= 0, F.col("vec")).alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"))
        mined = scratch.save(mined, "mined")
        scratch.drop(tops, found)
        out = mined if out is None else out.unionByName(mined)
    return out


def _known(ids: np.ndarray, places: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=places < 0)


def _ceil_percent(x: np.ndarray, percent: int) -> np.ndarray:
    return -_floor_percent(-x, percent)


def _floor_percent(x: np.ndarray, percent: int) -> np.ndarray:
    """floor(x * percent / 100) without leaving 64 bits."""
    return x // 100 * percent + x % 100 * percent // 100
