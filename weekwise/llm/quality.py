"""Quality by random-indexing word vectors and a two-layer network.

Every token (a run of letters and digits, or of signs) has an index vector: a
few random signs that follow from its hash.  A token's context vector is the
sum of the index vectors next to it, over all documents; tokens share
``BUCKETS`` rows by hash, so the table has a fixed size and is summed cell by
cell in the shuffle.  A document is the mean and spread of its tokens'
vectors, the mean agreement of neighbours, and its length.

A two-layer network is fitted in numpy on a bounded sample of labelled
documents, and a temperature, chosen on documents the network has not seen,
turns its outputs into probabilities.  Neither doc_id, lang nor source is an
input.

Defined cases: null and empty texts have no token and the vector 0; with
labels of one kind only, all scores are that label's share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekwise.llm.common import Scratch, held_out
from weekwise.llm.labelled import FIT_ROWS, labelled_sample
from weekwise.llm.text_arrays import Words, any_tokens, chunks, mix

BUCKETS = 1 << 13
WIDTH = 32
SIGNS = 2                # entries of an index vector
REACH = 2                # neighbours on each side
BLOCK = 1 << 16          # tokens whose vectors are held at once
UNIT = 1 << 16           # of a vector's entries as integers
HIDDEN = 24
THRESHOLD = 0.7

_SEED = np.uint64(0xA4093822299F31D0)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, Words]:
    words = Words(texts, any_tokens(), lower=False)
    return (words.hashes & np.uint64(BUCKETS - 1)).astype(np.int64), words.word_offs, words


def _context(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of the context table, summed over a task."""
    table = np.zeros(BUCKETS * WIDTH, dtype=np.int64)
    for batch in chunks(batches, "text"):
        row, offs, words = _tokens(batch.column("text"))
        doc = np.repeat(np.arange(batch.num_rows), np.diff(offs))
        h = mix(words.hashes ^ _SEED)
        for k in range(SIGNS):
            bits = h >> np.uint64(8 * k)
            column = (bits & np.uint64(WIDTH - 1)).astype(np.int64)
            sign = np.where(bits & np.uint64(WIDTH), 1.0, -1.0)
            for step in range(1, REACH + 1):
                same = np.flatnonzero(doc[step:] == doc[:-step]) if len(doc) > step else np.zeros(0, np.int64)
                for at, beside in ((same, same + step), (same + step, same)):
                    table += np.bincount(row[at] * WIDTH + column[beside], sign[beside],
                                         len(table)).astype(np.int64)
    used = np.flatnonzero(table)
    yield pa.RecordBatch.from_pydict({"cell": pa.array(used, pa.int64()), "value": pa.array(table[used], pa.int64())})


def context_vectors(docs: DataFrame) -> np.ndarray:
    """Unit context vector of every bucket, from all documents.

    The table has BUCKETS * WIDTH cells whatever the input, so it may come to
    the driver.
    """
    cells = (docs.select("text").mapInArrow(_context, "cell long, value long")
             .groupBy("cell").agg(F.sum("value").alias("value")).toArrow())
    table = np.zeros(BUCKETS * WIDTH)
    table[cells.column("cell").to_numpy()] = cells.column("value").to_numpy()
    table = table.reshape(BUCKETS, WIDTH)
    table /= np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)
    return table.astype(np.float32)


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Mean, spread and agreement of neighbours of the token vectors, and length, of every text.

    Vectors are summed as integers, so a text has the same result in any company.
    """
    row, offs, _ = _tokens(texts)
    n = len(texts)
    count = np.diff(offs)
    vectors = np.rint(vectors * float(UNIT)).astype(np.int64)
    sums = np.zeros((3, n, WIDTH), dtype=np.int64)
    for a in range(0, len(row), BLOCK):
        v = vectors[row[a:a + BLOCK + 1]]
        doc = np.searchsorted(offs, np.arange(a, a + len(v)), "right") - 1
        beside = v[:-1] * v[1:] * (doc[:-1] == doc[1:])[:, None]
        v, doc = v[:BLOCK], doc[:BLOCK]
        ids, first = np.unique(doc, return_index=True)
        sums[0, ids] += np.add.reduceat(v, first)
        sums[1, ids] += np.add.reduceat(v * v, first)
        if len(beside):
            ids, first = np.unique(doc[:len(beside)], return_index=True)
            sums[2, ids] += np.add.reduceat(beside[:BLOCK], first)
    sums = sums / np.array([UNIT, UNIT ** 2, UNIT ** 2], dtype=float)[:, None, None]
    mean, square = sums[0] / np.maximum(count, 1)[:, None], sums[1] / np.maximum(count, 1)[:, None]
    spread = np.sqrt(np.maximum(square - mean ** 2, 0))
    agree = sums[2] / np.maximum(count - 1, 1)[:, None]
    return np.column_stack([mean, spread, agree, np.log1p(count)])


class Network:
    """Two layers: tanh units, then one logistic unit over a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 1500,
                 rate: float = 0.01, decay: float = 1e-3) -> None:
        rng = np.random.Generator(np.random.PCG64(7))
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        self.temperature = 1.0
        z = self._scaled(x)
        share = np.clip((weight * y).sum() / weight.sum(), 1e-3, 1 - 1e-3)
        p = {"a": rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), "b": np.zeros(HIDDEN),
             "c": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), "d": np.array(np.log(share / (1 - share)))}
        first = {k: np.zeros_like(v) for k, v in p.items()}
        second = {k: np.zeros_like(v) for k, v in p.items()}
        total = weight.sum()
        for t in range(1, steps + 1):
            hidden = np.tanh(z @ p["a"] + p["b"])
            out = 1 / (1 + np.exp(-np.clip(hidden @ p["c"] + p["d"], -30, 30)))
            error = weight * (out - y) / total
            back = np.outer(error, p["c"]) * (1 - hidden ** 2)
            grad = {"a": z.T @ back + decay * p["a"], "b": back.sum(0),
                    "c": hidden.T @ error + decay * p["c"], "d": error.sum()}
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p[k] = p[k] - rate * (first[k] / (1 - 0.9 ** t)) / (np.sqrt(second[k] / (1 - 0.999 ** t)) + 1e-8)
        self.p = p

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(self._scaled(x) @ self.p["a"] + self.p["b"]) @ self.p["c"] + self.p["d"]

    def calibrate(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """The temperature with the least log loss on these documents."""
        raw = self.logits(x)

        def loss(t: float) -> float:
            p = np.clip(1 / (1 + np.exp(-np.clip(raw / t, -30, 30))), 1e-9, 1 - 1e-9)
            return float(-(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum())

        self.temperature = float(min(np.geomspace(0.25, 8, 101), key=loss))

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


class Model:
    def __init__(self, vectors: np.ndarray, network: Network | float) -> None:
        self.vectors, self.network = vectors, network

    def score(self, texts: pa.Array) -> np.ndarray:
        if isinstance(self.network, float):
            return np.full(len(texts), self.network)
        return self.network.score(pooled(texts, self.vectors))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Vectors from all documents, network from at most ``rows`` of each label."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    sample, weight = labelled_sample(docs, labels, "quality", scratch, rows)
    vectors = context_vectors(docs)
    if len(weight) < 2:
        return Model(vectors, float(next(iter(weight), 0.5)))
    shared = spark.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            x = pooled(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_pydict({"x": pa.array(list(x), pa.list_(pa.float64())),
                                              "label": batch.column("label"), "fold": batch.column("fold"),
                                              "gram": batch.column("gram")})

    # one vector for each document of the sample, in an order of its own
    found = sample.mapInArrow(run, "x array<double>, label int, fold int, gram long").orderBy("gram", "label").collect()
    scratch.clear()
    x = np.array([r["x"] for r in found])
    y = np.array([r["label"] for r in found], dtype=float)
    w = np.array([weight[r["label"]] for r in found])
    own = np.array([r["fold"] != 0 for r in found])
    if min(own.sum(), (~own).sum()) < 10:
        own = np.ones(len(found), dtype=bool)
    network = Network(x[own], y[own], w[own])
    network.calibrate(*((x[~own], y[~own], w[~own]) if not own.all() else (x, y, w)))
    return Model(vectors, network)


def quality(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"),
                                              "score": pa.array(shared.value.score(batch.column("text")))})

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
