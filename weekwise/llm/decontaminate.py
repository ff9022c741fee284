"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Every window of ten consecutive words of a benchmark item (the whole item
when it is shorter) is hashed into a set that goes to all tasks.  Each task
hashes the word windows of its documents as arrays, keeps those found in the
set and compares the words of every hit, so equal hashes of different words
count for nothing.  There is no shuffle.

The set is bounded: it is kept as arrays, items are packed into parts whose
sets are at most about ``max_bytes``, and an item beyond that is cut into
pieces that overlap by a window less a word.  When there are several parts the
documents are scanned once per part, the findings kept in a table in the shared
folder between the scans; the driver holds one part at a time.

Defined cases: a null or empty text has no words; a null item text has no
windows; a null item_id counts as an empty one (both are one item) and is
written as an empty string in the digest; repeated items with one id count
once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekwise.llm.common import Scratch, fresh
from weekwise.llm.text_arrays import Words, alnum_words, chunks, mix, windows

WINDOW = 10
MAX_SET_BYTES = 32 << 20   # of one broadcast set, about
WORD_BYTES = 48            # of a word's window in the set, its text aside
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"   # as alnum_words() has them
_SECOND = np.uint64(0x452821E638D01377)

FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hits", T.ArrayType(T.LongType())),        # first word, end word, ... of hit runs
    T.StructField("items", T.ArrayType(T.StringType())),
])


class NgramSet:
    """Windows of benchmark items as arrays: sorted hashes by length, with the place and item of each."""

    def __init__(self, items: list[tuple[str, str | None]], window: int) -> None:
        self.words = words = Words(pa.array([t for _, t in items], pa.large_string()), alnum_words())
        self.ids = sorted({i for i, _ in items})
        number = {x: k for k, x in enumerate(self.ids)}
        owner = np.array([number[i] for i, _ in items], dtype=np.int64)
        sizes = np.diff(words.word_offs)
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.filter: dict[int, np.ndarray] = {}
        second = None
        for n in np.unique(np.minimum(sizes[sizes > 0], window)).tolist():
            at = np.flatnonzero(np.minimum(sizes, window) == n)
            count = sizes[at] - n + 1
            place = np.arange(count.sum()) + np.repeat(words.word_offs[at] - np.cumsum(count) + count, count)
            item = np.repeat(owner[at], count)
            second = mix(words.hashes ^ _SECOND) if second is None else second
            key, other = windows(words.hashes, n)[place], windows(second, n)[place]
            # an item that repeats a window has it once; hashes of 128 bits tell its windows apart
            order = np.lexsort((other, item, key))
            key, other, item, place = key[order], other[order], item[order], place[order]
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (item[1:] != item[:-1]) | (other[1:] != other[:-1])
            self.by_length[n] = key[new], item[new], place[new]
            bits = np.zeros(1 << max(16, int(new.sum() * 4).bit_length()), dtype=bool)
            bits[(key & np.uint64(len(bits) - 1)).astype(np.int64)] = True
            self.filter[n] = bits
        words.hashes = words.hashes[:0]      # served its purpose

    def nbytes(self) -> int:
        own = self.words.buf.nbytes + self.words.starts.nbytes + self.words.ends.nbytes
        return own + sum(x.nbytes for part in self.by_length.values() for x in part) + sum(
            x.nbytes for x in self.filter.values())

    def hits(self, words: Words) -> Iterator[tuple[int, int, set]]:
        """(first word, length, items) of each verified window, over all texts."""
        ends = words.word_offs
        for n, (keys, item, place) in self.by_length.items():
            h = words.windows(n)
            maybe = np.flatnonzero(self.filter[n][(h & np.uint64(len(self.filter[n]) - 1)).astype(np.int64)])
            if not len(maybe):
                continue
            first, last = np.searchsorted(keys, h[maybe]), np.searchsorted(keys, h[maybe], "right")
            doc_end = ends[np.searchsorted(ends, maybe, "right")]
            there = (last > first) & (maybe + n <= doc_end)
            for i, a, b in zip(maybe[there].tolist(), first[there].tolist(), last[there].tolist()):
                mine = [words.word(j) for j in range(i, i + n)]
                items = {self.ids[k] for k, p in zip(item[a:b].tolist(), place[a:b].tolist())
                         if all(self.words.word(p + j) == mine[j] for j in range(n))}
                if items:
                    yield i, n, items


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return edges[0::2], edges[1::2]


def _scan(batch: pa.RecordBatch, ngrams: NgramSet, last: bool) -> pa.RecordBatch:
    words = Words(batch.column("text"), alnum_words())
    n = len(words.starts)
    delta = np.zeros(n + 1, dtype=np.int32)
    items: dict[int, set] = {}
    for i, length, ids in ngrams.hits(words):
        delta[i] += 1
        delta[i + length] -= 1
        doc = int(np.searchsorted(words.word_offs, i, "right")) - 1
        items.setdefault(doc, set()).update(ids)
    hit = np.cumsum(delta[:n]) > 0
    out = []
    for k, before in enumerate(batch.column("found").to_pylist()):
        a, b = int(words.word_offs[k]), int(words.word_offs[k + 1])
        mask, ids = hit[a:b], items.get(k, set())
        if before is not None:
            for s, e in zip(before["hits"][0::2], before["hits"][1::2]):
                mask[s:e] = True
            ids = ids | set(before["items"])
        s, e = _runs(mask) if mask.any() else ((), ())
        out.append({"n_words": b - a, "hits": [int(x) for run in zip(s, e) for x in run],
                    "items": sorted(ids)})
    found = pa.array(out, pa.struct([("n_words", pa.int64()), ("hits", pa.list_(pa.int64())),
                                     ("items", pa.list_(pa.string()))]))
    columns = {"doc_id": batch.column("doc_id")} | ({} if last else {"text": batch.column("text")})
    return pa.RecordBatch.from_pydict(columns | {"found": found})


def find_overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  max_bytes: int = MAX_SET_BYTES) -> DataFrame:
    """(doc_id, found) of every document row; ``found`` is ``FOUND``."""
    spark = docs.sparkSession
    out = docs.select("doc_id", "text", F.lit(None).cast(FOUND).alias("found"))
    between = out.schema
    scratch = Scratch(spark, "decontaminate")
    for items, last in _parts(benchmark, max_bytes, window):
        ngrams = spark.sparkContext.broadcast(NgramSet(items, window))

        def scan(batches, ngrams=ngrams, last=last):
            for batch in chunks(batches, "text"):
                yield _scan(batch, ngrams.value, last)

        if last:
            return out.mapInArrow(scan, T.StructType([f for f in between if f.name != "text"]))
        out = scratch.save(out.mapInArrow(scan, between), "found")
    raise AssertionError("there is always a part")


def _pieces(item: str, text: str, n_words: int, window: int, words: int) -> Iterator[tuple[str, str, int]]:
    """An item of more than ``words`` words as several that have its windows among them."""
    if n_words <= words:
        yield item, text, n_words
        return
    spans = [m.span() for m in re.finditer(WORD, text)]
    for a in range(0, len(spans) - window + 1, words):
        end = min(len(spans), a + words + window - 1)
        yield item, text[spans[a][0]:spans[end - 1][1]], end - a


def _parts(benchmark: DataFrame, max_bytes: int, window: int) -> Iterator[tuple[list[tuple[str, str | None]], bool]]:
    """(items, last): benchmark items packed into parts whose sets are at most about ``max_bytes``.

    Spark counts the words; the driver reads the items partition by partition
    and holds one part, of which it makes the set that every task needs.
    """
    part: list[tuple[str, str | None]] = []
    size = 0
    most = max(window, max_bytes // (2 * WORD_BYTES))
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                            F.coalesce("text", F.lit("")).alias("text"),
                            F.regexp_count("text", F.lit(WORD)).alias("n"))
    for row in rows.toLocalIterator():
        for item, text, n in _pieces(row.item_id, row.text, row.n or 0, window, most):
            cost = len(text.encode()) + WORD_BYTES * n
            if part and size + cost > max_bytes:
                yield part, False
                part, size = [], 0
            part.append((item, text))
            size += cost
    yield part, True


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  max_bytes: int = MAX_SET_BYTES) -> DataFrame:
    """Digest per document: word, hit and item counts."""
    found = find_overlaps(docs, benchmark, window, max_bytes)
    # the runs are first word, end word, first word, ...: ends count up, starts down
    n_hit = F.aggregate(F.transform("found.hits", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)),
                        F.lit(0).cast("long"), lambda total, x: total + x)
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("found.hits") > 0).alias("contaminated"),
    )


def remove_overlaps(docs: DataFrame, benchmark: DataFrame, whole: bool = False,
                    window: int = WINDOW, max_bytes: int = MAX_SET_BYTES) -> DataFrame:
    """Documents without benchmark passages, in the columns of ``docs``.

    Hit words are cut out of the text with what stands between them
    (``whole``: contaminated documents go instead).  A document of which only
    white space remains goes too; an uncontaminated one always stays.
    ``n_chars`` follows the new text where that column exists and is set.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    marks = fresh(docs.columns, "marks")
    out = docs.withColumn(marks, F.lit(None).cast(T.ArrayType(T.LongType())))
    between = out.schema
    for items, last in _parts(benchmark, max_bytes, window):
        ngrams = spark.sparkContext.broadcast(NgramSet(items, window))

        def cut(batches, ngrams=ngrams, last=last):
            for batch in chunks(batches, "text"):
                marked = _mark(batch, ngrams.value, marks)
                yield _apply(marked, marks, whole) if last else marked

        if last:
            out = out.mapInArrow(cut, docs.schema)
        else:  # cutting now could hide windows of later parts
            out = scratch.save(out.mapInArrow(cut, between), "marks")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text"))
                             .cast(docs.schema["n_chars"].dataType))
    return out


def _mark(batch: pa.RecordBatch, ngrams: NgramSet, marks: str) -> pa.RecordBatch:
    words = Words(batch.column("text"), alnum_words())
    found = [x or [] for x in batch.column(marks).to_pylist()]
    for i, n, _ in ngrams.hits(words):
        doc = int(np.searchsorted(words.word_offs, i, "right")) - 1
        base = int(words.offs[doc])
        found[doc] += [int(words.starts[i]) - base, int(words.ends[i + n - 1]) - base]
    return batch.set_column(batch.schema.get_field_index(marks), marks,
                            pa.array(found, pa.list_(pa.int64())))


def _apply(batch: pa.RecordBatch, marks: str, whole: bool) -> pa.RecordBatch:
    texts, keep = batch.column("text").to_pylist(), np.ones(batch.num_rows, dtype=bool)
    for k, found in enumerate(batch.column(marks).to_pylist()):
        if not found:
            continue
        raw = np.frombuffer(texts[k].encode(), dtype=np.uint8)
        cover = np.zeros(len(raw) + 1, dtype=np.int32)
        np.add.at(cover, found[0::2], 1)
        np.add.at(cover, found[1::2], -1)
        texts[k] = raw[np.cumsum(cover[:-1]) == 0].tobytes().decode()
        keep[k] = not whole and bool(texts[k].strip())
    out = batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))
    out = out.select([c for c in out.schema.names if c != marks])
    return out.filter(pa.array(keep))


def item_digest(ids: list[str]) -> str:
    """The digest of item ids that the query reports (for tests)."""
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
