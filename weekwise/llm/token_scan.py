"""Token counts by a separator scan of flat, unindexed token files.

``write_token_files`` tokenizes documents into flat files of 16-bit ids: the
ids of a document, then the end-of-document id, and nothing else, no index
and no lengths.  So that counts can be told apart afterwards, the ids begin
with digits of doc_id, written in ids beyond the vocabulary.

``count_tokens`` divides the files into blocks.  Each block is searched for
separators as one array, which gives the pieces of documents in it.  A prefix
scan over the blocks' separator counts numbers the documents of a file, and
the pieces that block borders cut are added up by that number.  Blocks have a
fixed size and files a bounded number of documents, so no task holds more
than a file and a block.

Defined cases: null and empty texts have no tokens; a null doc_id has a digit
of its own; repeated rows are counted one by one; a folder without token
files gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weekwise.llm.common import Scratch
from weekwise.llm.text_arrays import chunks

SEPARATOR = 50256        # the first id that the vocabulary leaves free
FIRST_DIGIT = SEPARATOR + 1
DIGIT_BITS = 11
DIGITS = 6               # of a 64-bit doc_id; digit 6 stands for a null one
BLOCK_TOKENS = 1 << 19
FILE_DOCUMENTS = 20_000


def _load(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    if max(ranks.values()) >= SEPARATOR:
        raise ValueError(f"the vocabulary leaves no room for the separator {SEPARATOR}")
    return tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _digits(doc_id: int | None) -> list[int]:
    if doc_id is None:
        return [FIRST_DIGIT + (DIGITS << DIGIT_BITS)]
    value = doc_id % 2**64
    return [FIRST_DIGIT + (k << DIGIT_BITS) + (value >> DIGIT_BITS * k & (1 << DIGIT_BITS) - 1)
            for k in range(DIGITS)]


def write_token_files(docs: DataFrame, path: str, tokenizer: tuple[str, str]) -> None:
    """Flat files of the documents' ids in ``path``; ``tokenizer`` is a rank file and its word pattern."""
    content = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(*content.value)
        for batch in chunks(batches, "text"):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                rows.append(np.array(_digits(doc_id) + encoding.encode_ordinary(text or ""), dtype="<u2").tobytes())
            yield pa.RecordBatch.from_pydict({"ids": pa.array(rows, pa.binary())})

    flat = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "ids binary")
    separator = SEPARATOR.to_bytes(2, "little").decode("latin-1")
    (flat.select(F.col("ids").cast("string").alias("value")).write
     .option("lineSep", separator).option("encoding", "ISO-8859-1")
     .option("maxRecordsPerFile", FILE_DOCUMENTS).text(path))


_ENCODINGS: dict[str, object] = {}


def _encoding(path: str, pattern: str):
    if path not in _ENCODINGS:
        _ENCODINGS[path] = _load(path, pattern)
    return _ENCODINGS[path]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of documents in each block, in their order."""
    for batch in batches:
        for path, k, raw in zip(*(batch.column(c).to_pylist() for c in ("path", "k", "block"))):
            ids = np.frombuffer(raw, dtype="<u2").astype(np.int64)
            at = np.flatnonzero(ids == SEPARATOR)
            n = len(at) + 1
            ends = np.append(at, len(ids))
            starts = np.append(0, at + 1)
            digit = ids >= FIRST_DIGIT
            place, value = np.divmod(ids[digit] - FIRST_DIGIT, 1 << DIGIT_BITS)
            piece = np.searchsorted(at, np.flatnonzero(digit))
            low, high, none = (np.zeros(n, dtype=np.int64) for _ in range(3))
            first = place < 3
            np.add.at(low, piece[first], value[first] << DIGIT_BITS * place[first])
            second = (place >= 3) & (place < DIGITS)
            np.add.at(high, piece[second], value[second] << DIGIT_BITS * (place[second] - 3))
            np.add.at(none, piece[place == DIGITS], 1)
            tokens = ends - starts - np.bincount(piece, minlength=n)
            yield pa.RecordBatch.from_pydict({
                "path": pa.array([path] * n, pa.string()), "k": pa.array(np.full(n, k), pa.int64()),
                "piece": pa.array(np.arange(n), pa.int64()), "separators": pa.array(np.full(n, n - 1), pa.int64()),
                "tokens": pa.array(tokens, pa.int64()), "low": pa.array(low), "high": pa.array(high),
                "none": pa.array(none)})


def count_tokens(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, n_tokens) of every document in the flat files of ``path``."""
    size = 2 * block_tokens
    files = spark.read.format("binaryFile").load(path).filter("length > 0")
    blocks = files.select("path", "content", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("length") - 1) / size))).alias("k")).select(
        "path", "k", F.substring("content", (F.col("k") * size + 1).cast("int"), F.lit(size)).alias("block"))
    pieces = blocks.mapInArrow(_pieces, "path string, k long, piece long, separators long, tokens long, "
                                        "low long, high long, none long")
    parts = ["tokens", "low", "high", "none"]
    inner = pieces.filter("piece > 0 and piece < separators").select(*parts)
    # a block's first and last piece may be parts of longer documents
    border = pieces.filter("piece = 0 or piece = separators")
    before = Window.partitionBy("path").orderBy("k").rangeBetween(Window.unboundedPreceding, -1)
    first = F.when(F.col("piece") == 0, F.col("separators"))
    numbered = border.withColumn("document", F.coalesce(F.sum(first).over(before), F.lit(0)) + F.col("piece"))
    whole = numbered.groupBy("path", "document").agg(
        *[F.sum(c).alias(c) for c in parts],
        F.max((F.col("piece") < F.col("separators")).cast("int")).alias("ended")).filter("ended = 1").select(*parts)
    value = F.shiftleft("high", 3 * DIGIT_BITS).bitwiseOR(F.col("low"))
    return inner.unionByName(whole).select(F.when(F.col("none") == 0, value).alias("doc_id"),
                                           F.col("tokens").alias("n_tokens"))


def document_token_counts(docs: DataFrame, tokenizer: tuple[str, str], block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, n_tokens) of every text, by way of token files in the shared folder.

    The counts are kept there too, so the token files can go at once.
    """
    scratch = Scratch(docs.sparkSession, "tokens")
    path = scratch.path("flat")
    write_token_files(docs, path, tokenizer)
    counts = scratch.save(count_tokens(docs.sparkSession, path, block_tokens), "counts")
    scratch.drop(path)
    return counts
