"""URL filter: a blocked Bloom filter of listed URLs before an exact hash join.

A list names hosts and path beginnings with a verdict each.  A listed entry
fits a URL if its host is the URL's or a parent domain of it and the URL's
path begins with its path; of those that fit, the longest decides.

1. Entries are canonical (host, path) pairs.  Each sets eight bits of one
   256-bit block, one bit in each of its 32-bit words; the blocks are built by
   an aggregation of the list and are at most ``FILTER_BYTES`` altogether.
2. An entry's shape is the number of its host's labels and the length of its
   path.  For every shape of the list a URL has at most one candidate: as many
   last labels, and the path cut to that length.  Candidates are probed in the
   filter, one block each.
3. Possible hits meet the list in an exact join, which removes the false ones.
   It joins the distinct candidates first, and brings what was found back to
   the URLs with hot entries (one that fits most of the pages) dealt to many
   tasks.  A filter that a very long list fills lets more candidates through;
   the result is the same.

Defined cases: a null URL, or one without ``://``, has an empty host and path;
nothing is listed for it.  Entries without a host or a path (null) are left
out; an entry listed with both verdicts blocks; repeated entries count once.
URLs that nothing fits get ``otherwise``.  Every row of ``pages`` is a row of
the result, repeated ones too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekwise.llm.bloom import FILTER_BYTES, BlockedBloom
from weekwise.llm.common import LOWER, UPPER, Scratch, salted_lookup


def url_host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """From the host on up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def _labels(host: Column) -> Column:
    return F.split(host, r"\.", -1)


def _key_hash(host: Column, path: Column) -> Column:
    return F.xxhash64(host, path)


def listed_entries(entries: DataFrame) -> DataFrame:
    """(l_host, l_path, verdict) of the list's distinct entries (host, path, verdict)."""
    return (entries.filter("host is not null and path is not null and verdict in ('allow', 'block')")
            .groupBy(F.translate("host", UPPER, LOWER).alias("l_host"), F.col("path").alias("l_path"))
            .agg(F.max("verdict").alias("verdict")))


def _shapes(listed: DataFrame) -> list[tuple[int, int]]:
    """Distinct (labels, path length) of the entries: no more than their lengths allow, whatever their number."""
    rows = listed.select(F.size(_labels(F.col("l_host"))).alias("n"), F.length("l_path").alias("m")).distinct()
    return sorted((r.n, r.m) for r in rows.collect())


def _candidate(shape: Column, labels: Column, path: Column) -> Column:
    """The (host, path) of a URL that an entry of this shape would have; null where the URL is too short."""
    return F.when((F.size(labels) >= shape["n"]) & (F.length(path) >= shape["m"]), F.struct(
        F.array_join(F.slice(labels, F.size(labels) - shape["n"] + 1, shape["n"]), ".").alias("l_host"),
        F.substr(path, F.lit(1), shape["m"]).alias("l_path")))


def _probe(urls: DataFrame, bloom: BlockedBloom) -> DataFrame:
    """(id, page_id, host, path, hits): which shapes' candidates may be listed."""
    words = urls.sparkSession.sparkContext.broadcast(bloom.words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = BlockedBloom(words.value)
        for batch in batches:
            lists = batch.column("hashes")
            flat, offsets = lists.flatten(), lists.offsets.to_numpy()
            offsets = offsets - offsets[0]
            there = np.flatnonzero(flat.is_valid().to_numpy(zero_copy_only=False))
            hashes = flat.drop_null().to_numpy()
            hit = there[held.may_hold(hashes)] if len(hashes) else there
            ends = np.searchsorted(hit, offsets).astype(np.int32)
            starts = np.repeat(offsets[:-1], np.diff(ends))
            hits = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array((hit - starts).astype(np.int32)))
            columns = [batch.column(c) for c in ("id", "page_id", "host", "path")]
            yield pa.RecordBatch.from_arrays([*columns, hits], ["id", "page_id", "host", "path", "hits"])

    kind = urls.schema["page_id"].dataType.simpleString()
    return urls.mapInArrow(run, f"id long, page_id {kind}, host string, path string, hits array<int>")


def judge(pages: DataFrame, entries: DataFrame, otherwise: str = "allow",
          filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(page_id, host, path, rule, verdict) per row of ``pages`` (page_id, url).

    ``rule`` is the host and path of the longest entry that fits.
    """
    scratch = Scratch(pages.sparkSession, "url-filter")
    listed = scratch.save(listed_entries(entries), "listed")
    shapes = _shapes(listed)
    urls = pages.select(F.monotonically_increasing_id().alias("id"), "page_id", url_host(F.col("url")).alias("host"),
                        url_path(F.col("url")).alias("path")).fillna("", ["host", "path"])
    if not shapes:
        return urls.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"),
                           F.lit(otherwise).alias("verdict"))
    fixed = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(m).alias("m")) for n, m in shapes])

    def hashes(labels: Column, path: Column) -> Column:
        def one(shape: Column) -> Column:
            c = _candidate(shape, labels, path)
            return F.when(c.isNotNull(), _key_hash(c["l_host"], c["l_path"]))
        return F.transform(fixed, one)

    bloom = BlockedBloom.build(listed.select(_key_hash(F.col("l_host"), F.col("l_path")).alias("h")), filter_bytes)
    probed = scratch.save(_probe(urls.withColumn("hashes", hashes(_labels(F.col("host")), F.col("path"))), bloom),
                          "probed")
    at = probed.filter(F.size("hits") > 0).withColumn("hit", F.explode("hits"))
    at = at.withColumn("c", _candidate(F.get(fixed, F.col("hit")), _labels(F.col("host")), F.col("path")))
    possible = at.select("id", "page_id", "host", "path", "c.l_host", "c.l_path")
    verified = scratch.save(possible.groupBy("l_host", "l_path").agg(F.count("*").alias("weight"))
                            .join(listed.hint("merge"), ["l_host", "l_path"]), "verified")
    met = salted_lookup(possible, verified, ["l_host", "l_path"], "weight", ["id"], "left")
    longest = F.max(F.when(F.col("verdict").isNotNull(), F.struct(
        (F.length("l_host") + F.length("l_path")).alias("size"), F.length("l_host").alias("deep"),
        F.concat("l_host", "l_path").alias("rule"), "verdict")))
    fits = met.groupBy("id").agg(*[F.first(c).alias(c) for c in ("page_id", "host", "path")], longest.alias("best"))
    judged = fits.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                         F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"))
    clear = probed.filter(F.size("hits") == 0).select(
        "page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(otherwise).alias("verdict"))
    return judged.unionByName(clear)
