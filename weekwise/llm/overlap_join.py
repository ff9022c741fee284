"""N-gram Jaccard join by T-occurrence search, exact for a given threshold.

Documents are sets of hashed word 3-grams.  A query document is linked with
those that occur on at least T of its grams' inverted lists, T following from
both sizes.  The search is DivideSkip: the longest lists are set aside, the
short ones are heap-merged with skipping, and what reaches T less the number
of long lists is probed in them by binary search.

Spark decides which documents meet in one index:

1. Equal sets become one set; copies never meet each other.
2. The grams of a set are dealt to H + AGREE parts by their hash, H being the
   most grams in which two linked sets of that size can differ.  Linked sets
   agree in AGREE whole parts, so they share as many buckets (part, its
   grams).  Sizes are banded, and a set deals its grams for its own band and,
   where it can have partners there, for the one below.
   An empty part says little: it is named twice, with either half of the next
   part's grams.  Of linked sets that agree in an empty part, one half agrees
   too unless the next part differs in two grams; then they agree in one
   more part elsewhere, so the count of shared buckets stands.  A part that is
   empty beside an empty half names nothing.  A set with w such parts shares
   AGREE - w other buckets with any partner; only a set with w >= AGREE, which
   is rare, has buckets for these parts too, as two such sets may share no others.
   Sets with fewer shared buckets than they need go, and with them their
   buckets; this leaves few sets that merely share a passage.
3. In every bucket the smallest member is a pivot; it searches the members
   that have it as pivot in as many buckets as they need to share.  That is
   linear in the buckets, and joins most groups of copies.
4. Only buckets whose members then belong to several components go on.  A
   search over the lists of these buckets, still without grams, finds which
   sets may be linked across components; they form blocks, in which every
   member queries the members of other components.  Blocks of more than
   ``BLOCK_SETS`` sets are dealt to pairs of chunks.

Grams are sent last.  A set has a row of parity bits, a thirtieth of its grams:
two sets differ in at least as many grams as bits, so most pairs that merely
share a passage go without a gram.  Bucket entries, nearly all of which are
alone in their bucket, are counted in slices of which each is freed before the
next.

So the work follows the buckets that are still undecided, no pair within a
decided group is made, and nothing is capped.  Tests hold it to brute force.

Defined cases: null and empty texts have no set and are linked with nothing;
a null doc_id is never the smallest; rows with one doc_id count as they are.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekwise.llm.bloom import FILTER_BYTES, BlockedBloom
from weekwise.llm.common import Scratch, fresh, salted_lookup
from weekwise.llm.components import components
from weekwise.llm.text_arrays import Words, chunks, mix, space_words

SHINGLE = 3
THRESHOLD = (90, 100)    # intersection / union
AGREE = 8                # parts that linked sets agree in, at least
FILTER_ROUNDS = 1
PIVOT_SETS = 256         # sets searched with a pivot in one index
BLOCK_SETS = 8192        # sets of one index in step 4
INDEX_GRAMS = 4_000_000  # grams of one index, about
PROBED = 256             # long lists that are probed at once
HEAP_ENTRIES = 2000      # entries of short lists that a heap merges
ENTRY_BYTES = 24         # of a bucket entry in a shuffle, before compression
SLICE_BYTES = 64 << 20   # of bucket entries that are not worth a further slice
SLICE_ENTRIES = 1 << 26  # bucket entries of a slice, at most about

_HALVES = np.array([0x452821E638D01377, 0xBE5466CF34E90C6C], dtype=np.uint64)
_SEED_A, _SEED_B = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)


class Bands:
    """Size bands: linked sets lie in one band or in neighbours.

    A band is some steps of the size ratio that linked sets can have wide,
    together about ``WIDTH``, so that only sets near its lower end have
    partners below it.
    """

    WIDTH = 1.37

    def __init__(self, threshold: tuple[int, int]) -> None:
        self.num, self.den = threshold
        self.steps = max(1, round(np.log(self.WIDTH) / np.log(self.den / self.num)))
        self.lows = [1]

    def _largest(self, n: int) -> int:
        """Largest set that one of size n can be linked with."""
        return n * self.den // self.num

    def smallest(self, n: int) -> int:
        return -(-n * self.num // self.den)

    def band(self, n: int) -> int:
        while self.lows[-1] <= n:
            low = self.lows[-1]
            for _ in range(self.steps):
                low = self._largest(low) + 1
            self.lows.append(low)
        return bisect_left(self.lows, n + 1) - 1

    def low(self, band: int) -> int:
        return self.lows[band]

    def differ(self, band: int) -> int:
        """Most grams in which a set of this band differs from a linked one that is no smaller."""
        top = self.lows[band + 1] - 1
        return (top + self._largest(top)) * (self.den - self.num) // (self.den + self.num)


def needed(a: int, b: int, threshold: tuple[int, int]) -> int:
    """Smallest intersection of linked sets of sizes a and b."""
    num, den = threshold
    return -(-num * (a + b) // (num + den))


def gram_sets(words: Words, shingle: int) -> list[np.ndarray]:
    """Sorted distinct grams of each text."""
    grams = words.windows(shingle)
    out = []
    for a, b in zip(words.word_offs[:-1].tolist(), words.word_offs[1:].tolist()):
        if b - a >= shingle:
            out.append(np.unique(grams[a:b - shingle + 1]))
        elif b > a:
            h = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for x in words.hashes[a:b]:
                    h = h * np.uint64(0xD6E8FEB86659FD93) + x
            out.append(mix(np.array([h ^ _SEED_B])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _sums(values: np.ndarray, part: np.ndarray, parts: int) -> np.ndarray:
    """Sum of 64-bit values by part, modulo 2**64."""
    out = np.zeros(parts, dtype=np.uint64)
    order = np.argsort(part, kind="stable")
    ids, first = np.unique(part[order], return_index=True)
    out[ids] = np.add.reduceat(values[order], first)
    return out


def bucket_names(grams: np.ndarray, bands: Bands) -> tuple[list[int], int]:
    """The buckets of a set, as signed 64-bit integers, and how many of them it shares with any linked set."""
    out: list[np.ndarray] = []
    need = AGREE
    own = bands.band(len(grams))
    spread = mix(grams ^ _SEED_A)
    for band in (own, own - 1):
        if band < own and bands.smallest(len(grams)) >= bands.low(own):
            continue  # no partner in the band below
        if (differ := bands.differ(band)) == 0:
            continue  # only equal sets are linked at this size
        parts = differ + AGREE
        part = (grams % np.uint64(parts)).astype(np.int64)
        size = np.bincount(part, minlength=parts)
        content = _sums(spread, part, parts)
        label = mix((np.arange(parts, dtype=np.uint64) << np.uint64(16)) + np.uint64(band) + _SEED_B)
        full = size > 0
        out.append(mix(content[full] ^ label[full]))
        if full.all():
            continue
        empty = np.flatnonzero(~full)
        side = ((grams >> np.uint64(40)) & np.uint64(1)).astype(np.int64)
        halves = _sums(spread, 2 * part + side, 2 * parts).reshape(parts, 2) + _HALVES
        after = (empty + 1) % parts
        blank = np.bincount(2 * part + side, minlength=2 * parts).reshape(parts, 2)[after] == 0
        weak = blank.any(axis=1)
        need = min(need, max(1, AGREE - int(weak.sum())))
        for half in (0, 1):
            named = np.ones(len(empty), dtype=bool) if weak.sum() >= AGREE else ~blank[:, half]
            out.append(mix(mix(label[empty[named]]) ^ halves[after[named], half]))
    return (np.unique(np.concatenate(out)).view(np.int64).tolist() if out else []), need


def _as_long(x: np.uint64) -> int:
    return int(np.array([x], dtype=np.uint64).view(np.int64)[0])


def parity_bits(grams: np.ndarray) -> bytes:
    """A bit per cell, for cells that an odd number of grams falls into.

    There are at least two cells a gram, a power of two, so that a longer
    row of bits folds to a shorter one.
    """
    cells = max(64, 1 << (2 * len(grams) - 1).bit_length())
    cell = (grams >> np.uint64(20)) & np.uint64(cells - 1)
    odd = np.bincount(cell.astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """Grams that are in one of two sets only: at least so many, by their parity bits."""
    x, y = sorted((np.frombuffer(v, np.uint8) for v in (a, b)), key=len)
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum(dtype=np.int64))


def describe_sets(docs: DataFrame, shingle: int, threshold: tuple[int, int]) -> DataFrame:
    """(doc_id, size, n, k1, k2, buckets, need, bits) per row.

    Bytes of the text; size, 128-bit name, buckets and parity bits of its set.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(threshold)
        for batch in chunks(batches, "text"):
            sets = gram_sets(Words(batch.column("text"), space_words()), shingle)
            with np.errstate(over="ignore"):
                named = [bucket_names(s, bands) if len(s) else ([], 0) for s in sets]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id"),
                    "size": pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64()),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "k1": pa.array([_as_long(np.sum(mix(s ^ _SEED_A), dtype=np.uint64)) for s in sets], pa.int64()),
                    "k2": pa.array([_as_long(np.sum(mix(s ^ _SEED_B), dtype=np.uint64)) for s in sets], pa.int64()),
                    "buckets": pa.array([b for b, _ in named], pa.list_(pa.int64())),
                    "need": pa.array([n for _, n in named], pa.int32()),
                    "bits": pa.array([parity_bits(s) for s in sets], pa.binary()),
                })

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, size long, n long, k1 long, k2 long, buckets array<long>, need int, bits binary")


def _shared_buckets(described: DataFrame, scratch: Scratch, slice_bytes: int) -> DataFrame:
    """(rid, bucket): entries of buckets that different sets name, and few others.

    Nearly all entries are alone in their bucket.  The buckets are worked in
    slices, so that the shuffle of one slice is at most about half as large
    as the texts, and freed before the next.  A slice finds its buckets with
    two different sets; a Bloom filter of these is all that the entries meet,
    so they are not shuffled again.  A filter belongs to its slice, and slices
    follow the number of entries, so it stays as small and as exact at any
    size of the input.
    """
    entries, size = described.agg(F.sum(F.size("buckets")), F.sum("size")).head()
    volume = ENTRY_BYTES * (entries or 0)
    slices = max(1, -(-(entries or 0) // SLICE_ENTRIES), min(-(-2 * volume // max(1, size or 0)), -(-volume // slice_bytes)))
    out = None
    for k in range(slices):
        inside = described.select("k1", F.explode("buckets").alias("h")).filter(F.pmod("h", F.lit(slices)) == k)
        shared = scratch.save(inside.groupBy("h").agg(F.min("k1").alias("lo"), F.max("k1").alias("hi"))
                              .filter("lo <> hi").select("h"), "shared")
        held = described.sparkSession.sparkContext.broadcast(BlockedBloom.build(shared, FILTER_BYTES).words)

        def run(batches: Iterator[pa.RecordBatch], k: int = k, held=held) -> Iterator[pa.RecordBatch]:
            bloom = BlockedBloom(held.value)
            for batch in batches:
                lists = batch.column("buckets")
                flat = lists.flatten().to_numpy()
                owner = np.repeat(batch.column("rid").to_numpy(), np.diff(lists.offsets.to_numpy()))
                mine = np.flatnonzero(flat % slices == k)
                mine = mine[bloom.may_hold(flat[mine])]
                yield pa.RecordBatch.from_pydict({"rid": owner[mine], "bucket": flat[mine]})

        hits = scratch.save(described.select("rid", "buckets").mapInArrow(run, "rid long, bucket long"), "hits")
        scratch.drop(shared)
        scratch.sweep()
        out = hits if out is None else out.unionByName(hits)
    return out


def _set_grams(docs: DataFrame, shingle: int, wanted: DataFrame) -> DataFrame:
    """(n, k1, k2, grams) of the rows whose doc_id is a ``rep`` of ``wanted``, and of few others.

    A Bloom filter tells them where the texts are, so no text is shuffled.
    """
    key = F.xxhash64(F.lit(7), F.col("doc_id"))
    words = docs.sparkSession.sparkContext.broadcast(BlockedBloom.build(
        wanted.select(F.xxhash64(F.lit(7), F.col("rep")).alias("h")), 4 * FILTER_BYTES).words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = BlockedBloom(words.value)
        held = (batch.filter(pa.array(bloom.may_hold(batch.column("h").to_numpy()))) for batch in batches)
        for batch in chunks(held, "text"):
            sets = [s for s in gram_sets(Words(batch.column("text"), space_words()), shingle) if len(s)]
            yield pa.RecordBatch.from_pydict({
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "k1": pa.array([_as_long(np.sum(mix(s ^ _SEED_A), dtype=np.uint64)) for s in sets], pa.int64()),
                "k2": pa.array([_as_long(np.sum(mix(s ^ _SEED_B), dtype=np.uint64)) for s in sets], pa.int64()),
                "grams": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
            })

    return docs.select(key.alias("h"), "text").mapInArrow(run, "n long, k1 long, k2 long, grams array<long>")


def _merge_skip(lists: list[list[int]], count: int) -> Iterator[tuple[int, int]]:
    """(member, occurrences) of members on at least ``count`` sorted lists, by a heap with skipping."""
    heap = [(x[0], k, 0) for k, x in enumerate(lists) if x]
    heapq.heapify(heap)
    while len(heap) >= count:
        member = heap[0][0]
        popped = []
        while heap and heap[0][0] == member:
            popped.append(heapq.heappop(heap))
        after = member + 1
        if len(popped) >= count:
            yield member, len(popped)
        else:  # what stands below the head that is then left is on too few lists
            while heap and len(popped) < count - 1:
                popped.append(heapq.heappop(heap))
            if not heap:
                return
            after = max(after, heap[0][0])
        for _, k, at in popped:
            at = bisect_left(lists[k], after, at)
            if at < len(lists[k]):
                heapq.heappush(heap, (lists[k][at], k, at))


def divide_skip(lists: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Members on at least ``least`` of the sorted lists, and on how many they are.

    The longest lists are set aside and the others merged, by a heap or, if
    they have more than ``HEAP_ENTRIES`` entries, as runs; what the merge
    leaves is looked for in the long lists by binary search, ``PROBED`` lists
    at once, and given up when the lists that remain cannot make up the count.
    Lists with fewer entries than there would be probes are read through.
    """
    lists = sorted((x for x in lists if len(x)), key=len)
    none = np.zeros(0, np.int64)
    if least <= 0 or len(lists) < least:
        return none, none
    n_long = min(least - 1, int(least / (0.0085 * np.log2(len(lists[-1]) + 1) + 1)))
    short, long = lists[:len(lists) - n_long], lists[len(lists) - n_long:]
    count = least - n_long
    if sum(map(len, short)) <= HEAP_ENTRIES:
        merged = list(_merge_skip([x.tolist() for x in short], count))
        members, seen = np.array(merged, dtype=np.int64).reshape(-1, 2).T
    else:  # the same merge, of all runs at once
        occurs = np.bincount(np.concatenate(short))
        members = np.flatnonzero(occurs >= count)
        seen = occurs[members]
    for k in range(0, len(long), PROBED):
        able = seen + len(long) - k >= least
        members, seen = members[able], seen[able]
        if not len(members):
            break
        run = long[k:k + PROBED]
        entries = np.concatenate(run)
        if len(members) * len(run) > len(entries):  # fewer entries than probes: read them
            seen = seen + np.bincount(entries, minlength=int(members[-1]) + 1)[members]
            continue
        width = np.int64(max(int(x[-1]) for x in run) + int(members[-1]) + 1)
        keyed = entries + width * np.repeat(np.arange(len(run)), [len(x) for x in run])
        probes = (members[:, None] + width * np.arange(len(run))[None, :]).ravel()
        at = np.minimum(np.searchsorted(keyed, probes), len(keyed) - 1)
        seen = seen + (keyed[at] == probes).reshape(len(members), -1).sum(axis=1)
    enough = seen >= least
    return members[enough], seen[enough]


class Index:
    """Inverted lists of some sets: the lists one after the other, in the order of their grams."""

    def __init__(self, grams: list[np.ndarray]) -> None:
        self.sizes = np.array([len(g) for g in grams], dtype=np.int64)
        flat = np.concatenate(grams) if grams else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(grams)), self.sizes)
        order = np.lexsort((owner, flat))
        self.values, first = np.unique(flat[order], return_index=True)
        self.members = owner[order]
        self.bounds = np.append(first, len(order))

    def sharing(self, query: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Members that have at least ``least`` entries of the query, and how many they have."""
        at = np.minimum(np.searchsorted(self.values, query), len(self.values) - 1)
        at = at[self.values[at] == query]
        found = [self.members[a:b] for a, b in zip(self.bounds[at].tolist(), self.bounds[at + 1].tolist())]
        return divide_skip(found, least)

    def search(self, query: np.ndarray, threshold: tuple[int, int]) -> list[int]:
        num, den = threshold
        n = len(query)
        fit = self.sizes[(self.sizes * den >= num * n) & (n * den >= num * self.sizes)]
        if not len(fit):
            return []
        members, seen = self.sharing(query, needed(n, int(fit.min()), threshold))
        return [m for m, s in zip(members.tolist(), seen.tolist()) if s >= needed(n, int(self.sizes[m]), threshold)]


def _groups(batches: Iterator[pa.RecordBatch], key: str, array: str = "grams") -> Iterator[list[dict]]:
    """Rows of one key at a time, from batches sorted by it; ``array`` is a column of numbers."""
    rows: list[dict] = []
    for batch in batches:
        columns = {c: batch.column(c) for c in batch.schema.names}
        keys = columns[key].to_pylist()
        lists = columns[array]
        flat, offs = lists.flatten().to_numpy(), lists.offsets.to_numpy()
        offs = offs - offs[0]
        others = {c: v.to_pylist() for c, v in columns.items() if c not in (array, key)}
        for i, k in enumerate(keys):
            if rows and rows[-1][key] != k:
                yield rows
                rows = []
            rows.append({key: k, array: flat[offs[i]:offs[i + 1]].copy()} | {c: v[i] for c, v in others.items()})
    if rows:
        yield rows


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in pairs], pa.int64()),
                                       "b": pa.array([b for _, b in pairs], pa.int64())})


def _may_link(threshold: tuple[int, int]):
    """Pairs whose parity bits do not rule the link out."""
    num, den = threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("n", "m", "bits", "other")))
            able = [min(n, m) * den >= num * max(n, m)
                    and least_difference(x, y) <= n + m - 2 * needed(n, m, threshold) for n, m, x, y in rows]
            yield batch.select(["pivot", "sid"]).filter(pa.array(able, pa.bool_()))

    return run


def _pivot_pairs(members: DataFrame, sets: DataFrame, threshold: tuple[int, int], scratch: Scratch) -> DataFrame:
    """(pivot, sid): members with a pivot they have in as many buckets as they need to share, and may be linked with.

    Each differing gram turns one parity bit, so two sets differ in at least
    as many grams as bits differ.  Pairs that so differ in too many to be
    linked go, before any gram is sent.
    """
    often = members.filter("sid <> pivot").groupBy("pivot", "sid").agg(F.count("*").alias("has"))
    own = sets.select("sid", "need", "n", "bits")
    pairs = scratch.save(often.join(own.hint("merge"), "sid").filter("has >= need").select("pivot", "sid"), "met")
    heads = pairs.groupBy("pivot").agg(F.count("*").alias("weight")).join(
        sets.select(F.col("sid").alias("pivot"), F.col("n").alias("m"), F.col("bits").alias("other")), "pivot")
    both = salted_lookup(pairs, scratch.save(heads, "heads"), ["pivot"], "weight", ["sid"]).join(
        own.drop("need").hint("merge"), "sid")
    return scratch.save(both.mapInArrow(_may_link(threshold), "pivot long, sid long"), "pivot-pairs")


def _pivot_links(pairs: DataFrame, grams: DataFrame, threshold: tuple[int, int], scratch: Scratch) -> DataFrame:
    """Links between pivots and the sets paired with them.

    Linked sets that share buckets of two only are found here, as they have
    each other in all of them; other links are found here or in the blocks.
    """
    sizes = pairs.join(grams.select("sid", "n").hint("merge"), "sid").groupBy("pivot").agg(
        F.count("*").alias("weight"), F.sum("n").alias("n"))
    sizes = sizes.withColumn("parts", F.ceil(F.greatest(
        F.col("weight") / PIVOT_SETS, F.col("n") / INDEX_GRAMS)).cast("int"))
    sizes = scratch.save(sizes, "pivot-sizes")
    dealt = salted_lookup(pairs, sizes.select("pivot", "parts", "weight"), ["pivot"], "weight", ["sid"])
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int"))
    heads = sizes.select("pivot", F.col("pivot").alias("sid"),
                         F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    rows = (dealt.select("pivot", "sid", "part").unionByName(heads)
            .join(grams.select("sid", "grams").hint("merge"), "sid")
            .select(F.concat_ws(":", "pivot", "part").alias("at"), "pivot", "sid", "grams"))
    dealt_out = rows.repartition("at").sortWithinPartitions("at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "at"):
            pivot = group[0]["pivot"]
            head = next(r["grams"] for r in group if r["sid"] == pivot)
            rest = [r for r in group if r["sid"] != pivot]
            found = Index([r["grams"] for r in rest]).search(head, threshold)
            yield _links([(pivot, rest[i]["sid"]) for i in found])

    return dealt_out.mapInArrow(run, "a long, b long")


class _Roots:
    """Union-find over the components that meet in a block."""

    def __init__(self, ids) -> None:
        self.up = {x: x for x in ids}

    def top(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.top(a), self.top(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _cross_links(asking: list[dict], answering: list[dict], often: int, roots: _Roots,
                 threshold: tuple[int, int]) -> list[tuple[int, int]]:
    """Links that join components, from queries of all but the most frequent one."""
    asking = [q for q in asking if q["root"] != often]
    pairs = []
    if asking:
        index = Index([r["grams"] for r in answering])
        for q in asking:
            for i in index.search(q["grams"], threshold):
                if roots.join(q["root"], answering[i]["root"]):
                    pairs.append((q["root"], answering[i]["root"]))
    return pairs


def _dealt(rows: DataFrame, sizes: DataFrame, block_sets: int) -> DataFrame:
    """``rows`` of blocks, dealt to pairs of chunks (at, part) by the blocks' ``sizes`` (block, weight, n)."""
    sizes = sizes.withColumn("parts", F.ceil(F.greatest(
        F.col("weight") / block_sets, F.col("n") / INDEX_GRAMS)).cast("int"))
    rows = salted_lookup(rows, sizes.select("block", "parts", "weight"), ["block"], "weight", ["sid"])
    rows = rows.withColumn("part", F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return rows.withColumn("at", F.concat_ws(":", "block", F.least("part", "other"), F.greatest("part", "other")))


def _chunks_of(group: list[dict]) -> Iterator[tuple[list[dict], list[dict]]]:
    """(asking, answering) rows of a group: a chunk with itself, or two chunks both ways."""
    lo, hi = map(int, group[0]["at"].split(":")[1:])
    first, second = ([r for r in group if r["part"] == p] for p in (lo, hi))
    yield first, second
    if lo != hi:
        yield second, first


def _candidate_links(blocks: DataFrame, threshold: tuple[int, int], block_sets: int) -> DataFrame:
    """A forest (a, b) over the sets of blocks that may be linked across components.

    ``blocks`` has (block, sid, root, need, n, bits, buckets).  The search is
    the same T-occurrence search, over the lists of buckets: sets that may be
    linked share as many of these as they need, and their parity bits allow it.
    """
    sizes = blocks.groupBy("block").agg(F.count("*").alias("weight"), F.sum(F.size("buckets")).alias("n"))
    rows = _dealt(blocks, sizes, block_sets)
    columns = ["at", "part", "sid", "root", "need", "n", "bits", "buckets"]
    dealt_out = rows.select(*columns).repartition("at").sortWithinPartitions("at")
    num, den = threshold

    def able(q: dict, r: dict, shared: int) -> bool:
        n, m = q["n"], r["n"]
        return (q["root"] != r["root"] and shared >= r["need"] and min(n, m) * den >= num * max(n, m)
                and least_difference(q["bits"], r["bits"]) <= n + m - 2 * needed(n, m, threshold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "at", "buckets"):
            if len({r["root"] for r in group}) == 1:
                continue
            forest, pairs = _Roots(r["sid"] for r in group), []
            for asking, answering in _chunks_of(group):
                index = Index([np.sort(r["buckets"]) for r in answering])
                for q in asking if answering else ():
                    members, shared = index.sharing(q["buckets"], q["need"])
                    for i, k in zip(members.tolist(), shared.tolist()):
                        r = answering[i]
                        if forest.top(q["sid"]) != forest.top(r["sid"]) and able(q, r, k):
                            forest.join(q["sid"], r["sid"])
                            pairs.append((q["sid"], r["sid"]))
            yield _links(pairs)

    return dealt_out.mapInArrow(run, "a long, b long")


def _block_links(blocks: DataFrame, grams: DataFrame, threshold: tuple[int, int], block_sets: int) -> DataFrame:
    """Links within blocks (block, sid, root) between sets of different roots."""
    sizes = blocks.join(grams.select("sid", "n").hint("merge"), "sid").groupBy("block").agg(
        F.count("*").alias("weight"), F.sum("n").alias("n"))
    rows = _dealt(blocks, sizes, block_sets).join(grams.select("sid", "grams").hint("merge"), "sid")
    dealt_out = rows.select("at", "part", "root", "grams").repartition("at").sortWithinPartitions("at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "at"):
            count = Counter(r["root"] for r in group)
            if len(count) == 1:
                continue
            # of two sets of different components one is not of the most frequent one
            often, roots = count.most_common(1)[0][0], _Roots(count)
            pairs = []
            for asking, answering in _chunks_of(group):
                pairs += _cross_links(asking, answering, often, roots, threshold)
            yield _links(pairs)

    return dealt_out.mapInArrow(run, "a long, b long")


def _in_blocks(sets: DataFrame, named: DataFrame, how: str) -> DataFrame:
    """``sets`` with the name of their component in ``named`` (id, root) as ``block``."""
    named = named.select(F.col("id").alias("sid"), F.col("root").alias("block"))
    return sets.join(named.hint("merge"), "sid", how).withColumn("block", F.coalesce("block", "sid"))


def _grams_of(docs: DataFrame, shingle: int, sids: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """(sid, n, grams) of the sets asked for; any document of a set serves."""
    wanted = scratch.save(sids.distinct().join(sets.select("sid", "rep", "n", "k1", "k2"), "sid"), "wanted")
    found = _set_grams(docs, shingle, wanted).join(wanted.select("sid", "n", "k1", "k2").hint("merge"), ["n", "k1", "k2"])
    grams = scratch.save(found.select("sid", "n", "grams").dropDuplicates(["sid"]), "grams")
    scratch.drop(wanted)
    scratch.sweep()
    return grams


def labelled_rows(docs: DataFrame, shingle: int = SHINGLE, threshold: tuple[int, int] = THRESHOLD,
                  block_sets: int = BLOCK_SETS, slice_bytes: int = SLICE_BYTES) -> tuple[DataFrame, Scratch]:
    """(doc_id, n, k1, k2, root, component_id) per row of ``docs`` with a set, and the rows without one.

    ``root`` names the component; ``component_id`` is the smallest doc_id that links reach.
    """
    scratch = Scratch(docs.sparkSession, "near-duplicates")
    described = scratch.save(describe_sets(docs, shingle, threshold).withColumn(
        "rid", F.monotonically_increasing_id()), "described")
    rows = scratch.save(described.select("doc_id", "n", "k1", "k2"), "rows")
    sets = described.filter("n > 0").groupBy("n", "k1", "k2").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("weight"), F.min("rid").alias("rid"))
    sets = scratch.save(sets.withColumn("sid", F.monotonically_increasing_id()), "sets")
    hits = _shared_buckets(described, scratch, slice_bytes)
    # one row of each set; a set without as many shared buckets as it needs has no partner
    named = hits.join(sets.select("rid", "sid").hint("merge"), "rid").select("rid", "sid", "bucket")
    named = scratch.save(named, "named")
    there = named.groupBy("rid", "sid").agg(F.count("*").alias("has"))
    known = scratch.save(described.select("rid", "n", "need", "bits").join(there.hint("merge"), "rid")
                         .filter("has >= need").drop("has", "rid"), "known")
    scratch.drop(described)
    scratch.sweep()
    left = scratch.save(named.select("bucket", "sid").join(known.select("sid").hint("merge"), "sid"), "able")
    scratch.drop(named)
    for again in range(1 + FILTER_ROUNDS):
        shared = left.groupBy("bucket").agg(F.count("*").alias("weight"), F.min("sid").alias("pivot"))
        shared = scratch.save(shared.filter("weight > 1"), "shared")
        members = scratch.save(salted_lookup(left, shared, ["bucket"], "weight", ["sid"]), "members")
        scratch.drop(left, shared)
        if again < FILTER_ROUNDS:
            able = (members.groupBy("sid").agg(F.count("*").alias("has")).join(known.select("sid", "need"), "sid")
                    .filter("has >= need").select("sid"))
            left = scratch.save(members.select("bucket", "sid").join(able.hint("merge"), "sid"), "able")
            scratch.drop(members)
    scratch.sweep()
    pairs = _pivot_pairs(members, known, threshold, scratch)
    asked = pairs.select("sid").unionByName(pairs.select(F.col("pivot").alias("sid")))
    grams = _grams_of(docs, shingle, asked, sets, scratch)
    links = scratch.save(_pivot_links(pairs, grams, threshold, scratch), "pivot-links")
    scratch.drop(grams)
    roots = components(links, scratch)
    rooted = scratch.save(members.join(roots.withColumnRenamed("id", "sid"), "sid", "left")
                          .select("bucket", "sid", F.coalesce("root", "sid").alias("root")), "rooted")
    scratch.drop(members)
    scratch.sweep()
    open_ = rooted.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"),
                                         F.count("*").alias("weight"))
    open_ = scratch.save(open_.filter("lo <> hi").select("bucket", "weight"), "open")
    if not open_.isEmpty():
        # linked sets of two components share open buckets only, as many as they need
        undecided = salted_lookup(rooted, open_, ["bucket"], "weight", ["sid"])
        asking = scratch.save(undecided.groupBy("sid", "root").agg(F.collect_list("bucket").alias("buckets"))
                              .join(known.hint("merge"), "sid").filter(F.size("buckets") >= F.col("need")), "asking")
        entries = asking.select("sid", F.explode("buckets").alias("bucket"))
        firsts = entries.groupBy("bucket").agg(F.min("sid").alias("first"), F.count("*").alias("weight"))
        firsts = scratch.save(firsts.filter("weight > 1"), "firsts")
        met = salted_lookup(entries, firsts, ["bucket"], "weight", ["sid"])
        coarse = components(met.select(F.col("sid").alias("a"), F.col("first").alias("b")), scratch)
        wide = scratch.save(_in_blocks(asking, coarse, "left"), "wide")
        forest = scratch.save(_candidate_links(wide, threshold, block_sets), "forest")
        scratch.drop(wide, firsts)
        scratch.sweep()
        fine = components(forest, scratch)
        fine = fine.unionByName(fine.select(F.col("root").alias("id"), "root").distinct())
        blocks = scratch.save(_in_blocks(asking.select("sid", "root"), fine, "inner"), "blocks")
        grams = _grams_of(docs, shingle, blocks.select("sid"), sets, scratch)
        more = _block_links(blocks, grams, threshold, block_sets)
        links = scratch.save(links.unionByName(more), "links")
        scratch.drop(grams, blocks, asking, forest)
        roots = components(links, scratch)
    scratch.drop(rooted, open_, known)
    scratch.sweep()

    named = (sets.join(roots.withColumnRenamed("id", "sid"), "sid", "left")
             .withColumn("root", F.coalesce("root", "sid")))
    named = scratch.save(named, "named")
    first = named.groupBy("root").agg(F.min("rep").alias("component_id"), F.count("*").alias("groups"))
    named = scratch.save(salted_lookup(named, first, ["root"], "groups", ["sid"])
                         .select("n", "k1", "k2", "weight", "root", "component_id"), "components")
    scratch.drop(sets)
    scratch.sweep()
    out = salted_lookup(rows.filter("n > 0"), named, ["n", "k1", "k2"], "weight", ["doc_id"])
    alone = rows.filter("n = 0").withColumns({"root": F.lit(None).cast("long"), "component_id": F.col("doc_id")})
    return out.select(*alone.columns).unionByName(alone), scratch


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, threshold: tuple[int, int] = THRESHOLD,
                    block_sets: int = BLOCK_SETS, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``.

    The component is named by the smallest doc_id that links reach.
    """
    found, _ = labelled_rows(docs, shingle, threshold, block_sets, slice_bytes)
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE,
                         threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` of which each component keeps one, in its columns.

    The row with the smallest doc_id stays, null ids after all others; of
    several such rows the one that stands first.  Rows without words stay.
    Rows are told apart by their place in the files they are read from, so an
    id that several rows have, or none, drops no other row.
    """
    scratch = Scratch(docs.sparkSession, "near-copies")
    file, row = fresh(docs.columns, "file"), fresh(docs.columns, "row")

    def placed(df: DataFrame) -> DataFrame:
        return df.select(*[df[c] for c in docs.columns], F.col("_metadata.file_path").alias(file),
                         F.col("_metadata.row_index").alias(row))

    try:
        whole = placed(docs)
    except AnalysisException:    # not read from Parquet files as it stands: a copy of it is
        whole = placed(scratch.save(docs, "whole"))
    keyed = whole.select(F.struct(F.col("doc_id").isNull().alias("null_id"), F.col("doc_id").alias("id"),
                                  F.col(file).alias("file"), F.col(row).alias("row")).alias("doc_id"), "text")
    found, inner = labelled_rows(keyed, shingle, threshold)
    gone = found.filter((F.col("n") > 0) & (F.col("doc_id") != F.col("component_id"))).select(
        F.col("doc_id.file").alias(file), F.col("doc_id.row").alias(row))
    gone = scratch.save(gone, "gone")
    inner.clear()
    return whole.join(gone, [file, row], "left_anti").select(*[whole[c] for c in docs.columns])
