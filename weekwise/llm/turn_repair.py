"""Conversation structure repair: a cost dynamic programme, then prefix-doubling path ranking.

A conversation is repaired by keeping, re-roling, deleting or inserting turns
until its role initials read ``(s?(ua)+)?``.  A node is a place between two
rows and the state of that grammar; an edit is an arc with its cost and the
letter that the audit writes.  A state and a letter determine the next state,
so an audit names one path.

1. Costs to the end are found backwards.  Arcs that keep them minimal are the
   optimal ones; each node points along its arc with the least letter.
2. Nodes are ranked by the audits of length 1, 2, 4, ... that follow from
   them: a node's rank of twice the length comes from its rank and that of the
   node its pointer reaches, and the pointers are doubled with it.  The ranks
   select the least of equally cheap paths, and the doubled pointers give all
   places of the selected path at once.

A conversation may be any share of all rows.  Rows are ordered by a range sort
and cut into chunks of at most 2 ** ``CHUNK_BITS``; texts stay behind, a row is one
code.  Every chunk is solved for all four entry and exit states (cost, and rank
of the least audit), the few numbers of a conversation's chunks are composed by
the same cost and pointer steps, and the chunks then write the audit of their
entry and exit.  No chunk path but the last ends with an insertion, so none of
two audits of a chunk begins the other.  The hash of a repaired conversation
streams over its rows in order and holds none of them.

Defined cases: null roles and texts are one space, as a null conv_id or turn is
in the damage key; rows without conv_id form a conversation.  A null turn comes
first; rows of one turn stand in the order of role and of the text's SHA-256,
equal rows side by side.  A role that begins with neither s, u nor a cannot be
kept.  Conversations without rows (all dropped) have zeros and an empty audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekwise.llm.common import Scratch, salted_lookup

CHUNK_BITS = 12            # rows of a chunk, as a power of two
SOLVE_ROWS = 1 << 16       # rows whose nodes a task holds at once
KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
TRUNCATED = 3              # of a truncated row that stays
START, SYSTEM, USER, ASSISTANT = range(4)   # states: the role that stands last
BLANK, DUPLICATE, CUT = 1, 2, 3             # faults of a row
NEXT = np.array([USER, USER, ASSISTANT, USER])   # the turn to insert or re-role to, by state
TAIL = [b"", b"II", b"I", b""]              # insertions that end the grammar, by state
NONE = 1 << 40             # cost of what cannot be
LETTERS = b"\0DIKR"        # ranks of audits of length 1


def damage(conversations: DataFrame) -> DataFrame:
    """The rows after the damage of the contract, by the crc32 of ``conv_id:turn``."""
    blank = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                            F.coalesce(F.col("turn").cast("string"), blank)).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", F.coalesce("role", blank).alias("role"),
                                F.coalesce("text", blank).alias("text"), kind.alias("kind")).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")
                       ).drop("copy")


def _conv(col: str = "conv_id") -> Column:
    """A key that is never null."""
    return F.concat(F.when(F.col(col).isNull(), "-").otherwise("+"), F.coalesce(F.col(col).cast("string"), F.lit("")))


def _keyed(rows: DataFrame) -> DataFrame:
    blank = F.lit(" ")
    return rows.select(
        _conv().alias("conv"), F.col("turn").isNotNull().alias("numbered"), F.coalesce("turn", F.lit(0)).alias("turn"),
        F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text")).withColumn(
        "name", F.unhex(F.sha2(F.col("text"), 256)))


PLACE = ["conv", "numbered", "turn", "role", "name"]   # of equal rows; also their order


def ordered_rows(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, numbered, turn, role, name, at, code): all rows in the order of ``at``, without texts.

    The code is the role's state and four times the row's first fault.
    """
    keyed = _keyed(rows)
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    slim = keyed.select(*PLACE, blank.alias("blank"), cut.alias("cut")).groupBy(*PLACE).agg(
        F.count("*").alias("copies"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))
    slim = scratch.save(slim, "slim")
    same = ["conv", "role", "name"]
    first = slim.groupBy(*same).agg(F.min(F.struct("numbered", "turn")).alias("first"), F.count("*").alias("weight"))
    seen = salted_lookup(slim, first.filter("weight > 1"), same, "weight", ["turn"], "left")
    later = F.coalesce(F.struct("numbered", "turn") != F.col("first"), F.lit(False))
    each = seen.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    fault = (F.when(F.col("blank"), BLANK).when(later | (F.col("copy") > 1), DUPLICATE)
             .when(F.col("cut"), CUT).otherwise(0))
    initial = F.substring("role", 1, 1)
    state = (F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT)
             .otherwise(START))
    rows = each.select(*PLACE, "copy", (state + 4 * fault).cast("int").alias("code"))
    order = [*PLACE, "copy"]
    out = scratch.save(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                       .withColumn("at", F.monotonically_increasing_id()).drop("copy"), "ordered")
    scratch.drop(slim)
    return out


class Solved:
    """Optimal paths of some chunks: a node is (place, state, layer), a layer one exit state."""

    def __init__(self, codes: np.ndarray, sizes: np.ndarray, exits: np.ndarray) -> None:
        self.sizes, self.layers = sizes, exits.shape[1]
        chunks = len(sizes)
        starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]      # of a chunk's rows
        self.first = starts + np.arange(chunks)                    # its first place; it has one more than rows
        ends = self.first + sizes
        places, layers = int(sizes.sum()) + chunks, self.layers
        cost = np.full((places, 4, layers), NONE, np.int64)
        cost[ends[:, None], exits, np.arange(layers)[None, :]] = 0
        self.next = np.arange(places * 4 * layers).reshape(places, 4, layers)
        self.rank = np.zeros((places, 4, layers), np.int64)
        role, fault = codes & 3, codes >> 2
        state, layer = np.arange(4), np.arange(layers)[None, None, :]
        for step in range(1, int(sizes.max(initial=0)) + 1):
            able = np.flatnonzero(sizes >= step)
            at = ends[able] - step
            row = starts[able] + sizes[able] - step
            after = cost[at + 1]
            gone = np.isin(fault[row], (BLANK, DUPLICATE))[:, None]
            extra = np.where(fault[row] == CUT, TRUNCATED, 0)[:, None, None]
            r = role[row][:, None]
            legal = ~gone & (((r == SYSTEM) & (state == START)) | ((r == USER) & (state != USER))
                             | ((r == ASSISTANT) & (state == USER)))
            delete = DELETE + after
            keep = np.where(legal[:, :, None], KEEP + extra + after[np.arange(len(able)), role[row]][:, None, :], NONE)
            rerole = np.where(gone[:, :, None], NONE, REROLE + extra + after[:, NEXT])
            base = np.minimum(np.minimum(delete, keep), rerole)
            best = np.minimum(np.minimum(base, INSERT + base[:, NEXT]), 2 * INSERT + base[:, NEXT[NEXT]])
            insert = INSERT + best[:, NEXT]
            best = np.minimum(best, NONE)
            cost[at] = best
            # the optimal arc with the least letter: D, I, K, R
            letter = np.select([delete == best, insert == best, keep == best], [1, 2, 3], 4)
            to_place = np.where(letter == 2, at[:, None, None], at[:, None, None] + 1)
            to_state = np.select([letter == 1, letter == 3], [state[None, :, None], r[:, :, None]], NEXT[None, :, None])
            there = best < NONE
            self.rank[at] = np.where(there, letter, 0)
            node = (to_place * 4 + to_state) * layers + layer
            self.next[at] = np.where(there, node, self.next[at])
        self.cost = cost
        self.letter = self.rank.ravel().copy()
        self._double()

    def _double(self) -> None:
        """Ranks of audits of doubled lengths, pointers over as many letters, and how many there are."""
        rank, to = self.letter, self.next.ravel()
        length = (rank > 0).astype(np.int64)
        self.jumps = [to]
        while True:
            further = rank[to]
            if not further.any():
                break
            rank = np.unique(rank * (int(rank.max()) + 1) + further, return_inverse=True)[1]
            length = length + length[to]
            to = to[to]
            self.jumps.append(to)
            if not self.letter[to].any():
                break
        self.rank, self.length = rank.reshape(self.next.shape), length

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """(cost, rank) from each chunk's entry states to its exits."""
        return self.cost[self.first], self.rank[self.first]

    def walk(self, node: np.ndarray, steps: np.ndarray) -> np.ndarray:
        """The nodes that so many letters lead to, by the doubled pointers."""
        for k, to in enumerate(self.jumps):
            node = np.where(steps >> k & 1 == 1, to[node], node)
        return node

    def paths(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(chunk, letter, state) along the paths from the entry states, in the first layer."""
        node = (self.first * 4 + entry) * self.layers
        count = self.length[node]
        chunk = np.repeat(np.arange(len(node)), count)
        steps = np.arange(len(chunk)) - np.repeat(np.cumsum(count) - count, count)
        on = self.walk(node[chunk], steps)
        return chunk, self.letter[on], on // self.layers % 4


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, codes, sizes) of about ``SOLVE_ROWS`` rows of conversations at once."""
    for batch in batches:
        offsets = batch.column("codes").offsets.to_numpy()
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + SOLVE_ROWS, "right")) - 1)
            piece = batch.slice(start, stop - start)
            yield piece, piece.column("codes").flatten().to_numpy().astype(np.int64), np.diff(offsets[start:stop + 1])
            start = stop


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, chunk, illegal, first, last, cost, rank): what other chunks need to know of each."""
    for rows, codes, sizes in _pieces(batches):
        solved = Solved(codes, sizes, np.tile(np.arange(4), (len(sizes), 1)))
        cost, rank = solved.entries()
        role = codes & 3
        begin = np.cumsum(sizes) - sizes
        pair = _illegal(role[:-1], role[1:])
        pair[begin[1:] - 1] = False
        illegal = np.add.reduceat(np.append(pair, False), begin)
        yield pa.RecordBatch.from_pydict({
            "conv": rows.column("conv"), "chunk": rows.column("chunk"), "illegal": illegal.astype(np.int64),
            "first": role[begin].astype(np.int32), "last": role[begin + sizes - 1].astype(np.int32),
            "cost": pa.array([c.tobytes() for c in cost], pa.binary()),
            "rank": pa.array([r.tobytes() for r in rank], pa.binary())})


def _illegal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ~(((a == SYSTEM) & (b == USER)) | ((a == USER) & (b == ASSISTANT)) | ((a == ASSISTANT) & (b == USER)))


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, chunk, entry, exit, tail, cost, illegal): the chunks' parts in each conversation's least path."""
    for batch in batches:
        lists = batch.column("chunks")
        flat = lists.flatten()
        sizes = np.diff(lists.offsets.to_numpy())
        cost, rank = (np.frombuffer(b"".join(flat.field(c).to_pylist()), np.int64).reshape(-1, 4, 4)
                      for c in ("cost", "rank"))
        total = len(cost)
        begin = np.cumsum(sizes) - sizes
        end = begin + sizes
        left = np.empty((total + 1, 4), np.int64)     # cost from a chunk's entry states to the end
        to = np.empty((total, 4), np.int64)           # exit state of the least path
        for step in range(1, int(sizes.max(initial=0)) + 1):
            at = end[sizes >= step] - step
            after = np.array([INSERT * len(t) for t in TAIL]) if step == 1 else left[at + 1][:, None, :]
            whole = np.minimum(cost[at] + after, NONE)
            left[at] = whole.min(axis=2)
            ranked = np.where(whole == left[at][:, :, None], rank[at], np.iinfo(np.int64).max)
            to[at] = ranked.argmin(axis=2)
        chunk, entry = np.arange(total), np.zeros(total, np.int64)
        place = chunk - np.repeat(begin, sizes)
        node, jump = np.repeat(begin, sizes) * 4 + START, np.minimum((chunk + 1)[:, None], total - 1) * 4 + to
        jump = jump.ravel()
        for k in range(int(place.max(initial=0)).bit_length()):
            node = np.where(place >> k & 1 == 1, jump[node], node)
            jump = jump[jump]
        entry = node % 4
        leave = to[chunk, entry]
        final = place == np.repeat(sizes, sizes) - 1
        first, last = (flat.field(c).to_numpy() for c in ("first", "last"))
        illegal = flat.field("illegal").to_numpy().copy()
        illegal[1:] += _illegal(last[:-1], first[1:]) & (place[1:] > 0)
        yield pa.RecordBatch.from_pydict({
            "conv": batch.column("conv").take(pa.array(np.repeat(np.arange(len(sizes)), sizes))),
            "chunk": flat.field("chunk"), "entry": entry.astype(np.int32), "exit": leave.astype(np.int32),
            "final": final, "cost": np.where(place == 0, left[chunk, START], 0), "illegal": illegal})


LINES = {USER: "user:", ASSISTANT: "assistant:"}


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, chunk, audit, tail, kept): a chunk's audit and the rows that stay.

    A row that stays has its ``at``, the inserted lines before it, and its new
    role or null for its own.
    """
    for rows, codes, sizes in _pieces(batches):
        entry, leave = (rows.column(c).to_numpy().astype(np.int64) for c in ("entry", "exit"))
        solved = Solved(codes, sizes, leave[:, None])
        chunk, letter, state = solved.paths(entry)
        text = np.frombuffer(LETTERS, np.uint8)[letter].tobytes().decode()
        bounds = np.searchsorted(chunk, np.arange(len(sizes) + 1)).tolist()
        start = rows.column("start").to_pylist()
        nexts = NEXT[state].tolist()
        audits, tails, kept = [], [], []
        for c, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            at, before, stays = start[c], "", []
            for k in range(a, b):
                if text[k] == "I":
                    before += LINES[nexts[k]] + "\n"
                    continue
                if text[k] != "D":
                    stays.append({"at": at, "before": before,
                                  "new_role": LINES[nexts[k]][:-1] if text[k] == "R" else None})
                    before = ""
                at += 1
            kept.append(stays)
            audits.append(text[a:b])
        final = rows.column("final").to_pylist()
        for c, e in enumerate(leave.tolist()):
            more = TAIL[e].decode() if final[c] else ""
            audits[c] += more
            tails.append("\n".join(["user:", "assistant:"][-len(more):]) if more else None)
        yield pa.RecordBatch.from_pydict({
            "conv": rows.column("conv"), "chunk": rows.column("chunk"), "audit": audits,
            "tail": pa.array(tails, pa.string()),
            "kept": pa.array(kept, pa.list_(pa.struct([("at", pa.int64()), ("before", pa.string()),
                                                       ("new_role", pa.string())])))})


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, repaired_sha256) of newline-joined lines that come sorted by conversation."""
    conv, digest = None, None
    for batch in batches:
        done = []
        for c, line in zip(batch.column("conv").to_pylist(), batch.column("line")):
            if c != conv:
                if conv is not None:
                    done.append((conv, digest.hexdigest()))
                conv, digest = c, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(line.as_buffer())
        if done:
            yield _hash_rows(done)
    if conv is not None:
        yield _hash_rows([(conv, digest.hexdigest())])


def _hash_rows(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"conv": [c for c, _ in rows], "repaired_sha256": [h for _, h in rows]})


class Repair:
    """The repair of the conversations in ``rows`` (conv_id, turn, role, text)."""

    def __init__(self, rows: DataFrame, chunk_bits: int = CHUNK_BITS) -> None:
        self.rows = rows
        scratch = self.scratch = Scratch(rows.sparkSession, "turn-repair")
        self.ordered = ordered_rows(rows, scratch)
        by_row = F.array_sort(F.collect_list(F.struct("at", "code")))
        chunks = scratch.save(
            self.ordered.groupBy("conv", F.shiftright("at", chunk_bits).alias("chunk")).agg(by_row.alias("r"))
            .select("conv", "chunk", F.col("r")[0]["at"].alias("start"), F.col("r.code").alias("codes")), "chunks")
        summaries = chunks.mapInArrow(_summaries, "conv string, chunk long, illegal long, first int, last int, "
                                                  "cost binary, rank binary")
        parts = ["chunk", "illegal", "first", "last", "cost", "rank"]
        composed = summaries.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct(*parts))).alias("chunks"))
        composed = scratch.save(composed.mapInArrow(
            _composed, "conv string, chunk long, entry int, exit int, final boolean, cost long, illegal long"),
            "composed")
        edits = chunks.join(composed.drop("cost", "illegal").hint("merge"), ["conv", "chunk"])
        self.edits = scratch.save(edits.mapInArrow(
            _edits, "conv string, chunk long, audit string, tail string, "
                    "kept array<struct<at: long, before: string, new_role: string>>"), "edits")
        self.composed = composed
        scratch.drop(chunks)

    def lines(self) -> DataFrame:
        """(conv, at, line): the repaired conversations, inserted turns before the row that they precede."""
        kept = self.edits.select("conv", F.inline("kept"))
        places = kept.join(self.ordered.select("at", *PLACE[1:]).hint("merge"), "at")
        texts = _keyed(self.rows).groupBy(*PLACE).agg(F.first("text").alias("text"))
        full = places.join(texts.hint("merge"), PLACE)
        line = F.concat("before", F.coalesce("new_role", "role"), F.lit(":"), "text")
        end = self.edits.filter("tail is not null").select(
            "conv", F.lit((1 << 63) - 1).alias("at"), F.col("tail").alias("line"))
        return full.select("conv", "at", line.alias("line")).unionByName(end)

    def hashes(self) -> DataFrame:
        """(conv, repaired_sha256) of the conversations that have lines."""
        lines = self.lines().withColumn("line", F.col("line").cast("binary"))
        return lines.repartition("conv").sortWithinPartitions("conv", "at").mapInArrow(
            _hashes, "conv string, repaired_sha256 string")

    def report(self, originals: DataFrame) -> DataFrame:
        """One row per conv_id of ``originals``: gaps, faults, cost, audit and hash."""
        def faults(kind: int) -> Column:
            return F.count_if(F.shiftright("code", 2) == kind)

        turn = F.when(F.col("numbered"), F.col("turn"))
        counts = self.ordered.groupBy("conv").agg(
            F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_distinct(turn), F.lit(0)).alias("gaps"),
            faults(BLANK).alias("blank"), faults(DUPLICATE).alias("duplicate"), faults(CUT).alias("truncated"))
        costs = self.composed.groupBy("conv").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"))
        audits = self.edits.groupBy("conv").agg(
            F.array_join(F.array_sort(F.collect_list(F.struct("chunk", "audit")))["audit"], "").alias("audit"))
        out = originals.select("conv_id").distinct().withColumn("conv", _conv())
        for part in (counts, costs, audits, self.hashes()):
            out = out.join(part, "conv", "left")
        numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
        return out.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
                          F.coalesce("audit", F.lit("")).alias("audit"),
                          F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
