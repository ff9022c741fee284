import hashlib
import heapq
import random
import re
import zlib

from llm_helpers import importable, ordered
from pyspark.sql import functions as F

from weekwise.llm import turn_repair
from weekwise.llm.turn_repair import Repair

KIND = "conv_id long, turn long, role string, text string"
AFTER = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
INSERTED = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """(cost, audit, lines) by best-first search over (cost, audit); rows are (role, text, fault)."""
    heap, seen = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, lines
        if (i, state) in seen:
            continue
        seen.add((i, state))
        for x in AFTER[state]:
            if x in INSERTED:
                heapq.heappush(heap, (cost + 3, audit + "I", i, x, lines + (INSERTED[x] + ":",)))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, lines))
            if fault in ("blank", "duplicate"):
                continue
            cost += 3 * (fault == "truncated")
            for x in AFTER[state]:
                if role[:1] == x:
                    heapq.heappush(heap, (cost, audit + "K", i + 1, x, lines + (role + ":" + text,)))
                if x in INSERTED:
                    heapq.heappush(heap, (cost + 3, audit + "R", i + 1, x, lines + (INSERTED[x] + ":" + text,)))


def brute(rows):
    talks = {c: [] for c, *_ in rows}
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        talks[c] += [(t is not None, t, role, text)] * (2 if kind == 3 else 1)
    out = []
    for c, talk in talks.items():
        talk.sort(key=lambda r: (r[0], r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        told, judged = set(), []
        for _, _, role, text in talk:
            last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
            judged.append((role, text, "blank" if not last else "duplicate" if (role, text) in told
                           else "truncated" if last not in ".!?" else ""))
            told.add((role, text))
        turns = [t for _, t, *_ in talk if t is not None]
        cost, audit, lines = cheapest(judged)
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(talk, talk[1:])]
        faults = [f for *_, f in judged]
        out.append((c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"),
                    faults.count("duplicate"), faults.count("truncated"),
                    sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return ordered(out)


def rows():
    r = random.Random(4)
    texts = ["Yes.", "no", "Why?", "", " \t", None, "Yes.", "a. b", "ü!", "end. \n", "日本"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "umpire", "Assistant"]
    out = []
    for c in range(300):
        for t in range(r.choice([1, 2, 4, 7, 12])):
            role = r.choice(roles) if r.random() < 0.4 else ("user", "assistant")[t % 2]
            out.append((c if c else None, r.choice([t, t, t, t, None, t + 3]), role, r.choice(texts)))
    out += [(c, k, ("user", "assistant")[k % 2], f"turn {k}.") for c in (900, 901) for k in range(6)]
    out += [(902, 1, "user", "x " * 100_000 + "."), (902, 2, "assistant", "y" * 200_000 + "?")] + out[:9]
    return out


def result(spark, data, **options):
    df = importable(spark).createDataFrame(data, KIND).select("*", *[F.lit("x").alias(c) for c in (
        "conv", "at", "name", "code", "kind", "copy", "chunk", "audit", "line", "numbered")])
    return ordered(Repair(turn_repair.damage(df), **options).report(df).collect())


def test_equals_best_first_search(spark):
    assert result(spark, rows()) == brute(rows())


def test_chunks_do_not_matter(spark):
    """Conversations cut at every fourth row, one of them most of the table."""
    r = random.Random(8)
    hot = [(7, k, r.choice(["user", "assistant", "assistant", "system"]), f"{k} {r.choice(['a', 'b.'])}")
           for k in range(700)]
    hot += [(7, None, "user", "the same text")] * 300
    small = rows()[:200]
    assert result(spark, hot + small, chunk_bits=2) == brute(hot + small)


def test_empty_and_all_dropped(spark):
    assert result(spark, []) == []
    dropped = [(c, 0, "user", "x.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert dropped and result(spark, dropped) == brute(dropped)


def test_ranks_order_audits_of_every_exit():
    """Ranks compare whole audits, not their beginnings: against the written audits of every exit."""
    import numpy as np
    r = np.random.default_rng(1)
    for _ in range(60):
        sizes = r.integers(1, 9, 5)
        codes = r.integers(0, 4, sizes.sum()) + 4 * r.integers(0, 4, sizes.sum())
        whole = turn_repair.Solved(codes, sizes, np.tile(np.arange(4), (5, 1)))
        cost, rank = whole.entries()
        audits = {}
        for exit_ in range(4):
            one = turn_repair.Solved(codes, sizes, np.full((5, 1), exit_))
            for entry in range(4):
                chunk, letter, _ = one.paths(np.full(5, entry))
                for c in range(5):
                    audits[c, entry, exit_] = bytes(turn_repair.LETTERS[k] for k in letter[chunk == c])
        for c in range(5):
            for entry in range(4):
                able = [e for e in range(4) if cost[c, entry, e] < turn_repair.NONE]
                assert sorted(able, key=lambda e: rank[c, entry, e]) == sorted(able, key=lambda e: audits[c, entry, e])
