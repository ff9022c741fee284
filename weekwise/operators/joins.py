"""Joins with calendar-sized tables (award periods, week boundaries, their days), and a filter of possible keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = 64               # tasks that the rows of one calendar key are dealt to
MAX_BYTES = 32 << 20     # of a table that may be broadcast
FILTER_WORDS = 1 << 18   # 64-bit words of a key filter: bounds the rows it is broadcast in


class CalendarSide:
    """A table that follows the calendar, not the data: joined by broadcast if it is as small as it should be.

    The table is cached and measured once, in rows and in bytes.  Making it
    may scan the data under it; measuring reads ``max_rows + 1`` of its rows.
    Beyond the bounds it is joined by a shuffle in which each of its rows is
    repeated ``PARTS`` times and the other side's rows are dealt by a hash of
    ``spread``, as a calendar has few keys and each holds many rows.
    """

    def __init__(self, df: DataFrame, max_rows: int, max_bytes: int = MAX_BYTES) -> None:
        self.df = df.persist()
        width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(8))
        rows, size = self.df.limit(max_rows + 1).agg(F.count("*"), F.sum(width)).head()
        self.small = rows <= max_rows and (size or 0) <= max_bytes

    def unpersist(self) -> None:
        self.df.unpersist()

    def where(self, condition: Column) -> "CalendarSide":
        """Part of the table, of the same kept rows and size class."""
        part = object.__new__(CalendarSide)
        part.df, part.small = self.df.where(condition), self.small
        return part

    def join(self, rows: DataFrame, keys: list[str], spread: list[str], how: str = "inner") -> DataFrame:
        """``rows`` joined to the table on same-named ``keys``; ``how`` is inner, left or left_semi."""
        if self.small:
            return rows.join(F.broadcast(self.df), keys, how)
        part = "_calendar_part"
        dealt = rows.withColumn(part, F.pmod(F.xxhash64(*spread), F.lit(PARTS)))
        copies = self.df.withColumn(part, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))
        return dealt.join(copies, [*keys, part], how).drop(part)


def null_safe_key(col: Column, name: str) -> list[Column]:
    """Two columns that are equal where ``col`` is, null counting as equal to null."""
    return [F.coalesce(col, F.lit("")).alias(name), col.isNull().alias(f"{name}_null")]


def possible_keys(rows: DataFrame, key: str, members: DataFrame, member: str, words: int = FILTER_WORDS) -> DataFrame:
    """``rows`` whose ``key`` may be one of ``members.member``: every one that is, and few others.  NULL keys go.

    For a lookup table that is much longer than what is looked up: the rows
    go before they are grouped and shuffled, and an exact join follows.  The
    filter is a Bloom filter of one 64-bit word a key, three bits of it set;
    the words are rows, combined map-side by ``bit_or`` and joined by their
    number.  There are at most ``words`` of them however many members there
    are, which is what bounds the broadcast; with more than about ten members
    a word the filter lets more through, and the result stays the same.  Both
    keys must have the same type, as hashes of different types differ.
    """
    if rows.schema[key].dataType != members.schema[member].dataType:
        raise ValueError(f"{key} is {rows.schema[key].dataType}, {member} is {members.schema[member].dataType}")

    def word(col: Column) -> Column:
        return F.pmod(F.xxhash64(col), F.lit(words))

    def bits(col: Column) -> Column:
        h = F.hash(col)
        one = F.lit(1).cast("bigint")
        places = [F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)) for k in range(3)]
        set_bits = [F.call_function("shiftleft", one, p) for p in places]
        return set_bits[0].bitwiseOR(set_bits[1]).bitwiseOR(set_bits[2])

    m = F.col(member)
    table = (members.where(m.isNotNull()).groupBy(word(m).alias("_word"))
             .agg(F.bit_or(bits(m)).alias("_bits")))
    k = F.col(key)
    return rows.where(k.isNotNull()).join(
        F.broadcast(table), (word(k) == F.col("_word")) & (F.col("_bits").bitwiseAND(bits(k)) == bits(k)), "left_semi")
