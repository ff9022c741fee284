"""A blocked Bloom filter, built by an aggregation and probed as arrays."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTER_BYTES = 16 << 20    # of the filter that tasks receive, at most
BITS_PER_ENTRY = 16        # of a filter below that size
WORDS = 8                  # 32-bit words of a block; a hash names a bit in each, and by its other bits the block


class BlockedBloom:
    """Blocks of eight 32-bit words; a key sets one bit in every word of one block."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words

    @staticmethod
    def build(hashes: DataFrame, max_bytes: int = FILTER_BYTES) -> "BlockedBloom":
        """The filter of all 64-bit hashes in the column ``h``; only its blocks come to the driver."""
        blocks = max(1, min(max_bytes // (4 * WORDS), -(-hashes.count() * BITS_PER_ENTRY // (32 * WORDS))))
        h = F.col("h")

        def bit(k: int) -> Column:
            place = F.shiftright(h, 5 * k).bitwiseAND(F.lit(31)).cast("int")
            return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place)).alias(f"w{k}")

        rows = (hashes.groupBy((F.shiftrightunsigned(h, 5 * WORDS) % blocks).alias("b"))
                .agg(*[bit(k) for k in range(WORDS)])).toArrow()
        words = np.zeros((blocks, WORDS), dtype=np.uint32)
        at = rows.column("b").to_numpy()
        for k in range(WORDS):
            words[at, k] = rows.column(f"w{k}").to_numpy().astype(np.uint32)
        return BlockedBloom(words)

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each 64-bit key hash may be an entry's; never false for one that is."""
        h = hashes.view(np.uint64)
        block = (h >> np.uint64(5 * WORDS)) % np.uint64(len(self.words))
        found = np.ones(len(hashes), dtype=bool)
        for k in range(WORDS):
            place = (h >> np.uint64(5 * k) & np.uint64(31)).astype(np.uint32)
            found &= self.words[block, k] >> place & np.uint32(1) == 1
        return found
