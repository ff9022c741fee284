"""Whole columns of texts as numpy arrays: words and their 64-bit hashes.

A word's hash is a polynomial over random byte values modulo 2**64, so the
hash of any run of bytes follows from one running sum; a final mix spreads
the bits.  Such a polynomial cannot tell some very regular long words apart
(Thue-Morse words from 1,024 letters on), whatever its base, so words of
``LONG`` bytes and more, which are rare, are hashed by BLAKE2.  Work goes in pieces cut between words, so memory does not grow
with the length of a text beyond one byte-sized mask and its words.
"""

from __future__ import annotations

import ctypes
import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 18          # bytes hashed at once
CHUNK_BYTES = 1 << 20    # bytes of text handled at once
LONG = 256               # bytes of a word that is hashed by itself

_RNG = np.random.Generator(np.random.PCG64(20240607))
_VALUE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C13)  # 3 modulo 8
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))

LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[65:91] += 32


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_POW = _powers(_BASE, PIECE + 1)
_INV = _powers(_INVERSE, PIECE + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def space_words() -> np.ndarray:
    """Bytes of words that white space divides: all but 0x20 and 0x09-0x0D."""
    word = np.ones(256, dtype=bool)
    word[[0x20, *range(0x09, 0x0E)]] = False
    return word


def alnum_words() -> np.ndarray:
    """Bytes of words of digits, letters and everything beyond ASCII."""
    word = np.zeros(256, dtype=bool)
    word[0x30:0x3A] = word[0x41:0x5B] = word[0x61:0x7B] = word[0x80:] = True
    return word


def any_tokens() -> np.ndarray:
    """Kinds of bytes: runs of digits, letters and beyond are tokens, so are runs of signs."""
    kind = alnum_words().astype(np.uint8)
    kind[(~alnum_words()) & space_words()] = 2
    return kind


def give_back() -> None:
    """Return freed memory to the system: a Python worker idles on after its task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def chunks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Slices with about ``CHUNK_BYTES`` of text; a longer text goes alone."""
    yield from _slices(batches, column)
    give_back()


def _slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + CHUNK_BYTES, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, with A-Z lower-cased if asked, and each text's offsets.

    Null texts are empty.
    """
    arr = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = arr.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    first, last = (int(offs[0]), int(offs[-1])) if len(offs) else (0, 0)
    raw = np.frombuffer(data, dtype=np.uint8)[first:last] if data is not None else np.zeros(0, np.uint8)
    return LOWER_ASCII[raw] if lower else raw, offs - first


class Words:
    """Words of several texts: byte ranges, hashes, and offsets per text.

    ``kinds`` gives the kind of each byte; a word is a run of one kind, and
    kind 0 belongs to none.
    """

    def __init__(self, texts: pa.Array, kinds: np.ndarray, lower: bool = True) -> None:
        self.buf, self.offs = text_bytes(texts, lower)
        n = len(self.buf)
        kind = kinds.astype(np.uint8)[self.buf]
        edge = np.ones(n + 1, dtype=bool)      # a text or another kind begins here
        edge[1:n] = kind[1:] != kind[:-1]
        edge[self.offs] = True
        word = kind > 0
        self.starts = np.flatnonzero(word & edge[:n])
        self.ends = np.flatnonzero(word & edge[1:]) + 1
        self.word_offs = np.searchsorted(self.starts, self.offs)
        self.hashes = self._hash(self.starts, self.ends)

    def heads(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Words of at least ``length`` bytes, and the hash of their first bytes.

        It equals the hash of a word of those bytes.
        """
        long = np.flatnonzero(self.ends - self.starts >= length)
        return long, self._hash(self.starts[long], self.starts[long] + length)

    def _hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), dtype=np.uint64)
        long = ends - starts >= LONG
        for i in np.flatnonzero(long).tolist():
            digest = hashlib.blake2b(self.buf[starts[i]:ends[i]], digest_size=8).digest()
            out[i] = int.from_bytes(digest, "little")
        if long.any():
            out[~long] = self._polynomials(starts[~long], ends[~long])
            return out
        return self._polynomials(starts, ends)

    def _polynomials(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of runs shorter than a piece."""
        out = np.empty(len(starts), dtype=np.uint64)
        i, n = 0, len(starts)
        while i < n:
            a = int(starts[i])
            j = max(i + 1, int(np.searchsorted(ends, a + PIECE, "right")))
            b = int(ends[j - 1])
            sums = np.zeros(b - a + 1, dtype=np.uint64)
            np.cumsum(_VALUE[self.buf[a:b]] * _POW[:b - a], out=sums[1:])
            s, e = starts[i:j] - a, ends[i:j] - a
            out[i:j] = mix((sums[e] - sums[s]) * _INV[s] + (e - s).astype(np.uint64))
            i = j
        return out

    def word(self, i: int) -> bytes:
        return self.buf[self.starts[i]:self.ends[i]].tobytes()

    def windows(self, length: int) -> np.ndarray:
        """Hash of the ``length`` words from each word on; the last
        ``length - 1`` words of all texts have none."""
        return windows(self.hashes, length)


def windows(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of each ``length`` consecutive hashes."""
    m = len(hashes) - length + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(m, dtype=np.uint64)
    for k in range(length):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += hashes[k:k + m]
    return mix(out)
