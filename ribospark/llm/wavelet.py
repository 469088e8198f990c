"""Wavelet matrix: a sequence of symbols as bit planes with rank directories, in one block of bytes.

Plane l holds bit ``levels-1-l`` of every symbol's code, in the order left by stably moving the zeros of
the planes above to the front (Claude, Navarro and Ordonez 2015). With popcounts per 512-bit block, any
token is read, counted and found in O(levels) steps without unpacking the rest.

Bytes: magic ``WMX1``; uint64 tokens, uint32 distinct symbols, uint32 documents; uint32 symbols in
ascending order; int64 doc_ids, uint8 null flags, uint64 token counts of the documents; per plane a
uint64 count of zeros, the padded bits, and a uint32 rank before every 512-bit block.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MAGIC = b"WMX1"
BLOCK = 512
HEAD = "<4sQII"


def _levels(symbols: int) -> int:
    return max(1, (max(symbols, 1) - 1).bit_length())


def build(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> bytes:
    """The file of one shard; ids are unsigned 32-bit token ids of the documents one after another."""
    n = len(ids)
    counts = np.bincount(ids) if n else np.zeros(1, np.int64)
    symbols = np.flatnonzero(counts).astype("<u4")
    levels = _levels(len(symbols))
    code = np.zeros(len(counts), np.uint16 if levels <= 16 else np.uint32)
    code[symbols] = np.arange(len(symbols))
    v = code[ids] if n else code[:0]
    out = [
        struct.pack(HEAD, MAGIC, n, len(symbols), len(doc_ids)),
        symbols.tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        np.array(lengths, "<u8").tobytes(),
    ]
    blocks = -(-n // BLOCK)
    for level in range(levels):
        ones = (v >> v.dtype.type(levels - 1 - level)).astype(np.uint8) & 1
        packed = np.zeros(blocks * BLOCK // 8, np.uint8)
        bits = np.packbits(ones, bitorder="little")
        packed[: len(bits)] = bits
        per = np.bitwise_count(packed.view("<u8")).reshape(blocks, BLOCK // 64).sum(1, dtype=np.uint32)
        ranks = np.zeros(blocks, "<u4")
        np.cumsum(per[:-1], out=ranks[1:]) if blocks else None
        mask = pa.Array.from_buffers(pa.bool_(), n, [None, pa.py_buffer(packed)])
        values = pa.Array.from_buffers(pa.from_numpy_dtype(v.dtype), n, [None, pa.py_buffer(v)])
        zeros = values.filter(pc.invert(mask)).to_numpy()
        out += [struct.pack("<Q", len(zeros)), packed.tobytes(), ranks.tobytes()]
        v = np.concatenate((zeros, values.filter(mask).to_numpy()))
    return b"".join(out)


class WaveletMatrix:
    """Reads one shard's bytes."""

    def __init__(self, data: bytes):
        magic, self.n, symbols, docs = struct.unpack_from(HEAD, data)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix")
        at = struct.calcsize(HEAD)

        def take(dtype, count):
            nonlocal at
            a = np.frombuffer(data, dtype, count, at)
            at += a.nbytes
            return a

        self.symbols = take("<u4", symbols)
        ids, null = take("<i8", docs), take(np.uint8, docs)
        self.doc_ids = [None if x else int(d) for d, x in zip(ids, null, strict=True)]
        self.lengths = take("<u8", docs).astype(np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))
        self.levels, blocks = _levels(symbols), -(-self.n // BLOCK)
        self.zeros, self.bits, self.ranks = [], [], []
        for _ in range(self.levels):
            self.zeros.append(int(take("<u8", 1)[0]))
            self.bits.append(take(np.uint8, blocks * BLOCK // 8))
            self.ranks.append(take("<u4", blocks))

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        b = i // BLOCK
        if b >= len(self.ranks[level]):
            return self.n - self.zeros[level]
        part = self.bits[level][b * BLOCK // 8 : (i + 7) // 8]
        return int(self.ranks[level][b]) + int(np.unpackbits(part, count=i - b * BLOCK, bitorder="little").sum())

    def access(self, i: int) -> int:
        """The token at place i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        code = 0
        for level in range(self.levels):
            bit = int(self.bits[level][i >> 3]) >> (i & 7) & 1
            ones = self._rank1(level, i)
            code = code << 1 | bit
            i = self.zeros[level] + ones if bit else i - ones
        return int(self.symbols[code])

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        """Where the tokens equal to token of [lo, hi) lie in the last arrangement."""
        code = int(np.searchsorted(self.symbols, token))
        if code == len(self.symbols) or self.symbols[code] != token:
            return 0, 0
        for level in range(self.levels):
            a, b = self._rank1(level, lo), self._rank1(level, hi)
            if code >> (self.levels - 1 - level) & 1:
                lo, hi = self.zeros[level] + a, self.zeros[level] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of token in [lo, hi)."""
        a, b = self._range(token, lo, self.n if hi is None else hi)
        return b - a

    def rank(self, token: int, i: int) -> int:
        return self.count(token, 0, i)

    def _select_bit(self, level: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) bit of that value in a plane."""
        ranks = self.ranks[level].astype(np.int64)
        before = ranks if bit else np.arange(len(ranks)) * BLOCK - ranks
        b = int(np.searchsorted(before, k, side="right")) - 1
        part = np.unpackbits(self.bits[level][b * BLOCK // 8 : (b + 1) * BLOCK // 8], bitorder="little")
        return b * BLOCK + int(np.flatnonzero(part == bit)[k - int(before[b])])

    def select(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of token."""
        lo, hi = self._range(token, 0, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i, code = lo + k, int(np.searchsorted(self.symbols, token))
        for level in reversed(range(self.levels)):
            bit = code >> (self.levels - 1 - level) & 1
            i = self._select_bit(level, bit, i - self.zeros[level] if bit else i)
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def tokens(self) -> np.ndarray:
        """All tokens: the planes are undone from the last to the first."""
        v = np.zeros(self.n, np.uint16 if self.levels <= 16 else np.uint32)
        for level in reversed(range(self.levels)):
            ones = np.unpackbits(self.bits[level], count=self.n, bitorder="little").view(bool)
            up = np.empty_like(v)
            low, high = v[: self.zeros[level]], v[self.zeros[level] :] | v.dtype.type(1 << (self.levels - 1 - level))
            if len(low):
                np.place(up, ~ones, low)
            if len(high):
                np.place(up, ones, high)
            v = up
        return self.symbols[v] if self.n else self.symbols[:0]


def documents(data: bytes):
    """(doc_id, start in the shard, ids) of each document of a shard."""
    w = WaveletMatrix(data)
    ids = w.tokens()
    for d, a, b in zip(w.doc_ids, w.starts[:-1], w.starts[1:], strict=True):
        yield d, int(a), ids[a:b]
