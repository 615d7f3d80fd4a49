"""Words, word hashes and window hashes of whole Arrow columns of text.

A word is a run of bytes other than the six ASCII blanks, which is also what ``bytes.split``
yields on UTF-8. Texts are handled in blocks of about a megabyte, whatever the Arrow batches
are, so memory is bounded by the block or by one longest text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_BYTES = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers (the public splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class RunHashes:
    """Hashes of any run of items of a sequence in constant time per run.

    Prefix sums of ``item * multiplier**position`` modulo 2**64, shifted back by the inverse
    powers, so equal runs hash alike wherever they stand.
    """

    _powers = np.ones(1, np.uint64)
    _inverses = np.ones(1, np.uint64)

    def __init__(self, items: np.ndarray):
        n = len(items)
        self._grow(n + 1)
        self.total = np.empty(n + 1, np.uint64)
        self.total[0] = 0
        sums = np.multiply(items, self._powers[:n], out=self.total[1:])
        np.cumsum(sums, out=sums)

    @classmethod
    def _grow(cls, n: int) -> None:
        if len(cls._powers) < n:
            factors = np.full((2, 1 << int(n).bit_length()), [[_MULTIPLIER], [_INVERSE]], np.uint64)
            factors[:, 0] = 1
            cls._powers, cls._inverses = np.cumprod(factors, axis=1, dtype=np.uint64)

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self._inverses[start])

    def every(self, length: int) -> np.ndarray:
        """Hash of the run of this length at each position where one fits."""
        n = max(0, len(self.total) - length)
        return mix((self.total[length:] - self.total[:n]) * self._inverses[:n])


class Block:
    """Some consecutive texts: their bytes, words, and which words belong to which text."""

    def __init__(self, texts: pa.Array, fold: bool = False):
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:][: len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[ends[0]: ends[-1]] if raw and ends[-1] else np.zeros(0, np.uint8)
        if fold:
            data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        self.data, self.offsets = data, ends - ends[0]
        solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
        edge = np.zeros(len(data) + 1, bool)
        edge[self.offsets] = True
        before = np.concatenate([[False], solid[:-1]]) if len(data) else solid
        after = np.concatenate([solid[1:], [False]]) if len(data) else solid
        self.starts = np.flatnonzero(solid & (~before | edge[:-1]))
        self.ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, self.offsets)  # words before each text

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owners(self) -> np.ndarray:
        """Text number of each word."""
        return np.repeat(np.arange(len(self)), self.counts)

    @cached_property
    def runs(self) -> RunHashes:
        """Hashes of any run of the bytes."""
        items = self.data.astype(np.uint64)
        items += np.uint64(1)
        return RunHashes(items)

    def hashes(self) -> np.ndarray:
        return self.runs.between(self.starts, self.ends)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]: self.ends[i]].tobytes()


def blocks(
    batches: Iterator[pa.RecordBatch], column: str = "text", fold: bool = False
) -> Iterator[tuple[pa.RecordBatch, Block]]:
    """Slices of the batches of about ``BLOCK_BYTES`` of text, each with its words."""
    for batch in batches:
        texts = batch.column(column)
        sizes = np.cumsum(np.nan_to_num(
            pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.float64)))
        at = 0
        while at < batch.num_rows:
            done = sizes[at - 1] if at else 0.0
            end = max(at + 1, int(np.searchsorted(sizes, done + BLOCK_BYTES, "right")))
            part = batch.slice(at, end - at)
            yield part, Block(part.column(column), fold)
            at = end


class Vocabulary:
    """Fixed-width ids of words, computed once per distinct word and kept up to ``limit``.

    Known words lie in arrays in order of their hashes, so a block is looked up at once.
    """

    def __init__(self, encode: Callable[[bytes], bytes], width: int, limit: int = 600_000):
        self.encode, self.limit, self.kind = encode, limit, np.dtype(f"<u{width}")
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.begins = self.lengths = np.zeros(0, np.int64)  # of each word's ids in ``codes``
        self.codes = np.zeros(0, self.kind)

    def places(self, block: Block, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the distinct words are known; those that were not are learned."""
        place = np.searchsorted(self.hashes, hashes)
        new = np.ones(len(hashes), bool)
        inside = place < len(self.hashes)
        new[inside] = self.hashes[place[inside]] != hashes[inside]
        if not new.any():
            return place
        raw, first = block.data.tobytes(), at[new]
        found = [self.encode(raw[s:e]) for s, e in zip(
            block.starts[first].tolist(), block.ends[first].tolist())]
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // self.kind.itemsize
        begins = len(self.codes) + np.cumsum(lengths) - lengths
        self.codes = np.concatenate([self.codes, np.frombuffer(b"".join(found), self.kind)])
        self.hashes = np.insert(self.hashes, place[new], hashes[new])
        self.begins = np.insert(self.begins, place[new], begins)
        self.lengths = np.insert(self.lengths, place[new], lengths)
        return place + np.cumsum(new) - new

    def ids(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words of the block in order, and the number of ids of each word."""
        hashes, at, word = np.unique(block.hashes(), return_index=True, return_inverse=True)
        if len(self.hashes) > self.limit:
            self.clear()
        known = self.places(block, hashes, at)[word]
        per_word = self.lengths[known]
        place = np.cumsum(per_word) - per_word
        return self.codes[
            np.repeat(self.begins[known] - place, per_word) + np.arange(per_word.sum())], per_word


def text_digest(text: str | Column = "text") -> Column:
    """128-bit digest of a text; null and empty texts share one."""
    column = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.md5(F.coalesce(column, F.lit(""))))
