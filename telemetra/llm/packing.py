"""Best-fit packing of tokenised documents by exact-complement hashing.

Lengths are whole numbers up to the capacity, so the lengths of all pieces form a histogram of
at most ``capacity`` entries, however many documents there are. The driver plans on that
histogram: which combinations of lengths fill a sequence, and how often. Tasks then place
their pieces by looking up the plan with each piece's number among the pieces of its length.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from telemetra.llm import text as tx
from telemetra.llm.frames import arrow_map, shifted
from telemetra.session import materialize

CAPACITY = 4096
END_ID = 1

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, _part int, _place long"


class WordIds:
    """Ids of one word. Plain Latin letters go to the BPE model directly, folded in A-Z.

    The tokeniser's normaliser and splitter leave such words as they are but for that folding,
    and its byte alphabet is asked for once per letter. Any other word takes the whole tokeniser
    as it is, because special tokens are looked for before anything is folded. White space
    always separates tokens, so ids of a text are those of its words in order.
    """

    plain = re.compile("([A-Za-zß-öø-ÿ]+)([.,]?)")

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        spelled = self.whole.pre_tokenizer.pre_tokenize_str
        letters = [*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100)]
        self.table = {c: spelled(chr(c))[0][0] for c in letters}
        self.same = all(self.table[c] == chr(c) for c in range(0x61, 0x7B))
        self.table |= {c - 32: self.table[c] for c in range(0x61, 0x7B)}
        self.codes = [struct.pack("<H", i) for i in range(max(self.whole.get_vocab().values()) + 1)]
        self.marks = {m: self.coded(self.full(m) if m else []) for m in ("", ".", ",")}

    def full(self, word: str) -> list[int]:
        return self.whole.encode(word, add_special_tokens=False).ids

    def coded(self, ids: list[int]) -> bytes:
        return b"".join([self.codes[i] for i in ids])

    def __call__(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        parts = self.plain.fullmatch(text)
        if not parts:
            return self.coded(self.full(text))
        stem, mark = parts.groups()
        if not (self.same and stem.isascii() and stem.islower()):
            stem = stem.translate(self.table)
        codes = self.codes
        return b"".join([codes[t.id] for t in self.model.tokenize(stem)]) + self.marks[mark]


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Token pieces of ``doc_id, text``: at most ``capacity`` ids each, cut only if longer.

    A null or empty text is the one end id. ``_place`` numbers the pieces of one length inside
    the task ``_part``.
    """
    path = path or public_tokenizers.path("word_bpe_49k.json")

    def run(batches):
        known = tx.Vocabulary(WordIds(path), 2)
        seen: Counter = Counter()
        part = TaskContext.get().partitionId()
        for rows, block in tx.blocks(batches):
            ids, per_word = known.ids(block)
            end = np.concatenate([[0], np.cumsum(per_word)])[block.first]
            out = {c.split()[0]: [] for c in PIECES.split(", ")}
            for i, doc in enumerate(rows.column("doc_id").to_pylist()):
                own = np.append(ids[end[i]: end[i + 1]], END_ID).astype("<u4")
                for piece, start in enumerate(range(0, len(own), capacity)):
                    cut = own[start: start + capacity]
                    place = seen[len(cut)]
                    seen[len(cut)] = place + 1
                    for name, value in zip(out, (
                            doc, piece, start, len(cut), zlib.crc32(cut.tobytes()), part, place)):
                        out[name].append(value)
            yield out

    return arrow_map(docs.select("doc_id", "text"), run, PIECES)


class Stock:
    """How many pieces of each length are left."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in histogram.items():
            self.left[length] = n

    def single(self, gap: int) -> tuple[int, ...] | None:
        return (gap,) if self.left[gap] else None

    def pair(self, gap: int) -> tuple[int, ...] | None:
        """Two lengths that sum to the gap, the larger as large as possible."""
        small = self.left[1: gap // 2 + 1] > 0
        large = self.left[gap - 1: gap - len(small) - 1: -1] > 0
        both = small & large
        if gap % 2 == 0 and len(both) and self.left[gap // 2] < 2:
            both[-1] = False
        at = int(np.argmax(both)) if both.any() else -1
        return None if at < 0 else (gap - 1 - at, at + 1)

    def triple(self, gap: int) -> tuple[int, ...] | None:
        for first in (np.flatnonzero(self.left[1:gap])[::-1] + 1).tolist():
            if 3 * first < gap:
                return None  # the first is the largest of the three
            self.left[first] -= 1
            rest = self.pair(gap - first) if gap - first > 1 else None
            self.left[first] += 1
            if rest:
                return (first, *rest)
        return None

    def largest(self, gap: int) -> int:
        fits = np.flatnonzero(self.left[1: gap + 1])
        return int(fits[-1]) + 1 if len(fits) else 0


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Combinations of lengths and how many sequences each fills.

    The longest length left opens a sequence. Its gap is filled exactly by one, two or three
    other lengths if the stock has them; otherwise the largest length that fits goes in (best
    fit) and the rest of the gap is tried again. Each combination is used as often as the stock
    allows at once, which uses up at least one length, so the plan has at most a few entries
    per length.
    """
    stock, chosen = Stock(histogram, capacity), []
    while longest := stock.largest(capacity):
        combination, gap = [longest], capacity - longest
        stock.left[longest] -= 1
        while gap:
            fill = stock.single(gap) or stock.pair(gap) or stock.triple(gap)
            if not fill:
                best = stock.largest(gap)
                if not best:
                    break
                fill = (best,)
            for length in fill:
                stock.left[length] -= 1
            combination += fill
            gap -= sum(fill)
        uses = Counter(combination)
        more = min(int(stock.left[length]) // n for length, n in uses.items())
        for length, n in uses.items():
            stock.left[length] -= more * n
        chosen.append((tuple(combination), more + 1))
    return chosen


def slots(chosen: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """The plan by length and number: ranges of pieces of one length and where they go."""
    taken: Counter = Counter()
    found, sequence = [], 0
    for combination, times in chosen:
        offset = 0
        for length in combination:
            found.append((length, taken[length], sequence, offset))
            taken[length] += times
            offset += length
        sequence += times
    found.sort()
    columns = np.array(found, np.int64).reshape(-1, 4).T
    return dict(zip(("length", "number", "sequence", "offset"), columns))


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Place of every token piece of ``doc_id, text`` in sequences of ``capacity`` tokens.

    One row per piece. Repeated rows are packed as often as they come; an empty table gives no
    rows. Pieces of one length are interchangeable, so only the number of a piece among its
    length decides its place.
    """
    stored = materialize(pieces(docs, capacity, path), "pieces")
    counts = stored.groupBy("length", "_part").agg(F.max("_place").alias("top"))
    sizes = counts.groupBy("length").agg(F.sum(F.col("top") + 1).alias("n"))
    # at most one row per possible length
    table = slots(plan({r["length"]: r["n"] for r in sizes.collect()}, capacity))
    kept = PIECES.split(", _part")[0]
    names = [c.split()[0] for c in kept.split(", ")]
    base = table["length"] << 48 | table["number"]

    def place(batches):
        for batch in batches:
            key = batch.column("length").to_numpy() << 48 | batch.column("_number").to_numpy()
            at = np.searchsorted(base, key, "right") - 1
            yield {c: batch.column(c) for c in names} | {
                "sequence_id": table["sequence"][at] + (key - base[at]),
                "offset": table["offset"][at],
            }

    return arrow_map(
        shifted(stored, "length", "_number"), place, f"{kept}, sequence_id long, offset long")
