"""Benchmark passages in documents, by SimHash over windows of the items' sizes.

Texts are lower-cased and cut into words of letters and digits; features are shingles of
five words (fewer in items that are shorter). A document is read with windows that hold as
many shingles as an item, one at every position that holds any shingle of the items of that
length: all other windows have similarity zero to them. The SimHash of a window is looked up in a multi-index:
the fingerprint is cut into seven blocks, and fingerprints within the radius differ by no
more than a seventh of it in some block, so each item stands in the tables under every value
that near its own blocks. Candidates within the radius are verified by the exact similarity
of their weighted shingles.

The benchmark is taken in blocks of a bounded number of words, each one pass over the
documents; nothing of the documents is shuffled.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import GOLDEN, map_arrow, mix64, slices, table, texts, whole_text

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 20
BLOCKS = 7
WORDS_IN_A_PASS = 2_000_000  # of the benchmark
REMEMBERED = 200_000  # words whose hashes a worker keeps; it starts anew beyond
WORD = re.compile(r"[^\W_]+")


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 17)
        return value


_hashes = _Hashes()


def word_hashes(text: str) -> np.ndarray:
    words = WORD.findall(text.lower())
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    key = np.full(n, size, np.uint64)
    for i in range(size):
        key = mix64(key * GOLDEN + words[i : i + n])
    return key


def window_prints(hashes: np.ndarray, size: int) -> np.ndarray:
    """SimHash of each window of `size` shingles."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    sums = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, dtype=np.int32, out=sums[1:])
    majority = 2 * (sums[size:] - sums[:-size]) > size
    return np.packbits(majority, axis=1).view(">u8").ravel().astype(np.uint64)


class BlockIndex:
    """Fingerprints under every block value that lies within a radius of their own."""

    def __init__(self, prints: np.ndarray, radius: int = RADIUS, blocks: int = BLOCKS):
        self.prints, self.radius = prints, radius
        edges = [64 * b // blocks for b in range(blocks + 1)]
        self.blocks = [(a, b - a) for a, b in itertools.pairwise(edges)]
        self.tables: list[dict[int, list[int]]] = []
        for shift, width in self.blocks:
            held = defaultdict(list)
            for i, value in enumerate(self._values(prints, shift, width).tolist()):
                for n in range(radius // blocks + 1):
                    for flips in itertools.combinations(range(width), n):
                        held[value ^ sum(1 << f for f in flips)].append(i)
            self.tables.append(dict(held))

    @staticmethod
    def _values(prints: np.ndarray, shift: int, width: int) -> np.ndarray:
        return (prints >> np.uint64(shift)) & np.uint64((1 << width) - 1)

    def near(self, windows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(fingerprint's number, numbers of the windows within the radius of it)."""
        candidates: dict[int, list[np.ndarray]] = defaultdict(list)
        for (shift, width), held in zip(self.blocks, self.tables, strict=True):
            values = self._values(windows, shift, width)
            order = np.argsort(values, kind="stable")
            ranked = values[order]
            cuts = np.flatnonzero(np.diff(ranked)) + 1
            for part in np.split(order, cuts):
                for i in held.get(int(values[part[0]]), ()):
                    candidates[i].append(part)
        for i, parts in sorted(candidates.items()):
            at = np.unique(np.concatenate(parts))
            near = np.bitwise_count(windows[at] ^ self.prints[i]) <= self.radius
            if near.any():
                yield i, at[near]


class Items:
    """The items of one pass, by the size of their shingles and the number of these."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.groups: dict[int, dict[int, tuple]] = {}
        sizes: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
        for item, text in rows:
            words = word_hashes(text or "")
            if len(words):
                size = min(SHINGLE, len(words))
                own = shingles(words, size)
                sizes[size][len(own)].append((item, own))
        # sorted shingles of all items, and of the items of each length
        self.anchors: dict[int, np.ndarray] = {}
        self.own_anchors: dict[int, dict[int, np.ndarray]] = defaultdict(dict)
        for size, by_length in sizes.items():
            self.groups[size] = {}
            for length, items in by_length.items():
                prints = np.array([window_prints(own, length)[0] for _, own in items], np.uint64)
                counts = [Counter(own.tolist()) for _, own in items]
                self.groups[size][length] = ([i for i, _ in items], counts, BlockIndex(prints))
                self.own_anchors[size][length] = np.unique(np.concatenate([x for _, x in items]))
            every = [own for items in by_length.values() for _, own in items]
            self.anchors[size] = np.unique(np.concatenate(every))

    def matches(self, text: str) -> list[tuple[int, int, int, int, float]]:
        """(item, first word, words, differing bits, similarity): the best window of each."""
        words = word_hashes(text)
        best: dict[int, tuple] = {}
        for size, by_length in self.groups.items():
            own = shingles(words, size)
            if not len(own):
                continue
            every = np.flatnonzero(_held(self.anchors[size], own))
            if not len(every):
                continue
            for length, (names, counts, index) in by_length.items():
                # windows without a shingle of these items have similarity zero to them
                anchors = every[_held(self.own_anchors[size][length], own[every])]
                if not len(anchors):
                    continue
                span = min(length, len(own))  # a shorter document is one window
                for first, last in _regions(anchors, span, len(own)):
                    part = own[first : last + span]
                    windows = window_prints(part, span)
                    for i, starts in index.near(windows):
                        for s in starts.tolist():
                            value = similarity(part[s : s + span].tolist(), counts[i], length)
                            if value < SIMILARITY:
                                continue
                            bits = int(np.bitwise_count(windows[s] ^ index.prints[i]))
                            found = (names[i], first + s, span + size - 1, bits, value)
                            old = best.get(names[i])
                            if old is None or (-value, found[1]) < (-old[4], old[1]):
                                best[names[i]] = found
        return [best[k] for k in sorted(best, key=lambda k: (k is None, k))]


def _held(ranked: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the values are in a sorted array."""
    at = np.minimum(np.searchsorted(ranked, values), len(ranked) - 1)
    return ranked[at] == values


def _regions(anchors: np.ndarray, span: int, n: int) -> list[tuple[int, int]]:
    """First and last starts of the windows that hold an anchor, joined where they meet."""
    low = np.maximum(anchors - span + 1, 0)
    high = np.minimum(anchors, n - span)
    cuts = np.flatnonzero(low[1:] > high[:-1] + 1) + 1
    starts = low[np.append(0, cuts)]
    ends = high[np.append(cuts - 1, len(anchors) - 1)]
    return list(zip(starts.tolist(), ends.tolist(), strict=True))


def similarity(window: list[int], item: Counter, length: int) -> float:
    """Jaccard similarity of shingles weighted by how often each occurs."""
    left = dict(item)
    common = 0
    for shingle in window:
        if left.get(shingle):
            left[shingle] -= 1
            common += 1
    return common / (len(window) + length - common)


RESULT = (
    "doc_id long, item_id long, first_word int, n_words int, distance int, similarity double"
)


def _passes(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list]:
    """The benchmark in blocks of bounded size, in order of the items."""
    block, held = [], 0
    rows = benchmark.select(F.col(item_col).cast("long"), whole_text(text_col)).orderBy(1, 2)
    for item, text in rows.toLocalIterator():
        n = text.count(" ") + 1
        if block and held + n > WORDS_IN_A_PASS:
            yield block
            block, held = [], 0
        block.append((item, text))
        held += n
    yield block


def benchmark_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row for each document and benchmark item whose text the document holds.

    Columns: doc_id, item_id, first_word and n_words of the best window (words as cut here),
    distance in bits, similarity (0.8 or more; the first window of those that tie). Null and
    empty texts hold nothing, and items without words are found nowhere. Rows that repeat are
    judged one by one; of items that repeat an identifier the best match is given. Documents
    without a passage give no row, nor does an empty table. Other columns are not read.
    """

    def look(items: Items):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text", 4 << 20):
                rows = [
                    (doc, *match)
                    for doc, text in zip(
                        batch.column("doc_id").to_pylist(), texts(batch.column("text")), strict=True
                    )
                    for match in items.matches(text)
                ]
                if rows:
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
                    names = [part.split()[0] for part in RESULT.split(", ")]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                        names=names,
                    )

        return run

    rows = docs.selectExpr(f"cast(`{id_col}` as long) AS doc_id", f"`{text_col}` AS text")
    found = [
        map_arrow(rows, look(Items(block)), RESULT)
        for block in _passes(benchmark, item_col, item_text_col)
    ]
    return reduce(DataFrame.unionByName, found)


def without_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of `docs` that hold no benchmark item, with all their columns; no shuffle."""

    def look(items: Items):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, text_col, 4 << 20):
                clean = [not items.matches(t) for t in texts(batch.column(text_col))]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return run

    for block in _passes(benchmark, item_col, item_text_col):
        docs = map_arrow(docs, look(Items(block)), docs.schema)
    return docs


def op1_decontamination(spark, sf_dir):
    return benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
