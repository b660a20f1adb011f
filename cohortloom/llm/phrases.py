"""Collocations: phrases that are said more often than their parts would meet by chance.

N-grams are counted in a prefix-free parse of the texts. A text becomes a stream of words with
a mark wherever no phrase can go on: at punctuation, at words that are too rare to be part of
one, and in front. A window of `longest - 1` words whose hash falls into a fixed class is a
trigger: a chunk ends there, and the next one begins with the same window. So copies and shared
passages give the same chunks wherever they stand, and the parse is a dictionary of distinct
chunks with their frequencies. Every n-gram lies inside a chunk, and is counted, weighted, in
the one whose words behind the leading window hold its last word: overlaps are assigned once.

Counting goes by size. An n-gram can only reach the threshold if all n-grams inside it do, so
pairs are made of frequent words, and longer ones where all their pairs are frequent. What is
frequent is told to the tasks by a bitmap of fixed size over hashes: it may let a rare n-gram
through, which the exact count then drops, and misses none.

The most frequent words, a fixed number of them, have codes of three bytes, in which chunks and
n-grams are shuffled; others are spelled. That makes rows short and decides nothing else.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import GOLDEN, map_arrow, mix64, raw, slices, table, whole_text
from cohortloom.sources.storage import materialize

SLICE = 8 << 20  # bytes of text, or of chunks in codes, that are counted at once
TRIGGER = 32  # one window in so many ends a chunk
SIEVE_BITS = 1 << 25  # of the bitmap of frequent n-grams, 4 MB
CODED = 1 << 17  # words with codes, in all languages together
SPELLED = 1 << 23  # numbers from here on stand for words without a code
CODE = 24  # bits of a code or of such a number
UNKNOWN = "und"
MARK = b"."  # a sign of punctuation, so never part of a word
# Letters in either case, the white space inside pieces and the ends of pieces.
_FROM = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + b"\t" + b",;:!?\n\x0b\x0c\r"
_TO = b"abcdefghijklmnopqrstuvwxyz" + b" " + b"." * 9
FOLDED = bytes.maketrans(_FROM, _TO)
WORDS = "lang string, phrase string, n long"
CHUNKS = "lang string, codes binary, spelled string, n long"
GRAMS = "gram binary, lang string, phrase string, n long"  # codes, or else language and words
NAMED = "lang string, phrase string, size int, n long"


def words_of(text: bytes) -> list[bytes]:
    """Words of a text in lower case, with a mark at each end of a piece."""
    return text.translate(FOLDED).replace(MARK, b" . ").split()


class Numbers(dict):
    """Word -> number in the order of first sight; the mark is zero."""

    def __init__(self):
        super().__init__({MARK: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def numbered(words: list[bytes], numbers: Numbers) -> np.ndarray:
    return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


def by_language(batch: pa.RecordBatch, column: str) -> Iterator[tuple[str, np.ndarray, list[bytes]]]:
    """Language, row numbers and contents of the rows of each language."""
    content = raw(batch.column(column))
    rows = defaultdict(list)
    for i, lang in enumerate(batch.column("lang").to_pylist()):
        rows[lang].append(i)
    for lang, at in rows.items():
        yield lang, np.array(at), [content[i] for i in at]


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sum of the weights of each, in whole numbers."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    starts = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])[: len(ranked)])
    return ranked[starts], np.add.reduceat(weights[order], starts) if len(starts) else weights[:0]


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, names=[part.split()[0] for part in schema.split(", ")])


def _same(value: str | None, n: int) -> pa.Array:
    return pa.nulls(n, pa.string()) if value is None else pa.repeat(pa.scalar(value), n)


def _strings(content: list[bytes]) -> pa.Array:
    return pa.array(content, pa.binary()).cast(pa.string())


class Sieve:
    """A bitmap over hashes of phrases."""

    def __init__(self, places: DataFrame, bits: int):
        cells = (
            places.groupBy(F.expr("at div 32").alias("cell"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 32 as int))")).alias("held"))
            .toArrow()  # a row for each cell that holds anything: a fixed number at most
        )
        self.bits = bits
        self.cells = np.zeros(bits // 32, np.uint32)
        self.cells[cells.column("cell").to_numpy()] = cells.column("held").to_numpy()

    def at(self, places: np.ndarray) -> np.ndarray:
        return (self.cells[places >> 5] >> (places & 31).astype(np.uint32) & 1).astype(bool)


def places_of(lang: str, phrases: list[bytes], bits: int) -> np.ndarray:
    """Places of spelled phrases in a bitmap."""
    seed, digest = xxhash.xxh64_intdigest(lang.encode(), 42), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(p, seed) for p in phrases), np.uint64, len(phrases))
    return (hashes % np.uint64(bits)).astype(np.int64)


def places_of_keys(keys: np.ndarray, bits: int) -> np.ndarray:
    """Places of pairs of codes in a bitmap."""
    return (mix64(keys.astype(np.uint64) * GOLDEN) % np.uint64(bits)).astype(np.int64)


def word_sieve(words: DataFrame, bits: int) -> Sieve:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, _, content in by_language(batch, "phrase"):
                yield _batch("at long", [pa.array(places_of(lang, content, bits))])

    return Sieve(map_arrow(words.select("lang", "phrase"), run, "at long"), bits)


def pair_sieve(pairs: DataFrame, bits: int) -> Sieve:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = batch.filter(batch.column("gram").is_valid())
            ids = from_bytes(coded.column("gram").to_pylist()).reshape(-1, 2)
            yield _batch("at long", [pa.array(places_of_keys(ids[:, 0] << CODE | ids[:, 1], bits))])
            for lang, _, content in by_language(batch.filter(batch.column("phrase").is_valid()), "phrase"):
                yield _batch("at long", [pa.array(places_of(lang, content, bits))])

    return Sieve(map_arrow(pairs.select("gram", "lang", "phrase"), run, "at long"), bits)


def to_bytes(ids: np.ndarray) -> bytes:
    """Three bytes for each code or number."""
    return np.ascontiguousarray(ids.astype(">u4").view(np.uint8).reshape(-1, 4)[:, 1:]).tobytes()


def from_bytes(content: list[bytes]) -> np.ndarray:
    part = np.frombuffer(b"".join(content), np.uint8).reshape(-1, 3).astype(np.int64)
    return part[:, 0] << 16 | part[:, 1] << 8 | part[:, 2]


@dataclass
class Codes:
    """The most frequent words; a word's code is its place, which is its language's alone."""

    langs: list[str]  # by code
    words: list[bytes]

    @classmethod
    def of(cls, words: DataFrame, most: int) -> Codes:
        top = words.orderBy(F.desc("n"), "lang", "phrase").limit(most).select("lang", "phrase").collect()
        return cls(["", *[r["lang"] for r in top]], [MARK, *[r["phrase"].encode() for r in top]])

    def by_language(self) -> dict[str, dict[bytes, int]]:
        found: dict[str, dict[bytes, int]] = defaultdict(dict)
        for code in range(1, len(self.words)):
            found[self.langs[code]][self.words[code]] = code
        return found


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, phrase, n): how often each word occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            for lang, _, content in by_language(batch, "text"):
                numbers = Numbers()
                found = [numbered(words_of(text), numbers) for text in content]
                n = np.bincount(np.concatenate(found), minlength=len(numbers))[1:]
                yield _batch(WORDS, [_same(lang, len(n)), _strings(list(numbers)[1:]), pa.array(n)])

    return map_arrow(docs, run, WORDS).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def triggers(stream: np.ndarray, hashes: np.ndarray, width: int, every: int) -> np.ndarray:
    """Places in a stream of word numbers where a window that ends a chunk ends."""
    key = np.zeros(max(0, len(stream) - width + 1), np.uint64)
    for i in range(width):
        key = mix64(key * GOLDEN + hashes[stream[i : i + len(key)]])
    return np.flatnonzero(key % np.uint64(every) == 0) + width - 1


def parse(stream: np.ndarray, hashes: np.ndarray, width: int, every: int) -> list[tuple[int, int]]:
    """Chunks (from, to) of a stream that begins with `width` marks.

    Each begins with the last `width` words of the one before.
    """
    ends = triggers(stream, hashes, width, every)
    ends = ends[(ends >= width) & (ends < len(stream) - 1)]
    starts = np.append(0, ends - width + 1).tolist()
    return list(zip(starts, [*(ends + 1).tolist(), len(stream)], strict=True))


def without_rare(ids: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The numbers of a text with marks for rare words; words alone and repeated marks go."""
    if not len(ids):
        return ids
    word = frequent[ids]
    pair = word[1:] & word[:-1]
    run = np.append(pair, False) | np.append(False, pair)
    kept = np.where(run, ids, 0)
    return kept[run | np.append(False, run[:-1])]  # with one mark behind each run


def chunks(docs: DataFrame, codes: Codes, frequent: Sieve, width: int, every: int) -> DataFrame:
    """(lang, codes, spelled, n): the dictionary of the parse.

    A word without a code is a number from SPELLED on, its place among the words of the chunk
    that are spelled, which are joined by spaces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code_of = codes.by_language()
        for batch in slices(batches, "text", SLICE):
            for lang, _, content in by_language(batch, "text"):
                numbers = Numbers()
                found = [numbered(words_of(text), numbers) for text in content]
                words = list(numbers)
                own = code_of.get(lang, {})
                code = np.fromiter((own.get(w, 0) for w in words), np.int64, len(words))
                known = frequent.at(places_of(lang, words, frequent.bits))
                known[0] = False
                bare = known & (code == 0)
                some = bool(bare.any())
                digest = xxhash.xxh64_intdigest
                hashes = np.fromiter(map(digest, words), np.uint64, len(words))
                lead, n = np.zeros(width, np.int64), defaultdict(int)
                for ids in found:
                    if not len(body := without_rare(ids, known)):
                        continue
                    stream = np.concatenate([lead, body])
                    line = to_bytes(code[stream])
                    for start, end in parse(stream, hashes, width, every):
                        if some and (at := np.flatnonzero(bare[stream[start:end]])).size:
                            part = code[stream[start:end]]
                            spelled = Numbers()  # its first number is that of the mark
                            part[at] = [
                                SPELLED - 1 + spelled[words[i]] for i in stream[start:end][at].tolist()
                            ]
                            n[to_bytes(part), b" ".join(list(spelled)[1:])] += 1
                        else:
                            n[line[3 * start : 3 * end], b""] += 1
                if n:
                    parts, rest = zip(*n, strict=True)
                    counts = pa.array(np.fromiter(n.values(), np.int64, len(n)))
                    yield _batch(
                        CHUNKS,
                        [_same(lang, len(n)), pa.array(parts, pa.binary()), _strings(rest), counts],
                    )

    found = map_arrow(docs, run, CHUNKS)
    return found.groupBy("lang", "codes", "spelled").agg(F.sum("n").alias("n"))


class Chunks:
    """Codes and weights of some distinct chunks of a language."""

    def __init__(self, codes: list[bytes], spelled: list[bytes], weights: np.ndarray, width: int):
        self.ids = from_bytes(codes)
        sizes = np.array([len(c) // 3 for c in codes])
        starts = np.cumsum(sizes) - sizes
        numbers = Numbers()
        for i, rest in enumerate(spelled):
            if rest:  # its words get numbers that hold for all these chunks
                own = self.ids[starts[i] : starts[i] + sizes[i]]
                at = np.flatnonzero(own >= SPELLED)
                shared = numbered(rest.split(b" "), numbers) - 1
                own[at] = SPELLED + shared[own[at] - SPELLED]
        self.spelled = list(numbers)[1:]
        self.weights = np.repeat(weights, sizes)
        # the leading window was counted in the chunk before
        place = np.arange(len(self.ids)) - np.repeat(starts, sizes)
        self.counts = place >= width

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Places where a pair of words ends, and the key of each pair."""
        at = np.flatnonzero((self.ids[1:] > 0) & (self.ids[:-1] > 0)) + 1
        return at, self.ids[at - 1] << CODE | self.ids[at]

    def spell(self, ids: np.ndarray, words: list[bytes]) -> list[bytes]:
        """The words of n-grams (rows of ids), joined by spaces."""
        return [
            b" ".join([words[i] if i < SPELLED else self.spelled[i - SPELLED] for i in row])
            for row in ids.tolist()
        ]

    def rows(
        self, lang: str, ids: np.ndarray, n: np.ndarray, words: list[bytes]
    ) -> Iterator[pa.RecordBatch]:
        """Rows of GRAMS: those with codes for all words, then the others."""
        bare = (ids >= SPELLED).any(axis=1)
        coded, counts = ids[~bare], n[~bare]
        if len(coded):
            step = 3 * ids.shape[1]
            offsets = np.arange(0, step * (len(coded) + 1), step, dtype=np.int32)
            buffers = [None, pa.py_buffer(offsets), pa.py_buffer(to_bytes(coded.ravel()))]
            grams = pa.Array.from_buffers(pa.binary(), len(coded), buffers)
            none = _same(None, len(coded))
            yield _batch(GRAMS, [grams, none, none, pa.array(counts)])
        if bare.any():
            rest = self.spell(ids[bare], words)
            nothing = pa.nulls(len(rest), pa.binary())
            yield _batch(GRAMS, [nothing, _same(lang, len(rest)), _strings(rest), pa.array(n[bare])])


def _chunk_slices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[str, Chunks]]:
    for batch in slices(batches, "codes", SLICE):
        weights = np.asarray(batch.column("n"), dtype=np.int64)
        spelled = raw(batch.column("spelled"))
        for lang, rows, content in by_language(batch, "codes"):
            yield lang, Chunks(content, [spelled[i] for i in rows.tolist()], weights[rows], width)


def _added_up(grams: DataFrame) -> DataFrame:
    return grams.groupBy("gram", "lang", "phrase").agg(F.sum("n").alias("n"))


def count_pairs(parsed: DataFrame, codes: Codes, width: int) -> DataFrame:
    """Rows of GRAMS for the pairs of words in the dictionary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, held in _chunk_slices(batches, width):
            at, keys = held.pairs()
            own = held.counts[at]
            keys, n = summed(keys[own], held.weights[at[own]])
            ids = np.stack([keys >> CODE, keys & ((1 << CODE) - 1)], axis=1)
            yield from held.rows(lang, ids, n, codes.words)

    return _added_up(map_arrow(parsed, run, GRAMS))


def count_longer(parsed: DataFrame, codes: Codes, pairs: Sieve, width: int) -> DataFrame:
    """Rows of GRAMS for three to `width + 1` words, all pairs of which are frequent."""

    def frequent(lang: str, held: Chunks, keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
        good = pairs.at(places_of_keys(keys, pairs.bits))
        bare = np.flatnonzero((ids >= SPELLED).any(axis=1))
        if len(bare):
            names = held.spell(ids[bare], codes.words)
            good[bare] = pairs.at(places_of(lang, names, pairs.bits))
        return good

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, held in _chunk_slices(batches, width):
            at, keys = held.pairs()
            distinct, which = np.unique(keys, return_inverse=True)
            ids = np.stack([distinct >> CODE, distinct & ((1 << CODE) - 1)], axis=1)
            good = frequent(lang, held, distinct, ids)[which]
            # number of the n-gram that ends at a place, none where it isn't frequent
            ending = np.full(len(held.ids), -1)
            ending[at[good]] = which[good]
            second = ending >= 0
            for _ in range(3, width + 2):
                ends = np.flatnonzero(second[1:] & (ending[:-1] >= 0)) + 1
                if not len(ends):
                    break
                grams = ending[ends - 1] << CODE | held.ids[ends]
                distinct, which = np.unique(grams, return_inverse=True)
                ids = np.hstack([ids[distinct >> CODE], (distinct & ((1 << CODE) - 1))[:, None]])
                own = held.counts[ends]
                counted, n = summed(which[own], held.weights[ends[own]])
                yield from held.rows(lang, ids[counted], n, codes.words)
                ending = np.full(len(held.ids), -1)
                ending[ends] = which

    return _added_up(map_arrow(parsed, run, GRAMS))


def named(grams: DataFrame, codes: Codes) -> DataFrame:
    """(lang, phrase, size, n) of rows of GRAMS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, phrases, sizes = [], [], []
            for gram, lang, phrase in zip(
                *(batch.column(k).to_pylist() for k in ("gram", "lang", "phrase")), strict=True
            ):
                if gram is not None:
                    own = from_bytes([gram]).tolist()
                    lang = codes.langs[own[0]]
                    phrase = b" ".join([codes.words[i] for i in own]).decode()
                langs.append(lang)
                phrases.append(phrase)
                sizes.append(phrase.count(" ") + 1)
            kinds = [pa.array(langs, pa.string()), pa.array(phrases, pa.string()), pa.array(sizes, pa.int32())]
            yield _batch(NAMED, [*kinds, batch.column("n")])

    return map_arrow(grams, run, NAMED)


def frequent_grams(
    docs: DataFrame,
    min_count: int,
    longest: int,
    every: int = TRIGGER,
    bits: int = SIEVE_BITS,
    coded: int = CODED,
) -> tuple[DataFrame, DataFrame]:
    """Totals (lang, total) of words, and (lang, phrase, size, n) of what is said often enough.

    `docs` has columns lang and text without nulls.
    """
    width = longest - 1
    often = F.col("n") >= min_count
    words = materialize(count_words(docs), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    common = words.where(often)
    codes = Codes.of(common, min(coded, SPELLED - 1))
    parsed = materialize(
        chunks(docs, codes, word_sieve(common, bits), width, every), "phrase-chunks"
    )
    found = [materialize(count_pairs(parsed, codes, width).where(often), "word-pairs")]
    if longest > 2:
        longer = count_longer(parsed, codes, pair_sieve(found[0], bits), width).where(often)
        found.append(materialize(longer, "longer-phrases"))
    grams = common.select("lang", "phrase", F.lit(1).alias("size"), "n")
    for more in found:
        grams = grams.unionByName(named(more, codes))
    return totals, materialize(grams, "phrases")


def collocations(
    docs: DataFrame,
    min_count: int = 100,
    longest: int = 5,
    top: int = 2000,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """The `top` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts in lower case (A-Z only) are cut into pieces at `.,;:!?` and line ends, pieces at
    spaces and tabs into words. A phrase is two to `longest` words of a piece that occur `a`
    times, `min_count` at least. `n` counts the words of the language. The score is
    floor(1000 a n / (l r)) where l and r count its two parts, for the cut that makes it
    lowest, the first of those that tie. A phrase inside a longer one that occurs as often
    is left out. Ranks go by score and a, descending, then by the phrase's bytes.

    A null language is `und`. Null and empty texts hold no words; rows that repeat count each;
    a very long text is counted by one task. A language without phrases gives no row, nor does
    an empty table. Other columns are not read. Everything is counted over all rows.
    """
    if longest < 2 or min_count < 1:
        raise ValueError("a phrase has two words and occurs once, at least")
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        whole_text(text_col).alias("text"),
    )
    totals, grams = frequent_grams(rows, min_count, longest)
    phrases = grams.where("size > 1").withColumnRenamed("n", "a")
    # frequencies fall with every word added, so of the longer phrases around one that occur
    # as often there is one of a single word more
    inner = (
        phrases.where("size > 2")
        .withColumn("word", F.split("phrase", " "))
        .selectExpr(
            "lang",
            "explode(array(array_join(slice(word, 1, size - 1), ' '),"
            " array_join(slice(word, 2, size - 1), ' '))) AS phrase",
            "a AS outer",
        )
        .groupBy("lang", "phrase")
        .agg(F.max("outer").alias("outer"))
    )
    apart = (
        phrases.join(inner, ["lang", "phrase"], "left")
        .where("outer IS NULL OR 100 * outer < 100 * a")
        .drop("outer")
    )
    cuts = (
        apart.withColumn("word", F.split("phrase", " "))
        .selectExpr("lang", "phrase", "a", "size", "word", "explode(sequence(1, size - 1)) AS k")
        .selectExpr(
            "lang",
            "phrase",
            "a",
            "k",
            "array_join(slice(word, 1, k), ' ') AS first",
            "array_join(slice(word, k + 1, size - k), ' ') AS rest",
        )
    )
    exact = "cast({} AS decimal(16,0))".format
    score = f"({exact('a')} * 1000 * {exact('total')}) div ({exact('l')} * {exact('r')})"
    scored = (
        cuts.join(grams.selectExpr("lang", "phrase AS first", "n AS l"), ["lang", "first"])
        .join(grams.selectExpr("lang", "phrase AS rest", "n AS r"), ["lang", "rest"])
        .join(totals, "lang")
        .withColumn("score", F.expr(score))
        .groupBy("lang", "phrase", "a", "total")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    place = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    return (
        scored.withColumn("rank", F.row_number().over(place))
        .where(F.col("rank") <= top)
        .selectExpr(
            "lang", "cast(rank AS long) AS rank", "phrase", "a", "cut.l", "cut.r", "total AS n", "cut.score"
        )
    )


def op12_phrases(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents),
pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^ \x09]+') AS w
    FROM (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs)),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces WHERE len(w) > 0),
sized AS (SELECT lang, w, i, unnest(range(1, least(5, len(w) - i + 1) + 1)) AS size FROM places),
grams AS (
    SELECT lang, array_to_string(w[i : i + size - 1], ' ') AS phrase, size, count(*) AS a
    FROM sized GROUP BY ALL),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM grams WHERE size = 1 GROUP BY lang),
often AS (SELECT * FROM grams WHERE a >= 100),
inner_ AS (
    SELECT lang, phrase, max(a) AS outer_a
    FROM (SELECT lang, a,
                 unnest([array_to_string(w[1 : size - 1], ' '), array_to_string(w[2 : size], ' ')]) AS phrase
          FROM (SELECT *, string_split(phrase, ' ') AS w FROM often WHERE size > 2))
    GROUP BY ALL),
apart AS (
    SELECT o.* FROM often o LEFT JOIN inner_ i ON o.lang = i.lang AND o.phrase = i.phrase
    WHERE o.size > 1 AND (i.outer_a IS NULL OR 100 * i.outer_a < 100 * o.a)),
cuts AS (
    SELECT lang, phrase, a, k, array_to_string(w[1 : k], ' ') AS first_, array_to_string(w[k + 1 : size], ' ') AS rest
    FROM (SELECT *, unnest(range(1, size)) AS k FROM (SELECT *, string_split(phrase, ' ') AS w FROM apart))),
scored AS (
    SELECT c.lang, c.phrase, c.a, c.k, f.a AS l, g.a AS r, t.n,
           (1000::HUGEINT * c.a * t.n) // (f.a::HUGEINT * g.a) AS score
    FROM cuts c
    JOIN often f ON f.lang = c.lang AND f.phrase = c.first_
    JOIN often g ON g.lang = c.lang AND g.phrase = c.rest
    JOIN totals t ON t.lang = c.lang),
lowest AS (
    SELECT * FROM scored
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score::BIGINT AS score
FROM lowest
QUALIFY rank <= 2000
"""
