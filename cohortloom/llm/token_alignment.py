"""Alignment of the tokens of two tokenizers, by galloping intersection of their ends.

Both tokenizers cut the same bytes, so a token is a byte range, and the ranges of a text end
at two sorted lists of offsets. The shorter list drives: each of its ends is looked up in the
longer one by steps that double, from where the one before was found, and a binary search in
the last step. Ends in both lists cut the text into groups, and the places that two
neighbouring ends were found at bound the tokens that overlap the one between them.

Neither tokenizer goes on past a single space between two other characters, so groups and
overlaps never do. A word between such spaces is aligned when it is met first and remembered
with its groups and links; a text's are those of its words, one after the other.

How many documents hold a pair of ids is a count over the corpus. Documents are taken in
blocks of a few megabytes; a block names each of its pairs once, with the number of its
documents that hold it, so what is shuffled to count pairs grows with the pairs of a block
and not with its tokens. The counts go back the same way, one row for each pair of a block, and
meet the block's documents in a cogroup. No table is broadcast and none goes to the driver.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import map_arrow, slices, table, texts
from cohortloom.llm.token_counts import byte_alphabet
from cohortloom.llm.token_files import Encoder
from cohortloom.session import ship_package
from cohortloom.sources.storage import materialize

BLOCK = 2 << 20  # bytes of text in a block; a document is never cut
REMEMBERED = 150_000  # parts of texts in each half of what a worker remembers
WORDS = 300_000  # words that a worker remembers the alignment of
LONGEST = 64  # characters of a part or word that is remembered
MARK = "▁"  # a space, in the pieces of the second tokenizer
SUMS = "n_a long, n_b long, n_groups long, n_links long"
HELD = (
    f"block long, doc_id long, {SUMS}, groups_sha256 string, pair array<int>, times array<int>,"
    " a array<int>, b array<int>, docs array<int>"
)
RESULT = f"doc_id long, {SUMS}, n_best long, count_sum long, groups_sha256 string"


class Remembered(dict):
    """Part of a text -> its ids as bytes, filled as parts are met.

    When it is full it becomes the older half of what is remembered. Long parts aren't kept.
    """

    def __init__(self, encode):
        super().__init__()
        self.encode, self.older = encode, {}

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            ids = self.encode(part)
        if len(part) <= LONGEST:
            self.room(1)
            self[part] = ids
        return ids

    def room(self, n: int) -> None:
        if len(self) + n > REMEMBERED:
            self.older = dict(self)
            self.clear()


class Speller:
    """The bytes of each id, and whether ids spell a text."""

    bytes: list[bytes]
    length: np.ndarray

    def spell(self, names: list[bytes]) -> None:
        self.bytes = names
        self.length = np.fromiter(map(len, names), np.int64, len(names))

    def spells(self, ids: np.ndarray, raw: bytes) -> bool:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())) == raw

    def spelled(self, ids: np.ndarray, sizes: np.ndarray, raw: list[bytes]) -> np.ndarray:
        """Which words their ids spell; `ids` are those of all words, joined."""
        at = _offsets(sizes)
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        if np.array_equal(_offsets(self.length[ids])[at], _offsets(lengths)):
            if self.spells(ids, b"".join(raw)):
                return np.ones(len(raw), bool)
        own = (self.spells(ids[at[k] : at[k + 1]], x) for k, x in enumerate(raw))
        return np.fromiter(own, bool, len(raw))


class ByteTokens(Encoder, Speller):
    """Ids of the byte-level tokenizer; strings of special tokens are plain text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        self.added = []
        self.part_ids = Remembered(self._part)
        alphabet = byte_alphabet()
        size = self.tokenizer.get_vocab_size()
        names = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.spell(
            [
                bytes(alphabet[c] for c in name)
                if all(c in alphabet for c in name)
                else name.encode()
                for name in names
            ]
        )

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a space and each word, joined, and how many a word has."""
        found = [
            self._plain(word) if self.plain.match(word) else self.whole(word)
            for word in map(" ".__add__, words)
        ]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return np.frombuffer(b"".join(found), "<u4").astype(np.int64), sizes

    def tokens(self, text: str) -> np.ndarray | None:
        """Ids of a space and the text; None if they spell anything else."""
        ids = np.frombuffer(self.encode(" " + text), "<u4")
        return ids if self.spells(ids, (" " + text).encode()) else None


class PieceTokens(Speller):
    """Ids of the SentencePiece model.

    Where no piece goes on past a space and the model keeps all spaces, a text without space
    marks of its own may be encoded word by word (`in_parts`).
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.spell(
            [
                bytes([int(name[3:-1], 16)])
                if self.model.is_byte(i)
                else name.replace(MARK, " ").encode()
                for i, name in enumerate(names)
            ]
        )
        shown = "".join(self.model.encode(" x  y ", out_type=str))
        keeps = shown == "  x  y ".replace(" ", MARK)
        self.in_parts = keeps and not any(MARK in name.lstrip(MARK) for name in names)

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word, which the model puts a space before, joined; how many a word has."""
        found = self.model.encode(words, num_threads=1)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), np.int64, int(sizes.sum())), sizes

    def tokens(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of each text, which the model puts a space before; None if they spell another."""
        found = [np.array(ids, "<u4") for ids in self.model.encode(texts, num_threads=1)]
        return [
            ids if self.spells(ids, (" " + text).encode()) else None
            for text, ids in zip(texts, found, strict=True)
        ]


_pairs: dict[tuple[str, str], tuple[ByteTokens, PieceTokens]] = {}


def tokenizers(a: str, b: str) -> tuple[ByteTokens, PieceTokens]:
    if (a, b) not in _pairs:
        _pairs[a, b] = ByteTokens(a), PieceTokens(b)
    return _pairs[a, b]


def gallop(short: list[int], long: list[int]) -> list[int]:
    """Place in `long` of the first end that is not below each end of `short`.

    Both ascend and end alike.
    """
    places, at, last = [], 0, len(long) - 1
    for end in short:
        if long[at] < end:
            at += 1  # the last step of one, most often all there are
            if long[at] < end:
                step = 1
                while at + step < last and long[at + step] < end:
                    at, step = at + step, step << 1
                at = bisect_left(long, end, at + 1, min(at + step, last))
        places.append(at)
    return places


class Aligned:
    """The groups and overlaps of some words, driven by one of the tokenizers.

    `ends` and `other_ends` are the ends of the words' tokens in the joined bytes, and `places`
    where the driver's ends were found.
    """

    def __init__(self, ends: np.ndarray, other_ends: np.ndarray, places: np.ndarray):
        self.n, self.n_other = len(ends), len(other_ends)
        self.cut = other_ends[places] == ends
        self.other_cut = np.zeros(self.n_other, bool)
        self.other_cut[places[self.cut]] = True
        # the first token that ends behind this one's start, up to the first that ends behind it
        first = np.zeros(self.n, np.int64)
        first[1:] = places[:-1] + self.cut[:-1]
        count = places - first + 1
        self.link = np.repeat(np.arange(self.n), count)
        started = np.cumsum(count) - count
        self.other_link = np.arange(len(self.link)) - np.repeat(started - first, count)


def _written(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> np.ndarray:
    """Ids and cuts of both lists in the order that groups are written in: a, then b.

    An entry is four times an id, plus two for an id of b, plus one for the last of its group.
    """
    group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    start_b = np.append(0, np.flatnonzero(cut_b) + 1)
    end_a = np.flatnonzero(cut_a) + 1
    out = np.empty(len(a) + len(b), np.int64)
    out[np.arange(len(a)) + start_b[group_a]] = 4 * a + cut_a
    out[np.arange(len(b)) + end_a[group_b]] = 4 * b + 2 + cut_b
    return out


class Names(dict):
    """Entry -> its id as text with the sign behind it."""

    def __missing__(self, entry: int) -> bytes:
        sign = (b",|", b",;")[entry >> 1 & 1][entry & 1 :][:1]
        self[entry] = text = b"%d%s" % (entry >> 2, sign)
        return text


_names = Names()


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.append(0, np.cumsum(sizes))


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of `values` over consecutive runs, of which some may be empty."""
    total = _offsets(values)
    at = _offsets(sizes)
    return total[at[1:]] - total[at[:-1]]


class Words:
    """Alignment of the words met: a row of sums, written groups and linked pairs for each.

    `rows` holds the row of a word, -1 if either tokenizer's ids don't spell it. A pair of ids
    is one number, the id of A times the ids of B plus the id of B. Long words and whole texts
    have rows until `settle`.
    """

    def __init__(self, a: ByteTokens, b: PieceTokens):
        self.a, self.b = a, b
        self.forget()

    def forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.sums = np.zeros((0, 4), np.int64)  # tokens of A, of B, groups, links
        self.pairs = np.zeros(0, np.int64)  # of the links of all rows, joined
        self.kept, self.long = 0, []

    def settle(self) -> None:
        """Drop the rows that aren't to be kept."""
        if len(self.groups) > self.kept:
            del self.groups[self.kept :]
            self.sums = self.sums[: self.kept].copy()
            self.pairs = self.pairs[: int(self.sums[:, 3].sum())].copy()
        for word in self.long:
            del self.rows[word]
        self.long = []

    def learn(self, words: Iterable[str]) -> None:
        """Align the words that have no row."""
        new = [word for word in words if word not in self.rows]
        if len(self.rows) + len(new) > WORDS:
            self.forget()
            new = list(words)
        self.align([word for word in new if len(word) <= LONGEST])
        self.kept = len(self.groups)
        self.long = [word for word in new if len(word) > LONGEST]
        self.align(self.long)

    def align(self, words: list[str]) -> None:
        """Rows for words that have none."""
        if not words:
            return
        raw = [(" " + word).encode() for word in words]
        ids_a, sizes_a = self.a.words(words)
        ids_b, sizes_b = self.b.words(words)
        sound = self.a.spelled(ids_a, sizes_a, raw) & self.b.spelled(ids_b, sizes_b, raw)
        rows = self.place(ids_a, ids_b, sizes_a, sizes_b, sound)
        self.rows.update(zip(words, rows.tolist(), strict=True))

    def place(
        self,
        ids_a: np.ndarray,
        ids_b: np.ndarray,
        sizes_a: np.ndarray,
        sizes_b: np.ndarray,
        sound: np.ndarray,
    ) -> np.ndarray:
        """Add the sound ones of some words, of which all ids are joined; the row of each or -1."""
        rows = np.full(len(sound), -1)
        for a_drives in (True, False):
            own = sound & ((sizes_a <= sizes_b) == a_drives)
            start = len(self.groups)
            self.add(
                ids_a[np.repeat(own, sizes_a)],
                ids_b[np.repeat(own, sizes_b)],
                sizes_a[own],
                sizes_b[own],
                a_drives,
            )
            rows[own] = np.arange(start, len(self.groups))
        return rows

    def add(
        self,
        ids_a: np.ndarray,
        ids_b: np.ndarray,
        sizes_a: np.ndarray,
        sizes_b: np.ndarray,
        a_drives: bool,
    ) -> None:
        """Rows for words of which both tokenizers' ids, joined, spell the same bytes."""
        if not len(sizes_a):
            return
        ends_a, ends_b = np.cumsum(self.a.length[ids_a]), np.cumsum(self.b.length[ids_b])
        short, long = (ends_a, ends_b) if a_drives else (ends_b, ends_a)
        links = Aligned(short, long, np.array(gallop(short.tolist(), long.tolist()), np.int64))
        if a_drives:
            cut_a, cut_b, link_a, link_b = links.cut, links.other_cut, links.link, links.other_link
        else:
            cut_a, cut_b, link_a, link_b = links.other_cut, links.cut, links.other_link, links.link
        word_of = np.repeat(np.arange(len(sizes_a)), sizes_a)
        n_links = np.bincount(word_of[link_a], minlength=len(sizes_a))
        n_groups = _sums(cut_a.astype(np.int64), sizes_a)
        sums = np.stack([sizes_a, sizes_b, n_groups, n_links], axis=1)
        self.sums = np.concatenate([self.sums, sums])
        pairs = ids_a[link_a] * len(self.b.bytes) + ids_b[link_b]
        self.pairs = np.concatenate([self.pairs, pairs])
        entries = _written(ids_a, ids_b, cut_a, cut_b).tolist()
        written = list(map(_names.__getitem__, entries))
        bounds = _offsets(sizes_a + sizes_b).tolist()
        self.groups += [b"".join(written[x:y]) for x, y in itertools.pairwise(bounds)]

    def learn_texts(self, texts: list[str]) -> np.ndarray:
        """Rows of texts that can't go word by word, aligned whole; -1 if not spelled."""
        found_b = self.b.tokens(texts)
        found_a = [
            None if ids is None else self.a.tokens(text)
            for text, ids in zip(texts, found_b, strict=True)
        ]
        none = np.zeros(0, np.int64)
        sound = np.array([ids is not None for ids in found_a])
        held_a = [ids if own else none for ids, own in zip(found_a, sound, strict=True)]
        held_b = [ids if own else none for ids, own in zip(found_b, sound, strict=True)]
        return self.place(
            np.concatenate(held_a).astype(np.int64),
            np.concatenate(held_b).astype(np.int64),
            np.array([*map(len, held_a)]),
            np.array([*map(len, held_b)]),
            sound,
        )


_words: dict[tuple[str, str], Words] = {}


def aligned_words(a: str, b: str) -> Words:
    if (a, b) not in _words:
        _words[a, b] = Words(*tokenizers(a, b))
    return _words[a, b]


def _cut(content: list[str], single_space: re.Pattern) -> list[list[str]]:
    """Words of each text, with a space put before it, less the space that each begins with."""
    cut = [text.split(" ") if text else [] for text in content]
    loose = {
        word
        for word in set().union(*cut)
        if not word or word[0].isspace() or word[-1].isspace()
    }
    for i, text in enumerate(content):
        if loose and not loose.isdisjoint(cut[i]):
            cut[i] = [word[1:] for word in single_space.split(" " + text)]
    return cut


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of consecutive runs, joined."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - _offsets(sizes)[:-1], sizes)


def align_texts(content: list[str], known: Words) -> dict[str, np.ndarray]:
    """Counts, written groups and linked pairs of each text.

    `pair_doc`, `pair` and `times` hold each distinct pair of a text once, in the order of the
    texts; `pair` is its place in `a` and `b`, and `docs` the texts that hold it.
    """
    n = len(content)
    by_word = [known.b.in_parts and MARK not in text for text in content]
    cut = _cut(
        [text if own else "" for text, own in zip(content, by_word, strict=True)],
        known.a.single_space,
    )
    known.learn(set().union(*cut))
    sizes = np.fromiter(map(len, cut), np.int64, n)
    words = itertools.chain.from_iterable(cut)
    rows = np.fromiter(map(known.rows.__getitem__, words), np.int64, int(sizes.sum()))
    doc_of = np.repeat(np.arange(n), sizes)
    # texts of words that aren't spelled may be spelled as a whole
    doubt = np.bincount(doc_of[rows < 0], minlength=n) > 0
    whole = [i for i, text in enumerate(content) if text and (doubt[i] or not by_word[i])]
    if whole:
        own = known.learn_texts([content[i] for i in whole])
        left = ~doubt[doc_of]
        doc_of = np.concatenate([doc_of[left], np.array(whole)[own >= 0]])
        rows = np.concatenate([rows[left], own[own >= 0]])
        order = np.argsort(doc_of, kind="stable")
        doc_of, rows = doc_of[order], rows[order]
        sizes = np.bincount(doc_of, minlength=n)
    out = {
        name: _sums(known.sums[rows, k], sizes)
        for k, name in enumerate(("n_a", "n_b", "n_groups", "n_links"))
    }
    at, each = _offsets(sizes).tolist(), rows.tolist()
    out["groups"] = np.full(n, None, object)
    for i in np.flatnonzero(sizes).tolist():
        own_groups = map(known.groups.__getitem__, each[at[i] : at[i + 1]])
        out["groups"][i] = b"".join(own_groups)[:-1]
    # distinct pairs of the block's words, then of each document
    used = np.flatnonzero(np.bincount(rows, minlength=len(known.groups)))
    n_links = known.sums[:, 3]
    found = known.pairs[_runs(_offsets(n_links)[:-1][used], n_links[used])]
    pairs, which = np.unique(found, return_inverse=True)
    starts = np.zeros(len(known.groups), np.int64)
    starts[used] = _offsets(n_links[used])[:-1]
    linked = which[_runs(starts[rows], n_links[rows])]
    doc = np.repeat(np.arange(n), out["n_links"])
    each_pair, times = np.unique(doc * max(1, len(pairs)) + linked, return_counts=True)
    out["pair_doc"], out["pair"] = np.divmod(each_pair, max(1, len(pairs)))
    out["times"] = times
    out["a"], out["b"] = np.divmod(pairs, len(known.b.bytes))
    out["docs"] = np.bincount(out["pair"], minlength=len(pairs))
    known.settle()
    return out


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = _offsets(sizes).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def align(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for each row of `docs`: doc_id and what its alignment holds.

    `n_a` and `n_b` tokens, `n_groups` between common ends, `n_links` pairs of tokens that
    overlap; `n_best` of these are of a pair of ids that no other pair with that id of A is
    held by more documents than, and `count_sum` adds up the documents that hold each link's
    pair; `groups_sha256` is the digest of the groups, `a1,a2|b1;a3|b2,b3`.

    Null and empty texts have no tokens, nor do texts that the tokens of either side don't spell
    (space marks in a text are read as spaces): zeros and an empty digest. Rows that repeat an
    identifier, or have none, each count as a document. Ties for the best pair are all best.
    A very long text is a block of its own. An empty table gives no rows; other columns
    are not read. `a_path` and `b_path` are paths that every executor has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = aligned_words(a_path, b_path)
        names = [part.split()[0] for part in HELD.split(", ")]
        block = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text", BLOCK):
            found = align_texts(texts(batch.column("text")), known)
            n = batch.num_rows
            per_doc = np.bincount(found["pair_doc"], minlength=n)
            none = pa.nulls(n, pa.list_(pa.int32()))
            digests = [
                "" if g is None else hashlib.sha256(g).hexdigest() for g in found["groups"]
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, block), pa.int64()),
                    batch.column("doc_id"),
                    *[pa.array(found[k]) for k in ("n_a", "n_b", "n_groups", "n_links")],
                    pa.array(digests, pa.string()),
                    _lists(found["pair"], per_doc),
                    _lists(found["times"], per_doc),
                    none,
                    none,
                    none,
                ],
                names=names,
            )
            size = np.array([len(found["a"])])
            lists = [_lists(found[k], size) for k in ("a", "b", "docs")]
            blank = [
                pa.nulls(1, kind)
                for kind in [pa.int64()] * 5 + [pa.string()] + [pa.list_(pa.int32())] * 2
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), *blank, *lists], names=names
            )
            block += 1

    rows = docs.selectExpr(f"cast(`{id_col}` as long) AS doc_id", f"`{text_col}` AS text")
    held = materialize(map_arrow(rows, run, HELD), "token-alignment")
    entries = held.where("a IS NOT NULL").selectExpr(
        "block AS part", "posexplode(arrays_zip(a, b, docs)) AS (place, entry)"
    )
    entries = entries.select("part", "place", "entry.*")
    counts = materialize(
        entries.groupBy("a", "b").agg(F.sum("docs").alias("count")), "pair-counts"
    )
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    pairs = counts.join(highest, "a").selectExpr("a", "b", "count", "count = highest AS best")
    known = entries.select("part", "place", "a", "b").join(pairs, ["a", "b"])

    def count(documents: pa.Table, looked_up: pa.Table) -> pa.Table:
        places = looked_up.column("place").to_numpy()
        held_by = np.zeros(len(places), np.int64)
        best = np.zeros(len(places), np.int64)
        held_by[places] = looked_up.column("count").to_numpy()
        best[places] = looked_up.column("best").to_numpy(zero_copy_only=False)
        lists = documents.column("pair").combine_chunks()
        sizes = np.diff(np.asarray(lists.offsets))
        pair = np.asarray(lists.flatten())
        times = np.asarray(documents.column("times").combine_chunks().flatten()).astype(np.int64)
        out = documents.drop_columns(["block", "pair", "times"])
        out = out.append_column("n_best", pa.array(_sums(times * best[pair], sizes)))
        out = out.append_column("count_sum", pa.array(_sums(times * held_by[pair], sizes)))
        return out.select([part.split()[0] for part in RESULT.split(", ")])

    documents = held.where("pair IS NOT NULL").drop("a", "b", "docs")
    ship_package(docs.sparkSession)
    return (
        documents.groupBy("block")
        .cogroup(known.select("part", "place", "count", "best").groupBy("part"))
        .applyInArrow(count, RESULT)
    )


def op11_token_alignment(spark, sf_dir):
    import public_tokenizers

    return align(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )
