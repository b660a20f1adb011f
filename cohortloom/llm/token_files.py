"""Token ids in binary files: byte-level BPE, Simple-8b words, read back block by block.

Documents are dealt to files by ranges of their identifier, so the files in name order
hold the ids in ascending document order. A file is a row of segments, each closed by an
eight-byte mark. A segment, in little-endian 64-bit words:

    magic, words after this one's six, documents, ids, blocks, words of the lengths
    document identifiers | document lengths in Simple-8b | block offsets | ids in Simple-8b

Spark writes the files, through its own committer, to any file system it knows; nothing
is opened by path. A lost task writes its file again.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortloom.llm import simple8b
from cohortloom.llm.common import map_arrow, table, texts
from cohortloom.llm.token_counts import byte_alphabet
from cohortloom.sources.storage import materialize, scratch_path

MAGIC = 0x31304E454B4F5438
HEADER = 6
MARK = "\n=seg8b\n"  # eight bytes, so words stay aligned in a file
SEGMENT = 1 << 20  # ids after which a segment is closed; a document is never cut
NO_ID = np.iinfo(np.int64).min  # stands for a null identifier
REMEMBERED = 300_000  # parts of texts in each half of what a worker remembers
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"


class _Recent(dict):
    """Part of a text -> its ids as bytes, filled as parts are met.

    When it is full, it becomes the older half of what is remembered, and parts that are met
    again come back from there.
    """

    def __init__(self, encode):
        super().__init__()
        self.encode, self.older = encode, {}

    def __missing__(self, part: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(part)
        if ids is None:
            ids = self.encode(part)
        self[part] = ids
        return ids


class Encoder:
    """The ids of the tokenizers library, parts met before taken from memory.

    Byte-level BPE splits a text by a pattern and encodes the parts one by one. Texts of
    Latin letters, digits and ASCII signs are split here and their parts go to the library's
    model. Other texts are cut at spaces between two other characters, where a part always
    begins; the pieces that have other characters go to the library whole, as does a text
    that holds one of its added tokens.
    """

    plain = re.compile(rf"[!-~\n {LETTERS}]*\Z")
    # Fixed value: the pattern of this vocabulary for the plain characters above. The letters
    # come first, as most parts are words and no other choice starts like them.
    parts = re.compile(
        rf" ?[{LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+"
    )
    single_space = re.compile(r"(?<=\S)(?= \S)")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.stand_in = {b: c for c, b in byte_alphabet().items()}
        self.part_ids = _Recent(self._part)

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def _part(self, part: str) -> bytes:
        if part.isascii():  # of these, the stand-ins of space and line feed differ
            shown = part.replace(" ", "Ġ").replace("\n", "Ċ")
        else:
            shown = part.encode().decode("latin-1").translate(self.stand_in)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.part_ids.__getitem__, self.parts.findall(text)))

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if any(token in text for token in self.added):
            return self.whole(text)
        if self.plain.match(text):
            return self._plain(text)
        pieces = self.single_space.split(text)
        return b"".join([self._plain(x) if self.plain.match(x) else self.whole(x) for x in pieces])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pack(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """One segment."""
    names = np.array([NO_ID if d is None else d for d in doc_ids], dtype="<i8")
    sizes, _ = simple8b.encode(np.array(lengths, dtype=np.uint64))
    words, offsets = simple8b.encode(ids)
    body = [names.view("<u8"), sizes, offsets, words]
    total = sum(map(len, body))
    head = [MAGIC, total, len(names), len(ids), len(offsets) - 1, len(sizes)]
    return b"".join(a.astype("<u8").tobytes() for a in [np.array(head, np.uint64), *body])


def unpack(content: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Document identifiers, lengths and ids of each segment of a file."""
    at, step = 0, HEADER * 8
    while at < len(content):
        magic, total, docs, n, blocks, sizes = np.frombuffer(content, "<u8", HEADER, at).tolist()
        if magic != MAGIC:
            raise ValueError("not a segment of token ids")
        body = np.frombuffer(content, "<u8", total, at + step)
        names, body = body[:docs].view("<i8"), body[docs:]
        lengths, body = simple8b.decode(body[:sizes]).astype(np.int64), body[sizes:]
        offsets, words = body[: blocks + 1], body[blocks + 1 :]
        if int(offsets[-1]) != len(words):
            raise ValueError("a segment's block offsets don't match its words")
        some = offsets[:: simple8b.TOGETHER // simple8b.BLOCK].tolist()
        cuts = zip(some, [*some[1:], len(words)], strict=True)
        ids = np.concatenate([simple8b.decode(words[a:b]) for a, b in cuts])
        if len(ids) != n or lengths.sum() != n:
            raise ValueError("a segment holds another number of ids than it says")
        yield names, lengths, ids
        at += step + total * 8 + len(MARK)


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode whole texts, add `end_id` to each document and write the files to `path`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        end = np.array([end_id], "<u4").tobytes()
        names, parts, lengths, held = [], [], [], 0

        def segment() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            out = pa.array([pack(names, lengths, ids)], pa.binary())
            return pa.RecordBatch.from_arrays([out], names=["segment"])

        for batch in batches:
            for name, text in zip(
                batch.column("doc_id").to_pylist(), texts(batch.column("text")), strict=True
            ):
                ids = encode(text) + end
                names.append(name)
                parts.append(ids)
                lengths.append(len(ids) // 4)
                held += len(ids) // 4
                if held >= SEGMENT:
                    yield segment()
                    names, parts, lengths, held = [], [], [], 0
        if names:
            yield segment()

    rows = docs.selectExpr(f"cast(`{id_col}` as long) AS doc_id", f"`{text_col}` AS text")
    # as many files as the input has splits, so their size stays that of a split
    files = max(1, docs.rdd.getNumPartitions())
    dealt = rows.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", "text")
    segments = map_arrow(dealt, run, "segment binary")
    # a text writer copies bytes as they are and adds the mark after each row
    segments.select(F.col("segment").cast("string").alias("value")).write.option(
        "lineSep", MARK
    ).text(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row for each document of the files: file, place in it, doc_id, local_start, ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                file, content = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                place = start = 0
                for names, lengths, ids in unpack(content):
                    bounds = np.append(0, np.cumsum(lengths))
                    plain = ids.astype("<u4")
                    n = len(names)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([file] * n, pa.string()),
                            pa.array(np.arange(place, place + n), pa.int64()),
                            pa.array(names, pa.int64(), mask=names == NO_ID),
                            pa.array(start + bounds[:-1], pa.int64()),
                            pa.array(lengths, pa.int64()),
                            pa.array(
                                [
                                    zlib.crc32(plain[a:b].tobytes())
                                    for a, b in zip(bounds[:-1], bounds[1:], strict=True)
                                ],
                                pa.int64(),
                            ),
                        ],
                        names=["file", "place", "doc_id", "local_start", "n_tokens", "ids_crc32"],
                    )
                    place, start = place + n, start + int(bounds[-1])

    files = spark.read.format("binaryFile").load(path).where("length > 0")
    return map_arrow(
        files.select("path", "content"),
        run,
        "file string, place long, doc_id long, local_start long, n_tokens long, ids_crc32 long",
    )


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, as read from the files.

    `start` counts the ids of all documents before it. A null or empty text has its end id
    only; rows that repeat an identifier stand next to each other, by text; a null
    identifier comes first; a path without documents gives no rows.
    """
    rows = materialize(read_token_files(spark, path), "token-index")
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("held"))
    # one row for each file
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("file", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    return rows.join(starts, "file").select(
        "doc_id",
        (F.col("base") + F.col("local_start")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def op6_token_files(spark, sf_dir):
    import public_tokenizers

    path = scratch_path(spark, "token-files")
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    write_token_files(table(spark, sf_dir, "documents"), path, vocabulary, end_id=2)
    return token_index(spark, path)
