"""SentencePiece encoding by sampled segmentations, and decoding.

The vocabulary is read from a SentencePiece model. Texts are written as that model does: a
space mark first, and in place of every space. Characters without a piece are spelled in
byte pieces. A model of ranked merges has no probabilities: its pieces are scored by Zipf's
law, minus the logarithm of their rank, and the scores of a unigram model are taken as they
are. See `lattice` for the search.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm import lattice
from cohortloom.llm.common import map_arrow, slices, table, texts, whole_text
from cohortloom.llm.lattice import SPACE

BATCH = 1 << 19  # bytes of text whose lattices are built together
HELD = 1_750_000  # characters of words whose lattices are kept, of some 75 bytes each
SEED = 42
_vocabularies: dict[tuple, Vocabulary] = {}


class Known:
    """Lattices of words, kept from batch to batch while they are not too many."""

    def __init__(self, pieces: lattice.Pieces):
        self.pieces = pieces
        self.words, self.characters = pa.array([], pa.string()), 0
        self.lattices = lattice.Lattices(pieces, self.words)

    def _start(self, words: pa.Array) -> None:
        self.words, self.characters = words, pc.sum(pc.utf8_length(words)).as_py() or 0
        self.lattices.clear()
        self.lattices.extend(lattice.Lattices(self.pieces, words))

    def numbers(self, words: pa.Array) -> np.ndarray:
        """The numbers of distinct words in the lattices, which are made where they are not held."""
        at = pc.index_in(words, value_set=self.words)
        new = words.filter(pc.is_null(at))
        characters = pc.sum(pc.utf8_length(new)).as_py() or 0
        if self.characters + characters > HELD:
            self._start(words)
            return np.arange(len(words))
        self.lattices.extend(lattice.Lattices(self.pieces, new))
        number = np.asarray(at.fill_null(-1)).astype(np.int64)
        number[number < 0] = len(self.words) + np.arange(len(new))
        self.words = pa.concat_arrays([self.words, new])
        self.characters += characters
        return number


class Vocabulary:
    def __init__(self, path: str, scores: str, theta: float):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.text = [model.id_to_piece(i) for i in range(n)]
        special = [
            model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i)
            for i in range(n)
        ]
        normal = [i for i in range(n) if not special[i]]
        if any(SPACE in self.text[i].lstrip(SPACE) for i in normal):
            raise ValueError("a piece has a space mark after another character")
        self.byte_id = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(model.is_byte(i) for i in self.byte_id):
            raise ValueError("the model has no byte pieces")
        score = np.zeros(n)
        if scores == "zipf":
            score[normal] = -theta * np.log(np.arange(len(normal)) + 1.0)
            worst = -theta * np.log(len(normal) + 1.0)
        elif scores == "model":
            score[normal] = [theta * model.get_score(i) for i in normal]
            worst = score[normal].min() - 10.0
        else:
            raise ValueError("scores must be zipf or model")
        self.pieces = lattice.Pieces(self.text, score, normal, self.byte_id, worst)
        self.known = Known(self.pieces)
        self.byte_of = {i: b for b, i in enumerate(self.byte_id)}
        # what each piece stands for in decoding, bytes for byte pieces, nothing for controls
        self.content = [
            bytes([self.byte_of[i]]) if i in self.byte_of
            else b"" if special[i] else t.replace(SPACE, " ").encode("utf-8", "surrogatepass")
            for i, t in enumerate(self.text)
        ]
        self.width = np.fromiter(map(len, self.content), np.int32, n)
        self.begin = np.cumsum(self.width, dtype=np.int32) - self.width
        self.bytes = np.frombuffer(b"".join(self.content), np.uint8)

    def decode(self, ids: list[int]) -> str:
        """Text of ids: the first space is the one that encoding adds."""
        raw = b"".join(map(self.content.__getitem__, ids))
        return raw.decode("utf-8", "replace").removeprefix(" ")

    def decoded(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The bytes of many rows of ids, before their first space is removed."""
        width = self.width[ids]
        ends = np.append(0, np.cumsum(width, dtype=np.int64))
        place = np.repeat(self.begin[ids] - ends[:-1], width)
        place += np.arange(len(place))
        raw, cuts = self.bytes[place].tobytes(), ends[bounds].tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def vocabulary(path: str, scores: str = "zipf", theta: float = 1.0) -> Vocabulary:
    key = (path, scores, theta)
    if key not in _vocabularies:
        _vocabularies[key] = Vocabulary(path, scores, theta)
    return _vocabularies[key]


RUN = re.compile(f"{SPACE}*[^{SPACE}]*")


def words_of(text: str) -> list[str]:
    """A text's words without their first space mark; more marks before a word stay with it."""
    if not text:
        return []
    plain = text.replace(" ", SPACE)
    words = plain.split(SPACE)
    if "" in words:
        return [run[1:] for run in RUN.findall(SPACE + plain) if run]
    return words


def numbered(batch: list[str]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """How many words each text has, the words' numbers in text order, and the distinct words."""
    plain = pc.replace_substring(pa.array(batch, pa.string()), SPACE, " ")
    split = pc.split_pattern(plain, " ")
    sizes = np.diff(np.asarray(split.offsets)).astype(np.int64)
    words = split.flatten()
    empty = np.asarray(pc.binary_length(words)) == 0
    text = np.repeat(np.arange(len(batch)), sizes)
    odd = np.unique(text[empty])  # texts where marks stay with words
    if len(odd):
        own = [words_of(batch[t]) for t in odd.tolist()]
        kept = ~np.isin(text, odd)
        sizes[odd] = list(map(len, own))
        words = pa.concat_arrays(
            [words.filter(pa.array(kept)), pa.array([w for ws in own for w in ws], pa.string())]
        )
        text = np.concatenate([text[kept], np.repeat(odd, sizes[odd])])
    found = words.dictionary_encode()
    numbers = np.asarray(found.indices)
    if len(odd):
        numbers = numbers[np.argsort(text, kind="stable")]
    return sizes, numbers, found.dictionary


def sampled(
    own: Vocabulary, batch: list[str], seeds: np.ndarray, k: int, known: Known | None = None
) -> list[list[tuple[np.ndarray, float, float]]]:
    """For each text up to k of (ids, log probability, log inclusion probability)."""
    sizes, words, distinct = numbered(batch)
    known = known or Known(own.pieces)
    words = known.numbers(distinct)[words]
    lattices = known.lattices
    paths, threshold = lattice.sample(lattices, sizes, words, seeds, k)
    out: list[list] = [[] for _ in batch]
    for path in paths:
        ids = lattices.ids[path.edge[lattice.edges_in_text_order(path)]]
        bounds = path.bounds
        spelled = np.flatnonzero(ids < 0)
        if len(spelled):
            ids, bounds = _spell(own, ids, bounds)
        score = lattice.log_inclusion(path.total, threshold)
        for t in np.flatnonzero(np.isfinite(path.top)).tolist():
            part = ids[bounds[t] : bounds[t + 1]]
            out[t].append((part, float(path.total[t]), float(score[t])))
    return out


def _spell(own: Vocabulary, ids: np.ndarray, bounds: np.ndarray):
    """Put the byte pieces of characters without a piece in their place."""
    byte_id = np.array(own.byte_id)
    ids = ids.copy()
    ascii_ = np.flatnonzero((ids < 0) & (ids >= -128))
    ids[ascii_] = byte_id[-1 - ids[ascii_]]
    spelled = np.flatnonzero(ids < 0)
    if not len(spelled):
        return ids, bounds
    parts = [chr(-1 - c).encode("utf-8", "surrogatepass") for c in ids[spelled].tolist()]
    width = np.ones(len(ids), np.int64)
    width[spelled] = [len(p) for p in parts]
    place = np.append(0, np.cumsum(width))
    out = np.repeat(ids, width)
    for at, part in zip(place[spelled].tolist(), parts, strict=True):
        out[at : at + len(part)] = byte_id[list(part)]
    return out, place[bounds]


def round_trips(own: Vocabulary, rows: list[list], content: list[str]) -> list[bool]:
    """Whether every sample of a text decodes to it. Equal bytes make equal texts; where they
    differ the decoded texts are compared."""
    samples = [s[0] for row in rows for s in row]
    bounds = np.append(0, np.cumsum([len(ids) for ids in samples], dtype=np.int64))
    raw = iter(own.decoded(np.concatenate([np.zeros(0, np.int64), *samples]), bounds))
    out = []
    for row, text in zip(rows, content, strict=True):
        want = text.replace(SPACE, " ")
        written = (" " + want if want else "").encode("utf-8", "surrogatepass")
        found = [next(raw) for _ in row]
        out.append(
            all(
                b == written or own.decode(s[0].tolist()) == want
                for b, s in zip(found, row, strict=True)
            )
        )
    return out


SAMPLES = "samples array<struct<ids:array<int>,log_prob:double,log_inclusion:double>>"


def sample_segmentations(
    docs: DataFrame,
    model: str,
    k: int = 2,
    seed: int = SEED,
    scores: str = "zipf",
    theta: float = 1.0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for each row of `docs`: doc_id, samples, round_trip.

    `samples` holds up to `k` distinct segmentations of the whole text, drawn without
    replacement, the largest perturbed value first: ids, log probability, and the log of the
    inclusion probability. A text with fewer segmentations gives them all, with inclusion
    probability one; a null or empty text has the one empty segmentation. Draws are seeded by
    the identifier, so repeated rows and reruns give the same; rows without identifier use
    the text's hash. `round_trip` says whether every sample decodes to the text (with space
    marks in the text read as spaces, as the model does). `model` is a path that every executor
    has. An empty table gives no rows; other columns are not read; there is no shuffle.
    """
    if k < 1:
        raise ValueError("k must be 1 at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(model, scores, theta)
        kind = pa.list_(
            pa.struct(
                [
                    ("ids", pa.list_(pa.int32())),
                    ("log_prob", pa.float64()),
                    ("log_inclusion", pa.float64()),
                ]
            )
        )
        for batch in slices(batches, "text", BATCH):
            content = texts(batch.column("text"))
            names = batch.column("doc_id").to_pylist()
            seeds = np.array(
                [
                    xxhash.xxh64_intdigest(
                        t.encode("utf-8", "surrogatepass") if i is None else str(i).encode(), seed
                    )
                    for i, t in zip(names, content, strict=True)
                ],
                np.uint64,
            )
            rows = sampled(own, content, seeds, k, own.known)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), _array(rows, kind), pa.array(round_trips(own, rows, content))],
                names=["doc_id", "samples", "round_trip"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return map_arrow(rows, run, f"doc_id long, {SAMPLES}, round_trip boolean")


def _array(rows: list[list], kind: pa.DataType) -> pa.Array:
    """Arrow lists of the samples, without a Python object for each id."""
    flat = [s for samples in rows for s in samples]
    ids = np.concatenate([np.zeros(0, np.int64), *[s[0] for s in flat]]).astype(np.int32)
    inner = np.append(0, np.cumsum([len(s[0]) for s in flat], dtype=np.int64)).astype(np.int32)
    outer = np.append(0, np.cumsum([len(x) for x in rows], dtype=np.int64)).astype(np.int32)
    values = pa.StructArray.from_arrays(
        [
            pa.ListArray.from_arrays(pa.array(inner), pa.array(ids)),
            pa.array([s[1] for s in flat], pa.float64()),
            pa.array([s[2] for s in flat], pa.float64()),
        ],
        fields=list(kind.value_type),
    )
    return pa.ListArray.from_arrays(pa.array(outer), values)


def decode(
    encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """doc_id and text of each row of ids; null or empty ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(model)
        for batch in batches:
            lines = [own.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lines, pa.string())], names=["doc_id", "text"]
            )

    rows = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
    return map_arrow(rows, run, "doc_id long, text string")


def op7_sentencepiece(spark, sf_dir):
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    return sample_segmentations(table(spark, sf_dir, "documents"), model)
