"""Sampled segmentations against enumeration."""

import collections
import math
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from cohortloom.llm import lattice
from cohortloom.llm import sentencepiece_sampling as sampling
from cohortloom.llm.common import slices

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    (1, None), (2, ""), (3, " "), (4, "hello world"), (4, "hello world"), (5, "  two  spaces "),
    (6, "line\nbreak\ttab ▁ mark▁inside"), (7, "漢字 𐍈 \x00 é😀"), (8, "word " * 20_000),
    (9, "y" * 5_000), (None, "no id"), (10, "a"),
]


def segmentations(text):
    """All segmentations of a small text in the small vocabulary, with log probabilities."""
    scores = {"▁": -2.0, "a": -2.5, "b": -2.2, "ab": -1.0, "▁a": -1.5, "ba": -1.7, "▁ab": -2.0}

    def walk(rest):
        if not rest:
            yield (), 0.0
        for n in range(1, len(rest) + 1):
            piece = rest[:n]
            if piece in scores or n == 1:
                score = scores.get(piece, -4.0 * len(piece.encode()))
                for tail, value in walk(rest[n:]):
                    yield (piece, *tail), score + value

    found = dict(walk("▁" + text.replace(" ", "▁")))
    norm = math.log(sum(map(math.exp, found.values())))
    return {k: v - norm for k, v in found.items()}, scores


class Small:
    """The vocabulary above as the sampler wants it."""

    def __init__(self, scores):
        self.text = list(scores)
        self.byte_id = list(range(100, 356))
        score = np.zeros(400)
        score[: len(scores)] = list(scores.values())
        self.pieces = lattice.Pieces(self.text, score, list(range(len(scores))), self.byte_id, -4.0)


def drawn(text, k, n, first=0):
    _, scores = segmentations("a")
    own = Small(scores)
    rows = sampling.sampled(own, [text] * n, np.arange(first, first + n, dtype=np.uint64), k)
    name = lambda ids: tuple(own.text[i] if i < 100 else chr(i - 100) for i in ids.tolist())
    return [[(name(ids), p, q) for ids, p, q in row] for row in rows]


@pytest.mark.parametrize("text", ["ab ba", "aabb", "abxab"])
def test_first_sample_has_the_right_distribution(text):
    want, _ = segmentations(text)
    n = 20_000
    counts = collections.Counter(row[0][0] for row in drawn(text, 1, n))
    assert set(counts) <= set(want)
    for name, log_p in want.items():
        p = math.exp(log_p)
        assert abs(counts[name] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-9


@pytest.mark.parametrize("k", [2, 4])
def test_samples_without_replacement(k):
    text, n = "ab ba", 20_000
    want, _ = segmentations(text)
    rows = drawn(text, k, n)
    pairs = collections.Counter()
    total = 0.0
    for row in rows:
        names = [name for name, _, _ in row]
        assert len(set(names)) == k
        for name, log_p, log_q in row:
            assert log_p == pytest.approx(want[name], abs=1e-9) and log_q <= 1e-9
            total += math.exp(log_p - log_q)
        pairs[tuple(names[:2])] += 1
    # sampling without replacement: the second follows its share of what the first left
    for (a, b), count in pairs.most_common(12):
        p = math.exp(want[a]) * math.exp(want[b]) / (1 - math.exp(want[a]))
        assert abs(count / n - p) < 5 * math.sqrt(p / n)
    # each sample weighted by its inclusion probability estimates the whole
    assert total / n == pytest.approx(1.0, abs=0.03)


def test_all_segmentations_when_few():
    want, _ = segmentations("ab")
    row = drawn("ab", 50, 1)[0]
    assert {name for name, _, _ in row} == set(want) and len(row) == len(want)
    assert all(q == 0.0 for _, _, q in row)
    assert drawn("", 3, 1) == [[((), 0.0, 0.0)]]


def test_batches_do_not_matter():
    own = sampling.vocabulary(MODEL)
    content = ["some words here", "other words there", "x"]
    seeds = np.array([5, 6, 7], np.uint64)
    together = sampling.sampled(own, content, seeds, 3)
    for i in range(3):
        alone = sampling.sampled(own, content[i : i + 1], seeds[i : i + 1], 3)[0]
        assert [s[0].tolist() for s in alone] == [s[0].tolist() for s in together[i]]


def test_sample_segmentations_of_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in ODD], "doc_id long, text string, samples string")
    got = sampling.sample_segmentations(docs.repartition(3), MODEL, k=3).collect()
    assert len(got) == len(ODD) and all(r.round_trip for r in got)
    by_id = collections.defaultdict(list)
    for r in got:
        by_id[r.doc_id].append([(tuple(s.ids), s.log_prob, s.log_inclusion) for s in r.samples])
    assert by_id[1] == by_id[2] == [[((), 0.0, 0.0)]]
    assert by_id[4][0] == by_id[4][1] and len(by_id[4][0]) == 3
    for samples in by_id.values():
        for row in samples:
            assert len({s[0] for s in row}) == len(row)
    decoded = sampling.decode(
        spark.createDataFrame([(i, list(s[0])) for i, rows in by_id.items() for s in rows[0]], "doc_id long, ids array<int>"),
        MODEL,
    ).collect()
    texts = {i: (t or "").replace("▁", " ") for i, t in ODD}
    assert decoded and all(r.text == texts[r.doc_id] for r in decoded)
    assert sampling.sample_segmentations(docs.limit(0), MODEL).count() == 0


def test_decoding_equals_the_library():
    from sentencepiece import SentencePieceProcessor

    library, own = SentencePieceProcessor(model_file=MODEL), sampling.vocabulary(MODEL)
    for _, text in ODD:
        ids = library.encode(text or "")
        assert own.decode(ids) == library.decode(ids)


def test_lattices_are_kept_between_batches(monkeypatch):
    own = sampling.vocabulary(MODEL)
    batches = [["some words here", " two  spaces "], ["here are some words", "", "▁ two"], ["new ones"]]
    seeds = np.array([5, 6, 7], np.uint64)
    plain = lambda rows: [[(ids.tolist(), p, q) for ids, p, q in row] for row in rows]
    for held, made in ((1_000, [6, 2, 2]), (20, [6, 5, 2])):
        monkeypatch.setattr(sampling, "HELD", held)
        known = sampling.Known(own.pieces)
        built = []
        make = lattice.Lattices
        with monkeypatch.context() as patch:
            patch.setattr(lattice, "Lattices", lambda p, w: built.append(len(w)) or make(p, w))
            rows = [sampling.sampled(own, b, seeds[: len(b)], 3, known) for b in batches]
        assert built == made
        for batch, got in zip(batches, rows, strict=True):
            assert plain(got) == plain(sampling.sampled(own, batch, seeds[: len(batch)], 3))
            assert sampling.round_trips(own, got, batch) == [True] * len(batch)


def test_lattices_take_a_bounded_memory():
    own = sampling.vocabulary(MODEL)
    letters = np.random.default_rng(3).integers(97, 123, (40, 20_000, 7)).astype(np.uint8)
    content = [b" ".join(map(bytes, rows)).decode() for rows in letters]
    batch = pa.RecordBatch.from_arrays([pa.array(content)], names=["text"])
    known = sampling.Known(own.pieces)
    tracemalloc.start()
    try:
        for part in slices(iter([batch]), "text", sampling.BATCH):  # of words that are all new
            text = part.column("text").to_pylist()
            sampling.sampled(own, text, np.arange(len(text), dtype=np.uint64), 2, known)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 280 << 20


def test_words_by_arrow_are_the_words():
    content = [t or "" for _, t in ODD]
    sizes, numbers, distinct = sampling.numbered(content)
    ends, words = np.cumsum(sizes), [distinct[i].as_py() for i in numbers.tolist()]
    got = [words[b - n : b] for n, b in zip(sizes, ends, strict=True)]
    assert got == [sampling.words_of(t) for t in content]
    assert len(set(distinct.to_pylist())) == len(distinct)


def test_a_wrong_sample_is_no_round_trip():
    own = sampling.vocabulary(MODEL)
    rows = sampling.sampled(own, ["some words", "other"], np.array([1, 2], np.uint64), 2)
    assert sampling.round_trips(own, rows, ["some words", "others"]) == [True, False]
