"""Token alignment, phrases and quality scores against plain versions."""

import hashlib
import itertools
import random
import re
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from cohortloom.llm import phrases, quality, token_alignment
from cohortloom.llm.common import table
from cohortloom.llm.token_counts import byte_alphabet

A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, a array<int>, n_a int, block int, x int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, [1], 2, 3, 4) for i, t, lang in rows], DOCS)


# ---------------------------------------------------------------------------
# Token alignment
# ---------------------------------------------------------------------------


class Plain:
    """Tokens by the libraries alone, on whole texts."""

    def __init__(self):
        self.a = tokenizers.Tokenizer.from_file(A_PATH)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)

    def tokens(self, text):
        whole = " " + text
        alphabet = byte_alphabet()
        ids_a = self.a.encode(whole, add_special_tokens=False).ids
        spelled_a = [bytes(alphabet[c] for c in self.a.id_to_token(i)) for i in ids_a]
        ids_b = self.b.encode(text)
        spelled_b = []
        for i in ids_b:
            piece = self.b.id_to_piece(i)
            byte = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
            spelled_b.append(
                bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()
            )
        if b"".join(spelled_a) != whole.encode() or b"".join(spelled_b) != whole.encode():
            return None
        return ids_a, np.cumsum([*map(len, spelled_a)]), ids_b, np.cumsum([*map(len, spelled_b)])


def plain_alignment(rows):
    plain, docs, held_by = Plain(), [], Counter()
    for i, text, _ in rows:
        found = plain.tokens(text) if text else None
        if found is None:
            docs.append((i, None))
            continue
        ids_a, ends_a, ids_b, ends_b = found
        links = []
        for x, end_x in enumerate(ends_a):
            start_x = ends_a[x - 1] if x else 0
            for y, end_y in enumerate(ends_b):
                start_y = ends_b[y - 1] if y else 0
                if start_x < end_y and start_y < end_x:
                    links.append((ids_a[x], ids_b[y]))
        groups = []
        before = 0
        for end in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
            side = [
                ",".join(str(t) for t, e in zip(ids, ends, strict=True) if before < e <= end)
                for ids, ends in ((ids_a, ends_a), (ids_b, ends_b))
            ]
            groups.append("|".join(side))
            before = end
        docs.append((i, (len(ids_a), len(ids_b), groups, links)))
        held_by.update(set(links))
    highest = defaultdict(int)
    for (x, _), n in held_by.items():
        highest[x] = max(highest[x], n)
    out = []
    for i, found in docs:
        if found is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = found
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        best = sum(held_by[link] == highest[link[0]] for link in links)
        total = sum(held_by[link] for link in links)
        out.append((i, n_a, n_b, len(groups), len(links), best, total, digest))
    return out


ODD_TEXTS = [
    None, "", " ", "  ", "a  b ", " lead", "trail   ", "tab\tand\n\nlines\r\n", "▁marked text", "x▁y z",
    "<|endoftext|> <s>x</s><unk> <0x41>", "naïve café ñandú straße", "漢字かな交じり文 と 空白", "😀👍🏽 emoji‍🙂",
    "é combined", "\x00null\x07 bell", "don't can't we're I'LL", "1234567890 3.14 12,000",
    "http://example.org/a?b=c#d_e", "word" * 400, "x " * 300, " nbsp　wide", "a" * 3000,
]


def test_tokens_equal_the_libraries():
    plain = Plain()
    a, b = token_alignment.tokenizers(A_PATH, B_PATH)
    assert b.in_parts
    draw = random.Random(2)
    alphabet = [" ", "  ", "a", "the", "Zug", "é", "漢", "😀", "\n", "\t", "1", ".", "'s", "<s>", "▁", "\x00"]
    texts = [t for t in ODD_TEXTS if t] + [
        "".join(draw.choice(alphabet) for _ in range(draw.randint(1, 30))) for _ in range(400)
    ]
    for text, ids_b in zip(texts, b.tokens(texts), strict=True):
        got = a.tokens(text).tolist()
        assert got == plain.a.encode(" " + text, add_special_tokens=False).ids, text
        if plain.tokens(text) is None:
            assert ids_b is None
        else:
            assert ids_b.tolist() == plain.b.encode(text), text


def test_galloping_finds_every_end():
    draw = random.Random(3)
    for _ in range(300):
        last = draw.randint(1, 400)
        short = sorted({last, *(draw.randrange(1, last + 1) for _ in range(draw.randint(0, 9)))})
        long = sorted({last, *(draw.randrange(1, last + 1) for _ in range(draw.randint(0, 200)))})
        assert token_alignment.gallop(short, long) == [bisect_left(long, x) for x in short]


@pytest.mark.parametrize("size", [1, 300, 1 << 22])
def test_alignment(spark, monkeypatch, size):
    monkeypatch.setattr(token_alignment, "BLOCK", size)
    given = table(spark, "/root/testdata/sf0.001", "documents").limit(25).collect()
    rows = [(i, t, "c") for i, t in enumerate(ODD_TEXTS)]
    rows += [(100 + r.doc_id, r.text[:1500], "c") for r in given]
    rows += [(4, "a  b ", "c"), (None, "null id", "c"), (None, "null id", "c"), (4, "another text", "c")]
    got = token_alignment.align(frame(spark, rows).repartition(5), A_PATH, B_PATH)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    found = [tuple(r) for r in got.select(*names).collect()]
    assert sorted(map(str, found)) == sorted(map(str, plain_alignment(rows)))


def test_words_met_before_are_not_aligned_again(monkeypatch):
    ends, gallop = [], token_alignment.gallop

    def counted(short, long):
        ends.extend(short)
        return gallop(short, long)

    monkeypatch.setattr(token_alignment, "gallop", counted)
    known = token_alignment.Words(*token_alignment.tokenizers(A_PATH, B_PATH))
    texts = ["unbelievable storytelling, étrange " * 200 + "end"] * 3
    first = token_alignment.align_texts(texts, known)
    met = len(ends)
    again = token_alignment.align_texts(texts, known)
    assert first["n_a"].min() > 1000 and met < 30 and len(ends) == met
    assert first["groups"].tolist() == again["groups"].tolist()


def test_whole_texts_of_a_block_are_aligned_together(monkeypatch):
    known = token_alignment.Words(*token_alignment.tokenizers(A_PATH, B_PATH))
    known.b = token_alignment.PieceTokens(B_PATH)
    known.b.in_parts = False
    added, add = [], known.add
    monkeypatch.setattr(known, "add", lambda *given: (added.append(1), add(*given)))
    texts = ["one text", "", "another", "▁marked"] * 50
    found = token_alignment.align_texts(texts, known)
    assert len(added) == 2
    assert (found["n_a"] > 0).tolist() == [True, False, True, False] * 50


@pytest.mark.parametrize("words, longest", [(0, 64), (40, 3), (300_000, 64)])
def test_alignment_by_words(monkeypatch, words, longest):
    monkeypatch.setattr(token_alignment, "WORDS", words)
    monkeypatch.setattr(token_alignment, "LONGEST", longest)
    known = token_alignment.Words(*token_alignment.tokenizers(A_PATH, B_PATH))
    draw = random.Random(5)
    alphabet = [" ", " ", " ", "  ", "a", "the", "Zug", "é", "漢", "😀", "\n", "\t", "\x1c", "\xa0", "1", ".", "'s", "ﬁ", "▁", "\x00"]
    texts = ODD_TEXTS + [
        "".join(draw.choice(alphabet) for _ in range(draw.randint(1, 30))) for _ in range(400)
    ]
    blocks, held_by = [], Counter()
    for at in range(0, len(texts), 50):
        found = token_alignment.align_texts([t or "" for t in texts[at : at + 50]], known)
        pairs = list(zip(found["a"].tolist(), found["b"].tolist(), strict=True))
        held_by.update(dict(zip(pairs, found["docs"].tolist(), strict=True)))
        blocks.append((found, pairs))
        assert len(known.groups) == len(known.sums) and known.sums[:, 3].sum() == len(known.pairs)
        assert all(len(w) <= longest and r < len(known.groups) for w, r in known.rows.items())
    highest = defaultdict(int)
    for (x, _), n in held_by.items():
        highest[x] = max(highest[x], n)
    out = []
    for found, pairs in blocks:
        best, total = Counter(), Counter()
        for doc, pair, times in zip(found["pair_doc"], found["pair"], found["times"], strict=True):
            held = held_by[pairs[pair]]
            total[doc] += int(times) * held
            best[doc] += int(times) * (held == highest[pairs[pair][0]])
        for doc, groups in enumerate(found["groups"]):
            sums = [int(found[k][doc]) for k in ("n_a", "n_b", "n_groups", "n_links")]
            digest = "" if groups is None else hashlib.sha256(groups).hexdigest()
            out.append((len(out), *sums, best[doc], total[doc], digest))
    assert out == plain_alignment([(i, t, "c") for i, t in enumerate(texts)])


def test_alignment_of_nothing(spark):
    assert token_alignment.align(frame(spark, []), A_PATH, B_PATH).count() == 0
    got = token_alignment.align(frame(spark, [(1, None, "c"), (2, "", "c")]), A_PATH, B_PATH).collect()
    assert {(r.doc_id, r.n_links, r.count_sum, r.groups_sha256) for r in got} == {(1, 0, 0, ""), (2, 0, 0, "")}


# ---------------------------------------------------------------------------
# Phrases
# ---------------------------------------------------------------------------

LOWER = {ord(a): a.lower() for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain_phrases(rows, least, longest, top):
    count, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    count[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, f in count.items():
        candidates = {p for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = {
            p
            for longer in candidates
            for size in range(2, len(longer))
            for i in range(len(longer) - size + 1)
            if (p := longer[i : i + size]) in candidates and 100 * f[longer] >= 100 * f[p]
        }
        rows = []
        for p in candidates - dropped:
            score, _, l, r = min(
                (1000 * f[p] * total[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                for k in range(1, len(p))
            )
            rows.append((-score, -f[p], " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def phrase_rows():
    draw = random.Random(6)
    words = ["the", "of", "Und", "ÉTÉ", "x|y", "naïve", "a-b", " odd", "e", "\x00n"] + ["r%d" % i for i in range(60)]
    rows = []
    for i in range(260):
        text = ""
        for _ in range(draw.randint(0, 60)):
            text += words[min(int(draw.expovariate(0.12)), len(words) - 1)]
            text += draw.choice([" "] * 9 + ["  ", "\t", ". ", ", ", "\n", "!", " ; ", "\r\n"])
        rows.append((i, text, draw.choice(["en", "en", "de", None, "", "und"])))
    passage = "Of all the things in the world this one is said most often, of all the things"
    rows += [(1000 + i, f"pre{i} {passage} post{i}", "en") for i in range(30)]
    rows += [(2000, None, "en"), (2001, "", None), (2002, " \t.,", "fr"), (None, passage, "en"), (5, passage, "en")]
    rows += [(2003, "same " * 3000, "es"), (2004, "one", "it"), (2005, "A B a b A b", None)]
    return rows


@pytest.mark.parametrize("every", [1, 2, 32, 10**9])
def test_phrases(spark, monkeypatch, every):
    coded = {1: 0, 2: 12, 32: 5}.get(every, 1 << 17)  # words with codes; others are spelled
    monkeypatch.setattr(phrases.frequent_grams, "__defaults__", (every, 1 << 12, coded))
    rows = phrase_rows()
    for least, longest, top in ((4, 5, 2000), (2, 3, 7)) if every == 2 else ((4, 5, 2000),):
        got = phrases.collocations(frame(spark, rows).repartition(3), least, longest, top)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, got.collect())) == plain_phrases(rows, least, longest, top)
    assert phrases.collocations(frame(spark, [])).count() == 0
    assert phrases.collocations(frame(spark, rows[:3])).count() == 0


def test_chunks_hold_each_word_once():
    draw = np.random.default_rng(7)
    for every in (1, 3, 10):
        for n in (0, 1, 5, 200):
            stream = np.concatenate([np.zeros(4, np.int64), draw.integers(0, 6, n)])
            parts = phrases.parse(stream, draw.integers(0, 2**63, 6).astype(np.uint64), 4, every)
            bodies = [stream[a + 4 : b] for a, b in parts]
            assert np.concatenate(bodies).tolist() == stream[4:].tolist()


def test_copies_share_their_chunks():
    """A passage gives the same chunks between other words, but for its ends."""
    draw = np.random.default_rng(8)
    hashes = draw.integers(0, 2**63, 500).astype(np.uint64)
    passage = draw.integers(1, 500, 2000)
    found = []
    for n in (10, 333):
        stream = np.concatenate([np.zeros(4, np.int64), draw.integers(1, 500, n), passage])
        found.append({tuple(stream[a:b]) for a, b in phrases.parse(stream, hashes, 4, 32)})
    assert len(found[0] & found[1]) >= 40


def test_sieves_miss_nothing(spark):
    held = [("en", f"w{i} é{i}") for i in range(500)] + [("", "x"), ("de", "漢 字")]
    sieve = phrases.word_sieve(spark.createDataFrame(held, "lang string, phrase string"), 1 << 16)
    for lang, of in itertools.groupby(sorted(held), key=lambda x: x[0]):
        assert sieve.at(phrases.places_of(lang, [p.encode() for _, p in of], 1 << 16)).all()
    assert sieve.at(phrases.places_of("fr", [p.encode() for _, p in held], 1 << 16)).mean() < 0.05
    ids = np.random.default_rng(2).integers(1, 1 << 17, (400, 2))
    rows = [(phrases.to_bytes(pair), None, None) for pair in ids[:200]] + [(None, "en", "a b")]
    pairs = phrases.pair_sieve(spark.createDataFrame(rows, "gram binary, lang string, phrase string"), 1 << 16)
    found = pairs.at(phrases.places_of_keys(ids[:, 0] << phrases.CODE | ids[:, 1], 1 << 16))
    assert found[:200].all() and found[200:].mean() < 0.05
    assert pairs.at(phrases.places_of("en", [b"a b"], 1 << 16)).all()


def test_codes_of_three_bytes():
    ids = np.array([0, 1, 255, 256, 65536, (1 << 24) - 1])
    assert phrases.from_bytes([phrases.to_bytes(ids)]).tolist() == ids.tolist()


def test_large_counts_are_exact(spark):
    """Products past 64 bits."""
    score = "(cast(a AS decimal(16,0)) * 1000 * cast(t AS decimal(16,0))) div (cast(l AS decimal(16,0)) * cast(r AS decimal(16,0)))"
    rows = [(10**12 + 7, 9 * 10**13 + 1, 10**12 + 9, 2 * 10**12 + 3), (100, 10**15, 100, 100)]
    got = spark.createDataFrame(rows, "a long, t long, l long, r long").selectExpr(f"{score} AS s").collect()
    assert [r.s for r in got] == [1000 * a * t // (l * r) for a, t, l, r in rows]


# ---------------------------------------------------------------------------
# Quality
# ---------------------------------------------------------------------------


def test_quality_of_held_out_documents(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    good = quality.trusted(labels).where(~quality.held_out())
    got = quality.quality_scores(docs, good).join(labels, "doc_id").where(quality.held_out())
    rows = got.select("quality", "predicted", "score").collect()
    assert len(rows) > 500
    right = {k: [r.predicted == k for r in rows if r.quality == k] for k in (0, 1)}
    assert sum(right[1]) >= 0.99 * len(right[1])
    assert sum(right[0]) >= 0.9 * len(right[0])


def plain_fit(x, good, prior):
    """Gradient descent on the same risk, written out."""
    z = np.hstack([(x - x.mean(0)) / np.where(x.std(0) > 1e-9, x.std(0), 1), np.ones((len(x), 1))])
    weight = np.append(np.full(x.shape[1], quality.RIDGE), 1e-9)
    loss = lambda f: np.log1p(np.exp(-np.abs(f))) + np.maximum(-f, 0)

    def risk(w):
        f = z @ w
        negative = loss(-f).mean() - prior * loss(-f[good]).mean()
        return prior * loss(f[good]).mean() + max(0.0, negative) + 0.5 * (weight * w * w).sum()

    w = np.zeros(z.shape[1])
    for _ in range(40_000):
        p = 1 / (1 + np.exp(-(z @ w)))
        w -= 0.1 * (z.T @ p / len(z) - prior * z[good].mean(0) + weight * w)
    return risk(w), risk


def test_fit_reaches_the_least_risk(spark):
    draw = np.random.default_rng(5)
    n = 1500
    is_good = draw.random(n) < 0.7
    x = draw.normal(size=(n, 2)).astype(np.float32) + np.where(is_good, 0.8, -0.8)[:, None].astype(np.float32)
    marked = is_good & (draw.random(n) < 0.4)
    rows = spark.createDataFrame(
        [(r.tolist(), bool(m)) for r, m in zip(x, marked, strict=True)], "x array<float>, good boolean"
    ).repartition(3)
    model = quality.fit(rows)
    assert abs(model.prior - 0.7) < 0.12
    least, risk = plain_fit(x.astype(float), marked, model.prior)
    assert risk(model.weights) <= least + 1e-4
    assert np.mean((model.score(x) >= 0.5) == is_good) > 0.8


def test_quality_of_odd_rows(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    good = quality.trusted(table(spark, "/root/testdata/sf0.01", "labels"))
    long = "the same words and others in a line of text that goes on. " * 5000
    odd = [(-1, None, "en"), (-2, "", "en"), (-3, " \n", "en"), (-4, long, "en"), (None, "x", None), (-4, "other", "en"), (-5, "", "en")]
    rows = frame(spark, odd).select("doc_id", "text").unionByName(docs.select("doc_id", "text"))
    got = quality.quality_scores(rows, good).where("doc_id < 0 OR doc_id IS NULL").collect()
    assert len(got) == len(odd)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert len({r.score for r in got if r.doc_id in (-1, -2, -5)}) == 1
    assert len({r.score for r in got if r.doc_id == -4}) == 2
    none = quality.quality_scores(rows, good.limit(0)).select("score", "predicted").distinct().collect()
    assert [tuple(r) for r in none] == [(0.5, 1)]
    assert quality.quality_scores(rows.limit(0), good).count() == 0


def test_trusted_are_those_all_labels_call_good(spark):
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (3, 1), (3, 0), (4, None), (None, 1), (5, 1), (5, 1)], "doc_id long, quality int"
    ).withColumn("least", F.lit(0))
    assert sorted(r.doc_id for r in quality.trusted(labels).collect()) == [1, 5]
