"""Exact dedup, secret scan, token files and token counts against plain versions."""

import hashlib
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortloom.llm import exact_dedup, secrets, simple8b, token_counts, token_files
from cohortloom.sources.storage import scratch_path

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, kept string, n int"
ODD = [
    (1, "same"),
    (2, None),
    (3, ""),
    (4, "same"),
    (4, "same"),
    (None, "same"),
    (None, "only without id"),
    (5, "pässword: hunter22 tab\there  two spaces \n line  end "),
    (6, "word " * 30_000),
    (7, "日本語 の 文 ½ x²  nbsp <|endoftext|> tail"),
    (8, " leading and don't they'll x.y!? 12,5\n\n\nDone"),
    (9, "deadbeef" * 4 + " PASSWORD='abcdef' token=short"),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], DOCS)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("parts", [1, 5])
def test_exact_duplicates(spark, keep, parts):
    docs = frame(spark, ODD).repartition(parts)
    got = exact_dedup.exact_duplicates(docs, keep=keep, fan_in=2).collect()
    assert len(got) == len(ODD)
    groups = {}
    for i, t in ODD:
        groups.setdefault(hashlib.sha256((t or "").encode()).hexdigest(), []).append(i)
    for row in got:
        ids = groups[row.text_sha256]
        real = [i for i in ids if i is not None]
        best = (max if keep == "largest" else min)(real) if real else None
        assert (row.keep_id, row.group_size) == (best, len(ids))
    assert sum(r.kept for r in got) == len(groups)
    left = exact_dedup.keep_one(docs, exact_dedup.exact_duplicates(docs, keep=keep)).collect()
    assert len(left) == len(groups) == len({r.text or "" for r in left})


def test_exact_duplicates_empty(spark):
    assert exact_dedup.exact_duplicates(frame(spark, [])).count() == 0


def plain_spans(text):
    spans = []
    for rank, (pattern, least, group) in enumerate(
        ((secrets.ASSIGN, 6, 1), (secrets.ACCESS, 20, 0), (secrets.HEX, 24, 0))
    ):
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                spans.append((m.start(), rank, m.end()))
    return [(s, e, secrets.KINDS[r]) for s, r, e in sorted(spans)]


pieces = st.sampled_from(
    ["password", "PassWD", "secret", "token", "api_key", "APIKEY", "AKIA", "İ", "ſecret", ":", "=",
     " ", "'", '"', "abcdef012345", "ABCDEF0123456789", "deadbeef", "zz", "\n", "é", "card ", "."]
)


@settings(max_examples=400, deadline=None)
@given(st.lists(pieces, max_size=14))
def test_base_spans_equal_plain_search(parts):
    text = "".join(parts)
    found = [s for s in secrets.find(text, WORDS) if s[2] in secrets.BASE]
    assert found == plain_spans(text)


WORDS = secrets.automaton()


def test_checksums():
    body = "abcdefghijklmnopqrstuvwxyz0123"
    value, check = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, rest = divmod(value, 62)
        check = secrets.BASE62[rest] + check
    good = f"ghp_{body}{check}"
    kinds = lambda t: [k for _, _, k in secrets.find(t, WORDS)]
    assert kinds(f"x {good} y") == ["github"]
    assert kinds(f"x ghp_{body}{check[::-1]}z y") == []
    assert kinds("card no. 4111 1111 1111 1111 ok") == ["card"]
    assert kinds("card no. 4111 1111 1111 1112 ok") == []
    assert kinds("IBAN: DE89 3704 0044 0532 0130 00.") == ["iban"]
    assert kinds("IBAN: DE88 3704 0044 0532 0130 00.") == []


def test_secret_query_on_odd_rows(spark):
    got = secrets.secret_spans(frame(spark, ODD)).collect()
    want = sorted((str(i), [tuple(s) for s in plain_spans(t or "")]) for i, t in ODD)
    assert sorted((str(r.doc_id), [tuple(s) for s in r.spans]) for r in got) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 3) | st.just(0) | st.integers(0, 50_000)))
def test_simple8b_round_trip(ids):
    ids = np.array(ids, dtype=np.uint64)
    words, offsets = simple8b.encode(ids, block=7)
    assert (simple8b.decode(words) == ids).all()
    for b in range(len(offsets) - 1):
        part = simple8b.decode(words[offsets[b] : offsets[b + 1]])
        assert (part == ids[7 * b : 7 * b + 7]).all()


def test_simple8b_packs_many_small_ids():
    words, _ = simple8b.encode(np.zeros(240, np.uint64))
    assert len(words) == 2


def test_simple8b_fills_words_one_after_the_other():
    rng = np.random.default_rng(5)
    for block in (1, 59, 121, 4096):
        sizes = rng.integers(0, 64, 90).repeat(rng.integers(1, 130, 90))
        ids = rng.integers(0, 2**63, len(sizes), dtype=np.uint64) >> sizes.astype(np.uint64)
        want, offsets, at = [], [], 0
        while at < len(ids):
            if at % block == 0:
                offsets.append(len(want))
            left = min(block - at % block, len(ids) - at)
            for s, (count, bits) in simple8b.SELECTORS.items():
                part = ids[at : at + count].tolist()
                if count <= left and max(part) < 1 << bits:
                    want.append(s << 60 | sum(x << k * bits for k, x in enumerate(part)))
                    at += count
                    break
            else:
                want += [0, int(ids[at])]
                at += 1
        words, starts = simple8b.encode(ids, block)
        assert words.tolist() == want and starts.tolist() == [*offsets, len(want)]


def test_segments_of_many_blocks():
    for n in (simple8b.TOGETHER, 2 * simple8b.TOGETHER + 5):
        ids = np.random.default_rng(n).integers(0, 50_000, n).astype(np.uint32)
        ((names, lengths, got),) = token_files.unpack(token_files.pack([3, None], [4, n - 4], ids))
        assert names.tolist() == [3, token_files.NO_ID] and lengths.tolist() == [4, n - 4]
        assert (got == ids).all()


def test_simple8b_packs_about_as_fast_as_it_unpacks():
    ids = (2.0 ** np.random.default_rng(1).uniform(3, 16, 1 << 19)).astype(np.uint32)
    words, _ = simple8b.encode(ids)

    def seconds(step, given):
        begun = time.thread_time()
        step(given)
        return time.thread_time() - begun

    packing = min(seconds(simple8b.encode, ids) for _ in range(5))
    assert packing < 6 * min(seconds(simple8b.decode, words) for _ in range(5))


characters = st.sampled_from(list(" \n\t'stvreldmaZé9½²日!.,-_ ́\x1c"))


@settings(max_examples=300, deadline=None)
@given(st.text(characters, max_size=40))
def test_encoder_equals_library(text):
    own = token_files.encoder(VOCABULARY)
    assert own.encode(text) == own.whole(text)


def test_token_files(spark):
    path = scratch_path(spark, "test-tokens")
    token_files.write_token_files(frame(spark, ODD).repartition(3), path, VOCABULARY, 2)
    got = token_files.token_index(spark, path).orderBy("start").collect()
    rows = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, own = 0, token_files.encoder(VOCABULARY)
    assert len(got) == len(rows)
    for row, (i, text) in zip(got, rows, strict=True):
        ids = own.whole(text or "") + (2).to_bytes(4, "little")
        assert tuple(row) == (i, start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4


def test_token_files_of_nothing(spark):
    path = scratch_path(spark, "test-tokens")
    token_files.write_token_files(frame(spark, []), path, VOCABULARY, 2)
    assert token_files.token_index(spark, path).count() == 0


def greedy(word, vocabulary):
    n, at = 0, 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in vocabulary), None)
        if end is None:
            return 1
        n, at = n + 1, end
    return n


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text("abc", min_size=1, max_size=5)), st.text("abcd", max_size=15))
def test_longest_match_small_vocabulary(vocabulary, word):
    vocabulary = {v.encode() for v in vocabulary}
    own = token_counts.LongestMatch(sorted(vocabulary))
    assert own.count(word.encode()) == greedy(word.encode(), vocabulary)


def test_token_counts(spark):
    vocabulary = set(token_counts.read_pieces(VOCABULARY))
    got = token_counts.token_counts(frame(spark, ODD), VOCABULARY).collect()
    want = [
        (i, len(w := (t or "").encode().split()), sum(greedy(b" " + x, vocabulary) for x in w))
        for i, t in ODD
    ]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_card_numbers_before_other_digits():
    words = secrets.automaton()
    spans = lambda text: [text[a:b] for a, b, kind in secrets.find(text, words) if kind == "card"]
    assert spans("card: 4111 1111 1111 1111 12/25") == ["4111 1111 1111 1111"]
    assert spans("card 4111111111111111 123") == ["4111111111111111"]
    assert spans("visa 4111-1111-1111-1111-12345") == ["4111-1111-1111-1111"]
    assert spans("card 4111 1111 1111 1112 12") == []
