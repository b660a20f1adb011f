"""SimHash dedup, decontamination and language identification against plain versions."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cohortloom.llm import components, decontaminate, language_id, simhash_dedup
from cohortloom.llm.common import table

DOCS = "doc_id long, text string, label string, component_id int, fp int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in rows], DOCS)


def plain_print(text, size):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    parts = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
    parts = parts or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(
        1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)
    )


def plain_components(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("seed", range(3))
def test_links_reach_all_within_two(spark, seed):
    draw = random.Random(seed)
    prints = {0, 2**64 - 1}
    for _ in range(30):
        base = draw.getrandbits(64)
        for _ in range(12):
            prints.add(base)
            base ^= sum(1 << b for b in draw.sample(range(64), draw.choice([1, 2, 3])))
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    near = [
        (a, b)
        for a, b in itertools.combinations(prints, 2)
        if bin((a ^ b) & (2**64 - 1)).count("1") <= 2
    ]
    rows = spark.createDataFrame([(p, p) for p in prints], "node long, fp long")
    links = [tuple(r) for r in simhash_dedup.links_within_two(rows).collect()]
    assert {tuple(sorted(x)) for x in links} <= set(near)
    assert plain_components(prints, links) == plain_components(prints, near)


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, 1001), (7, 7), (1001, 1000)]
    random.Random(1).shuffle(chain)
    links = spark.createDataFrame(chain, "a long, b long")
    got = dict(tuple(r) for r in components.components(links).collect())
    assert got == {**{i: 0 for i in range(1, 301)}, 1001: 1000}
    assert components.components(links.limit(0)).count() == 0


def near_rows():
    draw = random.Random(5)
    words = ["w%d" % i for i in range(500)]
    rows = []
    for group in range(6):
        base = [draw.choice(words) for _ in range(900)]
        for _ in range(5):
            copy = list(base)
            copy[draw.randrange(900)] = "edited%d" % draw.randrange(9)
            rows.append((len(rows) * 3 + 1, " ".join(copy)))
    rows += [(500, None), (501, ""), (502, " \n\t"), (503, "one"), (504, "ONE"), (505, "two words")]
    rows += [(600, "x " * 40_000), (601, "x " * 40_001), (None, "x " * 40_000), (None, "alone ü")]
    rows += [(rows[0][0], rows[0][1]), (700, "hello world É"), (701, "hello world é")]
    return rows


def test_near_duplicates(spark):
    rows = near_rows()
    got = simhash_dedup.near_duplicates(frame(spark, rows)).collect()
    prints = [plain_print(t, 3) for _, t in rows]
    groups = plain_components(
        set(prints),
        [
            (a, b)
            for a, b in itertools.combinations(set(prints), 2)
            if bin(a ^ b).count("1") <= 2
        ],
    )
    least = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            least[groups[p]] = min(i, least.get(groups[p], i))
    want = [
        (i, f"{p:016x}", least.get(groups[p])) for (i, _), p in zip(rows, prints, strict=True)
    ]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert simhash_dedup.near_duplicates(frame(spark, [])).count() == 0


def test_keep_one_of_near_copies(spark):
    """Every row is judged by its own text, also where identifiers repeat or are missing."""
    draw = random.Random(8)
    fresh = lambda: " ".join("w%d" % draw.randrange(900) for _ in range(400))
    base, other, third = fresh(), fresh(), fresh()
    rows = [(2, base + " z"), (1, base), (2, other), (2, other), (None, third), (7, third + " y")]
    rows += [(9, None), (8, ""), (10, "  "), (None, fresh()), (None, fresh())]
    schema = "doc_id long, text string, row long, judged string, Row_ map<string,int>, fp int"
    docs = spark.createDataFrame([(i, t, n, "j", {"k": n}, 3) for n, (i, t) in enumerate(rows)], schema)
    for parts in (1, 5):
        got = simhash_dedup.keep_one(docs.repartition(parts, "row") if parts > 1 else docs, words=3)
        assert got.columns == docs.columns
        kept = {r.row for r in got.collect()}
        assert kept - {2, 3} == {1, 5, 7, 9, 10} and len(kept & {2, 3}) == 1
    assert simhash_dedup.keep_one(docs.limit(0)).count() == 0


def plain_matches(text, items):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    best = {}
    for item, other in items:
        own = re.findall(r"[^\W_]+", (other or "").lower())
        size = min(5, len(own))
        if not own or len(words) < size:
            continue
        cut = lambda w: [tuple(w[i : i + size]) for i in range(len(w) - size + 1)]
        want, have = cut(own), cut(words)
        span = min(len(want), len(have))
        for s in range(len(have) - span + 1):
            window = Counter(have[s : s + span])
            common = sum((window & Counter(want)).values())
            value = common / (span + len(want) - common)
            if value >= 0.8 and value > best.get(item, (0,))[0]:
                best[item] = (value, s)
    return {(i, s, v) for i, (v, s) in best.items()}


def test_benchmark_matches(spark):
    draw = random.Random(3)
    words = ["Wort%d" % i for i in range(60)] + ["été", "x2", "naïve"]
    items = [(i, " ".join(draw.choice(words) for _ in range(draw.randint(8, 40)))) for i in range(12)]
    items += [(50, "Drei kleine Wörter"), (51, ""), (52, None), (53, "..."), (None, "null item is one of five words")]
    docs = []
    for i in range(60):
        filler = [draw.choice(words) for _ in range(draw.randint(0, 120))]
        passage = draw.choice(items)[1] or ""
        if i % 3 == 0:
            passage = passage.upper().replace(" ", ", ")
        if i % 5 == 0:
            parts = passage.split()
            parts[len(parts) // 2 :: 30] = ["changed"] * len(parts[len(parts) // 2 :: 30])
            passage = " ".join(parts)
        cut = draw.randint(0, len(filler))
        docs.append((i, " ".join([*filler[:cut], passage, *filler[cut:]])))
    docs += [(90, None), (91, ""), (92, items[0][1] * 3000), (None, items[1][1]), (93, items[1][1])]
    docs += [(94, " ".join(items[2][1].split()[:-1]))]
    benchmark = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, n int")
    got = decontaminate.benchmark_matches(frame(spark, docs), benchmark).collect()
    found = {}
    for r in got:
        found.setdefault(r.doc_id, set()).add((r.item_id, r.first_word, r.similarity))
    for i, text in docs:
        if i == 92:
            assert {x[0] for x in found[i]} >= {items[0][0]}
        else:
            assert found.get(i, set()) == plain_matches(text, items), i
    assert decontaminate.benchmark_matches(frame(spark, []), benchmark).count() == 0
    assert decontaminate.benchmark_matches(frame(spark, docs), benchmark.limit(0)).count() == 0


def test_benchmark_in_several_passes(spark, monkeypatch):
    docs = [(1, "a b c d e f g h"), (2, "k l m n o p q r")]
    items = spark.createDataFrame([(2, docs[1][1]), (1, docs[0][1])], "item_id long, text string")
    monkeypatch.setattr(decontaminate, "WORDS_IN_A_PASS", 8)
    got = decontaminate.benchmark_matches(frame(spark, docs), items)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(1, 1), (2, 2)}


def test_block_index_misses_nothing():
    draw = np.random.default_rng(4)
    prints = draw.integers(0, 2**64, 20, dtype=np.uint64)
    windows = np.concatenate([prints[:, None] ^ (np.uint64(1) << draw.integers(0, 64, (20, 1), dtype=np.uint64))
                              for _ in range(5)] + [draw.integers(0, 2**64, (4000, 1), dtype=np.uint64)]).ravel()
    for _ in range(20):
        windows[: len(prints) * 5] ^= np.uint64(1) << draw.integers(0, 64, len(prints) * 5, dtype=np.uint64)
        got = {(i, w) for i, ws in decontaminate.BlockIndex(prints).near(windows) for w in ws.tolist()}
        near = np.bitwise_count(prints[:, None] ^ windows[None, :]) <= decontaminate.RADIUS
        assert got == set(zip(*map(np.ndarray.tolist, np.nonzero(near)), strict=True))


def test_kneser_ney_sums_to_one():
    counts = Counter()
    for word in ("banana", "bandana", "ananas", "nab"):
        line = "\2\2\2" + word + "\3"
        counts.update(line[i : i + 4] for i in range(len(line) - 3))
    models = language_id.estimate([("x", g, n) for g, n in counts.items()] + [("y", "\2\2\2q", 1), ("y", "\2\2q\3", 3)])
    letters = sorted({g[-1] for g in counts} | {"q"})
    for context in ("\2\2\2", "\2ba", "ana", "zzz"):
        total = 0.0
        for c in letters:
            codes = np.array([ord(x) for x in context + c], np.uint64)
            total += np.exp(_score(models, codes)[0])
        unknown = np.array([ord(x) for x in context + "一"], np.uint64)
        rest = np.exp(_score(models, unknown)[0])
        assert total + rest == pytest.approx(1.0, abs=1e-9)


def _score(models, codes):
    value = np.zeros(len(models.languages))
    for order in range(4, 0, -1):
        key = language_id.keys_of(codes, order)[-1]
        at = np.searchsorted(models.grams[order - 1], key)
        if at < len(models.grams[order - 1]) and models.grams[order - 1][at] == key:
            return value + models.log_p[order - 1][at]
        if order > 1:
            key = language_id.keys_of(codes[:-1], order - 1)[-1]
            at = np.searchsorted(models.contexts[order - 2], key)
            if at < len(models.contexts[order - 2]) and models.contexts[order - 2][at] == key:
                value = value + models.log_back[order - 2][at]
    return value + models.unseen


def test_language_of_held_out_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    models = language_id.fit(docs.where(~language_id.held_out()))
    got = language_id.identify(docs, models).join(docs, "doc_id")
    tested = got.where(language_id.held_out()).select("lang", "lang_pred", "accepted").collect()
    assert sum(r.lang == r.lang_pred for r in tested) >= 0.99 * len(tested)
    assert sum(r.accepted for r in tested) >= 0.98 * len(tested)


def test_language_of_odd_rows(spark):
    train = spark.createDataFrame(
        [("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "en"), ("x", None)],
        "text string, lang string",
    )
    models = language_id.fit(train)
    rows = [(1, None), (2, ""), (3, "123 !? ² Ⅷ"), (4, "the dog"), (5, "THE DOG " * 30_000), (None, "die katze"), (4, "the dog"), (6, "漢字")]
    got = language_id.identify(frame(spark, rows), models).collect()
    pred = {(r.doc_id, r.lang_pred) for r in got}
    assert len(got) == len(rows)
    assert {(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "en"), (None, "de")} <= pred
    assert all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got if r.doc_id == 6} <= {"en", "de"}
    assert language_id.fit(train.where(F.lit(False))) is None
    assert {r.lang_pred for r in language_id.identify(frame(spark, rows), None).collect()} == {"und"}
    assert language_id.identify(frame(spark, []), models).count() == 0
