"""The pipeline's stages against plain versions on a small fixture."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortloom.llm.common import table
from cohortloom.sources.storage import materialize, scratch_path
from tests.llm.test_corpus_ops import plain_components, plain_print

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(spark):
    """Given documents with planted copies, near copies, passages and junk."""
    given = table(spark, "/root/testdata/sf0.001", "documents").where("n_chars > 800")
    rows = [tuple(r) for r in given.select(*COLUMNS).collect()]
    items = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "benchmark").collect()]
    draw, planted = random.Random(4), {}
    for k, (doc, text, lang, source, n) in enumerate(rows[:12]):
        words = text.split(" ")
        words[len(words) // 2] = "edited"
        planted[10_000 + k] = ("exact", doc)
        planted[20_000 + k] = ("near", doc)
        planted[30_000 + k] = ("leak", k)
        rows.append((10_000 + k, text, lang, source, n))
        rows.append((20_000 + k, " ".join(words), lang, source, n))
        body = " ".join(draw.sample(words, len(words)))
        rows.append((30_000 + k, f"{body}. {items[k][1]} {body[::-1]}", lang, source, n))
    rows += [(40_000, None, None, None, None), (40_001, "", "en", "s", 0), (40_002, "12 34 !!", "en", "s", 8)]
    rows += [(40_003, "ξένα γράμματα " * 40, None, "s", 1)]
    path = scratch_path(spark, "corpus")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(f"{path}/documents.parquet")
    table(spark, "/root/testdata/sf0.001", "benchmark").write.parquet(f"{path}/benchmark.parquet")
    return path, planted


def test_stages(spark, corpus):
    path, planted = corpus
    docs = table(spark, path, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, docs, path), f"test-{name}")
        if name != "encode":
            assert after.columns == COLUMNS
            assert after.exceptAll(docs).count() == 0
        kept[name] = (
            {r.doc_id: r.text for r in docs.collect()},
            {r.doc_id for r in after.select("doc_id").collect()},
        )
        docs = after
    before, left = kept["language"]
    assert before.keys() - left >= {40_000, 40_001, 40_002, 40_003}
    assert len(before.keys() - left) <= 6
    before, left = kept["exact"]
    best = {}
    for i, text in before.items():
        best[text] = max(i, best.get(text, i))
    assert left == set(best.values())
    before, left = kept["near"]
    prints = {i: plain_print(t, 3) for i, t in before.items()}
    linked = [
        (a, b)
        for a, b in itertools.combinations(set(prints.values()), 2)
        if bin(a ^ b).count("1") <= 2
    ]
    groups = plain_components(set(prints.values()), linked)
    least = {}
    for i, p in prints.items():
        least[groups[p]] = min(i, least.get(groups[p], i))
    assert left == set(least.values())
    assert {i for i, (kind, _) in planted.items() if kind == "near"} - left
    before, left = kept["benchmark"]
    items = [
        " ".join(re.findall(r"[^\W_]+", r.text.lower()))
        for r in table(spark, path, "benchmark").collect()
    ]
    holds = {
        i for i, t in before.items()
        if any(x in " ".join(re.findall(r"[^\W_]+", t.lower())) for x in items)
    }
    assert left == before.keys() - holds
    assert {i for i, (kind, _) in planted.items() if kind == "leak"} & left == set()
    before, left = kept["encode"]
    assert left == set(before)
    assert docs.where(~F.col("round_trip")).count() == 0


def test_run_equals_the_stages(spark, corpus):
    path, _ = corpus
    rows = corpus_pipeline.run(spark, path)
    assert rows.count() == rows.select("doc_id").distinct().count() > 100


def test_empty_tables(spark, corpus):
    path, _ = corpus
    docs = table(spark, path, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, path), f"test-empty-{name}")
        assert docs.count() == 0


def test_stages_on_odd_tables(spark, corpus):
    """Repeated and missing identifiers, other texts under one, clashing and map columns."""
    path, _ = corpus
    long = " ".join(f"word{i} and the rest of it" for i in range(30))
    other = " ".join(f"thing{i} was here for them" for i in range(30))
    rows = [
        (1, long, "en", {"a": 1}, "x"),
        (2, long + " z", "en", {"a": 2}, "x"),
        (2, other, "en", None, "y"),
        (2, other, "en", {"b": 1}, "z"),
        (None, other, "de", {"b": 1}, "z"),
        (None, None, None, None, None),
        (3, "", "en", {}, ""),
    ]
    names = "doc_id long, text string, lang string, found map<string,int>, digest string"
    docs = spark.createDataFrame(rows, names).withColumn("_digest", F.lit("own")).withColumn("row", F.lit(5))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, path)
        assert got.columns == docs.columns
        after = got.collect()
        assert {r._digest for r in after} <= {"own"} and {r.row for r in after} <= {5}
        if name == "exact":
            kept = [(r.doc_id, r.text) for r in after]
            assert sorted(map(str, kept)) == sorted(map(str, [(1, long), (2, long + " z"), (2, other), (3, "")]))
            assert [r.found for r in after if r.text == other][0] in (None, {"b": 1})
        if name == "near":
            kept = [(r.doc_id, r.text) for r in after]
            assert (2, other) in kept and (1, long) in kept and kept.count((2, other)) == 1
