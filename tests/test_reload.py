"""Loads that fail, repeat, change files or meet many headers."""

import os
import time

import pytest
from pyspark.sql import functions as F

from cohortloom import schemas
from cohortloom.plans import ingest
from cohortloom.sources import csv_files, listing, tables


def put(root, path, content):
    target = root / path
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(content)


def watch(spark, target):
    rows = tables.read_table(spark, target, "watch").collect()
    return sorted((r.participant_id, r.timestamp, r.hrm) for r in rows)


@pytest.fixture
def loaded(spark, tmp_path):
    root, target = tmp_path / "in", str(tmp_path / "out")
    for p in range(1, 5):
        rows = "".join(f"{p}{i},{p * 10 + i}\n" for i in range(4))
        put(root, f"Participant_{p}/Watch/w.csv", "timestamp,hrm\n" + rows)
    ingest.ingest(spark, str(root), target, "watch")
    return root, target


def failing(spark, target, people):
    """Rows of which one can't be computed."""
    rows = tables.read_table(spark, target, "watch").where(F.col("participant_id").isin(people))
    bad = F.when(F.col("hrm") == 22, F.raise_error(F.lit("lost"))).otherwise(F.lit(0.0))
    return rows.withColumn("hrm", bad.cast("double"))


@pytest.mark.parametrize("people", [None, ["Participant_2", "Participant_3"]])
@pytest.mark.parametrize("mode", ["overwrite", "append"])
def test_a_write_that_fails_keeps_the_old_table(spark, loaded, people, mode):
    root, target = loaded
    before = watch(spark, target)
    assert len(before) == 16
    path = f"{target}/watch"
    bad = failing(spark, target, people or [f"Participant_{p}" for p in range(1, 5)])
    with pytest.raises(Exception, match="lost"):
        ingest.write_curated(bad, path, mode, people)
    assert watch(spark, target) == before
    assert not [name for name in os.listdir(target) if name.startswith("_")]
    ingest.ingest(spark, str(root), target, "watch", participants=people)
    assert watch(spark, target) == before


def test_a_load_that_fails_keeps_everything(spark, loaded):
    root, target = loaded
    before = watch(spark, target)
    put(root, "Participant_2/Watch/w.csv", "timestamp,hrm\n1,2,3\n")
    for people in (None, ["Participant_2"]):
        with pytest.raises(Exception, match="(?i)malformed"):
            ingest.ingest(spark, str(root), target, "watch", people, on_bad="fail")
        assert watch(spark, target) == before


def test_a_swap_that_was_cut_off_is_finished(spark, loaded):
    root, target = loaded
    before = watch(spark, target)
    os.rename(f"{target}/watch", f"{target}/_watch-replaced")
    tables.recover_table(spark, f"{target}/watch")
    assert watch(spark, target) == before
    os.rename(f"{target}/watch", f"{target}/_watch-replaced")
    ingest.ingest(spark, str(root), target, "watch")
    assert watch(spark, target) == before
    assert sorted(os.listdir(target)) == ["ledger", "quarantine", "watch"]


def test_files_with_malformed_records_count_as_not_loaded(spark, loaded):
    root, target = loaded
    put(root, "Participant_2/Watch/w.csv", "timestamp,hrm\n1,x\n1,2,3\n")
    put(root, "Participant_3/Watch/w.csv", "timestamp,hrm\n1,x\n2,\n")
    ingest.ingest(spark, str(root), target, "watch", on_bad="files")
    assert {r[0] for r in watch(spark, target)} == {"Participant_1", "Participant_3", "Participant_4"}
    ledger = spark.read.parquet(ingest.file_ledger_path(target, "watch")).collect()
    counts = {r.path.split("/")[-3]: (r.rows, r.bad_rows) for r in ledger}
    assert counts["Participant_2"] == (0, 1) and counts["Participant_3"] == (2, 0)
    losses = spark.read.parquet(ingest.cast_ledger_path(target, "watch")).collect()
    assert [(r.source_file.split("/")[-3], r.column, r.lost) for r in losses] == [("Participant_3", "hrm", 1)]


def test_reload_of_some_participants(spark, loaded):
    root, target = loaded
    put(root, "Participant_2/Watch/w.csv", "timestamp,hrm\n99,1\n98,2,3\n")
    put(root, "Participant_3/Watch/w.csv", "timestamp,hrm\n")
    people = ["Participant_2", "Participant_3", "Participant_404"]
    for _ in range(2):
        ingest.ingest(spark, str(root), target, "watch", people)
        got = watch(spark, target)
        assert [r for r in got if r[0] in people] == [("Participant_2", "99", 1.0)]
        assert len(got) == 9  # a participant without rows has none left
        kept = spark.read.parquet(f"{target}/quarantine/watch").collect()
        assert [r.record for r in kept] == ["98,2,3"]
        ledger = spark.read.parquet(ingest.file_ledger_path(target, "watch")).collect()
        assert len(ledger) == 4 and sorted(r.rows for r in ledger) == [0, 1, 4, 4]
    with pytest.raises(ValueError):
        ingest.ingest(spark, str(root), target, "watch", ["someone"])


def test_append_loads_new_and_changed_files_once(spark, loaded):
    root, target = loaded
    before = watch(spark, target)
    add = lambda: ingest.ingest(spark, str(root), target, "watch", write_mode="append")
    assert add() == [] and watch(spark, target) == before
    put(root, "Participant_1/Watch/more.csv", "timestamp,hrm,note\n7,70,new\n8,x,new\n")
    put(root, "Participant_9/Watch/w.csv", "timestamp,hrm\n9,90\n")
    put(root, "Participant_2/Watch/w.csv", "timestamp,hrm\n20,1\n21,2\n1,2,3,4\n")
    want = [r for r in before if r[0] != "Participant_2"]
    want += [("Participant_1", "7", 70.0), ("Participant_1", "8", None), ("Participant_9", "9", 90.0)]
    want += [("Participant_2", "20", 1.0), ("Participant_2", "21", 2.0)]
    assert add() == ["watch"]
    key = lambda r: (r[0], r[1])
    assert sorted(watch(spark, target), key=key) == sorted(want, key=key)
    assert add() == [] and len(watch(spark, target)) == len(want)
    wide = spark.read.option("mergeSchema", True).parquet(f"{target}/watch")
    assert wide.where("note = 'new'").count() == 2
    losses = spark.read.parquet(ingest.cast_ledger_path(target, "watch")).collect()
    assert [(os.path.basename(r.source_file), r.column, r.lost) for r in losses] == [("more.csv", "hrm", 1)]
    assert [r.record for r in spark.read.parquet(f"{target}/quarantine/watch").collect()] == ["1,2,3,4"]
    ledger = spark.read.parquet(ingest.file_ledger_path(target, "watch"))
    assert ledger.count() == ledger.select("path").distinct().count() == 6


def test_append_after_a_lost_ledger_does_not_double(spark, loaded):
    """The table was written, the ledger was not: the files are loaded again in their place."""
    root, target = loaded
    before = watch(spark, target)
    tables.replace_table(
        spark.createDataFrame([], ingest.FILE_LEDGER), ingest.file_ledger_path(target, "watch")
    )
    assert ingest.ingest(spark, str(root), target, "watch", write_mode="append") == ["watch"]
    assert watch(spark, target) == before


def test_one_scan_for_two_thousand_headers(spark, tmp_path):
    for k in range(2000):
        names = ["timestamp", f"own_{k}", "hrm"] if k % 2 else ["hrm", "timestamp", f"own_{k}", f"b_{k}"]
        values = ",".join(f"{name}-{k}" for name in names)
        put(tmp_path, f"Participant_{k % 50}/Watch/w{k}.csv", ",".join(names) + f"\n{values}\n")
    files = listing.list_files(spark, listing.folder_globs(str(tmp_path), None, "Watch"))
    found = files.select("path").collect()
    rows = spark.createDataFrame([(r.path, 1) for r in found], listing.LISTING_SCHEMA)
    headers = csv_files.headers_of(rows).collect()
    start = time.time()
    records = csv_files.header_groups(rows, spellings=ingest.spellings("watch"))
    wide = records.scan
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert time.time() - start < 30  # with the pass over all files; the plan alone takes less
    assert len(headers) == 2000 and len(records.columns) == 3002
    assert plan.count("FileScan") == 1
    narrow = records.wide(records.lines, ["timestamp", "hrm"])
    got = {(r.timestamp, r.hrm) for r in narrow.collect()}
    assert got == {(f"timestamp-{k}", f"hrm-{k}") for k in range(2000)}


def test_records_of_one_scan(spark, tmp_path, monkeypatch):
    put(tmp_path, "Participant_1/Watch/a.csv", "﻿timestamp,hrm\n1,\"6,0\"\n\n  \n2,61,9\ntimestamp,hrm\n3\n")
    put(tmp_path, "Participant_1/Watch/b.csv", "\r\n\nHRM,note,Timestamp\r\n70,\"a \\\"b\\\"\",4\r\n,x y,\r\n")
    put(tmp_path, "Participant_1/Watch/c d+e[1].csv", "hrm\n80\n")
    files = listing.list_files(spark, listing.folder_globs(str(tmp_path), None, "Watch"))
    for portion in (50_000, 1):
        monkeypatch.setattr(csv_files, "FILES_IN_A_SCAN", portion)
        records = csv_files.header_groups(files, spellings=["timestamp", "hrm"])
        rows = csv_files.good_rows(records).select("timestamp", "hrm", "note").collect()
        want = [("1", "6,0", None), ("4", "70", 'a "b"'), (None, None, "x y"), (None, "80", None)]
        assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
        bad = csv_files.quarantined_rows(records).collect()
        assert sorted(r.record for r in bad) == ["2,61,9", "3"]
        assert [len(g.paths) for g in records] == [1, 1, 1]


def test_surveys_in_one_scan_lose_no_malformed_record(spark, tmp_path):
    root, target = tmp_path / "in", str(tmp_path / "out")
    put(root, "Participant_1/Surveys/UCLA.csv", "participant,date,q1,q2\n1,2020-01-01,Never, \n1,x\n")
    put(root, "Participant_2/Surveys/PHQ.csv", "Q1,Date,comment\nOften,2020-02-02,quick\n")
    ingest.ingest(spark, str(root), target, "surveys")
    rows = tables.read_table(spark, target, "surveys_long").collect()
    assert {(r.participant, r.date, r.question_id, r.response_raw) for r in rows} == {
        ("1", "2020-01-01", "q1", "Never"), ("2", "2020-02-02", "q1", "Often"),
    }
    assert [r.record for r in spark.read.parquet(f"{target}/quarantine/surveys_long").collect()] == ["1,x"]
    assert tables.read_table(spark, target, "surveys_long").schema == schemas.curated("surveys_long")
