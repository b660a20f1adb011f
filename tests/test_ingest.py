import os

import pytest

from cohortloom import schemas
from cohortloom.plans import ingest
from cohortloom.sources import csv_files, files, listing, storage, tables


def _write(root, path, content):
    target = root / path
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_bytes(content.encode() if isinstance(content, str) else content)


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("export tree")
    _write(root, "Participant_1/Aware/battery.csv", "timestamp,participant,battery_charge_start,battery_charge_end\n1,1,90,80\n2,1,x,70\n")
    _write(root, "Participant_2/Aware/battery_b+c d.csv", "battery_charge_end,timestamp,battery_charge_start,extra\n55,9,66,hi\n")
    _write(root, "Participant_2/Aware/calls.csv", "timestamp,dur,type\n1,12.5,2\n")
    _write(root, "Participant_3/Aware/battery.CSV", "timestamp,participant\n1,3\n")
    _write(root, "Participant_1/Watch/w.csv", "timestamp,hrm\n1,60\n2,61,oops\n3,62\n")
    _write(root, "Participant_2/Watch/deep/[w] {2}.CSV", "\ufefftimestamp,hrm\n4,70\n")
    _write(root, "Participant_2/Watch/empty.csv", "")
    _write(root, "Participant_2/Watch/header_only.csv", "timestamp,hrm\n")
    _write(root, "Participant_2/Watch/notes.txt", "timestamp,hrm\n8,99\n")
    _write(root, "Participant_1/Surveys/UCLA first.csv", "participant,date,timestamp,q1,q2,quality,age\n1,2020-01-01,2020-01-01 10:00:00,Never,Often,good,30\n1,2020-01-02,2020-01-02 10:00:00, ,Rarely,bad,30\n")
    _write(root, "Participant_2/Surveys/sub/PHQ.CSV", "Date,Q1,Q2\n2020-05-05,1,2\n")
    _write(root, "Participant_2/Surveys/info.csv", "participant,comment\n2,hello\n")
    _write(root, "Participant_1/Oura/ring.csv", "participant,timestamp,OURA_sleep_score,OURA_sleep_hr_5min,OURA_sleep_is_longest,OURA_sleep_period_id\n1,1577934245,80,0;60;61,1,0042\n")
    return str(root)


def _files(spark, tree, folder, people=None):
    return listing.list_files(spark, listing.folder_globs(tree, people, folder))


def test_globs_and_listing(spark, tree):
    assert listing.phone_globs("s3a://b/x/", ["P_1", "P_2"], "calls") == ["s3a://b/x/{P_1,P_2}/Aware/calls*.[cC][sS][vV]"]
    assert listing.folder_globs("/x", None) == ["/x/Participant_*/"]
    many = listing.folder_globs("/x", [f"P_{i}" for i in range(2500)], "Oura")
    assert len(many) == 3
    found = {os.path.basename(r.path) for r in _files(spark, tree, "Watch").collect()}
    assert found == {"w.csv", "[w] {2}.CSV", "header_only.csv"}  # an empty file has no rows
    assert _files(spark, tree, "Nothing").isEmpty()
    some = _files(spark, tree, "Watch", ["Participant_1", "Participant_404"])
    assert [os.path.basename(r.path) for r in some.collect()] == ["w.csv"]


def test_listing_reads_no_content(spark, tree):
    plan = _files(spark, tree, "Watch")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_header_names_like_the_reader_makes_them():
    assert csv_files.column_names('a,"b, c",,a,A') == ("a0", "b, c", "_c2", "a3", "A4")


def test_one_scan_per_distinct_header(spark, tree):
    groups = csv_files.header_groups(_files(spark, tree, "Watch"))
    assert [(g.columns, len(g.paths)) for g in groups] == [(("timestamp", "hrm"), 3)]
    rows = csv_files.good_rows(groups[0])
    assert sorted((r.timestamp, r.hrm) for r in rows.collect()) == [("1", "60"), ("3", "62"), ("4", "70")]
    assert all(t == "string" for _, t in rows.dtypes)
    assert rows.count() == 3 and rows.select("source_file").distinct().count() == 2


def test_bad_rows_policies(spark, tree):
    found = _files(spark, tree, "Watch")
    groups = csv_files.header_groups(found)
    report = csv_files.bad_files(groups).collect()
    assert [(os.path.basename(r.source_file), r.total_rows, r.bad_rows) for r in report] == [("w.csv", 3, 1)]
    assert [r.record for r in csv_files.quarantined_rows(groups).collect()] == ["2,61,oops"]
    whole = csv_files.read_csv(found, "files")
    assert [r.timestamp for r in whole.collect()] == ["4"]
    with pytest.raises(Exception, match="(?i)malformed"):
        csv_files.read_csv(found, "fail").collect()
    with pytest.raises(ValueError):
        csv_files.read_csv(found, "ignore")


def test_unreadable_files_are_reported_not_fatal(spark, tree):
    gone = spark.createDataFrame([("file:/nowhere/x.csv", 1)], listing.LISTING_SCHEMA)
    both = gone.unionByName(_files(spark, tree, "Watch"))
    assert [r.path for r in csv_files.unreadable(both).collect()] == ["file:/nowhere/x.csv"]
    assert csv_files.read_csv(both).count() == 3
    with pytest.raises(OSError):
        csv_files.read_csv(both, "fail")
    with pytest.raises(OSError):
        csv_files.read_csv(gone)
    assert csv_files.read_csv(gone.where("false")) is None


def test_union_by_name_ignores_order(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("y", 2, True)], "s string, i int, extra boolean")
    ab = csv_files.union_by_name([a, b]).select("i", "s", "extra")
    ba = csv_files.union_by_name([b, a]).select("i", "s", "extra")
    assert sorted(map(tuple, ab.collect())) == sorted(map(tuple, ba.collect())) == [(1, "x", None), (2, "y", True)]
    assert csv_files.union_by_name([]) is None


def test_phone_log(spark, tree):
    rows = {r.timestamp: r for r in ingest.phone_log(spark, tree, "battery").collect()}
    assert set(rows) == {"1", "2", "9"}
    assert rows["2"].battery_charge_start is None and rows["2"].battery_charge_end == 70.0
    other = rows["9"]
    assert other.battery_charge_start == 66.0 and other.extra == "hi"
    assert other.participant == "2"  # not in the file: from the folder
    assert (other.participant_id, other.source_type_raw, other.source_type, other.aware_type) == ("Participant_2", "Aware", "aware", "battery")
    assert (other.file_name, other.file_stem) == ("battery_b+c d.csv", "battery_b+c d")
    only = ingest.phone_log(spark, tree, "battery", ["Participant_1"])
    assert only.count() == 2
    assert ingest.phone_log(spark, tree, "messages") is None


def test_ring_types_keep_text_series(spark, tree):
    row = ingest.device_table(spark, tree, "oura", "Oura").first()
    assert row.OURA_sleep_score == 80.0 and row.OURA_sleep_hr_5min == "0;60;61"
    assert row.OURA_sleep_is_longest is True and row.OURA_sleep_period_id == "0042"
    assert row.timestamp == 1577934245
    assert len(schemas.RING_MEASURES) == 82
    kinds = [f.dataType.simpleString() for f in schemas.measures("oura")][2:]
    assert (kinds.count("double"), kinds.count("string"), kinds.count("boolean")) == (69, 12, 1)


def test_surveys_long(spark, tree):
    long = ingest.surveys_long(spark, tree)
    assert long.schema.names == schemas.curated("surveys_long").names
    got = sorted((r.participant, r.date, r.question_id, r.response_raw, r.file_stem) for r in long.collect())
    assert got == [
        ("1", "2020-01-01", "q1", "Never", "UCLA first"),
        ("1", "2020-01-01", "q2", "Often", "UCLA first"),
        ("1", "2020-01-02", "q2", "Rarely", "UCLA first"),
        ("2", "2020-05-05", "q1", "1", "PHQ"),
        ("2", "2020-05-05", "q2", "2", "PHQ"),
    ]
    prefixed = ingest.surveys_long(spark, tree, any_q=True)
    assert prefixed.where("question_id = 'quality'").count() == 2


def test_dataset_selection_rules():
    assert ingest.parse_datasets(" Aware:Battery, ,oura,") == {"aware:battery", "oura"}
    assert ingest.selected({"all"}, "watch") and ingest.selected({"oura"}, "Oura")
    assert not ingest.selected({"oura"}, "watch")
    assert list(ingest.builders()) == ["aware:battery", "aware:calls", "aware:screen", "aware:messages", "aware:notifications", "oura", "watch", "surveys"]


def test_whole_job_and_tables(spark, tree, tmp_path):
    target = str(tmp_path / "curated")
    assert ingest.ingest(spark, tree, target, dry_run=True) and not os.path.exists(target)
    written = ingest.ingest(spark, tree, target)
    assert written == ["aware_battery", "aware_calls", "oura", "watch", "surveys_long"]
    # loading again does not double the data
    ingest.ingest(spark, tree, target)
    for name in written:
        table = tables.read_table(spark, target, name)
        assert table.schema == schemas.curated(name)
    # undeclared columns are kept, malformed records are set aside
    assert "extra" in spark.read.parquet(f"{target}/aware/battery").columns
    kept = spark.read.parquet(f"{target}/quarantine/watch").collect()
    assert [r.record for r in kept] == ["2,61,oops"]
    assert sorted(os.listdir(f"{target}/quarantine")) == sorted(written)
    assert spark.read.parquet(f"{target}/quarantine/oura").isEmpty()
    assert tables.read_table(spark, target, "aware_battery").count() == 4  # with the .CSV file
    # an append loads what is new, unless it is told to load everything again
    ingest.ingest(spark, tree, target, "aware:battery", write_mode="append")
    assert tables.read_table(spark, target, "aware_battery").count() == 4
    ingest.ingest(spark, tree, target, "aware:battery", write_mode="append", only_new=False)
    assert tables.read_table(spark, target, "aware_battery").count() == 8
    tables.register_tables(spark, target, written)
    answers = tables.query(spark, "SELECT count(*) AS n FROM surveys_long WHERE file_stem LIKE '%UCLA%'")
    assert answers.first().n == 3


def test_external_tables_in_one_database(spark, tree, tmp_path):
    target = str(tmp_path / "curated")
    ingest.ingest(spark, tree, target, "watch")
    tables.create_external_tables(spark, target, "cohort_test", ["watch"])
    assert spark.table("cohort_test.watch").count() == 3


def test_partitioned_overwrite_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string")
    tables.write_parquet(df, path, partition_by=["k"])
    tables.write_parquet(df.where("k = 'a'"), path, partition_by=["k"])
    assert sorted((r.v, r.k) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        tables.write_parquet(df, path, "replace")


def test_survey_filter_and_columns_reach_the_scan(spark, tree, tmp_path):
    from cohortloom.plans.labels import survey_rows

    target = str(tmp_path / "curated")
    ingest.ingest(spark, tree, target, "surveys")
    plan = survey_rows(tables.read_table(spark, target, "surveys_long"))._jdf.queryExecution().executedPlan().toString()
    assert "StringContains(file_stem,UCLA)" in plan
    assert "question_text" not in plan and "survey_path" not in plan


def test_paths_resolve_by_scheme(tmp_path):
    system, location = files.resolve(f"file:{tmp_path}/a b", {})
    assert location == f"{tmp_path}/a b" and "Local" in type(system).__name__
    assert files.resolve(f"file://{tmp_path}/x", {})[1] == f"{tmp_path}/x"
    assert files.resolve(f"{tmp_path}/x", {})[1] == f"{tmp_path}/x"


def test_shared_root_comes_from_the_session(spark):
    configured = spark.conf.get(storage.SETTING, None)
    root = storage.shared_root(spark)
    if configured:
        assert root == files.qualify(spark, configured)
    kept = storage.materialize(spark.range(5), "five")
    assert kept.count() == 5
    assert files.resolve(kept.inputFiles()[0], {})[1].startswith(files.resolve(root, {})[1])


def test_no_private_folder_on_a_cluster(monkeypatch):
    class Context:
        master = "yarn"
        applicationId = "app"

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_root(Session())


def _write_bytes(root, name, content):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content)


def test_ingest_loses_nothing(spark, tmp_path):
    root, target = tmp_path / "in", str(tmp_path / "out")
    _write_bytes(root, "Participant_1/Watch/a.csv", b"Timestamp,Participant,HRM\n1,alice,60\n")
    _write_bytes(root, "Participant_2/Watch/b.CSV", b"timestamp,participant,hrm\n2,bob,61\n")
    _write_bytes(root, "Participant_2/Watch/bad.csv", b"timestamp,\xff\xfe,hrm\n3,x,62\n")
    _write_bytes(root, "Participant_1/Aware/battery1.CSV", b"timestamp,battery_charge_start\n1,50\n")
    _write_bytes(root, "Participant_1/Surveys/s.csv", b"participant,q1,q2a,Q_3,question4\n1,a,b,c,d\n")
    ingest.ingest(spark, str(root), target, any_q=True)
    watch = spark.read.parquet(f"{target}/watch")
    assert {(r.participant, r.hrm) for r in watch.collect()} == {("alice", 60.0), ("bob", 61.0)}
    listed = spark.read.parquet(f"{target}/quarantine/files/watch").collect()
    assert [os.path.basename(r.path) for r in listed] == ["bad.csv"] and listed[0].error
    assert tables.read_table(spark, target, "aware_battery").first().battery_charge_start == 50.0
    answers = tables.read_table(spark, target, "surveys_long").collect()
    assert {r.question_id for r in answers} == {"q1", "q2a", "q_3", "question4"}
    with pytest.raises(OSError):
        ingest.ingest(spark, str(root), target, "watch", on_bad="fail")
    # loading one participant anew keeps the others
    _write_bytes(root, "Participant_2/Watch/b.CSV", b"timestamp,participant,hrm\n2,bob,71\n4,bob,72\n")
    for _ in range(2):
        ingest.ingest(spark, str(root), target, "watch", participants=["Participant_2"])
        watch = spark.read.parquet(f"{target}/watch")
        assert {(r.participant, r.hrm) for r in watch.collect()} == {("alice", 60.0), ("bob", 71.0), ("bob", 72.0)}


def test_header_without_end_is_reported(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv_files, "HEADER_BYTES", 100)
    _write_bytes(tmp_path, "Participant_1/Watch/a.csv", b"x" * 20_000)
    files = listing.list_files(spark, listing.folder_globs(str(tmp_path), None, "Watch"))
    cache: dict = {}
    with pytest.raises(ValueError):
        csv_files._first_line(files.first().path, cache)


def test_scratch_scope_removes_what_it_made(spark):
    from cohortloom.sources import storage

    kept = storage.scratch_path(spark, "kept")
    spark.range(3).write.parquet(kept)
    with storage.scratch_scope(spark):
        gone = storage.scratch_path(spark, "gone")
        spark.range(3).write.parquet(gone)
        assert os.path.exists(gone.removeprefix("file:"))
    assert not os.path.exists(gone.removeprefix("file:"))
    assert spark.read.parquet(kept).count() == 3


def test_many_files_are_looked_up_in_few_tasks(spark, tmp_path):
    setting = listing.LISTING_TASKS
    before = spark.conf.get(setting)
    folder = tmp_path / "Participant_1" / "Aware"
    folder.mkdir(parents=True)
    for i in range(90):
        (folder / f"battery_{i}.csv").write_text(f"timestamp,participant\n{i},p\n")
    tracker = spark.sparkContext.statusTracker()
    spark.conf.set(setting, "10000")
    try:
        spark.sparkContext.setJobGroup("listing", "files and their rows")
        files = listing.list_files(spark, listing.phone_globs(str(tmp_path), None, "battery"))
        rows = csv_files.read_csv(files)
        assert spark.conf.get(setting) == "10000"
        sizes = [
            tracker.getStageInfo(stage).numTasks
            for job in tracker.getJobIdsForGroup("listing")
            for stage in tracker.getJobInfo(job).stageIds
            if tracker.getStageInfo(stage) is not None
        ]
        assert rows.count() == 90
        assert max(sizes) <= 8 * spark.sparkContext.defaultParallelism
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set(setting, before)
