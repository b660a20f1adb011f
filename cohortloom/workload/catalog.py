"""Registered queries: name -> function of (spark, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom import schemas
from cohortloom.operators import (
    assemble,
    features,
    folds,
    importance,
    latest,
    medians,
    metrics,
    models,
    prepare,
    rename,
    reshape,
    scoring,
)
from cohortloom.plans import evaluate, ingest, labels, model_table, results, states
from cohortloom.sources import csv_files, listing, storage, tables
from cohortloom.workload import cohort, exports

LONG_COLUMNS = (*labels.SUBMISSION, "question_id", "response_raw")
PROVENANCE = ("participant_id", "source_type_raw", "source_type", "file_name", "file_stem")

# ---------------------------------------------------------------------------
# Questionnaires
# ---------------------------------------------------------------------------


def survey_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.surveys_long(spark, sf_dir).select(*LONG_COLUMNS)


def survey_latest_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = labels.survey_rows(cohort.surveys_long(spark, sf_dir))
    return latest.latest_per_key(rows, "participant", ["timestamp"])


def survey_latest_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = labels.survey_rows(cohort.surveys_long(spark, sf_dir))
    return latest.latest_per_key(rows, "participant", ["timestamp", "file_name"])


def survey_pivot_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = cohort.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.concat(F.lit("q"), cohort.text("l_linenumber")).alias("question_id"),
        cohort.text(F.col("l_quantity").cast("int")).alias("response_raw"),
    )
    questions = [f"q{i}" for i in range(1, 8)]
    return reshape.pivot_first(
        lines, ["l_orderkey"], "question_id", "response_raw", questions, ["l_partkey"]
    )


def _ucla_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = cohort.surveys_wide(spark, sf_dir)
    return wide.where(F.col("file_stem").like(schemas.SURVEY_PATTERN))


def _coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.reverse_code(scoring.map_responses(_ucla_wide(spark, sf_dir), cohort.QUESTIONS))


def survey_map_reverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coded(spark, sf_dir).select("participant", "file_stem", *cohort.QUESTIONS)


def survey_total_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scoring.total_score(_coded(spark, sf_dir), cohort.QUESTIONS)
    return scored.select("participant", "file_stem", schemas.SCORE)


def survey_median_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scoring.total_score(_coded(spark, sf_dir), cohort.QUESTIONS)
    return scoring.median_split(scored, small_domain=True).select(
        "participant", "file_stem", schemas.SCORE, schemas.LABEL, schemas.LABEL_BINARY
    )


def participant_labels(spark: SparkSession, sf_dir: str, keep: str = "one") -> DataFrame:
    return labels.participant_labels(cohort.surveys_long(spark, sf_dir), cohort.QUESTIONS, keep=keep)


def participant_labels_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return participant_labels(spark, sf_dir, keep="ties")


# ---------------------------------------------------------------------------
# Features and model table
# ---------------------------------------------------------------------------


def _modality(modality: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return features.modality_features(cohort.log(spark, sf_dir, modality), modality)

    return run


def _modalities(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    logs = cohort.logs(spark, sf_dir)
    return {m: features.modality_features(logs[m], m) for m in features.MODALITIES}


def phone_outer_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _modalities(spark, sf_dir)
    return assemble.outer_chain([parts[m] for m in features.PHONE_MODALITIES])


def phone_ring_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.outer_join(
        phone_outer_chain(spark, sf_dir), _modality("ring")(spark, sf_dir)
    )


def features_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.merge_features(list(_modalities(spark, sf_dir).values()))


def features_single_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.single_shuffle(cohort.logs(spark, sf_dir))


def features_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.attach_labels(
        features_merged(spark, sf_dir), participant_labels(spark, sf_dir)
    )


def model_table_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_table.raw_model_table(cohort.logs(spark, sf_dir), participant_labels(spark, sf_dir))


def model_table_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_table.filled_model_table(
        cohort.logs(spark, sf_dir), participant_labels(spark, sf_dir)
    )


# ---------------------------------------------------------------------------
# Ingest
# ---------------------------------------------------------------------------


def csv_phone_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = exports.fresh_root(spark, "phone")
    for log in schemas.PHONE_LOGS:
        exports.export_phone(spark, sf_dir, root, log)
    parts = [ingest.phone_log(spark, root, log) for log in schemas.PHONE_LOGS]
    return csv_files.union_by_name(parts).select(
        "aware_type",
        *PROVENANCE,
        "timestamp",
        "participant",
        "note",
        "battery_charge_start",
        "battery_charge_end",
        "dur",
        "type",
        "message_type",
        "package_category",
        "screen_status",
    )


def csv_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = exports.fresh_root(spark, "union")
    exports.export_phone(spark, sf_dir, root, "battery")
    files = listing.list_files(spark, listing.phone_globs(root, None, "battery"))
    rows = csv_files.read_csv(files)
    return rows.select(
        "timestamp", "participant", "battery_charge_start", "battery_charge_end", "note"
    )


def csv_ingest_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = exports.fresh_root(spark, "metadata")
    exports.export_watch(spark, sf_dir, root)
    files = listing.list_files(spark, listing.folder_globs(root, None))
    rows = ingest.with_provenance(csv_files.read_csv(files))
    return rows.select(*PROVENANCE, "timestamp", "participant", "hrm")


def csv_watch_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = exports.fresh_root(spark, "watch")
    exports.export_watch(spark, sf_dir, root)
    rows = ingest.device_table(spark, root, "watch", "Watch")
    conformed = ingest.conform(rows, schemas.curated("watch"))
    return conformed.drop("ingest_ts", "source_file")


def csv_survey_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = exports.fresh_root(spark, "surveys")
    exports.export_surveys(spark, sf_dir, root)
    rows = ingest.surveys_long(spark, root)
    return rows.drop("ingest_ts", "source_file", "survey_path")


def ring_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns as read from an export, some not numbers, through the declared casts."""
    line = F.col("l_linenumber")
    raw = cohort.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        cohort.text("l_suppkey").alias("participant"),
        cohort.text(F.unix_seconds(F.col("l_shipdate").cast("timestamp"))).alias("timestamp"),
        F.repeat(cohort.text(line), 12).alias("OURA_activity_class_5min"),
        F.when(line % 3 == 0, F.lit("n/a"))
        .otherwise(cohort.text(F.col("l_quantity").cast("int")))
        .alias("OURA_activity_steps"),
        F.when(line % 2 == 0, F.lit("true")).otherwise(F.lit("0")).alias("OURA_sleep_is_longest"),
        F.concat(F.lit("0"), cohort.text(line)).alias("OURA_sleep_period_id"),
        cohort.text(F.col("l_partkey") * 0.25).alias("OURA_sleep_rmssd"),
    )
    return ingest.cast_ring(raw)


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = storage.scratch_path(spark, "roundtrip")
    rows = survey_unpivot(spark, sf_dir).withColumn(
        "survey", F.regexp_extract("file_stem", "^([A-Z]+)_", 1)
    )
    tables.write_parquet(rows, path, partition_by=["survey"])
    # a repeated load replaces its partitions and leaves the table as it was
    again = rows.where("survey = 'UCLA'")
    tables.write_parquet(again, path, partition_by=["survey"])
    return spark.read.parquet(path)


def table_sql_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = storage.scratch_path(spark, "curated")
    long = ingest.conform(cohort.surveys_long(spark, sf_dir), schemas.curated("surveys_long"))
    tables.write_parquet(long, f"{root}/{tables.location('surveys_long')}")
    battery = ingest.conform(
        cohort.phone_log(spark, sf_dir, "battery"), schemas.curated("aware_battery")
    )
    tables.write_parquet(battery, f"{root}/{tables.location('aware_battery')}")
    tables.register_tables(spark, root, ["surveys_long", "aware_battery"])
    return tables.query(
        spark,
        """
        SELECT s.participant, s.answers, b.battery_event_count
        FROM (SELECT participant, count(*) AS answers FROM surveys_long
              WHERE file_stem LIKE '%UCLA%' GROUP BY participant) s
        JOIN (SELECT participant, count(*) AS battery_event_count FROM aware_battery
              GROUP BY participant) b
          ON s.participant = b.participant
        """,
    )


def _bad_watch(spark: SparkSession, sf_dir: str) -> list[csv_files.HeaderGroup]:
    root = exports.fresh_root(spark, "bad")
    exports.export_watch(spark, sf_dir, root, with_bad=True)
    return csv_files.header_groups(
        listing.list_files(spark, listing.folder_globs(root, None, "Watch"))
    )


def _below_root(path: str):
    return F.regexp_extract(path, r"/(Participant_[^/]+/Watch/[^/]+)$", 1).alias("file")


def bad_file_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = csv_files.bad_files(_bad_watch(spark, sf_dir))
    return report.select(_below_root(csv_files.SOURCE_FILE), "total_rows", "bad_rows")


def bad_row_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = csv_files.quarantined_rows(_bad_watch(spark, sf_dir))
    return rows.select(_below_root(csv_files.SOURCE_FILE), "record")


def dataset_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of the curated tables after loading a chosen few datasets."""
    root, target = exports.fresh_root(spark, "some"), storage.scratch_path(spark, "target")
    for log in ("battery", "calls", "screen"):
        exports.export_phone(spark, sf_dir, root, log)
    exports.export_watch(spark, sf_dir, root)
    written = ingest.ingest(spark, root, target, " aware:battery, Watch,aware:SCREEN,oura ")
    counts = [
        tables.read_table(spark, target, name).agg(
            F.lit(name).alias("table_name"), F.count("*").alias("rows")
        )
        for name in written
    ]
    return csv_files.union_by_name(counts)


def rename_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename.sanitized_keys(cohort.page_names(spark, sf_dir))


def rename_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename.rename_plan(cohort.file_keys(spark, sf_dir))


# ---------------------------------------------------------------------------
# Preparation, folds, metrics
# ---------------------------------------------------------------------------


def _written_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return storage.materialize(features_merged(spark, sf_dir), "features")


def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _written_features(spark, sf_dir)
    return prepare.MedianFill.fit(rows, schemas.FEATURES).transform(rows)


def scale_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _written_features(spark, sf_dir)
    scaled = prepare.Standardize.fit(rows, schemas.FEATURES).transform(rows)
    return scaled.select("participant", *[F.round(c, 6).alias(c) for c in schemas.FEATURES])


def stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cohort.table(spark, sf_dir, "labels").select("doc_id", "quality")
    return folds.stratified_folds(rows, "quality", "doc_id")


def class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.class_distribution(cohort.table(spark, sf_dir, "labels"), "quality")


def fold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.fold_metrics(cohort.predictions(spark, sf_dir))


def fold_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.fold_auc(cohort.predictions(spark, sf_dir))


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.metric_summary(metrics.all_metrics(cohort.predictions(spark, sf_dir)))


def metric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = _summary(spark, sf_dir)
    return summary.select(
        "model", *[F.round(c, 9).alias(c) for c in summary.columns if c != "model"]
    )


def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.rounded(metrics.leaderboard(_summary(spark, sf_dir), ["O", "F"]))


# ---------------------------------------------------------------------------
# Importance and models
# ---------------------------------------------------------------------------


def importance_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as CSV, read back, then the first fifteen."""
    path = storage.scratch_path(spark, "importance")
    tables.write_csv(cohort.brand_importance(spark, sf_dir, "p_retailprice"), path)
    back = spark.read.schema("feature string, importance double").option("header", True).csv(path)
    return importance.top_features(back, 15)


def importance_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = cohort.brand_importance(spark, sf_dir, "p_retailprice")
    right = cohort.brand_importance(spark, sf_dir, "p_size")
    return importance.compare_importance(left, right, 10)


def _written_model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return storage.materialize(model_table_raw(spark, sf_dir), "model-table")


def _cross_validation(spec: models.ModelSpec):
    """A fit at the published settings in every fold; what SQL can check of its predictions."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = _written_model_table(spark, sf_dir)
        predictions = evaluate.held_out_predictions(table, [spec], schemas.FEATURES)
        return evaluate.prediction_audit(storage.materialize(predictions, "predictions"))

    return run


def _importance(spec: models.ModelSpec):
    """A fit at the published settings on all rows; what SQL can check of its importances."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = evaluate.fitted_importance(_written_model_table(spark, sf_dir), spec)
        found = storage.materialize(found, "importance")
        whole = found.agg(F.sum("importance")).first()[0]
        return found.select(
            "feature",
            F.col("importance").between(0, 1).alias("in_range"),
            F.lit(abs((whole or 0) - 1) < 1e-6).alias("sums_to_one"),
        )

    return run


def _planted(spec: models.ModelSpec):
    """A label made of two ring averages, learned from the features: is it found again?"""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = _written_model_table(spark, sf_dir)
        steps, sleep = list(schemas.RING_AVERAGES.values())[:2]
        whole = table.where(f"{steps} IS NOT NULL AND {sleep} IS NOT NULL")
        middle = medians.exact_medians(whole, {"both": f"{steps} + {sleep}"})["both"]
        planted = whole.withColumn(
            schemas.LABEL_BINARY, (F.col(steps) + F.col(sleep) > middle).cast("int")
        )
        predictions = evaluate.held_out_predictions(planted, [spec], schemas.FEATURES)
        area = metrics.fold_auc(storage.materialize(predictions, "predictions"))
        return area.select("model", "fold", (F.col("roc_auc") > 0.9).alias("found"))

    return run


def kernel_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far both kernel maps are from the kernel, on scaled features: which is closer?"""
    filled = prepare.MedianFill.fit(_written_features(spark, sf_dir), schemas.FEATURES)
    rows = filled.transform(_written_features(spark, sf_dir))
    columns = [c for c in schemas.FEATURES if c not in filled.empty]
    vectors = models.assemble(prepare.Standardize.fit(rows, columns).transform(rows), columns)
    held = storage.materialize(vectors.select(models.VECTOR), "kernel-rows")
    errors = {}
    for name in ("fourier", "landmarks"):
        spec = models.KERNEL_MACHINE.with_settings(map=name)
        mapping = models.kernel_map(held, spec, len(columns))
        errors[name] = models.kernel_error(held, mapping, len(columns))
    found = [(name, error < 0.1, error == min(errors.values())) for name, error in errors.items()]
    return spark.createDataFrame(found, "map string, small boolean, closest boolean")


def median_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians of columns far larger than what is taken for narrow."""
    columns = ("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount")
    lines = cohort.table(spark, sf_dir, "lineitem")
    found = medians.exact_medians(lines, {c: c for c in columns}, small=1000)
    return spark.createDataFrame(list(found.items()), "column string, median double")


def fold_metrics_undefined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of predictions some of which have no score, one fold none at all."""
    rows = cohort.predictions(spark, sf_dir)
    nothing = (F.col("fold") == 3) | (F.round(F.col("score") * 50) % 7 == 0)
    value = F.when(F.col("fold") == 3, F.lit(float("nan"))).when(~nothing, F.col("score"))
    return metrics.all_metrics(rows.withColumn("score", value))


def labels_repeated_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every answer twice, once with another text, some of which have no score."""
    long = cohort.surveys_long(spark, sf_dir)
    other = F.when(F.length("file_stem") % 3 == 0, F.lit("maybe")).when(
        F.length("participant") % 2 == 0, F.lit("Rarely")
    )
    again = long.withColumn("response_raw", F.coalesce(other, F.col("response_raw")))
    return labels.participant_labels(long.unionByName(again))


def model_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filled model table, written under its declared schema and read back."""
    root = storage.scratch_path(spark, "results")
    return results.write_result(model_table_filled(spark, sf_dir), root, "model_table_filled")


def results_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table that the evaluation writes."""
    root = storage.scratch_path(spark, "results")
    written = results.write_results(
        cohort.logs(spark, sf_dir), participant_labels(spark, sf_dir), root
    )
    counts = []
    for name in written:
        if name in schemas.RESULT_DDL:
            table = results.read_result(spark, root, name)
        else:
            table = spark.read.option("header", True).csv(f"{root}/{name}")
        counts.append(table.agg(F.lit(name).alias("table_name"), F.count("*").alias("rows")))
    return csv_files.union_by_name(counts)


def csv_mixed_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exports with headers in other letter case, `.CSV` suffixes and a header that is no text,

    loaded whole and then again for two participant folders only."""
    root, target = exports.fresh_root(spark, "mixed"), storage.scratch_path(spark, "target")
    exports.export_watch(spark, sf_dir, root, odd=True)
    ingest.ingest(spark, root, target, "watch")
    ingest.ingest(
        spark, root, target, "watch", participants=["Participant_3", "Participant_4"]
    )
    rows = spark.read.parquet(f"{target}/watch").select("participant_id", "participant", "hrm")
    listed = spark.read.parquet(f"{target}/quarantine/files/watch")
    folder = F.regexp_extract("path", "/(Participant_[^/]+)/Watch/", 1)
    failed = listed.select(
        folder.alias("participant_id"),
        F.lit("unreadable").alias("participant"),
        F.lit(None).cast("double").alias("hrm"),
    )
    return rows.unionByName(failed)


def reload_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load of everything, a new one of two folders with half their rows, and one that fails."""
    root, target = exports.fresh_root(spark, "reload"), storage.scratch_path(spark, "target")
    exports.export_watch(spark, sf_dir, root)
    ingest.ingest(spark, root, target, "watch")
    some = "participant % 40 IN (5, 6)"
    exports.export_watch(spark, sf_dir, root, only=f"{some} AND event_id % 2 = 0")
    ingest.ingest(spark, root, target, "watch", participants=["Participant_5", "Participant_6"])
    exports.export_watch(spark, sf_dir, root, with_bad=True, only="event_id % 50 = 0")
    for people in (["Participant_7", "Participant_8"], None):
        try:
            ingest.ingest(spark, root, target, "watch", participants=people, on_bad="fail")
        except Exception:  # the old table stays
            continue
        raise AssertionError("malformed records must fail this load")
    rows = spark.read.parquet(f"{target}/watch")
    return rows.select("participant_id", "participant", "timestamp", "hrm")


def append_changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three appends: some rows, all rows in the same and in further files, and nothing new."""
    root, target = exports.fresh_root(spark, "append"), storage.scratch_path(spark, "target")
    for only in ("event_id % 3 = 0 AND participant % 40 < 25", "true", None):
        if only:
            exports.export_phone(spark, sf_dir, root, "battery", only)
        ingest.ingest(spark, root, target, "aware:battery", write_mode="append")
    rows = tables.read_table(spark, target, "aware_battery")
    return rows.select(
        "participant_id", "participant", "timestamp", "battery_charge_start", "battery_charge_end"
    )


def file_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ledger says of the loaded files: rows and malformed rows."""
    root, target = exports.fresh_root(spark, "ledger"), storage.scratch_path(spark, "target")
    exports.export_watch(spark, sf_dir, root, with_bad=True)
    ingest.ingest(spark, root, target, "watch")
    held = tables.held_table(spark, ingest.file_ledger_path(target, "watch"), ingest.FILE_LEDGER)
    return held.select(_below_root("path"), "rows", "bad_rows")


def cast_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many texts the declared types of the watch table turned into NULL, by file."""
    root, target = exports.fresh_root(spark, "casts"), storage.scratch_path(spark, "target")
    exports.export_watch(spark, sf_dir, root, unfit=True)
    ingest.ingest(spark, root, target, "watch")
    held = spark.read.parquet(ingest.cast_ledger_path(target, "watch"))
    return held.select(_below_root(csv_files.SOURCE_FILE), "column", "lost")


def features_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features carried on from load to load: new files, changed files, nothing new."""
    root, target = exports.fresh_root(spark, "states"), storage.scratch_path(spark, "target")
    for only in ("event_id % 3 = 0 AND participant % 40 < 25", "event_id % 3 < 2", "true", None):
        if only:
            exports.export_phone(spark, sf_dir, root, "battery", only)
        ingest.ingest(spark, root, target, "aware:battery", write_mode="append")
        states.update_states(spark, target, "battery")
    return states.features(spark, target, "battery")


def _bucketed(rows: DataFrame, name: str, buckets: int) -> DataFrame:
    path = storage.scratch_path(rows.sparkSession, f"bucketed-{name}")
    return tables.save_bucketed(rows, path.rsplit("/", 1)[-1].replace("-", "_"), path, buckets=buckets)


def features_bucketed(spark: SparkSession, sf_dir: str, buckets: int = 8) -> DataFrame:
    """All modalities from tables that are bucketed by participant: no exchange."""
    held = {m: _bucketed(rows, m, buckets) for m, rows in cohort.logs(spark, sf_dir).items()}
    people = [rows.select(features.KEY).where(F.col(features.KEY).isNotNull()) for rows in held.values()]
    spine = _bucketed(csv_files.union_by_name(people).distinct(), "people", buckets)
    parts = [features.modality_features(rows, m) for m, rows in held.items()]
    return assemble.spine_join(spine, parts)


QUERIES = {
    "survey_unpivot": survey_unpivot,
    "survey_latest_ties": survey_latest_ties,
    "survey_latest_one": survey_latest_one,
    "survey_pivot_first": survey_pivot_first,
    "survey_map_reverse": survey_map_reverse,
    "survey_total_complete": survey_total_complete,
    "survey_median_split": survey_median_split,
    "participant_labels": participant_labels,
    "participant_labels_ties": participant_labels_ties,
    "battery_features": _modality("battery"),
    "call_features": _modality("calls"),
    "message_features": _modality("messages"),
    "notification_features": _modality("notifications"),
    "screen_features": _modality("screen"),
    "ring_features": _modality("ring"),
    "phone_outer_chain": phone_outer_chain,
    "phone_ring_outer": phone_ring_outer,
    "features_merged": features_merged,
    "features_single_shuffle": features_single_shuffle,
    "features_labelled": features_labelled,
    "model_table_raw": model_table_raw,
    "model_table_filled": model_table_filled,
    "csv_ingest_metadata": csv_ingest_metadata,
    "csv_phone_ingest": csv_phone_ingest,
    "csv_watch_ingest": csv_watch_ingest,
    "csv_union_by_name": csv_union_by_name,
    "csv_survey_ingest": csv_survey_ingest,
    "ring_cast": ring_cast,
    "parquet_roundtrip": parquet_roundtrip,
    "table_sql_read": table_sql_read,
    "bad_file_quarantine": bad_file_quarantine,
    "bad_row_quarantine": bad_row_quarantine,
    "dataset_selection": dataset_selection,
    "rename_sanitize": rename_sanitize,
    "rename_plan": rename_plan,
    "impute_median": impute_median,
    "scale_standard": scale_standard,
    "stratified_folds": stratified_folds,
    "class_distribution": class_distribution,
    "fold_metrics": fold_metrics,
    "fold_auc": fold_auc,
    "metric_summary": metric_summary,
    "leaderboard": leaderboard,
    "importance_topk": importance_topk,
    "importance_compare": importance_compare,
    "median_large": median_large,
    "fold_metrics_undefined": fold_metrics_undefined,
    "labels_repeated_answers": labels_repeated_answers,
    "model_table_roundtrip": model_table_roundtrip,
    "csv_mixed_ingest": csv_mixed_ingest,
    "reload_subset": reload_subset,
    "append_changed_files": append_changed_files,
    "file_ledger": file_ledger,
    "cast_ledger": cast_ledger,
    "features_from_states": features_from_states,
    "features_bucketed": features_bucketed,
    "results_written": results_written,
    "kernel_errors": kernel_errors,
    "planted_auc": _planted(models.KERNEL_MACHINE),
    "planted_forest": _planted(models.FOREST),
    "planted_boosted": _planted(models.BOOSTED),
    "planted_network": _planted(models.NETWORK),
    "cv_random_forest": _cross_validation(models.FOREST),
    "cv_gbt": _cross_validation(models.BOOSTED),
    "cv_rbf_svm": _cross_validation(models.KERNEL_MACHINE),
    "cv_mlp": _cross_validation(models.NETWORK),
    "rf_importance": _importance(models.FOREST),
    "gbt_importance": _importance(models.BOOSTED),
}
