"""Participant folders of CSV exports to curated Parquet tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom import schemas
from cohortloom.functions import paths
from cohortloom.functions.values import answered, number
from cohortloom.operators import reshape
from cohortloom.sources import csv_files, listing, tables
from cohortloom.sources.csv_files import CORRUPT, MALFORMED, SOURCE_FILE
from cohortloom.sources.storage import scratch_path, scratch_scope

LOST = "_lost"  # columns of a row whose text did not fit the declared type
FLAGS = (LOST, MALFORMED, CORRUPT)

CASTS: dict[type, Callable[[Column], Column]] = {
    T.DoubleType: number,
    T.StringType: lambda c: c.cast("string"),
    T.LongType: lambda c: F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint")),
    T.BooleanType: lambda c: F.coalesce(c.try_cast("boolean"), (number(c) != 0)),
}


def cast_declared(df: DataFrame, schema: T.StructType, lost: str | None = None) -> DataFrame:
    """Declared columns that exist get their declared type in one projection.

    Text that does not fit a type becomes NULL; `lost` names a further column that lists the
    columns this happened to. Columns of text type are kept as they are, undeclared columns
    pass through.
    """
    types = {field.name: type(field.dataType) for field in schema}
    typed = {c: CASTS[types[c]](F.col(f"`{c}`")) for c in df.columns if c in types}
    columns = [typed[c].alias(c) if c in typed else F.col(f"`{c}`") for c in df.columns]
    if lost is None:
        return df.select(*columns)
    missed = [
        F.when(answered(F.col(f"`{c}`")) & value.isNull(), F.lit(c))
        for c, value in typed.items()
        if types[c] is not T.StringType
    ]
    names = F.array(*missed) if missed else F.array().cast("array<string>")
    return df.select(*columns, F.filter(names, lambda name: name.isNotNull()).alias(lost))


def cast_ring(df: DataFrame) -> DataFrame:
    """Ring exports: epoch timestamp, 69 numeric measures, series and ids kept as text."""
    return cast_declared(df, schemas.measures("oura"))


def with_provenance(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Add the columns derived from the source path, and the load time."""
    return df.withColumns(paths.provenance(F.col(csv_files.SOURCE_FILE), folder)).withColumn(
        "ingest_ts", F.current_timestamp()
    )


def with_participant(df: DataFrame) -> DataFrame:
    """`participant` from the export where it has one, else the suffix of the folder name."""
    suffix = F.regexp_replace("participant_id", "^Participant_", "")
    suffix = F.when(suffix != "", suffix)
    if "participant" in df.columns:
        suffix = F.coalesce(F.when(F.trim("participant") != "", F.col("participant")), suffix)
    return df.withColumn("participant", suffix)


def conform(df: DataFrame, schema: T.StructType, keep_extra: bool = False) -> DataFrame:
    """The declared columns, in order, missing ones as typed NULLs.

    `keep_extra` appends the columns an export carries beyond the declared ones.
    """
    have = {c.lower() for c in df.columns}
    declared = [
        F.col(f.name) if f.name.lower() in have else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    known = {f.name.lower() for f in schema}
    extra = [F.col(f"`{c}`") for c in df.columns if keep_extra and c.lower() not in known]
    return df.select(*declared, *extra)


def spellings(table: str) -> list[str]:
    """Column names that headers are brought to, whatever their letter case."""
    return [*reshape.METADATA, *[field.name for field in schemas.curated(table)]]


def staged_measures(
    files: DataFrame,
    table: str,
    on_bad: str = "rows",
    failed: list[tuple[str, str]] | None = None,
) -> DataFrame | None:
    """Records of the listed exports, typed, with provenance and the FLAGS of each.

    Malformed records are in it, marked: one parse serves the data and the quarantine.
    """
    records = csv_files.header_groups(files, on_bad, spellings(table), failed)
    if not len(records):
        return None
    typed = cast_declared(records.scan, schemas.measures(table), LOST)
    is_log = table.startswith("aware_")
    rows = with_participant(with_provenance(typed, folder="Aware" if is_log else None))
    if is_log:
        rows = rows.withColumn("aware_type", F.lit(table.removeprefix("aware_")))
    return rows


def let_through(staged: DataFrame, on_bad: str) -> DataFrame:
    """The rows of a staged frame that the policy for malformed records lets through."""
    rows = staged
    if on_bad == "files":
        bad = staged.where(MALFORMED).select(F.col(SOURCE_FILE).alias("bad_file")).distinct()
        rows = rows.join(bad, F.col(SOURCE_FILE) == F.col("bad_file"), "left_anti")
    return rows.where(~F.col(MALFORMED))


def good(staged: DataFrame | None, on_bad: str = "rows") -> DataFrame | None:
    """The data of a staged frame."""
    return None if staged is None else let_through(staged, on_bad).drop(*FLAGS)


def phone_log(
    spark: SparkSession,
    root: str,
    log: str,
    participants: Sequence[str] | None = None,
    on_bad: str = "rows",
    failed: list[tuple[str, str]] | None = None,
) -> DataFrame | None:
    """All exports of one phone log, typed, with provenance and `aware_type`."""
    files = listing.list_files(spark, listing.phone_globs(root, participants, log))
    return good(staged_measures(files, f"aware_{log}", on_bad, failed), on_bad)


def device_table(
    spark: SparkSession,
    root: str,
    table: str,
    folder: str,
    participants: Sequence[str] | None = None,
    on_bad: str = "rows",
    failed: list[tuple[str, str]] | None = None,
) -> DataFrame | None:
    """Ring or watch exports below `folder`, typed, with provenance."""
    files = listing.list_files(spark, listing.folder_globs(root, participants, folder))
    return good(staged_measures(files, table, on_bad, failed), on_bad)


def _first_present(spellings: Iterable[str], columns: Iterable[str]) -> Column:
    present = [F.col(c) for c in spellings if c in set(columns)]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def staged_surveys(
    files: DataFrame,
    on_bad: str = "rows",
    failed: list[tuple[str, str]] | None = None,
    any_q: bool = False,
) -> DataFrame | None:
    """Questionnaires to one row per answered question, and one per malformed record.

    A record is unpivoted on the names of its own header, so no row is widened to the
    questions of other questionnaires.
    """
    records = csv_files.header_groups(files, on_bad, reshape.METADATA, failed)
    if not any(reshape.question_columns(header, any_q) for header in records.headers):
        return None
    metadata = reshape.metadata_columns(records.columns)
    rows = records.wide(records.lines, metadata, ("names", "cells"))
    question = F.lit(reshape.question_pattern(any_q))
    nothing = F.array(F.struct(*[F.lit(None).cast("string").alias(n) for n in ("names", "cells")]))
    pairs = F.filter(
        F.arrays_zip("names", "cells"),
        lambda pair: F.regexp_like(pair["names"], question) & answered(pair["cells"]),
    )
    long = with_participant(with_provenance(rows)).withColumn(
        "pair", F.explode(F.when(F.col(MALFORMED), nothing).otherwise(pairs))
    )
    ids = reshape.metadata_columns(long.columns)
    named = long.withColumns(
        {
            "question_id": F.lower("pair.names"),
            "response_raw": F.col("pair.cells"),
            "date": _first_present(schemas.DATE_SPELLINGS, ids),
            "timestamp": _first_present(schemas.TIME_SPELLINGS, ids),
            "survey_source_file": F.col("file_name"),
            "survey_path": F.col(SOURCE_FILE),
            LOST: F.array().cast("array<string>"),
        }
    )
    declared = schemas.curated("surveys_long")
    kept = conform(named, T.StructType([*declared, *[named.schema[flag] for flag in FLAGS]]))
    return kept


def surveys_long(
    spark: SparkSession,
    root: str,
    participants: Sequence[str] | None = None,
    on_bad: str = "rows",
    any_q: bool = False,
    failed: list[tuple[str, str]] | None = None,
) -> DataFrame | None:
    """Questionnaires to one row per answered question."""
    files = listing.list_files(spark, listing.folder_globs(root, participants, "Surveys"))
    return good(staged_surveys(files, on_bad, failed, any_q), on_bad)


# ---------------------------------------------------------------------------
# Dataset selection and the whole job
# ---------------------------------------------------------------------------


def parse_datasets(text: str) -> set[str]:
    """Dataset names of a comma-separated list, trimmed and lower-cased."""
    return {item.strip().lower() for item in text.split(",")} - {""}


def selected(requested: set[str], dataset: str) -> bool:
    return "all" in requested or dataset.lower() in requested


@dataclass(frozen=True)
class Builder:
    """How the files of a dataset are found and parsed."""

    table: str
    globs: Callable[[str, Sequence[str] | None], list[str]]
    stage: Callable[[DataFrame, str, list[tuple[str, str]]], DataFrame | None]


def builders(any_q: bool = False) -> dict[str, Builder]:
    """Dataset name -> its builder, in run order."""

    def measures(table: str):
        return lambda files, on_bad, failed: staged_measures(files, table, on_bad, failed)

    def folder(name: str):
        return lambda root, participants: listing.folder_globs(root, participants, name)

    def logs(log: str):
        return lambda root, participants: listing.phone_globs(root, participants, log)

    found = {
        f"aware:{log}": Builder(f"aware_{log}", logs(log), measures(f"aware_{log}"))
        for log in schemas.PHONE_LOGS
    }
    found["oura"] = Builder("oura", folder("Oura"), measures("oura"))
    found["watch"] = Builder("watch", folder("Watch"), measures("watch"))
    found["surveys"] = Builder(
        "surveys_long", folder("Surveys"), partial(staged_surveys, any_q=any_q)
    )
    return found


# ---------------------------------------------------------------------------
# Ledgers: which files were loaded, and what casts lost
# ---------------------------------------------------------------------------

FILE_LEDGER = (
    "path string, length bigint, modified timestamp, rows bigint, bad_rows bigint,"
    " loaded_at timestamp"
)


def file_ledger_path(root: str, table: str) -> str:
    return f"{root}/ledger/files/{table}"


def cast_ledger_path(root: str, table: str) -> str:
    return f"{root}/ledger/casts/{table}"


def quarantine_path(root: str, table: str) -> str:
    return f"{root}/quarantine/{table}"


def cast_losses(loaded: DataFrame) -> DataFrame:
    """(source_file, column, lost): texts that a declared type turned into NULL, by file."""
    return (
        loaded.select(SOURCE_FILE, F.explode(LOST).alias("column"))
        .groupBy(SOURCE_FILE, "column")
        .agg(F.count("*").alias("lost"))
    )


def file_counts(files: DataFrame, staged: DataFrame, on_bad: str) -> DataFrame:
    """One ledger row for each listed file, also for those of which no rows were loaded."""
    file = F.col(SOURCE_FILE).alias("path")
    rows = let_through(staged, on_bad).groupBy(file).agg(F.count("*").alias("rows"))
    bad = staged.where(MALFORMED).groupBy(file).agg(F.count("*").alias("bad_rows"))
    none = F.lit(0).cast("bigint")
    return files.join(rows, "path", "left").join(bad, "path", "left").select(
        "path",
        "length",
        "modified",
        F.coalesce("rows", none).alias("rows"),
        F.coalesce("bad_rows", none).alias("bad_rows"),
        F.current_timestamp().alias("loaded_at"),
    )


def files_to_load(files: DataFrame, root: str, table: str) -> DataFrame:
    """The listed files that the ledger doesn't hold as they are now."""
    held = tables.held_table(files.sparkSession, file_ledger_path(root, table), FILE_LEDGER)
    if held is None:
        return files
    return files.join(held.select("path", "length", "modified"), ["path", "length", "modified"], "left_anti")


def _keep_report(
    rows: DataFrame, path: str, key: str, gone: DataFrame | None, participants: Sequence[str] | None
) -> None:
    """Replace the part of a report that a load has made anew.

    That is everything; or what concerns the files of `gone` (path) and all of `participants`.
    """
    if gone is not None:
        held = tables.held_table(rows.sparkSession, path, rows.schema)
        if held is not None:
            old = held.join(gone, F.col(key) == F.col("gone"), "left_anti")
            if participants is not None:
                owner = paths.participant_id(F.col(key))
                old = old.where(~owner.isin(*participants))
            rows = old.unionByName(rows)
    tables.replace_table(rows, path)


def _write_new_files(data: DataFrame, path: str) -> None:
    """Add rows to a table; those of files it already holds are replaced.

    Participants whose files are all new are appended. The partitions of the others are written
    anew, from the rows of other files and the new ones; Spark swaps them when the job commits.
    """
    spark = data.sparkSession
    keys = [tables.PARTITION, SOURCE_FILE]
    files = data.select(*keys).distinct()
    held = tables.held_table(spark, path, files.schema)
    again: list[str] = []
    if held is not None:
        found = held.join(files, keys, "left_semi").select(tables.PARTITION).distinct()
        again = [r[0] for r in found.collect()]
    if again:
        held = spark.read.option("mergeSchema", True).parquet(path)
        owner = F.col(tables.PARTITION)
        others = held.where(owner.isin(*again)).join(
            data.select(SOURCE_FILE).distinct(), SOURCE_FILE, "left_anti"
        )
        merged = others.unionByName(data.where(owner.isin(*again)), allowMissingColumns=True)
        tables.write_parquet(merged, path, "overwrite", [tables.PARTITION])
        data = data.where(~owner.isin(*again))
    tables.write_parquet(data, path, "append", [tables.PARTITION])


def write_curated(
    data: DataFrame,
    path: str,
    write_mode: str,
    participants: Sequence[str] | None = None,
    only_new: bool = True,
) -> None:
    """Write a written-aside frame to its table, by participant.

    An overwrite replaces the whole table, or the partitions of `participants`; in both cases
    the old rows can be read until the new ones are complete, and stay if writing fails.
    """
    spark = data.sparkSession
    split = [tables.PARTITION]
    if write_mode == "append" and only_new:
        _write_new_files(data, path)
    elif write_mode != "overwrite":
        tables.write_parquet(data, path, write_mode, split)
    elif participants is None:
        # without a row there is no partition, and the file that holds the schema is wanted
        tables.replace_table(data, path, () if data.isEmpty() else split)
    else:
        written = {r[0] for r in data.select(*split).distinct().collect()}
        tables.write_parquet(data, path, write_mode, split)
        tables.drop_partitions(spark, path, split[0], sorted(set(participants) - written))


def ingest(
    spark: SparkSession,
    source_root: str,
    target_root: str,
    datasets: str = "all",
    participants: Sequence[str] | None = None,
    write_mode: str = "overwrite",
    on_bad: str = "rows",
    dry_run: bool = False,
    quarantine: bool = True,
    any_q: bool = False,
    only_new: bool = True,
) -> list[str]:
    """Load the selected datasets; the names of the curated tables that were written.

    The exports of a dataset are parsed once, into the shared folder, and everything is written
    from there: the curated table, in a partition for each participant; the malformed records
    that the policy leaves out, as they stand, under `quarantine/<table>` (`quarantine=False`
    leaves them out); under `ledger/files/<table>` the files with the numbers of their rows; and
    under `ledger/casts/<table>`, by file and column, how many texts a declared type made NULL.

    An overwrite replaces the tables, or with `participants` the rows of these folders and no
    others. Old rows can be read until the new ones are complete. An append loads the files that
    the ledger doesn't hold as they are now; rows of a file that has changed are replaced, so
    repeating it changes nothing. `only_new=False` appends everything again. `any_q` takes every
    survey column that starts with q as a question, not only q with a number.

    A dataset without files is skipped. A dataset whose files hold no rows writes an empty
    table with the declared schema. Files that cannot be read are listed with the reason under
    `quarantine/files/<table>`, or raise under `on_bad="fail"`; they are tried again by the
    next append.
    """
    if write_mode not in tables.WRITE_MODES:
        raise ValueError(f"mode must be one of {tables.WRITE_MODES}")
    if participants is not None and not all(p.startswith("Participant_") for p in participants):
        raise ValueError("participant folders are called Participant_ and a name")
    requested = parse_datasets(datasets)
    target_root = target_root.rstrip("/")
    written = []
    for dataset, builder in builders(any_q).items():
        if not selected(requested, dataset):
            continue
        table, failed = builder.table, []
        path = f"{target_root}/{tables.location(table)}"
        places = [f(target_root, table) for f in (file_ledger_path, cast_ledger_path, quarantine_path)]
        for place in [] if dry_run else [path, *places]:
            tables.recover_table(spark, place)
        globs = builder.globs(source_root, participants)
        files = listing.list_files(spark, globs, modified=True)
        some = write_mode == "append" and only_new
        if some:
            files = files_to_load(files, target_root, table)
        staged = builder.stage(files, on_bad, failed)
        partly = some or participants is not None
        if failed and not dry_run:
            report = spark.createDataFrame(failed, "path string, error string")
            gone = report.select(F.col("path").alias("gone")) if partly else None
            unreadable = quarantine_path(target_root, f"files/{table}")
            _keep_report(report, unreadable, "path", gone, participants)
        if staged is None:
            continue
        written.append(table)
        if dry_run:
            continue
        with scratch_scope(spark):
            curated = conform(staged, schemas.curated(table), keep_extra=True)
            aside = scratch_path(spark, f"staged-{table}")
            curated.write.partitionBy(MALFORMED).parquet(aside)
            held = spark.read.schema(curated.schema).parquet(aside)
            loaded = files
            if failed:
                missed = spark.createDataFrame([path for path, _ in failed], "string")
                loaded = files.join(missed.toDF("path"), "path", "left_anti")
            data = good(held, on_bad)
            write_curated(data, path, write_mode, participants, only_new)
            gone = loaded.select(F.col("path").alias("gone")) if partly else None
            losses = cast_losses(let_through(held, on_bad))
            reports = [(losses, cast_ledger_path(target_root, table), SOURCE_FILE)]
            if quarantine and on_bad != "fail":
                malformed = held.where(MALFORMED).select(SOURCE_FILE, F.col(CORRUPT).alias("record"))
                reports.append((malformed, quarantine_path(target_root, table), SOURCE_FILE))
            # the file ledger last: until then the files count as not loaded
            counts = file_counts(loaded, held, on_bad)
            reports.append((counts, file_ledger_path(target_root, table), "path"))
            replaced = participants if write_mode == "overwrite" else None
            for report, place, key in reports:
                _keep_report(report, place, key, gone, replaced)
    return written
