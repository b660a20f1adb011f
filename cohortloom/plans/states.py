"""Feature states of the curated tables, brought up to date load by load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom import schemas
from cohortloom.functions import paths
from cohortloom.operators import states
from cohortloom.operators.features import KEY
from cohortloom.plans import ingest
from cohortloom.sources import tables
from cohortloom.sources.csv_files import SOURCE_FILE

MODIFIED = "modified"
KEYS = [SOURCE_FILE, MODIFIED]  # a file as it was when it was loaded


def curated_of(modality: str) -> str:
    return "oura" if modality == "ring" else f"aware_{modality}"


def states_path(root: str, modality: str) -> str:
    return f"{root.rstrip('/')}/states/{modality}"


def _state_schema(modality: str) -> str:
    sums = ", ".join(
        f"sum_{c} double, count_{c} bigint" for c in states.sources(modality)
    )
    whole = f"{KEY} string, {SOURCE_FILE} string, {states.ROWS} bigint"
    return f"{whole}{', ' + sums if sums else ''}, {MODIFIED} timestamp, {tables.PARTITION} string"


def update_states(spark: SparkSession, root: str, modality: str) -> int:
    """Make the states of the files that were loaded since the last call; how many files.

    What the ledger names, and the states don't hold as it is now, is read from the curated
    table, by participant and file: other partitions aren't touched. States of a file that has
    changed are replaced, those of a file that the ledger no longer names are removed. The old
    states can be read until the new ones are complete.
    """
    root, table = root.rstrip("/"), curated_of(modality)
    ledger = tables.held_table(spark, ingest.file_ledger_path(root, table), ingest.FILE_LEDGER)
    if ledger is None:
        return 0
    path = states_path(root, modality)
    tables.recover_table(spark, path)
    named = ledger.where("rows > 0").select(
        F.col("path").alias(SOURCE_FILE),
        MODIFIED,
        paths.participant_id(F.col("path")).alias(tables.PARTITION),
    )
    held = tables.held_table(spark, path, _state_schema(modality))
    fresh, gone = named, None
    if held is not None:
        known = held.select(*KEYS).distinct()
        fresh = named.join(known, KEYS, "left_anti")
        gone = known.join(named, KEYS, "left_anti").count()
    n = fresh.count()
    if not n and not gone:
        return 0
    schema = schemas.curated(table)
    rows = spark.read.schema(schema).parquet(f"{root}/{tables.location(table)}")
    found = rows.join(fresh, [tables.PARTITION, SOURCE_FILE])  # reads their partitions only
    new = states.feature_states(found, modality, [*KEYS, tables.PARTITION])
    if gone:
        kept = held.join(named, KEYS, "left_semi")
        tables.replace_table(kept.unionByName(new), path, [tables.PARTITION])
    else:
        tables.write_parquet(new, path, "append", [tables.PARTITION])
    return n


def features(spark: SparkSession, root: str, modality: str) -> DataFrame:
    """Features of a modality from its states; equal to those of all rows of the table."""
    held = spark.read.schema(_state_schema(modality)).parquet(states_path(root, modality))
    return states.finish_features(held, modality)
