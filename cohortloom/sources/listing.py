"""Paths of participant folders and distributed file listings."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_SCHEMA = "path string, length bigint"
IDS_PER_GLOB = 1000


def escape_glob(path: str) -> str:
    """Literal form of a path whose name may hold glob characters."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def participant_globs(
    root: str, participants: Sequence[str] | None, tail: str
) -> list[str]:
    """Globs `root/{P1,P2,…}/tail`; every participant folder when none are named.

    Alternatives that do not exist match nothing, so a missing folder is skipped
    without a lookup of its own.
    """
    root = root.rstrip("/")
    if participants is None:
        return [f"{root}/Participant_*/{tail}"]
    names = [escape_glob(name) for name in participants]
    chunks = [names[i : i + IDS_PER_GLOB] for i in range(0, len(names), IDS_PER_GLOB)]
    return [f"{root}/{{{','.join(chunk)}}}/{tail}" for chunk in chunks]


def phone_globs(root: str, participants: Sequence[str] | None, log: str) -> list[str]:
    return participant_globs(root, participants, f"Aware/{log}*.[cC][sS][vV]")


def folder_globs(
    root: str, participants: Sequence[str] | None, folder: str | None = None
) -> list[str]:
    return participant_globs(root, participants, folder or "")


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Look up many paths in some tasks for each core instead of one for each path.

    What a task sends to the driver is otherwise several times the one file status in it. Paths
    are looked up when a reader is made, so that has to happen inside the block.
    """
    before = spark.conf.get(LISTING_TASKS)
    wanted = 8 * spark.sparkContext.defaultParallelism
    spark.conf.set(LISTING_TASKS, str(min(int(before), wanted)))
    try:
        yield
    finally:
        spark.conf.set(LISTING_TASKS, before)


def list_files(
    spark: SparkSession,
    globs: Iterable[str],
    name_pattern: str = r"(?i)\.csv$",
    modified: bool = False,
) -> DataFrame:
    """One row `(path, length)` per non-empty file below the globs that fits the pattern.

    `modified` adds the time of the last change. The file reader is asked for no content, so
    none is read.
    A glob that matches nothing contributes no rows.
    """
    found = []
    for glob in globs:
        try:
            with few_listing_tasks(spark):
                found.append(
                    spark.read.format("binaryFile").option("recursiveFileLookup", True).load(glob)
                )
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    columns = ["path", "length"]
    if modified:
        columns.append(F.col("modificationTime").alias("modified"))
    if not found:
        more = ", modified timestamp" if modified else ""
        return spark.createDataFrame([], LISTING_SCHEMA + more)
    listing = found[0].select(*columns)
    for more in found[1:]:
        listing = listing.unionByName(more.select(*columns))
    return listing.where(F.col("path").rlike(name_pattern))
