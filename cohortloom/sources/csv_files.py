"""CSV exports with differing headers, read as text cells in one scan."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.functions import paths
from cohortloom.session import ship_package
from cohortloom.sources.files import resolve
from cohortloom.sources.listing import escape_glob, few_listing_tasks

CORRUPT = "_corrupt_record"
MALFORMED = "_malformed"
SOURCE_FILE = "source_file"
ON_BAD = ("rows", "files", "fail")
HEADER_BYTES = 1 << 20  # a longer first line is no header
# What a scan sends to the executors, so that its size has a bound; more files make more scans
FILES_IN_A_SCAN = 50_000
PLACES_IN_A_SCAN = 8_000_000  # headers times columns
BLANK_LINES = re.compile(rb"(?:[ \t]*\r?\n)*")


@dataclass(frozen=True)
class HeaderGroup:
    """Files that share their columns, and their rows with every column as text."""

    columns: tuple[str, ...]
    paths: tuple[str, ...]
    scan: DataFrame  # columns + MALFORMED + CORRUPT + source_file


@dataclass(frozen=True)
class Records:
    """Records of files with any number of headers.

    `lines` has a row for each record: source_file, the number of its file's header, `names` and
    `cells` of its columns, MALFORMED and CORRUPT (the record as it stands, if it is malformed). `headers` are
    the columns of each header, `files` the paths that have it.
    """

    headers: tuple[tuple[str, ...], ...]
    files: tuple[tuple[str, ...], ...]
    lines: DataFrame
    columns: tuple[str, ...]

    def wide(
        self, rows: DataFrame, columns: Sequence[str], also: Sequence[str] = ()
    ) -> DataFrame:
        """`rows` of `lines` with a text column for each name; missing ones are NULL."""
        place = {name.lower(): k for k, name in enumerate(self.columns)}
        cells = [
            F.get("cells", F.get("places", F.lit(place[name.lower()]))).alias(name)
            for name in columns
        ]
        return rows.select(*cells, *also, MALFORMED, CORRUPT, SOURCE_FILE)

    @cached_property
    def scan(self) -> DataFrame:
        return self.wide(self.lines, self.columns)

    def __len__(self) -> int:
        return len(self.groups)

    def __getitem__(self, i: int) -> HeaderGroup:
        return self.groups[i]

    @cached_property
    def groups(self) -> list[HeaderGroup]:
        """The same records apart by columns; each group is a scan of its own when it is used."""
        numbers: dict[tuple[str, ...], list[int]] = {}
        for k, columns in enumerate(self.headers):
            numbers.setdefault(columns, []).append(k)
        return [
            HeaderGroup(
                columns,
                tuple(sorted(path for k in own for path in self.files[k])),
                self.wide(self.lines.where(F.col("header").isin(own)), columns),
            )
            for columns, own in sorted(numbers.items())
        ]


def _first_line(path: str, cache: dict) -> str | None:
    """First line of a file that isn't blank, reading no further than its end, or None.

    A file in which it does not end within HEADER_BYTES is reported as unreadable."""
    system, location = resolve(path, cache)
    line = b""
    with system.open_input_file(location) as stream:
        while b"\n" not in line:
            chunk = stream.read(16384)
            if not chunk:
                break
            line = (line + chunk).removeprefix(b"\xef\xbb\xbf")
            line = line[BLANK_LINES.match(line).end() :]
            if len(line) > HEADER_BYTES and b"\n" not in line:
                raise ValueError(f"no header within {HEADER_BYTES} bytes")
    return line.split(b"\n", 1)[0].decode("utf-8").rstrip("\r") or None


def _read_headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cache: dict = {}
    for batch in batches:
        headers, errors = [], []
        for path in batch["path"]:
            try:
                headers.append(_first_line(path, cache))
                errors.append(None)
            except Exception as error:  # one bad file must not stop the listing
                headers.append(None)
                errors.append(f"{type(error).__name__}: {error}")
        yield pd.DataFrame({"path": batch["path"], "header": headers, "error": errors})


def headers_of(files: DataFrame) -> DataFrame:
    """`(path, header, error)` per file, reading only the first line of each, on executors."""
    ship_package(files.sparkSession)
    slots = files.sparkSession.sparkContext.defaultParallelism
    return (
        files.select("path")
        .repartition(slots)
        .mapInPandas(_read_headers, "path string, header string, error string")
    )


def column_names(header: str, spellings: Iterable[str] = ()) -> tuple[str, ...]:
    """Column names of a header line; unnamed and repeated ones get their position.

    A name that differs from one of the `spellings` in letter case only takes the spelling.
    """
    exact = set(spellings)
    known: dict[str, str] = {}
    for name in spellings:
        known.setdefault(name.lower(), name)
    names = [
        name if name in exact else known.get(name.strip().lower(), name)
        for name in next(csv.reader([header]))
    ]
    folded = [name.lower() for name in names]
    return tuple(
        f"_c{i}" if not name else f"{name}{i}" if folded.count(name.lower()) > 1 else name
        for i, name in enumerate(names)
    )


def _kinds(spark: SparkSession, rows: dict[str, list], types: dict[str, pa.DataType]) -> DataFrame:
    """A small table that every executor gets."""
    return F.broadcast(
        spark.createDataFrame(pa.table({k: pa.array(v, types[k]) for k, v in rows.items()}))
    )


def _lines(
    spark: SparkSession,
    texts: Sequence[str],
    headers: Sequence[tuple[str, ...]],
    files: Sequence[tuple[str, ...]],
    numbers: Sequence[int],
    columns: Sequence[str],
    mode: str,
) -> DataFrame:
    """One scan over the files of the headers in `numbers`, parsed by their widths."""
    where = _kinds(
        spark,
        {
            "path": [path for k in numbers for path in files[k]],
            "header": [k for k in numbers for _ in files[k]],
        },
        {"path": pa.string(), "header": pa.int32()},
    )
    place = [{name.lower(): i for i, name in enumerate(headers[k])} for k in numbers]
    kinds = _kinds(
        spark,
        {
            "number": list(numbers),
            "first": [texts[k] for k in numbers],
            "width": [len(headers[k]) for k in numbers],
            "names": [list(headers[k]) for k in numbers],
            "places": [[own.get(name.lower()) for name in columns] for own in place],
        },
        {
            "number": pa.int32(),
            "first": pa.string(),
            "width": pa.int32(),
            "names": pa.list_(pa.string()),
            "places": pa.list_(pa.int32()),
        },
    )
    kinds = kinds.withColumn("first", F.xxhash64("first"))
    widths = sorted({len(headers[k]) for k in numbers})
    options = {"mode": mode, "columnNameOfCorruptRecord": CORRUPT}

    def parsed(width: int):
        fields = [T.StructField(f"c{i}", T.StringType()) for i in range(width)]
        schema = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
        return F.when(
            F.col("width") == width, F.from_csv("value", schema.simpleString(), options)
        ).alias(f"w{width}")

    def cells(width: int):
        own = F.array(*[F.col(f"w{width}.c{i}") for i in range(width)])
        return F.when(F.col("width") == width, own)

    with few_listing_tasks(spark):
        found = spark.read.text([escape_glob(path) for k in numbers for path in files[k]])
    return (
        found.select("value", paths.scanned_file().alias(SOURCE_FILE))
        .where(F.col("value").rlike(r"[^\x00-\x20]"))  # blank lines are no records
        .join(where, F.col(SOURCE_FILE) == where["path"])
        .join(F.broadcast(kinds), F.col("header") == kinds["number"])
        .where(F.xxhash64("value") != F.col("first"))  # nor is the header, also where it repeats
        .select(SOURCE_FILE, "header", "names", "places", "width", *[parsed(w) for w in widths])
        .select(
            SOURCE_FILE,
            "header",
            "names",
            "places",
            F.coalesce(*[cells(w) for w in widths]).alias("cells"),
            F.coalesce(*[F.col(f"w{w}.{CORRUPT}") for w in widths]).alias(CORRUPT),
        )
        .withColumn(MALFORMED, F.col(CORRUPT).isNotNull())
    )


def _portions(files: Sequence[tuple[str, ...]], width: int) -> Iterator[list[tuple[int, int, int]]]:
    """(header, first file, last file) of each scan: all in one, unless they pass the bounds."""
    most = max(1, PLACES_IN_A_SCAN // max(1, width))
    portion, held = [], 0
    for k, own in enumerate(files):
        for start in range(0, len(own), FILES_IN_A_SCAN):
            n = min(FILES_IN_A_SCAN, len(own) - start)
            if portion and (held + n > FILES_IN_A_SCAN or len(portion) >= most):
                yield portion
                portion, held = [], 0
            portion.append((k, start, start + n))
            held += n
    if portion:
        yield portion


def header_groups(
    files: DataFrame,
    on_bad: str = "rows",
    spellings: Iterable[str] = (),
    failed: list[tuple[str, str]] | None = None,
) -> Records:
    """Records of the listed files, whatever headers they have: one scan for all.

    The scan reads lines, a small table tells each file's header, and the CSV parser cuts a line
    into as many cells as its header has. A line that equals its file's header is no record.
    The table is broadcast: it names FILES_IN_A_SCAN files at most, further ones make another
    scan. The driver receives file names and header lines, partition by partition, which it needs
    for the scan's file index anyway, and no data. Names are brought to the declared
    `spellings` first. Files that cannot be opened, or whose header is no text, raise under
    `on_bad="fail"`, or when no file can be; otherwise they are appended to `failed` as
    (path, error), for the quarantine.
    """
    if on_bad not in ON_BAD:
        raise ValueError(f"on_bad must be one of {ON_BAD}")
    spellings = tuple(spellings)
    found: dict[str, list[str]] = {}
    failed, readable = [] if failed is None else failed, False
    for path, header, error in headers_of(files).toLocalIterator():
        if error is not None:
            failed.append((path, error))
            if on_bad == "fail":
                break
            continue
        readable = True
        if header is not None:
            found.setdefault(header, []).append(path)
    if failed and (on_bad == "fail" or not readable):
        raise OSError(f"cannot open {failed[0][0]}: {failed[0][1]}")
    texts = sorted(found)
    headers = tuple(column_names(text, spellings) for text in texts)
    own_files = tuple(tuple(sorted(set(found[text]))) for text in texts)
    columns: dict[str, str] = {}
    for header in sorted(headers):
        for name in header:
            columns.setdefault(name.lower(), name)
    mode = "FAILFAST" if on_bad == "fail" else "PERMISSIVE"
    spark = files.sparkSession
    scans = []
    for portion in _portions(own_files, len(columns)):
        part = {k: own_files[k][start:end] for k, start, end in portion}
        some = [part.get(k, ()) for k in range(len(texts))]
        names = tuple(columns.values())
        scans.append(_lines(spark, texts, headers, some, sorted(part), names, mode))
    lines = reduce(DataFrame.unionByName, scans) if scans else None
    return Records(headers, own_files, lines, tuple(columns.values()))


def unreadable(files: DataFrame) -> DataFrame:
    """`(path, error)` of listed files that cannot be opened."""
    return headers_of(files).where("error is not null").select("path", "error")


def _scanned(records: Records | Sequence[HeaderGroup]) -> DataFrame | None:
    """Rows with source file, flag and malformed record."""
    if not len(records):
        return None
    if isinstance(records, Records):
        return records.lines
    kept = [group.scan.select(SOURCE_FILE, MALFORMED, CORRUPT) for group in records]
    return reduce(DataFrame.unionByName, kept)


def bad_files(records: Records | Sequence[HeaderGroup]) -> DataFrame | None:
    """Quarantine report: rows and malformed rows of each file that has any malformed."""
    rows = _scanned(records)
    if rows is None:
        return None
    return (
        rows.groupBy(SOURCE_FILE)
        .agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(MALFORMED).alias("bad_rows"))
        .where("bad_rows > 0")
    )


def quarantined_rows(records: Records | Sequence[HeaderGroup]) -> DataFrame | None:
    """`(source_file, record)`: every malformed record as it stands in its file."""
    rows = _scanned(records)
    if rows is None:
        return None
    return rows.where(MALFORMED).select(SOURCE_FILE, F.col(CORRUPT).alias("record"))


def good_rows(records: Records | HeaderGroup, on_bad: str = "rows") -> DataFrame:
    """Rows of the files under a policy for malformed records.

    rows   leave out the malformed rows only (`quarantined_rows` holds them)
    files  leave out every file that holds a malformed row
    fail   the scan itself raises
    """
    rows = records.scan
    if on_bad == "files":
        bad = rows.where(MALFORMED).select(F.col(SOURCE_FILE).alias("bad_file")).distinct()
        rows = rows.join(bad, F.col(SOURCE_FILE) == F.col("bad_file"), "left_anti")
    if on_bad != "fail":
        rows = rows.where(~F.col(MALFORMED))
    return rows.drop(CORRUPT, MALFORMED)


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame | None:
    """UNION ALL by column name; a column missing from one side is NULL there."""
    frames = list(frames)
    if not frames:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_csv(
    files: DataFrame,
    on_bad: str = "rows",
    spellings: Iterable[str] = (),
    failed: list[tuple[str, str]] | None = None,
) -> DataFrame | None:
    """All listed CSV files as text columns plus `source_file`, or None without files.

    Unreadable files are appended to `failed`.
    """
    records = header_groups(files, on_bad, spellings, failed)
    return good_rows(records, on_bad) if len(records) else None
