"""Participant folders of CSV files, written by tasks from derived rows."""

from __future__ import annotations

import csv
import io

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.session import ship_package
from cohortloom.sources.files import resolve
from cohortloom.sources.storage import scratch_path
from cohortloom.workload import cohort

ROWS_PER_FILE = 20_000
FOLDERS = 40


def write_exports(rows: DataFrame, root: str) -> None:
    """Write the rows to `root/<path>`, one CSV file per distinct `path`.

    `header` lists the columns a file carries, in its order. A path names a slice of at
    most ROWS_PER_FILE source rows, so a task holds one small file at a time; a retried
    task rewrites the same file.
    """
    ship_package(rows.sparkSession)
    data = [c for c in rows.columns if c not in ("path", "header")]
    rows = rows.select("path", "header", *[F.col(c).cast("string").alias(c) for c in data])

    def write(group: pd.DataFrame) -> pd.DataFrame:
        columns = group["header"].iloc[0].split(",")
        text = io.StringIO()
        writer = csv.writer(text, lineterminator="\n")
        writer.writerow(columns)
        known = {c.lower(): c for c in group.columns}  # headers may differ in letter case
        fields = [known[c.lower()] for c in columns]
        body = group.sort_values(fields)[fields].astype(object)
        body = body.where(body.notna(), "")
        extra = group.loc[body.index, "extra"] if "extra" in group.columns else None
        for i, values in enumerate(body.itertuples(index=False, name=None)):
            surplus = [] if extra is None or pd.isna(extra.iloc[i]) else [extra.iloc[i]]
            writer.writerow([*values, *surplus])
        system, location = resolve(f"{root}/{group['path'].iloc[0]}", {})
        system.create_dir(location.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(location) as stream:
            stream.write(text.getvalue().encode())
        return pd.DataFrame({"rows": [len(group)]})

    rows.groupBy("path").applyInPandas(write, "rows bigint").agg(F.sum("rows")).collect()


def _folder(number: Column, name: str) -> Column:
    return F.concat(F.lit("Participant_"), cohort.text(number % FOLDERS), F.lit(f"/{name}/"))


def _slice(number: Column) -> Column:
    return cohort.text(F.floor(number / ROWS_PER_FILE))


def export_phone(
    spark: SparkSession, sf_dir: str, root: str, log: str, only: str = "true"
) -> None:
    """`Participant_n/Aware/<log>_<slice>.csv`; headers differ between folders.

    `only` is a condition on the rows that are exported, in SQL.
    """
    rows = cohort.phone_log(spark, sf_dir, log).where(only)
    user = F.col("participant").cast("bigint")
    measures = [c for c in rows.columns if c not in ("event_id", "timestamp", "participant")]
    plain = ",".join(["timestamp", "participant", *measures])
    turned = ",".join([*measures, "participant", "timestamp"])
    noted = ",".join(["timestamp", "participant", *measures, "note"])
    if log == "calls":  # these exports do not name the participant
        plain, turned, noted = (h.replace("participant,", "") for h in (plain, turned, noted))
    header = F.when(user % FOLDERS % 4 == 0, F.lit(noted)).when(
        user % FOLDERS % 5 == 0, F.lit(turned)
    )
    write_exports(
        rows.select(
            F.concat(
                _folder(user, "Aware"), F.lit(f"{log}_"), _slice(F.col("event_id")), F.lit(".csv")
            ).alias("path"),
            F.coalesce(header, F.lit(plain)).alias("header"),
            "timestamp",
            "participant",
            *measures,
            F.concat(F.lit("n, "), cohort.text(F.col("event_id") % 3)).alias("note"),
        ),
        root,
    )


def export_watch(
    spark: SparkSession,
    sf_dir: str,
    root: str,
    with_bad: bool = False,
    odd: bool = False,
    unfit: bool = False,
    only: str = "true",
) -> None:
    """`Participant_n/Watch/<name>` with spaces, plus signs and upper-case suffixes.

    With `with_bad`, every fiftieth event carries a cell too many. With `odd`, headers of
    some folders are in other letter case, and folder 3 has a file whose header is no text.
    With `unfit`, some measures are text or blank. `only` is a condition on the rows, in SQL.
    """
    rows = cohort.watch(spark, sf_dir).where(only)
    if unfit:
        event = F.col("event_id")
        rows = rows.withColumns(
            {
                "hrm": F.when(event % 7 == 0, F.lit("n/a")).otherwise(cohort.text("hrm")),
                "accx": F.when(event % 5 == 0, F.lit(" ")).otherwise(cohort.text("accx")),
                "accy": F.when(event % 11 == 0, F.lit("off")).otherwise(cohort.text("accy")),
            }
        )
    user = F.col("participant").cast("bigint")
    name = (
        F.when(user % 3 == 0, F.lit("heart rate + motion "))
        .when(user % 3 == 1, F.lit("sensor[1]_"))
        .otherwise(F.lit("watch_"))
    )
    suffix = F.when(user % 3 == 2, F.lit(".CSV")).otherwise(F.lit(".csv"))
    bad = F.when(F.col("event_id") % 50 == 0, F.lit("surplus"))
    plain = F.lit("timestamp,participant,hrm,accx,accy,accz")
    header = plain
    if odd:
        case = user % FOLDERS % 3
        header = F.when(case == 1, F.lit("Timestamp,Participant,HRM,accx,accy,accz"))
        header = F.coalesce(header.when(case == 2, F.upper(plain)), plain)
        system, location = resolve(f"{root}/Participant_3/Watch/broken.csv", {})
        system.create_dir(location.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(location) as stream:
            stream.write(b"timestamp,\xff\xfe,hrm\n1,2,3\n")
    write_exports(
        rows.select(
            F.concat(_folder(user, "Watch"), name, _slice(F.col("event_id")), suffix).alias("path"),
            header.alias("header"),
            "timestamp",
            "participant",
            "hrm",
            "accx",
            "accy",
            "accz",
            *([bad.alias("extra")] if with_bad else []),
        ),
        root,
    )


def export_surveys(spark: SparkSession, sf_dir: str, root: str) -> None:
    """`Participant_n/Surveys/<kind> <slice>.csv`; two questionnaires, different spellings."""
    rows = cohort.surveys_wide(spark, sf_dir)
    person = F.col("participant").cast("bigint")
    order = F.regexp_extract("file_stem", r"_(\d+)$", 1).cast("bigint")
    is_ucla = F.col("file_stem").like("%UCLA%")
    kind = F.when(is_ucla, F.lit("UCLA form ")).otherwise(F.lit("PHQ_"))
    write_exports(
        rows.select(
            F.concat(_folder(person, "Surveys"), kind, _slice(order), F.lit(".csv")).alias("path"),
            F.when(is_ucla, F.lit("participant,date,timestamp,q1,q2,q3,q4"))
            .otherwise(F.lit("participant,Date,Timestamp,Q1,Q2,Q3,Q4,comment"))
            .alias("header"),
            "participant",
            "date",
            "timestamp",
            *cohort.QUESTIONS,
            F.lit("free, text").alias("comment"),
        ),
        root,
    )


def fresh_root(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"exports-{name}")
