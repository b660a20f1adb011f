"""Questionnaires: wide to long and long to wide."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom import schemas
from cohortloom.functions import values

METADATA = (
    "participant_id",
    "participant",
    "source_file",
    "source_type_raw",
    "source_type",
    "file_name",
    "file_stem",
    *schemas.DATE_SPELLINGS,
    *schemas.TIME_SPELLINGS,
)


def question_pattern(any_q: bool = False) -> str:
    """Names of questions, in either letter case."""
    return r"(?i)^q" if any_q else r"(?i)^q\d+$"


def question_columns(columns: Iterable[str], any_q: bool = False) -> list[str]:
    """Question columns among `columns`: `q<digits>`, or with `any_q` every name

    that starts with q and is not metadata (either letter case)."""
    return [c for c in columns if c not in METADATA and re.match(question_pattern(any_q), c)]


def metadata_columns(columns: Iterable[str]) -> list[str]:
    return [c for c in columns if c in METADATA]


def question_order(names: Iterable[str]) -> list[str]:
    """Numbered questions by number, then any others by name: a total order."""

    def place(name: str):
        suffix = name[1:]
        return (0, int(suffix), name) if suffix.isdigit() else (1, 0, name)

    return sorted(names, key=place)


def unpivot_answers(
    df: DataFrame, ids: Sequence[str], questions: Sequence[str], keep_blank: bool = False
) -> DataFrame:
    """One row `(ids…, question_id, response_raw)` per answered question.

    Question ids are lower-cased so that `Q1` and `q1` are one item.
    """
    text = df.select(*ids, *[F.col(f"`{q}`").cast("string").alias(q) for q in questions])
    long = text.unpivot(list(ids), list(questions), "question_id", "response_raw")
    if not keep_blank:
        long = long.where(values.answered(F.col("response_raw")))
    return long.withColumn("question_id", F.lower("question_id"))


def pivot_first(
    df: DataFrame,
    keys: Sequence[str],
    question: str,
    value: str,
    questions: Sequence[str],
    order: Sequence[str] = (),
) -> DataFrame:
    """One row per key with a column per listed question.

    Of several answers the first non-null by (*`order`, value) is taken, so the pick
    never depends on row order. Rows with a NULL in any key are dropped. The question
    list is declared: no pass over the data finds it.
    """
    known = df.where(" and ".join(f"`{k}` is not null" for k in keys))
    present = F.col(value).isNotNull()

    def pick(name: str) -> Column:
        wanted = present & (F.col(question) == name)
        if not order:
            return F.min(F.when(wanted, F.col(value))).alias(name)
        first = F.min(F.when(wanted, F.struct(*order, value)))
        return first[value].alias(name)

    return known.groupBy(*keys).agg(*[pick(name) for name in questions])
