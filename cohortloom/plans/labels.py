"""Questionnaire answers to one labelled row per participant."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom import schemas
from cohortloom.functions import values
from cohortloom.operators import latest, reshape, scoring
from cohortloom.sources.storage import materialize

SUBMISSION = ("participant", "date", "timestamp", "file_name", "file_stem")
TIME_ORDER = ["__time", "__text"]
LABEL_COLUMNS = (*SUBMISSION, schemas.SCORE, schemas.LABEL, schemas.LABEL_BINARY)


def survey_rows(surveys: DataFrame, pattern: str = schemas.SURVEY_PATTERN) -> DataFrame:
    """Answers of the questionnaire whose file stem fits `pattern`."""
    return surveys.where(F.col("file_stem").like(pattern)).select(
        *SUBMISSION, "question_id", "response_raw"
    )


def time_order(raw: Column) -> dict[str, Column]:
    """Order columns of a raw time: the instant it names, else its text below all instants."""
    instant = values.event_time(raw)
    earliest = F.lit("0001-01-01").cast("timestamp")
    return {
        "__time": F.when(raw.isNotNull(), F.coalesce(instant, earliest)),
        "__text": F.when(instant.isNull(), raw).otherwise(F.lit("")),
    }


def participant_labels(
    surveys: DataFrame,
    questions: Sequence[str] | None = None,
    pattern: str = schemas.SURVEY_PATTERN,
    keep: str = "one",
    scores: Mapping[str, int] = schemas.RESPONSE_SCORES,
    reversed_items: Sequence[str] = schemas.REVERSED_ITEMS,
    normalize: bool = False,
    write_once: bool = True,
) -> DataFrame:
    """Score each participant's latest submission and split at the exact median.

    Without `questions` those that the questionnaire's answers name are used, found by one
    distinct of few values. Answers are folded map-side to one row per submission; of
    repeated answers to a question the first by text counts, whatever its score, and is then
    scored: an unknown text leaves the submission incomplete. Only submissions, not answers, then compete for being the latest. keep="ties" keeps
    every submission at the latest time. Incomplete submissions are not labelled.

    Both the median and the labels need the scores. `write_once` puts them, one row per
    participant, in the shared folder first, so that the answers are read only once.
    """
    rows = survey_rows(surveys, pattern).where(F.col("participant").isNotNull())
    if questions is None:
        found = rows.select("question_id").where("question_id IS NOT NULL").distinct().collect()
        questions = [row["question_id"] for row in found]
        if not questions:
            raise ValueError(f"no questions in questionnaires like {pattern}")
    questions = reshape.question_order(questions)
    first = {
        q: F.min(F.when(F.col("question_id") == q, F.col("response_raw"))).alias(q)
        for q in questions
    }
    submissions = (
        rows.groupBy(*SUBMISSION)
        .agg(*first.values())
        .withColumns({q: values.response_score(F.col(q), scores, normalize) for q in questions})
        .withColumns(time_order(F.col("timestamp")))
    )
    if keep == "one":
        newest = latest.latest_row(
            submissions, "participant", [*TIME_ORDER, "file_name", "file_stem", "date"]
        )
    elif keep == "ties":
        newest = latest.latest_per_key(submissions, "participant", TIME_ORDER)
    else:
        raise ValueError("keep must be 'one' or 'ties'")
    known = newest.dropna(how="any", subset=list(SUBMISSION))
    lowest, highest = min(scores.values()), max(scores.values())
    coded = scoring.reverse_code(known, reversed_items, lowest, highest)
    totals = scoring.total_score(coded, questions).select(*SUBMISSION, schemas.SCORE)
    if write_once:
        totals = materialize(totals, "scores")
    # a sum of bounded integers has few distinct values, so the median stays in the plan
    return scoring.median_split(totals, small_domain=True).select(*LABEL_COLUMNS)
