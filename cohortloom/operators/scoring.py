"""From text answers to a total score and a binary label."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom import schemas
from cohortloom.functions import values
from cohortloom.operators.medians import exact_medians, small_domain_median


def map_responses(
    df: DataFrame,
    columns: Sequence[str],
    scores: Mapping[str, int] = schemas.RESPONSE_SCORES,
    normalize: bool = False,
) -> DataFrame:
    """Replace text answers by their scores; an unknown text becomes NULL."""
    return df.withColumns(
        {c: values.response_score(F.col(c), scores, normalize) for c in columns}
    )


def reverse_code(
    df: DataFrame,
    items: Sequence[str] = schemas.REVERSED_ITEMS,
    lowest: int = schemas.LOWEST_SCORE,
    highest: int = schemas.HIGHEST_SCORE,
) -> DataFrame:
    """`lowest + highest - x` for the listed items that exist in `df`."""
    present = [c for c in items if c in df.columns]
    return df.withColumns(
        {c: values.reversed_score(F.col(c), lowest, highest) for c in present}
    )


def total_score(
    df: DataFrame, items: Sequence[str], out: str = schemas.SCORE, complete_only: bool = True
) -> DataFrame:
    """Sum of the items, NULL when any is missing; by default only complete rows stay."""
    scored = df.withColumn(out, values.strict_sum(F.col(c) for c in items))
    return scored.where(F.col(out).isNotNull()) if complete_only else scored


def median_split(
    df: DataFrame,
    score: str = schemas.SCORE,
    label: str = schemas.LABEL,
    binary: str = schemas.LABEL_BINARY,
    high: str = schemas.LABEL_HIGH,
    low: str = schemas.LABEL_LOW,
    small_domain: bool = False,
) -> DataFrame:
    """Label a score: above the exact median is high / 1, at or below it low / 0.

    `small_domain` states that the score has few distinct values; the median is then
    a scalar subquery of the same plan. Otherwise it is computed up front.
    """
    if small_domain:
        median = small_domain_median(df, score).scalar()
    else:
        median = F.lit(exact_medians(df, {score: F.col(score)})[score])
    above = F.col(score) > median
    return df.withColumns(
        {
            label: F.when(above, F.lit(high)).otherwise(F.lit(low)),
            binary: F.when(above, F.lit(1)).otherwise(F.lit(0)),
        }
    )
