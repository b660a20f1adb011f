"""Conversions from raw text and small numeric expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(value: Column) -> Column:
    """Double, or NULL for text that is not a number and for NaN."""
    return F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))


def number_sql(column: str) -> str:
    """`number` of a named column as SQL text, for generated lists of many columns."""
    return f"nanvl(try_cast(`{column}` AS double), CAST(NULL AS double))"


def event_time(value: Column) -> Column:
    """Timestamp of a text in one of the declared shapes, else NULL.

    A date with or without a time of day (ISO), eight digits as yyyyMMdd, or an epoch in
    seconds, milliseconds, microseconds or nanoseconds, told apart by magnitude (seconds
    below 1e11, and a thousandfold for each further unit). A time of day alone is no instant.
    """
    text = F.trim(value.cast("string"))
    day = F.when(text.rlike(r"^\d{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd")))
    epoch = F.when(
        text.rlike(r"^-?\d+(\.\d+)?$") & ~text.rlike(r"^\d{8}$"), text.try_cast("double")
    )
    size = F.abs(epoch)
    micros = (
        F.when(size < 1e11, epoch * 1e6)
        .when(size < 1e14, epoch * 1e3)
        .when(size < 1e17, epoch)
        .when(size < 1e20, epoch / 1e3)
    )
    iso = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}([ T]|$)"), text.try_cast("timestamp"))
    return F.coalesce(day, F.timestamp_micros(micros.cast("bigint")), iso)


def answered(value: Column) -> Column:
    """True for a response that is neither NULL nor only spaces."""
    return value.isNotNull() & (F.trim(value) != "")


def response_score(
    response: Column, scores: Mapping[str, int], normalize: bool = False
) -> Column:
    """Score of a text response, NULL when the text is not in `scores`.

    The match is exact; `normalize` trims and lower-cases both sides first.
    """
    table = {k.strip().lower(): v for k, v in scores.items()} if normalize else dict(scores)
    text = F.lower(F.trim(response)) if normalize else response
    entries = [F.lit(part) for pair in table.items() for part in pair]
    return F.try_element_at(F.create_map(*entries), text)


def reversed_score(score: Column, lowest: int, highest: int) -> Column:
    return F.lit(lowest + highest) - score


def strict_sum(columns: Iterable[Column]) -> Column:
    """Row-wise sum that is NULL when any part is NULL."""
    return reduce(lambda left, right: left + right, columns)
