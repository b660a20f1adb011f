"""Feature states: sums and counts that are merged instead of read again.

A mean can't be carried on from load to load, the sum and the number of its values can. A state
row holds them for one participant and one file, so loads add rows, a file that has changed
replaces its own, and the features of all loads are a grouped sum over states.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.values import number_sql
from cohortloom.operators.features import KEY, PLAN

ROWS = "rows"


def sources(modality: str) -> list[str]:
    """Measures of a modality that any feature is made of."""
    return list(dict.fromkeys(f.source for f in PLAN[modality] if f.source))


def state_columns(modality: str) -> list[str]:
    return [ROWS, *[f"{part}_{c}" for c in sources(modality) for part in ("sum", "count")]]


def feature_states(df: DataFrame, modality: str, by: Sequence[str] = ()) -> DataFrame:
    """One row for each participant (and value of `by`): rows, and sum and count of each measure.

    A sum without values is NULL. Rows without a participant are left out.
    """
    parts = [F.count("*").alias(ROWS)]
    for c in sources(modality):
        parts.append(F.expr(f"sum({number_sql(c)}) AS sum_{c}"))
        parts.append(F.expr(f"count({number_sql(c)}) AS count_{c}"))
    return df.where(F.col(KEY).isNotNull()).groupBy(KEY, *by).agg(*parts)


def merge_states(states: DataFrame, modality: str, by: Sequence[str] = ()) -> DataFrame:
    """The states of fewer keys: sums of sums and of counts."""
    return states.groupBy(KEY, *by).agg(*[F.sum(c).alias(c) for c in state_columns(modality)])


def finish_features(states: DataFrame, modality: str) -> DataFrame:
    """The same rows as `features.modality_features` over all rows behind the states."""
    merged = merge_states(states, modality)
    features = []
    for f in PLAN[modality]:
        if f.kind == "rows":
            value = F.col(ROWS)
        elif f.kind == "total":
            value = F.col(f"sum_{f.source}")
        else:
            value = F.col(f"sum_{f.source}") / F.nullif(F.col(f"count_{f.source}"), F.lit(0))
        features.append(value.alias(f.name))
    return merged.select(KEY, *features)
