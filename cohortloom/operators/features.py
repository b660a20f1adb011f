"""One feature row per participant and modality."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom import schemas
from cohortloom.functions.values import number_sql

KEY = "participant"


class Feature(NamedTuple):
    name: str
    kind: str  # mean | total | rows
    source: str | None = None


# features of each modality, in model-table order
PLAN: dict[str, tuple[Feature, ...]] = {
    "battery": (
        Feature("avg_battery_charge_start", "mean", "battery_charge_start"),
        Feature("avg_battery_charge_end", "mean", "battery_charge_end"),
        Feature("battery_event_count", "rows"),
    ),
    "calls": (
        Feature("total_calls", "rows"),
        Feature("avg_call_duration", "mean", "dur"),
        Feature("total_call_duration", "total", "dur"),
        Feature("avg_call_type", "mean", "type"),
    ),
    "messages": (
        Feature("total_messages", "rows"),
        Feature("avg_message_type", "mean", "message_type"),
    ),
    "notifications": (Feature("total_notifications", "rows"),),
    "screen": (
        Feature("total_screen_events", "rows"),
        Feature("avg_screen_status", "mean", "screen_status"),
    ),
    "ring": (
        *(Feature(alias, "mean", source) for source, alias in schemas.RING_AVERAGES.items()),
        Feature("oura_record_count", "rows"),
    ),
}
MODALITIES = tuple(PLAN)
PHONE_MODALITIES = MODALITIES[:-1]


def _aggregate(feature: Feature) -> str:
    if feature.kind == "rows":
        return f"count(*) AS {feature.name}"
    function = "avg" if feature.kind == "mean" else "sum"
    return f"{function}({number_sql(feature.source)}) AS {feature.name}"


def modality_features(df: DataFrame, modality: str, keep_null_key: bool = False) -> DataFrame:
    """Aggregate one modality to a row per participant.

    Means and counts combine map-side, so a participant with very many rows sends one
    partial row per task. A NULL participant forms a group only with `keep_null_key`.
    """
    rows = df if keep_null_key else df.where(F.col(KEY).isNotNull())
    return rows.groupBy(KEY).agg(*[F.expr(_aggregate(f)) for f in PLAN[modality]])
