"""Declared tables, column lists and scoring constants.

Each curated table has one declaration, used by the writer and by the reader.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Names, lists and constants that must equal the published data
# layout and scoring key for results to match.
# ---------------------------------------------------------------------------

PHONE_LOGS = ("battery", "calls", "screen", "messages", "notifications")

RESPONSE_SCORES = {
    "Never": 1,
    "Rarely": 2,
    "Sometimes": 3,
    "Often": 4,
    "never": 1,
    "rarely": 2,
    "sometimes": 3,
    "often": 4,
}
REVERSED_ITEMS = ("q1", "q5", "q6", "q9", "q10", "q15", "q16", "q19", "q20")
LOWEST_SCORE = 1
HIGHEST_SCORE = 4

SURVEY_PATTERN = "%UCLA%"
SCORE = "ucla_total_score"
LABEL = "loneliness_label"
LABEL_BINARY = "loneliness_label_binary"
LABEL_HIGH = "high_loneliness"
LABEL_LOW = "low_loneliness"

DATE_SPELLINGS = ("date", "Date")
TIME_SPELLINGS = ("timestamp", "Timestamp", "datetime", "Datetime")

RING_TEXT = (
    "OURA_activity_class_5min",
    "OURA_activity_met_1min",
    "OURA_activity_rest_mode_state",
    "OURA_ideal_bedtime_bedtime_window_end",
    "OURA_ideal_bedtime_bedtime_window_start",
    "OURA_readiness_period_id",
    "OURA_readiness_rest_mode_state",
    "OURA_sleep_hr_5min",
    "OURA_sleep_hypnogram_5min",
    "OURA_sleep_midpoint_time",
    "OURA_sleep_period_id",
    "OURA_sleep_rmssd_5min",
)
RING_FLAGS = ("OURA_sleep_is_longest",)
RING_MEASURES = (
    "OURA_activity_average_met",
    "OURA_activity_cal_active",
    "OURA_activity_cal_total",
    "OURA_activity_class_5min",
    "OURA_activity_daily_movement",
    "OURA_activity_high",
    "OURA_activity_inactive",
    "OURA_activity_inactivity_alerts",
    "OURA_activity_low",
    "OURA_activity_medium",
    "OURA_activity_met_1min",
    "OURA_activity_met_min_high",
    "OURA_activity_met_min_inactive",
    "OURA_activity_met_min_low",
    "OURA_activity_met_min_medium",
    "OURA_activity_non_wear",
    "OURA_activity_rest",
    "OURA_activity_rest_mode_state",
    "OURA_activity_score",
    "OURA_activity_score_meet_daily_targets",
    "OURA_activity_score_move_every_hour",
    "OURA_activity_score_recovery_time",
    "OURA_activity_score_stay_active",
    "OURA_activity_score_training_frequency",
    "OURA_activity_score_training_volume",
    "OURA_activity_steps",
    "OURA_activity_target_calories",
    "OURA_activity_target_km",
    "OURA_activity_target_miles",
    "OURA_activity_to_target_km",
    "OURA_activity_to_target_miles",
    "OURA_activity_total",
    "OURA_ideal_bedtime_bedtime_window_end",
    "OURA_ideal_bedtime_bedtime_window_start",
    "OURA_readiness_period_id",
    "OURA_readiness_rest_mode_state",
    "OURA_readiness_score",
    "OURA_readiness_score_activity_balance",
    "OURA_readiness_score_hrv_balance",
    "OURA_readiness_score_previous_day",
    "OURA_readiness_score_previous_night",
    "OURA_readiness_score_recovery_index",
    "OURA_readiness_score_resting_hr",
    "OURA_readiness_score_sleep_balance",
    "OURA_readiness_score_temperature",
    "OURA_sleep_average_breath_variation",
    "OURA_sleep_awake",
    "OURA_sleep_bedtime_end_delta",
    "OURA_sleep_bedtime_start_delta",
    "OURA_sleep_breath_average",
    "OURA_sleep_deep",
    "OURA_sleep_duration",
    "OURA_sleep_efficiency",
    "OURA_sleep_got_up_count",
    "OURA_sleep_hr_5min",
    "OURA_sleep_hr_average",
    "OURA_sleep_hr_lowest",
    "OURA_sleep_hypnogram_5min",
    "OURA_sleep_is_longest",
    "OURA_sleep_light",
    "OURA_sleep_lowest_heart_rate_time_offset",
    "OURA_sleep_midpoint_at_delta",
    "OURA_sleep_midpoint_time",
    "OURA_sleep_onset_latency",
    "OURA_sleep_period_id",
    "OURA_sleep_rem",
    "OURA_sleep_restless",
    "OURA_sleep_rmssd",
    "OURA_sleep_rmssd_5min",
    "OURA_sleep_score",
    "OURA_sleep_score_alignment",
    "OURA_sleep_score_deep",
    "OURA_sleep_score_disturbances",
    "OURA_sleep_score_efficiency",
    "OURA_sleep_score_latency",
    "OURA_sleep_score_rem",
    "OURA_sleep_score_total",
    "OURA_sleep_temperature_delta",
    "OURA_sleep_temperature_deviation",
    "OURA_sleep_temperature_trend_deviation",
    "OURA_sleep_total",
    "OURA_sleep_wake_up_count",
)

# ring measure -> feature, in the order of the published model table
RING_AVERAGES = {
    "OURA_sleep_duration": "avg_sleep_duration",
    "OURA_sleep_score": "avg_sleep_score",
    "OURA_sleep_total": "avg_sleep_total",
    "OURA_sleep_efficiency": "avg_sleep_efficiency",
    "OURA_sleep_rem": "avg_sleep_rem",
    "OURA_sleep_deep": "avg_sleep_deep",
    "OURA_sleep_light": "avg_sleep_light",
    "OURA_sleep_awake": "avg_sleep_awake",
    "OURA_activity_steps": "avg_steps",
    "OURA_activity_score": "avg_activity_score",
    "OURA_activity_total": "avg_activity_total",
    "OURA_activity_daily_movement": "avg_daily_movement",
    "OURA_activity_average_met": "avg_average_met",
    "OURA_readiness_score": "avg_readiness_score",
    "OURA_readiness_score_activity_balance": "avg_readiness_activity_balance",
    "OURA_readiness_score_hrv_balance": "avg_readiness_hrv_balance",
    "OURA_readiness_score_resting_hr": "avg_readiness_resting_hr",
    "OURA_readiness_score_sleep_balance": "avg_readiness_sleep_balance",
    "OURA_sleep_hr_average": "avg_sleep_hr_average",
    "OURA_sleep_hr_lowest": "avg_sleep_hr_lowest",
    "OURA_sleep_rmssd": "avg_sleep_rmssd",
    "OURA_sleep_average_breath_variation": "avg_breath_variation",
}

PHONE_FEATURES = (
    "avg_battery_charge_start",
    "avg_battery_charge_end",
    "battery_event_count",
    "total_calls",
    "avg_call_duration",
    "total_call_duration",
    "avg_call_type",
    "total_messages",
    "avg_message_type",
    "total_notifications",
    "total_screen_events",
    "avg_screen_status",
)
RING_FEATURES = (*RING_AVERAGES.values(), "oura_record_count")
FEATURES = (*PHONE_FEATURES, *RING_FEATURES)

METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc")

# ---------------------------------------------------------------------------
# Curated tables
# ---------------------------------------------------------------------------

PROVENANCE = (
    "source_file string, participant_id string, source_type_raw string, "
    "source_type string, file_name string, file_stem string"
)


def _ring_type(name: str) -> str:
    if name in RING_TEXT:
        return "string"
    return "boolean" if name in RING_FLAGS else "double"


MEASURE_DDL = {
    "aware_battery": "timestamp string, participant string, "
    "battery_charge_start double, battery_charge_end double",
    "aware_calls": "timestamp string, participant string, dur double, type string",
    "aware_messages": "timestamp string, participant string, message_type string",
    "aware_notifications": "timestamp string, participant string, package_category string",
    "aware_screen": "timestamp string, participant string, screen_status string",
    "oura": "participant string, timestamp bigint, "
    + ", ".join(f"{name} {_ring_type(name)}" for name in RING_MEASURES),
    "watch": "timestamp string, ppg string, hrm double, accx double, accy double, "
    "accz double, grax double, gray double, graz double, gyrx double, gyry double, "
    "gyrz double, pressure double",
}

SURVEYS_LONG_DDL = (
    "participant string, date string, timestamp string, survey_source_file string, "
    "survey_path string, survey_type string, question_id string, question_text string, "
    f"response_raw string, response_numeric double, {PROVENANCE}, ingest_ts timestamp"
)


def _from_ddl(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def measures(table: str) -> T.StructType:
    """Columns a source file of `table` may carry, with their curated types."""
    return _from_ddl(MEASURE_DDL[table])


def curated(table: str) -> T.StructType:
    """Full schema of a curated table as written to Parquet."""
    if table == "surveys_long":
        return _from_ddl(SURVEYS_LONG_DDL)
    extra = ", aware_type string" if table.startswith("aware_") else ""
    return _from_ddl(f"{MEASURE_DDL[table]}, {PROVENANCE}{extra}, ingest_ts timestamp")


CURATED_TABLES = ("surveys_long", *MEASURE_DDL)

RESULT_DDL = {
    "labels": (
        "participant string, date string, timestamp string, file_name string, file_stem string, "
        f"{SCORE} int, {LABEL} string, {LABEL_BINARY} int"
    ),
    "cv_results": ", ".join(
        ["model string", *[f"{m}_{part} double" for m in METRICS for part in ("mean", "std")]]
    ),
}
RESULT_DDL["cv_results_rounded"] = RESULT_DDL["cv_results"]
RESULT_DDL["model_table"] = ", ".join(
    [
        "participant string",
        *[f"{c} double" for c in FEATURES],
        f"{SCORE} double, {LABEL} string, {LABEL_BINARY} int",
    ]
)
RESULT_DDL["model_table_filled"] = RESULT_DDL["model_table"]


def result(table: str) -> T.StructType:
    """Schema of a table that the evaluation writes."""
    return _from_ddl(RESULT_DDL[table])
