import pytest
from pyspark.sql import functions as F

from cohortloom import schemas
from cohortloom.operators import assemble, features, prepare
from cohortloom.plans import model_table


@pytest.fixture(scope="module")
def logs(spark):
    ring_columns = ", ".join(f"{c} double" for c in schemas.RING_AVERAGES)
    width = len(schemas.RING_AVERAGES)
    return {
        "battery": spark.createDataFrame(
            [("a", 10.0, 5.0), ("a", 20.0, None), ("b", 1.0, float("nan")), (None, 9.0, 9.0)],
            "participant string, battery_charge_start double, battery_charge_end double",
        ),
        "calls": spark.createDataFrame(
            [("a", 3.0, "1"), ("c", 4.0, "x"), ("c", 6.0, "2")],
            "participant string, dur double, type string",
        ),
        "messages": spark.createDataFrame(
            [("d", "2"), (None, "1")], "participant string, message_type string"
        ),
        "notifications": spark.createDataFrame(
            [("a", "0")], "participant string, package_category string"
        ),
        "screen": spark.createDataFrame([("b", "3"), ("b", "0")], "participant string, screen_status string"),
        "ring": spark.createDataFrame(
            [("a", *[1.0] * width), ("e", *[None] * width)], f"participant string, {ring_columns}"
        ),
    }


def _parts(logs, **options):
    return [features.modality_features(logs[m], m, **options) for m in features.MODALITIES]


def _rows(df):
    return sorted(map(tuple, df.select("participant", *schemas.FEATURES).collect()), key=str)


def test_feature_list_is_the_published_order():
    planned = [f.name for m in features.MODALITIES for f in features.PLAN[m]]
    assert tuple(planned) == schemas.FEATURES
    assert len(planned) == 35
    assert planned[:4] == ["avg_battery_charge_start", "avg_battery_charge_end", "battery_event_count", "total_calls"]
    assert planned[-1] == "oura_record_count"


def test_counts_are_rows_and_means_skip_gaps(spark, logs):
    battery = {r.participant: r for r in features.modality_features(logs["battery"], "battery").collect()}
    assert set(battery) == {"a", "b"}
    assert battery["a"].battery_event_count == 2 and battery["a"].avg_battery_charge_end == 5.0
    assert battery["b"].avg_battery_charge_end is None
    calls = {r.participant: r for r in features.modality_features(logs["calls"], "calls").collect()}
    assert calls["c"].total_call_duration == 10.0 and calls["c"].avg_call_type == 2.0


def test_three_ways_to_assemble_agree(spark, logs):
    parts = _parts(logs)
    chain = _rows(assemble.outer_chain(parts))
    assert [r[0] for r in chain] == ["a", "b", "c", "d", "e"]
    assert _rows(assemble.merge_features(parts)) == chain
    assert _rows(assemble.single_shuffle(logs)) == chain
    missing = {r[0]: r for r in chain}["d"]
    assert missing[3] is None  # no battery rows: NULL, not zero


def test_null_keys_match_like_a_merge(spark, logs):
    kept = _parts(logs, keep_null_key=True)[:3]
    merged = assemble.outer_chain(kept, null_key="match").where("participant is null").collect()
    assert len(merged) == 1
    assert merged[0].battery_event_count == 1 and merged[0].total_messages == 1
    dropped = assemble.outer_chain(kept, null_key="drop")
    assert dropped.where("participant is null").isEmpty()


def test_merge_shuffles_each_modality_once(spark, logs):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        merged = assemble.merge_features(_parts(logs))
        single = assemble.single_shuffle(logs)
        exchanges = [
            df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
            for df in (merged, single)
        ]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert exchanges == [len(features.MODALITIES), 1]


def test_model_table_is_filled_with_medians(spark, logs):
    people = spark.createDataFrame(
        [("a", 40.0, "high_loneliness", 1), ("b", 20.0, "low_loneliness", 0), ("c", 21.0, "low_loneliness", 0), ("z", 1.0, "low_loneliness", 0)],
        f"participant string, {schemas.SCORE} double, {schemas.LABEL} string, {schemas.LABEL_BINARY} int",
    )
    filled = {r.participant: r for r in model_table.filled_model_table(logs, people).collect()}
    assert set(filled) == {"a", "b", "c"}
    assert filled["c"].avg_battery_charge_start == (15.0 + 1.0) / 2
    assert filled["c"].avg_message_type is None  # no value anywhere: stays NULL
    assert list(filled["a"].asDict())[1:36] == list(schemas.FEATURES)


def test_median_fill_and_scaling(spark):
    df = spark.createDataFrame(
        [(1.0, 5.0, None), (2.0, 5.0, None), (3.0, 5.0, None), (10.0, 5.0, None), (None, None, None)],
        "x double, y double, z double",
    )
    fill = prepare.MedianFill.fit(df, ["x", "y", "z"])
    assert fill.medians == {"x": 2.5, "y": 5.0, "z": None} and fill.empty == ["z"]
    filled = fill.transform(df)
    assert filled.where("x = 2.5").count() == 1
    scaled = prepare.Standardize.fit(filled, ["x", "y"]).transform(filled)
    got = scaled.agg(F.avg("x"), F.stddev_pop("x"), F.max("y")).first()
    assert got[0] == pytest.approx(0) and got[1] == pytest.approx(1) and got[2] == 0
