import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortloom import schemas
from cohortloom.functions import values
from cohortloom.operators import latest, medians, reshape, scoring
from cohortloom.plans import labels

FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def test_question_order_is_total():
    assert reshape.question_order(["q10", "quality", "q2", "Q1", "q1"]) == [
        "Q1",
        "q1",
        "q2",
        "q10",
        "quality",
    ]


def test_question_columns_pattern_and_prefix_rule():
    columns = ["participant", "q1", "Q2", "quality", "Timestamp", "query_date"]
    assert reshape.question_columns(columns) == ["q1", "Q2"]
    assert reshape.question_columns(columns, any_q=True) == ["q1", "Q2", "quality", "query_date"]


def test_unpivot_drops_null_and_blank_and_survives_odd_names(spark):
    df = spark.createDataFrame([("a", "Never", None, "  "), ("b", "x", "y", "z")], "p string, q1 string, Q2 string, `q'3` string")
    long = reshape.unpivot_answers(df, ["p"], ["q1", "Q2", "q'3"])
    assert sorted(map(tuple, long.collect())) == [
        ("a", "q1", "Never"),
        ("b", "q'3", "z"),
        ("b", "q1", "x"),
        ("b", "q2", "y"),
    ]


def test_pivot_inverts_unpivot_on_complete_rows(spark):
    rows = [(str(i), f"a{i}", f"b{i % 3}", f"c{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "p string, q1 string, q2 string, q3 string")
    long = reshape.unpivot_answers(df, ["p"], ["q1", "q2", "q3"])
    back = reshape.pivot_first(long, ["p"], "question_id", "response_raw", ["q1", "q2", "q3"])
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_pivot_takes_first_non_null_and_drops_null_keys(spark):
    df = spark.createDataFrame(
        [("a", "q1", None, 1), ("a", "q1", "z", 2), ("a", "q1", "b", 3), (None, "q1", "x", 1)],
        "p string, question_id string, response_raw string, at int",
    )
    out = reshape.pivot_first(df, ["p"], "question_id", "response_raw", ["q1", "q2"], ["at"])
    assert [tuple(r) for r in out.collect()] == [("a", "z", None)]


def test_latest_ties_and_one_submission(spark):
    df = spark.createDataFrame(
        [
            ("a", 1, "f1", "q1"),
            ("a", 2, "f2", "q1"),
            ("a", 2, "f2", "q2"),
            ("a", 2, "f3", "q1"),
            ("b", None, "f4", "q1"),
            (None, 5, "f5", "q1"),
        ],
        "p string, t int, f string, q string",
    )
    ties = latest.latest_per_key(df, "p", ["t"]).collect()
    assert sorted((r.p, r.f, r.q) for r in ties) == [("a", "f2", "q1"), ("a", "f2", "q2"), ("a", "f3", "q1")]
    one = latest.latest_per_key(df, "p", ["t", "f"]).collect()
    assert [(r.p, r.f) for r in one] == [("a", "f3")]


def test_latest_row_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS p", "id AS t", "'x' AS f")
    newest = latest.latest_row(df, "p", ["t", "f"])
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert sorted((r.p, r.t) for r in newest.collect()) == [(0, 999), (1, 997), (2, 998)]


def test_map_reverse_total(spark):
    df = spark.createDataFrame(
        [("a", "Never", "often"), ("b", "OFTEN", "Rarely"), ("c", "Often ", "Rarely")],
        "p string, q1 string, q2 string",
    )
    mapped = scoring.map_responses(df, ["q1", "q2"])
    assert [(r.q1, r.q2) for r in mapped.orderBy("p").collect()] == [(1, 4), (None, 2), (None, 2)]
    relaxed = scoring.map_responses(df, ["q1", "q2"], normalize=True)
    assert [r.q1 for r in relaxed.orderBy("p").collect()] == [1, 4, 4]
    reversed_ = scoring.reverse_code(mapped)
    assert [r.q1 for r in reversed_.orderBy("p").collect()] == [4, None, None]
    again = scoring.reverse_code(reversed_)
    assert again.exceptAll(mapped).isEmpty()
    total = scoring.total_score(reversed_, ["q1", "q2"])
    assert [(r.p, r[schemas.SCORE]) for r in total.collect()] == [("a", 8)]


def test_median_split_puts_the_median_low(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 3, 10)], f"{schemas.SCORE} int")
    for small in (True, False):
        out = scoring.median_split(df, small_domain=small).orderBy(schemas.SCORE).collect()
        assert [r[schemas.LABEL_BINARY] for r in out] == [0, 0, 1, 1]
    odd = df.where(f"{schemas.SCORE} < 10")
    out = scoring.median_split(odd, small_domain=True).orderBy(schemas.SCORE).collect()
    assert [r[schemas.LABEL] for r in out] == ["low_loneliness", "low_loneliness", "high_loneliness"]


@FEW
@given(
    st.lists(
        st.one_of(st.none(), st.floats(-1e6, 1e6), st.sampled_from([0.0, 1.0, 2.0])), max_size=60
    ),
    st.integers(1, 8),
)
def test_exact_median_with_narrowing(spark, items, small):
    df = spark.createDataFrame([(v,) for v in items], "v double")
    found = medians.exact_medians(df, {"v": F.col("v")}, small=small)["v"]
    known = [v for v in items if v is not None]
    if not known:
        assert found is None
    else:
        assert found == pytest.approx(statistics.median(known), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("shape", ["even", "ties", "spread", "two"])
def test_exact_median_narrows_on_larger_data(spark, shape):
    expression = {
        "even": "cast(id as double)",
        "ties": "cast(if(id % 3 = 0, 7, id) as double)",
        "spread": "exp(id / 100.0) * if(id % 2 = 0, 1, -1)",
        "two": "cast(id % 2 as double)",
    }[shape]
    df = spark.range(20001).selectExpr(f"{expression} AS v")
    found = medians.exact_medians(df, {"v": F.col("v")}, small=50)["v"]
    assert found == df.agg(F.median("v")).first()[0]


def test_exact_medians_of_several_columns_advance_together(spark):
    df = spark.range(5000).selectExpr(
        "cast(hash(id) as double) AS a",
        "if(id % 5 = 0, null, id * 0.5) AS b",
        "if(id < 10, id, null) AS c",
        "cast(null as int) AS d",
    )
    wanted = {(1, c): F.col(c) for c in "abcd"}
    found = medians.exact_medians(df, wanted, small=40)
    row = df.agg(*[F.median(c).alias(c) for c in "abcd"]).first()
    assert found == {(1, c): row[c] for c in "abcd"}
    assert medians.exact_medians(df, wanted) == found
    assert medians.exact_medians(df, {}) == {}


def test_event_time_reads_iso_and_epoch_text(spark):
    df = spark.createDataFrame(
        [("2020-01-02 03:04:05",), ("1577934245",), ("1577934245000",), ("soon",), (None,)], "t string"
    )
    got = [r[0] for r in df.select(values.event_time(F.col("t")).cast("string")).collect()]
    assert got == ["2020-01-02 03:04:05"] * 3 + [None, None]


def _submission(p, t, stem, answers, date="d"):
    return [(p, date, t, f"{stem}.csv", stem, q, a) for q, a in answers.items()]


def test_labels_follow_the_rules(spark):
    full = {f"q{i}": "Never" for i in range(1, 21)}
    rows = [
        *_submission("1", "2020-01-01", "UCLA_a", full),
        *_submission("1", "2020-02-01", "UCLA_b", {**full, "q2": "Often"}),
        *_submission("2", "2020-01-01", "UCLA_c", {**full, "q3": "Rarely", "q4": "Rarely"}),
        *_submission("3", "2020-01-01", "UCLA_d", {k: v for k, v in full.items() if k != "q7"}),
        *_submission("4", "2020-01-01", "PHQ_e", full),
        *_submission("5", "2020-01-01", "UCLA_f", full),
        *_submission("5", "2020-01-01", "UCLA_g", {**full, "q20": "Often"}),
        *_submission("6", "later", "UCLA_h", {**full, "q2": "sometimes"}),
        *_submission("6", "earlier", "UCLA_i", full),
        *_submission(None, "2020-01-01", "UCLA_j", full),
        *_submission("7", "2020-03-01", "UCLA_k", full, date=None),
        *_submission("7", "2020-02-01", "UCLA_l", full),
    ]
    schema = "participant string, date string, timestamp string, file_name string, file_stem string, question_id string, response_raw string"
    surveys = spark.createDataFrame(rows, schema)
    out = labels.participant_labels(surveys, list(full)).collect()
    base = 11 * 1 + 9 * 4
    # the latest submission counts; text times order as text; a NULL key drops the latest
    assert {r.participant: r[schemas.SCORE] for r in out} == {
        "1": base + 3,
        "2": base + 2,
        "5": base - 3,
        "6": base + 2,
    }
    assert {r.participant for r in out if r[schemas.LABEL_BINARY] == 1} == {"1"}
    ties = labels.participant_labels(surveys, list(full), keep="ties").collect()
    assert sorted(r.participant for r in ties) == ["1", "2", "5", "5", "6"]
    lazily = labels.participant_labels(surveys, list(full), write_once=False).collect()
    assert sorted(map(tuple, lazily)) == sorted(map(tuple, out))


def test_event_times_of_declared_shapes(spark):
    texts = {
        "2020-01-02": "2020-01-02 00:00:00",
        "2020-01-02T03:04:05Z": "2020-01-02 03:04:05",
        "2020-01-02 03:04:05": "2020-01-02 03:04:05",
        "20200101": "2020-01-01 00:00:00",
        "1577934245": "2020-01-02 03:04:05",
        "1577934245000": "2020-01-02 03:04:05",
        "1577934245000000": "2020-01-02 03:04:05",
        "1577934245000000000": "2020-01-02 03:04:05",
        "10:15": None,
        "20201399": None,
        "yesterday": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", F.date_format(values.event_time(F.col("t")), "yyyy-MM-dd HH:mm:ss").alias("e"))
    assert dict(map(tuple, got.collect())) == texts


def test_repeated_answers_take_the_first_text(spark):
    rows = [("1", "q1", "Often"), ("1", "q1", "Maybe"), ("1", "q2", "Never"), ("2", "q1", "Rarely"), ("2", "q1", "Often"), ("2", "q2", "Never")]
    df = spark.createDataFrame(
        [(p, "d", "2020-01-01", "f", "UCLA_f", q, a) for p, q, a in rows],
        "participant string, date string, timestamp string, file_name string, file_stem string, question_id string, response_raw string",
    )
    got = labels.participant_labels(df).collect()
    # the first text of participant 1 is unknown, of participant 2 it is "Often"
    assert [(r.participant, r.ucla_total_score) for r in got] == [("2", 1 + 1)]
