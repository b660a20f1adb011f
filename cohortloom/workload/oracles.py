"""Independent SQL for each registered query that SQL can express."""

from __future__ import annotations

from cohortloom import schemas

WIDE = """
wide AS (
  SELECT CAST(o_custkey AS VARCHAR) AS participant,
         strftime(o_orderdate, '%Y-%m-%d') AS "date",
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "timestamp",
         stem || '.csv' AS file_name, stem AS file_stem, q1, q2, q3, q4
  FROM (
    SELECT o.*, a.*,
      CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'UCLA_' ELSE 'PHQ_' END
        || o_orderpriority || '_' || o_orderkey AS stem
    FROM orders o JOIN (
      SELECT l_orderkey,
        CASE CAST(sum(l_quantity) AS BIGINT) % 5 WHEN 0 THEN 'Never' WHEN 1 THEN 'Rarely'
          WHEN 2 THEN 'sometimes' ELSE 'Often' END AS q1,
        CASE max(l_partkey) % 4 WHEN 0 THEN 'never' WHEN 1 THEN 'Rarely'
          WHEN 2 THEN 'Sometimes' ELSE 'often' END AS q2,
        CASE max(l_suppkey) % 5 WHEN 0 THEN 'Never' WHEN 1 THEN 'Rarely'
          WHEN 2 THEN 'Sometimes' WHEN 3 THEN 'Often' ELSE ' ' END AS q3,
        CASE count(*) % 4 WHEN 0 THEN 'Never' WHEN 1 THEN 'Rarely'
          WHEN 2 THEN 'Sometimes' ELSE 'Often' END AS q4
      FROM lineitem GROUP BY l_orderkey) a ON o.o_orderkey = a.l_orderkey)
)"""

IDS = 'participant, "date", "timestamp", file_name, file_stem'

LONG = (
    WIDE
    + ",\nlong AS (SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT {IDS}, '{q}' AS question_id, {q} AS response_raw FROM wide"
        for q in ("q1", "q2", "q3", "q4")
    )
    + ") WHERE response_raw IS NOT NULL AND trim(response_raw) <> '')"
)

UCLA = LONG + ",\nucla AS (SELECT * FROM long WHERE file_stem LIKE '%UCLA%')"


def _score(text: str) -> str:
    return (
        f"CASE WHEN {text} IN ('Never', 'never') THEN 1 WHEN {text} IN ('Rarely', 'rarely') THEN 2 "
        f"WHEN {text} IN ('Sometimes', 'sometimes') THEN 3 WHEN {text} IN ('Often', 'often') THEN 4 END"
    )


CODED = (
    WIDE
    + f""",
coded AS (
  SELECT {IDS}, 5 - {_score('q1')} AS q1, {_score('q2')} AS q2, {_score('q3')} AS q3,
         {_score('q4')} AS q4
  FROM wide WHERE file_stem LIKE '%UCLA%'),
scored AS (
  SELECT {IDS}, CAST(q1 + q2 + q3 + q4 AS INTEGER) AS ucla_total_score FROM coded
  WHERE q1 + q2 + q3 + q4 IS NOT NULL)"""
)

SPLIT = """
  CASE WHEN ucla_total_score > (SELECT median(ucla_total_score) FROM {t})
    THEN 'high_loneliness' ELSE 'low_loneliness' END AS loneliness_label,
  CAST(CASE WHEN ucla_total_score > (SELECT median(ucla_total_score) FROM {t})
    THEN 1 ELSE 0 END AS INTEGER) AS loneliness_label_binary"""


def _labels(keep: str) -> str:
    """CTEs ending in `labels`, from the latest submissions of the long table."""
    rank = "row_number" if keep == "one" else "rank"
    order = '"timestamp" DESC' + (", file_name DESC" if keep == "one" else "")

    def pick(q: str) -> str:
        return f"min(CASE WHEN question_id = '{q}' THEN response_raw END)"

    items = ", ".join(
        f"{_score(pick(q))} AS {q}"
        for q in ("q1", "q2", "q3", "q4")
    )
    return (
        UCLA
        + f""",
submissions AS (
  SELECT *, {rank}() OVER (PARTITION BY participant ORDER BY {order}) AS place
  FROM (SELECT {IDS}, {items} FROM ucla GROUP BY ALL)),
newest AS (
  SELECT {IDS}, CAST((5 - q1) + q2 + q3 + q4 AS INTEGER) AS ucla_total_score
  FROM submissions WHERE place = 1 AND (5 - q1) + q2 + q3 + q4 IS NOT NULL),
labels_ AS (SELECT {IDS}, ucla_total_score, {SPLIT.format(t='newest')} FROM newest)"""
    )


# ---------------------------------------------------------------------------
# Features
# ---------------------------------------------------------------------------

PHONE = """
aware_battery AS (SELECT CAST(user_id AS VARCHAR) AS participant, floor(value * 4) / 4 AS charge_start,
    floor(value * 4) / 4 * 0.5 AS charge_end
  FROM events WHERE event_type = 'view'),
aware_calls AS (SELECT CAST(user_id + 10 AS VARCHAR) AS participant, floor(value * 4) / 4 AS dur,
    event_id % 3 + 1 AS type FROM events WHERE event_type = 'click'),
aware_messages AS (SELECT CAST(user_id + 20 AS VARCHAR) AS participant, event_id % 2 + 1 AS message_type
  FROM events WHERE event_type = 'signup'),
aware_notifications AS (SELECT CAST(user_id + 30 AS VARCHAR) AS participant
  FROM events WHERE event_type = 'purchase'),
aware_screen AS (SELECT CAST(user_id + 40 AS VARCHAR) AS participant, event_id % 4 AS screen_status
  FROM events WHERE event_type = 'error'),
f_battery AS (SELECT participant, avg(charge_start) AS avg_battery_charge_start,
    avg(charge_end) AS avg_battery_charge_end, count(*) AS battery_event_count
  FROM aware_battery GROUP BY participant),
f_calls AS (SELECT participant, count(*) AS total_calls, avg(dur) AS avg_call_duration,
    sum(dur) AS total_call_duration, avg(CAST(type AS DOUBLE)) AS avg_call_type
  FROM aware_calls GROUP BY participant),
f_messages AS (SELECT participant, count(*) AS total_messages,
    avg(CAST(message_type AS DOUBLE)) AS avg_message_type
  FROM aware_messages GROUP BY participant),
f_notifications AS (SELECT participant, count(*) AS total_notifications
  FROM aware_notifications GROUP BY participant),
f_screen AS (SELECT participant, count(*) AS total_screen_events,
    avg(CAST(screen_status AS DOUBLE)) AS avg_screen_status
  FROM aware_screen GROUP BY participant),
f_phone AS (
  SELECT * FROM f_battery FULL JOIN f_calls USING (participant)
    FULL JOIN f_messages USING (participant) FULL JOIN f_notifications USING (participant)
    FULL JOIN f_screen USING (participant))"""

RING = (
    "f_ring AS (SELECT CAST(o_custkey AS VARCHAR) AS participant, "
    + ", ".join(
        f"avg(CASE WHEN l_linenumber % 7 <> {i % 7} THEN l_quantity + {i} END) AS {alias}"
        for i, alias in enumerate(schemas.RING_AVERAGES.values(), start=1)
    )
    + ", count(*) AS oura_record_count FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
    "GROUP BY o_custkey)"
)

FEATURES = (
    PHONE + ",\n" + RING + ",\nf_all AS (SELECT * FROM f_phone FULL JOIN f_ring USING (participant))"
)

MODEL = (
    FEATURES
    + ","
    + _labels("one")
    + ",\nmodel AS (SELECT participant, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in schemas.FEATURES)
    + ", CAST(ucla_total_score AS DOUBLE) AS ucla_total_score, loneliness_label, "
    "loneliness_label_binary FROM f_all JOIN labels_ USING (participant))"
)


def _filled(source: str, rest: str = "") -> str:
    """Every feature of `source` with gaps filled by the mean of its two middle values."""
    lists = ", ".join(
        f"list_sort(list(CAST({c} AS DOUBLE)) FILTER ({c} IS NOT NULL)) AS {c}" for c in schemas.FEATURES
    )
    middles = ", ".join(
        f"({c}[(len({c}) + 1) // 2] + {c}[len({c}) // 2 + 1]) / 2 AS {c}" for c in schemas.FEATURES
    )
    picks = ", ".join(f"coalesce(CAST(s.{c} AS DOUBLE), m.{c}) AS {c}" for c in schemas.FEATURES)
    return (
        f", lists AS (SELECT {lists} FROM {source}), middles AS (SELECT {middles} FROM lists) "
        f"SELECT s.participant, {picks}{rest} FROM {source} s, middles m"
    )


PREDICTIONS = """
preds AS (SELECT l_linestatus AS model, CAST(l_orderkey % 5 AS INTEGER) AS fold,
    CAST(l_returnflag = 'R' AS INTEGER) AS label, l_quantity / 50 AS score,
    CAST(l_quantity > 25 AS INTEGER) AS prediction FROM lineitem),
fold_counts AS (
  SELECT model, fold, CAST(count(*) AS DOUBLE) AS n,
    CAST(count(*) FILTER (label = 1 AND prediction = 1) AS DOUBLE) AS tp,
    CAST(count(*) FILTER (label = 0 AND prediction = 1) AS DOUBLE) AS fp,
    CAST(count(*) FILTER (label = 1 AND prediction = 0) AS DOUBLE) AS fn
  FROM preds GROUP BY model, fold),
basic AS (
  SELECT model, fold, (n - fp - fn) / n AS accuracy,
    coalesce(tp / nullif(tp + fp, 0), 0) AS "precision",
    coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
    coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1
  FROM fold_counts),
ranked AS (
  SELECT model, fold, label,
    rank() OVER (PARTITION BY model, fold ORDER BY score)
      + (count(*) OVER (PARTITION BY model, fold, score) - 1) / 2.0 AS mid_rank
  FROM preds),
auc AS (
  SELECT model, fold,
    (sum(mid_rank) FILTER (label = 1) - p * (p + 1) / 2) / nullif(p * (total - p), 0) AS roc_auc
  FROM (SELECT *, CAST(sum(label) OVER (PARTITION BY model, fold) AS DOUBLE) AS p,
      CAST(count(*) OVER (PARTITION BY model, fold) AS DOUBLE) AS total FROM ranked)
  GROUP BY model, fold, p, total)"""

SUMMARY = (
    PREDICTIONS
    + ",\nsummary AS (SELECT model, "
    + ", ".join(
        f'avg("{m}") AS {m}_mean, stddev_pop("{m}") AS {m}_std' for m in schemas.METRICS
    )
    + " FROM basic JOIN auc USING (model, fold) GROUP BY model)"
)
SUMMARY_COLUMNS = [f"{m}_{part}" for m in schemas.METRICS for part in ("mean", "std")]


def _brands(name: str, measure: str) -> str:
    return (
        f"{name} AS (SELECT p_brand AS feature, "
        f"CAST(sum(CAST(round({measure} * 100) AS BIGINT)) AS DOUBLE) / "
        f"(SELECT CAST(sum(CAST(round({measure} * 100) AS BIGINT)) AS DOUBLE) FROM part) AS importance "
        "FROM part GROUP BY p_brand)"
    )


# ---------------------------------------------------------------------------
# Ingest
# ---------------------------------------------------------------------------

FOLDER = "'Participant_' || (user_id % 40)"


def _phone_export(log: str, kind: str, shift: int, measures: dict[str, str]) -> str:
    names = (
        "battery_charge_start",
        "battery_charge_end",
        "dur",
        "type",
        "message_type",
        "package_category",
        "screen_status",
    )
    types = {"battery_charge_start": "DOUBLE", "battery_charge_end": "DOUBLE", "dur": "DOUBLE"}
    values = ", ".join(
        f"{measures.get(n, 'CAST(NULL AS ' + types.get(n, 'VARCHAR') + ')')} AS {n}" for n in names
    )
    stem = f"'{log}_' || (event_id // 20000)"
    user = f"(user_id + {shift})"
    person = f"{user} % 40" if log == "calls" else user
    folder = f"'Participant_' || ({user} % 40)"
    return f"""
    SELECT '{log}' AS aware_type, {folder} AS participant_id, 'Aware' AS source_type_raw,
      'aware' AS source_type, {stem} || '.csv' AS file_name, {stem} AS file_stem,
      strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp", CAST({person} AS VARCHAR) AS participant,
      CASE WHEN {user} % 40 % 4 = 0 THEN 'n, ' || (event_id % 3) END AS note, {values}
    FROM events WHERE event_type = '{kind}'"""


PHONE_EXPORTS = {
    "battery": _phone_export(
        "battery",
        "view",
        0,
        {
            "battery_charge_start": "floor(value * 4) / 4",
            "battery_charge_end": "floor(value * 4) / 4 * 0.5",
        },
    ),
    "calls": _phone_export(
        "calls",
        "click",
        10,
        {"dur": "floor(value * 4) / 4", "type": "CAST(event_id % 3 + 1 AS VARCHAR)"},
    ),
    "screen": _phone_export(
        "screen", "error", 40, {"screen_status": "CAST(event_id % 4 AS VARCHAR)"}
    ),
    "messages": _phone_export(
        "messages", "signup", 20, {"message_type": "CAST(event_id % 2 + 1 AS VARCHAR)"}
    ),
    "notifications": _phone_export(
        "notifications", "purchase", 30, {"package_category": "CAST(event_id % 6 AS VARCHAR)"}
    ),
}

WATCH_EXPORT = f"""
watch_export AS (
  SELECT *, name || suffix AS file_name, name AS file_stem FROM (
    SELECT event_id, {FOLDER} AS participant_id,
      CASE user_id % 3 WHEN 0 THEN 'heart rate + motion ' WHEN 1 THEN 'sensor[1]_' ELSE 'watch_' END
        || (event_id // 20000) AS name,
      CASE WHEN user_id % 3 = 2 THEN '.CSV' ELSE '.csv' END AS suffix,
      strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp", CAST(user_id AS VARCHAR) AS participant,
      floor(value * 4) / 4 AS v FROM events))"""

SURVEY_EXPORT = (
    WIDE
    + """,
filed AS (
  SELECT *, 'Participant_' || (CAST(participant AS BIGINT) % 40) AS participant_id,
    CASE WHEN file_stem LIKE '%UCLA%' THEN 'UCLA form ' ELSE 'PHQ_' END
      || (CAST(regexp_extract(file_stem, '_(\\d+)$', 1) AS BIGINT) // 20000) AS stem,
    file_stem LIKE '%UCLA%' AS is_ucla
  FROM wide),
answers AS ("""
    + " UNION ALL ".join(
        f"SELECT *, '{q}' AS question_id, {q} AS response_raw FROM filed"
        for q in ("q1", "q2", "q3", "q4")
    )
    + ")"
)

KEYS = """
keys AS (
  SELECT 'Participant_' || (page_id % 4) || '/Surveys' AS dir,
    'form' || (page_id % 3) || CASE WHEN page_id % 10 = 0 THEN '_' || (page_id // 10)
      ELSE ' ' || translate(CAST(page_id AS VARCHAR), '0123456789', ' :?#=&+,;!') END AS old_stem
  FROM pages),
named AS (
  SELECT dir, old_stem, dir || '/' || old_stem || '.csv' AS old_key,
    trim(regexp_replace(regexp_replace(old_stem, '[^A-Za-z0-9._-]', '_', 'g'), '_+', '_', 'g'), '._ ')
      AS stem
  FROM keys),
kept AS (SELECT DISTINCT dir, stem FROM named WHERE stem = old_stem),
claims AS (
  SELECT n.*, row_number() OVER (PARTITION BY n.dir, n.stem ORDER BY old_stem || '.csv') - 1
      + CASE WHEN k.stem IS NULL THEN 0 ELSE 1 END AS nth
  FROM named n LEFT JOIN kept k ON n.dir = k.dir AND n.stem = k.stem WHERE n.stem <> n.old_stem),
in_use AS (SELECT DISTINCT dir, stem FROM named),
free AS (
  SELECT c.dir, c.stem, c.n, row_number() OVER (PARTITION BY c.dir, c.stem ORDER BY c.n) AS nth
  FROM (SELECT dir, stem, unnest(range(1, (SELECT count(*) + 1000 FROM named))) AS n
        FROM (SELECT DISTINCT dir, stem FROM claims WHERE nth > 0)) c
  LEFT JOIN in_use u ON u.dir = c.dir AND u.stem = c.stem || '_' || c.n WHERE u.stem IS NULL)"""


def _select(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def _latest(order: str) -> str:
    return _select(
        UCLA,
        f"""SELECT {IDS}, question_id, response_raw FROM (
          SELECT *, rank() OVER (PARTITION BY participant ORDER BY {order}) AS place FROM ucla)
        WHERE place = 1""",
    )


ORACLES = {
    "survey_unpivot": _select(LONG, "SELECT * FROM long"),
    "survey_latest_ties": _latest('"timestamp" DESC'),
    "survey_latest_one": _latest('"timestamp" DESC, file_name DESC'),
    "survey_pivot_first": _select(
        """first_answers AS (
          SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS answer,
            row_number() OVER (PARTITION BY l_orderkey, l_linenumber
              ORDER BY l_partkey, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)) AS place
          FROM lineitem)""",
        "SELECT l_orderkey, "
        + ", ".join(f"max(answer) FILTER (l_linenumber = {i}) AS q{i}" for i in range(1, 8))
        + " FROM first_answers WHERE place = 1 GROUP BY l_orderkey",
    ),
    "survey_map_reverse": _select(CODED, "SELECT participant, file_stem, q1, q2, q3, q4 FROM coded"),
    "survey_total_complete": _select(
        CODED, "SELECT participant, file_stem, ucla_total_score FROM scored"
    ),
    "survey_median_split": _select(
        CODED,
        f"SELECT participant, file_stem, ucla_total_score, {SPLIT.format(t='scored')} FROM scored",
    ),
    "participant_labels": _select(_labels("one"), "SELECT * FROM labels_"),
    "participant_labels_ties": _select(_labels("ties"), "SELECT * FROM labels_"),
    "battery_features": _select(PHONE, "SELECT * FROM f_battery"),
    "call_features": _select(PHONE, "SELECT * FROM f_calls"),
    "message_features": _select(PHONE, "SELECT * FROM f_messages"),
    "notification_features": _select(PHONE, "SELECT * FROM f_notifications"),
    "screen_features": _select(PHONE, "SELECT * FROM f_screen"),
    "ring_features": _select(RING, "SELECT * FROM f_ring"),
    "phone_outer_chain": _select(PHONE, "SELECT * FROM f_phone"),
    "phone_ring_outer": _select(FEATURES, "SELECT * FROM f_all"),
    "features_merged": _select(FEATURES, "SELECT * FROM f_all"),
    "features_single_shuffle": _select(FEATURES, "SELECT * FROM f_all"),
    "features_labelled": _select(
        FEATURES + "," + _labels("one"),
        "SELECT f_all.*, ucla_total_score, loneliness_label, loneliness_label_binary "
        "FROM f_all JOIN labels_ USING (participant)",
    ),
    "model_table_raw": _select(MODEL, "SELECT * FROM model"),
    "model_table_filled": "WITH "
    + MODEL
    + _filled("model", ", s.ucla_total_score, s.loneliness_label, s.loneliness_label_binary"),
    "csv_ingest_metadata": _select(
        WATCH_EXPORT,
        """SELECT participant_id, 'Watch' AS source_type_raw, 'watch' AS source_type, file_name,
          file_stem, "timestamp", participant, CAST(v AS VARCHAR) AS hrm FROM watch_export""",
    ),
    "csv_phone_ingest": " UNION ALL ".join(PHONE_EXPORTS.values()),
    "csv_watch_ingest": _select(
        WATCH_EXPORT,
        """SELECT "timestamp", CAST(NULL AS VARCHAR) AS ppg, v AS hrm, v * (event_id % 7) AS accx,
          v * (event_id % 11) AS accy, v * (event_id % 13) AS accz, """
        + ", ".join(
            f"CAST(NULL AS DOUBLE) AS {c}"
            for c in ("grax", "gray", "graz", "gyrx", "gyry", "gyrz", "pressure")
        )
        + """, participant_id, 'Watch' AS source_type_raw, 'watch' AS source_type, file_name,
          file_stem FROM watch_export""",
    ),
    "csv_union_by_name": f"""SELECT "timestamp", participant,
      CAST(battery_charge_start AS VARCHAR) AS battery_charge_start,
      CAST(battery_charge_end AS VARCHAR) AS battery_charge_end, note
      FROM ({PHONE_EXPORTS['battery']})""",
    "csv_survey_ingest": _select(
        SURVEY_EXPORT,
        """SELECT participant, "date", "timestamp", stem || '.csv' AS survey_source_file,
          CAST(NULL AS VARCHAR) AS survey_type, question_id, CAST(NULL AS VARCHAR) AS question_text,
          response_raw, CAST(NULL AS DOUBLE) AS response_numeric, participant_id,
          'Surveys' AS source_type_raw, 'surveys' AS source_type, stem || '.csv' AS file_name,
          stem AS file_stem
        FROM answers WHERE trim(response_raw) <> ''""",
    ),
    "ring_cast": """SELECT l_orderkey, CAST(l_suppkey AS VARCHAR) AS participant,
        CAST(epoch(l_shipdate) AS BIGINT) AS "timestamp",
        repeat(CAST(l_linenumber AS VARCHAR), 12) AS OURA_activity_class_5min,
        CASE WHEN l_linenumber % 3 <> 0 THEN l_quantity END AS OURA_activity_steps,
        l_linenumber % 2 = 0 AS OURA_sleep_is_longest,
        '0' || l_linenumber AS OURA_sleep_period_id, l_partkey * 0.25::DOUBLE AS OURA_sleep_rmssd
      FROM lineitem""",
    "parquet_roundtrip": _select(
        LONG, "SELECT *, regexp_extract(file_stem, '^([A-Z]+)_', 1) AS survey FROM long"
    ),
    "table_sql_read": _select(
        UCLA + "," + PHONE,
        """SELECT participant, answers, battery_event_count
        FROM (SELECT participant, count(*) AS answers FROM ucla GROUP BY participant)
        JOIN f_battery USING (participant)""",
    ),
    "bad_file_quarantine": _select(
        WATCH_EXPORT,
        """SELECT participant_id || '/Watch/' || file_name AS file, count(*) AS total_rows,
          count(*) FILTER (event_id % 50 = 0) AS bad_rows
        FROM watch_export
        GROUP BY participant_id, file_name HAVING count(*) FILTER (event_id % 50 = 0) > 0""",
    ),
    "bad_row_quarantine": _select(
        WATCH_EXPORT,
        """SELECT participant_id || '/Watch/' || file_name AS file,
          "timestamp" || ',' || participant || ',' || v || ',' || (v * (event_id % 7))
            || ',' || (v * (event_id % 11)) || ',' || (v * (event_id % 13)) || ',surplus' AS record
        FROM watch_export WHERE event_id % 50 = 0""",
    ),
    "dataset_selection": """
      SELECT 'aware_battery' AS table_name, count(*) AS "rows" FROM events
        WHERE event_type = 'view'
      UNION ALL SELECT 'aware_screen', count(*) FROM events
        WHERE event_type = 'error'
      UNION ALL SELECT 'watch', count(*) FROM events""",
    "rename_sanitize": """
      WITH parts AS (SELECT url || '.csv' AS old_key,
          regexp_extract(url || '.csv', '^(.*)/[^/]*$', 1) AS dir,
          regexp_extract(url || '.csv', '([^/]*)$', 1) AS old_name FROM pages),
      cleaned AS (SELECT *, trim(regexp_replace(regexp_replace(
          regexp_replace(old_name, '\\.csv$', ''), '[^A-Za-z0-9._-]', '_', 'g'),
          '_+', '_', 'g'), '._ ') AS stem FROM parts)
      SELECT old_key, dir, old_name,
        CASE WHEN stem = '' THEN 'unnamed' ELSE stem END || '.csv' AS new_name,
        CASE WHEN stem = '' THEN 'unnamed' ELSE stem END || '.csv' <> old_name AS changed
      FROM cleaned""",
    "rename_plan": _select(
        KEYS,
        """SELECT old_key, old_key AS new_key, FALSE AS changed FROM named WHERE stem = old_stem
        UNION ALL
        SELECT c.old_key, c.dir || '/' || c.stem ||
          CASE WHEN c.nth = 0 THEN '' ELSE '_' || f.n END || '.csv', TRUE
        FROM claims c LEFT JOIN free f ON f.dir = c.dir AND f.stem = c.stem AND f.nth = c.nth""",
    ),
    "impute_median": "WITH " + FEATURES + _filled("f_all"),
    "scale_standard": _select(
        FEATURES
        + ",\nmoments AS (SELECT "
        + ", ".join(
            f"avg({c}) AS a{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(schemas.FEATURES)
        )
        + " FROM f_all)",
        "SELECT participant, "
        + ", ".join(
            f"round(({c} - a{i}) / CASE WHEN s{i} = 0 THEN 1 ELSE s{i} END, 6) AS {c}"
            for i, c in enumerate(schemas.FEATURES)
        )
        + " FROM f_all, moments",
    ),
    "stratified_folds": """
      SELECT doc_id, quality, CAST((row_number() OVER (
          ORDER BY quality, md5('42-' || doc_id)) - 1) % 5 AS INTEGER) AS fold FROM labels""",
    "class_distribution": 'SELECT quality, count(*) AS "rows" FROM labels GROUP BY quality',
    "fold_metrics": _select(PREDICTIONS, "SELECT * FROM basic"),
    "fold_auc": _select(PREDICTIONS, "SELECT * FROM auc"),
    "metric_summary": _select(
        SUMMARY,
        "SELECT model, "
        + ", ".join(f"round({c}, 9) AS {c}" for c in SUMMARY_COLUMNS)
        + " FROM summary",
    ),
    "leaderboard": _select(
        SUMMARY,
        "SELECT model, "
        + ", ".join(f"round_even({c}, 4) AS {c}" for c in SUMMARY_COLUMNS)
        + " FROM summary ORDER BY f1_mean DESC",
    ),
    "importance_topk": _select(
        _brands("b", "p_retailprice"),
        "SELECT feature, importance FROM b ORDER BY importance DESC, feature LIMIT 15",
    ),
    "importance_compare": _select(
        _brands("l", "p_retailprice") + "," + _brands("r", "p_size"),
        """SELECT feature, l.importance AS importance_left, rank_left,
          r.importance AS importance_right, rank_right,
          coalesce(rank_left <= 10 AND rank_right <= 10, FALSE) AS in_both_top
        FROM (SELECT *, CAST(rank() OVER (ORDER BY importance DESC) AS INTEGER) AS rank_left FROM l) l
        FULL JOIN (SELECT *, CAST(rank() OVER (ORDER BY importance DESC) AS INTEGER) AS rank_right
          FROM r) r USING (feature)""",
    ),
}

AUDIT = _select(
    MODEL
    + """,
dealt AS (SELECT loneliness_label_binary AS label, (row_number() OVER (
    ORDER BY loneliness_label_binary, md5('42-' || participant)) - 1) % 5 AS fold FROM model)""",
    """SELECT '{model}' AS model, CAST(fold AS INTEGER) AS fold, count(*) AS n_rows,
      CAST(sum(label) AS BIGINT) AS n_positive, count(*) AS keys_once, TRUE AS sound
    FROM dealt GROUP BY fold""",
)
IMPORTANCES = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, TRUE AS in_range, TRUE AS sums_to_one" for c in schemas.FEATURES
)
LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount"
)
ORACLES |= {
    name: AUDIT.replace("{model}", model)
    for name, model in (
        ("cv_random_forest", "Random Forest"),
        ("cv_gbt", "XGBoost"),
        ("cv_rbf_svm", "SVM"),
        ("cv_mlp", "Neural Network"),
    )
}
ORACLES |= {
    "rf_importance": IMPORTANCES,
    "gbt_importance": IMPORTANCES,
    **{
        query: f"SELECT '{model}' AS model, CAST(range AS INTEGER) AS fold, TRUE AS found FROM range(5)"
        for query, model in (
            ("planted_auc", "SVM"),
            ("planted_forest", "Random Forest"),
            ("planted_boosted", "XGBoost"),
            ("planted_network", "Neural Network"),
        )
    },
    "median_large": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", median(CAST({c} AS DOUBLE)) AS median FROM lineitem"
        for c in LINE_COLUMNS
    ),
    "fold_metrics_undefined": _select(
        PREDICTIONS.replace(
            "FROM preds)",
            "FROM preds WHERE fold <> 3 AND CAST(score * 50 AS INTEGER) % 7 <> 0)",
        ),
        "SELECT basic.*, roc_auc FROM basic LEFT JOIN auc USING (model, fold)",
    ),
    "labels_repeated_answers": _select(
        _labels("one")
        .replace(
            "ucla AS (SELECT * FROM long WHERE file_stem LIKE '%UCLA%')",
            """twice AS (SELECT * FROM long UNION ALL SELECT * REPLACE (
              CASE WHEN length(file_stem) % 3 = 0 THEN 'maybe' WHEN length(participant) % 2 = 0
                THEN 'Rarely' ELSE response_raw END AS response_raw) FROM long),
            ucla AS (SELECT * FROM twice WHERE file_stem LIKE '%UCLA%')""",
        ),
        "SELECT * FROM labels_",
    ),
    "model_table_roundtrip": ORACLES["model_table_filled"],
    "csv_mixed_ingest": _select(
        WATCH_EXPORT,
        """SELECT participant_id, participant, v AS hrm FROM watch_export
        UNION ALL SELECT 'Participant_3', 'unreadable', NULL""",
    ),
    "reload_subset": _select(
        WATCH_EXPORT,
        """SELECT participant_id, participant, "timestamp", v AS hrm FROM watch_export
        WHERE participant_id NOT IN ('Participant_5', 'Participant_6') OR event_id % 2 = 0""",
    ),
    "append_changed_files": f"""
      SELECT participant_id, participant, "timestamp", battery_charge_start, battery_charge_end
      FROM ({PHONE_EXPORTS["battery"]})""",
    "file_ledger": _select(
        WATCH_EXPORT,
        """SELECT participant_id || '/Watch/' || file_name AS file,
          count(*) FILTER (event_id % 50 <> 0) AS "rows",
          count(*) FILTER (event_id % 50 = 0) AS bad_rows
        FROM watch_export GROUP BY participant_id, file_name""",
    ),
    "cast_ledger": _select(
        WATCH_EXPORT,
        """SELECT participant_id || '/Watch/' || file_name AS file, "column", count(*) AS lost
        FROM (SELECT *, 'hrm' AS "column" FROM watch_export WHERE event_id % 7 = 0
          UNION ALL SELECT *, 'accy' FROM watch_export WHERE event_id % 11 = 0)
        GROUP BY participant_id, file_name, "column"
        """,
    ),
    "results_written": _select(
        MODEL,
        """SELECT 'labels' AS table_name, count(*) AS "rows" FROM labels_
        UNION ALL SELECT 'model_table', count(*) FROM model
        UNION ALL SELECT 'model_table_filled', count(*) FROM model
        UNION ALL SELECT 'cv_results', 4 UNION ALL SELECT 'cv_results_rounded', 4"""
        + "".join(
            f" UNION ALL SELECT 'importance_{tree}', {len(schemas.FEATURES)}"
            for tree in ("random_forest", "xgboost")
        ),
    ),
}
ORACLES["features_from_states"] = ORACLES["battery_features"]
ORACLES["features_bucketed"] = ORACLES["features_merged"]
ORACLES["kernel_errors"] = """
  SELECT 'fourier' AS map, TRUE AS small, FALSE AS closest
  UNION ALL SELECT 'landmarks', TRUE, TRUE"""
