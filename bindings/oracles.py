"""DuckDB SQL for the queries, written on its own terms over the same derived rows."""

from __future__ import annotations

from bindings import stand_ins
from riskloom import schema

MEASURED = stand_ins.select(stand_ins.MEASURED_EVENTS)
ACCIDENTS = stand_ins.select(stand_ins.ACCIDENT_FIELDS)
SCORED = stand_ins.select(stand_ins.PREDICTION_FIELDS)


def _windows(
    rows: str,
    time: str,
    width: int,
    slide: int,
    means: list[str],
    rates: list[str],
    modes: list[str],
    count: str,
    delay: int | None = None,
) -> str:
    """Every row beside the starts of its windows, then one group per start. Times in minutes."""
    starts = -(-width // slide)
    averages = [f"avg({name})" for name in means] + [
        f"avg(CASE WHEN {name} THEN 1e0 WHEN NOT {name} THEN 0e0 END)" for name in rates
    ]
    names = means + rates
    parts = [
        f"""x AS (
            SELECT * FROM (
                SELECT r.*, time_bucket(INTERVAL {slide} MINUTE, {time})
                            - k * INTERVAL {slide} MINUTE AS ws
                FROM ({rows}) r CROSS JOIN range({starts}) AS o(k))
            WHERE ws + INTERVAL {width} MINUTE > {time})""",
        "a AS (SELECT ws, count(*) AS "
        + f"{count}, "
        + ", ".join(f"{text} AS {name}" for text, name in zip(averages, names))
        + " FROM x GROUP BY ws)",
    ]
    for name in modes:
        parts.append(
            f"""m_{name} AS (
            SELECT ws, {name} FROM (
                SELECT ws, {name}, row_number() OVER (
                    PARTITION BY ws ORDER BY count(*) DESC, {name}) AS place
                FROM x WHERE {name} IS NOT NULL GROUP BY ws, {name})
            WHERE place = 1)"""
        )
    joins = " ".join(f"LEFT JOIN m_{name} USING (ws)" for name in modes)
    columns = ", ".join([count, *names, *modes])
    closed = ""
    if delay is not None:
        closed = f"""WHERE ws + INTERVAL {width} MINUTE <= (
            SELECT date_trunc('millisecond', max({time})) - INTERVAL {delay} MINUTE
            FROM ({rows}))"""
    return f"""WITH {', '.join(parts)}
        SELECT ws AS window_start, ws + INTERVAL {width} MINUTE AS window_end, {columns}
        FROM a {joins} {closed}"""


def _event_windows(width: int, slide: int, rows: str = MEASURED, delay: int | None = None):
    return _windows(
        rows, "ts", width, slide,
        ["cents", "paid_cents"], ["is_error"], ["event_type", "kind"], "n", delay,
    )


def _accident_windows(width: int, slide: int, delay: int | None = None) -> str:
    return _windows(
        ACCIDENTS, "Start_Time", width, slide,
        schema.MEAN_COLUMNS, schema.RATE_COLUMNS, schema.CATEGORY_COLUMNS, "accident_count", delay,
    )


def _some(rows: str, columns: str, where: str = "true") -> str:
    return f"SELECT {columns} FROM ({rows}) WHERE {where}"


_LABEL = "CASE WHEN Severity >= 3 THEN 1 ELSE 0 END"
_REPORT = """
    round_even(avg(prediction) * 1000, 0) / 1000 AS Avg_Prediction,
    round_even(avg(high_severity_prob) * 1000, 0) / 1000 AS Avg_Probability,
    CAST(sum(accident_count) AS BIGINT) AS Total_Accidents"""


def _uniform(seed: int) -> str:
    return f"(CAST('0x' || substr(md5('{seed}:' || ID), 1, 13) AS BIGINT) / 4503599627370496e0)"


def _index(column: str) -> str:
    """Place by falling frequency, then name; one place after the last for a missing value."""
    return f"""(SELECT {column}, row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS place
        FROM a WHERE {column} IS NOT NULL GROUP BY {column})"""


def _top(key: str, rows: str) -> str:
    return f"""SELECT *, Avg_Probability > 0.5 AS above_threshold
        FROM (SELECT {key}, {_REPORT} FROM ({rows})
              WHERE {key} IS NOT NULL AND {key} <> 'Clear' GROUP BY {key})
        ORDER BY Avg_Probability DESC, {key} LIMIT 15"""


# The events but for those of the first third whose window had ended, less the delay, when the
# second third was through.
_IN_TIME = f"""
    SELECT m.* FROM ({MEASURED}) m CROSS JOIN (
        SELECT lo + to_microseconds(third) AS t1, lo + to_microseconds(2 * third) AS t2
        FROM (SELECT min(ts) AS lo, (epoch_us(max(ts)) - epoch_us(min(ts))) // 3 AS third
              FROM events)) t
    WHERE ts >= t1 OR time_bucket(INTERVAL 60 MINUTE, ts) + INTERVAL 60 MINUTE > (
        SELECT date_trunc('millisecond', max(e.ts)) FROM events e WHERE e.ts < t2)
        - INTERVAL 13 DAY"""

_ACCIDENT_TEXT = ACCIDENTS.replace("chr(10)", "' '")
_UNIT_COLUMNS = ", ".join(schema.UNIT_COLUMNS.values())
_READABLE_END = "CASE WHEN Severity < 3 THEN End_Time END"

_CLEANED = f"""SELECT * REPLACE (
    {_READABLE_END} AS End_Time, Weather_Condition AS Wind_Direction) FROM ({ACCIDENTS})"""
_INPUTS = schema.MEAN_COLUMNS + schema.RATE_COLUMNS
_COMPLETE = " AND ".join(f"{name} IS NOT NULL" for name in _INPUTS)
_IN_SAMPLE = f"{_uniform(36)} < CASE WHEN Severity >= 3 THEN 1e0 ELSE 0.24e0 END"

ORACLES = {
    "tumbling_features": _event_windows(60, 60),
    "sliding_features": _event_windows(60, 30),
    "uneven_sliding_features": _event_windows(50, 20),
    "accident_tumbling_features": _accident_windows(60, 60),
    "accident_sliding_features": _accident_windows(360, 60),
    "mean_windows": _windows(
        MEASURED, "ts", 60, 30, ["cents", "paid_cents"], ["is_error"], [], "n"
    ),
    "null_event_time": _event_windows(60, 60, f"SELECT * FROM ({MEASURED}) WHERE NOT is_error"),
    "incomplete_windows": f"""
        SELECT count(*) AS windows, count(*) FILTER (WHERE {
            " OR ".join(f"{c} IS NULL" for c in schema.MEAN_COLUMNS + schema.RATE_COLUMNS)
        }) AS skipped_windows FROM ({_accident_windows(10, 10)})""",
    "closed_windows": _event_windows(60, 60, delay=60),
    "stream_tumbling": _event_windows(60, 60, delay=60),
    "stream_sliding": _event_windows(60, 30, delay=60),
    "stream_restart": _event_windows(60, 60, delay=60),
    "stream_open_windows": f"""
        SELECT window_start, window_end, n, cents, paid_cents, is_error FROM ({_event_windows(60, 60)})
        WHERE window_end > (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 2 DAY FROM events)""",
    "late_rows": _event_windows(60, 60, _IN_TIME, delay=13 * 24 * 60),
    "late_row_counts": f"""
        SELECT * EXCLUDE (in_time), CAST(in_time - emitted_rows AS BIGINT) AS open_rows, read_rows - in_time AS late_rows
        FROM (SELECT (SELECT count(*) FROM events) AS read_rows, (SELECT count(*) FROM ({_IN_TIME})) AS in_time,
                     (SELECT CAST(coalesce(sum(n), 0) AS BIGINT)
                      FROM ({_event_windows(60, 60, _IN_TIME, delay=13 * 24 * 60)})) AS emitted_rows)""",
    "unscored_windows": f"""
        SELECT (SELECT count(*) FROM events) AS rows, CAST(0 AS BIGINT) AS timeless_rows, count(*) AS windows,
               count(*) FILTER (WHERE {
            " OR ".join(f"{c} IS NULL" for c in schema.MEAN_COLUMNS + schema.RATE_COLUMNS)
        }) AS unscored_windows FROM ({_accident_windows(10, 10, delay=10)})""",
    "message_windows": _accident_windows(360, 60, delay=60),
    "csv_parse": "SELECT * FROM events",
    "csv_shapes": """
        SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
               CASE WHEN event_type NOT IN ('view', 'error') THEN CAST(user_id AS INT) END
                   AS user_id,
               CASE WHEN event_type = 'view' THEN 7
                    WHEN event_type NOT IN ('click', 'error') THEN 3 END AS third
        FROM events""",
    "accident_messages": _ACCIDENT_TEXT,
    "replay_roundtrip": "SELECT * FROM events",
    "replay_in_order": _event_windows(60, 60, delay=1),
    "blank_messages": """
        SELECT event_type || ' ' AS first, concat('  ', event_id, ' ') AS middle,
               ' ' || event_type AS last, way
        FROM events CROSS JOIN (VALUES ('files'), ('topic')) AS w(way)""",
    "rename_coerce": _some(
        ACCIDENTS,
        f"ID, Start_Time, {_READABLE_END} AS End_Time, Weather_Condition AS Wind_Direction, "
        + _UNIT_COLUMNS,
    ),
    "clean_csv_files": _CLEANED,
    "csv_inferred": _some(
        ACCIDENTS,
        "ID, Severity, Distance_mi, Description, Start_Lat, Precipitation_in, Junction, Start_Time",
    ),
    "clean_other_columns": _CLEANED,
    "clean_parquet_files": _CLEANED,
    "drop_nulls": _some(
        ACCIDENTS,
        "ID, Weather_Condition, Precipitation_in, Wind_Chill_F",
        "Weather_Condition IS NOT NULL AND Precipitation_in IS NOT NULL "
        "AND Wind_Chill_F IS NOT NULL",
    ),
    "severity_label": f"""
        SELECT o_orderkey, severity, CASE WHEN severity >= 3 THEN 1 ELSE 0 END AS label
        FROM ({stand_ins.select(stand_ins.ORDER_FIELDS, "orders")})""",
    "stratified_sample": f"""
        SELECT ID, {_LABEL} AS label FROM ({ACCIDENTS})
        WHERE {_IN_SAMPLE}""",
    "random_stratified_sample": f"""
        SELECT {_LABEL} AS label, count(*) AS rows, CAST(1 AS BIGINT) AS most_times,
               true AS as_due
        FROM ({ACCIDENTS}) GROUP BY 1""",
    "random_split": """
        SELECT count(*) AS rows, count(*) AS rows_in_one_part, true AS as_due FROM events""",
    "train_test_split": f"""
        SELECT ID, {_LABEL} AS label,
               CASE WHEN {_uniform(5043)} < 0.85e0 THEN 'train' ELSE 'test' END AS part
        FROM ({ACCIDENTS})""",
    "category_index": f"""
        WITH a AS ({ACCIDENTS})
        SELECT ID, Weather_Condition, Wind_Direction,
               CAST(coalesce(w.place, (SELECT count(DISTINCT Weather_Condition) FROM a))
                    AS DOUBLE) AS Weather_ConditionIndexed,
               CAST(coalesce(d.place, (SELECT count(DISTINCT Wind_Direction) FROM a))
                    AS DOUBLE) AS Wind_DirectionIndexed
        FROM a LEFT JOIN {_index("Weather_Condition")} w USING (Weather_Condition)
               LEFT JOIN {_index("Wind_Direction")} d USING (Wind_Direction)""",
    "category_index_wide": """
        WITH a AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS part FROM lineitem),
        i AS (SELECT part, row_number() OVER (ORDER BY count(*) DESC, part) - 1 AS place
              FROM a GROUP BY part)
        SELECT a.*, CAST(place AS DOUBLE) AS partIndexed FROM a JOIN i USING (part)""",
    "category_index_hot": """
        WITH a AS (SELECT l_orderkey, l_linenumber,
                          CASE WHEN l_orderkey % 3 = 0 THEN 'hot' WHEN l_orderkey % 10 = 1 THEN NULL
                               ELSE CAST(l_partkey AS VARCHAR) END AS part FROM lineitem),
        i AS (SELECT part, row_number() OVER (ORDER BY count(*) DESC, part) - 1 AS place
              FROM a WHERE part IS NOT NULL GROUP BY part)
        SELECT a.*, CAST(coalesce(place, (SELECT count(*) FROM i)) AS DOUBLE) AS partIndexed
        FROM a LEFT JOIN i USING (part)""",
    "gbt_score": f"""
        SELECT ID, {_LABEL} AS label, true AS prediction_is_likelier
        FROM ({ACCIDENTS}) WHERE {_COMPLETE}""",
    "gbt_score_rows": f"""
        SELECT ID, {_LABEL} AS label, {', '.join(_INPUTS + schema.CATEGORY_COLUMNS)},
               true AS all_inputs, true AS prediction_is_likelier
        FROM ({ACCIDENTS}) WHERE {_COMPLETE}""",
    "gbt_heldout": f"""
        SELECT ID, {_LABEL} AS label, true AS prediction_is_likelier FROM ({ACCIDENTS})
        WHERE {_COMPLETE} AND {_IN_SAMPLE} AND {_uniform(5043)} >= 0.85e0""",
    "gbt_stream_score": f"""
        SELECT window_start, window_end, accident_count, {', '.join(schema.CATEGORY_COLUMNS)},
               true AS prediction_is_likelier
        FROM ({_accident_windows(60, 60, delay=60)}) WHERE {_COMPLETE}""",
    "assembled_rows": _some(
        ACCIDENTS,
        "ID, Wind_Chill_F AS feature_0, Precipitation_in AS feature_1, "
        "CASE WHEN Junction THEN 1e0 ELSE 0e0 END AS feature_2, Distance_mi AS feature_3",
        "Wind_Chill_F IS NOT NULL AND Precipitation_in IS NOT NULL",
    ),
    "scored_windows": f"""
        SELECT *, true AS prediction_is_likelier FROM ({_accident_windows(60, 60, delay=60)})
        WHERE {
            " AND ".join(f"{c} IS NOT NULL" for c in schema.MEAN_COLUMNS + schema.RATE_COLUMNS)
        }""",
    "auc": f"""
        WITH ranked AS (
            SELECT is_error, rank() OVER (ORDER BY cents)
                   + (count(*) OVER (PARTITION BY cents) - 1) / 2e0 AS mid
            FROM ({MEASURED}))
        SELECT round((sum(mid) FILTER (WHERE is_error)
                      - count(*) FILTER (WHERE is_error)
                        * (count(*) FILTER (WHERE is_error) + 1) / 2e0)
                     / (count(*) FILTER (WHERE is_error)
                        * count(*) FILTER (WHERE NOT is_error)), 6) AS area_under_roc
        FROM ranked""",
    "prediction_readback": _some(
        SCORED,
        "date_trunc('millisecond', window_start) AS window_start, accident_count, "
        "Weather_Condition, prediction, high_severity_prob",
    ),
    "predictions_of_days": _some(
        SCORED,
        "date_trunc('millisecond', window_start) AS window_start, accident_count, "
        "Weather_Condition, prediction, high_severity_prob",
        "window_start >= '2024-01-10' AND window_start < '2024-01-13'",
    ),
    "prediction_preview": f"""
        SELECT CAST(prediction AS INT) AS label, prediction, high_severity_prob AS probability
        FROM ({SCORED}) ORDER BY event_id LIMIT 5""",
    "category_report": f"""
        SELECT Weather_Condition, {_REPORT} FROM ({SCORED})
        WHERE Weather_Condition <> 'Clear' GROUP BY Weather_Condition""",
    "category_risk_top": _top("Weather_Condition", SCORED),
    "top_k": _top(
        "user_id",
        stand_ins.select(
            {**stand_ins.PREDICTION_FIELDS, "user_id": "CAST(user_id AS VARCHAR)"}
        ),
    ),
    "threshold_split": f"""
        SELECT Weather_Condition, count(*) FILTER (WHERE high_severity_prob > 0.5) AS above,
               count(*) FILTER (WHERE high_severity_prob <= 0.5) AS up_to
        FROM ({SCORED}) GROUP BY Weather_Condition""",
    "hour_weekday_heatmap": "SELECT CAST(hour(window_start) AS INT) AS hour, "
    + ", ".join(
        f"avg(high_severity_prob) FILTER (WHERE isodow(window_start) = {number}) AS {day}"
        for number, day in enumerate(["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"], 1)
    )
    + f" FROM ({SCORED}) GROUP BY 1",
    "prob_histogram": f"""
        WITH p AS ({SCORED}),
        edges AS (
            SELECT CAST(i AS INT) AS bin, lo + i * ((hi - lo) / 20) AS bin_start,
                   CASE WHEN i = 19 THEN hi ELSE lo + (i + 1) * ((hi - lo) / 20) END AS bin_end
            FROM (SELECT min(high_severity_prob) AS lo, max(high_severity_prob) AS hi FROM p)
                 CROSS JOIN range(20) AS r(i))
        SELECT bin, bin_start, bin_end, count(high_severity_prob) AS count
        FROM edges LEFT JOIN p ON high_severity_prob >= bin_start
             AND (high_severity_prob < bin_end OR (bin = 19 AND high_severity_prob = bin_end))
        GROUP BY ALL""",
}
