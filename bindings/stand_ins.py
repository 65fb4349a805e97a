"""Accident-like rows derived from the driver's tables, row by row and over the whole table.

The expressions are SQL that Spark and DuckDB read alike. Measures are whole numbers, so sums are
exact in any order; probabilities are whole numbers over a power of two for the same reason.
"""

from __future__ import annotations

from riskloom import schema

CENTS = "round(value * 100)"
PROBABILITY = f"({CENTS} / 65536e0)"

MEASURED_EVENTS = {
    "event_id": "event_id",
    "ts": "ts",
    "cents": CENTS,
    "paid_cents": f"CASE WHEN event_type = 'purchase' THEN {CENTS} END",
    "is_error": "event_type = 'error'",
    "event_type": "event_type",
    "kind": "nullif(event_type, 'signup')",
}

_NIGHT = "CASE WHEN hour(ts) BETWEEN 6 AND 17 THEN 'Day' ELSE 'Night' END"
_WEATHER = (
    "CASE event_type WHEN 'view' THEN 'Clear' WHEN 'click' THEN 'Light Rain' "
    "WHEN 'purchase' THEN 'Snow' WHEN 'error' THEN 'Fog' END"
)
_WIND = "CASE user_id % 4 WHEN 0 THEN 'N' WHEN 1 THEN 'E' WHEN 2 THEN 'S' ELSE 'W' END"
_SEVERITY = (
    "1 + CAST(user_id % 2 AS INT) + CASE WHEN event_type = 'error' THEN 1 ELSE 0 END "
    f"+ CASE WHEN {CENTS} > 5000 THEN 1 ELSE 0 END"
)


def _remainder(column: str, divisor: int, offset: int = 0) -> str:
    return f"CAST({offset} + {column} % {divisor} AS DOUBLE)"


# One expression per field of an accident message, in message order.
ACCIDENT_FIELDS = dict(
    zip(
        schema.ACCIDENT_COLUMNS,
        [
            "concat('A-', event_id)",
            "concat('Source', user_id % 3)",
            f"CAST({_SEVERITY} AS INT)",
            "ts",
            "ts + INTERVAL 30 MINUTE",
            _remainder("event_id", 24, 25),
            _remainder("user_id", 55, -125),
            "CAST(NULL AS DOUBLE)",
            "CAST(NULL AS DOUBLE)",
            CENTS,
            "concat('Call \"', event_id, ', lane closed\"', chr(10), 'slow, exit ', user_id)",
            "props",
            "concat('City ', user_id % 20)",
            "concat('County ', user_id % 10)",
            "concat('S', user_id % 5)",
            "concat('Z', event_id % 90000)",
            "'US'",
            "'US/Eastern'",
            "concat('K', user_id % 30)",
            "date_trunc('minute', ts)",
            _remainder("event_id", 90, 10),
            f"nullif({_remainder('event_id', 70)}, 0e0)",
            _remainder("user_id", 100),
            "CAST(25 + event_id % 6 AS DOUBLE)",
            _remainder("event_id", 11),
            _WIND,
            f"nullif({_remainder('user_id', 9)}, 8e0)",
            f"CASE WHEN event_type <> 'click' THEN {_remainder('event_id', 3)} END",
            _WEATHER,
            *[f"event_id % {2 + position} = 0" for position in range(13)],
            _NIGHT,
            _NIGHT,
            _NIGHT,
            f"CASE WHEN user_id % 7 > 0 THEN {_NIGHT} END",
        ],
        strict=True,
    )
)

# Each event as a scored window of its own.
PREDICTION_FIELDS = {
    "event_id": "event_id",
    "window_start": "ts",
    "accident_count": "1 + user_id % 7",
    "Weather_Condition": _WEATHER,
    "prediction": f"CASE WHEN {PROBABILITY} > 0.5e0 THEN 1e0 ELSE 0e0 END",
    "high_severity_prob": PROBABILITY,
}

# Priority text to a severity, missing where the priority is not specified.
ORDER_FIELDS = {
    "o_orderkey": "o_orderkey",
    "severity": (
        "CASE WHEN o_orderpriority LIKE '%NOT SPECIFIED' THEN NULL "
        "ELSE CAST(substr(o_orderpriority, 1, 1) AS INT) END"
    ),
}


def expressions(fields: dict[str, str]) -> list[str]:
    return [f"{text} AS {name}" for name, text in fields.items()]


def select(fields: dict[str, str], table: str = "events") -> str:
    return f"SELECT {', '.join(expressions(fields))} FROM {table}"
