"""Names and types of the accident data, as stored, as streamed and as reported."""

from __future__ import annotations

# --- Fixed values: field order and types of an accident message (positional CSV). ---
ACCIDENT_DDL = """
    ID STRING, Source STRING, Severity INT,
    Start_Time TIMESTAMP, End_Time TIMESTAMP,
    Start_Lat DOUBLE, Start_Lng DOUBLE, End_Lat DOUBLE, End_Lng DOUBLE, Distance_mi DOUBLE,
    Description STRING, Street STRING, City STRING, County STRING, State STRING,
    Zipcode STRING, Country STRING, Timezone STRING, Airport_Code STRING,
    Weather_Timestamp TIMESTAMP,
    Temperature_F DOUBLE, Wind_Chill_F DOUBLE, Humidity_percent DOUBLE, Pressure_in DOUBLE,
    Visibility_mi DOUBLE, Wind_Direction STRING, Wind_Speed_mph DOUBLE,
    Precipitation_in DOUBLE, Weather_Condition STRING,
    Amenity BOOLEAN, Bump BOOLEAN, Crossing BOOLEAN, Give_Way BOOLEAN, Junction BOOLEAN,
    No_Exit BOOLEAN, Railway BOOLEAN, Roundabout BOOLEAN, Station BOOLEAN, Stop BOOLEAN,
    Traffic_Calming BOOLEAN, Traffic_Signal BOOLEAN, Turning_Loop BOOLEAN,
    Sunrise_Sunset STRING, Civil_Twilight STRING, Nautical_Twilight STRING,
    Astronomical_Twilight STRING
"""

# --- Fixed values: unit-suffixed names of the raw file and their clean names. ---
UNIT_COLUMNS = {
    "Distance(mi)": "Distance_mi",
    "Temperature(F)": "Temperature_F",
    "Wind_Chill(F)": "Wind_Chill_F",
    "Humidity(%)": "Humidity_percent",
    "Pressure(in)": "Pressure_in",
    "Visibility(mi)": "Visibility_mi",
    "Wind_Speed(mph)": "Wind_Speed_mph",
    "Precipitation(in)": "Precipitation_in",
}

# --- Fixed values: the window measures, in output order. ---
MEAN_COLUMNS = [
    "Visibility_mi", "Wind_Speed_mph", "Temperature_F", "Humidity_percent", "Pressure_in",
    "Distance_mi", "Precipitation_in", "Start_Lat", "Start_Lng",
]
RATE_COLUMNS = ["Junction", "Traffic_Signal", "Crossing"]
CATEGORY_COLUMNS = ["Weather_Condition", "Wind_Direction", "Sunrise_Sunset"]
COUNT_COLUMN = "accident_count"
DAY_COLUMN = "window_day"

# --- Fixed values: texts a pandas CSV reader takes as missing by default. ---
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

EVENT_TIME = "Start_Time"
COERCED_TIMES = ["Start_Time", "End_Time"]
INDEXED_COLUMNS = [f"{name}Indexed" for name in CATEGORY_COLUMNS]
FEATURE_INPUTS = MEAN_COLUMNS + RATE_COLUMNS + INDEXED_COLUMNS


def _fields(ddl: str) -> list[tuple[str, str]]:
    return [tuple(field.split(maxsplit=1)) for field in ddl.split(",")]


ACCIDENT_FIELDS = _fields(ACCIDENT_DDL)
ACCIDENT_COLUMNS = [name for name, _ in ACCIDENT_FIELDS]

WINDOW_FEATURES_DDL = ", ".join(
    ["window_start TIMESTAMP", "window_end TIMESTAMP", f"{COUNT_COLUMN} BIGINT"]
    + [f"{name} DOUBLE" for name in MEAN_COLUMNS + RATE_COLUMNS]
    + [f"{name} STRING" for name in CATEGORY_COLUMNS]
)

# JSON form of an ML vector, as the file sink writes it.
VECTOR_DDL = "STRUCT<type: TINYINT, size: INT, indices: ARRAY<INT>, values: ARRAY<DOUBLE>>"
PREDICTION_DDL = ", ".join(
    [WINDOW_FEATURES_DDL]
    + [f"{name} DOUBLE" for name in INDEXED_COLUMNS]
    + [f"{name} {VECTOR_DDL}" for name in ("features", "rawPrediction", "probability")]
    + ["prediction DOUBLE"]
)
