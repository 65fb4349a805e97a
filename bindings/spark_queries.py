"""The engine's queries on the driver's tables. Each takes (spark, folder of the tables)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bindings import stand_ins
from riskloom import schema
from riskloom.functions import columns as fn
from riskloom.operators import cleaning, parsing, reports, sampling, windows
from riskloom.operators.windows import EventWindow, Measures
from riskloom.plans import training
from riskloom.plans.ingest import CLUSTER_COLUMNS, typed
from riskloom.session import fresh_folder, stream_session, utc_session
from riskloom.sources import messages, models, predictions as stored, tables
from riskloom.streaming.counts import StreamCounts, counting_rows
from riskloom.streaming.replay import replay_to_files
from riskloom.streaming.scoring import message_features, score_messages
from riskloom.streaming.sinks import append_files
from riskloom.streaming.state import open_windows

EVENTS_DDL = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
    "props STRING"
)
EVENT_MEASURES = Measures(
    means=["cents", "paid_cents"], rates=["is_error"], modes=["event_type", "kind"], count="n"
)
TUMBLING = EventWindow("1 hour")
SLIDING = EventWindow("1 hour", "30 minutes")
UNEVEN = EventWindow("50 minutes", "20 minutes")
LONG_SLIDING = EventWindow("6 hours", "1 hour")
#: So that files of the driver's tables have several splits.
SMALL_SPLIT = "1m"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return utc_session(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _events(spark: SparkSession, folder: str, fields: dict[str, str]) -> DataFrame:
    return _table(spark, folder, "events").selectExpr(*stand_ins.expressions(fields))


def measured(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder, stand_ins.MEASURED_EVENTS)


def accidents(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder, stand_ins.ACCIDENT_FIELDS)


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder, stand_ins.PREDICTION_FIELDS)


def _plain_times(df: DataFrame) -> DataFrame:
    """Times without a zone, as the tables have them."""
    return df.withColumns(
        {
            name: F.col(name).cast("timestamp_ntz")
            for name, kind in df.dtypes
            if kind == "timestamp"
        }
    )


# --- Window features over tables ------------------------------------------------------------


def _event_windows(window: EventWindow) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return windows.window_features(measured(spark, folder), window, EVENT_MEASURES, "ts")

    return query


def _accident_windows(window: EventWindow) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return windows.window_features(accidents(spark, folder), window)

    return query


def mean_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Means, rates and counts only, without a category."""
    measures = Measures(means=["cents", "paid_cents"], rates=["is_error"], count="n")
    return windows.window_features(measured(spark, folder), SLIDING, measures, "ts")


def null_event_time(spark: SparkSession, folder: str) -> DataFrame:
    """Errors lose their time and with it their window."""
    timeless = measured(spark, folder).withColumn("ts", F.when(~F.col("is_error"), F.col("ts")))
    return windows.window_features(timeless, TUMBLING, EVENT_MEASURES, "ts")


def closed_windows(spark: SparkSession, folder: str) -> DataFrame:
    """The windows of a table that a stream over it would have emitted."""
    rows = measured(spark, folder)
    features = windows.window_features(rows, TUMBLING, EVENT_MEASURES, "ts")
    return windows.closed_windows(features, rows, "ts", TUMBLING.duration)


def incomplete_windows(spark: SparkSession, folder: str) -> DataFrame:
    features = windows.window_features(accidents(spark, folder), EventWindow("10 minutes"))
    return windows.incomplete_windows(features, schema.MEAN_COLUMNS + schema.RATE_COLUMNS)


# --- Window features over streams -----------------------------------------------------------


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    # A pattern, since a stream takes a plain path for a folder and the table may be one file.
    rows = messages.table_stream(spark, f"{folder.rstrip('/')}/events.parquet*", EVENTS_DDL)
    return rows.selectExpr(*stand_ins.expressions(stand_ins.MEASURED_EVENTS)).withColumn(
        "ts", F.col("ts").cast("timestamp")
    )


def _run_to_files(spark: SparkSession, stream: DataFrame, name: str, file_format: str) -> str:
    path = fresh_folder(spark, name)
    checkpoint = fresh_folder(spark, f"{name}-checkpoint")
    append_files(stream, path, checkpoint, file_format, available_now=True).awaitTermination()
    return path


def _stream_windows(window: EventWindow) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows = _event_stream(stream_session(spark), folder)
        features = windows.window_features(rows, window, EVENT_MEASURES, "ts")
        path = _run_to_files(spark, _plain_times(features), "windows", "parquet")
        return spark.read.parquet(path)

    return query


def _accident_messages(spark: SparkSession, folder: str) -> str:
    """The accidents as message files, in stretches of time."""
    path = fresh_folder(spark, "messages")
    replay_to_files(accidents(spark, folder), path, ["Start_Time", "ID"])
    return path


def message_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Replay to message files, stream, parse, window, append JSON, read back."""
    source = _accident_messages(spark, folder)
    features = message_features(
        messages.file_messages(stream_session(spark), source), LONG_SLIDING, delay="1 hour"
    )
    path = _run_to_files(spark, features, "message-windows", "json")
    return _plain_times(utc_session(spark).read.schema(schema.WINDOW_FEATURES_DDL).json(path))


def _event_messages(lines: DataFrame) -> DataFrame:
    """The measured events in messages."""
    ddl = EVENTS_DDL.replace("TIMESTAMP_NTZ", "TIMESTAMP")
    rows = parsing.parse_csv(parsing.message_text(lines), ddl)
    return rows.selectExpr(*stand_ins.expressions(stand_ins.MEASURED_EVENTS))


class _Parts:
    """Events sent one part after the other; every part is a run of its own, begun anew from the
    checkpoint of the last."""

    def __init__(self, spark: SparkSession, parts: list[DataFrame], delay: str) -> None:
        self.spark, self.counts = spark, StreamCounts()
        source, self.target = fresh_folder(spark, "parts"), fresh_folder(spark, "part-windows")
        self.checkpoint = fresh_folder(spark, "part-checkpoint")
        for part in parts:
            replay_to_files(part, source, ["ts", "event_id"], mode="append")
            lines = messages.file_messages(stream_session(spark), source)
            rows = counting_rows(_event_messages(lines), TUMBLING, "ts")
            features = windows.window_features(rows, TUMBLING, EVENT_MEASURES, "ts", delay)
            query = append_files(
                _plain_times(features), self.target, self.checkpoint, "parquet", available_now=True
            )
            query.awaitTermination()
            self.counts.take(query)

    def emitted(self) -> DataFrame:
        return self.spark.read.parquet(self.target)

    def open(self) -> DataFrame:
        return _plain_times(open_windows(self.spark, self.checkpoint, EVENT_MEASURES))


def _thirds(events: DataFrame) -> list[DataFrame]:
    """The events of the first, second and last third of the time they cover."""
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    third = (high - low) // 3
    first, second = low + third, low + 2 * third
    time = F.col("ts")
    return [
        events.where(time < first),
        events.where((time >= first) & (time < second)),
        events.where(time >= second),
    ]


def stream_restart(spark: SparkSession, folder: str) -> DataFrame:
    """Three runs in the order of time: nothing is lost or repeated at a restart."""
    return _Parts(spark, _thirds(_table(spark, folder, "events")), "1 hour").emitted()


def stream_open_windows(spark: SparkSession, folder: str) -> DataFrame:
    """What the checkpoint of three runs holds: the windows that have not come out."""
    return _Parts(spark, _thirds(_table(spark, folder, "events")), "2 days").open()


def _out_of_order(spark: SparkSession, folder: str) -> _Parts:
    early, middle, last = _thirds(_table(spark, folder, "events"))
    return _Parts(spark, [middle, early, last], "13 days")


def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The second third comes first; of the first third only what the delay still allows counts."""
    return _out_of_order(spark, folder).emitted()


def late_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows such a stream has read, put out, holds still and dropped as late."""
    sent = _out_of_order(spark, folder)
    emitted, held = (df.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for df in (sent.emitted(), sent.open()))
    late = sent.counts.late_rows(emitted, held)
    fields = "read_rows BIGINT, emitted_rows BIGINT, open_rows BIGINT, late_rows BIGINT"
    return spark.createDataFrame([(sent.counts.rows, emitted, held, late)], fields)


def unscored_windows(spark: SparkSession, folder: str) -> DataFrame:
    """How many windows a stream puts out and how many of them no model scores. What a model does is no
    matter here, so it only gathers its inputs."""
    source = _accident_messages(spark, folder)
    inputs = schema.MEAN_COLUMNS + schema.RATE_COLUMNS
    model = PipelineModel([training.feature_assembler(inputs)])
    query = score_messages(
        messages.file_messages(stream_session(spark), source),
        model,
        EventWindow("10 minutes"),
        fresh_folder(spark, "predictions"),
        fresh_folder(spark, "checkpoint"),
        available_now=True,
    )
    query.awaitTermination()
    counts = StreamCounts().take(query)
    row = (counts.rows, counts.timeless_rows, counts.windows, counts.unscored_windows)
    return spark.createDataFrame([row], "rows BIGINT, timeless_rows BIGINT, windows BIGINT, unscored_windows BIGINT")


# --- Parsing, cleaning, replay --------------------------------------------------------------


def csv_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Rows to CSV messages in bytes and back to typed rows."""
    events = _table(spark, folder, "events")
    lines = events.select(parsing.csv_record(events).cast("binary").alias("value"))
    return parsing.parse_csv(parsing.message_text(lines), EVENTS_DDL)


def csv_shapes(spark: SparkSession, folder: str) -> DataFrame:
    """Short, overlong and unreadable records, by event type."""
    line = (
        F.when(F.col("event_type") == "click", F.concat_ws(",", "event_id", "user_id"))
        .when(F.col("event_type") == "view", F.concat_ws(",", "event_id", F.lit("x"), F.lit("7")))
        .when(F.col("event_type") == "error", F.lit(""))
        .otherwise(F.concat_ws(",", "event_id", "user_id", F.lit("3"), F.lit("extra")))
    )
    lines = _table(spark, folder, "events").select(line.alias("csv_line"))
    return parsing.parse_csv(lines, "event_id BIGINT, user_id INT, third INT")


def accident_messages(spark: SparkSession, folder: str) -> DataFrame:
    """All 46 fields through a message, quotes and commas included."""
    rows = accidents(spark, folder)
    lines = parsing.message_text(parsing.to_messages(rows))
    return _plain_times(parsing.parse_csv(lines))


def replay_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Message files read as a stream of several micro-batches."""
    source = fresh_folder(spark, "replay")
    events = _table(spark, folder, "events")
    replay_to_files(events, source, ["ts", "event_id"], files=8)
    lines = messages.file_messages(stream_session(spark), source, max_files_per_trigger=3)
    rows = parsing.parse_csv(parsing.message_text(lines), EVENTS_DDL)
    return spark.read.parquet(_run_to_files(spark, rows, "replayed", "parquet"))


def replay_in_order(spark: SparkSession, folder: str) -> DataFrame:
    """Message files streamed one by one with a delay far shorter than a file: no row is late."""
    source = fresh_folder(spark, "replay")
    replay_to_files(_table(spark, folder, "events"), source, ["ts", "event_id"], files=6)
    lines = messages.file_messages(stream_session(spark), source, max_files_per_trigger=1)
    features = windows.window_features(_event_messages(lines), TUMBLING, EVENT_MEASURES, "ts", "1 minute")
    return spark.read.parquet(_run_to_files(spark, _plain_times(features), "in-order", "parquet"))


def blank_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Texts that begin and end with blanks: white space inside a message stays, that around it
    goes, whether it is sent to files or to a topic."""
    texts = _table(spark, folder, "events").select(
        F.concat(F.lit(" \t"), "event_type", F.lit(" ")).alias("first"),
        F.concat(F.lit("  "), F.col("event_id").cast("string"), F.lit(" ")).alias("middle"),
        F.concat(F.lit(" "), "event_type", F.lit(" \t ")).alias("last"),
    )
    source = fresh_folder(spark, "blank-messages")
    replay_to_files(texts, source, ["middle"])
    ddl = "first STRING, middle STRING, last STRING"
    from_files = parsing.parse_csv(parsing.message_text(texts.sparkSession.read.text(source)), ddl)
    from_topic = parsing.parse_csv(parsing.message_text(parsing.to_messages(texts)), ddl)
    return from_files.withColumn("way", F.lit("files")).unionAll(
        from_topic.withColumn("way", F.lit("topic"))
    )


def _raw_accidents(spark: SparkSession, folder: str) -> DataFrame:
    raw_names = {clean: raw for raw, clean in schema.UNIT_COLUMNS.items()}
    rows = accidents(spark, folder).withColumn(
        "End_Time", F.when(F.col("Severity") < 3, F.col("End_Time").cast("string")).otherwise("?")
    )
    missing = rows.withColumn("Wind_Direction", F.coalesce("Weather_Condition", F.lit("N/A")))
    return missing.withColumnsRenamed(raw_names)


def rename_coerce(spark: SparkSession, folder: str) -> DataFrame:
    """Unit names, unreadable times and missing-value texts cleaned in place."""
    cleaned = cleaning.clean_accidents(_raw_accidents(spark, folder))
    return _plain_times(cleaned).select(
        "ID", "Start_Time", "End_Time", "Wind_Direction", *schema.UNIT_COLUMNS.values()
    )


def clean_csv_files(spark: SparkSession, folder: str) -> DataFrame:
    """Raw CSV files to cleaned CSV files to the typed table, with line breaks inside quotes. Each file is
    read by several tasks."""
    raw, cleaned = fresh_folder(spark, "raw"), fresh_folder(spark, "cleaned")
    tables.write_csv(_raw_accidents(spark, folder), raw)
    session = utc_session(spark)
    session.conf.set("spark.sql.files.maxPartitionBytes", SMALL_SPLIT)
    read = tables.read_raw_accidents(session, raw)
    tables.write_csv(cleaning.clean_accidents(read), cleaned)
    return _plain_times(tables.read_accidents(session, cleaned))


def csv_inferred(spark: SparkSession, folder: str) -> DataFrame:
    """CSV files under the types that are found in them."""
    path = fresh_folder(spark, "untyped")
    accident = accidents(spark, folder).select(
        "ID", "Severity", "Distance_mi", "Description", "Start_Lat", "Precipitation_in", "Junction", "Start_Time"
    )
    tables.write_csv(accident, path)
    return _plain_times(tables.read_csv_inferred(utc_session(spark), path))


def clean_other_columns(spark: SparkSession, folder: str) -> DataFrame:
    """A raw file with its columns in another order and one more."""
    raw, cleaned = fresh_folder(spark, "raw"), fresh_folder(spark, "cleaned")
    rows = _raw_accidents(spark, folder)
    mixed = [F.col(f"`{name}`") for name in sorted(rows.columns, key=lambda name: name[::-1])]
    tables.write_csv(rows.select(F.lit("x").alias("Other"), *mixed), raw)
    read = tables.read_raw_accidents(utc_session(spark), raw)
    tables.write_csv(cleaning.clean_accidents(read), cleaned)
    return _plain_times(tables.read_accidents(utc_session(spark), cleaned))


def clean_parquet_files(spark: SparkSession, folder: str) -> DataFrame:
    """Raw CSV files to the cleaned table in Parquet."""
    raw, cleaned = fresh_folder(spark, "raw"), f"{fresh_folder(spark, 'cleaned')}.parquet"
    tables.write_csv(_raw_accidents(spark, folder), raw)
    read = tables.read_raw_accidents(utc_session(spark), raw)
    tables.write_table(typed(cleaning.clean_accidents(read)), cleaned, cluster_by=CLUSTER_COLUMNS)
    return _plain_times(tables.read_accidents(utc_session(spark), cleaned))


def drop_nulls(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = cleaning.clean_accidents(
        accidents(spark, folder),
        drop_nulls=True,
        drop_subset=["Weather_Condition", "Precipitation_in", "Wind_Chill_F"],
    )
    return cleaned.select("ID", "Weather_Condition", "Precipitation_in", "Wind_Chill_F")


# --- Labels, samples, features --------------------------------------------------------------


def severity_label(spark: SparkSession, folder: str) -> DataFrame:
    orders = _table(spark, folder, "orders")
    rows = orders.selectExpr(*stand_ins.expressions(stand_ins.ORDER_FIELDS))
    return training.with_label(rows, "severity")


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    return training.with_label(accidents(spark, folder)).select("ID", "label")


def _in_parts(parts: list[DataFrame]) -> DataFrame:
    train, test = [
        part.withColumn("part", F.lit(name)) for name, part in zip(["train", "test"], parts)
    ]
    return train.unionAll(test)


def stratified_sample(spark: SparkSession, folder: str) -> DataFrame:
    """The sample that training takes."""
    rows = _labelled(spark, folder)
    by = training.draw(rows, ["ID"], sampling.SAMPLE_SEED)
    return sampling.stratified_sample(rows, uniform=by)


def train_test_split(spark: SparkSession, folder: str) -> DataFrame:
    """The split that training makes."""
    rows = _labelled(spark, folder)
    return _in_parts(sampling.split(rows, uniform=training.draw(rows, ["ID"], sampling.SPLIT_SEED)))


def _near(part: Column, whole: Column, fraction: float) -> Column:
    """Whether a drawn part is within six standard deviations of its fraction."""
    spread = F.sqrt(whole * fraction * (1 - fraction))
    return F.abs(part - whole * fraction) <= 6 * spread


def random_stratified_sample(spark: SparkSession, folder: str) -> DataFrame:
    """What holds for any draw of Spark's sampler: label 1 whole, label 0 near its fraction, no row
    twice and none that is not in the table."""
    table = _labelled(spark, folder)
    drawn = sampling.stratified_sample(table)
    counts = drawn.groupBy("ID", "label").count().withColumnRenamed("count", "times")
    both = table.join(counts, ["ID", "label"], "full")
    kept = F.col("times").isNotNull()
    return both.groupBy("label").agg(
        F.count("*").alias("rows"),
        F.max(F.coalesce("times", F.lit(0))).alias("most_times"),
        (
            (F.first("label") == 1) & (F.count_if(kept) == F.count("*"))
            | (F.first("label") == 0)
            & _near(F.count_if(kept), F.count("*"), sampling.LABEL_FRACTIONS[0])
        ).alias("as_due"),
    )


def random_split(spark: SparkSession, folder: str) -> DataFrame:
    """What holds for any draw of Spark's split: the parts together are the table, each row in one,
    and the first is near its weight."""
    table = _labelled(spark, folder)
    parts = _in_parts(sampling.split(table))
    placed = parts.groupBy("ID", "label").agg(
        F.count("*").alias("times"), F.count_if(F.col("part") == "train").alias("train")
    )
    both = table.join(placed, ["ID", "label"], "full")
    return both.agg(
        F.count("*").alias("rows"),
        F.count_if(F.coalesce("times", F.lit(0)) == 1).alias("rows_in_one_part"),
        _near(F.sum("train"), F.count("*"), sampling.SPLIT_WEIGHTS[0]).alias("as_due"),
    )


def category_index(spark: SparkSession, folder: str) -> DataFrame:
    rows = accidents(spark, folder).select("ID", "Weather_Condition", "Wind_Direction")
    return training.with_category_index(rows, ["Weather_Condition", "Wind_Direction"])


def category_index_wide(spark: SparkSession, folder: str) -> DataFrame:
    """A column of very many values."""
    lines = _table(spark, folder, "lineitem")
    rows = lines.select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part"))
    return training.with_category_index(rows, ["part"])


def category_index_hot(spark: SparkSession, folder: str) -> DataFrame:
    """Very many values, of which one has a third of the rows, and a tenth without a value."""
    lines = _table(spark, folder, "lineitem")
    part = (
        F.when(F.col("l_orderkey") % 3 == 0, F.lit("hot"))
        .when(F.col("l_orderkey") % 10 == 1, F.lit(None))
        .otherwise(F.col("l_partkey").cast("string"))
    )
    return training.with_category_index(lines.select("l_orderkey", "l_linenumber", part.alias("part")), ["part"])


def assembled_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with a missing measure have no feature vector."""
    inputs = ["Wind_Chill_F", "Precipitation_in", "Junction", "Distance_mi"]
    rows = accidents(spark, folder).select("ID", *inputs)
    vectors = training.feature_assembler(inputs).transform(rows)
    return vectors.select(
        "ID",
        *[
            fn.vector_element(F.col("features"), position).alias(f"feature_{position}")
            for position in range(len(inputs))
        ],
    )


# --- Models ---------------------------------------------------------------------------------


def _trained(spark: SparkSession, folder: str, **settings) -> PipelineModel:
    """Train on the accidents, save, and load what was saved."""
    path = fresh_folder(spark, "model")
    trained = training.train_severity(accidents(spark, folder), **settings)
    models.save_model(trained.model, path)
    return models.load_model(path)


def _likelier(probability: Column) -> Column:
    """Whether the predicted class is the likelier one, with a probability that is one."""
    likely = (probability > reports.DECISION_THRESHOLD).cast("double")
    return ((F.col("prediction") == likely) & probability.between(0, 1)).alias(
        "prediction_is_likelier"
    )


def gbt_score(spark: SparkSession, folder: str) -> DataFrame:
    """Which records the full classifier scores, and that it gives the likelier class."""
    rows = training.with_label(accidents(spark, folder))
    scored_rows = _trained(spark, folder).transform(rows)
    return scored_rows.select("ID", "label", _likelier(fn.vector_element(F.col("probability"), 1)))


def gbt_score_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The same with all inputs as they come out of the classifier, category places included."""
    rows = training.with_label(accidents(spark, folder))
    scored_rows = _trained(spark, folder, iterations=2).transform(rows)
    return scored_rows.select(
        "ID",
        "label",
        *schema.MEAN_COLUMNS,
        *schema.RATE_COLUMNS,
        *schema.CATEGORY_COLUMNS,
        (F.size(vector_to_array("features")) == len(schema.FEATURE_INPUTS)).alias("all_inputs"),
        _likelier(fn.vector_element(F.col("probability"), 1)),
    )


def gbt_heldout(spark: SparkSession, folder: str) -> DataFrame:
    """The held-out records of the keyed sample and split, scored by a model of the others."""
    path = fresh_folder(spark, "held-out")
    training.train_severity(accidents(spark, folder), predictions_path=path, iterations=2)
    scored_rows = utc_session(spark).read.parquet(path)
    return scored_rows.select("ID", "label", _likelier(fn.vector_element(F.col("probability"), 1)))


def _stream_scored(spark: SparkSession, folder: str, model: PipelineModel) -> DataFrame:
    """Score the message stream per window and read the predictions back."""
    source = _accident_messages(spark, folder)
    target, checkpoint = fresh_folder(spark, "predictions"), fresh_folder(spark, "checkpoint")
    score_messages(
        messages.file_messages(stream_session(spark), source),
        model,
        TUMBLING,
        target,
        checkpoint,
        available_now=True,
    ).awaitTermination()
    return _plain_times(stored.read_predictions(utc_session(spark), target))


def gbt_stream_score(spark: SparkSession, folder: str) -> DataFrame:
    return _stream_scored(spark, folder, _trained(spark, folder)).select(
        "window_start",
        "window_end",
        "accident_count",
        *schema.CATEGORY_COLUMNS,
        _likelier(F.col("high_severity_prob")),
    )


def scored_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Which windows a model scores, with what it was given and whether its class is the likelier
    one. These hold for any model, so a small one will do."""
    predictions = _stream_scored(spark, folder, _trained(spark, folder, iterations=2))
    return predictions.select(
        "window_start",
        "window_end",
        "accident_count",
        *schema.MEAN_COLUMNS,
        *schema.RATE_COLUMNS,
        *schema.CATEGORY_COLUMNS,
        _likelier(F.col("high_severity_prob")),
    )


def auc(spark: SparkSession, folder: str) -> DataFrame:
    rows = measured(spark, folder).select(
        F.col("cents").alias("score"), F.col("is_error").cast("double").alias("label")
    )
    area = training.area_under_roc(rows, bins=0, score="score")
    return spark.createDataFrame([(round(area, 6),)], "area_under_roc DOUBLE")


# --- Predictions and reports ----------------------------------------------------------------


def prediction_readback(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions with an ML vector as JSON lines and back."""
    path = fresh_folder(spark, "readback")
    second = F.col("high_severity_prob")
    rows = scored(spark, folder).withColumn(
        "probability", array_to_vector(F.array(1 - second, second))
    )
    rows.drop("high_severity_prob").write.json(path)
    ddl = schema.PREDICTION_DDL.replace(
        "window_start TIMESTAMP", "window_start TIMESTAMP_NTZ"
    )
    return reports.in_time_order(stored.read_predictions(spark, path, ddl)).select(
        "window_start", "accident_count", "Weather_Condition", "prediction", "high_severity_prob"
    )


def predictions_of_days(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of scored windows that keeps a folder for each day, and three days of it."""
    rows = messages.table_stream(stream_session(spark), f"{folder.rstrip('/')}/events.parquet*", EVENTS_DDL)
    second = F.col("high_severity_prob")
    windows_scored = rows.selectExpr(*stand_ins.expressions(stand_ins.PREDICTION_FIELDS)).withColumn(
        "probability", array_to_vector(F.array(1 - second, second))
    )
    path, checkpoint = fresh_folder(spark, "by-day"), fresh_folder(spark, "by-day-checkpoint")
    append_files(
        stored.with_day(windows_scored.drop("high_severity_prob")), path, checkpoint,
        available_now=True, partition_by=[schema.DAY_COLUMN],
    ).awaitTermination()
    ddl = schema.PREDICTION_DDL.replace("window_start TIMESTAMP", "window_start TIMESTAMP_NTZ")
    days = {"first_day": dt.date(2024, 1, 10), "last_day": dt.date(2024, 1, 12)}
    return stored.read_predictions(spark, path, ddl, by_day=True, **days).select(
        "window_start", "accident_count", "Weather_Condition", "prediction", "high_severity_prob"
    )


def prediction_preview(spark: SparkSession, folder: str) -> DataFrame:
    rows = scored(spark, folder).select(
        "event_id",
        F.col("prediction").cast("int").alias("label"),
        "prediction",
        F.col("high_severity_prob").alias("probability"),
    )
    return reports.preview(rows, "event_id")


def category_report(spark: SparkSession, folder: str) -> DataFrame:
    return reports.category_report(scored(spark, folder))


def category_risk_top(spark: SparkSession, folder: str) -> DataFrame:
    return reports.category_risk(scored(spark, folder))


def top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The top of many groups: users instead of weather."""
    rows = _events(spark, folder, {**stand_ins.PREDICTION_FIELDS, "user_id": "user_id"})
    return reports.category_risk(
        rows.withColumn("user_id", F.col("user_id").cast("string")), "user_id"
    )


def threshold_split(spark: SparkSession, folder: str) -> DataFrame:
    return reports.threshold_split(scored(spark, folder))


def hour_weekday_heatmap(spark: SparkSession, folder: str) -> DataFrame:
    return reports.hour_weekday_heatmap(scored(spark, folder))


def prob_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return reports.probability_histogram(scored(spark, folder))


QUERIES: dict[str, Query] = {
    "tumbling_features": _event_windows(TUMBLING),
    "sliding_features": _event_windows(SLIDING),
    "uneven_sliding_features": _event_windows(UNEVEN),
    "accident_tumbling_features": _accident_windows(TUMBLING),
    "accident_sliding_features": _accident_windows(LONG_SLIDING),
    "mean_windows": mean_windows,
    "null_event_time": null_event_time,
    "incomplete_windows": incomplete_windows,
    "closed_windows": closed_windows,
    "stream_tumbling": _stream_windows(TUMBLING),
    "stream_sliding": _stream_windows(SLIDING),
    "stream_restart": stream_restart,
    "stream_open_windows": stream_open_windows,
    "late_rows": late_rows,
    "late_row_counts": late_row_counts,
    "unscored_windows": unscored_windows,
    "message_windows": message_windows,
    "csv_parse": csv_parse,
    "csv_shapes": csv_shapes,
    "accident_messages": accident_messages,
    "replay_roundtrip": replay_roundtrip,
    "replay_in_order": replay_in_order,
    "blank_messages": blank_messages,
    "rename_coerce": rename_coerce,
    "clean_csv_files": clean_csv_files,
    "csv_inferred": csv_inferred,
    "clean_other_columns": clean_other_columns,
    "clean_parquet_files": clean_parquet_files,
    "drop_nulls": drop_nulls,
    "severity_label": severity_label,
    "stratified_sample": stratified_sample,
    "train_test_split": train_test_split,
    "random_stratified_sample": random_stratified_sample,
    "random_split": random_split,
    "category_index": category_index,
    "category_index_wide": category_index_wide,
    "category_index_hot": category_index_hot,
    "assembled_rows": assembled_rows,
    "gbt_score": gbt_score,
    "gbt_score_rows": gbt_score_rows,
    "gbt_heldout": gbt_heldout,
    "gbt_stream_score": gbt_stream_score,
    "scored_windows": scored_windows,
    "auc": auc,
    "prediction_readback": prediction_readback,
    "predictions_of_days": predictions_of_days,
    "prediction_preview": prediction_preview,
    "category_report": category_report,
    "category_risk_top": category_risk_top,
    "top_k": top_k,
    "threshold_split": threshold_split,
    "hour_weekday_heatmap": hour_weekday_heatmap,
    "prob_histogram": prob_histogram,
}
