"""Command line: ``spark-submit`` or ``python -m riskloom COMMAND ...``."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from riskloom.operators.windows import EventWindow
from riskloom.plans.ingest import clean_file
from riskloom.plans.reporting import write_reports
from riskloom.plans.training import train_severity
from riskloom.session import get_spark, stream_session
from riskloom.sources.messages import file_messages, kafka_messages
from riskloom.sources.models import load_model, save_model
from riskloom.sources.tables import read_accidents
from riskloom.streaming.counts import StreamCounts
from riskloom.streaming.replay import ROWS_PER_FILE, replay_to_files, replay_to_topic
from riskloom.streaming.scoring import score_messages

# --- Fixed values: default names and paths of the command line. ---
RAW_FILE = "us_accidents.csv"
CLEANED_FILE = "us_accidents_cleaned.parquet"
TOPIC = "us_accidents_topic"
SERVERS = "localhost:9092"
MODEL = "models/accident_gbt_pipeline"
PREDICTIONS = "output/predictions_json"
CHECKPOINT = "output/checkpoint"
REPORTS = "output/reports"


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="riskloom", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    clean = commands.add_parser("clean", help="clean the raw accident file")
    clean.add_argument("--source", default=RAW_FILE)
    clean.add_argument("--target", default=CLEANED_FILE, help="CSV, or Parquet if *.parquet")
    clean.add_argument("--drop-nulls", action="store_true")

    replay = commands.add_parser("replay", help="send the cleaned table as messages")
    replay.add_argument("--source", default=CLEANED_FILE)
    replay.add_argument("--servers", default=SERVERS)
    replay.add_argument("--topic", default=TOPIC)
    replay.add_argument("--files", help="write text files to this folder instead of a topic")
    replay.add_argument("--slices", type=int, help="number of stretches of time")
    replay.add_argument("--rows-per-file", type=int, default=ROWS_PER_FILE)
    replay.add_argument("--run", help="name under which a replay cut short can be repeated")

    train = commands.add_parser("train", help="train the severity classifier")
    train.add_argument("--source", default=CLEANED_FILE)
    train.add_argument("--model", default=MODEL)
    train.add_argument("--predictions", help="write the held-out predictions to this folder")
    train.add_argument(
        "--key", nargs="+", default=["ID"], help="columns that decide sample and split"
    )

    for reader in (clean, replay, train):
        reader.add_argument(
            "--one-line-records",
            action="store_true",
            help="no record of the CSV has line breaks, so lines need not be put together",
        )
        reader.add_argument(
            "--whole-files",
            action="store_true",
            help="read each CSV file by one task, as stray quotes in it need",
        )

    score = commands.add_parser("score", help="score a message stream per window")
    score.add_argument("kind", help="tumbling or sliding")
    score.add_argument("duration")
    score.add_argument("slide", nargs="?")
    score.add_argument("--servers", default=SERVERS)
    score.add_argument("--topic", default=TOPIC)
    score.add_argument("--files", help="read text files from this folder instead of a topic")
    score.add_argument("--model", default=MODEL)
    score.add_argument("--delay", help="watermark delay; the window duration by default")
    score.add_argument("--target", default=PREDICTIONS)
    score.add_argument("--checkpoint", default=CHECKPOINT)
    score.add_argument("--available-now", action="store_true", help="take what is there and end")
    score.add_argument(
        "--max-per-trigger", type=int, help="files, or messages of a topic, in a micro-batch"
    )
    score.add_argument("--trigger", help="time between micro-batches, such as '1 minute'")

    for topic in (replay, score):
        topic.add_argument(
            "--option", nargs=2, action="append", default=[], metavar=("NAME", "VALUE"),
            help="an option of the topic connector",
        )

    report = commands.add_parser("report", help="write the report tables")
    report.add_argument("--source", default=PREDICTIONS)
    report.add_argument("--target", default=REPORTS)
    report.add_argument("--first-day", type=dt.date.fromisoformat, help="day of the first windows reported")
    report.add_argument("--last-day", type=dt.date.fromisoformat)
    for days in (score, report):
        days.add_argument("--by-day", action="store_true", help="predictions lie in a folder for each day")
    return parser


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.command == "clean":
        clean_file(
            spark, args.source, args.target, args.drop_nulls, not args.one_line_records, args.whole_files
        )
    elif args.command == "replay":
        table = read_accidents(spark, args.source, not args.one_line_records, args.whole_files)
        if args.files:
            order = ["Start_Time", "ID"]
            replay_to_files(
                table, args.files, order, args.slices, rows_per_file=args.rows_per_file, run=args.run
            )
        else:
            replay_to_topic(table, args.servers, args.topic, **dict(args.option))
    elif args.command == "train":
        table = read_accidents(spark, args.source, not args.one_line_records, args.whole_files)
        trained = train_severity(table, args.key, predictions_path=args.predictions)
        save_model(trained.model, args.model)
        for row in trained.preview:
            print(f"label {row.label}, prediction {row.prediction}, probability {row.probability}")
        print(f"area under ROC: {trained.area_under_roc}")
    elif args.command == "score":
        window = EventWindow.of(args.kind, args.duration, args.slide)
        session = stream_session(spark)
        if args.files:
            messages = file_messages(session, args.files, args.max_per_trigger)
        else:
            options = dict(args.option)
            if args.max_per_trigger:
                options["maxOffsetsPerTrigger"] = str(args.max_per_trigger)
            messages = kafka_messages(session, args.servers, args.topic, **options)
        query = score_messages(
            messages,
            load_model(args.model),
            window,
            args.target,
            args.checkpoint,
            args.delay,
            args.by_day,
            available_now=args.available_now,
            processing_time=args.trigger,
        )
        counts = StreamCounts()
        while not query.awaitTermination(60):
            counts.take(query)
        counts.take(query)
        print(f"{counts.rows} rows read, {counts.timeless_rows} without a time")
        print(f"{counts.windows} windows, {counts.unscored_windows} unscored")
    elif args.command == "report":
        write_reports(
            spark, args.source, args.target,
            by_day=args.by_day, first_day=args.first_day, last_day=args.last_day,
        )


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    run(get_spark(), args)


if __name__ == "__main__":
    main()
