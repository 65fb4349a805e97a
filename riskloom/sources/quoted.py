"""CSV records with line breaks inside quoted fields, from files that are read in pieces.

Spark's line scan cuts a file into splits, and a line may begin inside a quoted field that another
split opened. Whether it does is the parity of the quotes before it: doubled quotes count twice, so
only opening and closing ones matter. Each split counts its own quotes, a running sum over the splits
of a file tells with what parity each begins, and that settles every line. The task that scans a split
puts the records together that begin and end in it, so no such text is shuffled or sorted; only the
lines of records over the end of a split travel. Files are told apart by a 64-bit hash of their paths.

A quote stands for itself only inside a quoted field, doubled. A file with other stray quotes, or with
single carriage returns as line ends, has to be read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from riskloom.operators.parsing import QUOTING
from riskloom.session import partitions_of

BYTE_ORDER_MARK = "﻿"
#: How a record is parsed once its text is together.
RECORD = {**QUOTING, "multiLine": "true"}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its file's hash, its split, a number that rises within the split, and its quotes."""
    scan = spark.read.option("lineSep", "\n").text(path)
    line = F.col("value")
    lines = scan.select(
        # Sorting and joining go by numbers; paths are long and share their beginnings.
        F.xxhash64(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        line.alias("line"),
        (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))).alias("quotes"),
    )
    # A task scans several splits, one after the other, where there are very many.
    return lines.coalesce(max(partitions_of(spark), 4 * spark.sparkContext.defaultParallelism))


def _starts(lines: DataFrame) -> DataFrame:
    """Whether each split begins and ends inside a quoted field, the number of its first line, and those
    of the first and the last line with an odd number of quotes."""
    odd = F.when(F.col("quotes").bitwiseAND(1) == 1, F.col("id"))
    sums = lines.groupBy("file", "block").agg(
        F.sum("quotes").alias("quotes"), F.min("id").alias("first_id"), F.min(odd).alias("first_odd"), F.max(odd).alias("last_odd")
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("quotes").over(before), F.lit(0)).bitwiseAND(1)
    sums = sums.withColumn("start", start).withColumn("end", (F.col("start") + F.col("quotes")).bitwiseAND(1))
    return sums.drop("quotes")


def _whole_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """first and record of those that begin and end in one split, from its lines in order: a hash of the
    split, four times the quotes with 2 if it begins inside a quoted field and 1 if it begins its file, line."""
    key, inside, headless, first, held = None, 0, False, False, []
    for batch in batches:
        splits, notes, lines = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
        quotes = notes >> 2
        changes = np.flatnonzero(np.diff(splits)) + 1
        for a, b in zip([0, *changes.tolist()], [*changes.tolist(), len(splits)]):
            if a == b:
                continue
            if key != splits[a]:  # what is held runs over the end of its split
                key, inside, held = splits[a], int(notes[a]) >> 1 & 1, []
                headless, first = bool(inside), bool(notes[a] & 1)
            after = (inside + np.cumsum(quotes[a:b])) & 1
            inside = int(after[-1])
            ends = np.flatnonzero(after == 0) + 1
            if not len(ends):
                held.append(lines.slice(a, b - a))
                continue
            kept = sum(map(len, held))
            texts = pa.concat_arrays([*held, lines.slice(a, int(ends[-1]))])
            held = [lines.slice(a + int(ends[-1]), b - a - int(ends[-1]))]
            offsets = pa.array(np.concatenate(([0], kept + ends)).astype(np.int32))
            records = pc.binary_join(pa.ListArray.from_arrays(offsets, texts), "\n")
            marks = np.zeros(len(records), bool)
            marks[0] = first
            skip = int(headless)
            headless = first = False
            yield pa.RecordBatch.from_arrays([pa.array(marks[skip:]), records.slice(skip)], ["first", "record"])


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """first (whether it is its file's first record) and record, the text of each record that is not
    blank, in no order."""
    lines = _lines(spark, path)
    # One row for each split, so the join leaves the lines where and as they were scanned.
    known = lines.join(F.broadcast(_starts(lines)), ["file", "block"])
    notes = F.col("quotes").cast("long") * 4 + F.col("start") * 2 + (F.col("block") == 0).cast("int")
    whole = known.select(F.xxhash64("file", "block"), notes, "line").mapInArrow(_whole_records, "first boolean, record string")
    # Of records over the end of a split: the lines up to the first that closes one begun before, and
    # those from the last that opens one.
    head = (F.col("start") == 1) & (F.col("first_odd").isNull() | (F.col("id") <= F.col("first_odd")))
    tail = (F.col("end") == 1) & (F.col("id") >= F.col("last_odd"))
    parts = known.withColumn("begin", F.when(head, F.lit(0)).when(tail, F.lit(1))).where("begin IS NOT NULL")
    pieces = parts.groupBy("file", "block", "begin").agg(
        F.array_sort(F.collect_list(F.struct("id", "line"))).alias("listed"),
        ((F.col("block") == 0) & (F.min("id") == F.min("first_id"))).alias("first"),
    )
    text = F.array_join(F.col("listed.line"), "\n")
    # A piece without a beginning goes on the last record that was open before it.
    in_order = Window.partitionBy("file").orderBy("block", "begin")
    chained = pieces.select("file", "block", "first", text.alias("record"), F.sum("begin").over(in_order).alias("chain"), "begin")
    joined = chained.groupBy("file", "chain").agg(
        F.max("first").alias("first"), F.array_sort(F.collect_list(F.struct("block", "begin", "record"))).alias("pieces")
    )
    joined = joined.select("first", F.array_join(F.col("pieces.record"), "\n").alias("record"))
    records = whole.unionByName(joined)
    record = F.rtrim("record", F.lit("\r"))
    unmarked = F.when(F.col("first"), F.ltrim(record, F.lit(BYTE_ORDER_MARK))).otherwise(record)
    return records.select("first", unmarked.alias("record")).where("record <> ''")


def header_names(spark: SparkSession, path: str) -> list[str]:
    """The names in the first record of the files."""
    return spark.read.csv(path, header=True, multiLine=True, **QUOTING).columns


def data_records(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """record: those after the first of each file, which has to hold the names."""
    return quoted_records(spark, path).where(_is_data(names)).select("record")


def _is_data(names: list[str]) -> Column:
    fields = ", ".join(f"_{k} STRING" for k in range(len(names) + 1))
    held = F.from_csv("record", fields, RECORD)
    same = held[f"_{len(names)}"].isNull()
    for k, name in enumerate(names):
        same = same & F.lower(held[f"_{k}"]).eqNullSafe(name.lower())
    message = F.concat(F.lit("another header: "), F.col("record"))
    wrong = F.raise_error(message).cast("boolean")
    return F.when(~F.col("first"), True).when(same, False).otherwise(wrong)


def parsed_records(records: DataFrame, ddl: str) -> DataFrame:
    """The fields of each record under a schema, by position."""
    return records.select(F.from_csv("record", ddl, RECORD).alias("data")).select("data.*")


def inferred_ddl(records: DataFrame, names: list[str]) -> str:
    """The types that Spark's reader finds in all records, under the names."""
    spark = records.sparkSession
    texts = getattr(records._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    reader = spark.read.options(inferSchema="true", **RECORD)
    found = reader._jreader.csv(texts).schema()
    kinds = [found.apply(k).dataType().catalogString() for k in range(found.size())]
    return ", ".join(f"`{name}` {kind}" for name, kind in zip(names, kinds))
