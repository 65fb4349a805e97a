"""How tables are laid out and joined: hot categories, days as folders, times in ranges."""

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskloom import schema
from riskloom.operators.parsing import parsed_fields
from riskloom.plans import training
from riskloom.session import settings
from riskloom.sources.predictions import read_predictions, with_day
from riskloom.sources.tables import write_table

from helpers import final_plan, rows


@pytest.fixture
def shuffled(spark):
    """A session in which nothing is small enough to be sent to all tasks by itself."""
    session = spark.newSession()
    for key, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.session.timeZone": "UTC",
    }.items():
        session.conf.set(key, value)
    return session


def skewed(session, n=30_000):
    value = (
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("v"), (F.col("id") % 6000).cast("string")))
    )
    return session.range(n).repartition(5).select("id", value.alias("c"))


def test_hot_and_missing_categories_are_spread(shuffled):
    df = skewed(shuffled)
    indexed = training.with_category_index(df, ["c"])
    assert "BroadcastHashJoin" in final_plan(indexed) and "SortMergeJoin" in final_plan(indexed)
    sizes = [r["count"] for r in indexed.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * sorted(sizes)[8]
    expected = training.category_indexer(["c"]).fit(df).transform(df)
    assert rows(indexed) == rows(expected)


def test_few_categories_need_no_shuffle_of_the_table(shuffled):
    df = shuffled.range(5000).select("id", (F.col("id") % 7).cast("string").alias("c"), F.lit("x").alias("d"))
    indexed = training.with_category_index(df, ["c", "d"])
    placed = [(r.id, r.p) for r in indexed.select("id", F.spark_partition_id().alias("p")).collect()]
    assert sorted(placed) == sorted((r.id, r.p) for r in df.select("id", F.spark_partition_id().alias("p")).collect())
    expected = training.category_indexer(["c", "d"]).fit(df).transform(df)
    assert rows(indexed) == rows(expected)


def test_long_categories_are_not_sent_to_all(shuffled):
    """A heavy value beyond a kilobyte is joined by value; the result is the same."""
    df = shuffled.range(3000).select("id", F.when(F.col("id") % 2 == 0, F.repeat(F.lit("long"), 500)).otherwise(F.col("id").cast("string")).alias("c"))
    indexed = training.with_category_index(df, ["c"])
    expected = training.category_indexer(["c"]).fit(df).transform(df)
    assert rows(indexed) == rows(expected)


def predictions(spark):
    probability = array_to_vector(F.array(F.lit(0.25), F.lit(0.75)))
    starts = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 7200)
    return spark.range(100).select(starts.alias("window_start"), F.col("id").alias("accident_count"), probability.alias("probability"))


@pytest.mark.parametrize("by_day", [True, False])
def test_days_of_predictions(spark, tmp_path, by_day):
    path = str(tmp_path / "p")
    df = predictions(spark)
    if by_day:
        with_day(df).write.partitionBy(schema.DAY_COLUMN).json(path)
    else:
        df.write.json(path)
    days = {"first_day": dt.date(2024, 1, 3), "last_day": dt.date(2024, 1, 4)}
    found = read_predictions(spark, path, by_day=by_day, **days)
    assert sorted(r.accident_count for r in found.collect()) == list(range(24, 48))
    assert found.columns == read_predictions(spark, path).columns if not by_day else schema.DAY_COLUMN not in found.columns
    assert all(r.high_severity_prob == 0.75 for r in found.collect())
    if by_day:
        filters = final_plan(found).split("PartitionFilters: ")[1].split("PushedFilters")[0]
        assert schema.DAY_COLUMN in filters
        assert len(found.inputFiles()) > 2  # those of all days; the scan takes the days' own
    assert read_predictions(spark, path, by_day=by_day).count() == 100
    assert read_predictions(spark, str(tmp_path / "none"), by_day=by_day, **days).count() == 0


def groups_over(path, low, high):
    """(row groups that can hold a time of the stretch, all row groups), by the files' own statistics."""
    hit = count = 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(0).statistics
            count += 1
            hit += stats.min < high and stats.max >= low
    return hit, count


def test_a_clustered_table_is_read_in_part(spark, tmp_path):
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.enabled", "false")
    time = F.timestamp_seconds(F.lit(1704067200) + (F.col("id") * 7919 % 20_000) * 60)
    df = session.range(20_000).repartition(10).select(time.alias("Start_Time"), F.col("id").cast("string").alias("ID"))
    plain, clustered = str(tmp_path / "a.parquet"), str(tmp_path / "b.parquet")
    write_table(df, plain)
    write_table(df, clustered, cluster_by=["Start_Time", "ID"])
    utc = dt.timezone.utc
    stretch = dt.datetime(2024, 1, 5, tzinfo=utc), dt.datetime(2024, 1, 6, tzinfo=utc)
    hit, count = groups_over(plain, *stretch)
    assert hit == count
    hit, count = groups_over(clustered, *stretch)
    assert count >= 8 and hit <= 2
    low, high = (F.lit(t.replace(tzinfo=None)).cast("timestamp") for t in stretch)
    within = (F.col("Start_Time") >= low) & (F.col("Start_Time") < high)
    read = session.read.parquet(clustered)
    assert "GreaterThanOrEqual(Start_Time" in final_plan(read.where(within))
    assert rows(read) == rows(session.read.parquet(plain))


def test_one_time_for_all_rows_is_split_by_the_key(spark, tmp_path):
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.enabled", "false")
    df = session.range(8000).select(F.timestamp_seconds(F.lit(0)).alias("Start_Time"), F.col("id").cast("string").alias("ID"))
    path = str(tmp_path / "c.parquet")
    write_table(df, path, cluster_by=["Start_Time", "ID"])
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{path}/*.parquet")]
    assert len(sizes) >= 6 and max(sizes) < 3000


def test_settings_come_back(spark):
    session = spark.newSession()
    before = session.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(KeyError):
        with settings(session, {"spark.sql.shuffle.partitions": "3", "riskloom.none": "x"}):
            assert session.conf.get("spark.sql.shuffle.partitions") == "3"
            raise KeyError
    assert session.conf.get("spark.sql.shuffle.partitions") == before
    assert session.conf.get("riskloom.none", None) is None


def test_clustered_rows_are_made_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    table = spark.range(0, 5000, numPartitions=4).mapInArrow(counted, "id long")
    write_table(table, str(tmp_path / "once.parquet"), cluster_by=["id"])
    assert made.value == 5000 == spark.read.parquet(str(tmp_path / "once.parquet")).count()


def test_a_row_is_parsed_at_once(spark):
    texts = spark.createDataFrame([("7", " 8 ", '5"', None, "x\ny"), ("z", "", "1.5", "2024-01-02 03:04:05", None)], "a STRING, b STRING, c STRING, d STRING, e STRING")
    fields = [("e", "STRING"), ("d", "TIMESTAMP"), ("c", "DOUBLE"), ("b", "DOUBLE"), ("a", "INT")]
    found = parsed_fields(texts, fields)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_csv(") == 1
    plain = [(r.e, r.d and str(r.d), r.c, r.b, r.a) for r in found.collect()]
    assert plain == [("x\ny", None, None, 8.0, 7), (None, "2024-01-02 03:04:05", 1.5, None, None)]
