"""Training and evaluation of the severity classifier."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Row, functions as F

from riskloom import schema
from riskloom.functions.columns import label_from_severity, uniform_of
from riskloom.operators.reports import preview
from riskloom.operators.sampling import SAMPLE_SEED, SPLIT_SEED, split, stratified_sample
from riskloom.session import fresh_folder, remove_folder, shared_folder

# --- Fixed values: the classifier's settings. ---
ITERATIONS = 30
DEPTH = 5
BINS = 150
MODEL_SEED = 36

#: A category is heavy with one row in this many, so there are at most as many of them.
HEAVY = 1000
HEAVY_BYTES = 1024


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    area_under_roc: float
    #: A few held-out predictions: label, prediction, probability.
    preview: list[Row]


def with_label(df: DataFrame, severity: str = "Severity") -> DataFrame:
    return df.withColumn("label", label_from_severity(F.col(severity)))


def category_indexer(columns: Sequence[str] = schema.CATEGORY_COLUMNS) -> StringIndexer:
    """Index all columns in one pass, by falling frequency and then by name.

    Missing and unseen categories share one index after the last.
    """
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{name}Indexed" for name in columns],
        handleInvalid="keep",
        stringOrderType="frequencyDesc",
    )


def feature_assembler(inputs: Sequence[str] = schema.FEATURE_INPUTS) -> VectorAssembler:
    """Rows with a missing input have no features and are left out."""
    return VectorAssembler(inputCols=list(inputs), outputCol="features", handleInvalid="skip")


def severity_pipeline(
    categories: Sequence[str] = schema.CATEGORY_COLUMNS,
    inputs: Sequence[str] = schema.FEATURE_INPUTS,
    iterations: int = ITERATIONS,
    depth: int = DEPTH,
    bins: int = BINS,
    seed: int = MODEL_SEED,
) -> Pipeline:
    """Index categories, assemble features, boost trees."""
    trees = GBTClassifier(
        featuresCol="features",
        labelCol="label",
        maxIter=iterations,
        maxDepth=depth,
        maxBins=bins,
        seed=seed,
    )
    return Pipeline(stages=[category_indexer(categories), feature_assembler(inputs), trees])


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """slot (a column's place), value and rows of each category, for all columns in one pass."""
    slots = [
        F.struct(F.lit(slot).alias("slot"), F.col(name).cast("string").alias("value"))
        for slot, name in enumerate(columns)
    ]
    values = df.select(F.inline(F.array(*slots))).where("value IS NOT NULL")
    return values.groupBy("slot", "value").agg(F.count("*").alias("rows"))


@dataclass
class _Column:
    """What is known of a column's categories: how many, the rows that hold one, the longest in bytes."""

    values: int = 0
    rows: int = 0
    longest: int = 0

    @property
    def few(self) -> bool:
        return self.values <= HEAVY and self.longest <= HEAVY_BYTES


def _placed_categories(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[_Column]]:
    """slot, value, rows and place of every category.

    Places go by falling frequency and then by name, for any number of values: the counts are sorted
    by range and written, and a row's place is its place in its partition after the rows of the
    partitions before. Only the rows of each partition, a few numbers for each column, come together.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, "categories")
    order = [F.col("slot"), F.col("rows").desc(), F.col("value")]
    placed = category_counts(df, columns).repartitionByRange(*order).sortWithinPartitions(*order)
    placed.select("slot", "value", "rows", F.monotonically_increasing_id().alias("id")).write.parquet(path)
    placed = spark.read.parquet(path)
    part = F.shiftright("id", 33)
    sizes = placed.groupBy(part.alias("part"), "slot").agg(
        F.count("*").alias("n"),
        F.min("id").alias("low"),
        F.sum("rows").alias("rows"),
        F.max(F.octet_length("value")).alias("longest"),
    )
    known, starts = [_Column() for _ in columns], {}
    for row in sorted(sizes.collect()):
        of = known[row["slot"]]
        starts[row["part"], row["slot"]] = of.values - row["low"]
        of.values += row["n"]
        of.rows += row["rows"]
        of.longest = max(of.longest, row["longest"])
    shifts = spark.createDataFrame(
        [(part, slot, shift) for (part, slot), shift in starts.items()], "part BIGINT, slot INT, shift BIGINT"
    )
    found = placed.withColumn("part", part).join(shifts, ["part", "slot"])
    return found.select("slot", "value", "rows", (F.col("id") + F.col("shift")).alias("place")), known


def category_index(
    df: DataFrame, columns: Sequence[str] = schema.CATEGORY_COLUMNS
) -> tuple[DataFrame, list[int]]:
    """(slot, value and place of every category, number of categories of each column)."""
    placed, known = _placed_categories(df, columns)
    return placed.select("slot", "value", "place"), [of.values for of in known]


def with_category_index(
    df: DataFrame, columns: Sequence[str] = schema.CATEGORY_COLUMNS
) -> DataFrame:
    """Each column with its index beside it; missing values share one place after the last.

    Values that hold a thousandth of the rows or more are at most a thousand, and those of them up to
    a kilobyte long are sent to all tasks: the rows that hold one never meet in one task. Where there
    are others, their rows are joined by value; heavy and missing values are spread over the tasks of
    that join by a number that says nothing.
    """
    placed, known = _placed_categories(df, columns)
    for slot, (name, of) in enumerate(zip(columns, known)):
        value = F.col(name).cast("string")
        own = placed.where(F.col("slot") == slot).withColumn("place", F.col("place").cast("double"))
        heavy = F.col("rows") * HEAVY >= of.rows
        sent = own if of.few else own.where(heavy & (F.octet_length("value") <= HEAVY_BYTES))
        sent = sent.select(F.col("value").alias("_heavy"), F.col("place").alias("_heavy_place"))
        df = df.join(F.broadcast(sent), value == F.col("_heavy"), "left").drop("_heavy")
        place = F.col("_heavy_place")
        if not of.few:
            # A letter before the key tells values from numbers that only spread rows.
            light = F.col("_heavy_place").isNull() & value.isNotNull()
            alone = F.concat(F.lit("n"), F.monotonically_increasing_id().cast("string"))
            df = df.withColumn("_key", F.when(light, F.concat(F.lit("v"), value)).otherwise(alone))
            rest = own.select(F.concat(F.lit("v"), F.col("value")).alias("_value"), F.col("place").alias("_place"))
            df = df.join(rest, F.col("_key") == F.col("_value"), "left").drop("_key", "_value")
            place = F.coalesce(place, F.col("_place"))
        indexed = F.coalesce(place, F.lit(float(of.values)))
        df = df.withColumn(f"{name}Indexed", indexed).drop("_heavy_place", "_place")
    return df


def check_categories(df: DataFrame, categories: Sequence[str], bins: int) -> None:
    """Refuse categories with more values than the trees have bins, before fitting anything.

    Missing values take a bin as well. The library's indexer takes all values of a column to one
    place, so this also bounds what it holds.
    """
    counts = category_counts(df, categories).groupBy("slot").count()
    too_many = {
        categories[row["slot"]]: row["count"]
        for row in counts.where(F.col("count") + 1 > bins).collect()
    }
    if too_many:
        raise ValueError(f"categories with more values than {bins} bins less one: {too_many}")


def fit(train: DataFrame, bins: int = BINS, **settings) -> PipelineModel:
    """Fit the classifier on labelled rows."""
    check_categories(train, settings.get("categories", schema.CATEGORY_COLUMNS), bins)
    return severity_pipeline(bins=bins, **settings).fit(train)


def area_under_roc(
    predictions: DataFrame, bins: int = 1000, score: str = "rawPrediction", label: str = "label"
) -> float:
    """Area under the ROC curve, over a curve of about ``bins`` points or, for 0, exactly."""
    return BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=score, metricName="areaUnderROC", numBins=bins
    ).evaluate(predictions)


def train_severity(
    accidents: DataFrame,
    key: Sequence[str] | None = ("ID",),
    sample_path: str | None = None,
    predictions_path: str | None = None,
    work_folder: str | None = None,
    **settings,
) -> Trained:
    """Label, sample, split, fit, and measure on the held-out part.

    With ``key`` columns, which have to tell rows apart, the sample and the split follow the key,
    and for rows that lack it the other columns; without them Spark's samplers draw by partition.
    Sampling comes before the split, so the measure is for the sampled mix.

    The sample is written to the shared folder and removed at the end, or stays under
    ``sample_path``. The held-out predictions are written to ``predictions_path``, if given.
    """
    spark = accidents.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:  # boosting cuts its lineage there
        spark.sparkContext.setCheckpointDir(shared_folder(spark, work_folder))
    inputs = settings.get("inputs", schema.FEATURE_INPUTS)
    categories = settings.get("categories", schema.CATEGORY_COLUMNS)
    plain = [name for name in inputs if name.removesuffix("Indexed") not in categories]
    needed = dict.fromkeys([*(key or []), "label", *plain, *categories])
    labelled = with_label(accidents).select(*needed)
    sampled = stratified_sample(labelled, uniform=draw(labelled, key, SAMPLE_SEED))
    # Boosting goes over the sample hundreds of times. It is written as a table of its own, so an
    # executor lost on the way costs a read of its part and not of the source; spread evenly,
    # whatever files it comes from and however the strata lie in them; and in as many files as
    # its size calls for. All columns are hashed, so a key that many rows share does not draw
    # them together.
    columns = sampled.columns
    path = sample_path or fresh_folder(spark, "sample", work_folder)
    sampled.repartition(*columns).sortWithinPartitions(*columns).write.parquet(path)
    sampled = spark.read.parquet(path)
    train, test = split(sampled, uniform=draw(sampled, key, SPLIT_SEED))
    model = fit(train, **settings)
    predictions = model.transform(test)
    if predictions_path:
        predictions.write.parquet(predictions_path)
        predictions = spark.read.parquet(predictions_path)
    order = list(key) if key else sampled.columns
    trained = Trained(model, area_under_roc(predictions), preview(predictions, order).collect())
    if not sample_path:
        remove_folder(spark, path)
    return trained


def draw(df: DataFrame, key: Sequence[str] | None, seed: int) -> Column | None:
    """A number in [0, 1) for each row, by its key, or else by its other columns."""
    if not key:
        return None
    others = [F.col(name) for name in df.columns if name not in key]
    return uniform_of(*map(F.col, key), seed=seed, others=others)
