"""Report tables over scored windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.functions.columns import round_half_even

# --- Fixed values: report sizes, the baseline category, the decision threshold, day names. ---
HISTOGRAM_BINS = 20
TOP_CATEGORIES = 15
BASELINE_CATEGORY = "Clear"
REPORT_PLACES = 3
DECISION_THRESHOLD = 0.5
WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def in_time_order(predictions: DataFrame, time: str = "window_start") -> DataFrame:
    """For presentation: a total order costs a range shuffle that no other report needs."""
    return predictions.orderBy(time)


def top_rows(df: DataFrame, by: str, key: str, rows: int) -> DataFrame:
    """The ``rows`` highest by one column; the key decides between equals."""
    return df.orderBy(F.col(by).desc(), F.col(key)).limit(rows)


def preview(predictions: DataFrame, order: str | list[str], rows: int = 5) -> DataFrame:
    """A few labelled predictions, the same ones on every run."""
    return (
        predictions.orderBy(order).select("label", "prediction", "probability").limit(rows)
    )


def category_report(
    predictions: DataFrame,
    category: str = "Weather_Condition",
    baseline: str | None = BASELINE_CATEGORY,
    places: int = REPORT_PLACES,
) -> DataFrame:
    """Mean prediction and probability and total count per category, without the baseline."""
    kept = F.col(category).isNotNull()
    if baseline is not None:
        kept = kept & (F.col(category) != baseline)
    return (
        predictions.where(kept)
        .groupBy(category)
        .agg(
            round_half_even(F.avg("prediction"), places).alias("Avg_Prediction"),
            round_half_even(F.avg("high_severity_prob"), places).alias("Avg_Probability"),
            F.sum("accident_count").alias("Total_Accidents"),
        )
    )


def category_risk(
    predictions: DataFrame, category: str = "Weather_Condition", rows: int = TOP_CATEGORIES
) -> DataFrame:
    """The riskiest categories, ranked by the rounded mean probability."""
    report = category_report(predictions, category)
    return top_rows(with_threshold(report, "Avg_Probability"), "Avg_Probability", category, rows)


def with_threshold(
    df: DataFrame, probability: str, threshold: float = DECISION_THRESHOLD
) -> DataFrame:
    """Mark the rows above the decision threshold."""
    return df.withColumn("above_threshold", F.col(probability) > threshold)


def threshold_split(
    predictions: DataFrame,
    category: str = "Weather_Condition",
    threshold: float = DECISION_THRESHOLD,
) -> DataFrame:
    """Rows above and up to the threshold, per category."""
    probability = F.col("high_severity_prob")
    return predictions.groupBy(category).agg(
        F.count_if(probability > threshold).alias("above"),
        F.count_if(probability <= threshold).alias("up_to"),
    )


def hour_weekday_heatmap(predictions: DataFrame, time: str = "window_start") -> DataFrame:
    """Mean probability by hour of day, one column per weekday from Monday on.

    The weekdays are given to the pivot, so it needs no job to find them and a weekday without
    data is a column of nulls.
    """
    cells = predictions.where(
        F.col(time).isNotNull() & F.col("high_severity_prob").isNotNull()
    ).select(
        F.hour(time).alias("hour"), F.weekday(time).alias("weekday"), "high_severity_prob"
    )
    days = list(range(len(WEEKDAYS)))
    table = cells.groupBy("hour").pivot("weekday", days).agg(F.avg("high_severity_prob"))
    return table.select("hour", *[F.col(str(day)).alias(WEEKDAYS[day]) for day in days])


def probability_histogram(
    predictions: DataFrame, value: str = "high_severity_prob", bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """Counts in equal-width bins from the lowest to the highest value, empty bins included.

    A bin holds its lower edge and the last bin its upper edge too. If all values are equal the
    range is half a unit to either side, and without values it is 0 to 1.
    """
    values = predictions.select(F.col(value).cast("double").alias("v")).where(
        F.col("v").isNotNull() & ~F.isnan("v")
    )
    ends = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).select(
        F.struct(
            F.when(F.col("lo") < F.col("hi"), F.col("lo"))
            .otherwise(F.coalesce(F.col("lo") - 0.5, F.lit(0.0)))
            .alias("lo"),
            F.when(F.col("lo") < F.col("hi"), F.col("hi"))
            .otherwise(F.coalesce(F.col("hi") + 0.5, F.lit(1.0)))
            .alias("hi"),
        ).alias("ends")
    )
    # The two ends are one row, read as a scalar subquery and then a constant for the scan.
    lo, hi = ends.scalar()["lo"], ends.scalar()["hi"]
    step = (hi - lo) / bins

    def edge(number):
        return F.when(number == bins, hi).otherwise(lo + number * step)

    # The quotient may land one bin off beside an edge; comparing with the edges settles it.
    guess = F.least(F.floor((F.col("v") - lo) / (hi - lo) * bins), F.lit(bins - 1))
    settled = (
        F.when(F.col("v") < edge(F.col("bin")), F.col("bin") - 1)
        .when(
            (F.col("v") >= edge(F.col("bin") + 1)) & (F.col("bin") < bins - 1), F.col("bin") + 1
        )
        .otherwise(F.col("bin"))
    )
    counts = (
        values.select("v", guess.alias("bin"))
        .select(settled.alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("filled"))
    )
    spark = predictions.sparkSession
    # At most ``bins`` rows on either side.
    return (
        spark.range(bins)
        .select(F.col("id").alias("bin"))
        .join(F.broadcast(counts), "bin", "left")
        .select(
            F.col("bin").cast("int").alias("bin"),
            edge(F.col("bin")).alias("bin_start"),
            edge(F.col("bin") + 1).alias("bin_end"),
            F.coalesce("filled", F.lit(0)).cast("bigint").alias("count"),
        )
    )
