import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from bindings.spark_queries import accidents
from riskloom import schema
from riskloom.functions.columns import label_from_severity, uniform_of
from riskloom.operators.reports import preview
from riskloom.operators.sampling import split, split_bounds, stratified_sample
from riskloom.plans import training
from riskloom.sources.models import load_model, save_model

from helpers import rows

QUICK = {"iterations": 3, "depth": 3}


def test_label(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "s INT")
    labels = df.select("s", label_from_severity(F.col("s")).alias("label")).collect()
    assert {row.s: row.label for row in labels} == {1: 0, 2: 0, 3: 1, 4: 1, None: 0}


def strata(spark, count=20000):
    return spark.range(count).select("id", (F.col("id") % 3).cast("int").alias("label"))


def test_keyed_sample_and_split_do_not_depend_on_partitions(spark):
    df, by = strata(spark), uniform_of(F.col("id"), seed=36)
    other = df.repartition(7)
    expected = rows(stratified_sample(df, uniform=by))
    assert rows(stratified_sample(other, uniform=by)) == expected
    assert [rows(part) for part in split(df, uniform=by)] == [
        rows(part) for part in split(other, uniform=by)
    ]


@pytest.mark.parametrize("keyed", [True, False])
def test_sample_fractions(spark, keyed):
    df = strata(spark)
    by = uniform_of(F.col("id"), seed=36) if keyed else None
    counts = {
        row.label: row["count"]
        for row in stratified_sample(df, uniform=by).groupBy("label").count().collect()
    }
    assert counts[1] == df.where("label = 1").count()
    assert counts[0] / df.where("label = 0").count() == pytest.approx(0.24, abs=0.02)
    assert 2 not in counts


@pytest.mark.parametrize("keyed", [True, False])
def test_split_is_a_partition(spark, keyed):
    df = strata(spark)
    by = uniform_of(F.col("id"), seed=5043) if keyed else None
    train, test = split(df, uniform=by)
    assert train.count() / 20000 == pytest.approx(0.85, abs=0.02)
    assert rows(train.unionAll(test)) == rows(df)


def test_split_bounds_cover_the_unit_range():
    assert split_bounds([17, 3]) == [(0.0, 0.85), (0.85, 1.0)]
    bounds = split_bounds([0.1] * 10)
    assert bounds[0][0] == 0.0 and bounds[-1][1] == 1.0
    assert all(left[1] == right[0] for left, right in zip(bounds, bounds[1:]))


def test_uniform_is_even(spark):
    draws = spark.range(50000).select(uniform_of(F.col("id"), seed=1).alias("u"))
    low, high, mean, below = draws.agg(
        F.min("u"), F.max("u"), F.avg("u"), F.avg((F.col("u") < 0.24).cast("double"))
    ).first()
    assert 0 <= low and high < 1
    assert mean == pytest.approx(0.5, abs=0.01) and below == pytest.approx(0.24, abs=0.01)


def test_index_order_null_and_unseen(spark):
    train = spark.createDataFrame(
        [("b",), ("b",), ("c",), ("c",), ("a",), (None,)], "Weather STRING"
    )
    model = training.category_indexer(["Weather"]).fit(train)
    names = [("a",), ("b",), ("c",), ("new",), (None,)]
    indexed = model.transform(spark.createDataFrame(names, "Weather STRING"))
    assert {row.Weather: row.WeatherIndexed for row in indexed.collect()} == {
        "b": 0.0, "c": 1.0, "a": 2.0, "new": 3.0, None: 3.0,
    }


def test_assembler_leaves_out_incomplete_rows(spark):
    df = spark.createDataFrame(
        [(1, 1.0, True), (2, None, True), (3, float("nan"), True), (4, 1.0, None)],
        "id INT, x DOUBLE, flag BOOLEAN",
    )
    kept = training.feature_assembler(["x", "flag"]).transform(df)
    assert [(row.id, list(row.features)) for row in kept.collect()] == [(1, [1.0, 1.0])]


def test_area_under_roc_equals_the_rank_formula(spark):
    draw = random.Random(5)
    data = [(float(draw.randrange(40)), float(draw.random() < 0.4)) for _ in range(400)]
    pos = [score for score, label in data if label]
    neg = [score for score, label in data if not label]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    df = spark.createDataFrame(data, "score DOUBLE, label DOUBLE")
    area = training.area_under_roc(df, bins=0, score="score")
    assert area == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-12)


def test_too_many_categories_are_refused_before_fitting(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("Weather"))
    with pytest.raises(ValueError, match="Weather"):
        training.check_categories(df, ["Weather"], 150)
    training.check_categories(df.where("id < 149"), ["Weather"], 150)
    with pytest.raises(ValueError, match="Weather"):
        training.check_categories(df.where("id < 150"), ["Weather"], 150)


def test_bins_accept_what_the_trees_accept(spark, tables):
    rows = training.with_label(accidents(spark, tables))
    # Four kinds of weather and of wind, and a place for missing values.
    training.fit(rows, bins=5, **QUICK)
    with pytest.raises(ValueError, match="Weather"):
        training.fit(rows, bins=4, **QUICK)


def test_category_index_of_many_values_equals_the_librarys(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 7 > 0, (F.col("id") * F.col("id") % 911).cast("string")).alias("Weather"),
        (F.col("id") % 5 == 0).cast("string").alias("Wind"),
    )
    names = ["Weather", "Wind"]
    expected = training.category_indexer(names).fit(df).transform(df)
    assert rows(training.with_category_index(df.repartition(5), names)) == rows(expected)
    assert training.with_category_index(df.limit(0), names).count() == 0


def test_rows_without_a_key_are_drawn_by_their_other_columns(spark):
    df = spark.range(1000).select(
        F.lit(None).cast("string").alias("ID"), F.lit(0).alias("label"), F.col("id").alias("measure")
    )
    drawn = stratified_sample(df, uniform=training.draw(df, ["ID"], 36)).count()
    assert drawn == pytest.approx(240, abs=60)
    keyed = df.withColumn("ID", F.col("measure").cast("string"))
    other = keyed.withColumn("measure", F.lit(0))
    by_key = [stratified_sample(t, uniform=training.draw(t, ["ID"], 36)) for t in (keyed, other)]
    assert rows(by_key[0].select("ID")) == rows(by_key[1].select("ID"))


@pytest.fixture(scope="module")
def trained(spark, tables):
    return training.train_severity(accidents(spark, tables), iterations=5)


def test_training_learns_and_survives_saving(spark, tables, tmp_path, trained):
    assert trained.area_under_roc > 0.8
    save_model(trained.model, str(tmp_path / "model"))
    save_model(trained.model, str(tmp_path / "model"))  # overwrites
    scored = training.with_label(accidents(spark, tables)).select(
        "ID", "label", *schema.MEAN_COLUMNS, *schema.RATE_COLUMNS, *schema.CATEGORY_COLUMNS
    )

    def predicted(model):
        out = model.transform(scored)
        return rows(out.select("ID", "prediction", vector_to_array("probability").alias("p")))

    again = load_model(str(tmp_path / "model"))
    assert predicted(again) == predicted(trained.model)
    complete = scored.na.drop("any", subset=schema.MEAN_COLUMNS + schema.RATE_COLUMNS)
    assert len(predicted(again)) == complete.count() < scored.count()


def test_training_does_not_depend_on_the_layout(spark, tables, trained):
    again = training.train_severity(accidents(spark, tables).repartition(5), iterations=5)
    assert again.area_under_roc == trained.area_under_roc


def test_training_leaves_no_sample_and_shows_held_out_rows(spark, tables, tmp_path):
    folder, kept = tmp_path / "work", tmp_path / "kept"
    trained = training.train_severity(accidents(spark, tables), work_folder=str(folder), **QUICK)
    assert not [p for p in folder.glob("sample-*")] and len(trained.preview) == 5
    again = training.train_severity(
        accidents(spark, tables), sample_path=str(kept), predictions_path=str(tmp_path / "p"), **QUICK
    )
    assert spark.read.parquet(str(kept)).count() > 0 and again.preview == trained.preview
    held_out = spark.read.parquet(str(tmp_path / "p"))
    assert rows(preview(held_out, ["ID"])) == rows(spark.createDataFrame(trained.preview, held_out.select("label", "prediction", "probability").schema))


def test_training_without_a_key(spark, tables):
    assert training.train_severity(accidents(spark, tables), key=None, **QUICK).area_under_roc > 0.5


def test_preview_is_the_same_every_time(spark, tables, trained):
    scored = trained.model.transform(training.with_label(accidents(spark, tables)))
    shown = preview(scored, "ID")
    assert shown.columns == ["label", "prediction", "probability"]
    assert shown.count() == 5 and rows(shown) == rows(preview(scored.repartition(3), "ID"))
