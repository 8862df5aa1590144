import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from furrow.operators import bagging, models
from furrow.operators.bagging import BaggedForest
from furrow.plans import queries
from furrow.sources import shared


@pytest.fixture(scope="module")
def table(spark):
    path = shared.fresh_path(spark, "model-rows")
    spark.range(600).select(
        F.col("id").alias("reading_id"), (F.col("id") % 50).cast("double").alias("a"),
        (F.col("id") % 7).cast("double").alias("b"),
        ((F.col("id") % 50) >= 25).cast("int").alias("label"),
        (F.col("id") % 50 * 2.0).alias("value"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def vectors(table):
    return models.assemble(models.hashed_split(table, "reading_id"), ["a", "b"])


def test_split_ignores_partitioning(table, rows):
    split = lambda df: rows(models.hashed_split(df, "reading_id"), "reading_id", "split")
    assert split(table.repartition(3)) == split(table.coalesce(1))
    sides = {r.split: r["count"] for r in models.hashed_split(table, "reading_id").groupBy("split").count().collect()}
    assert sum(sides.values()) == 600 and 0.75 < sides["train"] / 600 < 0.85


def test_classification_metrics_equal_the_evaluator(spark):
    data = [(t, g) for t, g, n in [(0, 0.0, 5), (0, 1.0, 2), (1, 1.0, 4), (1, 2.0, 1), (2, 0.0, 3)] for _ in range(n)]
    scored = spark.createDataFrame(data, "label int, prediction double")
    found = models.classification_metrics(scored, "label").first()
    for name, metric in [("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                         ("weighted_recall", "weightedRecall"), ("f1", "f1")]:
        expected = MulticlassClassificationEvaluator(labelCol="label", metricName=metric).evaluate(scored)
        assert found[name] == pytest.approx(expected, abs=1e-12), name


def test_regression_metrics_equal_the_evaluator(spark):
    scored = spark.createDataFrame([(1.0, 1.5), (2.0, 1.0), (4.0, 4.5), (8.0, 6.0)], "label double, prediction double")
    found = models.regression_metrics(scored, "label").first()
    for metric in ("mae", "rmse", "r2"):
        assert found[metric] == pytest.approx(RegressionEvaluator(metricName=metric).evaluate(scored), abs=1e-12)


def test_classifier_reload_importance_and_summary(spark, table):
    split = vectors(table)
    model = models.fit_classifier(split.filter("split = 'train'"), "label", ["a", "b"], numTrees=5)
    test = split.filter("split = 'test'")
    scored = model.transform(test)
    metrics = models.classification_metrics(scored, "label")
    assert metrics.first().accuracy > 0.95
    path = shared.fresh_path(spark, "forest")
    models.save_model(model, path)
    again = BaggedForest.load(path).transform(test)
    pick = lambda df: sorted((r.reading_id, r.prediction, str(r.probability)) for r in df.collect())
    assert pick(again) == pick(scored)
    ranked = models.feature_importance(spark, model, ["a", "b"]).collect()
    assert [r.feature_name for r in ranked] == ["a", "b"]
    assert sum(r.importance_score for r in ranked) == pytest.approx(1.0)
    summary = models.training_summary(split, metrics, {"algorithm": "forest", "tree_count": 5}).first()
    assert summary.total_records == 600 == summary.train_records + summary.test_records
    assert (summary.algorithm, summary.tree_count) == ("forest", 5)


def test_regressor(table):
    split = vectors(table)
    model = models.fit_regressor(split.filter("split = 'train'"), "value", ["a", "b"], numTrees=5)
    assert models.regression_metrics(model.transform(split.filter("split = 'test'")), "value").first().r2 > 0.9


def test_incomplete_rows(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (None, 2.0)], "a double, b double")
    assert models.assemble(frame, ["a", "b"], invalid="skip").count() == 1
    with pytest.raises(Exception):
        models.assemble(frame, ["a", "b"]).collect()


def test_forests_do_not_depend_on_partitions(table):
    split = vectors(table)
    train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
    for fit, target in ((models.fit_classifier, "label"), (models.fit_regressor, "value")):
        fitted = [fit(train.repartition(n), target, ["a", "b"], numTrees=4, draws=2) for n in (1, 9, 64)]
        assert fitted[0].trees == fitted[1].trees == fitted[2].trees and len(fitted[0].trees) == 4
        assert len({str(model.featureImportances) for model in fitted}) == 1
        pick = lambda model: sorted((r.reading_id, r.prediction) for r in model.transform(test).collect())
        assert pick(fitted[0]) == pick(fitted[1]) == pick(fitted[2])


def test_a_fit_reads_its_rows_once(spark, table):
    """Counting, bin edges and binning share one scan, and nothing stays cached."""
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    for fit, target in ((models.fit_classifier, "label"), (models.fit_regressor, "value")):
        before = read.value
        fit(table.mapInArrow(seen, table.schema), target, ["a", "b"], numTrees=4, draws=2)
        assert read.value - before == table.count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached


def test_edges_of_a_sample_do_not_depend_on_partitions(table, monkeypatch):
    """More rows than the edges are read off: the sample must be the same rows."""
    monkeypatch.setattr(bagging, "EDGE_ROWS", 100)
    edges = [bagging._edges(table.repartition(n), ["a", "b"], "reading_id", 42, 600) for n in (1, 7)]
    assert edges[0] == edges[1] and len(edges[0][0]) > 10


def test_no_task_of_the_repartition_check_gets_the_whole_table(spark, sf, monkeypatch):
    class Seen(Exception):
        pass

    def seen(train, *rest, **settings):
        raise Seen(train.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first())

    monkeypatch.setattr(models, "fit_classifier", seen)
    monkeypatch.setattr(bagging, "ROWS_OF_TASK", 20)
    with pytest.raises(Seen) as found:  # the first forest's, of the fewest partitions
        queries.forest_repartition_check(spark, sf)
    most, rows = found.value.args[0]
    assert rows > 100 and most < 40
    assert (bagging.tasks_for(spark.range(61)), bagging.tasks_for(spark.range(0))) == (4, 1)


def test_votes_of_draws_are_those_of_one_forest(spark, table):
    """Raw votes add up over draws, probabilities to one; the most voted label is predicted, of equal ones the smaller."""
    split = vectors(table)
    model = models.fit_classifier(split, "label", ["a", "b"], numTrees=5, draws=2)
    assert [m.getNumTrees for m in model.members] == [3, 2] and model.getNumTrees == 5 and model.numFeatures == 2
    for row in model.transform(split.limit(50)).collect():
        assert row.rawPrediction.toArray().sum() == pytest.approx(5)
        assert list(row.probability) == pytest.approx([v / 5 for v in row.rawPrediction])
        assert row.prediction == max(range(2), key=lambda i: (row.rawPrediction[i], -i))


def test_poisson_weights(spark):
    rows = spark.range(20000).select(*(bagging.poisson_weight(42, d, "id").alias(f"w{d}") for d in range(2)))
    found = rows.agg(F.avg("w0").alias("mean"), F.var_pop("w0").alias("var"), F.corr("w0", "w1").alias("corr"), F.avg((F.col("w0") == 0).cast("double")).alias("none")).first()
    assert found.mean == pytest.approx(1, abs=0.03) and found["var"] == pytest.approx(1, abs=0.05)
    assert found.none == pytest.approx(0.368, abs=0.02) and abs(found["corr"]) < 0.03


def test_constant_and_missing_features_and_a_rare_label(spark):
    frame = spark.range(80).select(
        F.col("id").alias("reading_id"), F.lit(1.0).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id").cast("double")).otherwise(float("nan")).alias("b"),
        (F.col("id") == 79).cast("int").alias("label"),
    )
    model = models.fit_classifier(frame, "label", ["a", "b"], numTrees=6, draws=6)
    assert {len(r.probability) for r in model.transform(frame).collect()} == {2}
    with pytest.raises(Exception):
        models.fit_classifier(frame.withColumn("b", F.lit(None).cast("double")), "label", ["a", "b"], numTrees=1)


def test_published_forecast(spark):
    scored = spark.sql(
        "SELECT 1 AS farm_id, timestamp'2024-01-01' AS reading_hour, 1.0D AS temperature, 1.0D AS humidity,"
        " 1.0D AS soil_moisture, 1.0D AS rainfall, 1.0D AS battery, 2.0D AS next_hour_soil_moisture,"
        " 29.996D AS prediction")
    row = models.moisture_predictions(scored).first()
    assert len(row) == 10
    assert (row.predicted_next_hour_soil_moisture, row.predicted_irrigation_required) == (30.0, "YES")


def test_strongest_features(spark):
    frame = spark.range(40).select(
        F.col("id").cast("double").alias("same"), (-F.col("id")).alias("against"), F.lit(3.0).alias("constant"),
        (F.col("id") % 2).alias("odd"), F.lit(None).cast("double").alias("none"), F.col("id").alias("label"),
    )
    found = models.strongest(frame, ["odd", "constant", "same", "none", "against"], "label", 4).collect()
    assert [r.feature_name for r in found] == ["against", "same", "odd", "constant"]
    assert found[0].strength == found[1].strength == pytest.approx(1) and found[3].strength is None
    assert [r.strength for r in models.strongest(frame.limit(0), ["odd"], "label", 4).collect()] == [None]
