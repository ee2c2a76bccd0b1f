from __future__ import annotations

import pytest

from tripmill.models import regress
from tripmill.operators import metrics
from tripmill.plans import dashboard, scoring, training
from tripmill.sources import synthetic, tables
from tripmill.streaming.scoring import score_arrivals

SETTINGS = training.TrainingSettings(trees=3, class_depth=4, fare_depth=4, restarts=1, folds=2)


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("models") / "run")
    return path, training.run(spark, sample_size=600, use_synthetic=True, path=path, settings=SETTINGS)


@pytest.fixture(scope="module")
def fresh(spark):
    return synthetic.synthetic_trips(synthetic.trip_ids(spark, 100)).drop("fare_amount", "total_amount")


def test_metrics_of_every_stage(trained):
    rows = {(r.stage, r.key, r.metric) for r in trained[1].metrics.collect()}
    assert {stage for stage, _, _ in rows} == {"classification", "regression", "category_regression", "cross_validation"}
    assert trained[1].statistics.count() == 3
    assert {r["class"] for r in trained[1].report.collect()} >= {"low", "medium", "high", "weighted avg"}


def test_saved_models_predict_the_same(spark, trained, fresh):
    path, run = trained
    loaded = scoring.FareScorer.load(spark, path)
    left, right = (s.predict(fresh).select("id", "cluster", "predicted_fare_category", "predicted_fare") for s in (run.scorer, loaded))
    assert left.count() == 100 and left.exceptAll(right).count() == 0
    assert left.filter("predicted_fare <= 0 or cluster is null or predicted_fare_category is null").count() == 0
    with pytest.raises(FileNotFoundError):
        scoring.FareScorer.load(spark, path + "-none")


def test_scoring_starts_no_job_and_no_python(spark, trained, fresh):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    scored = trained[1].scorer.predict(fresh)
    assert list(tracker.getJobIdsForGroup("planning")) == []
    assert "Python" not in scored._jdf.queryExecution().toString()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_single_trip_and_empty_batch(spark, trained):
    scorer = trained[1].scorer
    one = scorer.predict_single_trip(spark, {"trip_distance": 5.2, "passenger_count": 2, "pickup_hour": 18, "payment_type": 1})
    assert one.columns == ["predicted_fare", "predicted_fare_category", "cluster"] and one.first().predicted_fare > 0
    assert scorer.predict_single_trip(spark, {"passenger_count": 1}).count() == 1
    assert scorer.predict_batch(spark, []).first().trip_distance == 5.0
    two = scorer.predict_batch(spark, [{"trip_distance": 1}, {"passenger_count": 3}])
    assert sorted(r.trip_distance for r in two.collect()) == [1.0, 5.0]


def test_table_source(spark):
    tables.replace_table(synthetic.synthetic_trips(synthetic.trip_ids(spark, 200)), "all_taxi_trips_test")
    from tripmill.plans.ingest import ingest

    assert 0 < ingest(spark, "all_taxi_trips_test", 100).count() <= 100
    spark.sql("DROP TABLE all_taxi_trips_test")


def test_stream_equals_batch(spark, trained, fresh, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    fresh.write.parquet(source)
    query = score_arrivals(spark, trained[1].scorer, source, target, str(tmp_path / "check"), fresh.schema)
    query.awaitTermination()
    columns = ["id", "cluster", "predicted_fare_category", "predicted_fare"]
    assert spark.read.parquet(target).select(columns).exceptAll(trained[1].scorer.predict(fresh).select(columns)).count() == 0


def test_dashboard(spark, trained, tmp_path):
    trips = synthetic.synthetic_trips(synthetic.trip_ids(spark, 300))
    from tripmill.operators.features import add_fare_category

    scored = add_fare_category(trained[1].scorer.predict(trips))
    importances = regress.feature_importances(trained[1].global_regressor, spark=spark)
    comparison = metrics.compare_models(scored.withColumn("flat", scored.fare_amount * 0 + 50), "fare_amount", {"staged": "predicted_fare", "flat": "flat"})
    paths = dashboard.write_dashboard(scored, str(tmp_path / "all"), "id", ["trip_distance", "speed"], importances, comparison)
    assert len(paths) == 10 and all(spark.read.parquet(p).count() > 0 for p in paths)
    assert spark.read.parquet(str(tmp_path / "all/feature_importance")).count() == 8
    assert len(dashboard.chart_tables(scored, "id", ["trip_distance", "speed"])) == 8


def test_requests_keep_fields_that_no_schema_names(spark):
    rows = [{"trip_distance": 2, "request_id": "a", "is_weekend": True, "speed": 12.5}, {"request_id": 7, "note": None}]
    got = scoring.request_frame(spark, rows)
    assert dict(got.dtypes) == {"trip_distance": "double", "is_weekend": "boolean", "note": "string", "request_id": "string", "speed": "double"}
    assert [tuple(r) for r in got.select("request_id", "speed", "is_weekend").collect()] == [("a", 12.5, True), ("7", None, None)]
