"""Features, splits, models and segments."""

from datetime import date

import pytest
from storeloom.checks import queries as checks
from pyspark.sql import functions as F
from storeloom.layout import Layout
from storeloom.operators import ml
from storeloom.plans import prediction
from storeloom.session import scratch_path, through_table
from storeloom.sources import sinks, starschema
from test_gold import people, sales


@pytest.fixture(scope="module")
def features(spark, golden):
    return through_table(checks._features(spark, golden), "features")


@pytest.fixture(scope="module")
def models(features):
    return ml.train_churn_model(features, rounds=10), ml.train_clv_model(features, trees=20)


def test_client_without_a_purchase(spark):
    c = people(spark, [(1, "a", "FR"), (2, "b", "FR")])
    p = sales(spark, [(1, "x", 5, 2, date(2024, 5, 1))])
    got = {r.id_client: r for r in ml.client_features(c, p, date(2024, 6, 1)).collect()}
    assert got[2].total_purchases == 0 and float(got[2].total_spent) == 0.0
    assert got[2].min_order_value is None and got[2].days_since_last_purchase == 999
    assert (got[1].is_churned, got[2].is_churned) == (0, 1)


def test_split_keeps_label_shares(features):
    split = ml.stratified_split(features)
    n = {r.is_churned: (r.n, r.t) for r in split.groupBy("is_churned").agg(
        F.count("id_client").alias("n"), F.count_if("is_train").alias("t")).collect()}
    assert all(t == int(0.75 * total) for total, t in n.values()) and len(n) == 2


def test_scaled_training_rows_are_standard(features):
    scaled = ml.scale_features(ml.stratified_split(features)).where("is_train")
    row = scaled.agg(F.avg("total_spent").alias("m"), F.stddev_samp("total_spent").alias("s")).first()
    assert row.m == pytest.approx(0, abs=1e-9) and row.s == pytest.approx(1, abs=1e-9)


def test_model_quality(spark, models):
    churn, clv = models
    c = {r.metric: r.value for r in ml.churn_metrics(churn).collect()}
    assert c["roc_auc"] > 0.99 and c["accuracy"] > 0.97
    assert c["f1_score"] == pytest.approx(
        2 * c["precision"] * c["recall"] / (c["precision"] + c["recall"]))
    v = {r.metric: r.value for r in ml.clv_metrics(clv).collect()}
    assert v["r2_score"] > 0.9 and v["mae"] <= v["rmse"]
    weights = ml.feature_importance(spark, churn).collect()
    assert weights[0].feature == ml.LEAKY_FEATURE
    assert sum(r.importance for r in weights) == pytest.approx(1)


def test_training_repeats(features, models):
    again = ml.train_churn_model(features, rounds=10)
    key = ["id_client", "churn_prediction"]
    assert sorted(again.held_out.select(*key).collect()) == sorted(
        models[0].held_out.select(*key).collect())


def test_split_is_read_without_a_shuffle(features):
    plan = ml.stratified_split(features)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan


def test_training_rows_use_all_cores(spark, features, monkeypatch):
    monkeypatch.setattr(ml, "TASK_ROWS", 50)
    data = ml.model_input(ml.stratified_split(features), ml.CLV_FEATURES).withColumn("label", F.col("total_spent"))
    rows = ml.training_rows(data, ml.CLV_FEATURES)
    own = [*[f"x_{c}" for c in ml.CLV_FEATURES], "label"]
    assert rows.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(rows.collect()) == sorted(data.where("is_train").select(*own).collect())
    # Files in another order give the same model.
    turned = through_table(features.repartition(3, "country"), "turned")
    first, other = (ml.train_clv_model(f, trees=3).held_out.select("id_client", "clv_prediction").collect()
                    for f in (features, turned))
    assert sorted(first) == sorted(other)


def test_leaky_feature_can_be_left_out(features):
    fitted = ml.train_churn_model(features, rounds=2, drop_leaky=True)
    assert ml.LEAKY_FEATURE not in fitted.columns


def test_predictions(features, models):
    got = ml.predict_clients(features, *models)
    assert got.columns == ml.PREDICTION_COLUMNS and got.count() == 1500
    assert got.where("total_purchases = 0 and predicted_clv <> 0").count() == 0
    assert got.where("churn_probability < 0 or churn_probability > 1").count() == 0
    counts = {r.segment: r.clients for r in ml.segment_counts(got).collect()}
    assert sum(counts.values()) == 1500 and set(counts) <= set(ml.SEGMENTS)
    best = ml.top_at_risk(got, 5).collect()
    assert [r.predicted_clv for r in best] == sorted((r.predicted_clv for r in best), reverse=True)


@pytest.mark.parametrize("p,band", [(0.0, None), (0.3, "Low"), (0.31, "Medium"), (0.7, "Medium"),
                                    (0.71, "High"), (1.0, "High"), (1e-9, "Low")])
def test_risk_band(spark, p, band):
    assert spark.range(1).select(ml.churn_risk_band(F.lit(p))).first()[0] == band


def test_segments_at_their_bounds(spark):
    data = [(1, 0.71, 5.0), (2, 0.29, 5.0), (3, 0.71, 3.0), (4, 0.29, 3.0), (5, 0.3, 1.0),
            (6, 0.7, 9.0), (7, 0.9, 1.0)]    # the median value is 3
    df = spark.createDataFrame(data, "id_client int, churn_probability double, predicted_clv double")
    got = {r.id_client: r.segment for r in ml.client_segments(df).collect()}
    assert got == {1: "High Value at Risk", 2: "Champions", 3: "At Risk", 4: "Loyal",
                   5: "Standard", 6: "Standard", 7: "At Risk"}


def test_golden_segments(spark, golden):
    scores = checks._synthetic_scores(spark, golden)
    banded = scores.select(ml.churn_risk_band(F.col("churn_probability")).alias("b"))
    assert {r.b: r["count"] for r in banded.groupBy("b").count().collect()} == {
        "Low": 450, "Medium": 600, "High": 435, None: 15}
    counts = {r.segment: r.clients for r in ml.segment_counts(ml.client_segments(scores)).collect()}
    assert counts == {"High Value at Risk": 215, "Champions": 227, "At Risk": 220, "Loyal": 223,
                      "Standard": 615}


def test_prediction_flow_saves_and_loads(spark, sf):
    layout = Layout(scratch_path(spark, "ml"))
    sinks.write_parquet(starschema.clients(spark, sf), layout.path("silver", "clients"))
    sinks.write_parquet(starschema.purchases(spark, sf), layout.path("silver", "purchases"))
    report = prediction.prediction_flow(spark, layout, checks.AS_OF, rounds=3, trees=5).first()
    assert report.business_insights.total_customers == 150.0
    assert len(report.churn_top_features) == 5
    churn, clv = prediction.load_models(layout)
    features = spark.read.parquet(layout.path("ml", "features"))
    again = ml.score_clients(features, ml.Fitted(churn, ml.CHURN_FEATURES, features),
                             ml.Fitted(clv, ml.CLV_FEATURES, features))
    key = ["id_client", "churn_probability", "predicted_clv"]
    saved = spark.read.parquet(layout.path("ml", "predictions"))
    assert sorted(again.select(*key).collect()) == sorted(saved.select(*key).collect())
    assert spark.read.option("header", True).csv(
        layout.export("ml", "predictions", "csv")).count() == 150
