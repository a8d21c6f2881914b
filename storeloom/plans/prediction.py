"""Silver to predictions: features, both models, scores, files and report."""

from __future__ import annotations

from datetime import date

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from storeloom.layout import Layout
from storeloom.operators import ml
from storeloom.plans.silver import read_silver
from storeloom.sources import sinks

CHURN_REPORT = ["accuracy", "roc_auc", "precision", "recall", "f1_score"]
CLV_REPORT = ["mae", "rmse", "r2_score"]


def _metrics(rows: DataFrame, section: str) -> DataFrame:
    return rows.select(F.lit(section).alias("section"), "metric", "value")


def _top_features(spark: SparkSession, fitted: ml.Fitted, top: int = 5) -> DataFrame:
    """One row: the array of the most important features (at most ``top``)."""
    best = ml.feature_importance(spark, fitted, top)
    pairs = F.collect_list(F.struct("importance", "feature"))
    ordered = F.sort_array(pairs, asc=False)
    return best.agg(F.transform(
        ordered, lambda p: F.struct(p["feature"].alias("feature"),
                                    p["importance"].alias("importance"))).alias("top_features"))


def save_model(spark: SparkSession, layout: Layout, churn: ml.Fitted, clv: ml.Fitted,
               predictions: DataFrame, export_csv: bool = True) -> DataFrame:
    """Write both models, the predictions and the report; return the report row."""
    churn.model.write().overwrite().save(layout.path("ml", "churn_model"))
    clv.model.write().overwrite().save(layout.path("ml", "clv_model"))
    sinks.write_parquet(predictions, layout.path("ml", "predictions"))
    written = spark.read.parquet(layout.path("ml", "predictions"))
    if export_csv:
        sinks.write_csv(written, layout.export("ml", "predictions", "csv"))

    insights = ["total_customers", *[s.lower().replace(" ", "_") for s in ml.SEGMENTS],
                "avg_churn_probability", "total_predicted_clv"]
    long = (_metrics(ml.churn_metrics(churn), "churn_model")
            .unionByName(_metrics(ml.clv_metrics(clv), "clv_model"))
            .unionByName(_metrics(ml.segment_insights(written), "business_insights")))
    row = sinks.report_row(long, {"churn_model": CHURN_REPORT, "clv_model": CLV_REPORT,
                                  "business_insights": insights}).select(
        "*",
        _top_features(spark, churn).scalar().alias("churn_top_features"),
        _top_features(spark, clv).scalar().alias("clv_top_features"))
    path = sinks.write_json_report(row, layout.export("ml", "report", "json"))
    return spark.read.json(path)


def load_models(layout: Layout) -> tuple[PipelineModel, PipelineModel]:
    return (PipelineModel.load(layout.path("ml", "churn_model")),
            PipelineModel.load(layout.path("ml", "clv_model")))


def prediction_flow(spark: SparkSession, layout: Layout, as_of: date,
                    rounds: int = ml.GBT_ROUNDS, trees: int = ml.FOREST_TREES,
                    drop_leaky: bool = False, export_csv: bool = True) -> DataFrame:
    """Features to a table, train, score every client, save; returns the report row."""
    silver = read_silver(spark, layout)
    path = layout.path("ml", "features")
    sinks.write_parquet(ml.client_features(silver["clients"], silver["purchases"], as_of), path)
    features = spark.read.parquet(path)
    churn = ml.train_churn_model(features, rounds=rounds, drop_leaky=drop_leaky)
    clv = ml.train_clv_model(features, trees=trees)
    return save_model(spark, layout, churn, clv, ml.predict_clients(features, churn, clv),
                      export_csv)
