"""Churn and customer-lifetime-value prediction with Spark MLlib."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F

from storeloom.functions.calendar import days_between
from storeloom.functions.numeric import cents_to_money, from_cents, round2
from storeloom.functions.selection import exact_median, hash_split
from storeloom.operators.kpis import ACTIVE_DAYS, purchase_aggregates, purchases_per_month
from storeloom.session import through_table

# Feature lists, model settings and segment bounds.
CHURN_FEATURES = ["total_purchases", "total_spent", "avg_order_value", "total_quantity",
                  "customer_lifetime_days", "purchase_frequency_per_month",
                  "days_since_last_purchase"]
CLV_FEATURES = ["total_purchases", "avg_order_value", "total_quantity",
                "customer_lifetime_days", "purchase_frequency_per_month",
                "days_since_last_purchase"]
LEAKY_FEATURE = "days_since_last_purchase"
NEVER_BOUGHT_DAYS = 999
TRAIN_FRACTION = 0.75
SEED = 42
GBT_ROUNDS, GBT_RATE, GBT_DEPTH = 100, 0.1, 5
FOREST_TREES, FOREST_DEPTH = 100, 10
LOW_RISK, HIGH_RISK = 0.3, 0.7
#: Training rows that make another task worth its start; a tree level is a job over all of them.
TASK_ROWS = 20_000
SEGMENTS = ["High Value at Risk", "Champions", "At Risk", "Loyal", "Standard"]

PREDICTION_COLUMNS = ["id_client", "name", "email", "country", "total_purchases", "total_spent",
                      "days_since_last_purchase", "churn_probability", "churn_risk",
                      "predicted_clv", "segment"]


# --- features --------------------------------------------------------------

def features_join(clients: DataFrame, purchases: DataFrame) -> DataFrame:
    """All clients with their purchase aggregates; unfilled for non-buyers."""
    spent = F.col("spent_cents")
    bought = purchase_aggregates(purchases).select(
        "id_client", "total_purchases", cents_to_money(spent).alias("total_spent"),
        F.try_divide(from_cents(spent), F.col("total_purchases")).alias("avg_order_value"),
        "min_order_value", "max_order_value", "total_quantity",
        "first_purchase_date", "last_purchase_date")
    return clients.join(bought, "id_client", "left")


def churn_label(features: DataFrame) -> DataFrame:
    return features.withColumn(
        "is_churned", (F.col("days_since_last_purchase") > ACTIVE_DAYS).cast("int"))


def client_features(clients: DataFrame, purchases: DataFrame, as_of: date) -> DataFrame:
    """One row per client, buyer or not.

    Lifetime counts from the subscription here (the KPIs count from the first
    purchase), and the frequency stays unrounded.
    """
    today = F.lit(as_of)
    money_or_zero = F.coalesce(F.col("total_spent"), F.lit(0)).cast("decimal(18,2)")
    orders = F.coalesce("total_purchases", F.lit(0).cast("bigint"))
    lifetime = days_between(today, F.col("subscription_date"))
    recency = F.coalesce(days_between(today, F.col("last_purchase_date")),
                         F.lit(NEVER_BOUGHT_DAYS))
    return (features_join(clients, purchases)
            .withColumns({
                "total_purchases": orders,
                "total_spent": money_or_zero,
                "avg_order_value": F.coalesce("avg_order_value", F.lit(0.0)),
                "total_quantity": F.coalesce("total_quantity", F.lit(0).cast("bigint")),
                "customer_lifetime_days": lifetime,
                "days_since_last_purchase": recency,
                "purchase_frequency_per_month": purchases_per_month(orders, lifetime)})
            .transform(churn_label))


def stratified_split(features: DataFrame, label: str | None = "is_churned",
                     fraction: float = TRAIN_FRACTION, seed: int = SEED) -> DataFrame:
    """``is_train`` for exactly the given fraction of every label, repeatable."""
    return hash_split(features, "id_client", fraction, seed, label)


def model_input(features: DataFrame, columns: list[str]) -> DataFrame:
    """Adds each feature as a double without NULL, named ``x_<feature>``."""
    return features.withColumns(
        {f"x_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns})


def scaling_stages(columns: list[str], name: str) -> list:
    """Assemble and standardise; ``name`` keeps the columns of two models apart."""
    return [VectorAssembler(inputCols=[f"x_{c}" for c in columns], outputCol=f"{name}_raw"),
            StandardScaler(inputCol=f"{name}_raw", outputCol=f"{name}_features",
                           withMean=True, withStd=True)]


def scale_features(features: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Standardised feature columns; mean and deviation from the training rows.

    ``features`` carries the ``is_train`` flag of :func:`stratified_split`.
    """
    columns = columns or CHURN_FEATURES
    data = model_input(features, columns)
    fitted = Pipeline(stages=scaling_stages(columns, "scaled")).fit(data.where("is_train"))
    scaled = vector_to_array(F.col("scaled_features"))
    return fitted.transform(data).select(
        "id_client", "is_train",
        *[F.element_at(scaled, i + 1).alias(c) for i, c in enumerate(columns)])


# --- models ----------------------------------------------------------------

def training_rows(data: DataFrame, columns: list[str]) -> DataFrame:
    """The model's columns of the training rows, written once and spread over all cores.

    A table of features is small in bytes, so its files alone would give a few
    tasks, whatever the number of rows. Rows lie by the hash of their client and
    in the order of ids, so that a model does not depend on the order of the files.
    """
    inputs = [f"x_{c}" for c in columns]
    rows = through_table(data.where("is_train").select("id_client", *inputs, "label"), "training")
    tasks = min(data.sparkSession.sparkContext.defaultParallelism, rows.count() // TASK_ROWS)
    if tasks > 1:
        rows = rows.repartition(tasks, "id_client").sortWithinPartitions("id_client", *inputs, "label")
    return rows.select(*inputs, "label")


@dataclass(frozen=True)
class Fitted:
    """A fitted pipeline, its feature columns and its predictions on held-out rows."""

    model: PipelineModel
    columns: list[str]
    held_out: DataFrame


def train_churn_model(features: DataFrame, rounds: int = GBT_ROUNDS, rate: float = GBT_RATE,
                      depth: int = GBT_DEPTH, seed: int = SEED,
                      drop_leaky: bool = False) -> Fitted:
    """Boosted trees for ``is_churned``.

    The label is a function of ``days_since_last_purchase``; ``drop_leaky``
    leaves that feature out. ``features`` is scanned for the split, the training
    rows and whatever reads the held-out ones, so give a written table.
    """
    columns = [c for c in CHURN_FEATURES if not (drop_leaky and c == LEAKY_FEATURE)]
    data = model_input(stratified_split(features, seed=seed), columns).withColumn(
        "label", F.col("is_churned").cast("double"))
    boosted = (GBTClassifier(featuresCol="churn_features", labelCol="label",
                             predictionCol="churn_prediction", maxIter=rounds, stepSize=rate,
                             maxDepth=depth, seed=seed)
               .setProbabilityCol("churn_vector").setRawPredictionCol("churn_margin"))
    model = Pipeline(stages=[*scaling_stages(columns, "churn"), boosted]).fit(training_rows(data, columns))
    return Fitted(model, columns, model.transform(data.where(~F.col("is_train"))))


def train_clv_model(features: DataFrame, trees: int = FOREST_TREES, depth: int = FOREST_DEPTH,
                    seed: int = SEED) -> Fitted:
    """A random forest for ``total_spent`` of the clients that bought something."""
    buyers = features.where(F.col("total_purchases") > 0)
    data = model_input(stratified_split(buyers, label=None, seed=seed), CLV_FEATURES).withColumn(
        "label", F.col("total_spent").cast("double"))
    forest = RandomForestRegressor(featuresCol="clv_features", labelCol="label",
                                   predictionCol="clv_prediction", numTrees=trees,
                                   maxDepth=depth, minInstancesPerNode=2,
                                   featureSubsetStrategy="all", seed=seed)
    model = Pipeline(stages=[*scaling_stages(CLV_FEATURES, "clv"), forest]).fit(training_rows(data, CLV_FEATURES))
    return Fitted(model, CLV_FEATURES, model.transform(data.where(~F.col("is_train"))))


def churn_metrics(fitted: Fitted) -> DataFrame:
    """``(metric, value)``: accuracy, ROC-AUC and precision, recall, F1 of churners."""
    scored = fitted.held_out
    auc = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="churn_margin",
                                        metricName="areaUnderROC").evaluate(scored)
    said, is_so = F.col("churn_prediction") == 1, F.col("label") == 1
    both = F.count_if(said & is_so)
    row = scored.agg(
        F.avg((said == is_so).cast("double")).alias("accuracy"),
        F.lit(float(auc)).alias("roc_auc"),
        F.try_divide(both, F.count_if(said)).alias("precision"),
        F.try_divide(both, F.count_if(is_so)).alias("recall"),
        F.try_divide(both * 2, F.count_if(said) + F.count_if(is_so)).alias("f1_score"))
    return row.unpivot([], row.columns, "metric", "value")


def clv_metrics(fitted: Fitted) -> DataFrame:
    """``(metric, value)``: MAE, RMSE and R2, from one aggregation."""
    error = F.col("label") - F.col("clv_prediction")
    squares = F.sum(error * error)
    row = fitted.held_out.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.try_divide(squares, F.var_pop("label") * F.count("label"))).alias("r2_score"))
    return row.unpivot([], row.columns, "metric", "value")


def feature_importance(spark, fitted: Fitted, top: int | None = None) -> DataFrame:
    """``(feature, importance)`` descending; as many rows as features."""
    weights = fitted.model.stages[-1].featureImportances.toArray().tolist()
    frame = spark.createDataFrame(list(zip(fitted.columns, weights)),
                                  "feature string, importance double")
    ordered = frame.orderBy(F.col("importance").desc(), F.col("feature"))
    return ordered if top is None else ordered.limit(top)


# --- predictions -----------------------------------------------------------

def churn_risk_band(probability: Column) -> Column:
    """Low (0, 0.3], Medium (0.3, 0.7], High (0.7, 1]; NULL at exactly 0."""
    return (F.when((probability > 0) & (probability <= LOW_RISK), "Low")
            .when((probability > LOW_RISK) & (probability <= HIGH_RISK), "Medium")
            .when((probability > HIGH_RISK) & (probability <= 1), "High"))


def client_segments(scored: DataFrame, approx: bool = False) -> DataFrame:
    """``segment`` from churn probability and predicted value against its median."""
    threshold = exact_median(scored, "predicted_clv", approx).scalar()
    p = F.col("churn_probability")
    return (scored.withColumn("_high", F.col("predicted_clv").cast("double") > threshold)
            .withColumn("segment",
                        F.when((p > HIGH_RISK) & F.col("_high"), SEGMENTS[0])
                        .when((p < LOW_RISK) & F.col("_high"), SEGMENTS[1])
                        .when((p > HIGH_RISK) & ~F.col("_high"), SEGMENTS[2])
                        .when((p < LOW_RISK) & ~F.col("_high"), SEGMENTS[3])
                        .otherwise(SEGMENTS[4]))
            .drop("_high"))


def score_clients(features: DataFrame, churn: Fitted, clv: Fitted) -> DataFrame:
    """Churn probability of all clients, predicted value of buyers, else 0.

    Both models run on the same row, so scoring is one narrow pass.
    """
    probability = F.element_at(vector_to_array(F.col("churn_vector")), 2)
    value = F.when(F.col("total_purchases") > 0, F.col("clv_prediction")).otherwise(F.lit(0.0))
    wide = model_input(features, sorted({*churn.columns, *clv.columns}))
    return (clv.model.transform(churn.model.transform(wide))
            .select("id_client", "name", "email", "country", "total_purchases", "total_spent",
                    "days_since_last_purchase", probability.alias("churn_probability"),
                    value.alias("predicted_clv"))
            .withColumn("churn_risk", churn_risk_band(F.col("churn_probability"))))


def predict_clients(features: DataFrame, churn: Fitted, clv: Fitted) -> DataFrame:
    """One row per client with probability, risk band, predicted value and segment.

    The scores are written once, since the median and the segments both read
    them and scoring runs every tree.
    """
    scored = through_table(score_clients(features, churn, clv), "scores")
    return client_segments(scored).select(*PREDICTION_COLUMNS)


def segment_counts(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("segment").agg(F.count(F.lit(1)).alias("clients"))


def segment_insights(predictions: DataFrame) -> DataFrame:
    """``(metric, value)``: clients per segment, in total, mean risk, summed value."""
    def of(segment: str) -> Column:
        return F.count_if(F.col("segment") == segment).cast("double").alias(
            segment.lower().replace(" ", "_"))

    row = predictions.agg(
        F.count(F.lit(1)).cast("double").alias("total_customers"),
        *[of(s) for s in SEGMENTS],
        F.avg("churn_probability").cast("decimal(38,6)").cast("double")
        .alias("avg_churn_probability"),
        round2(F.sum(F.col("predicted_clv").cast("double"))).alias("total_predicted_clv"))
    return row.unpivot([], row.columns, "metric", "value")


def top_at_risk(predictions: DataFrame, limit: int = 10) -> DataFrame:
    return (predictions.where(F.col("segment") == SEGMENTS[0])
            .orderBy(F.col("predicted_clv").desc(), F.col("id_client")).limit(limit))
