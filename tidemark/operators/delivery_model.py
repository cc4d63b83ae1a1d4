"""Delivery-time regression: features, training, batch scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import FeatureHasher, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import elapsed_hours
from tidemark.operators.gold import order_totals

_NUMBERS = ["items", "value", "freight", "hours_to_approval"]


def order_features(orders: DataFrame, items: DataFrame, customers: DataFrame) -> DataFrame:
    """Features of every order; ``delivery_hours`` is null until it is delivered."""
    totals = order_totals(items)
    states = customers.select("customer_id", "customer_state")
    return (
        orders.join(totals, "order_id", "left")
        .join(states, "customer_id", "left")
        .select(
            "order_id",
            F.coalesce("items", F.lit(0)).cast("double").alias("items"),
            F.coalesce(F.col("price").cast("double"), F.lit(0.0)).alias("value"),
            F.coalesce(F.col("freight").cast("double"), F.lit(0.0)).alias("freight"),
            F.coalesce(
                elapsed_hours("order_purchase_timestamp", "order_approved_at").cast("double"), F.lit(0.0)
            ).alias("hours_to_approval"),
            F.coalesce("customer_state", F.lit("unknown")).alias("state"),
            elapsed_hours("order_purchase_timestamp", "order_delivered_customer_date")
            .cast("double")
            .alias("delivery_hours"),
        )
    )


def fit_delivery_model(
    features: DataFrame,
    numbers: Sequence[str] = _NUMBERS,
    state_slots: int = 256,
    penalty: float = 0.01,
) -> PipelineModel:
    """Linear regression on the delivered orders.

    States are hashed into ``state_slots`` places, so no list of them is
    gathered, and the normal equations take one distributed pass and a matrix
    of fixed size. States that share a place share a weight; 0 leaves them out.
    """
    hashed = ["state_vector"] if state_slots else []
    stages = [
        *(FeatureHasher(inputCols=["state"], outputCol=c, numFeatures=state_slots) for c in hashed),
        VectorAssembler(inputCols=[*numbers, *hashed], outputCol="features"),
        LinearRegression(
            featuresCol="features",
            labelCol="delivery_hours",
            predictionCol="predicted_hours",
            solver="normal",
            regParam=penalty,
        ),
    ]
    return Pipeline(stages=stages).fit(features.where(F.col("delivery_hours").isNotNull()))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Predicted delivery hours of every order."""
    return model.transform(features).select("order_id", "delivery_hours", "predicted_hours")


def prediction_error(scored: DataFrame) -> DataFrame:
    """(n, mean_error, rmse, r2) of the delivered orders of ``score``; one row.

    Meant for orders that the model was not fitted on. ``r2`` is null where all took
    equally long; without delivered orders all but ``n`` is null.
    """
    error = F.col("predicted_hours") - F.col("delivery_hours")
    spread = F.var_pop("delivery_hours")
    return scored.where(F.col("delivery_hours").isNotNull()).agg(
        F.count("*").alias("n"),
        F.avg(error).alias("mean_error"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.when(spread > 0, 1 - F.avg(error * error) / spread).alias("r2"),
    )
