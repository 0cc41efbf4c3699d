"""Feature vectors, rating model and physical layout for repeated aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placemat.scratch import stage

FEATURES = ("rating", "price_level", "user_ratings_total", "latitude", "longitude")


def assemble_features(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Add ``features``; rows with a null feature are skipped."""
    assembler = VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="skip")
    return Pipeline(stages=[assembler]).fit(df).transform(df)


def train_rating_model(df: DataFrame, seed: int = 42, trees: int = 20, depth: int = 5) -> PipelineModel:
    """Random-forest regression of the rating on the other features, fitted on all rated rows."""
    inputs = [c for c in FEATURES if c != "rating"]
    assembler = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="skip")
    forest = RandomForestRegressor(
        featuresCol="features", labelCol="rating", numTrees=trees, maxDepth=depth, seed=seed
    )
    return Pipeline(stages=[assembler, forest]).fit(df.dropna(subset=["rating"]))


def holdout_predictions(df: DataFrame, key: str = "row_key", every: int = 5, **model) -> DataFrame:
    """``key, rating, prediction`` of one rated row in ``every``, by a forest fitted on the others.

    Rows are dealt by the hash of their key, so the split is the same on every run and cluster.
    """
    held = F.pmod(F.xxhash64(key), F.lit(every)) == 0
    fitted = train_rating_model(df.where(~held), **model)
    return fitted.transform(df.where(held & F.col("rating").isNotNull())).select(key, "rating", "prediction")


def prediction_error(predictions: DataFrame) -> DataFrame:
    """Root mean square error of the predictions, and that of answering the mean rating every time."""
    rated = predictions.where(F.col("rating").isNotNull() & F.col("prediction").isNotNull())
    return rated.agg(
        F.count("*").alias("rows"),
        F.sqrt(F.avg(F.pow(F.col("rating") - F.col("prediction"), 2))).alias("rmse"),
        F.stddev_pop("rating").alias("mean_rmse"),
    )


def partition_and_cache(df: DataFrame, n: int = 10, by: str = "city") -> DataFrame:
    """Rows of one ``by`` value kept together in about ``n`` partitions, written once for repeated reads.

    The rebalance hint splits a value that would make a partition far too large. The rows are in the
    shared folder, so nothing stays in the executors' memory and nothing needs to be released.
    """
    return stage(df.hint("rebalance", n, by), "layout")
