from pyspark.sql import functions as F

from placemat.operators import features


def test_forest_is_fitted_on_all_rated_rows(spark, monkeypatch):
    fitted = []
    monkeypatch.setattr(features.Pipeline, "fit", lambda self, rows: fitted.append(rows))
    rows = spark.range(1_000_200).select(*[F.col("id").cast("double").alias(c) for c in features.FEATURES])
    features.train_rating_model(rows.withColumn("rating", F.when(F.col("latitude") >= 100, 4.0)))
    assert fitted[0].count() == 1_000_100


def rated(spark, rating):
    """4,000 places whose rating is ``rating`` and a little noise; one feature says nothing."""
    rows = spark.range(4000).select(
        F.col("id").alias("row_key"),
        (F.col("id") % 4 + 1).cast("double").alias("price_level"),
        (F.pmod(F.xxhash64("id"), F.lit(300))).cast("double").alias("user_ratings_total"),
        (F.pmod(F.hash("id"), F.lit(90))).cast("double").alias("latitude"),
        F.lit(1.0).alias("longitude"),
    )
    noise = (F.pmod(F.xxhash64(F.col("row_key") * 7), F.lit(100)) - 50) / 500
    return rows.withColumn("rating", F.when(F.col("row_key") % 97 != 0, rating + noise))


def test_forest_predicts_rows_it_has_not_seen(spark):
    """A rating that follows from price and reviews is learnt; one that follows from nothing is not."""
    good = rated(spark, F.when(F.col("user_ratings_total") > 150, 2.0).otherwise(1.0) + F.col("price_level") / 2)
    found = features.prediction_error(features.holdout_predictions(good)).first()
    assert 600 < found["rows"] < 1000 and found["rmse"] < 0.4 * found["mean_rmse"]
    noise = rated(spark, F.lit(3.0))
    found = features.prediction_error(features.holdout_predictions(noise)).first()
    assert found["rmse"] > 0.9 * found["mean_rmse"]
    # A constant forest would not pass the first bound.
    constant = features.holdout_predictions(good).withColumn("prediction", F.lit(2.75))
    assert features.prediction_error(constant).first()["rmse"] > 0.9 * features.prediction_error(constant).first()["mean_rmse"]
