"""Writers for predictions."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

STAMP = "%Y_%m_%d_%H_%M_%S"


def write_submission(predictions: DataFrame, root: str, model: str, at: datetime | None = None) -> str:
    """``id,trip_duration`` as gzip CSV in a time-stamped directory; returns the path."""
    stamp = (at or datetime.now(timezone.utc)).strftime(STAMP)
    path = f"{root.rstrip('/')}/{model}_submission_{stamp}"
    (
        predictions.select("id", "trip_duration")
        .write.option("header", True)
        .option("compression", "gzip")
        .csv(path)
    )
    return path


def write_out_of_fold(train_predictions: DataFrame, test_predictions: DataFrame, root: str, model: str) -> str:
    """Train and test predictions side by side for ensembling."""
    path = f"{root.rstrip('/')}/{model}_out_of_fold"
    both = train_predictions.select("id", "trip_duration", F.lit("train").alias("split")).unionByName(
        test_predictions.select("id", "trip_duration", F.lit("test").alias("split"))
    )
    both.write.mode("overwrite").partitionBy("split").parquet(path)
    return path


def write_fold_predictions(fold_predictions: DataFrame, root: str, model: str) -> str:
    """Test predictions of every fold's model, one directory per fold."""
    path = f"{root.rstrip('/')}/{model}_fold_predictions"
    (
        fold_predictions.select("id", "fold", "trip_duration")
        .write.mode("overwrite")
        .partitionBy("fold")
        .parquet(path)
    )
    return path
