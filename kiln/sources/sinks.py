"""Writers: split outputs, stored features, models and metric logs (all under a shared folder)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_splits(df: DataFrame, path: str, split_col: str = "split", compression: str = "gzip") -> None:
    """One folder per split (``split=train/`` ...), each holding only its own rows."""
    df.write.mode("overwrite").partitionBy(split_col).option("compression", compression).parquet(path)


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_features(df: DataFrame, path: str) -> DataFrame:
    """Compute features once, store them, and return the stored table for later training jobs."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_metric_log(history: DataFrame, path: str) -> DataFrame:
    """Per-epoch metric log as headed CSV (one small file: the history has one row per epoch)."""
    history.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return history.sparkSession.read.option("header", True).schema(history.schema).csv(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(cls, path: str):
    return cls.load(path)
