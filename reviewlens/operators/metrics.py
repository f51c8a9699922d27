"""Quality of predictions, as plain aggregates over (label, prediction) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _squared_error() -> Column:
    gap = F.col("label") - F.col("prediction")
    return gap * gap


def mse(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.avg(_squared_error()).alias("mse"))


def rmse(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.sqrt(F.avg(_squared_error())).alias("rmse"))


def accuracy(rows: DataFrame, *by: str) -> DataFrame:
    """Share of exact hits: the overall precision of a multiclass prediction."""
    hit = (F.col("label") == F.col("prediction")).cast("int")
    return rows.groupBy(*by).agg(F.avg(hit).alias("accuracy"))


def weighted_f1(rows: DataFrame, *by: str) -> DataFrame:
    """F1 per true class, weighted by the class's share of the rows.

    Rows are first counted per (label, prediction); a class's support, predicted count and hits
    then come from two rows per cell of that small table.
    """
    cells = rows.groupBy(*by, "label", "prediction").agg(F.count("*").alias("n"))
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = cells.select(
        *by,
        F.explode(
            F.array(
                F.struct(
                    F.col("label").cast("double").alias("class"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("long").alias("predicted"),
                    hit.cast("long").alias("hits"),
                ),
                F.struct(
                    F.col("prediction").cast("double").alias("class"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("n").alias("predicted"),
                    F.lit(0).cast("long").alias("hits"),
                ),
            )
        ).alias("side"),
    ).select(*by, "side.*")
    classes = sides.groupBy(*by, "class").agg(
        F.sum("support").alias("support"),
        F.sum("predicted").alias("predicted"),
        F.sum("hits").alias("hits"),
    )
    f1 = F.col("hits") * 2.0 / (F.col("support") + F.col("predicted"))
    return classes.groupBy(*by).agg(
        (F.sum(F.col("support") * f1) / F.sum("support")).alias("weighted_f1")
    )
