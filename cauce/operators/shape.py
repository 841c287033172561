"""Turning rows of measures into ``(metric, value)`` rows and back."""

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

METRICS_DDL = "metric string, value bigint"


def to_metrics(row: DataFrame) -> DataFrame:
    """One row of BIGINT measures to ``(metric, value)`` rows."""
    return row.unpivot([], row.columns, "metric", "value")


def to_row(metrics: DataFrame, names: Iterable[str]) -> DataFrame:
    """``(metric, value)`` rows to one row with a column per name."""
    return metrics.agg(
        *[F.max(F.when(F.col("metric") == name, F.col("value"))).alias(name) for name in names]
    )


def metrics_frame(spark: SparkSession, values: Mapping[str, int]) -> DataFrame:
    """A few measured numbers as ``(metric, value)`` rows."""
    return spark.createDataFrame([(k, int(v)) for k, v in values.items()], METRICS_DDL)


def total(expression: Column) -> Column:
    """Sum that is 0, not NULL, over no rows."""
    return F.coalesce(F.sum(expression), F.lit(0))
