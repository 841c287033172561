"""Comparison of what a source holds with what was stored."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The two outcomes of the comparison.
STATUS_OK = "OK - Integridad confirmada"
STATUS_DIFFERS = "ALERTA - Diferencia detectada"


def status(difference: Column) -> Column:
    return F.when(difference == 0, STATUS_OK).otherwise(STATUS_DIFFERS)


def reconcile(source: DataFrame, stored: DataFrame) -> DataFrame:
    """One row: rows in the source, rows stored, difference, status."""
    tagged = source.select(F.lit(True).alias("is_source")).unionByName(
        stored.select(F.lit(False).alias("is_source"))
    )
    counts = tagged.agg(
        F.count_if(F.col("is_source")).alias("source_rows"),
        F.count_if(~F.col("is_source")).alias("stored_rows"),
    )
    difference = F.col("source_rows") - F.col("stored_rows")
    return counts.withColumn("difference", difference).withColumn(
        "status", status(F.col("difference"))
    )
