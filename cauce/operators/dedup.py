"""Duplicate rows: the grouping behind profile, deduplication and audit."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cauce.operators.shape import total
from cauce.schemas import ID


def key_columns(df: DataFrame, id_column: str = ID) -> list[str]:
    return [c for c in df.columns if c != id_column]


def duplicate_groups(df: DataFrame, id_column: str = ID) -> DataFrame:
    """One row per distinct combination of the columns other than the id.

    Adds ``copies`` (rows in the group) and ``ids`` (rows with an id); the id is
    the least of the group, so the surviving row does not depend on the run.
    NULLs compare equal. All buffers are BIGINT, which keeps this a hash
    aggregate: copies fold together before the one shuffle, however many a
    group has.
    """
    return df.groupBy(*key_columns(df, id_column)).agg(
        F.min(id_column).alias(id_column),
        F.count(F.lit(1)).alias("copies"),
        F.count(id_column).alias("ids"),
    )


def deduplicate(df: DataFrame, id_column: str = ID) -> DataFrame:
    """Distinct rows by every column but the id; keeps the least id."""
    return (
        df.groupBy(*key_columns(df, id_column))
        .agg(F.min(id_column).alias(id_column))
        .select(*df.columns)
    )


def duplicate_count(df: DataFrame, id_column: str = ID) -> DataFrame:
    return duplicate_groups(df, id_column).agg(total(F.col("copies") - 1).alias("duplicate_rows"))
