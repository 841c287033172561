"""The folder that all executors see, for tables written between steps."""

import uuid

from pyspark.sql import DataFrame, SparkSession

_root: str | None = None


def use_shared_dir(path: str | None) -> None:
    """The folder for sessions without ``spark.checkpoint.dir``."""
    global _root
    _root = path


def shared_dir(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, else under ``use_shared_dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None) or _root
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return f"{root.rstrip('/')}/cauce-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and return the table read back.

    The files hold one committed attempt of every task, so whatever is computed
    from them stays the same when executors are lost later on.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
