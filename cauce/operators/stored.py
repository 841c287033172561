"""Facts and large dimensions written in buckets of the join key, so that joins move neither.

Both sides lie in the same number of buckets of (key, part). A key with more than
``rows_per_task`` facts, NULL too, is split into parts when the facts are written,
so that no bucket holds it whole; dimension rows are repeated once per part. The
tables pay off where the same facts are joined more than once.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cauce.operators.enrichment import PART, ROWS_PER_TASK, Dimension, Split, split_keys
from cauce.schemas import KEY
from cauce.shared import written


@dataclass(frozen=True)
class StoredFacts:
    """Facts in ``buckets`` buckets of (``key``, part), and how their hot keys are split."""

    table: DataFrame
    split: Split
    buckets: int
    key: str = KEY


def _names(key: str) -> str:
    return ", ".join(f"`{c}`" for c in (key, PART))


def _write(df: DataFrame, name: str, path: str, buckets: int, key: str) -> DataFrame:
    """One file a bucket: rows are dealt by the same hash as the buckets."""
    dealt = df.repartition(buckets, key, PART)
    writer = dealt.write.mode("overwrite").bucketBy(buckets, key, PART).sortBy(key, PART)
    writer.option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def _open(spark: SparkSession, name: str, path: str, buckets: int, key: str) -> DataFrame:
    """The files of ``_write`` as a table of this session's catalog, which may be a new one."""
    if not spark.catalog.tableExists(name):
        schema = spark.read.parquet(path).schema
        columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
        place = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({_names(key)})"
            f" INTO {buckets} BUCKETS LOCATION '{place}'"
        )
    return spark.table(name)


def store_facts(
    facts: DataFrame,
    name: str,
    path: str,
    buckets: int,
    key: str = KEY,
    rows_per_task: int = ROWS_PER_TASK,
) -> StoredFacts:
    """Write ``facts``, whose ``key`` is an INT (``with_key``), as table ``name`` below ``path``.

    One count per key, then one shuffle and write of the facts; ``facts`` is computed twice.
    Allow one bucket per 100 to 200 MB. An existing table of the name is replaced.
    """
    split = Split(written(split_keys(facts, key, rows_per_task), f"{path}/splits"), key)
    table = _write(split.spread(facts), name, f"{path}/rows", buckets, key)
    return StoredFacts(table, split, buckets, key)


def open_facts(spark: SparkSession, name: str, path: str, buckets: int, key: str = KEY) -> StoredFacts:
    """What ``store_facts`` wrote, in this or another session."""
    split = Split(spark.read.parquet(f"{path}/splits"), key)
    return StoredFacts(_open(spark, name, f"{path}/rows", buckets, key), split, buckets, key)


def store_dimension(dim: Dimension, facts: StoredFacts, name: str, path: str) -> Dimension:
    """``dim`` written in the buckets of ``facts``; for ``join_stored`` with these facts alone."""
    table = _write(facts.split.repeat(dim.table), name, path, facts.buckets, facts.key)
    return Dimension(dim.name, table, dim.marker)


def open_dimension(dim_name: str, marker: str, facts: StoredFacts, name: str, path: str) -> Dimension:
    """What ``store_dimension`` wrote, in this or another session."""
    spark = facts.table.sparkSession
    return Dimension(dim_name, _open(spark, name, path, facts.buckets, facts.key), marker)


def join_stored(facts: StoredFacts, dims: Sequence[Dimension]) -> DataFrame:
    """Left join of stored facts with stored dimensions, the key first: no side is shuffled.

    Every fact is kept, also those with a NULL or unmatched key; a key that a
    dimension repeats repeats the fact.
    """
    key, table = facts.key, facts.table
    base = [c for c in table.columns if c not in (key, PART)]
    added = [c for d in dims for c in d.table.columns if c not in (key, PART)]
    for dim in dims:
        # The hint keeps a small estimate from a broadcast, whose size nobody measured.
        table = table.join(dim.table.hint("merge"), [key, PART], "left")
    return table.select(key, *base, *added)
