"""Folders that all executors see, and columns that do not clash with the caller's."""

import contextlib
import contextvars
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

_own: list[tempfile.TemporaryDirectory] = []
#: Folders made since ``recorded`` began, while it runs, for each thread by itself.
_made: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("made", default=None)


def shared_folder(spark: SparkSession, label: str) -> str:
    """The name of a new folder below ``spark.checkpoint.dir``.

    Only where that setting is missing in a local session, as in tests, a
    temporary folder takes its place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        if not _own:
            _own.append(tempfile.TemporaryDirectory(prefix="llm-", ignore_cleanup_errors=True))
        root = _own[0].name
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


@contextlib.contextmanager
def recorded(folders: list[str]):
    """Adds the folders made inside to ``folders``, for ``remove``."""
    token = _made.set(folders)
    try:
        yield
    finally:
        _made.reset(token)


def remove(spark: SparkSession, folders: list[str]) -> None:
    """Delete folders that nothing reads any more, and the tables in buckets that lay there."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        if "/buckets-" in folder:
            spark.sql(f"DROP TABLE IF EXISTS {_table_name(folder)}")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def newest(df: DataFrame) -> float:
    """When the youngest file that ``df`` reads was written, in seconds; 0 if it reads none."""
    spark = df.sparkSession
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = 0.0
    for file in df.inputFiles():
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        found = max(found, path.getFileSystem(conf).getFileStatus(path).getModificationTime() / 1000)
    return found


def _table_name(folder: str) -> str:
    return "buckets_" + folder.rpartition("-")[2]


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    What is computed from the files stays the same when executors are lost
    later on, also where ``df`` numbers rows by their partition.
    """
    path = shared_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_buckets(df: DataFrame, key: str) -> DataFrame:
    """``df`` written as a table in buckets of ``key``; joins by it leave its rows where they are."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_folder(spark, "buckets")
    name = _table_name(path)
    writer = df.write.bucketBy(n, key).option("compression", "zstd").option("path", path)
    writer.saveAsTable(name)
    return spark.table(name)


def bucketed(df: DataFrame, row: str) -> DataFrame:
    """``df`` numbered in a new column ``row`` and written in buckets of it: texts move once."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = df.withColumn(row, F.monotonically_increasing_id()).repartition(n, row)
    return in_buckets(numbered, row)


#: Parts of the hashes that are counted to find where a sample ends.
PARTS = 1024


def bounded_sample(rows: DataFrame, label: str, max_rows: int, equal: bool = False) -> DataFrame:
    """At most ``max_rows`` of ``rows``, drawn for each value of ``label`` by itself.

    All rows are taken if they fit. Else a value has a share of ``max_rows`` by its count, or with
    ``equal`` the same as every other value. Rows are drawn by a hash of all their
    columns, so that copies of a text under different ids are drawn one by one, and
    partitions play no part. Rows that are equal in every column are drawn together, and
    left out where they would fill a twentieth of their value's share.

    ``rows`` is computed three times; the values of ``label`` are few. The driver gets a
    histogram of the hashes of about twice the sample, ``PARTS`` counts for each value.
    """
    counts = {r[0]: r.n for r in rows.groupBy(label).agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    if total <= max_rows:
        return rows
    quota = {v: max_rows // len(counts) if equal else max_rows * n // total for v, n in counts.items()}
    name, size = free_name(rows, "_drawn"), 1 << 62
    hashed = F.shiftrightunsigned(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), 2)
    drawn = rows.withColumn(name, hashed)

    def by_value(numbers: dict):
        found = F.lit(0).cast("long")
        for value, number in numbers.items():
            found = F.when(F.col(f"`{label}`").eqNullSafe(F.lit(value)), F.lit(number).cast("long")).otherwise(found)
        return found

    wide = {v: min(size, int((2 * quota[v] + 1000) / n * size)) for v, n in counts.items()}
    few = drawn.filter(F.col(name) < by_value(wide)).groupBy(label, name).agg(F.count("*").alias("n"))
    often = (F.col("n") > 1) & (F.col("n") > by_value(quota) / 20)
    width = by_value({v: limit // PARTS + 1 for v, limit in wide.items()})
    found = few.groupBy(label, (F.col(name) - F.pmod(F.col(name), width)).alias("start")).agg(
        F.sum(F.when(often, 0).otherwise(F.col("n"))).alias("n"),
        F.collect_list(F.when(often, F.col(name))).alias("often"),  # at most 20 for a share of rows
    ).collect()
    limits, upto = dict(wide), dict.fromkeys(quota, 0)
    for r in sorted(found, key=lambda r: r.start):
        upto[r[0]] += r.n
        if upto[r[0]] > quota[r[0]]:
            limits[r[0]] = min(limits[r[0]], r.start)
    often = sorted({x for r in found for x in r.often})
    taken = drawn.filter(F.col(name) < by_value(limits))
    if often:
        taken = taken.filter(~F.col(name).isin(often))
    return taken.drop(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a Spark one; call it on the driver."""
    return to_arrow_schema(StructType.fromDDL(ddl))


def record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[] for _ in schema]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
