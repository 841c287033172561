"""Writers of tables, samples and reports."""

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

#: The file that names the version readers see.
POINTER = "_current"


def write_table(df: DataFrame, path: str) -> None:
    """Full refresh of a Parquet table. The old rows go before the new ones are complete."""
    df.write.mode("overwrite").parquet(path)


def _files(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    return hadoop, folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _version(spark: SparkSession, path: str) -> str | None:
    hadoop, folder, files = _files(spark, path)
    pointer = hadoop.Path(folder, POINTER)
    if not files.exists(pointer):
        return None
    stream = files.open(pointer)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def current(spark: SparkSession, path: str) -> str:
    """The folder with the rows of a table: its current version, or ``path`` itself where it has none."""
    version = _version(spark, path)
    return path if version is None else f"{path}/{version}"


def commit_table(df: DataFrame, path: str, kept: int = 1) -> str:
    """Full refresh of a Parquet table that readers see at once and whole; returns its folder.

    The rows go into a folder of their own. A small file that names it then takes the
    place of the old one, so that a run that ends before leaves the old table as it
    was. ``kept`` older versions stay for those who still read them; what runs that
    ended half-way left goes too, so one run at a time may write a table.
    """
    spark = df.sparkSession
    old = _version(spark, path)
    version = f"v-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{version}")
    hadoop, folder, files = _files(spark, path)
    folder = files.makeQualified(folder)
    written = hadoop.Path(folder, f"_next-{version}")
    stream = files.create(written, True)
    try:
        stream.write(version.encode())
    finally:
        stream.close()
    overwrite = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    overwrite[0] = hadoop.Options.Rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(folder.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(written, hadoop.Path(folder, POINTER), overwrite)
    _forget(files, folder, [version, old], kept)
    return f"{path}/{version}"


def _forget(files, folder, named: list[str | None], kept: int) -> None:
    """Delete all versions but the ``named`` ones and the youngest others, ``kept`` old ones in all."""
    found = [s for s in files.listStatus(folder) if s.getPath().getName().startswith(("v-", "_next-"))]
    found.sort(key=lambda s: s.getModificationTime(), reverse=True)
    order = {name: i for i, name in enumerate(n for n in named if n)}
    found.sort(key=lambda s: order.get(s.getPath().getName(), len(order)))
    for status in found[1 + kept :]:
        files.delete(status.getPath(), True)


def observed(df: DataFrame, measures: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` with ``measures`` taken over its rows by whichever job runs it first.

    Put it after the last shuffle: Spark counts each task of the final stage of a
    job once, while tasks of earlier stages may count twice when they run again.
    """
    observation = Observation()
    return df.observe(observation, *[m.alias(n) for n, m in measures.items()]), observation


def write_sample(sample: DataFrame, path: str) -> None:
    """A bounded sample as one CSV file with a header; texts keep their spaces."""
    (
        sample.coalesce(1)
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_report(lines: DataFrame, path: str) -> None:
    """``(line_no, line)`` rows as one UTF-8 text file, in line order."""
    in_order = lines.repartition(1).sortWithinPartitions("line_no")
    in_order.select("line").write.mode("overwrite").text(path)
