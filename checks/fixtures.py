"""Inputs of the queries, derived by Spark from the given tables.

The given tables hold no dirt, so NULLs, blanks, padding and duplicates are
planted by rule; FIXTURES.md lists the rules.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cauce.operators.enrichment import Dimension
from cauce.operators.ordering import with_surrogate_id
from cauce.shared import shared_dir
from cauce.sources import read_dimensions

# Chosen run time, so that reports repeat.
RUN_TIME = "2024-02-01 08:30:00"
# Records per page of the page files: bounds what one page file collects.
PAGE_SIZE = 1000

_made: dict[tuple[str, ...], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_time() -> Column:
    return F.lit(RUN_TIME).cast("timestamp_ntz")


def made_once(spark: SparkSession, sf_dir: str, name: str, make) -> str:
    """Folder of an input file set; ``make(path)`` writes it on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _made:
        path = f"{shared_dir(spark)}/{name}"
        make(path)
        _made[key] = path
    return _made[key]


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` in the landing layout, with planted dirt and duplicates."""
    events = table(spark, sf_dir, "events")
    event = F.col("event_id")

    def absent(every: int, value: Column) -> Column:
        return F.when(event % every != 0, value)

    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    department = F.col("user_id") % 30
    copies = F.when(event % 10 == 0, F.array(F.lit(1), F.lit(10000001))).otherwise(
        F.array(F.lit(1))
    )
    return events.select("*", F.explode(copies).alias("shift")).select(
        (event + F.col("shift")).alias("id"),
        absent(11, F.when(event % 13 == 0, "").otherwise(iso)).alias("fecha_hecho"),
        absent(
            19, F.concat(F.lit(" "), F.lpad(department.cast("string"), 2, "0"), F.lit(" "))
        ).alias("cod_depto"),
        absent(7, F.concat(F.lit("  nation_"), department.cast("string"), F.lit(" "))).alias(
            "departamento"
        ),
        absent(23, F.lpad(F.col("user_id").cast("string"), 5, "0")).alias("cod_muni"),
        absent(17, F.concat(F.lit(" "), F.col("event_type"), F.lit("  "))).alias("municipio"),
        absent(5, F.col("value")).alias("cantidad"),
    )


def fields(**types: str) -> StructType:
    return reduce(lambda s, item: s.add(*item), types.items(), StructType())


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        (F.col("n_nationkey") + 1).alias("cod_depto"),
        F.col("n_name").alias("departamento"),
        F.col("n_nationkey").alias("n"),
        F.col("n_regionkey").alias("page"),
        "r_name",
    )


def write_json_arrays(df: DataFrame, chunk: Column, path: str) -> None:
    """Files of one JSON array each; ``chunk`` must bound the rows of an array."""
    record = F.struct(*df.columns)
    arrays = df.groupBy(chunk.alias("chunk")).agg(
        F.to_json(F.sort_array(F.collect_list(record))).alias("value")
    )
    # Line breaks between the objects make each file a multi-line document.
    lines = arrays.select("chunk", F.replace("value", F.lit("},{"), F.lit("},\n{")).alias("value"))
    lines.write.mode("overwrite").partitionBy("chunk").text(path)


def table_markup(header: list[str], body: Column) -> Column:
    names = "".join(f"<th>{name}</th>" for name in header)
    return F.concat(
        F.lit(f'<table border="1">\n<thead><tr>{names}</tr></thead>\n<tbody>'),
        body,
        F.lit("</tbody>\n</table>"),
    )


def row_markup(*cells: Column) -> Column:
    parts = [p for c in cells for p in (F.lit("<td>"), c.cast("string"), F.lit("</td>"))]
    return F.concat(F.lit("\n<tr>"), *parts, F.lit("</tr>"))


def _population(spark, sf_dir):
    n = F.col("n")
    value = F.when(n == 7, 0).otherwise(100000 + n * 3701)
    return _nations(spark, sf_dir).select(
        "cod_depto", "departamento", value.cast("bigint").alias("poblacion_2023")
    )


def _category(spark, sf_dir):
    names = F.array(*[F.lit(x) for x in ("Especial", "Primera", "Segunda", "Tercera")])
    return (
        _nations(spark, sf_dir)
        .filter("n <> 3")
        .select(
            "cod_depto",
            "departamento",
            F.get(names, F.col("n") % 4).alias("categoria_departamento"),
            (F.col("n") + 1).alias("num_municipios"),
        )
    )


def _gdp(spark, sf_dir):
    n = F.col("n").cast("bigint")
    return (
        _nations(spark, sf_dir)
        .filter("n < 20")
        .select(
            "cod_depto",
            F.col("departamento").alias("nombre"),
            (7000000 + n * 1000).alias("pib_percapita_cop"),
            (300000 + n).alias("pib_total_millones_cop"),
        )
    )


def _write_employment_pages(spark, sf_dir, path):
    """One HTML file per region: a line per table row, header and footer lines around them."""
    n = F.col("n")
    rate = F.format_string("%d.%d", F.lit(5) + F.floor(n / 10), n % 10)
    employed = F.format_number(20000 + n, 0)  # with a thousands comma
    nations = _nations(spark, sf_dir)
    rows = nations.select(
        "page",
        F.col("cod_depto").alias("line"),
        row_markup(F.col("cod_depto"), F.col("departamento"), rate, employed).alias("value"),
    )
    head = (
        "<!DOCTYPE html><html><!-- <table> --><body><table id='t'><thead><tr><th>cod_depto</th>"
        "<th>departamento</th><th>tasa_desempleo_pct</th><th>poblacion_ocupada</th></tr></thead><tbody>"
    )
    tail = "</tbody></table><table><tr><td>other</td></tr></table></body></html>"
    pages = nations.select("page").distinct()
    ends = pages.select("page", F.lit(0).alias("line"), F.lit(head).alias("value")).unionByName(
        pages.select("page", F.lit(1000).alias("line"), F.lit(tail).alias("value"))
    )
    lines = rows.unionByName(ends).repartition("page").sortWithinPartitions("page", "line")
    lines.drop("line").write.mode("overwrite").partitionBy("page").text(path)


def dimensions(spark: SparkSession, sf_dir: str) -> list[Dimension]:
    """The five dimensions, written in their formats and read by the library."""

    def make(path: str) -> None:
        _population(spark, sf_dir).write.option("header", True).csv(f"{path}/population")
        write_json_arrays(_category(spark, sf_dir), F.lit(0), f"{path}/category")
        _nations(spark, sf_dir).select(
            "cod_depto", "departamento", F.col("r_name").alias("region")
        ).write.option("header", True).option("sep", "|").csv(f"{path}/region")
        _gdp(spark, sf_dir).write.option("rootTag", "departamentos").option(
            "rowTag", "departamento"
        ).xml(f"{path}/gdp")
        _write_employment_pages(spark, sf_dir, f"{path}/employment")

    path = made_once(spark, sf_dir, "dimensions", make)
    names = ("population", "category", "region", "gdp", "employment")
    return read_dimensions(spark, **{name: f"{path}/{name}" for name in names})


def numbered_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts in event order with positions 1..N, and a field that no table keeps."""
    source = facts(spark, sf_dir).withColumnRenamed("id", "source_id")
    order = [F.col("fecha_hecho").asc_nulls_first(), F.col("source_id").asc()]
    return with_surrogate_id(source, order)


def page_files(spark: SparkSession, sf_dir: str) -> str:
    """Page files of JSON arrays; absent values are absent fields of the records."""

    def make(path: str) -> None:
        record = F.struct(
            "id", "fecha_hecho", "cod_depto", "departamento", "cod_muni", "municipio",
            "cantidad", "source_id",
        )
        offset = F.floor((F.col("id") - 1) / PAGE_SIZE).cast("bigint") * PAGE_SIZE
        # A page collects PAGE_SIZE records at most, whatever the data.
        pages = (
            numbered_records(spark, sf_dir)
            .groupBy(offset.alias("offset"))
            .agg(F.sort_array(F.collect_list(record)).alias("records"))
            .select(
                "offset",
                F.to_json(F.transform("records", lambda r: r.dropFields("id"))).alias("value"),
            )
        )
        pages.write.mode("overwrite").partitionBy("offset").text(path)

    return made_once(spark, sf_dir, "pages", make)
