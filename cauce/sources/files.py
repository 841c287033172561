"""File readers with explicit schemas.

A value that does not fit its type is an error, never a silent NULL. Delimited
and XML texts are read as texts and then cast; JSON values have types already.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from cauce.operators.enrichment import Dimension
from cauce.schemas import (
    CATEGORY,
    CLEAN,
    EMPLOYMENT,
    GDP,
    KEY,
    LANDING,
    POPULATION,
    REGION,
)
from cauce.sinks import current
from cauce.sources.html import html_table
from cauce.sources.records import array_text
from cauce.sources.splits import delimited_records, json_elements, xml_elements
from cauce.sources.typed import sql_name, text_fields, typed


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LANDING).parquet(current(spark, path))


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CLEAN).parquet(current(spark, path))


def _split_delimited(spark: SparkSession, path: str, schema: StructType, sep: str) -> DataFrame:
    """The texts of delimited files, read in parts; the header is checked and dropped."""
    records = delimited_records(spark, path, sep)
    options = {"sep": sep, "escape": '"', "mode": "FAILFAST", "multiLine": "true"}
    names = schema.fieldNames()
    given = F.from_csv("text", text_fields(schema).simpleString(), options)
    # The header is the record whose fields are the column names, in every file.
    is_header = F.lit(True)
    for name in names:
        is_header &= F.trim(F.col("row")[name]).eqNullSafe(F.lit(name))
    rows = records.select("file", given.alias("row")).withColumn("is_header", is_header)
    found = {r.file: r.n for r in rows.groupBy("file").agg(F.count_if("is_header").alias("n")).collect()}
    wrong = sorted(file for file, n in found.items() if n != 1)
    if wrong:
        raise ValueError(f"no header, or more than one, with {', '.join(names)}: {wrong[0]}")
    return rows.filter(~F.col("is_header")).select("row.*")


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: StructType,
    sep: str = ",",
    multi_line: bool = False,
    split: bool = False,
) -> DataFrame:
    """Delimited text with a header row. ``schema`` lists all columns of the file.

    The header must carry those names. ``multi_line`` allows line breaks inside
    quoted fields, at the price of one task per file; with ``split`` as well a file
    is read in parts (``delimited_records``).
    """
    if multi_line and split:
        return typed(_split_delimited(spark, path, schema, sep), schema, markers=True)
    texts = (
        spark.read.schema(text_fields(schema))
        .option("header", True)
        .option("sep", sep)
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return typed(texts, schema, markers=True)


def read_json_array(
    spark: SparkSession, path: str, schema: StructType, split: bool = False
) -> DataFrame:
    """Files that each hold one JSON array of objects, over any number of lines.

    A value that does not fit its type is an error, and so is a file that holds
    anything else. A file is one row of one task; with ``split`` it is read in
    parts, however it is laid out (``json_elements``).
    """
    if split:
        # As an array of one, since a second value behind an object is an error there alone.
        alone = F.concat(F.lit("["), "text", F.lit("]"))
        records = F.from_json(alone, ArrayType(schema), {"mode": "FAILFAST"})
        rows = json_elements(spark, path).select(F.inline(records))
    else:
        records = F.from_json(array_text("value"), ArrayType(schema), {"mode": "FAILFAST"})
        rows = spark.read.text(path, wholetext=True).select(F.inline(records))
    return rows.select(*map(sql_name, schema.fieldNames()))


def read_xml_rows(
    spark: SparkSession, path: str, schema: StructType, row_tag: str, split: bool = False
) -> DataFrame:
    """One row per ``row_tag`` element; each field is a child element and must be there.

    A file is one task; with ``split`` it is read in parts, however it is laid out
    (``xml_elements``).
    """
    texts = text_fields(schema)
    if split:
        row = F.from_xml("text", texts, {"mode": "FAILFAST", "rowTag": row_tag})
        rows = xml_elements(spark, path, row_tag).select(row.alias("row")).select("row.*")
    else:
        reader = spark.read.schema(texts).option("rowTag", row_tag).option("mode", "FAILFAST")
        rows = reader.xml(path)
    return typed(rows, schema, required=True)


def read_html_table(
    spark: SparkSession, path: str, schema: StructType, table_index: int = 0, spans: bool = False
) -> DataFrame:
    """A table of every HTML file under ``path``, rows of all files together; ``spans`` as for ``html_rows``."""
    pages = spark.read.text(path, wholetext=True).withColumnRenamed("value", "html")
    table = html_table(pages, schema, table_index=table_index, required=True, spans=spans)
    return table.select(*map(sql_name, schema.fieldNames()))


def _dimension(name: str, table: DataFrame, added: list[str]) -> Dimension:
    return Dimension(name, table.select(KEY, *added), added[0])


def read_dimensions(
    spark: SparkSession,
    population: str,
    category: str,
    region: str,
    gdp: str,
    employment: str,
    split: bool = False,
    spans: bool = False,
) -> list[Dimension]:
    """The five dimensions, each from a path in its own format.

    ``split`` is for JSON and XML files so large that one task should not read one;
    ``spans`` for an HTML table whose cells span rows or columns.
    """
    return [
        _dimension(
            "poblacion (CSV)", read_delimited(spark, population, POPULATION), ["poblacion_2023"]
        ),
        _dimension(
            "categorias (JSON)",
            read_json_array(spark, category, CATEGORY, split),
            ["categoria_departamento", "num_municipios"],
        ),
        _dimension("regiones (TXT)", read_delimited(spark, region, REGION, sep="|"), ["region"]),
        _dimension(
            "pib (XML)",
            read_xml_rows(spark, gdp, GDP, "departamento", split),
            ["pib_percapita_cop", "pib_total_millones_cop"],
        ),
        _dimension(
            "desempleo (HTML)",
            read_html_table(spark, employment, EMPLOYMENT, spans=spans),
            ["tasa_desempleo_pct", "poblacion_ocupada"],
        ),
    ]
