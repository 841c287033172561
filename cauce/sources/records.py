"""API records to landing rows."""

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from cauce.functions import to_code
from cauce.operators.shape import total
from cauce.schemas import COUNT, ID, LANDING, RAW
from cauce.sources.typed import sql_name


def project_fields(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the fields of ``schema``: absent ones become NULL, others go."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def records_from_json(df: DataFrame, json: str, schema: StructType = RAW) -> DataFrame:
    """JSON object texts to the fields of ``schema``; other columns are kept."""
    fields = StructType([f for f in schema.fields if f.name not in df.columns])
    kept = [c for c in df.columns if c != json]
    record = F.from_json(F.col(json), fields, {"mode": "FAILFAST"})
    return df.select(*kept, record.alias("_record")).select(*kept, "_record.*")


def array_text(name: str) -> Column:
    """The JSON text itself, or an error where it is no array."""
    wrong = F.raise_error(F.concat(F.lit("no JSON array: "), F.left(name, F.lit(80))))
    text = F.regexp_replace(name, r"^\ufeff", "")
    return F.when(text.rlike(r"^\s*\["), text).otherwise(wrong.cast("string"))


def page_records(pages: DataFrame, start: str, body: str, schema: StructType) -> DataFrame:
    """The records of pages: ``body`` is a JSON array, ``start`` counts the records before it.

    ``schema`` names the fields, all STRING, and may hold ``id`` BIGINT, the position
    of the record from 1. A value that is no text comes as its JSON text.
    """
    for field in schema.fields:
        wanted = LongType() if field.name == ID else StringType()
        if field.dataType != wanted:
            raise ValueError(f"{field.name} must be {wanted.simpleString()}")
    fields = StructType([f for f in schema.fields if f.name != ID])
    records = F.from_json(array_text(body), ArrayType(fields), {"mode": "FAILFAST"})
    position = (F.col(start).cast("bigint") + F.col("pos") + 1).alias(ID)
    numbered = pages.select(start, F.posexplode(records).alias("pos", "record"))
    found = numbered.select(position, "record.*")
    return found.select(*[F.col(sql_name(c)) for c in schema.fieldNames()])


def read_page_files(
    spark: SparkSession, path: str, schema: StructType = RAW, first: int | None = None
) -> DataFrame:
    """Records of stored pages: ``<path>/offset=<first record>/`` holds one JSON array file.

    The same records and ids as the paged source gives, read by Spark alone: a page
    is one row, so pages run in parallel, on any file system that Spark knows.
    ``first`` reads that many records and only the pages that hold them. A page that
    is no array, and a second file in a folder, are errors.
    """
    pages = spark.read.text(path, wholetext=True)
    folders = Counter(name.rpartition("/")[0] for name in pages.inputFiles())
    shared = sorted(folder for folder, n in folders.items() if n > 1 and "offset=" in folder)
    if shared:
        raise ValueError(f"more than one file in {shared[0]}")
    if "offset" not in pages.columns:  # an empty folder, or files in the wrong place
        misplaced = F.raise_error(F.lit("pages must be in folders offset=<first record>"))
        pages = pages.withColumn("offset", misplaced.cast("bigint"))
    if first is not None:
        pages = pages.filter(F.col("offset") < first)
    found = page_records(pages, "offset", "value", schema)
    return found if first is None else found.filter(F.col(ID) <= first)


# Spark's own cast also takes 1d, 2f, 0x1p3 and Infinity.
_DECIMAL = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"


def _as_number(number: Column) -> Column:
    text = number.cast("string")
    value = F.when(text.rlike(_DECIMAL), text.try_cast("double"))
    return F.when(F.abs(value) < float("inf"), value)


def land(raw: DataFrame) -> DataFrame:
    """Raw records to the landing schema.

    Codes and names become text as they are. A count that is no finite decimal
    number becomes NULL; ``unreadable_counts`` tells how many.
    """
    fixed = project_fields(raw, RAW)
    typed = {
        f.name: F.col(f.name).cast("string")
        for f in RAW.fields
        if f.name not in ("id", COUNT)
    }
    return fixed.withColumns(
        {"id": F.col("id").cast("bigint"), **typed, COUNT: _as_number(F.col(COUNT))}
    ).select(*LANDING.fieldNames())


def unreadable_counts() -> Column:
    """Aggregate over raw records: counts that are present but no number."""
    text = to_code(F.col(COUNT))
    return total((text.isNotNull() & _as_number(text).isNull()).cast("bigint"))
