from datetime import datetime

from pyspark.sql import functions as F

from cauce.operators.enrichment import Dimension
from cauce.schemas import LANDING

RUN_TIME = datetime(2024, 5, 6, 7, 8, 9)


def run_time():
    return F.lit(RUN_TIME.isoformat()).cast("timestamp_ntz")


def rows(df):
    """All rows as a sorted list of tuples, NULLs first."""
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((v is not None, str(type(v)), 0 if v is None else v) for v in r))


def landing(spark, data):
    return spark.createDataFrame(data, LANDING)


def metrics(df):
    return {r["metric"]: r["value"] for r in df.collect()}


def plan(df):
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def dims(spark):
    """Two dimensions; key 3 of the second one comes twice."""
    population = spark.createDataFrame(
        [(1, 1000), (2, 0), (3, 300)], "cod_depto int, poblacion_2023 bigint"
    )
    region = spark.createDataFrame(
        [(1, "Norte"), (3, "Sur"), (3, "Este")], "cod_depto int, region string"
    )
    return [
        Dimension("poblacion", population, "poblacion_2023"),
        Dimension("regiones", region, "region"),
    ]
