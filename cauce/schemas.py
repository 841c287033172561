"""Column contracts of the tables that pass between the stages."""

from pyspark.sql.types import StructType

ID = "id"
KEY = "cod_depto"
EVENT_TIME = "fecha_hecho"
COUNT = "cantidad"
RATE = "hurtos_por_100k"

# What the paged source emits: the ingest position and every field as text.
RAW = (
    StructType()
    .add("id", "long")
    .add("fecha_hecho", "string")
    .add("cod_depto", "string")
    .add("departamento", "string")
    .add("cod_muni", "string")
    .add("municipio", "string")
    .add("cantidad", "string")
)

LANDING = (
    StructType()
    .add("id", "long")
    .add("fecha_hecho", "string")
    .add("cod_depto", "string")
    .add("departamento", "string")
    .add("cod_muni", "string")
    .add("municipio", "string")
    .add("cantidad", "double")
)

CLEAN = (
    StructType()
    .add("id", "long")
    .add("fecha_hecho", "timestamp_ntz")
    .add("cod_depto", "string")
    .add("departamento", "string")
    .add("cod_muni", "string")
    .add("municipio", "string")
    .add("cantidad", "long")
)

# Full layouts of the five dimension files, in file order.
POPULATION = (
    StructType()
    .add("cod_depto", "integer")
    .add("departamento", "string")
    .add("poblacion_2023", "long")
)
CATEGORY = (
    StructType()
    .add("cod_depto", "integer")
    .add("departamento", "string")
    .add("categoria_departamento", "string")
    .add("num_municipios", "integer")
)
REGION = (
    StructType()
    .add("cod_depto", "integer")
    .add("departamento", "string")
    .add("region", "string")
)
GDP = (
    StructType()
    .add("cod_depto", "integer")
    .add("nombre", "string")
    .add("pib_percapita_cop", "long")
    .add("pib_total_millones_cop", "long")
)
EMPLOYMENT = (
    StructType()
    .add("cod_depto", "integer")
    .add("departamento", "string")
    .add("tasa_desempleo_pct", "double")
    .add("poblacion_ocupada", "long")
)

# What an absent value becomes in each column.
FILL_VALUES = {
    "departamento": "DESCONOCIDO",
    "municipio": "DESCONOCIDO",
    "cod_depto": "00",
    "cod_muni": "00000",
    "cantidad": 0,
}

SAMPLE_ROWS = 1000
