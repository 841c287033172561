"""The three audit reports as ``(line_no, line)`` rows.

Each takes one row of measured numbers and gives the lines of the text report.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.functions import count_line
from cauce.operators.cleaning import profile_measures, step_measures
from cauce.operators.enrichment import Dimension, match_measures
from cauce.operators.reconcile import status
from cauce.operators.shape import to_row
from cauce.schemas import KEY, RATE

# The texts of the ingest report.
INGEST_TITLE = "AUDITORIA DE INGESTA - "
INGEST_SOURCE = "API URL        : "
INGEST_SOURCE_ROWS = "Registros API  : "
INGEST_STORED_ROWS = "Registros BD   : "
INGEST_DIFFERENCE = "Diferencia     : "
INGEST_STATUS = "Estado         : "

# The texts of the cleaning report.
CLEAN_TITLE = "REPORTE DE LIMPIEZA DE DATOS - "
CLEAN_SOURCE = "Fuente           : "
CLEAN_BEFORE = "--- ESTADO ANTES DE LA LIMPIEZA ---"
CLEAN_INITIAL_ROWS = "Registros totales    : "
CLEAN_DUPLICATES = "Duplicados detectados: "
CLEAN_NULLS = "Valores nulos por columna:"
CLEAN_STEPS = "--- OPERACIONES REALIZADAS ---"
CLEAN_STEP_1 = "[1] Eliminacion de duplicados  : %d registros eliminados"
CLEAN_STEP_2 = (
    "[2] Correccion de tipos        : fecha_hecho->timestamp"
    " | cantidad->integer | cod_depto/cod_muni->string trimmed"
)
CLEAN_STEP_3A = "[3a] Nulos en fecha_hecho      : %d registros eliminados"
CLEAN_STEP_3B = (
    "[3b] Imputacion categoricos    : departamento/municipio -> 'DESCONOCIDO'"
    " | cod_depto -> '00' | cod_muni -> '00000'"
)
CLEAN_STEP_3C = "[3c] Imputacion cantidad       : nulos -> 0"
CLEAN_STEP_4 = "[4]  Normalizacion texto       : departamento y municipio en mayusculas sin espacios"
CLEAN_AFTER = "--- ESTADO DESPUES DE LA LIMPIEZA ---"
CLEAN_FINAL_ROWS = "Registros finales    : "
CLEAN_REMOVED_ROWS = "Registros eliminados : "
CLEAN_STATUS = "Estado: LIMPIEZA COMPLETADA EXITOSAMENTE"

# The texts of the enrichment report.
ENRICH_TITLE = "REPORTE DE ENRIQUECIMIENTO DE DATOS - "
ENRICH_SOURCES = "--- FUENTES ADICIONALES INTEGRADAS ---"
ENRICH_MATCHES = "--- REGISTROS COINCIDENTES POR FUENTE (left join sobre cod_depto) ---"
ENRICH_COLUMNS = "--- COLUMNAS NUEVAS INCORPORADAS ---"
ENRICH_STEPS = "--- TRANSFORMACIONES APLICADAS ---"
ENRICH_STEP_1 = "  [1] cod_depto casteado a IntegerType en todas las fuentes"
ENRICH_STEP_2 = "  [2] Left join sucesivo por cod_depto (%d fuentes)"
ENRICH_STEP_3 = (
    "  [3] Columna derivada: hurtos_por_100k = (cantidad / poblacion_2023) * 100000"
)
ENRICH_SUMMARY = "--- RESUMEN ---"
ENRICH_BASE_ROWS = "  Registros dataset base     : "
ENRICH_ROWS = "  Registros dataset enriquec.: "
ENRICH_BASE_COLUMNS = "  Columnas base              : "
ENRICH_ALL_COLUMNS = "  Columnas tras enriquec.    : "
ENRICH_SAMPLE = "  Muestra exportada (csv)    : %d registros"
ENRICH_STATUS = "  Estado: ENRIQUECIMIENTO COMPLETADO EXITOSAMENTE"


def _lines(row: DataFrame, lines: Sequence[str | Column]) -> DataFrame:
    """One ``(line_no, line)`` row per entry; the entries may use columns of ``row``."""
    numbered = [
        F.struct(
            F.lit(number).alias("line_no"),
            (F.lit(line) if isinstance(line, str) else line).alias("line"),
        )
        for number, line in enumerate(lines, 1)
    ]
    return row.select(F.inline(F.array(*numbered)))


def _with_number(label: str, value: Column) -> Column:
    return F.concat(F.lit(label), value.cast("string"))


def title_line(title: str, run_time: Column) -> Column:
    return F.concat(F.lit(title), F.date_format(run_time, "yyyy-MM-dd HH:mm:ss"))


def ingest_report(counts: DataFrame, run_time: Column, source_label: str) -> DataFrame:
    """Report of a row with ``source_rows`` and ``stored_rows``."""
    difference = F.col("source_rows") - F.col("stored_rows")
    return _lines(
        counts,
        [
            "=" * 60,
            title_line(INGEST_TITLE, run_time),
            "=" * 60,
            INGEST_SOURCE + source_label,
            _with_number(INGEST_SOURCE_ROWS, F.col("source_rows")),
            _with_number(INGEST_STORED_ROWS, F.col("stored_rows")),
            _with_number(INGEST_DIFFERENCE, difference),
            "-" * 60,
            F.concat(F.lit(INGEST_STATUS), status(difference)),
            "=" * 60,
        ],
    )


def clean_report(
    audit: DataFrame, landing: DataFrame, run_time: Column, source_label: str
) -> DataFrame:
    """Report of the ``(metric, value)`` rows of ``clean_audit``."""
    row = to_row(audit, [*profile_measures(landing), *step_measures()])
    return _lines(
        row,
        [
            "=" * 60,
            title_line(CLEAN_TITLE, run_time),
            "=" * 60,
            CLEAN_SOURCE + source_label,
            "",
            CLEAN_BEFORE,
            _with_number(CLEAN_INITIAL_ROWS, F.col("initial_rows")),
            _with_number(CLEAN_DUPLICATES, F.col("duplicate_rows")),
            CLEAN_NULLS,
            *[count_line(F.lit(c), F.col(f"nulls_{c}")) for c in landing.columns],
            "",
            CLEAN_STEPS,
            F.format_string(CLEAN_STEP_1, "removed_duplicates"),
            CLEAN_STEP_2,
            F.format_string(CLEAN_STEP_3A, "removed_undated"),
            CLEAN_STEP_3B,
            CLEAN_STEP_3C,
            CLEAN_STEP_4,
            "",
            CLEAN_AFTER,
            _with_number(CLEAN_FINAL_ROWS, F.col("final_rows")),
            _with_number(CLEAN_REMOVED_ROWS, F.col("initial_rows") - F.col("final_rows")),
            "",
            CLEAN_STATUS,
            "=" * 60,
        ],
    )


def _source_line(dim: Dimension) -> Column:
    rows = count_line(F.lit(dim.name), F.col(f"rows_{dim.name}"), width=35)
    return F.concat(rows, F.lit(" registros"))


def _match_line(dim: Dimension) -> Column:
    counts = F.col(f"matched_{dim.name}"), F.col("enriched_rows")
    return F.format_string("  %s (%s): %d / %d", F.lit(dim.name), F.lit(dim.marker), *counts)


def enrich_report(
    audit: DataFrame,
    base_columns: Sequence[str],
    dims: Sequence[Dimension],
    run_time: Column,
    sample_limit: int,
) -> DataFrame:
    """Report of the ``(metric, value)`` rows ``base_rows``, ``enriched_rows``,
    ``matched_<dimension>`` and ``rows_<dimension>``."""
    names = ["base_rows", *match_measures(dims), *[f"rows_{d.name}" for d in dims]]
    new_columns = [*[c for d in dims for c in d.added(KEY)], RATE]
    enriched = F.col("enriched_rows")
    return _lines(
        to_row(audit, names),
        [
            "=" * 65,
            title_line(ENRICH_TITLE, run_time),
            "=" * 65,
            "",
            ENRICH_SOURCES,
            *[_source_line(d) for d in dims],
            "",
            ENRICH_MATCHES,
            *[_match_line(d) for d in dims],
            "",
            ENRICH_COLUMNS,
            *[f"  + {c}" for c in new_columns],
            "",
            ENRICH_STEPS,
            ENRICH_STEP_1,
            ENRICH_STEP_2 % len(dims),
            ENRICH_STEP_3,
            "",
            ENRICH_SUMMARY,
            _with_number(ENRICH_BASE_ROWS, F.col("base_rows")),
            _with_number(ENRICH_ROWS, enriched),
            f"{ENRICH_BASE_COLUMNS}{len(base_columns)}",
            f"{ENRICH_ALL_COLUMNS}{len(base_columns) + len(new_columns)}",
            F.format_string(ENRICH_SAMPLE, F.least(enriched, F.lit(sample_limit))),
            "",
            ENRICH_STATUS,
            "=" * 65,
        ],
    )
