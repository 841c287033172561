"""For each query the same result as DuckDB SQL over the given tables."""

from checks.fixtures import RUN_TIME

FACTS = """
dirty AS (
  SELECT event_id,
    CASE WHEN event_id % 11 = 0 THEN NULL
         WHEN event_id % 13 = 0 THEN ''
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') END AS fecha_hecho,
    CASE WHEN event_id % 19 <> 0
         THEN ' ' || lpad(CAST(user_id % 30 AS VARCHAR), 2, '0') || ' ' END AS cod_depto,
    CASE WHEN event_id % 7 <> 0 THEN '  nation_' || (user_id % 30) || ' ' END AS departamento,
    CASE WHEN event_id % 23 <> 0 THEN lpad(CAST(user_id AS VARCHAR), 5, '0') END AS cod_muni,
    CASE WHEN event_id % 17 <> 0 THEN ' ' || event_type || '  ' END AS municipio,
    CASE WHEN event_id % 5 <> 0 THEN value END AS cantidad
  FROM events),
facts AS (
  SELECT event_id + 1 AS id, * EXCLUDE (event_id) FROM dirty
  UNION ALL
  SELECT event_id + 10000001 AS id, * EXCLUDE (event_id) FROM dirty WHERE event_id % 10 = 0)
"""

GROUPS = """
grouped AS (
  SELECT min(id) AS id, fecha_hecho, cod_depto, departamento, cod_muni, municipio, cantidad,
    count(*) AS copies, TRY_CAST(fecha_hecho AS TIMESTAMP) AS parsed
  FROM facts
  GROUP BY fecha_hecho, cod_depto, departamento, cod_muni, municipio, cantidad)
"""


def normalised(parsed: str) -> str:
    return f"""
  id,
  {parsed} AS fecha_hecho,
  coalesce(trim(cod_depto, ' '), '00') AS cod_depto,
  upper(trim(coalesce(departamento, 'DESCONOCIDO'), ' ')) AS departamento,
  coalesce(trim(cod_muni, ' '), '00000') AS cod_muni,
  upper(trim(coalesce(municipio, 'DESCONOCIDO'), ' ')) AS municipio,
  coalesce(TRY_CAST(trunc(cantidad) AS BIGINT), 0) AS cantidad
"""


CLEAN = f"""
cleaned AS (SELECT {normalised("parsed")} FROM grouped WHERE parsed IS NOT NULL)
"""

DIMS = """
dim_poblacion AS (
  SELECT n_nationkey + 1 AS cod_depto,
    CAST(CASE WHEN n_nationkey = 7 THEN 0 ELSE 100000 + n_nationkey * 3701 END AS BIGINT)
      AS poblacion_2023
  FROM nation),
dim_categoria AS (
  SELECT n_nationkey + 1 AS cod_depto,
    CASE n_nationkey % 4 WHEN 0 THEN 'Especial' WHEN 1 THEN 'Primera'
      WHEN 2 THEN 'Segunda' ELSE 'Tercera' END AS categoria_departamento,
    n_nationkey + 1 AS num_municipios
  FROM nation WHERE n_nationkey <> 3),
dim_region AS (
  SELECT n_nationkey + 1 AS cod_depto, r_name AS region
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
dim_pib AS (
  SELECT n_nationkey + 1 AS cod_depto,
    CAST(7000000 + n_nationkey * 1000 AS BIGINT) AS pib_percapita_cop,
    CAST(300000 + n_nationkey AS BIGINT) AS pib_total_millones_cop
  FROM nation WHERE n_nationkey < 20),
dim_desempleo AS (
  SELECT n_nationkey + 1 AS cod_depto,
    CAST((5 + n_nationkey // 10) || '.' || (n_nationkey % 10) AS DOUBLE) AS tasa_desempleo_pct,
    CAST(20000 + n_nationkey AS BIGINT) AS poblacion_ocupada
  FROM nation)
"""


def joined(base: str, name: str) -> str:
    """CTE ``name``: ``base`` with an INT key, left joined with the five dimensions."""
    return f"""
{name} AS (
  SELECT k.* EXCLUDE (cod_depto), k.cod_depto,
    p.poblacion_2023, c.categoria_departamento, c.num_municipios, r.region,
    g.pib_percapita_cop, g.pib_total_millones_cop, d.tasa_desempleo_pct, d.poblacion_ocupada
  FROM (SELECT * REPLACE (TRY_CAST(trim(cod_depto, ' ') AS INTEGER) AS cod_depto) FROM {base}) k
  LEFT JOIN dim_poblacion p ON k.cod_depto = p.cod_depto
  LEFT JOIN dim_categoria c ON k.cod_depto = c.cod_depto
  LEFT JOIN dim_region r ON k.cod_depto = r.cod_depto
  LEFT JOIN dim_pib g ON k.cod_depto = g.cod_depto
  LEFT JOIN dim_desempleo d ON k.cod_depto = d.cod_depto)
"""


RATE = "round(cantidad / nullif(poblacion_2023, 0) * 100000, 4) AS hurtos_por_100k"

ENRICHED = f"""
{joined("cleaned", "matched")},
enriched AS (SELECT *, {RATE} FROM matched)
"""

# Records as the pages hold them: numbered from 1 in event order.
RECORDS = """
records AS (
  SELECT row_number() OVER (ORDER BY fecha_hecho NULLS FIRST, id) AS position, * FROM facts)
"""

STEPS = """
steps AS (
  SELECT CAST(sum(copies) AS BIGINT) AS initial_rows,
    CAST(sum(copies - 1) AS BIGINT) AS duplicates,
    count(*) FILTER (parsed IS NULL) AS undated,
    count(*) FILTER (fecha_hecho IS NULL) AS undated_null,
    count(*) FILTER (parsed IS NULL AND fecha_hecho IS NOT NULL) AS undated_unparsed,
    count(*) FILTER (parsed IS NOT NULL) AS final_rows
  FROM grouped)
"""

COLUMNS = ["id", "fecha_hecho", "cod_depto", "departamento", "cod_muni", "municipio", "cantidad"]
ADDED = [
    "poblacion_2023",
    "categoria_departamento",
    "num_municipios",
    "region",
    "pib_percapita_cop",
    "pib_total_millones_cop",
    "tasa_desempleo_pct",
    "poblacion_ocupada",
]
SOURCES = {
    "poblacion (CSV)": ("dim_poblacion", "poblacion_2023"),
    "categorias (JSON)": ("dim_categoria", "categoria_departamento"),
    "regiones (TXT)": ("dim_region", "region"),
    "pib (XML)": ("dim_pib", "pib_percapita_cop"),
    "desempleo (HTML)": ("dim_desempleo", "tasa_desempleo_pct"),
}


def with_(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + select.strip()


def long_form(rows: dict[str, str], source: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{metric}' AS metric, CAST({value} AS BIGINT) AS value FROM {source}"
        for metric, value in rows.items()
    )


def lines(entries: list[str]) -> str:
    """SQL for report lines; an entry is an SQL expression over the CTE ``n``."""
    return "\nUNION ALL ".join(
        f"SELECT {number} AS line_no, {entry} AS line FROM n"
        for number, entry in enumerate(entries, 1)
    )


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# The texts of the three reports, in the next three functions.


def _ingest_lines() -> str:
    return lines(
        [
            text("=" * 60),
            text(f"AUDITORIA DE INGESTA - {RUN_TIME}"),
            text("=" * 60),
            text("API URL        : events"),
            "'Registros API  : ' || rows",
            "'Registros BD   : ' || rows",
            "'Diferencia     : ' || 0",
            text("-" * 60),
            text("Estado         : OK - Integridad confirmada"),
            text("=" * 60),
        ]
    )


def _clean_lines() -> str:
    nulls = [f"printf('  %-15s: %d', '{c}', {_null_count(c)})" for c in COLUMNS]
    return lines(
        [
            text("=" * 60),
            text(f"REPORTE DE LIMPIEZA DE DATOS - {RUN_TIME}"),
            text("=" * 60),
            text("Fuente           : events"),
            "''",
            text("--- ESTADO ANTES DE LA LIMPIEZA ---"),
            "'Registros totales    : ' || initial_rows",
            "'Duplicados detectados: ' || duplicates",
            text("Valores nulos por columna:"),
            *nulls,
            "''",
            text("--- OPERACIONES REALIZADAS ---"),
            "'[1] Eliminacion de duplicados  : ' || duplicates || ' registros eliminados'",
            text(
                "[2] Correccion de tipos        : fecha_hecho->timestamp"
                " | cantidad->integer | cod_depto/cod_muni->string trimmed"
            ),
            "'[3a] Nulos en fecha_hecho      : ' || undated || ' registros eliminados'",
            text(
                "[3b] Imputacion categoricos    : departamento/municipio -> 'DESCONOCIDO'"
                " | cod_depto -> '00' | cod_muni -> '00000'"
            ),
            text("[3c] Imputacion cantidad       : nulos -> 0"),
            text(
                "[4]  Normalizacion texto       : "
                "departamento y municipio en mayusculas sin espacios"
            ),
            "''",
            text("--- ESTADO DESPUES DE LA LIMPIEZA ---"),
            "'Registros finales    : ' || final_rows",
            "'Registros eliminados : ' || (initial_rows - final_rows)",
            "''",
            text("Estado: LIMPIEZA COMPLETADA EXITOSAMENTE"),
            text("=" * 60),
        ]
    )


def _null_count(column: str) -> str:
    return f"(SELECT count(*) FROM facts WHERE {column} IS NULL)"


def _enrich_lines() -> str:
    base = "(SELECT count(*) FROM cleaned)"
    every = "(SELECT count(*) FROM matched)"
    return lines(
        [
            text("=" * 65),
            text(f"REPORTE DE ENRIQUECIMIENTO DE DATOS - {RUN_TIME}"),
            text("=" * 65),
            "''",
            text("--- FUENTES ADICIONALES INTEGRADAS ---"),
            *[
                f"printf('  %-35s: %d registros', '{name}', (SELECT count(*) FROM {dim}))"
                for name, (dim, _) in SOURCES.items()
            ],
            "''",
            text("--- REGISTROS COINCIDENTES POR FUENTE (left join sobre cod_depto) ---"),
            *[
                f"'  {name} ({marker}): ' || (SELECT count({marker}) FROM matched) || ' / ' || {every}"
                for name, (_, marker) in SOURCES.items()
            ],
            "''",
            text("--- COLUMNAS NUEVAS INCORPORADAS ---"),
            *[text(f"  + {c}") for c in [*ADDED, "hurtos_por_100k"]],
            "''",
            text("--- TRANSFORMACIONES APLICADAS ---"),
            text("  [1] cod_depto casteado a IntegerType en todas las fuentes"),
            text("  [2] Left join sucesivo por cod_depto (5 fuentes)"),
            text(
                "  [3] Columna derivada: hurtos_por_100k = (cantidad / poblacion_2023) * 100000"
            ),
            "''",
            text("--- RESUMEN ---"),
            f"'  Registros dataset base     : ' || {base}",
            f"'  Registros dataset enriquec.: ' || {every}",
            text("  Columnas base              : 7"),
            text("  Columnas tras enriquec.    : 16"),
            f"'  Muestra exportada (csv)    : ' || least({every}, 1000) || ' registros'",
            "''",
            text("  Estado: ENRIQUECIMIENTO COMPLETADO EXITOSAMENTE"),
            text("=" * 65),
        ]
    )


AUDIT = {
    "initial_rows": "initial_rows",
    "duplicate_rows": "duplicates",
    **{f"nulls_{c}": _null_count(c) for c in COLUMNS},
}
STEP_METRICS = {
    "removed_duplicates": "duplicates",
    "removed_undated": "undated",
    "undated_null": "undated_null",
    "undated_unparsed": "undated_unparsed",
    "counts_out_of_range": "0",
    "final_rows": "final_rows",
}
MATCHES = {
    "base_rows": "(SELECT count(*) FROM cleaned)",
    "enriched_rows": "(SELECT count(*) FROM matched)",
    **{f"matched_{n}": f"(SELECT count({m}) FROM matched)" for n, (_, m) in SOURCES.items()},
}
SOURCE_METRICS = {
    **{f"rows_{n}": f"(SELECT count(*) FROM {d})" for n, (d, _) in SOURCES.items()},
    **{f"keys_{n}": f"(SELECT count(DISTINCT cod_depto) FROM {d})" for n, (d, _) in SOURCES.items()},
}
ONE = "n AS (SELECT 1)"
RECORD_COUNT = "n AS (SELECT count(*) AS rows FROM facts)"
TEXT_RECORD = (
    "SELECT position AS id, fecha_hecho, cod_depto, departamento, cod_muni, municipio,"
    " CAST(cantidad AS VARCHAR) AS cantidad"
)
LANDED = (
    "SELECT position AS id, fecha_hecho, cod_depto, departamento, cod_muni, municipio, cantidad"
    " FROM records"
)
# The records cleaned after ingest, where the ids are the positions.
LANDED_FACTS = f"landed AS ({LANDED})"

FANOUT = """
SELECT source, count(*) AS base_rows, CAST(sum(greatest(copies, 1)) AS BIGINT) AS joined_rows
FROM (
  SELECT s.source, k.id, (SELECT count(*) FROM every e
    WHERE e.source = s.source AND e.cod_depto = k.cod_depto) AS copies
  FROM (SELECT id, TRY_CAST(trim(cod_depto, ' ') AS INTEGER) AS cod_depto FROM facts) k
  CROSS JOIN (SELECT DISTINCT source FROM every) s)
GROUP BY source
"""


def _every_source(extra: str) -> str:
    parts = [f"SELECT '{n}' AS source, cod_depto FROM {d}" for n, (d, _) in SOURCES.items()]
    parts.append(f"SELECT '{extra}', c_nationkey + 1 FROM customer")
    return "every AS (" + " UNION ALL ".join(parts) + ")"


def _source_sizes() -> str:
    widths = {
        "poblacion (CSV)": "16",
        "categorias (JSON)": "24 + strlen(categoria_departamento)",
        "regiones (TXT)": "16 + strlen(region)",
        "pib (XML)": "24",
        "desempleo (HTML)": "24",
    }
    parts = [
        f"SELECT '{n}' AS source, count(*) AS rows, count(DISTINCT cod_depto) AS keys,"
        f" CAST(sum({widths[n]}) AS BIGINT) AS bytes FROM {d}"
        for n, (d, _) in SOURCES.items()
    ]
    parts.append(
        "SELECT 'clientes', count(*), count(DISTINCT c_nationkey),"
        " CAST(sum(16 + strlen(c_name)) AS BIGINT) FROM customer"
    )
    return " UNION ALL ".join(parts)


def _schema_delta() -> str:
    every = [KEY_FIRST, *[c for c in COLUMNS if c != KEY_FIRST], *ADDED, "hurtos_por_100k"]
    return " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\","
        f" '{'base' if c in COLUMNS else 'added'}' AS role, count({c}) AS non_null FROM enriched"
        for i, c in enumerate(every, 1)
    )


KEY_FIRST = "cod_depto"


def oracle() -> dict[str, str]:
    clean = (FACTS, GROUPS, CLEAN)
    star = (*clean, DIMS, ENRICHED)
    facts_joined = (FACTS, DIMS, joined("facts", "matched"))
    landed = (
        FACTS,
        RECORDS,
        LANDED_FACTS,
        GROUPS.replace("FROM facts", "FROM landed"),
        CLEAN,
        DIMS,
        ENRICHED,
    )
    sql = {
        "src_rest_pages": with_(FACTS, RECORDS, select=f"{TEXT_RECORD} FROM records"),
        "src_landing_table": with_(FACTS, select="SELECT * FROM facts"),
        "src_clean_table": with_(*clean, select="SELECT * FROM cleaned"),
        "src_csv": """
            SELECT c_custkey AS cod_depto, '"' || c_name || '", ' || c_mktsegment AS departamento,
              CASE WHEN c_custkey % 9 <> 0 THEN c_acctbal END AS saldo FROM customer""",
        "src_json_array": """
            SELECT p_partkey AS cod_depto, CASE WHEN p_partkey % 9 <> 0 THEN p_brand END AS categoria,
              p_size AS num_municipios FROM part""",
        "src_json_pretty_split": """
            SELECT c_custkey AS cod_depto, c_name || ' {"[,]"}' || chr(10) || '\\ ' || c_mktsegment AS nombre,
              CAST(floor(c_acctbal * 100) AS BIGINT) AS total, CAST(c_nationkey AS BIGINT) AS a, '}{' AS b
            FROM customer""",
        "src_csv_lines_split": """
            SELECT c_custkey AS cod_depto,
              '"' || c_name || '",' || chr(10) || chr(10) || c_mktsegment AS nombre, c_acctbal AS saldo
            FROM customer""",
        "src_pipe_text": """
            SELECT o_orderkey AS cod_depto, o_orderpriority || ', ' || o_orderstatus AS region,
              o_totalprice AS total FROM orders""",
        "src_xml": """
            SELECT c_custkey AS cod_depto, c_name || ' <&> ' || c_mktsegment AS nombre,
              CAST(floor(c_acctbal * 100) AS BIGINT) AS pib_total FROM customer""",
        "src_html_table": """
            SELECT page_id, CAST(i + 1 AS INTEGER) AS row_no,
              CAST(page_id * 10 + i AS INTEGER) AS cod_depto,
              'Nariño & ' || i AS nombre, page_id * 1000 + i AS poblacion_ocupada
            FROM (SELECT page_id, unnest(generate_series(0, page_id % 5)) AS i FROM pages)""",
        "src_html_spans": """
            SELECT page_id, CAST(i + 1 AS INTEGER) AS row_no, page_id AS grupo, CAST(i AS BIGINT) AS n, page_id + i AS total
            FROM (SELECT page_id, unnest(generate_series(0, page_id % 4)) AS i FROM pages)
            UNION ALL SELECT page_id, CAST(page_id % 4 + 2 AS INTEGER), -1, page_id, page_id FROM pages""",
        "src_local_rows": """
            SELECT event_type, count(*) AS events,
              CASE event_type WHEN 'click' THEN 'Clic' WHEN 'view' THEN 'Vista'
                WHEN 'purchase' THEN 'Compra' WHEN 'signup' THEN 'Registro' END AS label
            FROM events GROUP BY event_type""",
        "sink_landing_overwrite": with_(FACTS, select="SELECT * FROM facts"),
        "surrogate_id": with_(
            FACTS,
            RECORDS,
            select="SELECT position AS id, id AS source_id, * EXCLUDE (position, id) FROM records",
        ),
        "sample_raw": with_(
            FACTS,
            RECORDS,
            select=f"{TEXT_RECORD}, CAST(id AS VARCHAR) AS source_id FROM records"
            " WHERE position <= 1000",
        ),
        "sample_clean": with_(
            *clean,
            select="SELECT * REPLACE (strftime(fecha_hecho, '%Y-%m-%d %H:%M:%S') AS fecha_hecho)"
            " FROM cleaned ORDER BY id LIMIT 1000",
        ),
        "sample_enriched": with_(
            *star,
            select="SELECT * REPLACE (strftime(fecha_hecho, '%Y-%m-%d %H:%M:%S') AS fecha_hecho)"
            " FROM enriched ORDER BY id LIMIT 1000",
        ),
        "sink_report_text": with_(
            FACTS,
            RECORD_COUNT,
            f"report AS ({_ingest_lines()})",
            select="SELECT string_agg(line || chr(10), '' ORDER BY line_no) AS content FROM report",
        ),
        "sink_clean_table": with_(*clean, select="SELECT * FROM cleaned"),
        "proj_fixed_fields": with_(
            FACTS, select="SELECT * REPLACE (CAST(NULL AS VARCHAR) AS cod_muni) FROM facts"
        ),
        "proj_dim_columns": """
            SELECT c_custkey AS cod_depto, c_acctbal, CAST(NULL AS BIGINT) AS poblacion_2023
            FROM customer""",
        "proj_all_but_id": with_(FACTS, select="SELECT * EXCLUDE (id) FROM facts"),
        "proj_replace_columns": with_(
            FACTS, select=f"SELECT {normalised('TRY_CAST(fecha_hecho AS TIMESTAMP)')} FROM facts"
        ),
        "proj_derived_rate": with_(
            *star,
            select="SELECT cod_depto, id, fecha_hecho, departamento, cod_muni, municipio, cantidad,"
            " poblacion_2023, hurtos_por_100k FROM enriched",
        ),
        "filter_valid_date": with_(
            FACTS, select="SELECT * FROM facts WHERE TRY_CAST(fecha_hecho AS TIMESTAMP) IS NOT NULL"
        ),
        "filter_not_null": with_(
            FACTS, select=long_form({f"with_{c}": f"count({c})" for c in COLUMNS}, "facts")
        ),
        "join_left_dim": with_(
            *facts_joined,
            select="SELECT cod_depto, id, fecha_hecho, departamento, cod_muni, municipio, cantidad,"
            " poblacion_2023 FROM matched",
        ),
        "join_left_chain5": with_(*facts_joined, select="SELECT * FROM matched"),
        "join_left_pruned": with_(*facts_joined, select="SELECT id, cod_depto, region FROM matched"),
        "join_key_coercion": with_(
            FACTS,
            select="SELECT id, TRY_CAST(trim(cod_depto, ' ') AS INTEGER) AS cod_depto FROM facts",
        ),
        "join_fanout_check": with_(FACTS, DIMS, _every_source("repeated"), select=FANOUT),
        "agg_row_count": with_(FACTS, select="SELECT count(*) AS rows FROM facts"),
        "agg_null_profile": with_(
            FACTS,
            ONE,
            select=" UNION ALL ".join(
                f"SELECT '{c}' AS \"column\", {_null_count(c)} AS nulls FROM n" for c in COLUMNS
            ),
        ),
        "agg_duplicate_count": with_(
            FACTS,
            select="SELECT (SELECT count(*) FROM facts) - (SELECT count(*) FROM"
            " (SELECT DISTINCT * EXCLUDE (id) FROM facts)) AS duplicate_rows",
        ),
        "agg_dedup_subset": with_(
            FACTS, GROUPS, select="SELECT * EXCLUDE (copies, parsed) FROM grouped"
        ),
        "agg_step_removed": with_(FACTS, GROUPS, STEPS, select=long_form(STEP_METRICS, "steps")),
        "agg_reconcile": with_(
            FACTS,
            select="SELECT count(*) AS source_rows, count(departamento) AS stored_rows,"
            " count(*) - count(departamento) AS difference,"
            " CASE WHEN count(*) = count(departamento) THEN 'OK - Integridad confirmada'"
            " ELSE 'ALERTA - Diferencia detectada' END AS status FROM facts",
        ),
        "agg_unreadable_counts": with_(
            FACTS,
            select="SELECT count(municipio) FILTER (id % 3 = 0) AS unreadable_counts FROM facts",
        ),
        "agg_match_counts": with_(*star, ONE, select=long_form(MATCHES, "n")),
        "agg_source_counts": with_(DIMS, select=_source_sizes()),
        "agg_clean_summary": with_(
            FACTS,
            GROUPS,
            STEPS,
            select=long_form(
                {
                    "initial_rows": "initial_rows",
                    "final_rows": "final_rows",
                    "removed_rows": "initial_rows - final_rows",
                },
                "steps",
            ),
        ),
        "agg_schema_delta": with_(*star, select=_schema_delta()),
        "sort_by_event_date": with_(FACTS, select="SELECT * FROM facts ORDER BY fecha_hecho, id"),
        "limit_sample": with_(FACTS, select="SELECT * FROM facts ORDER BY id LIMIT 1000"),
        "limit_offset_page": with_(
            FACTS, select="SELECT * FROM facts ORDER BY id LIMIT 500 OFFSET 1500"
        ),
        "limit_page_by_id": with_(
            FACTS,
            RECORDS,
            select="SELECT position AS id, id AS source_id, * EXCLUDE (position, id) FROM records"
            " WHERE position > 1500 AND position <= 2000",
        ),
        "limit_indexed_pages": with_(
            FACTS,
            RECORDS,
            select="SELECT records.* EXCLUDE (position), CAST(i AS INTEGER) AS page"
            " FROM records, range(10) AS tenth(i), (SELECT count(*) AS n FROM facts)"
            " WHERE position > n * i // 10 AND position <= n * i // 10 + 100",
        ),
        "union_pages": with_(
            FACTS,
            select="SELECT * FROM facts UNION ALL"
            " SELECT * REPLACE (CAST(NULL AS VARCHAR) AS municipio) FROM facts",
        ),
        "fn_parse_timestamp": with_(
            FACTS,
            select="SELECT id, TRY_CAST(CASE WHEN id % 29 = 0 THEN fecha_hecho || 'x'"
            " ELSE fecha_hecho END AS TIMESTAMP) AS parsed FROM facts",
        ),
        "fn_count_to_int": with_(
            FACTS,
            select="SELECT id, TRY_CAST(trunc(cantidad - 50) AS BIGINT) AS signed_count,"
            " TRY_CAST(trunc(cantidad * 1e18) AS BIGINT) AS large_count FROM facts",
        ),
        "fn_code_to_string": """
            SELECT l_orderkey, CAST(l_partkey AS VARCHAR) AS part_code,
              CAST(l_linenumber AS VARCHAR) AS line_code, l_returnflag AS flag_code
            FROM lineitem""",
        "fn_trim": with_(
            FACTS,
            select="SELECT id, trim(departamento, ' ') AS name,"
            " trim(chr(9) || ' ' || municipio || chr(9), ' ') AS tabbed FROM facts",
        ),
        "fn_upper_trim": with_(
            FACTS,
            select="SELECT id, upper(trim(departamento, ' ')) AS departamento,"
            " upper(trim(' ñandú ' || municipio, ' ')) AS municipio FROM facts",
        ),
        "fn_key_to_int": with_(
            FACTS,
            select="SELECT id, TRY_CAST(trim(cod_depto, ' ') AS INTEGER) AS key,"
            " TRY_CAST(trim(cod_muni, ' ') AS INTEGER) AS town_key,"
            " TRY_CAST(trim(municipio, ' ') AS INTEGER) AS no_key FROM facts",
        ),
        "fn_fill_text": with_(
            FACTS,
            select="SELECT * REPLACE (coalesce(departamento, 'DESCONOCIDO') AS departamento,"
            " coalesce(municipio, 'DESCONOCIDO') AS municipio,"
            " coalesce(cod_depto, '00') AS cod_depto, coalesce(cod_muni, '00000') AS cod_muni)"
            " FROM facts",
        ),
        "fn_fill_number": with_(
            FACTS, select="SELECT * REPLACE (coalesce(cantidad, 0) AS cantidad) FROM facts"
        ),
        "fn_safe_ratio": """
            SELECT l_orderkey, l_linenumber, l_extendedprice / nullif(l_partkey % 7, 0) AS ratio
            FROM lineitem""",
        "fn_rate_per_100k": """
            SELECT l_orderkey, l_linenumber,
              round(l_quantity / nullif(l_partkey * l_suppkey, 0) * 100000, 4) AS rate
            FROM lineitem""",
        "fn_round4": """
            SELECT l_orderkey, l_linenumber, round(l_extendedprice / 7, 4) AS rounded
            FROM lineitem""",
        "fn_timestamp_text": """
            SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS text FROM events""",
        "fn_report_line": """
            SELECT event_id, printf('  %-15s: %d', event_type, user_id) AS line FROM events""",
        "fn_run_timestamp": """
            SELECT event_id,
              'REPORTE DE LIMPIEZA DE DATOS - ' || strftime(ts, '%Y-%m-%d %H:%M:%S') AS line
            FROM events""",
        "report_ingest": with_(FACTS, RECORD_COUNT, select=_ingest_lines()),
        "report_clean": with_(
            FACTS, GROUPS, STEPS, "n AS (SELECT * FROM steps)", select=_clean_lines()
        ),
        "report_enrich": with_(*star, ONE, select=_enrich_lines()),
        "job_profile": with_(FACTS, GROUPS, STEPS, select=long_form(AUDIT, "steps")),
        "job_clean": with_(*clean, select="SELECT * FROM cleaned"),
        "job_enrich": with_(*star, select="SELECT * FROM enriched"),
        "job_ingest": with_(FACTS, RECORDS, select=LANDED),
        "job_clean_written": with_(
            FACTS, GROUPS, STEPS, select=long_form({**AUDIT, **STEP_METRICS}, "steps")
        ),
        "job_ingest_written": with_(
            FACTS,
            select=long_form(
                {"source_rows": "count(*)", "unreadable_counts": "count(*) * 0", "stored_rows": "count(*)"},
                "facts",
            ),
        ),
        "job_enrich_written": with_(
            *star, ONE, select=long_form({**MATCHES, **SOURCE_METRICS}, "n")
        ),
        "job_end_to_end": with_(*landed, select="SELECT * FROM enriched"),
    }
    # Other ways to the same results.
    for name, same in {
        "src_page_files": "src_rest_pages",
        "src_rest_keys": "src_rest_pages",
        "sink_versions": "sink_landing_overwrite",
        "src_json_array_split": "src_json_array",
        "src_xml_split": "src_xml",
        "limit_deep_page": "limit_offset_page",
        "surrogate_id_indexed": "surrogate_id",
        "join_left_shuffled": "join_left_chain5",
        "join_left_reduced": "join_left_chain5",
        "join_left_stored": "join_left_chain5",
    }.items():
        sql[name] = sql[same]
    return {name: statement.strip() for name, statement in sql.items()}
