import glob

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from cauce import __main__ as command_line
from cauce.operators import cleaning, enrichment
from cauce.operators.reports import clean_report, enrich_report, ingest_report
from cauce.operators.shape import metrics_frame
from cauce.plans import run_all, run_clean, run_enrich, run_ingest
from cauce.schemas import CLEAN, RAW
from cauce.shared import shared_dir, written
from cauce.sources import read_clean
from cauce.sinks import commit_table, current, observed, write_report, write_sample, write_table
from helpers import dims, landing, metrics, rows, run_time

DATE = "2010-01-01T00:00:00.000"

RECORDS = [
    (1, DATE, " 01 ", "a", "1", "x", "5"),
    (2, DATE, " 01 ", "a", "1", "x", "5"),
    (3, "", "02", "b", "2", None, "7"),
    (4, DATE, "03", None, "2", "y", "many"),
    (5, DATE, None, "c", None, "y", None),
]


def raw(spark):
    return spark.createDataFrame(RECORDS, RAW)


def file_text(path):
    (part,) = glob.glob(f"{path}/part-*")
    with open(part, encoding="utf-8") as f:
        return f.read()


def texts(report):
    return [r["line"] for r in report.orderBy("line_no").collect()]


# The texts of the three reports, in the next three tests.


def test_ingest_report_lines(spark):
    counts = spark.createDataFrame([(5, 4)], "source_rows bigint, stored_rows bigint")
    assert texts(ingest_report(counts, run_time(), "http://host.example")) == [
        "=" * 60,
        "AUDITORIA DE INGESTA - 2024-05-06 07:08:09",
        "=" * 60,
        "API URL        : http://host.example",
        "Registros API  : 5",
        "Registros BD   : 4",
        "Diferencia     : 1",
        "-" * 60,
        "Estado         : ALERTA - Diferencia detectada",
        "=" * 60,
    ]


def test_clean_report_lines(spark):
    df = landing(
        spark,
        [
            (1, DATE, None, "A", "1", "B", 1.0),
            (2, DATE, None, "A", "1", "B", 1.0),
            (3, None, "1", "A", "1", "B", 1.0),
        ],
    )
    lines = texts(clean_report(cleaning.clean_audit(df), df, run_time(), "landing"))
    assert lines[1:17] == [
        "REPORTE DE LIMPIEZA DE DATOS - 2024-05-06 07:08:09",
        "=" * 60,
        "Fuente           : landing",
        "",
        "--- ESTADO ANTES DE LA LIMPIEZA ---",
        "Registros totales    : 3",
        "Duplicados detectados: 1",
        "Valores nulos por columna:",
        "  id             : 0",
        "  fecha_hecho    : 1",
        "  cod_depto      : 2",
        "  departamento   : 0",
        "  cod_muni       : 0",
        "  municipio      : 0",
        "  cantidad       : 0",
        "",
    ]
    assert lines[18] == "[1] Eliminacion de duplicados  : 1 registros eliminados"
    assert lines[20] == "[3a] Nulos en fecha_hecho      : 1 registros eliminados"
    assert lines[25:] == [
        "--- ESTADO DESPUES DE LA LIMPIEZA ---",
        "Registros finales    : 1",
        "Registros eliminados : 2",
        "",
        "Estado: LIMPIEZA COMPLETADA EXITOSAMENTE",
        "=" * 60,
    ]


def test_enrich_report_lines(spark):
    measured = {
        "base_rows": 4,
        "enriched_rows": 5,
        "matched_poblacion": 3,
        "matched_regiones": 2,
        "rows_poblacion": 30,
        "rows_regiones": 31,
    }
    report = enrich_report(
        metrics_frame(spark, measured), CLEAN.fieldNames(), dims(spark), run_time(), 1000
    )
    lines = texts(report)
    assert lines[4:7] == [
        "--- FUENTES ADICIONALES INTEGRADAS ---",
        "  poblacion                          : 30 registros",
        "  regiones                           : 31 registros",
    ]
    assert "  poblacion (poblacion_2023): 3 / 5" in lines
    assert "  regiones (region): 2 / 5" in lines
    assert lines[-9:] == [
        "--- RESUMEN ---",
        "  Registros dataset base     : 4",
        "  Registros dataset enriquec.: 5",
        "  Columnas base              : 7",
        "  Columnas tras enriquec.    : 10",
        "  Muestra exportada (csv)    : 5 registros",
        "",
        "  Estado: ENRIQUECIMIENTO COMPLETADO EXITOSAMENTE",
        "=" * 65,
    ]


def test_report_file_keeps_line_order(spark, tmp_path):
    df = spark.range(200).select(
        F.col("id").alias("line_no"), F.concat(F.lit("línea "), "id").alias("line")
    )
    path = str(tmp_path / "report")
    write_report(df.repartition(5), path)
    write_report(df.repartition(5), path)
    assert file_text(path).splitlines() == [f"línea {i}" for i in range(200)]


def test_sample_file_keeps_spaces_and_blanks(spark, tmp_path):
    path = str(tmp_path / "sample")
    write_sample(spark.createDataFrame([(' a "b"', "", None)], "a string, b string, c string"), path)
    assert file_text(path) == 'a,b,c\n" a ""b""","",\n'


def test_overwrite_replaces_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    write_table(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3


def test_a_run_that_ends_half_way_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    assert current(spark, path) == path
    commit_table(spark.range(5), path)
    seen = current(spark, path)
    broken = spark.range(9).withColumn("id", F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")))
    with pytest.raises(Exception, match="lost"):
        commit_table(broken, path)
    assert current(spark, path) == seen and spark.read.parquet(seen).count() == 5
    reader = spark.read.parquet(seen)
    commit_table(spark.range(3), path)
    assert spark.read.parquet(current(spark, path)).count() == 3
    assert reader.count() == 5  # the version before stays for its readers
    commit_table(spark.range(4), path)
    assert spark.read.parquet(current(spark, path)).count() == 4
    assert sorted(f.name[:2] for f in (tmp_path / "t").iterdir() if not f.name.startswith(".")) == ["_c", "v-", "v-"]


def test_stages_with_versions(spark, tmp_path):
    out = str(tmp_path)
    for n in (5, 3):
        records = raw(spark).filter(F.col("id") <= n)
        results = run_all(records, dims(spark), out, run_time(), "src", counted=n, versioned=True)
        assert results[0].table.count() == n == results[0].metrics["server_rows"]
        assert rows(read_clean(spark, f"{out}/clean")) == rows(results[1].table)
    with pytest.raises(ValueError, match="counted 9 records, 5 were read"):
        run_ingest(raw(spark), str(tmp_path / "x"), run_time(), "src", counted=9)


def test_observed_counts_rows_before_later_filters(spark, tmp_path):
    df, observation = observed(spark.range(10), {"n": F.count(F.lit(1)), "s": F.sum("id")})
    write_table(df.filter("id > 7"), str(tmp_path / "t"))
    assert observation.get == {"n": 10, "s": 45}


def test_observed_counts_leave_out_lost_attempts(spark, tmp_path):
    def lose_first_attempt(batches):
        yield from batches
        task = TaskContext.get()
        if task.attemptNumber() == 0 and task.partitionId() % 2 == 0:
            raise RuntimeError("lost after its last row")

    groups = spark.range(4000).groupBy((F.col("id") % 100).alias("k")).agg(F.count("*").alias("n"))
    df, observation = observed(groups, {"rows": F.sum("n"), "groups": F.count("*")})
    write_table(df.mapInArrow(lose_first_attempt, df.schema), str(tmp_path / "t"))
    assert observation.get == {"rows": 4000, "groups": 100}
    assert spark.read.parquet(str(tmp_path / "t")).count() == 100


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark), shared_dir(spark)
    assert first.startswith(root) and first != second
    table = written(spark.range(3), first)
    assert rows(table) == [(0,), (1,), (2,)]


def test_shared_folder_is_required(monkeypatch):
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        conf = Conf({"spark.master": "local[2]"})

    monkeypatch.setattr("cauce.shared._root", None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())
    monkeypatch.setattr("cauce.shared._root", "/somewhere")
    assert shared_dir(Session()).startswith("/somewhere/cauce-")


def test_ingest_job(spark, tmp_path):
    first = raw(spark).withColumn("other", F.lit("o")).limit(2)
    result = run_ingest(raw(spark), str(tmp_path), run_time(), "src", first)
    assert result.metrics == {"source_rows": 5, "unreadable_counts": 1, "stored_rows": 5}
    assert rows(result.table)[3] == (4, DATE, "03", None, "2", "y", None)
    assert "Estado         : OK - Integridad confirmada" in file_text(tmp_path / "landing_report")
    assert file_text(tmp_path / "landing_sample").splitlines()[0].endswith(",cantidad,other")


def test_clean_job_equals_the_separate_audit(spark, tmp_path):
    df = landing(spark, [r[:6] + (float(i),) for i, r in enumerate(RECORDS)] * 2)
    result = run_clean(df, str(tmp_path), run_time(), "src")
    assert rows(result.table) == rows(cleaning.clean(df))
    assert result.table.schema == CLEAN
    assert result.metrics == metrics(cleaning.clean_audit(df))
    assert file_text(tmp_path / "clean_report").rstrip("\n") == "\n".join(texts(result.report))
    assert "2010-01-01 00:00:00" in file_text(tmp_path / "clean_sample")


def test_enrich_job_equals_the_separate_audit(spark, tmp_path):
    clean = cleaning.clean(landing(spark, [r[:6] + (1.0,) for r in RECORDS]))
    result = run_enrich(clean, dims(spark), str(tmp_path), run_time())
    assert rows(result.table) == rows(enrichment.enrich(clean, dims(spark)))
    separate = metrics(enrichment.match_counts(clean, dims(spark)))
    assert {k: result.metrics[k] for k in separate} == separate
    assert result.metrics["rows_regiones"] == 3
    with pytest.raises(ValueError, match="regiones"):
        run_enrich(clean, dims(spark), str(tmp_path / "x"), run_time(), unique_keys=True)


def test_empty_input_through_all_stages(spark, tmp_path):
    none = raw(spark).limit(0)
    results = run_all(none, dims(spark), str(tmp_path), run_time(), "src")
    assert [r.table.count() for r in results] == [0, 0, 0]
    assert results[1].metrics["initial_rows"] == 0
    assert "  regiones (region): 0 / 0" in texts(results[2].report)


def test_command_line_runs_the_stages(spark, tmp_path, monkeypatch):
    import json

    monkeypatch.setattr(type(spark.sparkContext), "stop", lambda self: None)
    page = tmp_path / "pages" / "offset=0"
    page.mkdir(parents=True)
    records = [dict(zip(RAW.fieldNames()[1:], r[1:])) | {"zona": "u"} for r in RECORDS]
    (page / "p.json").write_text(json.dumps(records))
    files = {
        "population": ("p.csv", "cod_depto,departamento,poblacion_2023\n1,A,1000\n"),
        "category": (
            "c.json",
            '[{"cod_depto":1,"departamento":"A","categoria_departamento":"P","num_municipios":3}]',
        ),
        "region": ("r.txt", "cod_depto|departamento|region\n1|A|Sur\n"),
        "gdp": (
            "g.xml",
            "<departamentos><departamento><cod_depto>1</cod_depto><nombre>A</nombre>"
            "<pib_percapita_cop>2</pib_percapita_cop>"
            "<pib_total_millones_cop>3</pib_total_millones_cop></departamento></departamentos>",
        ),
        "employment": (
            "e.html",
            "<table><tr><th>cod_depto</th><th>departamento</th><th>tasa_desempleo_pct</th>"
            "<th>poblacion_ocupada</th></tr>"
            "<tr><td>1</td><td>A</td><td>9.5</td><td>4</td></tr></table>",
        ),
    }
    paths = []
    for option, (name, text) in files.items():
        (tmp_path / name).write_text(text)
        paths += [f"--{option}", str(tmp_path / name)]
    source = ["--path", str(tmp_path / "pages"), "--limit", "5", "--sample-fields", "zona"]
    out, steps = str(tmp_path / "all"), str(tmp_path / "steps")
    command_line.main(["all", "--out", out, *source, *paths])
    command_line.main(["ingest", "--out", steps, *source])
    command_line.main(["clean", "--out", steps])
    command_line.main(["enrich", "--out", steps, "--unique-keys", *paths])
    enriched = spark.read.parquet(f"{out}/enriched")
    assert rows(enriched) == rows(spark.read.parquet(f"{steps}/enriched"))
    assert len(enriched.columns) == 16 and enriched.count() == 3
    assert enriched.filter("id = 1").first()["hurtos_por_100k"] == 500.0
    command_line.main(["clean", "--out", steps, "--blank-as-null", "--zoned"])
    assert "zona" in file_text(f"{out}/landing_sample")
