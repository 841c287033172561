"""The three stages as jobs that write tables, samples and reports.

Each stage reads its input once and writes its table once. The audit figures are
observed by that same write, in its last stage, so they cost no second pass; the
sample comes from the written table.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.operators.cleaning import (
    audited_groups,
    clean_groups,
    profile_measures,
    step_measures,
)
from cauce.operators.enrichment import (
    BROADCAST_BYTES,
    ROWS_PER_TASK,
    Dimension,
    enrich,
    match_measures,
    measure,
)
from cauce.operators.ordering import sample, sample_as_text
from cauce.operators.reports import clean_report, enrich_report, ingest_report
from cauce.operators.shape import metrics_frame, to_row, total
from cauce.schemas import KEY, SAMPLE_ROWS
from cauce.sinks import commit_table, current, observed, write_report, write_sample, write_table
from cauce.sources import land, read_landing, unreadable_counts


@dataclass(frozen=True)
class StageResult:
    """The written table, its exported sample, the measured numbers and the report."""

    table: DataFrame
    sample: DataFrame
    metrics: dict[str, int]
    report: DataFrame


def _write(df: DataFrame, path: str, versioned: bool) -> None:
    """Refresh a table, as a new version or in place."""
    if versioned:
        commit_table(df, path)
    else:
        write_table(df, path)


def run_ingest(
    raw: DataFrame,
    out: str,
    run_time: Column,
    source_label: str,
    first_records: DataFrame | None = None,
    sample_rows: int = SAMPLE_ROWS,
    counted: int | None = None,
    versioned: bool = False,
) -> StageResult:
    """Land raw records under ``<out>/landing`` and compare both row counts.

    With ``versioned`` the old table stays readable until the new one is complete
    (``commit_table``); so for the other stages.

    ``counted`` is what the server said it holds (``count_records``); it goes into the
    metrics as ``server_rows``, and fewer records than that are an error.

    The raw sample comes from ``first_records`` with all its fields; a paged
    source reads those with its option ``first``. Without it ``raw`` is scanned
    again for the sample.
    """
    spark = raw.sparkSession
    measures = {"source_rows": total(F.lit(1)), "unreadable_counts": unreadable_counts()}
    passed, observation = observed(raw, measures)
    _write(land(passed), f"{out}/landing", versioned)
    landing = read_landing(spark, f"{out}/landing")
    metrics = {**observation.get, "stored_rows": landing.count()}
    if counted is not None:
        metrics["server_rows"] = counted
        if metrics["source_rows"] < counted:
            raise ValueError(f"the server counted {counted} records, {metrics['source_rows']} were read")
    row = to_row(metrics_frame(spark, metrics), metrics)
    report = ingest_report(row, run_time, source_label)
    first = sample(raw if first_records is None else first_records, sample_rows)
    write_sample(first, f"{out}/landing_sample")
    write_report(report, f"{out}/landing_report")
    return StageResult(landing, first, metrics, report)


def run_clean(
    landing: DataFrame,
    out: str,
    run_time: Column,
    source_label: str,
    zoned: bool = False,
    blank_as_null: bool = False,
    sample_rows: int = SAMPLE_ROWS,
    versioned: bool = False,
) -> StageResult:
    """Clean ``landing`` into ``<out>/clean``: one scan, one shuffle, one write."""
    spark = landing.sparkSession
    measures = {**profile_measures(landing), **step_measures()}
    groups, observation = observed(audited_groups(landing, zoned), measures)
    cleaned = clean_groups(groups, landing.columns, blank_as_null)
    _write(cleaned, f"{out}/clean", versioned)
    metrics = observation.get
    table = spark.read.schema(cleaned.schema).parquet(current(spark, f"{out}/clean"))
    report = clean_report(metrics_frame(spark, metrics), landing, run_time, source_label)
    first = sample_as_text(table, sample_rows)
    write_sample(first, f"{out}/clean_sample")
    write_report(report, f"{out}/clean_report")
    return StageResult(table, first, metrics, report)


def run_enrich(
    clean: DataFrame,
    dims: Sequence[Dimension],
    out: str,
    run_time: Column,
    base_rows: int | None = None,
    unique_keys: bool = False,
    sample_rows: int = SAMPLE_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
    versioned: bool = False,
    key_bytes: int = 0,
) -> StageResult:
    """Enrich the written table ``clean`` into ``<out>/enriched``.

    ``base_rows`` is its row count where that is known already.
    """
    spark = clean.sparkSession
    sizes = measure(dims, KEY)
    table = enrich(
        clean, dims, sizes, unique_keys, broadcast_bytes, rows_per_task, key_bytes=key_bytes
    )
    joined, matches = observed(table, match_measures(dims))
    path = f"{out}/enriched"
    _write(joined, path, versioned)
    metrics = {
        "base_rows": clean.count() if base_rows is None else base_rows,
        **matches.get,
        **{f"rows_{name}": size.rows for name, size in sizes.items()},
        **{f"keys_{name}": size.keys for name, size in sizes.items()},
    }
    table = spark.read.schema(joined.schema).parquet(current(spark, path))
    report = enrich_report(
        metrics_frame(spark, metrics), clean.columns, dims, run_time, sample_rows
    )
    first = sample_as_text(table, sample_rows)
    write_sample(first, f"{out}/enriched_sample")
    write_report(report, f"{out}/enriched_report")
    return StageResult(table, first, metrics, report)


def run_all(
    raw: DataFrame,
    dims: Sequence[Dimension],
    out: str,
    run_time: Column,
    source_label: str,
    first_records: DataFrame | None = None,
    zoned: bool = False,
    blank_as_null: bool = False,
    unique_keys: bool = False,
    counted: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
    versioned: bool = False,
    key_bytes: int = 0,
) -> tuple[StageResult, StageResult, StageResult]:
    """Ingest, clean and enrich, each from the table that the stage before wrote."""
    ingested = run_ingest(
        raw, out, run_time, source_label, first_records, counted=counted, versioned=versioned
    )
    landing = f"{out}/landing"
    cleaned = run_clean(
        ingested.table, out, run_time, landing, zoned, blank_as_null, versioned=versioned
    )
    base_rows = cleaned.metrics["final_rows"]
    options = {
        "broadcast_bytes": broadcast_bytes,
        "rows_per_task": rows_per_task,
        "versioned": versioned,
        "key_bytes": key_bytes,
    }
    enriched = run_enrich(cleaned.table, dims, out, run_time, base_rows, unique_keys, **options)
    return ingested, cleaned, enriched
