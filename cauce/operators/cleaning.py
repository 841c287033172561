"""Profile and clean the landing table.

Everything starts from ``duplicate_groups``: the clean table is a filter and a
projection of the groups, and each audit figure is a sum over them. One shuffle
therefore serves the table and its whole audit.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.functions import is_missing, parse_event_time, to_code, to_count, to_name
from cauce.operators.dedup import deduplicate, duplicate_groups, key_columns
from cauce.operators.shape import to_metrics, total
from cauce.schemas import COUNT, EVENT_TIME, FILL_VALUES, ID

PARSED = "_parsed"


def drop_undated(df: DataFrame, zoned: bool = False) -> DataFrame:
    """Keep rows whose event time parses.

    The NULL test on the raw column is implied by the other one; it is written
    out because only it can be pushed into the file scan.
    """
    raw = F.col(EVENT_TIME)
    return df.filter(raw.isNotNull() & parse_event_time(raw, zoned).isNotNull())


def normalised_columns(event_time: Column, blank_as_null: bool = False) -> dict[str, Column]:
    """Typed, imputed and normalised replacement of each landing column."""

    def filled(name: str, text: Column) -> Column:
        if blank_as_null:
            text = F.nullif(F.trim(text), F.lit(""))
        return F.coalesce(text, F.lit(FILL_VALUES[name]))

    return {
        EVENT_TIME: event_time,
        "cod_depto": filled("cod_depto", to_code(F.col("cod_depto"))),
        "departamento": to_name(filled("departamento", F.col("departamento"))),
        "cod_muni": filled("cod_muni", to_code(F.col("cod_muni"))),
        "municipio": to_name(filled("municipio", F.col("municipio"))),
        COUNT: F.coalesce(to_count(F.col(COUNT)), F.lit(FILL_VALUES[COUNT]).cast("bigint")),
    }


def normalise(df: DataFrame, zoned: bool = False, blank_as_null: bool = False) -> DataFrame:
    """Replace the landing columns in place, in one projection."""
    event_time = parse_event_time(F.col(EVENT_TIME), zoned)
    return df.withColumns(normalised_columns(event_time, blank_as_null))


def clean(landing: DataFrame, zoned: bool = False, blank_as_null: bool = False) -> DataFrame:
    """Deduplicate on the raw values, drop undated rows, impute, normalise.

    The date test reads only a grouping column, so it runs before the shuffle.
    """
    return normalise(drop_undated(deduplicate(landing), zoned), zoned, blank_as_null)


def audited_groups(landing: DataFrame, zoned: bool = False) -> DataFrame:
    """The groups of ``landing`` with the event time parsed, once for table and audit."""
    parsed = parse_event_time(F.col(EVENT_TIME), zoned)
    return duplicate_groups(landing).withColumn(PARSED, parsed)


def clean_groups(
    groups: DataFrame, columns: Sequence[str], blank_as_null: bool = False
) -> DataFrame:
    """The clean table from ``audited_groups``; equals ``clean`` of the landing table."""
    dated = groups.filter(F.col(PARSED).isNotNull())
    return dated.withColumns(normalised_columns(F.col(PARSED), blank_as_null)).select(*columns)


def profile_measures(landing: DataFrame) -> dict[str, Column]:
    """Sums over the groups of ``landing``: rows, duplicates, nulls per column."""
    types = dict(landing.dtypes)
    copies = F.col("copies")
    nulls = {f"nulls_{ID}": total(copies - F.col("ids"))}
    for name in key_columns(landing):
        missing = is_missing(F.col(name), types[name])
        nulls[f"nulls_{name}"] = total(F.when(missing, copies).otherwise(0))
    return {
        "initial_rows": total(copies),
        "duplicate_rows": total(copies - 1),
        **{f"nulls_{c}": nulls[f"nulls_{c}"] for c in landing.columns},
    }


def step_measures() -> dict[str, Column]:
    """Sums over ``audited_groups``: rows that each cleaning step removes or changes."""
    given = F.col(EVENT_TIME).isNotNull()
    undated = F.col(PARSED).isNull()
    lost_count = F.col(COUNT).isNotNull() & to_count(F.col(COUNT)).isNull()
    return {
        "removed_duplicates": total(F.col("copies") - 1),
        "removed_undated": F.count_if(undated),
        "undated_null": F.count_if(~given),
        "undated_unparsed": F.count_if(undated & given),
        "counts_out_of_range": F.count_if(lost_count & ~undated),
        "final_rows": F.count_if(~undated),
    }


def _measured(groups: DataFrame, measures: dict[str, Column]) -> DataFrame:
    return to_metrics(groups.agg(*[value.alias(name) for name, value in measures.items()]))


def profile(landing: DataFrame) -> DataFrame:
    """``(metric, value)``: rows, duplicates and nulls per column, in one pass."""
    return _measured(duplicate_groups(landing), profile_measures(landing))


def step_counts(landing: DataFrame, zoned: bool = False) -> DataFrame:
    """``(metric, value)``: rows removed per cleaning step, in one pass."""
    return _measured(audited_groups(landing, zoned), step_measures())


def clean_audit(landing: DataFrame, zoned: bool = False) -> DataFrame:
    """Profile and step counts together, in one pass."""
    measures = {**profile_measures(landing), **step_measures()}
    return _measured(audited_groups(landing, zoned), measures)


def clean_summary(landing: DataFrame, zoned: bool = False) -> DataFrame:
    """``(metric, value)``: rows before, rows after, rows removed in total."""
    initial, final = total(F.col("copies")), step_measures()["final_rows"]
    return _measured(
        audited_groups(landing, zoned),
        {"initial_rows": initial, "final_rows": final, "removed_rows": initial - final},
    )


def null_profile(df: DataFrame) -> DataFrame:
    """``(column, nulls)`` for every column of any table, in one scan, no shuffle of rows."""
    counts = [
        F.count_if(is_missing(F.col(name), data_type)).alias(name) for name, data_type in df.dtypes
    ]
    return df.agg(*counts).unpivot([], df.columns, "column", "nulls")
