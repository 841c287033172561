from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cauce.operators import enrichment, stored
from cauce.operators.enrichment import Dimension, DimensionSize
from cauce.schemas import CLEAN
from helpers import dims, metrics, plan, rows

DAY = datetime(2010, 1, 1)


def clean_table(spark):
    data = [
        (1, DAY, "01", "A", "1", "X", 5),
        (2, DAY, "02", "A", "1", "X", 5),
        (3, DAY, "03", "A", "1", "X", 5),
        (4, DAY, "00", "A", "1", "X", 5),
        (5, DAY, "no", "A", "1", "X", 5),
    ]
    return spark.createDataFrame(data, CLEAN)


def test_left_joins_keep_every_fact_and_fan_out(spark):
    enriched = enrichment.enrich(clean_table(spark), dims(spark))
    assert enriched.columns == [
        "cod_depto", "id", "fecha_hecho", "departamento", "cod_muni", "municipio", "cantidad",
        "poblacion_2023", "region", "hurtos_por_100k",
    ]
    assert sorted(
        (r["id"], r["cod_depto"], r["poblacion_2023"], r["region"], r["hurtos_por_100k"])
        for r in enriched.filter("id <> 5").collect()
    ) == [
        (1, 1, 1000, "Norte", 500.0),
        (2, 2, 0, None, None),
        (3, 3, 300, "Este", 1666.6667),
        (3, 3, 300, "Sur", 1666.6667),
        (4, 0, None, None, None),
    ]
    assert enriched.filter("id = 5 and cod_depto is null").count() == 1


def test_sizes_and_unique_keys(spark):
    empty = Dimension("vacia", spark.createDataFrame([], "cod_depto int, v string"), "v")
    sizes = enrichment.measure([*dims(spark), empty])
    assert sizes["poblacion"] == DimensionSize(rows=3, keys=3, bytes=3 * 16)
    assert sizes["regiones"] == DimensionSize(rows=3, keys=2, bytes=3 * 16 + 12)
    assert sizes["vacia"] == DimensionSize(rows=0, keys=0, bytes=0)
    with pytest.raises(ValueError, match="regiones"):
        enrichment.enrich(clean_table(spark), dims(spark), unique_keys=True)


def test_nested_columns_count_for_the_size(spark):
    table = spark.range(2).select(
        F.col("id").cast("int").alias("cod_depto"),
        F.array_repeat(F.lit("abcd"), 1000).alias("v"),
        F.lit(1.5).alias("x"),
    )
    assert enrichment.measure([Dimension("d", table, "v")])["d"].bytes > 2 * 4000


@pytest.mark.parametrize("rows_per_task", [1, 7, 1000])
def test_shuffle_joins_give_the_same_rows(spark, rows_per_task):
    """One key holds a third of all facts, NULL another third."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 1).when(n % 3 == 1, F.lit(None)).otherwise(n % 5)
    facts = spark.range(300).select(key.cast("int").alias("cod_depto"), "id")
    both = dims(spark)
    by_broadcast = enrichment.join_dimensions(facts, both)
    by_shuffle = enrichment.join_dimensions(
        facts, both, broadcast_bytes=0, rows_per_task=rows_per_task
    )
    text = plan(by_shuffle)
    assert text.count("SortMergeJoin") == 2
    assert text.count("Exchange hashpartitioning") == 3  # the facts once, each dimension once
    assert by_shuffle.columns == by_broadcast.columns
    assert rows(by_shuffle) == rows(by_broadcast)


def test_hot_key_is_spread(spark):
    """A key that holds all facts does not end in one task."""
    facts = spark.range(1000).select(F.lit(1).alias("cod_depto"), "id")
    joined = enrichment.join_dimensions(
        facts, dims(spark)[:1], broadcast_bytes=0, rows_per_task=50
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        per_task = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(per_task) > 1 and max(per_task) < 600


def third_hot(spark, n=300):
    """One key holds a third of all facts, NULL another third; key 4 matches nothing."""
    i = F.col("id")
    key = F.when(i % 3 == 0, 1).when(i % 3 == 1, F.lit(None)).otherwise(i % 5)
    return spark.range(n).select(key.cast("int").alias("cod_depto"), "id")


@pytest.mark.parametrize("rows_per_task", [1, 7, 1000])
def test_reduced_joins_shuffle_matched_facts_only(spark, tmp_path, rows_per_task):
    third_hot(spark).write.parquet(str(tmp_path / "facts"))
    facts, both = spark.read.parquet(str(tmp_path / "facts")), dims(spark)
    options = {"broadcast_bytes": 0, "rows_per_task": rows_per_task}
    reduced = enrichment.join_dimensions(facts, both, key_bytes=1000, **options)
    expected = enrichment.join_dimensions(facts, both)
    assert reduced.columns == expected.columns and rows(reduced) == rows(expected)
    before, after = plan(reduced).split("LeftAnti")[0], plan(reduced).split("LeftAnti")[1]
    assert before.count("SortMergeJoin") == 2 and "LeftSemi" in before
    # Below the anti join there is the scan of the facts, and the keys that are broadcast.
    facts_side = after.split("BroadcastExchange")[0]
    assert "Scan parquet" in facts_side and "Exchange hashpartitioning" not in facts_side
    whole = enrichment.join_dimensions(facts, both, key_bytes=10, **options)
    assert "LeftAnti" not in plan(whole)  # the keys are more than that


def test_reduced_joins_of_nothing(spark):
    both = dims(spark)
    none = [Dimension(d.name, d.table.limit(0), d.marker) for d in both]
    options = {"broadcast_bytes": -1, "key_bytes": 1000}
    facts = third_hot(spark, 30)
    assert rows(enrichment.join_dimensions(facts, none, **options)) == rows(enrichment.join_dimensions(facts, none))
    assert enrichment.join_dimensions(facts.limit(0), both, **options).count() == 0


@pytest.mark.parametrize("rows_per_task", [20, 1000])
def test_stored_tables_join_without_a_shuffle(spark, tmp_path, rows_per_task):
    facts, both = third_hot(spark), dims(spark)
    expected = enrichment.join_dimensions(facts, both)
    names = [f"kept_{rows_per_task}_{d.name}" for d in both]
    path = str(tmp_path / "facts")
    kept = stored.store_facts(facts, f"kept_{rows_per_task}", path, 4, rows_per_task=rows_per_task)
    large = [stored.store_dimension(d, kept, n, str(tmp_path / n)) for d, n in zip(both, names)]
    joined = stored.join_stored(kept, large)
    assert plan(joined).count("SortMergeJoin") == 2 and "Exchange" not in plan(joined)
    assert joined.columns == expected.columns and rows(joined) == rows(expected)
    per_bucket = [r[1] for r in kept.table.groupBy(F.input_file_name()).count().collect()]
    assert rows_per_task > 20 or max(per_bucket) < 160
    for name in [f"kept_{rows_per_task}", *names]:  # as a new session finds them
        spark.sql(f"DROP TABLE {name}")
    again = stored.open_facts(spark, f"kept_{rows_per_task}", path, 4)
    opened = [
        stored.open_dimension(d.name, d.marker, again, n, str(tmp_path / n)) for d, n in zip(both, names)
    ]
    reopened = stored.join_stored(again, opened)
    assert "Exchange" not in plan(reopened) and rows(reopened) == rows(expected)


def test_stored_empty_tables(spark, tmp_path):
    kept = stored.store_facts(third_hot(spark, 0), "kept_none", str(tmp_path / "facts"), 2)
    large = [stored.store_dimension(d, kept, f"none_{d.name}", str(tmp_path / d.name)) for d in dims(spark)]
    assert stored.join_stored(kept, large).count() == 0


def test_large_dimension_with_small_one(spark):
    """Only the dimension above the bound is shuffled; the column order stays."""
    facts = spark.range(20).select((F.col("id") % 4).cast("int").alias("cod_depto"), "id")
    both = dims(spark)
    mixed = enrichment.join_dimensions(facts, both, broadcast_bytes=50)
    text = plan(mixed)
    assert "SortMergeJoin" in text and "BroadcastHashJoin" in text
    assert rows(mixed) == rows(enrichment.join_dimensions(facts, both))
    assert mixed.columns == ["cod_depto", "id", "poblacion_2023", "region"]


def test_broadcast_joins_do_not_shuffle_facts(spark, tmp_path):
    path = str(tmp_path / "clean")
    clean_table(spark).write.parquet(path)
    text = plan(enrichment.enrich(spark.read.parquet(path), dims(spark)))
    assert text.count("BroadcastHashJoin") == 2
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text


def test_unused_dimensions_leave_the_plan(spark):
    """A dimension with unique keys is pruned; one with repeated keys must stay."""
    clean, both = clean_table(spark), dims(spark)
    view = enrichment.enrich(clean, both, prunable=True)
    assert plan(view.select("id", "region")).count("BroadcastHashJoin") == 1
    assert plan(view.select("id", "hurtos_por_100k")).count("BroadcastHashJoin") == 2
    assert plan(view.groupBy().count()).count("BroadcastHashJoin") == 1
    assert view.count() == 6
    assert rows(view) == rows(enrichment.enrich(clean, both))


def test_match_counts_equal_counts_over_the_join(spark):
    found = metrics(enrichment.match_counts(clean_table(spark), dims(spark)))
    enriched = enrichment.enrich(clean_table(spark), dims(spark))
    assert found == {
        "base_rows": 5,
        "enriched_rows": enriched.count(),
        "matched_poblacion": enriched.filter("poblacion_2023 is not null").count(),
        "matched_regiones": enriched.filter("region is not null").count(),
    }
    assert found["enriched_rows"] == 6


def test_matched_row_with_null_marker_is_no_match(spark):
    table = spark.createDataFrame([(1, None)], "cod_depto int, region string")
    found = metrics(
        enrichment.match_counts(clean_table(spark), [Dimension("r", table, "region")])
    )
    assert (found["enriched_rows"], found["matched_r"]) == (5, 0)


def test_fanout_check(spark):
    assert rows(enrichment.fanout_check(clean_table(spark), dims(spark))) == [
        ("poblacion", 5, 5),
        ("regiones", 5, 6),
    ]


def test_schema_delta(spark):
    clean = clean_table(spark)
    delta = rows(enrichment.schema_delta(clean, enrichment.enrich(clean, dims(spark))))
    assert delta[0] == (1, "cod_depto", "base", 5)
    assert delta[-1] == (10, "hurtos_por_100k", "added", 3)
    assert [r[2] for r in delta] == ["base"] * 7 + ["added"] * 3
