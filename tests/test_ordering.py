from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cauce.operators import ordering
from cauce.operators.reconcile import STATUS_DIFFERS, STATUS_OK, reconcile
from helpers import plan, rows


def test_event_order(spark):
    df = spark.createDataFrame(
        [(3, "b"), (2, None), (1, "b"), (4, "a")], "id bigint, fecha_hecho string"
    )
    assert [r["id"] for r in ordering.by_event_time(df).collect()] == [2, 4, 1, 3]


def test_sample_is_a_top_k(spark):
    df = spark.range(5000).select((4999 - F.col("id")).alias("id"))
    first = ordering.sample(df)
    assert "TakeOrderedAndProject" in plan(first)
    assert [r["id"] for r in first.collect()] == list(range(1000))
    assert ordering.sample(df.limit(3)).count() == 3


def test_sample_as_text(spark):
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 2, 3, 4, 5, 600))], "id bigint, fecha_hecho timestamp_ntz"
    )
    assert rows(ordering.sample_as_text(df)) == [(1, "2024-01-02 03:04:05")]


def test_pages_of_a_table(spark):
    df = spark.range(1, 101)
    by_order = ordering.page_slice(df, 90, 20)
    by_id = ordering.page_by_id(df, 90, 20)
    assert rows(by_order) == rows(by_id) == [(i,) for i in range(91, 101)]
    assert "Sort" not in plan(by_id)
    wide = df.select((F.col("id") % 7).alias("k"), "id").withColumn("x", F.lit("y"))
    page = ordering.page_slice(wide, 20, 15, ("k", "id"))
    expected = sorted((i % 7, i, "y") for i in range(1, 101))[20:35]
    assert [tuple(r) for r in page.collect()] == expected
    assert ordering.page_slice(wide, 200, 5, ("k", "id")).count() == 0


def test_samples_of_ids_with_gaps(spark):
    df = spark.range(0, 100_000, 37).repartition(16)
    assert rows(ordering.sample(df, 50)) == [(37 * i,) for i in range(50)]
    assert ordering.sample(df, 10**6).count() == df.count()
    assert ordering.sample(df.limit(0), 5).count() == 0


def test_append_pages_keeps_duplicates_and_fills_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([("y", 1, 2)], "b string, id int, c int")
    assert ordering.append_pages([a, b, a]).columns == ["id", "a", "b", "c"]
    assert rows(ordering.append_pages([a, b, a])) == [
        (1, None, "y", 2),
        (1, "x", None, None),
        (1, "x", None, None),
    ]


def test_surrogate_ids_are_contiguous_in_order(spark):
    """Nearly all rows share the first sort value; NULLs sort first."""
    hot = F.when(F.col("id") % 100 == 0, F.lit(None)).when(F.col("id") % 50 == 1, "z").otherwise("a")
    df = spark.range(3000).repartition(7).select(hot.alias("day"), F.col("id").alias("n"))
    order = [F.col("day").asc_nulls_first(), F.col("n").asc()]
    found = sorted(tuple(r) for r in ordering.with_surrogate_id(df, order).collect())
    assert [r[0] for r in found] == list(range(1, 3001))
    expected = sorted(
        ((r["day"], r["n"]) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or "", r[1])
    )
    assert [r[1:] for r in found] == expected
    assert ordering.with_surrogate_id(df.limit(0), order).count() == 0


def test_reconcile(spark):
    same = reconcile(spark.range(5), spark.range(5)).first()
    assert tuple(same) == (5, 5, 0, STATUS_OK)
    less = reconcile(spark.range(5), spark.range(3).toDF("x")).first()
    assert tuple(less) == (5, 3, 2, STATUS_DIFFERS)
    assert "CartesianProduct" not in plan(reconcile(spark.range(5), spark.range(3)))


@pytest.mark.parametrize("ids", ["dense", "gaps", "clusters", "equal", "wide"])
def test_samples_of_many_partitions(spark, monkeypatch, ids):
    monkeypatch.setattr(ordering, "FEW_PARTITIONS", 1)
    monkeypatch.setattr(ordering, "RANGES", 8)
    i = F.col("id")
    made = {
        "dense": i,
        "gaps": i * 104729 - 5 * 10**6,
        "clusters": F.when(i < 900, i).otherwise(i + 10**15),
        "equal": F.lit(7).cast("long"),
        "wide": F.when(i == 0, -(2**63)).when(i == 1, 2**63 - 1).otherwise(i * 3),
    }[ids]
    df = spark.range(0, 1000, 1, 6).select(made.cast("long").alias("id"))
    values = sorted(r.id for r in df.collect())
    for n in (1, 10, 500, 999, 1000, 5000):
        assert [r.id for r in ordering.sample(df, n).collect()] == values[:n]
    assert ordering.sample(df.limit(0), 5).count() == 0 == ordering.sample(df, 0).count()
    with_null = df.unionByName(spark.createDataFrame([(None,)], "id long"))
    assert [r.id for r in ordering.sample(with_null, 3).collect()] == [None, *values[:2]]


def test_sample_of_clustered_ids_reads_few_rows(spark, monkeypatch):
    monkeypatch.setattr(ordering, "FEW_PARTITIONS", 1)
    df = spark.range(0, 200_000, 1, 6).select((F.col("id") + F.when(F.col("id") > 100, 10**14).otherwise(0)).alias("id"))
    bound = ordering._bound(df, "id", 1000)
    assert 1000 <= df.filter(F.col("id") <= bound).count() <= 3000
