import pytest
from pyspark.sql import functions as F

from cauce.operators import ordering, paging
from helpers import plan

N = 3000


def in_order(df, order):
    """Key tuples sorted as Spark does: NULLs first."""
    keys = [tuple(r) for r in df.select(*order).collect()]
    return sorted(keys, key=lambda key: [(v is not None, v if v is not None else 0) for v in key])


@pytest.fixture
def table(spark, tmp_path):
    """A tenth of the rows have no first key, another tenth no text; columns are named as the index's own."""
    i = F.col("id")
    made = spark.range(0, N, 1, 5).select(
        F.when(i % 10 != 0, F.timestamp_seconds(1.7e9 + i % 41)).alias("k0"),
        F.when(i % 10 != 3, F.concat(F.lit("ñ"), i % 7)).alias("first"),
        (i * 7919 % N).alias("k1"),
        (i % 3).alias("part"),
        F.lit("x").alias("a.b"),
    )
    made.write.parquet(str(tmp_path / "t"))
    return spark.read.parquet(str(tmp_path / "t"))


@pytest.mark.parametrize("order", [("k0", "k1"), ("first", "k0", "k1"), ("k1",)])
def test_pages_and_numbers(spark, table, tmp_path, order):
    paging.index_keys(table, order, str(tmp_path / "index"), block_rows=100)
    index = paging.open_index(spark, str(tmp_path / "index"), order)
    expected = in_order(table, order)
    # Two pages lie in NULLs, one crosses their end, others the end of the table.
    for offset, limit in [(0, 40), (130, 50), (280, 90), (1234, 777), (N - 5, 50), (N, 5), (N + 999, 5), (7, 0)]:
        page = paging.page(table, index, offset, limit)
        assert page.columns == table.columns
        assert [tuple(r) for r in page.select(*order).collect()] == expected[offset : offset + limit]
    numbered = paging.number_rows(table, index, "n")
    assert numbered.columns == ["n", *table.columns]
    found = sorted(tuple(r) for r in numbered.select("n", "k1").collect())
    places = [(i + 1, key[order.index("k1")]) for i, key in enumerate(expected)]
    assert found == places


def test_pages_of_a_table_need_one_sort(spark, table):
    """The index has whole blocks; a page sorts no more rows than lie between two indexed keys."""
    index = paging.index_keys(table, ("k1",), block_rows=100)
    before = sorted(r.before for r in index.table.collect())
    assert before[0] == 0 and max(b - a for a, b in zip(before, [*before[1:], N])) <= 100
    text = plan(paging.page(table, index, 1500, 20))
    assert "TakeOrderedAndProject" in text and "Exchange hashpartitioning" not in text
    assert "GreaterThanOrEqual" in text or ">= Subquery" in text


def test_numbers_write_no_whole_rows(spark, table, tmp_path):
    index = paging.index_keys(table, ("k1",), str(tmp_path / "index"), block_rows=100)
    assert index.table.columns == ["part", "first", "before"]
    assert index.table.select("first.*").columns == ["k0"]
    text = plan(paging.number_rows(table, index, "n"))
    assert text.count("Exchange hashpartitioning(_part") == 1
    # Some parts, although they are small: rows are wider than keys.
    assert index.table.select("part").distinct().count() > 1


def test_repeated_keys(spark):
    """Blocks that begin amid equal keys are left out, so that counts before a key are exact."""
    df = spark.range(0, 1000, 1, 4).select((F.col("id") > 700).cast("int").alias("k"), "id")
    index = paging.index_keys(df, ("k",), block_rows=50)
    assert sorted((r.first.k0, r.before) for r in index.table.collect()) == [(0, 0), (1, 701)]
    assert [r.k for r in paging.page(df, index, 690, 20).collect()] == [0] * 11 + [1] * 9
    found = sorted((r.n, r.k) for r in paging.number_rows(df, index, "n").collect())
    assert found == [(i + 1, int(i > 700)) for i in range(1000)]


def test_empty_table_and_replaced_id(spark):
    df = spark.range(100).select(F.col("id"), (-F.col("id")).alias("k"))
    index = paging.index_keys(df, ("k",))
    numbered = paging.number_rows(df, index)
    assert numbered.columns == ["id", "k"]
    assert sorted(tuple(r) for r in numbered.collect()) == [(i + 1, i - 99) for i in range(100)]
    empty = df.limit(0)
    index = paging.index_keys(empty, ("k",))
    assert paging.page(empty, index, 0, 10).count() == 0 == paging.number_rows(empty, index).count()
    assert ordering.page_slice(empty, 0, 10, ("k",)).count() == 0


def test_wrong_arguments(spark):
    df = spark.range(3)
    with pytest.raises(ValueError, match="at least one column"):
        paging.index_keys(df, ())
    index = paging.index_keys(df, ("id",))
    with pytest.raises(ValueError, match="negative"):
        paging.page(df, index, -1, 5)
