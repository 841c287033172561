"""Pages and row numbers of an ordered table, by a small index of its keys.

The index is made once per table and order: one shuffle of the key columns. Each
page then reads the rows between two indexed keys, and row numbers come from a
second pass in which the indexed keys are fixed bounds; no row is written between.

The order is ascending with NULLs first. Rows of equal keys come in any order, so
pages fit together where the order is total. An index holds for the rows it was
made of: keep it beside one version of a table.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cauce.schemas import ID
from cauce.shared import shared_dir, written
from cauce.sources.typed import sql_name

#: Rows from one indexed key to the next, where no key repeats.
BLOCK_ROWS = 100_000


@dataclass(frozen=True)
class KeyIndex:
    """Rows (part, first, before): a key, and how many rows have a lower one.

    ``part`` is a range of the sort, of which there are ``spark.sql.shuffle.partitions``
    at most; a part holds one row per block.
    """

    table: DataFrame
    order: tuple[str, ...]


def _key(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(sql_name(c)).alias(f"k{i}") for i, c in enumerate(order)])


def index_keys(
    df: DataFrame, order: Sequence[str], path: str | None = None, block_rows: int = BLOCK_ROWS
) -> KeyIndex:
    """Index ``df`` by the columns ``order``, written below ``path`` (else in the shared folder).

    Reads and shuffles those columns alone. Equal keys lie in one range of the sort,
    and a block that begins amid equal keys counts to the one before.
    """
    if not order:
        raise ValueError("an index needs at least one column")
    names = [f"k{i}" for i in range(len(order))]
    keys = df.select(_key(order).alias("key")).select("key.*")
    rows_below = (1 << 33) - 1  # monotonically_increasing_id: partition above, row below 33 bits
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(rows_below))
    # With a number given, small ranges of keys stay apart: they bound wider rows later.
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = keys.repartitionByRange(ranges, *names).sortWithinPartitions(*names)
    placed = placed.withColumns({"part": F.spark_partition_id(), "place": place})
    blocks = placed.groupBy("part", F.expr(f"place DIV {block_rows}").alias("block")).agg(
        F.min(F.struct(*names)).alias("first"),
        F.max(F.struct(*names)).alias("last"),
        F.count(F.lit(1)).alias("rows"),
    )
    out = path or shared_dir(df.sparkSession)
    # Written first: another run of the sort may draw other ranges.
    blocks = written(blocks, f"{out}/blocks")
    inside = Window.partitionBy("part").orderBy("block")
    until = inside.rowsBetween(Window.unboundedPreceding, -1)
    # One row per range of the sort.
    below = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.groupBy("part").agg(F.sum("rows").alias("rows"))
    starts = starts.select("part", F.coalesce(F.sum("rows").over(below), F.lit(0)).alias("start"))
    begins = F.coalesce(F.lag("last").over(inside) < F.col("first"), F.lit(True))
    counted = blocks.select(
        "part", "first", F.coalesce(F.sum("rows").over(until), F.lit(0)).alias("ahead"), begins.alias("begins")
    )
    table = counted.filter("begins").join(F.broadcast(starts), "part")
    table = table.select("part", "first", (F.col("start") + F.col("ahead")).alias("before"))
    return KeyIndex(written(table, f"{out}/keys"), tuple(order))


def open_index(spark: SparkSession, path: str, order: Sequence[str]) -> KeyIndex:
    """What ``index_keys`` wrote below ``path``, in this or another session."""
    return KeyIndex(spark.read.parquet(f"{path}/keys"), tuple(order))


def page(df: DataFrame, index: KeyIndex, offset: int, limit: int) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of ``df`` in the order of its index, sorted.

    The scan gets bounds on the first column of the order. One task sorts the page and
    what lies between it and the indexed keys around it: two blocks more at most, where
    no key repeats.
    """
    if offset < 0 or limit < 0:
        raise ValueError("offset and limit must not be negative")
    before, first = F.col("before"), F.col("first")
    edges = index.table.agg(
        F.max(F.when(before <= offset, before)).alias("start"),
        F.max(F.when(before <= offset, first)).alias("low"),
        F.min(F.when(before >= offset + limit, first)).alias("high"),
    )
    start, low, high = edges.first()
    if start is None or limit == 0:
        return df.limit(0)
    # As subqueries, the bounds need no way through Python values.
    low_key, high_key = (edges.select(c).scalar() for c in ("low", "high"))
    lead, key = F.col(sql_name(index.order[0])), _key(index.order)
    wanted = key >= low_key
    if low.k0 is not None:
        wanted &= lead >= edges.select("low.k0").scalar()
    if high is not None:
        wanted &= key < high_key
        if high.k0 is not None:
            under = lead <= edges.select("high.k0").scalar()
            wanted &= under if low.k0 is not None else under | lead.isNull()
    in_order = df.filter(wanted).orderBy(*[F.col(sql_name(c)) for c in index.order])
    return in_order.offset(offset - start).limit(limit)


def number_rows(df: DataFrame, index: KeyIndex, id_column: str = ID) -> DataFrame:
    """``df`` with its places 1..N in the order of its index as first column ``id_column``.

    The first keys of the parts are the bounds: each row finds its part by halving, and
    one shuffle brings the rows of a part together. A column of that name is replaced.
    """
    kept = [sql_name(c) for c in df.columns if c != id_column]
    parts = index.table.groupBy("part").agg(F.min("first").alias("first"), F.min("before").alias("before"))
    n = parts.count()
    # One array for all rows, of one entry per part.
    bounds = parts.agg(F.sort_array(F.collect_list(F.struct("first", "before"))).alias("all")).scalar()
    part, bound, key = "_part", "_bounds", "_key"
    steps = [1 << i for i in reversed(range(n.bit_length()))] or [1]

    def halved(found: Column, step: Column) -> Column:
        fits = F.get(F.col(bound), found + step - 1)["first"] <= F.col(key)
        return F.when(fits, found + step).otherwise(found)

    at = F.reduce(F.array(*[F.lit(s) for s in steps]), F.lit(0), halved)
    rows = df.withColumns({bound: bounds, key: _key(index.order)}).withColumn(part, at)
    inside = Window.partitionBy(part).orderBy(*[F.col(sql_name(c)) for c in index.order])
    start = F.get(bounds, F.col(part) - 1)["before"]
    numbered = rows.drop(bound, key).withColumn("_place", F.row_number().over(inside))
    position = (start + F.col("_place")).cast("long").alias(id_column)
    return numbered.select(position, *kept)
