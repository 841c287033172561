"""Order, samples, page slices, surrogate ids and appended pages."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from cauce.functions import timestamp_text
from cauce.operators.paging import index_keys, page
from cauce.schemas import EVENT_TIME, ID, SAMPLE_ROWS
from cauce.shared import shared_dir, written
from cauce.sources.typed import sql_name


def by_event_time(df: DataFrame) -> DataFrame:
    """Total order by event time; the id breaks ties."""
    return df.orderBy(EVENT_TIME, ID)


#: Partitions whose first rows one task can sort.
FEW_PARTITIONS = 64
#: Ranges of ids that are counted at a time.
RANGES = 4096


def _bound(df: DataFrame, order: str, rows: int) -> int | None:
    """An id with ``rows`` rows or a few more at or below it; None where there are not so many.

    Counts ids by ranges of one width, then by narrower ones inside the range that
    holds the last wanted row: two or three scans of the id, however ids are spread.
    """
    low, high = df.agg(F.min(order), F.max(order)).first()
    if low is None:
        return None
    left = rows
    while True:
        width = -(-(high - low + 1) // RANGES)
        place = F.expr(f"CAST((CAST({sql_name(order)} AS DECIMAL(20,0)) - {low}) DIV {width} AS INT)")
        inside = df.filter(F.col(order).between(low, high)).groupBy(place.alias("place")).count()
        for place, n in sorted(map(tuple, inside.collect())):  # RANGES rows at most
            if n >= left:
                break
            left -= n
        else:
            return None
        low, high = low + place * width, min(low + (place + 1) * width - 1, high)
        if width == 1 or n <= left + rows:
            return high


def sample(df: DataFrame, rows: int = SAMPLE_ROWS, order: str = ID) -> DataFrame:
    """The first ``rows`` rows by a numeric id, NULLs first; ``df`` should be a written table.

    Of few partitions the first rows of each meet in one task. Otherwise a bound on
    the id is found first, from the id column alone, so that a few times ``rows`` rows
    meet there (more only where one id repeats).
    """
    whole = isinstance(df.schema[order].dataType, IntegralType)
    if whole and rows > 0 and df.rdd.getNumPartitions() > FEW_PARTITIONS:
        bound = _bound(df, order, rows)
        if bound is not None:
            df = df.filter(F.col(order).isNull() | (F.col(order) <= bound))
    return df.orderBy(order).limit(rows)


def sample_as_text(df: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The sample for export, with the event time as text."""
    return sample(df, rows).withColumn(EVENT_TIME, timestamp_text(F.col(EVENT_TIME)))


def page_by_id(df: DataFrame, offset: int, limit: int, id_column: str = ID) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` where ids run 1..N without gaps: no sort."""
    position = F.col(id_column)
    return df.filter((position > offset) & (position <= offset + limit))


def page_slice(
    df: DataFrame, offset: int, limit: int, order: Sequence[str] = (ID,)
) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of a total order.

    Only the columns of the order are shuffled, for an index that serves this page alone.
    For many pages of a table make it once (``paging.index_keys``, ``paging.page``).
    """
    return page(df, index_keys(df, order), offset, limit)


def append_pages(pages: Sequence[DataFrame]) -> DataFrame:
    """All rows of all pages, duplicates kept; columns match by name, absent ones are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


def with_surrogate_id(
    df: DataFrame,
    order: Sequence[Column],
    id_column: str = ID,
) -> DataFrame:
    """Ids 1..N without gaps in the given order, which should be total.

    Range partitions sort in parallel; a row's id is its place in its partition
    plus the rows of the partitions before. Place and partition are written out
    first, because a second evaluation may draw other range bounds. The running
    sum runs over one row per partition. For an ascending order ``paging.number_rows``
    gives the same ids without writing whole rows.
    """
    place, part = "_place", "_part"
    in_order = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows_below = (1 << 33) - 1  # monotonically_increasing_id: partition above, row below 33 bits
    placed = written(
        in_order.withColumns(
            {
                part: F.spark_partition_id(),
                place: F.monotonically_increasing_id().bitwiseAND(F.lit(rows_below)),
            }
        ),
        shared_dir(df.sparkSession),
    )
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(part)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(part, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    # One row per partition of the sort, so the broadcast is bounded by their number.
    numbered = placed.join(F.broadcast(starts), part)
    position = (F.col("_start") + F.col(place) + 1).alias(id_column)
    return numbered.select(position, *[c for c in df.columns if c != id_column])
