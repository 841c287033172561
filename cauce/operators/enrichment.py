"""Left joins of the facts with keyed dimensions, and their audit."""

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.functions import rate_per_100k, to_key
from cauce.operators.shape import to_metrics, total
from cauce.schemas import COUNT, KEY, RATE
from cauce.shared import shared_dir, written

# A dimension is broadcast only up to this measured size.
BROADCAST_BYTES = 32 * 1024 * 1024
# Facts of one key that may meet in one task when a dimension is too big for that.
ROWS_PER_TASK = 5_000_000
_FIXED_WIDTH = (
    "boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "date",
    "timestamp",
)


@dataclass(frozen=True)
class Dimension:
    """A table with an INT key column and the columns it adds to the facts.

    ``marker`` is the column whose non-NULL value counts as a match.
    """

    name: str
    table: DataFrame
    marker: str

    def added(self, key: str = KEY) -> list[str]:
        return [c for c in self.table.columns if c != key]


@dataclass(frozen=True)
class DimensionSize:
    rows: int
    keys: int
    bytes: int


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row as held in memory: eight per column, and all texts and nested values."""
    sizes = [
        F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0))
        for name, data_type in df.dtypes
        if not data_type.startswith(_FIXED_WIDTH)
    ]
    return reduce(Column.__add__, sizes, F.lit(8 * len(df.columns))).cast("bigint")


def dimension_sizes(dims: Sequence[Dimension], key: str = KEY) -> DataFrame:
    """``(source, rows, keys, bytes)`` per dimension.

    ``rows`` is the audit figure; ``rows`` above ``keys`` means that the join
    could multiply facts (or that a key is NULL); ``bytes`` decides how to join.
    """
    spark = dims[0].table.sparkSession
    names = F.explode(F.array(*[F.lit(d.name) for d in dims])).alias("source")
    empty = spark.range(1).select(
        names, F.lit(None).cast("int").alias("key"), F.lit(0).alias("n"), F.lit(0).alias("b")
    )
    tagged = [
        d.table.select(
            F.lit(d.name).alias("source"),
            F.col(key).alias("key"),
            F.lit(1).alias("n"),
            _row_bytes(d.table).alias("b"),
        )
        for d in dims
    ]
    per_key = (
        reduce(DataFrame.unionByName, tagged, empty)
        .groupBy("source", "key")
        .agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    )
    return per_key.groupBy("source").agg(
        F.sum("n").alias("rows"), F.count("key").alias("keys"), F.sum("b").alias("bytes")
    )


def measure(dims: Sequence[Dimension], key: str = KEY) -> dict[str, DimensionSize]:
    """Sizes of the dimensions; one small job, one row per dimension."""
    names = [dim.name for dim in dims]
    if len(set(names)) < len(names):
        raise ValueError(f"dimensions of the same name: {sorted(names)}")
    rows = dimension_sizes(dims, key).collect()
    return {r["source"]: DimensionSize(r["rows"], r["keys"], r["bytes"]) for r in rows}


def require_unique_keys(sizes: dict[str, DimensionSize]) -> None:
    repeated = sorted(name for name, size in sizes.items() if size.rows > size.keys)
    if repeated:
        raise ValueError(f"repeated or NULL keys in: {', '.join(repeated)}")


def with_key(df: DataFrame, key: str = KEY) -> DataFrame:
    """Text code to INT key, in place; codes that are no number give NULL."""
    return df.withColumn(key, to_key(F.col(key)))


#: The column that tells the parts of a split key apart.
PART = "_part"
_PARTS, _HOT_KEY = "_parts", "_hot_key"


def split_keys(facts: DataFrame, key: str, rows_per_task: int) -> DataFrame:
    """The keys with more than ``rows_per_task`` facts, NULL too, and into how many parts each goes.

    Write it before use, so that both sides of a join see one and the same split. It has
    at most (facts / rows_per_task) rows, which bounds its broadcast.
    """
    return (
        facts.groupBy(F.col(key).alias(_HOT_KEY))
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > rows_per_task)
        .select(_HOT_KEY, F.ceil(F.col("_n") / rows_per_task).cast("int").alias(_PARTS))
    )


@dataclass(frozen=True)
class Split:
    """How facts and dimensions are dealt over the parts of hot keys; other keys have one part."""

    hot: DataFrame
    key: str

    def _with_parts(self, df: DataFrame) -> DataFrame:
        same_key = df[self.key].eqNullSafe(self.hot[_HOT_KEY])
        return df.join(F.broadcast(self.hot), same_key, "left").drop(_HOT_KEY)

    def spread(self, facts: DataFrame) -> DataFrame:
        """Facts with their part: by a hash of the row and of its partition, so that equal
        facts spread too; a retried task repeats both."""
        columns = [F.col("`" + c.replace("`", "``") + "`") for c in facts.columns]
        row_hash = F.xxhash64(*columns, F.spark_partition_id())
        place = F.coalesce(F.pmod(row_hash, F.col(_PARTS)), F.lit(0)).cast("int")
        return self._with_parts(facts).withColumn(PART, place).drop(_PARTS)

    def repeat(self, dim: DataFrame) -> DataFrame:
        """Dimension rows once for each part of their key."""
        every_part = F.explode(F.sequence(F.lit(0), F.coalesce(_PARTS, F.lit(1)) - 1)).alias(PART)
        return self._with_parts(dim).select(*dim.columns, every_part)


def _shuffled_left_join(
    facts: DataFrame, dims: Sequence[Dimension], key: str, rows_per_task: int
) -> DataFrame:
    """Left joins by shuffle, with hot keys split.

    A key with more than ``rows_per_task`` facts (NULL and unmatched keys count
    too) is split into parts, and its dimension rows are repeated once per part.
    All joins use the same two columns, so the facts shuffle and sort once for all
    dimensions.
    """
    hot = written(split_keys(facts, key, rows_per_task), shared_dir(facts.sparkSession))
    split = Split(hot, key)
    joined = split.spread(facts)
    for dim in dims:
        # The hint keeps estimates from broadcasting what was measured as too big.
        joined = joined.join(split.repeat(dim.table).hint("merge"), [key, PART], "left")
    return joined.drop(PART)


def _reduced_left_join(
    facts: DataFrame, dims: Sequence[Dimension], key: str, rows_per_task: int
) -> DataFrame:
    """Left joins that shuffle only facts whose key some dimension has; the others get NULLs.

    The dimensions' keys are broadcast, so check their size first. Facts are read twice.
    """
    found = reduce(DataFrame.union, [d.table.select(key) for d in dims])
    keys = F.broadcast(found.filter(F.col(key).isNotNull()).distinct())
    matched = _shuffled_left_join(facts.join(keys, key, "left_semi"), dims, key, rows_per_task)
    absent = [
        F.lit(None).cast(f.dataType).alias(f.name) for d in dims for f in d.table.schema if f.name != key
    ]
    unmatched = facts.join(keys, key, "left_anti").select("*", *absent)
    return matched.unionByName(unmatched)


def _grouped(dim: Dimension, key: str) -> Dimension:
    return replace(dim, table=dim.table.dropDuplicates([key]))


def join_dimensions(
    facts: DataFrame,
    dims: Sequence[Dimension],
    key: str = KEY,
    sizes: dict[str, DimensionSize] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
    prunable: bool = False,
    key_bytes: int = 0,
) -> DataFrame:
    """Left join of ``facts`` with every dimension; the key comes first.

    Dimensions of a measured size up to ``broadcast_bytes`` are broadcast, so the
    facts are not shuffled; bigger ones are shuffle joins with hot keys split.
    Every fact is kept; a key that a dimension repeats repeats the fact.

    With ``prunable`` a dimension whose keys were measured as unique is also
    grouped by its key, which changes no row but lets Catalyst drop its join from
    queries that use none of its columns.

    With ``key_bytes`` the distinct keys of the bigger dimensions are broadcast where
    their measured size is at most that, and only facts with such a key are shuffled.
    It pays where many facts match nothing and ``facts`` is cheap to read twice.
    """
    sizes = measure(dims, key) if sizes is None else sizes
    if prunable:
        dims = [_grouped(d, key) if sizes[d.name].rows == sizes[d.name].keys else d for d in dims]
    small = [d for d in dims if sizes[d.name].bytes <= broadcast_bytes]
    large = [d for d in dims if sizes[d.name].bytes > broadcast_bytes]
    base = [c for c in facts.columns if c != key]
    added = [c for d in dims for c in d.added(key)]

    joined = facts
    if large:
        # Eight bytes for the key, and as much for its place in the hash table.
        small_keys = 16 * sum(sizes[d.name].keys for d in large) <= key_bytes
        join = _reduced_left_join if small_keys else _shuffled_left_join
        joined = join(facts, large, key, rows_per_task)
    joined = reduce(lambda df, d: df.join(F.broadcast(d.table), key, "left"), small, joined)
    return joined.select(key, *base, *added)


def with_rate(
    df: DataFrame, events: str = COUNT, population: str = "poblacion_2023", name: str = RATE
) -> DataFrame:
    return df.withColumn(name, rate_per_100k(F.col(events), F.col(population)))


def enrich(
    clean: DataFrame,
    dims: Sequence[Dimension],
    sizes: dict[str, DimensionSize] | None = None,
    unique_keys: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
    prunable: bool = False,
    key_bytes: int = 0,
) -> DataFrame:
    """The clean table with all dimension columns and the rate per 100,000.

    With ``unique_keys`` a repeated dimension key is an error. ``prunable`` suits a
    view that is queried for some of its columns, ``key_bytes`` facts of which many match
    nothing (see ``join_dimensions``).
    """
    sizes = measure(dims) if sizes is None else sizes
    if unique_keys:
        require_unique_keys(sizes)
    keyed = with_key(clean)
    joined = join_dimensions(
        keyed, dims, KEY, sizes, broadcast_bytes, rows_per_task, prunable, key_bytes
    )
    return with_rate(joined)


def match_measures(dims: Sequence[Dimension], weight: Column | None = None) -> dict[str, Column]:
    """Sums over joined rows: rows, and rows matched by each dimension."""
    weight = F.lit(1) if weight is None else weight
    matched = {
        f"matched_{d.name}": total(F.when(F.col(d.marker).isNotNull(), weight).otherwise(0))
        for d in dims
    }
    return {"enriched_rows": total(weight), **matched}


def match_counts(
    clean: DataFrame, dims: Sequence[Dimension], sizes: dict[str, DimensionSize] | None = None
) -> DataFrame:
    """``(metric, value)``: base rows, enriched rows, matched rows per dimension.

    Facts are counted per key first, so this reads the key column alone and the
    joins see one row per key. Sums weighted by that count equal the counts over
    the joined facts, fan-out included.
    """
    per_key = with_key(clean).groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
    joined = join_dimensions(per_key, dims, sizes=sizes)
    measures = match_measures(dims, F.col("n"))
    matches = to_metrics(joined.agg(*[v.alias(k) for k, v in measures.items()]))
    return to_metrics(per_key.agg(total(F.col("n")).alias("base_rows"))).unionByName(matches)


def fanout_check(clean: DataFrame, dims: Sequence[Dimension]) -> DataFrame:
    """``(source, base_rows, joined_rows)`` of a left join with each dimension alone.

    ``joined_rows`` above ``base_rows`` shows a repeated key. Works on counts per
    key, so no fact row meets a dimension row.
    """
    per_key = with_key(clean).groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
    sources = F.explode(F.array(*[F.lit(d.name) for d in dims])).alias("source")
    keys = [d.table.select(F.lit(d.name).alias("source"), KEY) for d in dims]
    copies = (
        reduce(DataFrame.unionByName, keys).groupBy("source", KEY).agg(F.count(KEY).alias("copies"))
    )
    return (
        per_key.select(KEY, "n", sources)
        .join(copies, ["source", KEY], "left")
        .groupBy("source")
        .agg(
            F.sum("n").alias("base_rows"),
            F.sum(F.col("n") * F.coalesce("copies", F.lit(1))).alias("joined_rows"),
        )
    )


def schema_delta(base: DataFrame, enriched: DataFrame) -> DataFrame:
    """``(position, column, role, non_null)`` for each column of ``enriched``."""
    before = set(base.columns)
    counts = enriched.agg(*[F.count(F.col(c)).alias(c) for c in enriched.columns])
    places = F.create_map(
        *[F.lit(x) for i, c in enumerate(enriched.columns, 1) for x in (c, i)]
    )
    return counts.unpivot([], enriched.columns, "column", "non_null").select(
        places[F.col("column")].alias("position"),
        "column",
        F.when(F.col("column").isin(*before), "base").otherwise("added").alias("role"),
        "non_null",
    )
