"""Centroid clustering of integer vectors with exact distances, by bit planes.

A vector of 64 integers in two's complement is turned into planes: bit b of all
64 components is one 64-bit word. The dot product of two vectors is then the
weighted sum of the ones that pairs of planes have in common, where plane b
weighs 2**b and the plane of the sign -2**b. All sums are integers, so neither
the order of rows nor the partitions change a result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cauce.llm import pieces as P
from cauce.llm.common import arrow_schema, staged

#: Components of a vector; one bit each in a word of a plane.
SIZE = 64
#: Integers beyond this have squared distances beyond 64 bits.
LARGEST = 1 << 27


def bits_of(values: np.ndarray) -> int:
    """Planes that hold all ``values``, the sign's included."""
    if not values.size:
        return 1
    return max(int(values.max()), ~int(values.min()), 0).bit_length() + 1


def planes(vectors: np.ndarray) -> np.ndarray:
    """(rows, planes) words of (rows, 64) integers; the last plane is the sign's."""
    bits = bits_of(vectors)
    flags = (vectors[:, None, :] >> np.arange(bits)[None, :, None]) & 1
    packed = np.packbits(flags.astype(np.uint8), axis=2, bitorder="little")
    return packed.view("<u8")[:, :, 0]


def weights(bits: int) -> np.ndarray:
    """What a one in each plane counts."""
    found = np.left_shift(1, np.arange(bits, dtype=np.int64))
    found[-1] = -found[-1]
    return found


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot products of all rows of planes ``a`` with all of ``b``."""
    total = np.zeros((len(a), len(b)), np.int64)
    for i, x in enumerate(weights(a.shape[1]).tolist()):
        for j, y in enumerate(weights(b.shape[1]).tolist()):
            total += (x * y) * np.bitwise_count(a[:, i, None] & b[None, :, j]).astype(np.int64)
    return total


def squares(vectors: np.ndarray) -> np.ndarray:
    return (vectors * vectors).sum(axis=1)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector, the smaller number where tied, and its squared distance."""
    distance = squares(vectors)[:, None] + squares(centroids) - 2 * dots(planes(vectors), planes(centroids))
    cluster = distance.argmin(axis=1)
    return cluster, distance[np.arange(len(vectors)), cluster]


def _integers(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, SIZE)


def integer_vectors(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """(vec_id, held): floor(scale * x) of the vectors that are kept.

    Kept are vectors with exactly 64 components, none NULL or non-finite. One
    whose integers go beyond ``LARGEST`` is left out too, as its distances would
    not fit a long.
    """
    x = F.col("embedding").cast("array<double>")
    whole = (F.size(x) == SIZE) & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) * scale > LARGEST))
    held = F.transform(x, lambda v: F.floor(v * scale).cast("long"))
    return vectors.filter(F.coalesce(whole, F.lit(False))).select("vec_id", held.alias("held"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``<seed>:<vec_id>``, in that order.

    Rows with the same vec_id follow each other by their components; those
    without one come last, by their components.
    """
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.select(drawn.alias("drawn"), "held").orderBy(F.col("drawn").asc_nulls_last(), "held").limit(k)
    return np.array([r.held for r in first.collect()], np.int64).reshape(-1, SIZE)


def means(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid as floor(sum / count) of its vectors; one without vectors stays."""
    sent = rows.sparkSession.sparkContext.broadcast(centroids)
    k = len(centroids)

    def add(batches):
        sums, counts = np.zeros((k, SIZE), np.int64), np.zeros(k, np.int64)

        def given():
            some = np.flatnonzero(counts)
            number, place = np.repeat(some, SIZE), np.tile(np.arange(SIZE), len(some))
            columns = [number, place, sums[some].ravel(), np.repeat(counts[some], SIZE)]
            return pa.record_batch([pa.array(c) for c in columns], ["number", "place", "total", "n"])

        seen = 0
        for batch in batches:
            if batch.num_rows:
                held = _integers(batch["held"])
                cluster, _ = nearest(held, sent.value)
                order = np.argsort(cluster, kind="stable")
                first = np.searchsorted(cluster[order], np.arange(k + 1))
                sums += P.row_sums(held[order], first)
                counts += np.diff(first)
                seen += len(held)
                if seen > 1 << 34:  # sums of a task stay within 64 bits
                    yield given()
                    sums[:], counts[:], seen = 0, 0, 0
        if seen:
            yield given()

    partial = rows.select("held").mapInArrow(add, "number long, place long, total long, n long")
    exact = F.sum(F.col("total").cast("decimal(38,0)"))
    found = partial.groupBy("number", "place").agg(exact.alias("total"), F.sum("n").alias("n"))
    moved = centroids.copy()
    for r in found.collect():  # at most 64 for each centroid
        moved[r.number, r.place] = int(r.total) // r.n
    return moved


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, seed: int = 1, scale: int = 64) -> DataFrame:
    """Per kept vector of (vec_id, embedding): vec_id, cluster, distance, inertias and centroid.

    Components become floor(scale * x); see ``integer_vectors`` for what is kept
    (not NULL, empty, shorter or longer ones). Centroids start as ``first_centroids``; each of ``rounds``
    rounds assigns all vectors to the nearest one and moves it to the floor of
    their mean. distance is the squared one after the last assignment;
    cluster_inertia and inertia are its sums over the cluster and over all (NULL
    beyond 64 bits); centroid is the final one as an array. Fewer kept vectors
    than ``k`` give as many clusters; equal vectors all go to the smallest number.
    Repeated vec_ids are rows of their own, a NULL one is carried along. Other
    columns are not read; without kept vectors the result is empty.

    The driver holds ``k`` centroids; a round brings 64 sums for each of them.
    """
    spark = vectors.sparkSession
    kind = vectors.schema["vec_id"].dataType.simpleString()
    rows = integer_vectors(vectors, scale)
    centroids = first_centroids(rows, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = means(rows, centroids)
    schema = f"vec_id {kind}, cluster int, distance long"
    kinds = arrow_schema(schema)
    sent = spark.sparkContext.broadcast(centroids)

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                number, distance = nearest(_integers(batch["held"]), sent.value)
                columns = [batch["vec_id"], pa.array(number, pa.int32()), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, schema=kinds)

    assigned = staged(rows.mapInArrow(assign, schema), "assigned")
    exact = F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum")
    by_cluster = {r.cluster: r.sum for r in assigned.groupBy("cluster").agg(exact).collect()}  # k at most
    total = sum(by_cluster.values())

    def long(value):
        return int(value) if abs(value) < 1 << 63 else None

    held = [(i, long(by_cluster.get(i, 0)), long(total), c) for i, c in enumerate(centroids.tolist())]
    names = "cluster int, cluster_inertia long, inertia long, centroid array<long>"
    table = spark.createDataFrame(held, names)
    return assigned.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )
