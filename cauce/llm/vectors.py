"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within and between cells.

Every vector has a home cell, that of the nearest centroid, and lies in one block of it, with
others at about the same angle from the centroid. Two vectors whose cosine reaches the threshold
are at most its angle apart, so their angles from any centroid differ by no more than that: a
vector meets the blocks at such angles, and no pair is lost however the cells fall. Vectors
are written once, in the order of label and cell; tasks read two chunks of the files at a time,
so nothing is copied for the cells that a vector meets.
"""

import functools
import itertools
import uuid
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cauce.llm.common import arrow_schema, shared_folder, staged
from cauce.llm.components import components

#: Most rows of a block, which a chunk's rows are compared with at a time.
BLOCK = 256
#: Most rows and components of a chunk; two chunks are in memory at a time.
CHUNK, COMPONENTS = 16_384, 1 << 22


def spherical_kmeans(vectors: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Unit centroids of unit vectors; a cell that runs empty keeps its centroid."""
    k = min(k, len(vectors))
    centroids = vectors[np.random.RandomState(seed).choice(len(vectors), k, replace=False)]
    for _ in range(rounds):
        near = (vectors @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, vectors)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 0, sums / np.maximum(norms, 1e-300), centroids)
    return centroids


def leading_axes(units: np.ndarray, threshold: float) -> np.ndarray:
    """Orthonormal axes, most of the length first; as many as decide most pairs, none if that takes nearly all.

    With the lengths of what is left they bound a cosine from above.
    """
    size = units.shape[1]
    axes = np.linalg.eigh(units.T @ units)[1][:, ::-1]
    left, right = units[::2][:512] @ axes, units[1::2][:512] @ axes
    best, least = 0, size
    for m in range(8, size, 8):
        rest = [np.sqrt(np.maximum(0, 1 - (x[:, :m] ** 2).sum(axis=1))) for x in (left, right)]
        share = (left[:, :m] @ right[:, :m].T + np.outer(*rest) >= threshold).mean() if right.size else 1
        cost = m + 2 * size * (1 - (1 - share) ** BLOCK)
        if cost < least:
            best, least = m, cost
    return axes[:, :best]


class _Cells(NamedTuple):
    """The centroids and leading axes for vectors of one length."""

    centroids: np.ndarray
    axes: np.ndarray


def _by_size(held: pa.Array, kind: str):
    """(rows, vectors) for each length of the vectors in a column of bytes.

    Each vector is multiplied by a power of two; no cosine changes, and no square leaves double precision.
    """
    sizes = pc.binary_length(held).to_numpy()
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        same = held if len(at) == len(sizes) else held.take(pa.array(at))
        vectors = np.frombuffer(b"".join(same.to_pylist()), kind).reshape(len(at), -1).astype(float)
        yield at, np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _digests(held: list) -> pa.Array:
    return pa.array([None if x is None else xxhash.xxh3_128_digest(x) for x in held], pa.binary())


def _held(column: pa.Array, used: np.ndarray, kind: str) -> list[bytes | None]:
    """Bytes of the vectors that are ``used`` and can link with others, else None."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    flat = pc.cast(column.flatten(), pa.float32() if kind == "<f4" else pa.float64())
    flat = flat.to_numpy(zero_copy_only=False)  # NaN for NULL
    first = np.cumsum(sizes) - sizes
    held = [None] * len(sizes)
    for size in np.unique(sizes[sizes > 0]):
        at = np.flatnonzero(used & (sizes == size))
        vectors = flat[first[at][:, None] + np.arange(size)].astype(kind) + np.array(0, kind)  # no -0.0
        good = np.isfinite(vectors).all(axis=1) & vectors.any(axis=1)
        for i, vector in zip(at[good].tolist(), vectors[good]):
            held[i] = vector.tobytes()
    return held


def _vectors(vectors: DataFrame, kind: str, whole: bool) -> DataFrame:
    """(vec_id, label) and ``held``, the vector's bytes, or ``sign``, their digest; NULL for those that link with nothing."""
    kinds = {c: vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, {'held' if whole else 'sign'} binary"
    arrow = arrow_schema(schema)

    def read(batches):
        for batch in batches:
            held = _held(batch["embedding"], pc.is_valid(batch["label"]).to_numpy(zero_copy_only=False), kind)
            last = pa.array(held, pa.binary()) if whole else _digests(held)
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["label"], last], schema=arrow)

    return vectors.select("vec_id", "label", "embedding").mapInArrow(read, schema)


def _cells(vectors: DataFrame, kind: str, n: int, k: int, sample: int, threshold: float) -> dict[int, _Cells]:
    """Centroids for the lengths among about ``sample`` of ``n`` vectors, which the driver holds."""
    share = F.pmod(F.xxhash64("embedding"), F.lit(1 << 30)) < int(min(1.0, sample / max(n, 1)) * (1 << 30))
    drawn = _vectors(vectors.filter(share & F.col("label").isNotNull()), kind, True).filter("held is not null")
    held = [bytes(r.held) for r in drawn.select("held").distinct().limit(2 * sample).collect()]
    found = {}
    for _, of_size in _by_size(pa.array(held, pa.binary()), kind):
        units = _units(of_size)
        found[units.shape[1]] = _Cells(spherical_kmeans(units, k), leading_axes(units, threshold))
    return found


def near_vectors(
    vectors: DataFrame, threshold: float = 0.93, cell_rows: int = 4000, most_cells: int = 256, sample: int = 10_000
) -> DataFrame:
    """Per row of (vec_id, embedding, label): n_links, component_id and kept.

    Rows link when their labels are equal and not NULL and the cosine of their
    vectors is at least ``threshold``. NULL, empty and zero vectors and those
    with a NULL or non-finite component link with nothing, nor do vectors of
    different lengths. Equal vectors are one class, however many; n_links counts
    its rows. Repeated vec_ids are rows of their own; component_id is the
    smallest vec_id reachable (NULL only if all are), kept tells whether it is
    the own one. Other columns are not read.

    Centroids are fitted on ``sample`` vectors at most, taken by hash; every row
    is assigned. Products in single precision rule pairs out or in; those within
    its error of the threshold are decided in double precision. ``vectors`` is
    computed three times and must give the same rows each time. Each distinct vector
    is shuffled twice and written once; work grows with the square of what shares a
    label, less what the cells rule out.
    """
    spark = vectors.sparkSession
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"
    rows = staged(_vectors(vectors, kind, False), "vectors")
    n = rows.filter("sign is not null").select("label", "sign").distinct().count()
    cells = _cells(vectors, kind, n, min(most_cells, n // cell_rows + 1), sample, threshold)
    sent = spark.sparkContext.broadcast(cells)

    unique = _vectors(vectors, kind, True).filter("held is not null").groupBy("label", "held").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("first")
    )
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), n // (CHUNK // 2) + 1)
    classes = staged(_placed(unique, kind, sent, parts), "vector-classes")
    found = staged(_compared(classes, kind, sent, threshold), "block-links")

    counted = found.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(found.filter("root <> cls").select(F.col("cls").alias("a"), F.col("root").alias("b")))
    rooted = classes.select("cls", "label", "sign", "copies", "first")
    rooted = rooted.join(counted, "cls", "left").join(roots.select(F.col("id").alias("cls"), "root"), "cls", "left")
    rooted = staged(rooted.withColumn("root", F.coalesce("root", "cls")), "rooted")
    tops = staged(rooted.groupBy("root").agg(F.min("first").alias("top")), "tops")
    links = (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    member = staged(rooted.join(tops, "root").select("label", "sign", links, "top"), "members")
    out = rows.join(member, ["label", "sign"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("top"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def _placed(unique: DataFrame, kind: str, sent, parts: int) -> DataFrame:
    """Writes the vectors by label, length and cell; one row for each, with its file and chunk.

    ``cls`` numbers the vectors in that order.
    """
    label, first = (unique.schema[c].dataType.simpleString() for c in ("label", "first"))
    schema = f"label {label}, size int, cell int, near double, sign binary, copies long, first {first}, held binary"
    kinds = arrow_schema(schema)

    def assign(batches):
        for batch in batches:
            size, cell, near = np.zeros(len(batch), np.int32), np.zeros(len(batch), np.int32), np.zeros(len(batch))
            for at, of_size in _by_size(batch["held"], kind):
                size[at] = of_size.shape[1]
                if of_size.shape[1] in sent.value:
                    cosines = _units(of_size) @ sent.value[of_size.shape[1]].centroids.T
                    cell[at] = cosines.argmax(axis=1)
                    near[at] = cosines.max(axis=1)
            columns = [batch["label"], size, cell, near, _digests(batch["held"].to_pylist()), batch["copies"], batch["first"], batch["held"]]
            yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], schema=kinds)

    key = ["label", "size", "cell", "near", "sign"]
    ordered = unique.mapInArrow(assign, schema).repartitionByRange(parts, *key).sortWithinPartitions(*key)
    numbered = ordered.withColumn("cls", F.monotonically_increasing_id())
    folder = shared_folder(unique.sparkSession, "placed")
    stored = arrow_schema(f"cls long, label {label}, size int, cell int, near double, copies long, held binary")
    schema = f"cls long, label {label}, size int, sign binary, copies long, first {first}, file string, chunk int"
    listed = arrow_schema(schema)

    def write(batches):
        # Each attempt of a task has a file of its own; the rows name that of the committed one.
        file = f"{folder}/{uuid.uuid4().hex}.arrow"
        files, path = fs.FileSystem.from_uri(file)
        files.create_dir(path.rpartition("/")[0], recursive=True)
        with files.open_output_stream(path) as sink, pa.ipc.new_file(sink, stored) as chunks:
            for number, rows in enumerate(_chunks(batches, CHUNK, COMPONENTS)):
                chunks.write_batch(pa.RecordBatch.from_arrays([rows[c] for c in stored.names], schema=stored))
                place = [pa.repeat(file, len(rows)), pa.repeat(pa.scalar(number, pa.int32()), len(rows))]
                yield pa.RecordBatch.from_arrays([*(rows[c] for c in listed.names[:-2]), *place], schema=listed)

    return numbered.mapInArrow(write, schema)


def _chunks(batches, most_rows: int, most_components: int):
    """The rows of ``batches``, as many at a time as a chunk may have."""
    waiting = []
    for batch in batches:
        size = max(pc.max(batch["size"]).as_py() or 0, 1)
        most, start = max(1, min(most_rows, most_components // size)), 0
        while start < len(batch):
            room = most - sum(map(len, waiting))
            if room > 0:
                waiting.append(batch.slice(start, room))
                start += len(waiting[-1])
            else:
                yield pa.concat_batches(waiting)
                waiting = []
    if waiting:
        yield pa.concat_batches(waiting)


def _opened(file: str) -> pa.ipc.RecordBatchFileReader:
    files, path = fs.FileSystem.from_uri(file)
    local = isinstance(files, fs.LocalFileSystem)
    return pa.ipc.open_file(pa.memory_map(path) if local else files.open_input_file(path))


def _compared(classes: DataFrame, kind: str, sent, threshold: float) -> DataFrame:
    """(cls, links, root) of the vectors that link, for each two chunks that share a label and length."""
    group = F.struct("label", "size")
    chunks = classes.groupBy("file", "chunk").agg(
        F.min("cls").alias("start"), F.min_by(group, "cls").alias("lowest"), F.max_by(group, "cls").alias("highest")
    )
    chunks = staged(chunks, "chunks")
    # Chunks follow each other by label and length: two of them share no other group than this.
    left = chunks.select(F.col("file").alias("file_a"), F.col("chunk").alias("chunk_a"), F.col("start").alias("start_a"), "highest")
    right = chunks.select(F.col("file").alias("file_b"), F.col("chunk").alias("chunk_b"), F.col("start").alias("start_b"), "lowest")
    two = left.join(right, (F.col("highest") == F.col("lowest")) & (F.col("start_a") < F.col("start_b")))
    names = ["file_a", "chunk_a", "file_b", "chunk_b"]
    one = chunks.select("file", "chunk", "file", "chunk").toDF(*names)
    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = two.select(*names).union(one).repartition(n).sortWithinPartitions(*names)

    def compare(batches):
        opened = functools.lru_cache(8)(_opened)
        loaded = functools.lru_cache(2)(lambda file, chunk: opened(file).get_batch(chunk))
        run = functools.lru_cache(2)(lambda file, chunk, lo, hi: _run(loaded(file, chunk)[lo:hi], kind, sent.value))
        for batch in batches:
            for a, i, b, j in zip(*(batch[c].to_pylist() for c in names)):
                found = []
                if (a, i) == (b, j):
                    for lo, hi in _spans(loaded(a, i)):
                        if hi - lo > 1:
                            x = run(a, i, lo, hi)
                            found.append(_linked(x, x, threshold, BLOCK))
                else:
                    x, y = run(a, i, *_spans(loaded(a, i))[-1]), run(b, j, *_spans(loaded(b, j))[0])
                    found.append(_linked(x, y, threshold, BLOCK))
                if found:
                    yield pa.record_batch([np.concatenate(x) for x in zip(*found)], ["cls", "links", "root"])

    return pairs.mapInArrow(compare, "cls long, links long, root long")


def _spans(chunk: pa.RecordBatch) -> list[tuple[int, int]]:
    """Begin and end of the rows of each label and length."""
    codes = [pc.dictionary_encode(chunk[c]).indices.to_numpy() for c in ("label", "size")]
    new = np.flatnonzero(np.any(np.diff(codes), axis=0)) + 1
    return list(itertools.pairwise([0, *new.tolist(), len(chunk)]))


class _Run(NamedTuple):
    """Vectors of one label and length, by cell; leads are the leading components and the length of the others."""

    cls: np.ndarray
    copies: np.ndarray
    cell: np.ndarray
    near: np.ndarray
    exact: np.ndarray
    norms: np.ndarray
    units: np.ndarray
    leads: np.ndarray | None
    centroids: np.ndarray | None


def _run(rows: pa.RecordBatch, kind: str, cells: dict[int, _Cells]) -> _Run:
    (_, exact), = _by_size(rows["held"], kind)
    units, leads, centroids = _units(exact), None, None
    if exact.shape[1] in cells:
        centroids, axes = cells[exact.shape[1]]
        if axes.size:
            leads = units @ axes
            rest = np.sqrt(np.maximum(0, 1 - (leads * leads).sum(axis=1)))
            leads = np.hstack([leads, rest[:, None]]).astype(np.float32)
    columns = [rows[c].to_numpy() for c in ("cls", "copies", "cell", "near")]
    return _Run(*columns, exact, np.linalg.norm(exact, axis=1), units.astype(np.float32), leads, centroids)


def _blocks(cell: np.ndarray, near: np.ndarray, block: int) -> list[tuple[int, int, list[tuple[int, float, float]]]]:
    """(begin, end, cells with their least and largest cosine) of blocks; small pieces of cells share one."""
    blocks = []
    for lo, hi in itertools.pairwise([0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(cell)]):
        step = -(-(hi - lo) // -(-(hi - lo) // block))
        for start in range(lo, hi, step):
            stop = min(start + step, hi)
            piece = (int(cell[lo]), float(near[start:stop].min()), float(near[start:stop].max()))
            if blocks and stop - blocks[-1][0] <= block // 2:
                blocks[-1] = (blocks[-1][0], stop, [*blocks[-1][2], piece])
            else:
                blocks.append((start, stop, [piece]))
    return blocks


def _linked(a: _Run, b: _Run, threshold: float, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cls, links, root) of the vectors of ``a`` that link with one of ``b`` and the other way round; ``a`` may be ``b``."""
    same, n = a is b, len(a.cls)
    # Beyond the error of a product in single precision, with the rounding of its factors.
    size = a.units.shape[1]
    error, step = (size + 16) * 2.0**-23, COMPONENTS // size + 1
    angle = np.arccos(np.clip(threshold, -1, 1))
    cls = a.cls if same else np.concatenate([a.cls, b.cls])
    links, root = np.zeros(len(cls), np.int64), np.arange(len(cls))
    to_b = 0 if same else n
    blocks = _blocks(b.cell, b.near, block)
    toward = {}
    if a.centroids is not None and len(blocks) > 1:
        known = np.unique(b.cell)
        toward = dict(zip(known.tolist(), a.centroids[known].astype(np.float32) @ a.units.T))
    for lo, hi, pieces in blocks:
        begin = lo if same else 0
        if toward and len(pieces) <= 4:
            close = np.zeros(n - begin, bool)
            for cell, least, most in pieces:
                least, most = np.arccos(np.clip(least, -1, 1)) + angle, np.arccos(np.clip(most, -1, 1)) - angle
                t = toward[cell][begin:]
                close |= (t >= np.cos(min(least, np.pi)) - error) & (t <= np.cos(max(most, 0)) + error)
            left = np.flatnonzero(close) + begin
        else:
            left = np.arange(begin, n)
        right = np.arange(lo, hi)
        if a.leads is not None and len(left):
            open_ = a.leads[left] @ b.leads[lo:hi].T >= threshold - error
            left, right = left[open_.any(axis=1)], right[open_.any(axis=0)]
        if not len(left):
            continue
        cosines = a.units[left] @ b.units[right].T
        linked = cosines >= threshold - error
        if same:
            linked &= left[:, None] > right
        x, y = np.nonzero(linked & (cosines < threshold + error))
        for i, j in zip(*(np.split(z, range(step, len(z), step)) for z in (x, y))):
            p, q = left[i], right[j]
            linked[i, j] = np.einsum("ij,ij->i", a.exact[p], b.exact[q]) / (a.norms[p] * b.norms[q]) >= threshold
        some, other = linked.any(axis=1), linked.any(axis=0)
        if not some.any():
            continue
        left, right, linked = left[some], right[other], linked[some][:, other]
        links[left] += linked @ b.copies[right]
        links[to_b + right] += a.copies[left] @ linked
        near, far = root[left], root[to_b + right]
        if near.min() != near.max() or far.min() != far.max() or near[0] != far[0]:
            x, y = np.nonzero(linked)
            _unite(root, left[x], to_b + right[y])
    some = links > 0
    return cls[some], links[some], cls[root[some]]


def _unite(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Gives the ends of the links ``i``, ``j`` and all that they were linked with the smallest root."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return
        i, j = i[apart], j[apart]
        np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (root[root] != root).any():
            root[:] = root[root]
