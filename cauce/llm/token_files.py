"""Token ids in Arrow stream files: fixed-size-list batches of equal-length sequences and masks.

A file holds the documents of one range of ids, one after the other, cut into
sequences of ``length`` ids; the last sequence of a file is padded and its mask
says so. All batches but the last have ``ROWS`` sequences, so a place in a file
gives the batch and the sequence by division, and a mapped file is read without
copying. An index has the file and place of every document.
"""

import functools
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cauce.llm.common import staged
from cauce.llm.encoders import encoded

#: Sequences in a batch.
ROWS = 256


def _batch(ids: np.ndarray, length: int, used: int) -> pa.RecordBatch:
    """Sequences of ``ids``, of which ``used`` are no padding."""
    mask = np.arange(len(ids)) < used
    columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), length) for x in (ids, mask)]
    return pa.record_batch(columns, ["ids", "mask"])


class _Writer:
    """One file, under its final name only when it is complete."""

    def __init__(self, folder: str, part: int, length: int, dtype: str):
        self.files, root = fs.FileSystem.from_uri(folder)
        self.files.create_dir(root, recursive=True)
        self.path, self.length, self.dtype = f"{root}/part-{part:06d}.arrow", length, dtype
        self.attempt = f"{root}/_{part:06d}-{uuid.uuid4().hex}"
        self.sink = self.files.open_output_stream(self.attempt)
        self.stream = pa.ipc.new_stream(self.sink, _batch(np.zeros(0, dtype), length, 0).schema)
        self.held, self.n_held = [], 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids.astype(self.dtype))
        self.n_held += len(ids)
        size = ROWS * self.length
        if self.n_held >= size:
            joined = np.concatenate(self.held)
            whole = len(joined) // size * size
            for start in range(0, whole, size):
                self.stream.write_batch(_batch(joined[start : start + size], self.length, size))
            self.held, self.n_held = [joined[whole:]], len(joined) - whole

    def close(self) -> None:
        if self.n_held:
            joined = np.concatenate(self.held)
            padding = np.zeros(-len(joined) % self.length, self.dtype)
            rows = np.concatenate([joined, padding])
            self.stream.write_batch(_batch(rows, self.length, len(joined)))
        self.stream.close()
        self.sink.close()
        self.files.move(self.attempt, self.path)


class TokenFile:
    """Random access to one file; a local one is mapped, not read."""

    def __init__(self, folder: str, part: int):
        files, root = fs.FileSystem.from_uri(folder)
        path = f"{root}/part-{part:06d}.arrow"
        local = isinstance(files, fs.LocalFileSystem)
        source = pa.memory_map(path) if local else files.open_input_file(path)
        self.batches = list(pa.ipc.open_stream(source))
        self.length = self.batches[0].schema.field("ids").type.list_size if self.batches else 0

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of the ``i``-th sequence."""
        row = self.batches[i // ROWS].slice(i % ROWS, 1)
        return tuple(x.flatten().to_numpy(zero_copy_only=False) for x in row.columns)

    def ids(self, start: int, n: int) -> Iterator[np.ndarray]:
        """``n`` ids from place ``start`` on, as views of the batches they lie in."""
        size = ROWS * self.length
        while n > 0:
            held = self.batches[start // size]["ids"].values.to_numpy()
            part = held[start % size : start % size + n]
            yield part
            start, n = start + len(part), n - len(part)


def write_token_files(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    end_id: int = 2,
    length: int = 2048,
    vocabulary_size: int = 50_257,
    partitions: int | None = None,
) -> DataFrame:
    """Write the ids of all texts by ascending ``doc_id``; returns the index.

    ``end_id`` follows each document. Index: doc_id, part (the file), place (ids
    before it in the file), n_tokens, start (ids of all documents before it). A
    NULL text is empty, a NULL doc_id comes first, repeated ids follow each other
    in any order. Other columns are not read. An empty table gives no file.

    One shuffle sorts the texts into ranges; each task writes its range as one
    file, holding a batch at a time. A lost task is repeated under a new name and
    moved into place when complete.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dtype = "<u2" if vocabulary_size <= 1 << 16 else "<u4"

    def write(batches):
        writer, place = None, 0
        for block, ids, rows in encoded(batches, vocabulary, "text", end_id):
            part = TaskContext.get().partitionId()
            writer = writer or _Writer(folder, part, length, dtype)
            writer.add(ids)
            yield pa.record_batch(
                [
                    block["doc_id"],
                    pa.array(np.full(block.num_rows, part), pa.int32()),
                    pa.array(rows[:-1] + place),
                    pa.array(np.diff(rows)),
                ],
                ["doc_id", "part", "place", "n_tokens"],
            )
            place += int(rows[-1])
        if writer:
            writer.close()

    kind = docs.schema["doc_id"].dataType.simpleString()
    ranged = docs.select("doc_id", "text").repartitionByRange(n, "doc_id")
    index = staged(
        ranged.sortWithinPartitions("doc_id").mapInArrow(
            write, f"doc_id {kind}, part int, place long, n_tokens long"
        ),
        "token-index",
    )
    # One row per file.
    sizes = index.groupBy("part").agg(F.sum("n_tokens").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return index.join(bases, "part").select(
        "doc_id", "part", "place", "n_tokens", (F.col("base") + F.col("place")).alias("start")
    )


def read_token_files(index: DataFrame, folder: str) -> DataFrame:
    """The documents of ``index`` as the files have them: its columns and ids_crc32.

    The checksum is the unsigned CRC-32 of the ids as little-endian 32-bit integers.
    """

    def read(batches):
        opened = functools.lru_cache(maxsize=2)(lambda part: TokenFile(folder, part))
        for batch in batches:
            sums = []
            for part, place, n in zip(*(batch[c].to_pylist() for c in ("part", "place", "n_tokens"))):
                crc = 0
                for ids in opened(part).ids(place, n):
                    crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                sums.append(crc)
            yield pa.record_batch(
                [*batch.columns, pa.array(sums, pa.int64())], [*batch.schema.names, "ids_crc32"]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in index.schema)
    return index.mapInArrow(read, f"{fields}, ids_crc32 long")
