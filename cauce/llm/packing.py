"""Packing by cutting stock: column generation over a histogram of lengths.

A document is cut into sequences' worth of ids and a rest; the rest into a
multiple of ``GRID`` and less than that. So there are few lengths. A linear
program over patterns (how often each length occurs in a sequence) covers their
histogram; a knapsack by dynamic programming prices new patterns. Its solution
is rounded down, patterns that fill a sequence get documents by their rank, and
what is left is laid end to end and cut, its tail into powers of two.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cauce.llm.common import arrow_schema, record_batch, staged
from cauce.llm.encoders import encoded

GRID = 32


def cut_lengths(n: int, room: int) -> list[int]:
    """The pieces of a document of ``n`` ids."""
    rest = n % room
    return [room] * (n // room) + [x for x in (rest // GRID * GRID, rest % GRID) if x]


def price(values: np.ndarray, lengths: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern that fills ``room`` exactly, or as far as possible."""
    best, last = np.full(room + 1, -np.inf), np.full(room + 1, -1)
    best[0] = 0
    for size in range(1, room + 1):
        fits = lengths <= size
        if fits.any():
            worth = np.where(fits, values + best[np.maximum(size - lengths, 0)], -np.inf)
            last[size] = worth.argmax()
            best[size] = worth[last[size]]
    size = int(best.argmax()) if best[room] < best.max() - 1e-9 else room
    worth, pattern = float(best[size]), np.zeros(len(lengths))
    while size > 0:
        pattern[last[size]] += 1
        size -= lengths[last[size]]
    return worth, pattern


def generate(lengths: np.ndarray, demand: np.ndarray, room: int, rounds: int = 2000):
    """Patterns and their fractional numbers that cover ``demand`` with the fewest sequences.

    Revised simplex from one pattern per length; ends when no pattern has a value
    over 1. Any stop gives a feasible solution.
    """
    basis = np.diag((room // lengths).astype(float))
    inverse = np.diag(1 / np.diag(basis))
    amounts = inverse @ demand
    for _ in range(rounds):
        worth, pattern = price(inverse.sum(axis=0), lengths, room)
        if worth <= 1 + 1e-9:
            break
        change = inverse @ pattern
        ratio = np.where(change > 1e-9, amounts / np.where(change > 1e-9, change, 1), np.inf)
        out = int(ratio.argmin())
        basis[:, out] = pattern
        inverse[out] /= change[out]
        others = np.arange(len(lengths)) != out
        inverse[others] -= np.outer(change[others], inverse[out])
        amounts = np.maximum(inverse @ demand, 0)
    return basis.T, amounts


@dataclass
class Plan:
    """Where the piece of a given length and rank goes; its size depends on ``GRID`` and room alone.

    ``slots[length]``: rows (first rank, first sequence, pieces a sequence, first
    offset) by rank; beyond ``used[length]`` pieces, place ``line[length]`` on.
    """

    room: int
    slots: dict[int, np.ndarray] = field(default_factory=dict)
    used: dict[int, int] = field(default_factory=dict)
    line: dict[int, int] = field(default_factory=dict)
    cuts: np.ndarray = None
    first: int = 0
    total: int = 0

    def places(self, length: int, rank: int) -> Iterator[tuple[int, int, int, int]]:
        """(place in the piece, length, sequence, offset) of a piece and its cuts."""
        if rank < self.used.get(length, 0):
            rows = self.slots[length]
            row = rows[np.searchsorted(rows[:, 0], rank, "right") - 1]
            turn, slot = divmod(rank - int(row[0]), int(row[2]))
            yield 0, length, int(row[1]) + turn, int(row[3]) + slot * length
            return
        start = self.line[length] + (rank - self.used.get(length, 0)) * length
        done = 0
        while done < length:
            at = start + done
            full = self.total // self.room
            if at < full * self.room:
                sequence, offset = divmod(at, self.room)
                end = self.room
            else:
                i = int(np.searchsorted(self.cuts, at, "right")) - 1
                sequence, offset = full + i, at - int(self.cuts[i])
                end = int(self.cuts[i + 1] - self.cuts[i])
            part = min(length - done, end - offset)
            yield done, part, self.first + sequence, offset
            done += part


def make_plan(histogram: dict[int, int], room: int) -> Plan:
    plan = Plan(room)
    whole = histogram.get(room, 0)
    if whole:
        plan.slots[room], plan.used[room] = np.array([[0, 0, 1, 0]]), whole
    sequences = whole
    lengths = np.array(sorted((x for x in histogram if x != room), reverse=True), np.int64)
    slots = {int(x): [] for x in lengths}
    used = {int(x): 0 for x in lengths}
    if len(lengths):
        demand = np.array([histogram[int(x)] for x in lengths], float)
        patterns, amounts = generate(lengths, demand, room)
        for pattern, amount in zip(patterns.astype(np.int64), np.floor(amounts + 1e-9).astype(np.int64)):
            if int(pattern @ lengths) != room:
                continue
            times = [amount, *((histogram[int(x)] - used[int(x)]) // a for x, a in zip(lengths, pattern) if a)]
            turns, offset = int(min(times)), 0
            if turns <= 0:
                continue
            for x, a in zip(lengths.tolist(), pattern.tolist()):
                if a:
                    slots[x].append((used[x], sequences, a, offset))
                    used[x] += a * turns
                    offset += a * x
            sequences += turns
    for x in used:
        if slots[x]:
            plan.slots[x], plan.used[x] = np.array(slots[x]), used[x]
        plan.line[x] = plan.total
        plan.total += (histogram[x] - used[x]) * x
    rest, cuts = plan.total % room, [plan.total - plan.total % room]
    while rest:
        power = 1 << (rest.bit_length() - 1)
        cuts.append(cuts[-1] + power)
        rest -= power
    plan.cuts, plan.first = np.array(cuts), sequences
    return plan


def pack(docs: DataFrame, vocabulary: str, end_id: int = 1, room: int = 2048) -> DataFrame:
    """The pieces of all documents and their places in sequences of at most ``room`` ids.

    Returns doc_id, start, length, ids (binary, little-endian 32 bits), ids_crc32,
    doc_tokens, sequence_id, offset, and row, which tells rows of one doc_id apart.
    Every id lies in one piece; all sequences have ``room`` ids but the last few,
    whose lengths are different powers of two, so nothing is padded. A NULL text
    is empty and gives ``end_id`` alone. Other columns are not read.

    One scan stages the pieces, numbered by partition and length; their counts
    alone make the ranks, and every place follows from length and rank, so no
    piece is shuffled unless the counts are too many to broadcast.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, row long, start long, length int, doc_tokens long, part int, nth long,"
        " ids binary, ids_crc32 long"
    )

    kinds = arrow_schema(schema)

    def cut(batches):
        seen: dict[int, int] = {}
        rows, part = 0, TaskContext.get().partitionId()
        for block, ids, bounds in encoded(batches, vocabulary, "text", end_id):
            out = []
            for doc, start, stop in zip(block["doc_id"].to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                at = start
                for length in cut_lengths(stop - start, room):
                    held = ids[at : at + length].astype("<u4").tobytes()
                    nth = seen.get(length, 0)
                    seen[length] = nth + 1
                    number = part << 33 | rows
                    out.append((doc, number, at - start, length, stop - start, part, nth, held, zlib.crc32(held)))
                    at += length
                rows += 1
            yield record_batch(out, kinds)

    cut_up = staged(docs.select("doc_id", "text").mapInArrow(cut, schema), "pieces")
    counts = staged(cut_up.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts")
    sums = counts.groupBy("length").agg(F.sum("n").alias("n"))  # at most 2 * GRID + 64 lengths
    plan = make_plan({r.length: r.n for r in sums.collect()}, room)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = cut_up.join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.col("nth"))
    out_schema = (
        f"doc_id {kind}, row long, start long, length int, ids binary, ids_crc32 long,"
        " doc_tokens long, sequence_id long, offset int"
    )
    out_kinds = arrow_schema(out_schema)
    names = ["doc_id", "row", "start", "length", "doc_tokens", "ids", "ids_crc32", "rank"]

    def place(batches):
        for batch in batches:
            out = []
            for doc, row, start, length, tokens, ids, crc, rank in zip(*(batch[c].to_pylist() for c in names)):
                for at, size, sequence, offset in plan.places(length, rank):
                    if size == length:
                        part, own = ids, crc
                    else:
                        part = ids[4 * at : 4 * (at + size)]
                        own = zlib.crc32(part)
                    out.append((doc, row, start + at, size, part, own, tokens, sequence, offset))
            yield record_batch(out, out_kinds)

    return ranked.select(*names).mapInArrow(place, out_schema)
