"""Repeated byte strings across documents, compared by suffix arrays built by linear grouping.

Every string of ``LENGTH`` bytes has an anchor, the least hash of its 64-byte
grams; equal strings have equal anchors at equal places. So the strings of an
anchor are compared with those of equal anchors only, in three steps that each
settle most of what is left:

1. contexts (all strings of one anchor in a document): equal ones repeat wholly;
2. ranges of 32 neighbouring strings that share the bytes in their middle, where
   contexts of an anchor differ: equal ranges repeat wholly;
3. ranges that differ: what lies left and right of the shared middle goes into a
   suffix array; equal strings are neighbours in it. Where very many ranges
   share one middle, its strings are grouped by content instead.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cauce.llm import pieces as P
from cauce.llm.common import arrow_schema, bucketed, record_batch, staged

#: Bytes of a gram whose hash chooses anchors.
GRAM = 64
#: Neighbouring strings of a range.
RANGE = 32
#: Ranges with one middle that are compared by a suffix array at once.
MOST = 1000
#: Bytes of a text whose hashes are held at once.
WINDOW = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1


def lyndon_groups(text: list[int]) -> tuple[list[int], list[int]]:
    """Groups of suffixes by their longest Lyndon prefix, and each one's previous smaller suffix.

    ``text`` ends in a unique least symbol. A group is named by the rank of its
    first suffix. Groups are taken from the highest to the lowest; the nearest
    earlier suffix of a lower group is a member's previous smaller one, and its
    Lyndon prefix grows by the group's: it moves to a new group right above its
    own, the higher the more members point to it.
    """
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place, group, end, prev = [0] * n, [0] * n, [0] * (n + 1), [-1] * n
    start = 0
    for i, s in enumerate(order):
        if text[s] != text[order[start]]:
            end[start] = i
            start = i
        place[s], group[s] = i, start
    end[start] = n
    top = n
    while top > 0:
        start = group[order[top - 1]]
        pointed: dict[int, int] = {}
        for s in sorted(order[start:top]):
            p = s - 1
            while p >= 0 and group[p] >= start:
                p = prev[p]
            prev[s] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        by_count: dict[int, list[int]] = {}
        for p, count in pointed.items():
            by_count.setdefault(count, []).append(p)
        for count in sorted(by_count, reverse=True):
            cut: dict[int, int] = {}
            for p in by_count[count]:
                g = group[p]
                last = cut.get(g, end[g]) - 1
                cut[g] = last
                other, at = order[last], place[p]
                order[at], order[last] = other, p
                place[other], place[p] = at, last
            for p in by_count[count]:
                group[p] = cut[group[p]] if group[p] in cut and place[p] >= cut[group[p]] else group[p]
            for g, new in cut.items():
                end[new] = end[g]
                if new != g:
                    end[g] = new
        top = start
    return group, prev


def suffix_array(text: list[int]) -> list[int]:
    """Starts of the suffixes of ``text`` in order; ``text`` ends in a unique least symbol."""
    group, prev = lyndon_groups(text)
    n = len(text)
    found, free = [0] * n, list(range(n))
    found[0] = n - 1
    done = bytearray(n)
    done[n - 1] = 1
    for i in range(n):
        s = found[i] - 1
        while s >= 0 and not done[s]:
            g = group[s]
            found[free[g]] = s
            free[g] += 1
            done[s] = 1
            s = prev[s]
    return found


def repeated(sides: list[tuple[bytes, bytes, int]]) -> list[np.ndarray]:
    """For ranges (left, right, middle): which of their strings occur in another one too.

    The i-th string of a range has all but i bytes of a full left side, the
    middle, and i bytes of the right side.
    """
    text, starts = [], []
    for left, right, middle in sides:
        starts.append(len(text))
        text += [b + 2 for b in left]
        text.append(258 + middle)
        text += [b + 2 for b in right]
        text.append(1)
    text.append(0)
    order = np.array(suffix_array(text))
    padded = np.array(text + [0] * RANGE, np.int64)
    rows = np.lib.stride_tricks.sliding_window_view(padded, RANGE)
    same = np.zeros(len(order), bool)
    for at in range(0, len(order) - 1, 4096):
        pair = order[at : at + 4097]
        same[at : at + len(pair) - 1] = (rows[pair[1:]] == rows[pair[:-1]]).all(axis=1)
    equal = np.zeros(len(order), bool)
    equal[order] = same | np.append(False, same[:-1])
    out = []
    for start, (left, right, _) in zip(starts, sides):
        held = np.zeros(RANGE, bool)
        # String i starts at left's byte i - (RANGE - 1 - len(left)) and needs i bytes on the right.
        first = RANGE - 1 - len(left)
        i = np.arange(first, min(len(right), RANGE - 1) + 1)
        held[i] = equal[start + i - first]
        out.append(held)
    return out


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    n = len(data) - GRAM + 1
    powers = np.cumprod(np.full(len(data), _BASE, np.uint64))
    inverse = np.cumprod(np.full(n, pow(_BASE, -1, 1 << 64), np.uint64))
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers)])
    hashes = (sums[GRAM:] - sums[:-GRAM]) * inverse
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    return hashes ^ (hashes >> np.uint64(29))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    n = len(values) - width + 1
    full = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    full[: len(values)] = values
    parts = full.reshape(-1, width)
    ahead = np.minimum.accumulate(parts, axis=1).ravel()
    back = np.minimum.accumulate(parts[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(
    data: np.ndarray, length: int, window: int | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor, first start, last start, hash) of runs of strings with one anchor, by blocks of the text.

    A run that goes on in the next block is given in parts, one from each block.
    """
    window = window or WINDOW
    strings = len(data) - length + 1
    for block in range(0, strings, window):
        part = data[block : min(block + window, strings) + length - 1]
        hashes = _gram_hashes(part)
        # The leftmost of equal hashes: the low bits are the place.
        marked = (hashes >> np.uint64(21) << np.uint64(21)) | np.arange(len(hashes), dtype=np.uint64)
        at = (_least(marked, length - GRAM + 1) & np.uint64((1 << 21) - 1)).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
        last = np.append(first[1:], len(at)) - 1
        yield at[first] + block, first + block, last + block, hashes[at[first]]


def _contexts(docs: DataFrame, length: int) -> DataFrame:
    """(row, gram, context, lead, width, firsts) of the distinct contexts of each row.

    A context lies at every start in ``firsts``, its anchor ``lead`` bytes and its
    last string ``width`` bytes further on. Text that repeats in itself has few rows.
    """
    schema = "row long, gram long, context binary, lead int, width int, firsts array<int>"
    kinds = arrow_schema(schema)

    def scan(batches):
        for block in P.blocks(batches, "text"):
            offsets, data = P.text_bytes(block["text"])
            found = []
            for row, start, stop in zip(block["row"].to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                held = memoryview(data[start:stop])
                parts = anchors(data[start:stop], length, WINDOW) if stop - start >= length else ()
                own: dict[tuple[int, bytes], tuple[int, int, list[int]]] = {}
                for at, first, last, hashes in parts:
                    grams = hashes.view(np.int64).tolist()
                    for a, i, j, gram in zip(at.tolist(), first.tolist(), last.tolist(), grams):
                        digest = xxhash.xxh3_128(held[i : j + length], seed=a - i).digest()
                        own.setdefault((gram, digest), (a - i, j - i, []))[2].append(i)
                found += [(row, *key, *value) for key, value in own.items()]
            if found:
                yield record_batch(found, kinds)

    return staged(docs.select("row", "text").mapInArrow(scan, schema), "contexts")


def _ranges(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(row, start, middle, left, right) of the ranges of the ``wanted`` contexts.

    start is that of the range's first string, which may lie before the text.
    """
    schema = "row long, start int, middle binary, left binary, right binary"
    kinds = arrow_schema(schema)

    def cut(batches):
        for block in P.blocks(batches, "text"):
            offsets, data = P.text_bytes(block["text"])
            for row, begin, stop, runs in zip(
                block["row"].to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), block["runs"].to_pylist()
            ):
                held = data[begin:stop].tobytes()
                out = []
                # Parts of a run share the range at their border, which is one range all the same.
                own = {
                    (run["anchor"], g)
                    for run in runs
                    for g in range((run["anchor"] - run["last"]) // RANGE, (run["anchor"] - run["first"]) // RANGE + 1)
                }
                for a, g in sorted(own):
                    final = a - RANGE * g
                    start = final - RANGE + 1
                    digest = xxhash.xxh3_128(held[final : start + length], seed=g).digest()
                    left = held[max(start, 0) : final]
                    out.append((row, start, digest, left, held[start + length : final + length]))
                yield record_batch(out, kinds)

    runs = wanted.groupBy("row").agg(F.collect_list(F.struct("anchor", "first", "last")).alias("runs"))
    texts = docs.select("row", "text").join(runs, "row")
    return staged(texts.mapInArrow(cut, schema), "ranges")


def _differing(folded: DataFrame) -> DataFrame:
    """(row, start, i) of strings that repeat, of ranges (row, start, middle, left, right)."""

    def compare(batches):
        held = None
        for batch in batches:
            held = batch if held is None else pa.concat_batches([held, batch])
            middles = held["middle"].to_pylist()
            whole = len(middles)
            while whole and middles[whole - 1] == middles[-1]:
                whole -= 1
            if whole:
                yield from found(held.slice(0, whole), middles)
                held = held.slice(whole)
        if held is not None and held.num_rows:
            yield from found(held, held["middle"].to_pylist())

    def found(batch, middles):
        lefts, rights = batch["left"].to_pylist(), batch["right"].to_pylist()
        bounds = [0, *(i for i in range(1, batch.num_rows) if middles[i] != middles[i - 1]), batch.num_rows]
        flags, todo, size = [], [], 0
        for number, (a, b) in enumerate(zip(bounds, bounds[1:])):
            todo += [(lefts[i], rights[i], number) for i in range(a, b)]
            if len(todo) >= MOST or b == batch.num_rows:
                flags += repeated(todo)
                todo = []
        place, i = np.nonzero(np.array(flags))
        rows, starts = (batch[c].to_numpy()[place] for c in ("row", "start"))
        yield pa.record_batch([pa.array(rows), pa.array(starts), pa.array(i, pa.int32())], ["row", "start", "i"])

    # A number of partitions keeps Spark from putting small ones together: their bytes say little of the work.
    n = int(folded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = folded.repartition(n, "middle").sortWithinPartitions("middle")
    return spread.mapInArrow(compare, "row long, start int, i int")


def repeated_strings(docs: DataFrame, length: int = 400) -> DataFrame:
    """(row, first, last): starts of strings of ``length`` bytes that start anywhere else as well.

    ``docs`` has row and text; row tells its rows apart. Intervals may overlap.
    """
    contexts = _contexts(docs, length)
    first = F.col("firsts")[0]
    one = F.struct("row", (first + F.col("lead")).alias("anchor"), first.alias("first"), (first + F.col("width")).alias("last"))
    classes = contexts.groupBy("gram", "context").agg(F.sum(F.size("firsts")).alias("n"), F.min(one).alias("one"))
    classes = staged(classes, "context-classes")
    copied = classes.filter("n > 1").select("gram", "context")
    whole = contexts.join(copied, ["gram", "context"], "left_semi")
    whole = whole.select("row", "width", F.explode("firsts").alias("first"))
    whole = whole.select("row", "first", (F.col("first") + F.col("width")).alias("last"))

    mixed = staged(classes.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram"), "mixed")
    ranges = _ranges(docs, classes.join(mixed, "gram", "left_semi").select("one.*"), length)
    key = ["middle", "left", "right"]
    folds = ranges.groupBy(*key).agg(F.count("*").alias("n"), F.min(F.struct("row", "start")).alias("one"))
    folds = staged(folds, "folds")
    same = ranges.join(folds.filter("n > 1").select(*key), key, "left_semi")
    size = F.length("right")
    # Only strings that lie within the text.
    same = same.select("row", F.greatest("start", F.lit(0)).alias("first"), (F.col("start") + size).alias("last"))

    counts = staged(folds.groupBy("middle").agg(F.count("*").alias("ranges")).filter("ranges > 1"), "range-counts")
    differ = staged(folds.join(counts, "middle").select("one.*", *key, "n", "ranges"), "differing")
    few = _differing(differ.filter(F.col("ranges") <= MOST).select("row", "start", *key, "n"))
    few = few.select("row", (F.col("start") + F.col("i")).alias("first"))

    # Too many for one suffix array: string by string. The i-th one needs the
    # bytes of the left side from i on, and i bytes of the right side.
    many = differ.filter(F.col("ranges") > MOST)
    i = F.explode(F.sequence(F.lit(RANGE - 1) - F.length("left"), F.length("right")))
    strings = many.select("row", "start", *key, "n", i.alias("i"))
    own = F.expr(f"substring(left, i - ({RANGE - 1} - length(left)) + 1)")
    strings = strings.select("row", "start", "i", "middle", own.alias("l"), F.expr("substring(right, 1, i)").alias("r"))
    strings = staged(strings, "strings")
    twice = strings.groupBy("middle", "i", "l", "r").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    twice = strings.join(twice, ["middle", "i", "l", "r"], "left_semi")
    twice = twice.select("row", (F.col("start") + F.col("i")).alias("first"))
    single = few.union(twice).select("row", "first", F.col("first").alias("last"))
    return whole.union(same).union(single)


def remove_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept (binary) and kept_sha256.

    Every byte covered by a string of ``length`` bytes that also starts anywhere
    else goes, judged on the input. Texts are UTF-8; NULL is empty; matches stay
    within a text. Repeated rows are copies of each other, so both lose what is
    long enough. Whole texts of any length are searched. Other columns are not read.
    """
    texts = bucketed(docs.select("doc_id", "text"), "row")
    spans = repeated_strings(texts, length).distinct()
    spans = spans.groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    kinds = arrow_schema(schema)

    def remove(batches):
        for block in P.blocks(batches, "text"):
            offsets, data = P.text_bytes(block["text"])
            out = []
            for doc, start, stop, found in zip(
                block["doc_id"].to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), block["spans"].to_pylist()
            ):
                edges = np.zeros(stop - start + 1, np.int64)
                for span in found or ():
                    edges[span["first"]] += 1
                    edges[span["last"] + length] -= 1
                gone = np.cumsum(edges[:-1]) > 0
                runs = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
                kept = data[start:stop][~gone].tobytes()
                digest = hashlib.sha256(kept).hexdigest()
                out.append((doc, stop - start, int(gone.sum()), runs, kept, digest))
            yield record_batch(out, kinds)

    joined = texts.join(spans, "row", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(remove, schema)
