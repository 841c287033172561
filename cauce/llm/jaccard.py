"""Documents with similar sets of word n-grams: prefix filtering, verified once per pair.

Shingles are ordered rare first. Two similar sets share one of their first
shingles (prefix), have similar sizes (length), meet early enough (position), and
differ in few of the bits that shingles flip (suffix); only pairs that pass are
compared.

The order begins with shingles of a part of all hashes, twice as large as a
prefix needs; only those are counted exactly, by document. Most occur in one
document and leave at once: a prefix of nothing else has no partner. Shingles that
a table of counts of fixed size shows as common come last in the order, so that
no counted group is a large share of the data.

Pairs of one posting list are not all emitted. Neighbours in it, by size, are
compared first; what they link is one component. Then members of lists that hold
several components are sorted by their marks, in a different order in each list, so
that similar sets come close to each other, and those near by are compared. Only pairs
of components that are still different are left for the last pass.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cauce.llm import pieces as P
from cauce.llm.common import arrow_schema, bucketed, free_name, in_buckets, record_batch, staged
from cauce.llm.components import components

#: Buckets of the table of frequencies, by the top bits of a shingle's hash.
BUCKET_BITS = 16
#: A bucket with so many times the mean holds a common shingle.
COMMON = 4
#: Fewest bits of a set's marks for the suffix filter; each shingle flips one of them.
MARK_BITS = 1024
#: 64-bit words of marks that go along with the members of posting lists.
FIRST_MARKS = 8
#: Members before one that it is compared with, in the order of a list by marks.
NEAR_BY = 8
#: Odd multipliers for the words of a shingle.
_ODD = np.random.RandomState(9).randint(0, 1 << 62, 4096).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _ODD[0]
    return values ^ (values >> np.uint64(29))


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's word n-grams.

    A-Z count as a-z. Fewer words than ``size`` give the whole sequence as one;
    no words, an empty text and NULL give an empty set.
    """
    offsets, data = P.text_bytes(column)
    upper = (data >= 65) & (data <= 90)
    bounds, held, first = P.words(offsets, np.where(upper, data | 32, data))
    codes, known = P.distinct(bounds, held)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in known], np.uint64)[codes]
    n = max(len(hashes) - size + 1, 0)
    rolled = np.zeros(n, np.uint64)
    for i in range(size):
        rolled += hashes[i : n + i] * _ODD[i + 1]
    rolled = _mixed(rolled)
    sets = []
    for start, stop in zip(first[:-1].tolist(), first[1:].tolist()):
        if stop - start >= size:
            sets.append(np.unique(rolled[start : stop - size + 1]))
        elif stop > start:
            whole = (hashes[start:stop] * _ODD[1 : stop - start + 1]).sum(dtype=np.uint64)
            sets.append(_mixed(np.array([whole + np.uint64(stop - start)], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def set_marks(held: np.ndarray) -> np.ndarray:
    """The bits that an odd number of elements falls on, packed: two to four bits per element."""
    bits = max(MARK_BITS, 1 << (2 * len(held)).bit_length())
    return np.packbits(np.bincount((held % np.uint64(bits)).astype(np.int64), minlength=bits).astype(np.uint8) & 1)


def folded(marks: np.ndarray, size: int) -> np.ndarray:
    """The marks of the same set in ``size`` bytes, fewer than it has."""
    return np.bitwise_xor.reduce(marks.reshape(-1, size), axis=0)


def _described(docs: DataFrame, size: int) -> tuple[DataFrame, np.ndarray]:
    """Per row: size, signature and marks of its set. And how many shingles fall into each bucket."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {kind}, n int, sign binary, marks binary, first_marks array<long>, bucket int, often long"
    kinds = arrow_schema(schema)

    def describe(batches):
        P.forget()
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for block in P.blocks(batches, "text"):
            out = []
            sets = shingle_sets(block["text"], size)
            total += np.bincount((np.concatenate(sets) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), minlength=len(total))
            for row, doc, held in zip(block["row"].to_pylist(), block["doc_id"].to_pylist(), sets):
                n = len(held)
                if not n:
                    out.append((row, doc, 0, None, None, [], None, None))
                    continue
                marks = set_marks(held)
                sign = xxhash.xxh3_128_digest(held.tobytes())
                first = folded(marks, FIRST_MARKS * 8).view(np.int64)
                out.append((row, doc, n, sign, marks.tobytes(), first, None, None))
            yield record_batch(out, kinds)
        found = np.flatnonzero(total)
        if len(found):
            none = [pa.nulls(len(found), f.type) for f in list(kinds)[:6]]
            yield pa.RecordBatch.from_arrays([*none, pa.array(found, pa.int32()), pa.array(total[found])], schema=kinds)

    both = staged(docs.select("row", "doc_id", "text").mapInArrow(describe, schema), "described")
    total = np.zeros(1 << BUCKET_BITS, np.int64)
    sums = both.filter("row is null").groupBy("bucket").agg(F.sum("often").alias("n")).toArrow()  # at most the table's size
    total[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return both.filter("row is not null").drop("bucket", "often"), total


def _prefixes(docs: DataFrame, classes: DataFrame, total: np.ndarray, size: int, num: int, den: int) -> DataFrame:
    """(cls, n, pos, shingle): what a set's prefix shares with other sets, in the order of all shingles.

    First come the rare shingles of a part of all hashes, by their exact number of
    sets; then the other rare ones by hash; then common ones by their bucket.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = 4 * parts
    common = total > COMMON * max(total.sum() / len(total), 1)
    sent = spark.sparkContext.broadcast((total, common))
    # 2.25 times the share that a prefix is of its set, of 2**16.
    counted = np.uint64(min(int(2.25 * (den - num) / den * (1 << 16)), 1 << 16))

    def spread(batches):
        P.forget()
        often, is_common = sent.value
        for block in P.blocks(batches, "text"):
            rows, hashes, sizes = [], [], []
            for row, held in zip(block["row"].to_pylist(), shingle_sets(block["text"], size)):
                n = len(held)
                if not n:
                    continue
                place = (held >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
                late = is_common[place]
                first = ~late & ((held & np.uint64(0xFFFF)) < counted)
                length = n - (num * n + den - 1) // den + 1
                own = held[first]
                size_ = np.full(len(own), len(own))
                if len(own) < length:
                    # Sorted by hash already; a stable order by class and bucket keeps it so.
                    rest, at = held[~first], place[~first]
                    rest = rest[np.argsort(np.where(late[~first], often[at] + 1, 0), kind="stable")[: length - len(own)]]
                    own = np.concatenate([own, rest])
                    # Below zero: the place in the order is known.
                    size_ = np.concatenate([size_, -1 - np.arange(len(size_), length)])
                rows.append(np.full(len(own), row))
                hashes.append(own)
                sizes.append(size_)
            if not rows:
                continue
            rows, hashes, sizes = (np.concatenate(x) for x in (rows, hashes, sizes))
            # What needs no count may go anywhere.
            bucket = np.where(sizes < 0, rows % buckets, (hashes >> np.uint64(16)).astype(np.int64) % buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            held = [x[order] for x in (rows.astype("<i8"), hashes.astype("<u8"), sizes.astype("<i4"))]
            some = np.flatnonzero(np.diff(cuts))
            bytes_ = [[x[cuts[i] : cuts[i + 1]].tobytes() for i in some.tolist()] for x in held]
            yield pa.record_batch([pa.array(some, pa.int32()), *(pa.array(x, pa.binary()) for x in bytes_)], ["bucket", "rows", "hashes", "sizes"])

    def shared(batches):
        bucket, held = None, []

        def found():
            rows, hashes, sizes = (np.concatenate([np.frombuffer(x, t) for x in c]) for c, t in zip(zip(*held), ("<i8", "<u8", "<i4")))
            order = np.argsort(hashes, kind="stable")
            rows, hashes, sizes = rows[order], hashes[order], sizes[order]
            first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
            often = np.repeat(np.diff(np.append(first, len(hashes))), np.diff(np.append(first, len(hashes))))
            kept = (often > 1) | (sizes < 0)
            columns = rows[kept], hashes[kept].view(np.int64), often[kept].astype(np.int32), sizes[kept].astype(np.int32)
            return pa.record_batch([pa.array(c) for c in columns], ["cls", "shingle", "often", "size"])

        for batch in batches:
            for b, *values in zip(*(batch[c].to_pylist() for c in ("bucket", "rows", "hashes", "sizes"))):
                if b != bucket and held:
                    yield found()
                    held = []
                bucket = b
                held.append(values)
        if held:
            yield found()

    own = classes.select(F.col("cls").alias("row"))
    texts = docs.select("row", "text").join(own, "row", "left_semi")
    entries = texts.mapInArrow(spread, "bucket int, rows binary, hashes binary, sizes binary")
    spread_out = entries.repartition(parts, "bucket").sortWithinPartitions("bucket")
    found = staged(spread_out.mapInArrow(shared, "cls long, shingle long, often int, size int"), "shared")
    col = F.col
    known = found.filter("size < 0").select("cls", "shingle", (-1 - col("size")).alias("pos"))
    rank = F.row_number().over(Window.partitionBy("cls").orderBy("often", "shingle"))
    # Those of one set alone come before all that are left.
    alone = col("size") - F.count("*").over(Window.partitionBy("cls"))
    ranked = found.filter("size >= 0").select("cls", "shingle", (alone + rank - 1).cast("int").alias("pos"))
    lists = ranked.unionByName(known).join(classes.select("cls", "n"), "cls")
    length = col("n") - F.ceil(num * col("n") / den) + 1
    return lists.filter(col("pos") < length).select("cls", "n", "pos", "shingle")


def _postings(lists: DataFrame, num: int, den: int) -> DataFrame:
    """Members of posting lists that have a neighbour of similar size, each with the one before it.

    A list is sorted by size, so who has no such neighbour has no such partner
    in it at all. Tasks hold ranges of (shingle, size, id), so a long list is
    spread over several; members at the ends of a range are always given.
    """
    names = ["shingle", "n", "cls", "pos"]
    schema = "shingle long, n int, cls long, pos int, prev_n int, prev_cls long, prev_pos int"

    def neighbour(rows):
        sizes = rows[1].astype(np.int64)
        return (rows[0][1:] == rows[0][:-1]) & (den * sizes[:-1] >= num * sizes[1:])

    def given(rows, before, first, last):
        """All rows but the last, which waits for its successor unless it is the ``last`` of all.

        ``before`` is the row before the first one if it is a neighbour of similar size.
        """
        equal = neighbour(rows)
        lone = np.concatenate([[before is None], ~equal])
        wanted = ~lone | np.append(equal, last)
        wanted[0] |= first
        wanted[-1] &= last
        if wanted.any():
            columns = [pa.array(c[wanted]) for c in rows]
            for i, c in enumerate(rows[1:], 1):
                prev = np.concatenate([c[:1] if before is None else before[i], c[:-1]])
                columns.append(pa.array(prev[wanted], mask=lone[wanted]))
            yield pa.record_batch(columns, [*names, "prev_n", "prev_cls", "prev_pos"])

    def neighbours(batches: Iterator[pa.RecordBatch]):
        rows, before, first = None, None, True
        for batch in batches:
            found = [batch[c].to_numpy() for c in names]
            rows = found if rows is None else [np.concatenate(x) for x in zip(rows, found)]
            if len(rows[0]) > 1:
                yield from given(rows, before, first, False)
                before = [c[-2:-1] for c in rows] if neighbour([c[-2:] for c in rows])[0] else None
                rows, first = [c[-1:] for c in rows], False
        if rows is not None and len(rows[0]):
            yield from given(rows, before, first, True)

    spread = lists.select(*names).repartitionByRange("shingle", "n", "cls")
    ordered = spread.sortWithinPartitions("shingle", "n", "cls")
    return staged(ordered.mapInArrow(neighbours, schema), "postings")


def _passes(n_a, n_b, pos_a, pos_b, num: int, den: int):
    """Length and position filter."""
    least = F.least(n_a - pos_a, n_b - pos_b) + F.least(pos_a, pos_b)
    similar = (den * F.least(n_a, n_b) >= num * F.greatest(n_a, n_b))
    return similar & ((num + den) * least >= num * (n_a + n_b))


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int, num: int, den: int):
    """The pairs (a, b) whose sets are similar; only sets of pairs that pass the suffix filter move."""

    def marked(side):
        return classes.select(F.col("cls").alias(side), F.col("n").alias(f"n_{side}"), F.col("marks").alias(f"marks_{side}"))

    def differ_little(batches):
        for batch in batches:
            keep = []
            columns = (batch[c].to_pylist() for c in ("n_a", "n_b", "marks_a", "marks_b"))
            for n_a, n_b, *marks in zip(*columns):
                x, y = (np.frombuffer(m, np.uint8) for m in marks)
                least = min(len(x), len(y))
                bits = int(np.bitwise_count(folded(x, least) ^ folded(y, least)).sum())
                # Sets that differ in more bits differ in more shingles than similar ones do.
                keep.append((num + den) * bits <= (den - num) * (n_a + n_b))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    near = pairs.join(marked("a"), "a").join(marked("b"), "b")
    near = staged(near.mapInArrow(differ_little, "a long, b long"), "near")
    ends = near.select(F.col("a").alias("row")).union(near.select("b")).distinct()

    def sets(batches):
        for block in P.blocks(batches, "text"):
            held = [x.tobytes() for x in shingle_sets(block["text"], size)]
            yield pa.record_batch([block["row"], pa.array(held, pa.binary())], ["row", "held"])

    texts = docs.select("row", "text").join(ends, "row", "left_semi")
    found = staged(texts.mapInArrow(sets, "row long, held binary"), "sets")

    def compare(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch["held_a"], batch["held_b"]):
                a, b = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(den * both >= num * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def side(name):
        return found.select(F.col("row").alias(name), F.col("held").alias(f"held_{name}"))

    both = near.join(side("a"), "a").join(side("b"), "b").select("a", "b", "held_a", "held_b")
    return staged(both.mapInArrow(compare, "a long, b long"), "similar")


def _pairs(rows: DataFrame, a: str, b: str) -> DataFrame:
    return rows.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))


def _differ_little(a: str, b: str, names: list[str], num: int, den: int):
    """Whether the short marks of two sets differ as little as those of similar ones do."""
    bits = [F.bit_count(F.col(f"{a}.{name}").bitwiseXOR(F.col(f"{b}.{name}"))) for name in names]
    return (num + den) * sum(bits[1:], bits[0]) <= (den - num) * (F.col(f"{a}.n") + F.col(f"{b}.n"))


def _owned(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of lists that hold several components, with their component's root."""
    owned = members.join(roots.select(F.col("id").alias("cls"), "root"), "cls", "left")
    owned = staged(owned.withColumn("root", F.coalesce("root", "cls")), "rooted")
    mixed = owned.groupBy("shingle").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y")
    return owned.join(staged(mixed.select("shingle"), "mixed"), "shingle", "left_semi")


def _near_by(members: DataFrame, names: list[str], num: int, den: int) -> DataFrame:
    """Pairs (a, b) of different components whose members come close in a list's order by marks.

    The order turns the bits of one of the marks, by shingle: sets that differ
    in few bits often agree in the first ones. Every member has at most
    ``NEAR_BY`` pairs in a list; pairs over the ends of a task's range are left out.
    """
    fields = ["shingle", "cls", "root", "n", "pos", *names]

    def close(batches):
        before = None
        for batch in batches:
            rows = [batch[c].to_numpy() for c in fields]
            rows = rows if before is None else [np.concatenate(x) for x in zip(before, rows)]
            fresh = 0 if before is None else len(before[0])
            shingle, cls, root, n, pos = rows[:5]
            marks = np.stack(rows[5:])
            n, pos = n.astype(np.int64), pos.astype(np.int64)
            found = []
            for step in range(1, NEAR_BY + 1):
                i = np.arange(max(fresh, step), len(cls))
                j = i - step
                keep = (shingle[i] == shingle[j]) & (root[i] != root[j])
                i, j = i[keep], j[keep]
                least = np.minimum(n[i] - pos[i], n[j] - pos[j]) + np.minimum(pos[i], pos[j])
                keep = den * np.minimum(n[i], n[j]) >= num * np.maximum(n[i], n[j])
                keep &= (num + den) * least >= num * (n[i] + n[j])
                i, j = i[keep], j[keep]
                bits = np.bitwise_count(marks[:, i] ^ marks[:, j]).sum(axis=0, dtype=np.int64)
                keep = (num + den) * bits <= (den - num) * (n[i] + n[j])
                found.append(np.stack([cls[i[keep]], cls[j[keep]]]))
            before = [c[-NEAR_BY:] for c in rows]
            pairs = np.unique(np.sort(np.concatenate(found, axis=1), axis=0), axis=1)
            yield pa.record_batch([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    drawn = F.xxhash64("shingle")
    word = F.get(F.array(*names), F.pmod(drawn, F.lit(len(names))).cast("int"))
    turned = members.withColumns({"word": word, "by": F.pmod(F.shiftright(drawn, 8), F.lit(64)).cast("int")})
    turned = turned.withColumn("order", F.expr("shiftleft(word, by) | shiftrightunsigned(word, 64 - by)"))
    spread = turned.select("order", *fields).repartitionByRange("shingle", "order", "cls")
    ordered = spread.sortWithinPartitions("shingle", "order", "cls").select(*fields)
    return staged(ordered.mapInArrow(close, "a long, b long").distinct(), "near-by")


def similar_documents(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Per row of (row, doc_id, text): n_shingles, component_id and kept.

    Two rows link when den * |intersection| >= num * |union| of their sets of
    word n-grams. component_id is the smallest doc_id reachable by links, the
    own one included; the row that has it is kept (of several the smallest row;
    a NULL doc_id comes last). Rows without words link with nothing. Equal sets
    are one class; links are verified between classes. ``docs`` must read the
    same each time, from files; row tells its rows apart.
    """
    described, total = _described(docs, size)
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    signs = described.filter("n > 0").groupBy("sign").agg(F.min("row").alias("cls"), F.min(first).alias("first"))
    signs = staged(signs, "classes")
    classes = described.select(F.col("row").alias("cls"), "n", "marks", "first_marks")
    # In buckets of cls, so that pairs find the marks of their ends without moving them all.
    classes = in_buckets(classes.join(signs.select("cls"), "cls"), "cls")
    postings = _postings(_prefixes(docs, classes, total, size, num, den), num, den)

    col = F.col
    chain = postings.filter("prev_cls is not null").filter(
        _passes(col("n"), col("prev_n"), col("pos"), col("prev_pos"), num, den)
    )
    tried = staged(_pairs(chain, "cls", "prev_cls").distinct(), "tried")
    links = _verified(tried, classes, docs, size, num, den)
    roots = staged(components(links), "roots")

    owned = staged(_owned(postings.select("shingle", "n", "cls", "pos"), roots), "owned")
    names = [f"mark_{i}" for i in range(FIRST_MARKS)]
    marks = classes.select("cls", *[col("first_marks")[i].alias(name) for i, name in enumerate(names)])
    owned = staged(owned.join(marks, "cls"), "owned")
    close = staged(_near_by(owned, names, num, den).join(tried, ["a", "b"], "left_anti"), "close")
    links = links.union(_verified(close, classes, docs, size, num, den))
    tried = tried.union(close)
    roots = staged(components(links), "roots")
    owned = staged(_owned(owned.drop("root"), roots), "owned")

    a, b = owned.alias("a"), owned.alias("b")
    cross = a.join(
        b,
        (col("a.shingle") == col("b.shingle"))
        & (col("a.cls") < col("b.cls"))
        & (col("a.root") != col("b.root"))
        & _passes(col("a.n"), col("b.n"), col("a.pos"), col("b.pos"), num, den)
        & _differ_little("a", "b", names, num, den),
    ).select(col("a.cls").alias("a"), col("b.cls").alias("b"))
    cross = staged(cross.distinct(), "cross").join(tried, ["a", "b"], "left_anti")
    links = links.union(_verified(cross, classes, docs, size, num, den))
    roots = staged(components(links), "roots")

    rooted = signs.join(roots.select(col("id").alias("cls"), "root"), "cls", "left")
    rooted = staged(rooted.withColumn("root", F.coalesce("root", "cls")), "rooted")
    tops = staged(rooted.groupBy("root").agg(F.min("first").alias("top")), "tops")
    member = staged(rooted.join(tops, "root").select("sign", "top"), "members")
    joined = described.select("row", "doc_id", "n", "sign").join(member, "sign", "left")
    alone = col("top").isNull()
    return joined.select(
        "row",
        "doc_id",
        col("n").cast("long").alias("n_shingles"),
        F.when(alone, col("doc_id")).otherwise(col("top.doc_id")).alias("component_id"),
        (alone | (col("top.row") == col("row"))).alias("kept"),
    )


def numbered(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text) of ``docs``, written once."""
    return bucketed(docs.select("doc_id", "text"), "row")


def drop_similar(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one row of each component of similar texts; all columns stay."""
    row = free_name(docs, "row")
    rows = bucketed(docs, row)
    found = similar_documents(rows.select(F.col(row).alias("row"), "doc_id", "text"), size, num, den)
    dropped = staged(found.filter(~F.col("kept")).select(F.col("row").alias(row)), "dropped")
    return rows.join(dropped, row, "left_anti").drop(row)
