"""Exact, near and partial duplicates against brute force."""

import collections
import hashlib
import pathlib
import random
import re

import numpy as np
import pytest

from cauce.llm import components, jaccard, recipes, suffixes, vectors

SCHEMA = "doc_id long, text string, `row` string, recipe int, sign int"


def table(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "r", 1, 2) for i, t in zip(ids, texts)], SCHEMA)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def roots(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return [find(i) for i in range(n)]


# Exact copies


def copies():
    rng = random.Random(1)
    long = prose(rng, 4000)
    return [long, long.replace(" ", "\n\t"), long + "x", "a b", "a  b", " a b", None, "", "\n", " ", "日本" * 3000, "日本" * 3000, "z" * 9000]


def test_exact_duplicates(spark):
    texts = copies()
    norm = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for t in texts]
    rows = {r.doc_id: r for r in recipes.exact_duplicates(table(spark, texts)).collect()}
    for i, text in enumerate(norm):
        same = [j for j, other in enumerate(norm) if other == text]
        r = rows[i]
        assert (r.keep_id, r.group_size, r.kept) == (same[0], len(same), same[0] == i)
        assert r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_drop_copies_with_repeated_and_null_ids(spark):
    docs = table(spark, ["a", "a", "b", "b", "c"], [3, 3, None, 9, None])
    kept = recipes.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.text, r.doc_id) for r in kept.collect() if r.text != "c") == [("a", 3), ("b", 9)]
    assert kept.count() == 3 and recipes.drop_copies(docs.limit(0)).count() == 0


def test_digests_of_two_chunks_do_not_join_texts(spark, monkeypatch):
    """With a digest that is the same for all chunks, the texts' own checksums decide."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(recipes.F, "xxhash64", lambda *c: F.lit(1).cast("long"))
    texts = ["one", "two", "two", "three"]
    rows = {r.doc_id: r.keep_id for r in recipes.exact_duplicates(table(spark, texts)).collect()}
    assert rows == {0: 0, 1: 1, 2: 1, 3: 3}


# Similar sets


def similar(texts, size, num, den):
    sets = []
    for text in texts:
        words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        whole = [tuple(words)] if words else []
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or set(whole))
    links = [
        (i, j)
        for j in range(len(sets))
        for i in range(j)
        if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])
    ]
    return [len(s) for s in sets], roots(len(sets), links)


def near_texts():
    rng = random.Random(2)
    texts = [None, "", " ", "One", "one", "two words", "Two  WORDS", "two words more", "é É"]
    for _ in range(6):
        base = prose(rng, rng.randint(30, 200))
        texts.append(base)
        for _ in range(rng.randint(1, 12)):
            words = base.split()
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(50)}"
            texts.append(" ".join(words))
    texts += [prose(rng, 80, 12) for _ in range(15)]
    return texts


@pytest.mark.parametrize(("size", "num"), [(3, 90), (5, 80), (2, 60)])
def test_similar_documents(spark, size, num):
    texts = near_texts()
    docs = jaccard.numbered(table(spark, texts))
    rows = {r.doc_id: r for r in jaccard.similar_documents(docs, size, num, 100).collect()}
    sizes, root = similar(texts, size, num, 100)
    assert [rows[i].n_shingles for i in range(len(texts))] == sizes
    assert [rows[i].component_id for i in range(len(texts))] == root
    assert [rows[i].kept for i in range(len(texts))] == [r == i for i, r in enumerate(root)]


def test_few_pairs_of_a_large_group_are_left_for_the_last_pass(spark, monkeypatch):
    """Near copies whose neighbours by size are seldom similar: no pass takes pairs by the square of the group."""
    rng = random.Random(4)
    base, texts = prose(rng, 300, 10**6).split(), []
    for i in range(200):
        words = list(base)
        for at in rng.sample(range(300), 3 if i % 8 else 2):
            words[at] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    sizes = {}

    def counted(df, label, staged=jaccard.staged):
        found = staged(df, label)
        sizes[label] = sizes.get(label, 0) + found.count()
        return found

    monkeypatch.setattr(jaccard, "staged", counted)
    found = jaccard.similar_documents(jaccard.numbered(table(spark, texts)), 3, 90, 100)
    root = similar(texts, 3, 90, 100)[1]
    assert {r.doc_id: r.component_id for r in found.collect()} == dict(enumerate(root))
    assert sizes["cross"] < 4 * len(texts)
    assert sizes.get("close", 0) <= jaccard.NEAR_BY * sizes["postings"]


def test_drop_similar(spark):
    docs = table(spark, ["a b c", "A b  c", "d", None, ""], [5, 5, None, 1, 1])
    kept = jaccard.drop_similar(docs)
    assert kept.columns == docs.columns
    assert sorted(kept.select("text").toPandas()["text"].map(str)) in (["", "A b  c", "None", "d"], ["", "None", "a b c", "d"])
    assert jaccard.drop_similar(docs.limit(0)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (3, 2)]
    found = components.components(spark.createDataFrame(links, "a long, b long"))
    rows = {r.id: r.root for r in found.collect()}
    assert rows == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# Repeated strings


def test_suffix_array():
    rng = random.Random(3)
    for _ in range(300):
        text = [rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 50))] + [0]
        assert suffixes.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def removed(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for i in range(len(d) - length + 1):
            seen[d[i : i + length]] = seen.get(d[i : i + length], 0) + 1
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = np.frombuffer(d, np.uint8)[~gone].tobytes()
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeating_texts():
    rng = random.Random(6)
    passage = prose(rng, 150, 10**6)
    texts = [None, "", "short", "é" * 700, "ab" * 450, "a" * 399, "a" * 400]
    for _ in range(12):
        start = rng.randrange(200)
        texts.append(prose(rng, rng.randint(5, 80), 10**6) + passage[start : start + rng.randint(380, 700)] + prose(rng, 40, 10**6))
    whole = prose(rng, 200, 10**6)
    return texts + [whole, whole, whole[:500] + "|" + whole[500:], passage[:399], passage[1:401]]


@pytest.mark.parametrize("most", [1000, 1])
def test_remove_repeats(spark, monkeypatch, most):
    """Also where every range that differs from others is compared string by string."""
    monkeypatch.setattr(suffixes, "MOST", most)
    texts = repeating_texts()
    rows = {r.doc_id: r for r in suffixes.remove_repeats(table(spark, texts)).collect()}
    for i, expected in enumerate(removed(texts, 400)):
        r = rows[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected, i


def test_remove_repeats_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "WINDOW", 300)
    rng = random.Random(8)
    text = prose(rng, 500, 10**6)
    parts = next(iter([list(suffixes.anchors(np.frombuffer(text.encode(), np.uint8), 400))]))
    starts = np.concatenate([np.concatenate([np.arange(i, j + 1) for i, j in zip(p[1], p[2])]) for p in parts])
    assert (starts == np.arange(len(text) - 399)).all()


@pytest.mark.parametrize("window", [150, 300, 701])
def test_remove_repeats_across_blocks(spark, monkeypatch, window):
    """A run that a block's border cuts in parts repeats nothing by itself."""
    monkeypatch.setattr(suffixes, "WINDOW", window)
    rng = random.Random(10)
    texts = [*repeating_texts(), *(prose(rng, 600, 10**6) for _ in range(4))]
    rows = {r.doc_id: r for r in suffixes.remove_repeats(table(spark, texts)).collect()}
    for i, expected in enumerate(removed(texts, 400)):
        r = rows[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected, i


def test_unique_text_of_several_blocks_stays_whole(spark):
    text = prose(random.Random(11), 320_000, 10**9)
    assert len(text) > 3 * suffixes.WINDOW
    row = suffixes.remove_repeats(table(spark, [text])).first()
    assert (row.n_removed, row.n_spans) == (0, 0)
    assert row.kept_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_contexts_that_recur_in_a_text_are_held_once(spark, monkeypatch):
    """Text that repeats in itself must not send a row for each recurrence to one task."""
    monkeypatch.setattr(suffixes, "WINDOW", 700)
    rng = random.Random(12)
    again = "word pair " * 300
    texts = [again, again + prose(rng, 90, 10**6), prose(rng, 90, 10**6) + again[3:], "x" * 2000, prose(rng, 200, 10**6)]
    docs = table(spark, texts).withColumnRenamed("doc_id", "id").selectExpr("id AS row", "text")
    contexts = suffixes._contexts(docs, 400)
    assert contexts.count() == contexts.select("row", "gram", "context").distinct().count()
    starts = contexts.selectExpr("row", "width", "explode(firsts) AS first")
    starts = starts.selectExpr("row", "explode(sequence(first, first + width)) AS start").collect()
    assert sorted(map(tuple, starts)) == [(i, j) for i, t in enumerate(texts) for j in range(len(t) - 399)]
    rows = {r.doc_id: r for r in suffixes.remove_repeats(table(spark, texts)).collect()}
    for i, expected in enumerate(removed(texts, 400)):
        r = rows[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected, i


def test_ranges_that_differ_stay_in_many_tasks(spark):
    """Few bytes, much work: Spark must not put their partitions together."""
    rng = random.Random(13)
    sides = [(bytes([i % 40]), rng.randbytes(31), rng.randbytes(31)) for i in range(160)]
    data = [(i, 0, bytearray(m), bytearray(left), bytearray(right)) for i, (m, left, right) in enumerate(sides)]
    ranges = spark.createDataFrame(data, "row long, start int, middle binary, left binary, right binary")
    found = suffixes._differing(ranges)
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert found.count() == 0


def test_remove_repeats_of_repeated_rows_and_nothing(spark):
    text = prose(random.Random(9), 120, 10**6)
    rows = suffixes.remove_repeats(table(spark, [text, text], [1, 1])).collect()
    assert [r.n_removed for r in rows] == [len(text)] * 2
    assert suffixes.remove_repeats(table(spark, [])).count() == 0


# Vectors

VECTORS = "vec_id long, embedding array<float>, label int, cell int, home int"


def planted(n=300, size=16):
    rng = np.random.RandomState(4)
    rows = []
    for i in range(n):
        if i % 3 and rows:
            base = np.array(rows[rng.randint(len(rows))][1])
            v = base + rng.normal(0, rng.choice([0, 0.05, 0.12]), size) * np.linalg.norm(base) / 2
        else:
            v = rng.normal(size=size)
        rows.append((i, np.float32(v).tolist(), int(rng.randint(3)) if i % 10 else None))
    rows += [
        (n, None, 1), (n + 1, [], 1), (n + 2, [0.0] * size, 1), (n + 3, [float("nan")] * size, 1),
        (n + 4, [None] + [1.0] * (size - 1), 1), (n + 5, [1.0, 2.0], 1), (n + 6, [2.0, 4.0], 1), (n + 7, [float("inf")] * size, 1),
    ]
    return rows


@pytest.mark.parametrize(("cell_rows", "block"), [(4000, 1024), (20, 7)])
def test_near_vectors(spark, monkeypatch, cell_rows, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    data = planted()
    df = spark.createDataFrame([(*r, 1, 2) for r in data], VECTORS)
    rows = {r.vec_id: r for r in vectors.near_vectors(df, cell_rows=cell_rows).collect()}
    good = {}
    for i, v, label in data:
        if label is not None and v and None not in v and np.isfinite(v).all() and np.any(v):
            good[i] = (np.array(v, float), label)
    links = []
    for i, (x, a) in good.items():
        for j, (y, b) in good.items():
            if i < j and a == b and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
                links.append((i, j))
    assert len(links) > 50
    root = roots(len(data), links)
    for i, _, _ in data:
        r = rows[i]
        assert r.n_links == sum(i in pair for pair in links)
        assert r.component_id == root[i] and r.kept == (root[i] == i)


def stored_bytes(spark):
    root = pathlib.Path(spark.conf.get("spark.checkpoint.dir"))
    return sum(f.stat().st_size for f in root.rglob("*") if f.is_file())


def test_near_vectors_are_not_copied_for_the_cells_they_meet(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CHUNK", 600, raising=False)
    rng = np.random.RandomState(8)
    found = rng.normal(size=(2000, 32))
    found[1500:] = found[:500] + 0.1 * rng.normal(size=(500, 32))
    found[1900:] = found[0] + 0.2 * rng.normal(size=(100, 32))
    found = np.float32(found).astype(float)
    df = spark.createDataFrame([(i, v.tolist(), 1 + i % 50 // 49, 1, 2) for i, v in enumerate(found)], VECTORS)
    before = stored_bytes(spark)
    rows = {r.vec_id: r for r in vectors.near_vectors(df, cell_rows=20).collect()}
    assert stored_bytes(spark) - before < 3 * found.size * 4
    units = found / np.linalg.norm(found, axis=1)[:, None]
    label = np.arange(2000) % 50 // 49
    linked = np.triu((units @ units.T >= 0.93) & (label[:, None] == label), 1)
    links = np.argwhere(linked).tolist()
    assert len(links) > 3000
    root = roots(2000, links)
    assert [rows[i].n_links for i in range(2000)] == (linked.sum(axis=0) + linked.sum(axis=1)).tolist()
    assert [rows[i].component_id for i in range(2000)] == [root[i] for i in range(2000)]


def test_near_vectors_of_many_lengths_and_labels_in_double_precision(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CHUNK", 40, raising=False)
    kind = "vec_id string, embedding array<double>, label string"
    rng = np.random.RandomState(9)
    side = float(np.sqrt(1 - 0.93**2))
    edge = [[3.0, 0.0], [0.93, side * (1 - 1e-9)], [0.93, side * (1 + 1e-9)]]
    data = [(f"edge{i}", v, "e") for i, v in enumerate(edge)]
    data += [("huge", [1e200, 1e200], "e"), ("tiny", [1e-200, 0.0], "e"), (None, [-0.0, 1.0], "e"), ("same", [0.0, 1.0], "e")]
    data += [(f"v{i}", rng.normal(size=1 + i % 3).tolist(), "abc"[i % 7 % 3]) for i in range(200)]
    rows = vectors.near_vectors(spark.createDataFrame(data, kind), cell_rows=10).collect()
    expected = collections.Counter()
    for i, (a, x, m) in enumerate(data):
        others = [y for j, (_, y, n) in enumerate(data) if i != j and m == n and len(x) == len(y)]
        x = np.array(x) / np.abs(x).max()
        others = [np.array(y) / np.abs(y).max() for y in others]
        expected[a, sum(x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.93 for y in others)] += 1
    assert expected["edge0", 2] == expected["edge1", 3] == expected["edge2", 1] == expected["huge", 0] == expected["same", 1] == 1
    assert collections.Counter((r.vec_id, r.n_links) for r in rows) == expected


def test_near_vectors_of_repeated_rows_and_nothing(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 1, 0, 0)] * 3 + [(None, [1.0, 0.1], 1, 0, 0)], VECTORS)
    rows = vectors.near_vectors(df).collect()
    assert sorted(r.n_links for r in rows) == [3] * 4 and {r.component_id for r in rows} == {1}
    assert vectors.near_vectors(df.limit(0)).count() == 0
