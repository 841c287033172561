"""Quality rules, fill-in-middle and centroid clusters against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cauce.llm import middle, perplexity, planes

SCHEMA = "doc_id long, text string, lang string, n int, form string, key long, lang_pred string, cluster int"


def table(spark, texts, langs=None, ids=None):
    ids = range(len(texts)) if ids is None else ids
    langs = ["en"] * len(texts) if langs is None else langs
    rows = [(i, t, x, 1, "f", 2, "p", 3) for i, t, x in zip(ids, texts, langs)]
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# Quality rules


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def probabilities(texts, order=perplexity.ORDER):
    """p(character | characters before) of one language, from the definition of modified Kneser-Ney."""
    counts = Counter()
    for text in texts:
        for word in words(text):
            w = f" {word} "
            for n in range(1, order + 1):
                for i in range(len(w) - n + 1):
                    if n > 1 or i:
                        counts[w[i : i + n]] += 1
    adjusted = {}
    for gram, c in counts.items():
        if len(gram) == order or (len(gram) > 1 and gram[0] == " "):
            adjusted[gram] = c
        else:
            adjusted[gram] = len({g for g in counts if len(g) == len(gram) + 1 and g[1:] == gram})
    discounts = {}
    for n in range(1, order + 1):
        t = Counter(c for g, c in adjusted.items() if len(g) == n)
        y = t[1] / (t[1] + 2 * t[2]) if t[1] + 2 * t[2] else None
        for i in (1, 2, 3):
            d = None if y is None or not t[i] else i - (i + 1) * y * t[i + 1] / t[i]
            discounts[n, i] = d if d is not None and 0 <= d <= i else 0.5 * i
    followers = defaultdict(dict)
    for gram, c in adjusted.items():
        followers[gram[:-1]][gram[-1]] = c
    alphabet = len(followers[""]) + 1

    def p(char, context):
        if context and context not in followers:
            return p(char, context[1:])
        seen = followers[context]
        total = sum(seen.values())
        n = len(context) + 1
        gamma = sum(discounts[n, min(c, 3)] for c in seen.values()) / total
        own = max(seen[char] - discounts[n, min(seen[char], 3)], 0) / total if char in seen else 0
        return own + gamma * (p(char, context[1:]) if context else 1 / alphabet)

    return p


def brute_loss(text, p, order=perplexity.ORDER):
    found = []
    for word in words(text):
        w = f" {word} "
        found += [-math.log(p(w[i], w[max(0, i - order + 1) : i])) for i in range(1, len(w))]
    return sum(found) / len(found)


def brute_figures(text):
    text = text or ""
    found = words(text)
    seen, lines = set(), 0
    for line in text.split("\n"):
        if words(line):
            lines += line in seen
            seen.add(line)
    windows = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    times = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(found), sum(map(len, found)), symbols, lines, len(inside)


def prose(rng, n, syllables):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))


def quality_texts():
    rng = random.Random(3)
    odd = [
        None, "", " \n", "a", "\x0b", "é𝒳 ü", "a b c d e f a b c d e", "x y z\nx y z\n\nx y z ", "# * $ % & | < >",
        "w " * 40, "a\tb\r\nc\x0cd", "\x00 a\x00b", "one word still", "z" * 3000, "a b c d e " * 3 + "end",
    ]
    return odd + [prose(rng, rng.randint(5, 80), ["ba", "ne", "ti", "gro", "É"]) for _ in range(40)]


def test_figures_and_perplexity(spark):
    texts = quality_texts()
    langs = ["en" if i % 3 else "fr" for i in range(len(texts))]
    langs[20], langs[21] = None, ""
    found = perplexity.quality(table(spark, texts, langs)).collect()
    assert len(found) == len(texts)
    models = {}
    for lang in {x or "" for x in langs}:
        models[lang] = probabilities([t and t.replace("\0", "�") for t, x in zip(texts, langs) if (x or "") == lang])
    for r in found:
        text = texts[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_figures(text), repr(text)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        if "\0" in (text or ""):
            continue
        if r.n_words:
            assert math.log(r.perplexity) == pytest.approx(brute_loss(text, models[langs[r.doc_id] or ""]), abs=1e-4)
        else:
            assert r.perplexity is None and not r.kept


def test_odd_texts_leave_the_band(spark):
    rng = random.Random(5)
    clean = [prose(rng, 200, ["ba", "ne", "ti", "gro", "sel", "mu"]) for _ in range(300)]
    other = [prose(rng, 200, ["xq", "zw", "vk", "jy", "qq"]) for _ in range(3)]
    common = [clean[0]] * 400  # copies must not narrow the band
    found = {r.doc_id: r for r in perplexity.quality(table(spark, clean + other + common)).collect()}
    assert sum(found[i].kept for i in range(300)) >= 297
    assert not any(found[i].kept for i in range(300, 303))
    assert {found[i].kept for i in range(303, 703)} == {found[0].kept}


def test_model_in_many_files_and_tasks_give_the_same(spark, monkeypatch):
    texts = quality_texts()
    whole = rows(perplexity.quality(table(spark, texts)))
    docs = table(spark, texts).repartition(7)
    monkeypatch.setattr(perplexity, "PART", 100)
    model = perplexity.fit(docs)
    assert len(model.files) > 5
    assert rows(perplexity.quality(docs, model=model)) == whole


def test_quality_of_an_empty_table_and_repeated_rows(spark):
    docs = table(spark, ["a b"] * 3, [None] * 3, [7, 7, None])
    assert perplexity.quality(docs.limit(0)).collect() == []
    found = perplexity.quality(docs).collect()
    assert sorted(str(r.doc_id) for r in found) == ["7", "7", "None"]
    assert len({tuple(r)[1:] for r in found}) == 1


def test_words_that_the_model_lacks(spark):
    model = perplexity.fit(table(spark, ["abc abd abe"]))
    found = perplexity.quality(table(spark, ["日本 abc", "abc"], ["en", "xx"]), model=model).collect()
    assert all(r.perplexity > 1 and math.isfinite(r.perplexity) for r in found)


# Fill-in-middle


def brute_middle(doc_id, text, fim=50, spm=80):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, mid, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(prefix), len(mid), f"<S>{suffix}<P>{prefix}<M>{mid}"
    return n, "psm", len(prefix), len(mid), f"<P>{prefix}<S>{suffix}<M>{mid}"


ODD = ["", None, " ", "\n\t", "a", " a ", "a b", "<P>", "x <S> y", "a<M", ">b <P", "P> c", "<", "S>", "日本 語 x", "é" * 9, "a\x0bb\x1cc",
       "word " * 5000, "<<P", "<S", ">", "<M <P <S", "\r\n"]


def test_fill_in_middle(spark):
    rng = random.Random(1)
    alphabet = ["a", " ", "\n", "é", "日", "<", "P", "S", "M", ">", "𝒳", "\t"]
    texts = ODD * 8 + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    ids = [None if i == 40 else i // 2 if i < 20 else i for i in range(len(texts))]
    docs = table(spark, texts, ids=ids)
    for fim, spm in ((50, 80), (100, 50), (0, 0)):
        found = middle.fill_in_middle(docs.coalesce(2), fim_percent=fim, spm_percent=spm).collect()
        expected = [(i, *brute_middle(i, t, fim, spm), t or "") for i, t in zip(ids, texts)]
        actual = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output.decode(), r.restored.decode()) for r in found]
        assert sorted(actual, key=repr) == sorted(expected, key=repr)
    assert middle.fill_in_middle(docs.limit(0)).collect() == []


def test_restored_comes_from_the_output_alone(spark):
    texts = ["one two three", "four  five\n", "a", ""]
    offsets = np.cumsum([0, *map(len, texts)])
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    form = np.array([middle.PSM, middle.SPM, middle.SPM, middle.PLAIN])
    cuts = offsets[:-1] + [3, 0, 1, 0], offsets[:-1] + [7, 10, 1, 0]
    out, result = middle.scatter(offsets, data, form, *cuts)
    assert result.tobytes() == b"<P>one<S> three<M> two<S>\n<P><M>four  five<S><P>a<M>"
    again, text = middle.restore(out, result, form)
    assert again.tolist() == offsets.tolist() and text.tobytes().decode() == "".join(texts)


# Centroid clusters


def brute_clusters(vectors, k=16, rounds=3):
    kept = []
    for vec_id, x in vectors:
        if x is not None and len(x) == 64 and all(v is not None and math.isfinite(v) for v in x):
            kept.append((vec_id, [math.floor(64 * v) for v in x]))

    def order(row):
        digest = None if row[0] is None else hashlib.sha256(f"1:{row[0]}".encode()).hexdigest()
        return digest is None, digest or "", row[1]

    centroids = [e for _, e in sorted(kept, key=order)[:k]]

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(e, c)), i) for i, c in enumerate(centroids)) for _, e in kept]

    for _ in range(rounds):
        of = assigned()
        for i in range(len(centroids)):
            own = [e for (_, e), (_, j) in zip(kept, of) if i == j]
            if own:
                centroids[i] = [sum(x) // len(own) for x in zip(*own)]
    of = assigned()
    by = Counter()
    for d, i in of:
        by[i] += d
    return sorted(((v, i, d, by[i], sum(by.values()), centroids[i]) for (v, _), (d, i) in zip(kept, of)), key=repr)


VECTORS = "vec_id long, embedding array<double>, label int, cluster int, held string"


def vector_table(spark, vectors):
    return spark.createDataFrame([(i, x, 1, 2, "h") for i, x in vectors], VECTORS)


def clusters(df, **how):
    found = planes.cluster(df, **how).collect()
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid) for r in found), key=repr)


def test_clusters(spark):
    rng = np.random.RandomState(2)
    vectors = [(i, (rng.standard_normal(64) * s).tolist()) for i, s in enumerate([0.3] * 120 + [5.0] * 30 + [1000.0] * 3)]
    vectors += [(200 + i, [1.5] * 64) for i in range(60)] + [(5, [0.0] * 64), (5, [-0.0] * 64), (None, [2.0] * 64), (None, [-7.25] * 64)]
    bad = [None, [], [1.0] * 63, [1.0] * 65, [None] + [1.0] * 63, [float("nan")] * 64, [float("inf")] + [0.0] * 63]
    vectors += [(300 + i, x) for i, x in enumerate(bad)]
    expected = brute_clusters(vectors)
    assert clusters(vector_table(spark, vectors)) == expected
    assert clusters(vector_table(spark, vectors).repartition(5)) == expected


def test_few_vectors_and_none(spark):
    vectors = [(i, [float(i)] * 64) for i in range(5)]
    assert clusters(vector_table(spark, vectors)) == brute_clusters(vectors)
    ties = [(i, [1.0] * 64) for i in range(40)]
    found = clusters(vector_table(spark, ties))
    assert found == brute_clusters(ties) and {r[1] for r in found} == {0}
    assert clusters(vector_table(spark, vectors).limit(0)) == []
    assert clusters(vector_table(spark, [(1, [1e300] * 64), (2, [0.5] * 64)])) == brute_clusters([(2, [0.5] * 64)])


def test_planes_are_exact():
    rng = np.random.RandomState(4)
    for high in (1, 2, 37, 1 << 27):
        a, b = (rng.randint(-high, high + 1, (9, 64)).astype(np.int64) for _ in range(2))
        assert (planes.dots(planes.planes(a), planes.planes(b)) == a @ b.T).all()
    assert planes.dots(planes.planes(np.zeros((1, 64), np.int64)), planes.planes(a)).tolist() == [[0] * 9]
