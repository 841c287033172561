"""Quality rules: figures of a text, and bands of perplexity under n-grams of its language.

The model is a modified Kneser-Ney one over the characters of words, one per
language, counted over all documents by Spark. A word stands between two spaces;
no n-gram reaches beyond them, so that a word's probability is its own and is
computed once for each distinct word of a block of texts. The model lies in files of sorted hash
arrays; a task looks n-grams up in those files that may hold them.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cauce.llm import pieces as P
from cauce.llm.common import arrow_schema, shared_folder, staged

#: Characters that n_symbols counts.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
#: Words of a window that is looked for in the rest of the text.
REPEATED = 5
#: Characters of the longest n-grams, spaces around the word included.
ORDER = 5
#: Bytes of text whose distinct words are looked at together.
BLOCK = 4 << 20
#: Distinct words that a task holds before it gives out their n-grams.
HELD_WORDS = 300_000
#: n-grams in a file of the model, about.
PART = 1 << 20
#: Files of the model that a worker keeps, of 16 bytes an n-gram.
KEPT_PARTS = 12
_ODD = np.random.RandomState(11).randint(0, 1 << 62, 16).astype(np.uint64) * np.uint64(2) + np.uint64(1)


# Figures of a text


def _row_counts(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.append(0, np.cumsum(flags))[offsets])


def duplicate_lines(texts: list[str | None]) -> list[int]:
    """Per text: lines with a word that equal an earlier line."""
    found = []
    for text in texts:
        lines = text.split("\n") if text else []
        seen, n = set(), 0
        for line in lines if len(lines) > 1 else ():
            if line.strip(" \t\n\r\x0b\x0c"):
                n += line in seen
                seen.add(line)
        found.append(n)
    return found


def repeated_words(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per row: words inside windows that occur twice or more in the row, the first time included."""
    n = len(codes) - REPEATED + 1
    if n < 1:
        return np.zeros(len(first) - 1, np.int64)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    word = (codes.astype(np.uint64) + np.uint64(1)) * _ODD[0]
    word ^= word >> np.uint64(29)
    rolled = row[:n].astype(np.uint64) * _ODD[1]
    for i in range(REPEATED):
        rolled += word[i : n + i] * _ODD[i + 2]
    inside = np.flatnonzero(row[:n] == row[REPEATED - 1 :])
    order = inside[np.argsort(rolled[inside])]
    equal = rolled[order[1:]] == rolled[order[:-1]]
    again = np.zeros(len(order), bool)
    again[1:] = equal
    again[:-1] |= equal
    steps = np.zeros(len(codes) + 1, np.int64)
    windows = order[again]
    np.add.at(steps, windows, 1)
    np.add.at(steps, windows + REPEATED, -1)
    return _row_counts(np.cumsum(steps)[:-1] > 0, first)


# n-grams of words


def spaced(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all words with one space around each, and the place of each word's first space."""
    text = (b" " + b" ".join(words) + b" ").decode(errors="replace")
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return points, np.flatnonzero(points == 32)


def hashes(points: np.ndarray, n: int, seeds) -> np.ndarray:
    """Hash of the ``n`` code points that end at each place from ``n`` - 1 on; ``seeds`` tells languages apart."""
    total = np.full(len(points) - n + 1, _ODD[n], np.uint64) + seeds
    for i in range(n):
        total += points[i : len(points) - n + 1 + i].astype(np.uint64) * _ODD[8 + i]
    total = (total ^ (total >> np.uint64(31))) * _ODD[0]
    return total ^ (total >> np.uint64(29))


def lang_seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang))


def keys_at(points: np.ndarray, at: np.ndarray, size: np.ndarray, seed) -> np.ndarray:
    """Hash of the ``size`` code points that end at each place ``at``, both arrays."""
    key = np.empty(len(at), np.uint64)
    for n in range(1, min(ORDER, len(points)) + 1):
        of = np.flatnonzero(size == n)
        key[of] = hashes(points, n, seed)[at[of] - n + 1]
    return key


def longest(spaces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of all characters after a word's first space, and the lengths of the longest n-grams there."""
    at = np.arange(1, spaces[-1] + 1)
    begin = np.repeat(spaces[:-1], np.diff(spaces))
    return at, np.minimum(at - begin + 1, ORDER)


def word_grams(words: list[bytes], times: np.ndarray) -> list[tuple[list[str], np.ndarray]]:
    """The distinct longest n-grams of the words by length, and how often they occur."""
    points, spaces = spaced(words)
    at, size = longest(spaces)
    weight = np.repeat(times, np.diff(spaces))
    key = keys_at(points, at, size, np.uint64(0))
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    counts = np.add.reduceat(weight[order], first).astype(np.int64)
    at, size = at[order[first]], size[order[first]]
    found = []
    for n in range(2, ORDER + 1):
        of = np.flatnonzero(size == n)
        if not len(of):
            continue
        matrix = points[at[of][:, None] + np.arange(1 - n, 1)]
        # A fixed-width text drops zeros at its end, so that U+0000 counts as U+FFFD.
        matrix = np.where(matrix == 0, 0xFFFD, matrix).astype("<u4")
        found.append((np.ascontiguousarray(matrix).view(f"<U{n}").ravel().tolist(), counts[of]))
    return found


def _lang() -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang")


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, c): how often each n-gram of ``ORDER`` characters, or one that begins a word, occurs.

    Each character counts once, for the longest n-gram that ends in it: of
    shorter ones inside a word the model needs only what comes before them.
    """
    schema = "lang string, gram string, c long"

    def count(batches):
        held: dict[str, dict[bytes, int]] = {}

        def given():
            for lang, words in held.items():
                if not words:
                    continue
                for grams, counts in word_grams(list(words), np.fromiter(words.values(), float, len(words))):
                    yield pa.record_batch([pa.array([lang] * len(grams)), pa.array(grams), pa.array(counts)], ["lang", "gram", "c"])
            held.clear()

        for block in P.blocks(batches, "text", BLOCK):
            bounds, data, first = P.words(*P.text_bytes(block["text"]))
            codes, known = P.distinct(bounds, data)
            if not len(known):
                continue
            lang = block["lang"].dictionary_encode()
            names = lang.dictionary.to_pylist()
            of = np.repeat(lang.indices.to_numpy(), np.diff(first)).astype(np.int64)
            pairs, times = np.unique(of * len(known) + codes, return_counts=True)
            cuts = np.searchsorted(pairs, np.arange(len(names) + 1) * len(known)).tolist()
            for name, a, b in zip(names, cuts, cuts[1:]):
                words = held.setdefault(name, {})
                for i, t in zip((pairs[a:b] % len(known)).tolist(), times[a:b].tolist()):
                    word = known[i]
                    words[word] = words.get(word, 0) + t
            if sum(map(len, held.values())) > HELD_WORDS:
                yield from given()
        yield from given()

    counted = docs.select("text", _lang()).mapInArrow(count, schema)
    return staged(counted.groupBy("lang", "gram").agg(F.sum("c").alias("c")), "gram-counts")


# Modified Kneser-Ney


def _discount(i: int) -> Column:
    """Discount of counts of ``i`` (3: and more) from t1 to t4, the n-grams with such counts.

    Where they allow none between 0 and ``i``, a usual value stands in.
    """
    y = F.try_divide(F.col("t1"), F.col("t1") + 2 * F.col("t2"))
    found = i - (i + 1) * y * F.try_divide(F.col(f"t{i + 1}"), F.col(f"t{i}"))
    return F.when(found.between(0, i), found).otherwise(F.lit(0.5 * i)).alias(f"d{i}")


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(lang, gram, logp, backoff): interpolated probabilities and weights as contexts, natural logarithms.

    An n-gram shorter than the longest counts by the distinct characters before
    it, unless it begins a word. The row with an empty gram holds the probability
    of an unknown character.
    """
    sized = counts.withColumn("n", F.length("gram"))
    levels = [sized.filter(F.col("n") == ORDER)]
    for n in range(ORDER - 1, 0, -1):
        inside = levels[-1].groupBy("lang", F.expr("substring(gram, 2)").alias("gram"))
        inside = inside.agg(F.count("*").alias("c")).withColumn("n", F.lit(n))
        levels.append(staged(inside.unionByName(sized.filter(F.col("n") == n)), f"adjusted-{n}"))
    adjusted = levels[0]
    for level in levels[1:]:
        adjusted = adjusted.unionByName(level)

    seen = [F.sum((F.col("c") == i).cast("long")).alias(f"t{i}") for i in (1, 2, 3, 4)]
    # A row for each language and length.
    discounts = adjusted.groupBy("lang", "n").agg(*seen).select("lang", "n", *map(_discount, (1, 2, 3)))
    discounts = staged(discounts, "discounts")
    context = F.expr("substring(gram, 1, n - 1)").alias("context")
    kinds = [F.sum((F.col("c") == i).cast("long")).alias(f"n{i}") for i in (1, 2)]
    contexts = adjusted.groupBy("lang", "n", context).agg(F.sum("c").alias("total"), *kinds, F.count("*").alias("all"))
    # Counts times discounts, not sums of discounts: the same whatever the order of rows.
    removed = F.expr("n1 * d1 + n2 * d2 + (all - n1 - n2) * d3")
    contexts = contexts.join(discounts, ["lang", "n"]).select("lang", "context", "total", (removed / F.col("total")).alias("gamma"))
    contexts = staged(contexts, "contexts")
    discount = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
    rows = adjusted.join(discounts, ["lang", "n"]).select("lang", "n", "gram", "c", discount.alias("d"), context)
    rows = rows.join(contexts, ["lang", "context"])
    rows = staged(rows.select("lang", "n", "gram", ((F.col("c") - F.col("d")) / F.col("total")).alias("alpha"), "gamma"), "alphas")

    # One row for each language.
    unknown = rows.filter("n = 1").groupBy("lang").agg((F.first("gamma") / (F.count("*") + 1)).alias("p"))
    unknown = staged(unknown, "unknown")
    p = rows.filter("n = 1").join(unknown, "lang").select("lang", "gram", (F.col("alpha") + F.col("p")).alias("p"))
    levels = [p]
    for n in range(2, ORDER + 1):
        below = levels[-1].select("lang", F.col("gram").alias("rest"), F.col("p").alias("q"))
        own = rows.filter(F.col("n") == n).withColumn("rest", F.expr("substring(gram, 2)"))
        p = own.join(below, ["lang", "rest"]).select("lang", "gram", (F.col("alpha") + F.col("gamma") * F.col("q")).alias("p"))
        levels.append(staged(p, f"grams-{n}"))
    known = levels[0].unionByName(unknown.select("lang", F.lit("").alias("gram"), "p"))
    for level in levels[1:]:
        known = known.unionByName(level)
    weights = contexts.filter("context <> ''").select("lang", F.col("context").alias("gram"), "gamma")
    # A context is an n-gram itself, but for the space that begins a word where no word ends.
    joined = known.join(weights, ["lang", "gram"], "left")
    return joined.select(
        "lang",
        "gram",
        F.ln("p").alias("logp"),
        F.coalesce(F.ln("gamma"), F.lit(0.0)).alias("backoff"),
    )


@dataclass
class Model:
    """Files of sorted hash arrays: their names and first hashes, in ascending order."""

    folder: str
    files: list[str]
    first: list[int]


def gram_hashes(langs: list[str], grams: list[str]) -> np.ndarray:
    """The hash of each (language, n-gram), signed; an empty n-gram is hashed as U+0000."""
    out = np.empty(len(grams), np.uint64)
    lengths = np.array([len(g) for g in grams])
    seeds = {lang: lang_seed(lang) for lang in set(langs)}
    seed = np.array([seeds[lang] for lang in langs], np.uint64)
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        text = "".join(grams[i] for i in at) if n else "\0" * len(at)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        width = max(n, 1)
        starts = np.arange(len(at)) * width
        total = np.full(len(at), _ODD[width], np.uint64) + seed[at]
        for i in range(width):
            total += points[starts + i].astype(np.uint64) * _ODD[8 + i]
        total = (total ^ (total >> np.uint64(31))) * _ODD[0]
        out[at] = total ^ (total >> np.uint64(29))
    return out.view(np.int64)


def fit(docs: DataFrame) -> Model:
    """The models of all languages, from every word of (text, lang); a NULL lang counts as an empty one."""
    spark = docs.sparkSession
    known = kneser_ney(gram_counts(docs))

    def arrays(batches):
        for batch in batches:
            if batch.num_rows:
                key = gram_hashes(batch["lang"].to_pylist(), batch["gram"].to_pylist())
                values = [batch[c].cast(pa.float32()) for c in ("logp", "backoff")]
                yield pa.record_batch([pa.array(key), *values], ["key", "logp", "backoff"])

    table = staged(known.mapInArrow(arrays, "key long, logp float, backoff float"), "model")
    parts = table.count() // PART + 1
    folder = shared_folder(spark, "sorted-model")
    table.repartitionByRange(parts, "key").sortWithinPartitions("key").write.option("compression", "zstd").parquet(folder)
    written = spark.read.parquet(folder)
    bounds = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min("key").alias("low")).orderBy("low").collect()
    return Model(folder, [b.file for b in bounds], [b.low for b in bounds])


class Lookup:
    """Values of n-grams from a model's files, of which a worker keeps some."""

    def __init__(self, model: Model):
        self.model, self.kept = model, {}
        folder = model.folder if "://" in model.folder or model.folder.startswith("file:") else f"file://{model.folder}"
        self.files, self.root = fs.FileSystem.from_uri(folder)

    def _part(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        held = self.kept.pop(i, None)
        if held is None:
            path = f"{self.root}/{self.model.files[i]}"
            table = pq.read_table(path, filesystem=self.files, partitioning=None)
            values = np.column_stack([table[c].to_numpy() for c in ("logp", "backoff")])
            held = table["key"].to_numpy(), values
            while len(self.kept) >= KEPT_PARTS:
                del self.kept[next(iter(self.kept))]
        self.kept[i] = held
        return held

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """(logp, backoff) per key; NaN and 0 for one that the model lacks."""
        values = np.tile(np.array([np.nan, 0], np.float32), (len(keys), 1))
        if not len(keys) or not self.model.files:
            return values
        wanted, back = np.unique(keys, return_inverse=True)
        found = np.tile(np.array([np.nan, 0], np.float32), (len(wanted), 1))
        cuts = np.searchsorted(wanted, np.array(self.model.first[1:], np.int64))
        for i, (a, b) in enumerate(zip([0, *cuts.tolist()], [*cuts.tolist(), len(wanted)])):
            if a < b:
                held, known = self._part(i)
                at = np.minimum(np.searchsorted(held, wanted[a:b]), len(held) - 1)
                same = held[at] == wanted[a:b]
                found[a:b][same] = known[at[same]]
        return found[back]


def score_words(lang: str, words: list[bytes], lookup: Lookup) -> tuple[np.ndarray, np.ndarray]:
    """Log probability and number of characters of each word, the space that ends it included.

    The longest n-gram that the model has gives a character's probability; each
    one tried before adds the weight of its context.
    """
    points, spaces = spaced(words)
    seed = lang_seed(lang)
    unknown = lookup(gram_hashes([lang], [""]))[0, 0]
    # Without a model of the language every character is as likely as one of all code points.
    unknown = -np.log(0x110000) if np.isnan(unknown) else unknown
    at, size = longest(spaces)
    logp, left = np.zeros(len(at)), np.arange(len(at))
    while len(left):
        found = lookup(keys_at(points, at[left], size[left], seed).view(np.int64))[:, 0]
        known = ~np.isnan(found)
        logp[left[known]] += found[known]
        left = left[~known]
        last = size[left] == 1
        logp[left[last]] += unknown
        left = left[~last]
        size[left] -= 1
        logp[left] += lookup(keys_at(points, at[left] - 1, size[left], seed).view(np.int64))[:, 1]
    sums = np.append(0, np.cumsum(logp))
    return np.diff(sums[spaces]), np.diff(spaces)


def describe(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of (doc_id, text, lang): the figures of its text, and how likely its characters are."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, loss double, sign long"
    )
    kinds = arrow_schema(schema)

    def figures(batches):
        lookup = P.one_in_worker(("perplexity", model.folder), lambda: Lookup(model))
        for block in P.blocks(batches, "text", BLOCK):
            offsets, data = P.text_bytes(block["text"])
            bounds, held, first = P.words(offsets, data)
            codes, known = P.distinct(bounds, held)
            lang = block["lang"].dictionary_encode()
            of = np.repeat(lang.indices.to_numpy(), np.diff(first)).astype(np.int64)
            scores = np.zeros((len(codes), 2))
            for i, name in enumerate(lang.dictionary.to_pylist()):
                at = np.flatnonzero(of == i)
                some, back = np.unique(codes[at], return_inverse=True)
                if len(some):
                    scores[at] = np.column_stack(score_words(name, [known[c] for c in some.tolist()], lookup))[back]
            logp, chars = P.row_sums(scores, first).T
            begins = (data & 0xC0) != 0x80
            view = memoryview(np.ascontiguousarray(data))
            cuts = offsets.tolist()
            sign = [xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(cuts, cuts[1:])]
            columns = [
                block["doc_id"].cast(kinds.field("doc_id").type),
                block["lang"],
                np.diff(first),
                _row_counts(begins & ~P.SPACE[data], offsets),
                _row_counts(SYMBOLS[data], offsets),
                duplicate_lines(block["text"].to_pylist()),
                repeated_words(codes, first),
                np.where(chars > 0, -logp / np.maximum(chars, 1), 0).round(6),
                np.array(sign, np.uint64).view(np.int64),
            ]
            yield pa.record_batch([pa.array(c, f.type) if not isinstance(c, pa.Array) else c for c, f in zip(columns, kinds)], schema=kinds)

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), _lang())
    return staged(rows.mapInArrow(figures, schema), "figures")


def bands(figures: DataFrame, width: float, least: float) -> DataFrame:
    """(lang, low, high): the losses that are usual in each language.

    Quartiles are exact to a thousandth, from counts by thousandths. Of equal
    texts one counts, so that a large group of copies doesn't move them. The band
    goes ``width`` times their distance beyond the quartiles, ``least`` at least.
    """
    usual = figures.filter(~F.col("base_failed")).select("lang", "sign", "loss").distinct()
    counts = usual.groupBy("lang", F.round(F.col("loss") * 1000).cast("long").alias("bin")).agg(F.count("*").alias("n"))
    counts = staged(counts, "losses")
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy("bin"))
    total = F.sum("n").over(Window.partitionBy("lang"))
    at = counts.select("lang", "bin", upto.alias("upto"), total.alias("total"))
    quartile = [F.min(F.when(F.col("upto") >= q * F.col("total"), F.col("bin"))) / 1000 for q in (0.25, 0.75)]
    found = at.groupBy("lang").agg(quartile[0].alias("q1"), quartile[1].alias("q3"))
    beyond = F.greatest(width * (F.col("q3") - F.col("q1")), F.lit(least))
    return found.select("lang", (F.col("q1") - beyond).alias("low"), (F.col("q3") + beyond).alias("high"))


def quality(
    docs: DataFrame,
    least_words: int = 10,
    most_repeated: int = 20,
    width: float = 3.0,
    least_band: float = 0.05,
    slack: float = 3.0,
    model: Model | None = None,
) -> DataFrame:
    """Per row of (doc_id, text, lang): figures of the text, its perplexity, and the verdict.

    base_failed: fewer than ``least_words`` words, or more than ``most_repeated``
    in a hundred of them in repeated windows of five. kept: not so, and the
    logarithm of the perplexity (by character) is inside the band of the language,
    which ``slack`` over the square root of the text's characters widens, since
    short texts vary more.
    Perplexity is NULL for a text without words, which fails the base. A NULL text counts
    as empty, a NULL lang as an empty one, with a model and a band of its own.
    Every text is counted and scored whole; copies of a text have one verdict, and
    repeated or NULL doc_ids are rows of their own. Lines and words compare
    exactly. Other columns are not read; an empty table gives no rows. ``model`` is
    counted over ``docs`` itself unless given; ``docs`` must read the same each time.
    """
    model = model or fit(docs)
    figures = describe(docs, model)
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    figures = figures.withColumn("base_failed", failed)
    # One row for each language.
    usual = staged(bands(figures, width, least_band), "bands")
    beyond = slack / F.sqrt(F.greatest(F.col("word_chars") + F.col("n_words"), F.lit(1)))
    low, high = F.col("low") - beyond, F.col("high") + beyond
    inside = F.coalesce(F.col("loss").between(low, high), F.lit(True))
    return figures.join(usual, "lang", "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & inside).alias("kept"),
        F.when(F.col("n_words") > 0, F.exp("loss")).alias("perplexity"),
        F.exp(low).alias("least_perplexity"),
        F.exp(high).alias("most_perplexity"),
    )
