"""Language identification by unigrams of pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary.
The probability of a word is the sum over all its segmentations into pieces (the
forward algorithm); a text is scored by its words. Expectation maximisation with
the forward and backward sums fits the probabilities.
"""

import functools
import itertools
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cauce.llm import pieces as P
from cauce.llm.common import bounded_sample, staged

LETTERS = re.compile(r"[^\W\d_]+")
#: Longer words are summed one by one in logarithms, shorter ones of a length together;
#: these sums are far from the least double.
LONGEST = 25
#: Probability of a character that the vocabulary lacks.
UNKNOWN = 1e-7
SMOOTHING = 0.1


@functools.cache
def vocabulary(path: str) -> tuple[dict[str, int], int]:
    """Pieces by id, without control and byte pieces, and the longest length."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))]
    known = {model.id_to_piece(i): i for i in ids}
    return known, max(map(len, known))


def runs(token: bytes) -> list[str]:
    """Runs of letters in lower case, marked as word starts as the vocabulary marks them."""
    return ["▁" + x for x in LETTERS.findall(token.decode(errors="replace").lower())]


def lattice(words: list[str], path: str) -> list[tuple[int, int, np.ndarray]]:
    """For words of one length: (start, end, piece id per word); -1 is no piece, -2 an unknown character."""
    known, longest = vocabulary(path)
    n, edges = len(words[0]), []
    for end in range(1, n + 1):
        for start in range(max(0, end - longest), end):
            missing = -2 if end - start == 1 else -1
            ids = np.array([known.get(w[start:end], missing) for w in words], np.int32)
            if (ids != -1).any():
                edges.append((start, end, ids))
    return edges


def _probability(table: np.ndarray, ids: np.ndarray) -> np.ndarray:
    found = table[np.maximum(ids, 0)]
    found[ids == -1] = 0
    found[ids == -2] = UNKNOWN
    return found


def by_length(words: list[str]) -> dict[int, list[int]]:
    """The places of the words of up to ``LONGEST`` characters, by their length."""
    groups: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        if len(word) <= LONGEST:
            groups.setdefault(len(word), []).append(i)
    return groups


def chain(word: str, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and ids of all pieces in a word, by end; -2 is an unknown character."""
    known, longest = vocabulary(path)
    starts, ends, ids = array("q"), array("q"), array("q")
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - longest), end):
            piece = known.get(word[start:end], -2 if end - start == 1 else -1)
            if piece != -1:
                starts.append(start)
                ends.append(end)
                ids.append(piece)
    return tuple(np.frombuffer(x, np.int64) for x in (starts, ends, ids))


def log_sums(n: int, starts, ends, ids, logs: np.ndarray) -> np.ndarray:
    """The logarithm of the sum over all ways from 0 to each place, per column of ``logs``.

    ``logs`` has the logarithm of every piece, and of an unknown character as last row but one.
    """
    sums = np.zeros((n + 1, logs.shape[1]))
    bounds = np.searchsorted(ends, np.arange(n + 2)).tolist()
    for end in range(1, n + 1):
        at = slice(bounds[end], bounds[end + 1])
        sums[end] = np.logaddexp.reduce(sums[starts[at]] + logs[ids[at]], axis=0)
    return sums


def _logs(table: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(np.vstack([table, np.full((2, table.shape[1]), UNKNOWN)]))


def forward(words: list[str], table: np.ndarray, path: str) -> np.ndarray:
    """Log probability of each word in each language; table is piece x language."""
    scores = np.zeros((len(words), table.shape[1]))
    for n, rows in by_length(words).items():
        sums = np.zeros((n + 1, len(rows), table.shape[1]))
        sums[0] = 1
        for start, end, ids in lattice([words[i] for i in rows], path):
            sums[end] += sums[start] * _probability(table, ids)
        scores[rows] = np.log(sums[n])
    long = [i for i, word in enumerate(words) if len(word) > LONGEST]
    logs = _logs(table) if long else None
    for i in long:
        scores[i] = log_sums(len(words[i]), *chain(words[i], path), logs)[-1]
    return scores


def expected(words, langs, counts, table, path) -> np.ndarray:
    """Expected counts of (piece, language) for words seen ``counts`` times in a language."""
    total = np.zeros_like(table)
    langs, counts = np.asarray(langs), np.asarray(counts, float)
    for n, rows in by_length(words).items():
        edges = lattice([words[i] for i in rows], path)
        lang, count = langs[rows], counts[rows]
        weights = []
        ahead = np.zeros((n + 1, len(rows)))
        ahead[0] = 1
        for start, end, ids in edges:
            weights.append(_probability(table, ids)[np.arange(len(rows)), lang])
            ahead[end] += ahead[start] * weights[-1]
        back = np.zeros((n + 1, len(rows)))
        back[n] = 1
        for (start, end, _), weight in zip(reversed(edges), reversed(weights)):
            back[start] += back[end] * weight
        for (start, end, ids), weight in zip(edges, weights):
            share = count * ahead[start] * weight * back[end] / ahead[n]
            real = ids >= 0
            np.add.at(total, (ids[real], lang[real]), share[real])
    long = [i for i, word in enumerate(words) if len(word) > LONGEST]
    logs = _logs(table) if long else None
    for i in long:
        n, (starts, ends, ids) = len(words[i]), chain(words[i], path)
        own = logs[:, [langs[i]]]
        ahead = log_sums(n, starts, ends, ids, own)[:, 0]
        turned = np.argsort(-starts, kind="stable")  # the same from the word's end on
        back = log_sums(n, (n - ends)[turned], (n - starts)[turned], ids[turned], own)[::-1, 0]
        share = counts[i] * np.exp(ahead[starts] + own[ids, 0] + back[ends] - ahead[n])
        real = ids >= 0
        np.add.at(total[:, langs[i]], ids[real], share[real])
    return total


class Model:
    """Languages and log-free piece probabilities (piece x language)."""

    def __init__(self, langs: list[str], table: np.ndarray, path: str):
        self.langs, self.table, self.path = langs, table, path


def fit(labelled: DataFrame, path: str, max_rows: int = 20_000, rounds: int = 3) -> Model:
    """Fit on (text, lang) rows; those with a NULL lang are ignored.

    At most ``max_rows`` rows are learned from, in equal shares for the languages, so
    that rare ones stay (``bounded_sample``). The model has vocabulary x languages numbers; every round
    is one Spark job over the distinct words of the sample.
    """
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = bounded_sample(rows, "lang", max_rows, equal=True)

    def count(batches):
        for block in P.blocks(batches, "text"):
            bounds, held, first = P.words(*P.text_bytes(block["text"]))
            codes, known = P.distinct(bounds, held)
            lang = block["lang"].dictionary_encode()
            of = np.repeat(lang.indices.to_numpy(), np.diff(first))
            pair, times = np.unique(of.astype(np.int64) * max(len(known), 1) + codes, return_counts=True)
            sums: dict[tuple[str, str], int] = {}
            names = lang.dictionary.to_pylist()
            for p, t in zip(pair.tolist(), times.tolist()):
                for run in runs(known[p % len(known)]):
                    key = names[p // len(known)], run
                    sums[key] = sums.get(key, 0) + t
            if sums:
                yield pa.record_batch(
                    [*map(pa.array, zip(*sums)), pa.array(list(sums.values()), pa.int64())],
                    ["lang", "word", "n"],
                )

    counted = rows.select("text", "lang").mapInArrow(count, "lang string, word string, n long")
    table_of = staged(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "lang-words")
    langs = [r.lang for r in table_of.select("lang").distinct().orderBy("lang").collect()]
    size = max(vocabulary(path)[0].values()) + 1
    usable = np.zeros(size, bool)
    usable[list(vocabulary(path)[0].values())] = True
    table = np.repeat(usable[:, None] / usable.sum(), len(langs), axis=1)
    for _ in range(rounds if langs else 0):
        sums = np.zeros_like(table)
        for r in _round(table_of, langs, table, path).collect():  # at most the size of the model
            sums[r.piece, r.lang] = r.n
        sums[usable] += SMOOTHING
        table = sums / sums.sum(axis=0)
    return Model(langs, table, path)


def _round(words: DataFrame, langs: list[str], table: np.ndarray, path: str) -> DataFrame:
    places = {lang: i for i, lang in enumerate(langs)}
    sent = words.sparkSession.sparkContext.broadcast(table)

    def step(batches):
        sums = np.zeros_like(sent.value)
        for batch in batches:
            lang = [places[x] for x in batch["lang"].to_pylist()]
            sums += expected(batch["word"].to_pylist(), lang, batch["n"].to_pylist(), sent.value, path)
        piece, lang = np.nonzero(sums)
        if len(piece):
            yield pa.record_batch(
                [pa.array(piece), pa.array(lang), pa.array(sums[piece, lang])], ["piece", "lang", "n"]
            )

    found = words.mapInArrow(step, "piece long, lang long, n double")
    return found.groupBy("piece", "lang").agg(F.sum("n").alias("n"))


_models = itertools.count()


def _scores(model_id: int, table: np.ndarray, path: str) -> P.Memo:
    """Per token: log probabilities by language, then letters; kept by a worker for its later tasks."""

    def compute(tokens: list[bytes]) -> list[bytes]:
        found = [runs(token) for token in tokens]
        flat = [run for x in found for run in x]
        first = np.cumsum([0, *map(len, found)])
        scores = forward(flat, table, path) if flat else np.zeros((0, table.shape[1]))
        letters = np.array([sum(map(len, x)) for x in found], float)
        return [x.tobytes() for x in np.column_stack([P.row_sums(scores, first), letters])]

    return P.one_in_worker(("language", model_id), lambda: P.Memo(compute))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score, replacing columns of these names.

    The score is the posterior probability of the language, all taken as equally
    likely before. A NULL text, one without letters, and any text under a model
    without languages is ``und`` with score 0. Whole texts of any length are scored; equal
    texts score alike; of tied languages the first by name is taken. Columns
    called ``text`` must be there, all others are carried along.
    """
    docs = docs.drop("lang_pred", "score")
    sent = docs.sparkSession.sparkContext.broadcast((model.langs, model.table))
    path, model_id = model.path, next(_models)

    def predict(batches):
        langs, table = sent.value
        width = len(langs)
        memo = _scores(model_id, table, path)
        for block in P.blocks(batches, "text"):
            bounds, held, first = P.words(*P.text_bytes(block["text"]))
            codes, known = P.distinct(bounds, held)
            flat = np.frombuffer(b"".join(memo(known)), float).reshape(-1, width + 1)
            total = P.row_sums(flat[codes], first)
            logs = total[:, :width]
            if width:
                best = logs.argmax(axis=1)
                score = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
                none = total[:, width] == 0
                names = np.array([*langs, "und"], object)[np.where(none, width, best)]
                score = np.where(none, 0, score.round(6))
            else:
                names, score = np.full(block.num_rows, "und", object), np.zeros(block.num_rows)
            yield pa.record_batch(
                [*block.columns, pa.array(names, pa.string()), pa.array(score, pa.float64())],
                [*block.schema.names, "lang_pred", "score"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(predict, f"{fields}{', ' if fields else ''}lang_pred string, score double")


def held_out():
    """Whether crc32 of the doc_id's text leaves the remainder 1 by 3."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
