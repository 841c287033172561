"""Toxicity by cumulative-link ordinal regression on sparse text features.

P(grade <= k) = sigmoid(threshold[k] - weights . x): all thresholds share the
weights. x has a one for every word of the text. The weights are fitted with a
penalty on their sum, so that all but telling words get none and long texts are
not judged by many small ones.
"""

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cauce.llm import pieces as P
from cauce.llm.common import arrow_schema, bounded_sample, record_batch, staged

LETTERS = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    """Hashes of words in ascending order, their weights, and ascending thresholds."""

    words: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray


def features(token: bytes) -> list[int]:
    """64-bit hashes of the runs of letters, in lower case."""
    found = LETTERS.findall(token.decode(errors="replace").lower())
    return [xxhash.xxh3_64_intdigest(word) for word in found]


def probabilities(z: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade) by row, for grades 0 to len(thresholds)."""
    below = 1 / (1 + np.exp(np.clip(z[:, None] - thresholds, -500, 500)))
    edges = np.column_stack([np.zeros(len(z)), below, np.ones(len(z))])
    return np.diff(edges, axis=1)


def fit_ordinal(rows, columns, n_rows, n_columns, grades, n_grades, penalty=0.3, rounds=300):
    """Proximal Adagrad on the mean log likelihood; x is 1 at (rows, columns).

    ``penalty`` is the price of a unit of weight, in log likelihood of a row.
    Weights are not negative: words can raise a grade, harmless ones don't lower it.
    """
    share = np.bincount(grades, minlength=n_grades).cumsum()[:-1] / len(grades)
    share = np.clip(share, 1e-3, 1 - 1e-3)
    first = np.log(share / (1 - share))
    theta = np.maximum.accumulate(first + 1e-3 * np.arange(n_grades - 1))
    weights, squares, theta_squares = np.zeros(n_columns), np.full(n_columns, 1e-8), np.full(n_grades - 1, 1e-8)
    for _ in range(rounds):
        z = np.bincount(rows, weights[columns], n_rows)
        below = 1 / (1 + np.exp(np.clip(z[:, None] - theta, -500, 500)))
        edges = np.column_stack([np.zeros(n_rows), below, np.ones(n_rows)])
        slopes = edges * (1 - edges)
        at = np.arange(n_rows)
        p = np.maximum(edges[at, grades + 1] - edges[at, grades], 1e-12)
        high, low = slopes[at, grades + 1] / p, slopes[at, grades] / p
        by_z = (high - low) / n_rows  # gradient of the loss
        gradient = np.bincount(columns, by_z[rows], n_columns)
        by_theta = np.array([(low[grades == k + 1].sum() - high[grades == k].sum()) / n_rows for k in range(n_grades - 1)])
        squares += gradient**2
        theta_squares += by_theta**2
        step = 0.5 / np.sqrt(squares)
        moved = weights - step * gradient
        weights = np.maximum(moved - step * penalty / n_rows, 0)
        theta = np.maximum.accumulate(theta - 0.2 / np.sqrt(theta_squares) * by_theta)
    return weights, theta


def fit(labelled: DataFrame, max_rows: int = 10_000, least_rows: int = 3, grades: int = 4) -> Model:
    """Fit on (text, toxic) rows; those with a NULL label are ignored.

    Labels are 0 or 1. The grades of toxic rows are made from them: words that
    occur mostly in toxic rows are counted, and thirds of the counts by word of
    text give grades 1 to ``grades`` - 1; the others have grade 0. At most ``max_rows``
    rows are learned from, with the labels in their shares (``bounded_sample``).
    Words of fewer than ``least_rows`` rows are left out.
    """
    labelled = bounded_sample(labelled.filter(F.col("toxic").isNotNull()), "toxic", max_rows)

    def sparse(batches):
        for block in P.blocks(batches, "text"):
            held, _ = _features(block["text"], features)
            sets = [np.unique(x).view(np.int64) for x in held]
            yield pa.record_batch(
                [block["toxic"].cast(pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["toxic", "words"]
            )

    sample = labelled.select("toxic", "text").mapInArrow(sparse, "toxic long, words array<long>").toArrow()
    toxic = sample["toxic"].to_numpy().astype(bool)
    empty = Model(np.zeros(0, np.uint64), np.zeros(0), np.full(grades - 1, 20.0))
    if not toxic.any() or toxic.all():
        return empty
    lists = sample["words"].combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    row = np.repeat(np.arange(len(toxic)), sizes)
    words, column, counts = np.unique(lists.flatten().to_numpy().view(np.uint64), return_inverse=True, return_counts=True)
    usual = np.flatnonzero(counts >= least_rows)
    place = np.full(len(words), -1)
    place[usual] = np.arange(len(usual))
    kept = place[column] >= 0
    row, column, words = row[kept], place[column[kept]], words[usual]
    if not len(words):
        return empty
    in_toxic = np.bincount(column, toxic[row], len(words))
    in_all = np.bincount(column, minlength=len(words))
    share = toxic.mean()
    telling = (in_toxic - in_all * share) / np.sqrt(in_all * share * (1 - share)) > 6
    amount = np.bincount(row, telling[column], len(toxic)) / np.maximum(np.log2(sizes + 2), 1)
    cuts = np.quantile(amount[toxic], np.arange(1, grades - 1) / (grades - 1))
    grade = np.where(toxic, 1 + np.searchsorted(cuts, amount, "left"), 0)
    weights, theta = fit_ordinal(row, column, len(toxic), len(words), grade, grades)
    used = weights != 0
    return Model(words[used], weights[used], theta)


def labelled_texts(docs: DataFrame, labels: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """(text, toxic) of at most ``max_rows`` pairs of a document and a label with one doc_id, for ``fit``.

    Drawn by doc_id and label, before any text is read; rows of a repeated doc_id are drawn
    together (``bounded_sample``). NULL labels and ids of one table alone are left out.
    """
    given = labels.select("doc_id", "toxic").filter(F.col("toxic").isNotNull())
    pairs = staged(docs.select("doc_id").join(given, "doc_id"), "labelled")
    drawn = staged(bounded_sample(pairs, "toxic", max_rows).distinct(), "drawn")
    # At most max_rows ids and labels, so texts stay where they are.
    return docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("text", "toxic")


def _features(column: pa.Array, of_token) -> tuple[list[np.ndarray], np.ndarray]:
    """The hashes of each row's distinct tokens."""
    bounds, held, first = P.words(*P.text_bytes(column))
    codes, known = P.distinct(bounds, held)
    results = [np.array(of_token(t), np.uint64) for t in known]
    starts = np.cumsum([0, *map(len, results)])
    values = np.concatenate(results) if results else np.zeros(0, np.uint64)
    out = []
    for start, stop in zip(first[:-1], first[1:]):
        found, _ = P.gather(values, starts, np.unique(codes[start:stop]))
        out.append(found)
    return out, first


def grade(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """Per row: doc_id, grade (the likeliest), severity (its expectation), p_toxic and toxic.

    toxic means that a grade over 0 has the probability ``least``; texts without
    any telling word are far below it. Whole texts of
    any length count; a NULL text is one without words. Equal texts are graded
    alike, repeated rows as often as they occur. Other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, grade int, severity double, p_toxic double, toxic boolean"
    kinds = arrow_schema(schema)

    def predict(batches):
        words, weights = sent.value.words, sent.value.weights

        def compute(tokens):
            out = []
            for token in tokens:
                hashes = np.array(features(token), np.uint64)
                at = np.searchsorted(words, hashes)
                hit = at < len(words)
                hit[hit] = words[at[hit]] == hashes[hit]
                out.append(at[hit].astype("<i4").tobytes())
            return out

        memo = P.Memo(compute)
        for block in P.blocks(batches, "text"):
            bounds, held, first = P.words(*P.text_bytes(block["text"]))
            codes, known = P.distinct(bounds, held)
            values, starts = P.ragged(memo(known), "<i4")
            found, ends = P.gather(values, starts, codes)
            row = np.repeat(np.arange(block.num_rows), np.diff(ends[first]))
            width = max(len(words), 1)
            once = np.unique(row * width + found)
            z = np.bincount(once // width, weights[once % width], block.num_rows) if len(once) else np.zeros(block.num_rows)
            p = probabilities(z, sent.value.thresholds)
            severity = (p @ np.arange(p.shape[1])).round(6)
            toxic = 1 - p[:, 0]
            rows = zip(
                block["doc_id"].to_pylist(), p.argmax(axis=1).tolist(), severity.tolist(),
                toxic.round(6).tolist(), (toxic >= least).tolist(),
            )
            yield record_batch(list(rows), kinds)

    return docs.select("doc_id", "text").mapInArrow(predict, schema)
