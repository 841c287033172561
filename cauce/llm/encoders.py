"""Whole texts to token ids with the tokenizers library, one call per distinct piece.

Texts are cut by ``pieces.chunks``. Tokenizers that split a text into runs of
letters, digits and signs first, with or without the space before, never match
across such a cut, so the ids are those of the whole text.
"""

import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from cauce.llm import pieces as P


def _memo(path: str) -> P.Memo:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True  # their strings in a text are ordinary text

    def compute(pieces: list[bytes]) -> list[bytes]:
        texts = [piece.decode() for piece in pieces]
        found = model.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    return P.Memo(compute)


def encode(path: str, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows, ``end_id`` after each, and the row offsets. NULL counts as empty."""
    memo = P.one_in_worker(("encoder", path), lambda: _memo(path))
    offsets, data = P.text_bytes(column)
    bounds, first = P.chunks(offsets, data)
    codes, known = P.distinct(bounds, data)
    values, starts = P.ragged(memo(known), "<u4")
    ids, ends = P.gather(values, starts, codes)
    rows = ends[first]
    return np.insert(ids, rows[1:], end_id), rows + np.arange(len(rows))


def encoded(
    batches: Iterator[pa.RecordBatch], path: str, text: str, end_id: int
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for block in P.blocks(batches, text):
        yield block, *encode(path, block[text], end_id)
