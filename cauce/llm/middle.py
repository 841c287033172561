"""Fill-in-middle transformation by scattering the bytes of a batch to their places.

A document is cut twice between its tokens. The three parts stay whole, so the
place of a byte in the output is its place in the input plus a shift that only
changes at a cut: the shifts of all bytes of a batch are the cumulative sum of
an array that is zero but at the cuts, and one numpy assignment moves them. The
marks are then found in the output alone, and the same kind of sum says from
where to gather each byte of the text again.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cauce.llm import pieces as P
from cauce.llm.common import arrow_schema

#: The marks before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_MARKS = np.array([list(PREFIX), list(SUFFIX), list(MIDDLE)], np.uint8)
_WIDTH = len(PREFIX)
#: Order of the parts (prefix 0, middle 1, suffix 2) behind each other, by form.
PLAIN, PSM, SPM = 0, 1, 2
FORMS = np.array(["plain", "psm", "spm"], object)
_ORDER = {PSM: (0, 2, 1), SPM: (2, 0, 1)}
_MARK_OF = {0: 0, 2: 1, 1: 2}


def draws(seed: int, ids: list) -> np.ndarray:
    """Four 32-bit numbers per id, from sha256 of ``<seed>:<id>``; NULL counts as an empty id."""
    texts = (f"{seed}:{'' if i is None else i}" for i in ids)
    found = b"".join(hashlib.sha256(t.encode()).digest()[:16] for t in texts)
    return np.frombuffer(found, ">u4").astype(np.int64).reshape(-1, 4)


def unit_ends(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The end of every token, and each row's first token.

    A token is a word with the white space before it; white space that ends a
    text is one of its own.
    """
    last = np.zeros(len(data), bool)
    space = P.SPACE[data]
    last[:-1] = ~space[:-1] & space[1:]
    filled = np.flatnonzero(np.diff(offsets))
    last[offsets[1:][filled] - 1] = True
    ends = np.flatnonzero(last) + 1
    return ends, np.searchsorted(ends, offsets, side="right")


def places(data: np.ndarray, pattern: bytes) -> np.ndarray:
    """Where ``pattern`` of three bytes begins."""
    a, b, c = pattern
    return np.flatnonzero((data[:-2] == a) & (data[1:-1] == b) & (data[2:] == c))


def marked_rows(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Whether a row's own text holds one of the marks."""
    held = np.zeros(len(offsets) - 1, bool)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        found = places(data, mark)
        row = np.searchsorted(offsets, found, side="right") - 1
        held[row[found + _WIDTH <= offsets[row + 1]]] = True
    return held


def cut(offsets, data, numbers, fim_percent: int, spm_percent: int):
    """Per row: number of tokens, form, and both cuts as places in ``data``."""
    ends, first = unit_ends(offsets, data)
    n = np.diff(first)
    low = np.minimum(numbers[:, 0] % (n + 1), numbers[:, 1] % (n + 1))
    high = np.maximum(numbers[:, 0] % (n + 1), numbers[:, 1] % (n + 1))
    plain = (n == 0) | marked_rows(offsets, data) | (numbers[:, 2] % 100 >= fim_percent)
    form = np.where(plain, PLAIN, np.where(numbers[:, 3] % 100 < spm_percent, SPM, PSM))
    behind = np.append(0, ends)
    cuts = [np.where(k == 0, offsets[:-1], behind[first[:-1] + k]) for k in (low, high)]
    return n, form, *cuts


def _laid(form: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where the three parts of each row begin in the output; the marks stand right before them."""
    to = np.empty_like(sizes)
    for kind, order in _ORDER.items():
        rows = form == kind
        place = starts[rows]
        for part in order:
            place = place + _WIDTH
            to[rows, part] = place
            place = place + sizes[rows, part]
    plain = form == PLAIN
    to[plain] = starts[plain, None] + np.cumsum(sizes[plain], axis=1) - sizes[plain]
    return to


def _shifts(size: int, at: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """For places 0 to ``size``: the last shift at or before each, ``at`` in ascending order.

    Parts may be empty; of several that begin at one place the last one counts,
    since their differences add up.
    """
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, at, np.diff(shift, prepend=0))
    return np.cumsum(steps)[:size]


def scatter(offsets, data, form, cut_a, cut_b) -> tuple[np.ndarray, np.ndarray]:
    """The outputs of all rows: offsets and bytes."""
    begins = np.column_stack([offsets[:-1], cut_a, cut_b])
    sizes = np.diff(np.column_stack([begins, offsets[1:]]), axis=1)
    out = np.zeros(len(offsets), np.int64)
    np.cumsum(np.diff(offsets) + np.where(form == PLAIN, 0, 3 * _WIDTH), out=out[1:])
    to = _laid(form, out[:-1], sizes)
    result = np.empty(out[-1], np.uint8)
    moved = np.arange(len(data)) + _shifts(len(data), begins.ravel(), (to - begins).ravel())
    result[moved] = data
    rows = np.flatnonzero(form != PLAIN)
    for part, mark in _MARK_OF.items():
        result[(to[rows, part] - _WIDTH)[:, None] + np.arange(_WIDTH)] = _MARKS[mark]
    return out, result


def restore(out: np.ndarray, result: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts again, from outputs and forms alone: offsets and bytes."""
    rows = np.flatnonzero(form != PLAIN)
    # A text with a mark in it is plain, and no mark can arise where a part meets one.
    marks = np.empty((3, len(form)), np.int64)
    for i, mark in enumerate((PREFIX, SUFFIX, MIDDLE)):
        found = places(result, mark)
        row = np.searchsorted(out, found, side="right") - 1
        inside = found + _WIDTH <= out[row + 1]
        marks[i, row[inside]] = found[inside]
    sizes = np.zeros((len(form), 3), np.int64)
    begins = np.repeat(out[:-1, None], 3, axis=1)
    plain = form == PLAIN
    sizes[plain, 0] = np.diff(out)[plain]
    for kind, order in _ORDER.items():
        of = rows[form[rows] == kind]
        stops = [*(marks[_MARK_OF[part], of] for part in order[1:]), out[of + 1]]
        for part, stop in zip(order, stops):
            begins[of, part] = marks[_MARK_OF[part], of] + _WIDTH
            sizes[of, part] = stop - begins[of, part]
    offsets = np.zeros(len(out), np.int64)
    np.cumsum(sizes.sum(axis=1), out=offsets[1:])
    to = offsets[:-1, None] + np.cumsum(sizes, axis=1) - sizes
    size = int(offsets[-1])
    origin = np.arange(size) + _shifts(size, to.ravel(), (begins - to).ravel())
    return offsets, result[origin]


def _characters(data: np.ndarray) -> np.ndarray:
    """Code points that begin before each byte, and their number at the end."""
    return np.append(0, np.cumsum((data & 0xC0) != 0x80))


def _digests(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    view = memoryview(np.ascontiguousarray(data))
    bounds = offsets.tolist()
    return pa.array([hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(bounds, bounds[1:])], pa.string())


def fill_in_middle(
    docs: DataFrame,
    seed: int = 42,
    fim_percent: int = 50,
    spm_percent: int = 80,
    digests_only: bool = False,
) -> DataFrame:
    """Per row of (doc_id, text): n, form, the sizes of prefix and middle, and the output.

    n counts tokens: words with the white space before them, and white space that
    ends a text. Both cuts lie after a number of tokens drawn from ``seed`` and
    doc_id, so rows with one doc_id and text are treated alike, and a NULL doc_id
    draws like an empty one. Of texts that can be cut ``fim_percent`` in a hundred
    are, and of those ``spm_percent`` have the suffix first (``spm``), the others
    the prefix (``psm``). A NULL text counts as empty; an empty text, and one that
    holds a mark, is ``plain``: the output is the text and the sizes are NULL.
    Parts may be empty. Texts of any length are one row each; other columns are
    not read; an empty table gives no rows.

    Output columns: output and restored (binary, UTF-8), or with ``digests_only``
    output_sha256 and restored_sha256. restored is rebuilt from output and form.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    last = "output_sha256 string, restored_sha256 string" if digests_only else "output binary, restored binary"
    schema = f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, {last}"
    kinds = arrow_schema(schema)

    def binaries(offsets, data):
        if offsets[-1] >= 1 << 31:
            raise ValueError("a batch of texts must stay below 2 GiB")
        where = pa.py_buffer(offsets.astype(np.int32))
        return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, where, pa.py_buffer(np.ascontiguousarray(data))])

    def transform(batches):
        for block in P.blocks(batches, "text"):
            offsets, data = P.text_bytes(block["text"])
            numbers = draws(seed, block["doc_id"].to_pylist())
            n, form, cut_a, cut_b = cut(offsets, data, numbers, fim_percent, spm_percent)
            out, result = scatter(offsets, data, form, cut_a, cut_b)
            ends = _digests if digests_only else binaries
            before = _characters(data)
            none = form == PLAIN
            columns = [
                block["doc_id"].cast(kinds.field("doc_id").type),
                pa.array(n, pa.int64()),
                pa.array(FORMS[form], pa.string()),
                pa.array(before[cut_a] - before[offsets[:-1]], pa.int64(), mask=none),
                pa.array(before[cut_b] - before[cut_a], pa.int64(), mask=none),
                ends(out, result),
                ends(*restore(out, result, form)),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=kinds)

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(transform, schema)
