"""Texts of an Arrow batch as bytes, cut into pieces, coded by distinct piece.

Words repeat, so whatever is computed from a word alone is computed once per
distinct word (``Memo``) and gathered for all its places with numpy.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The bytes 0x09-0x0D and 0x20.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def blocks(
    batches: Iterator[pa.RecordBatch], text: str, limit: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(sizes.astype(np.int64)) // limit
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            yield batch.slice(start, stop - start)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row offsets and all bytes; NULL counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64, len(column) + 1, column.offset * 8)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], held[offsets[0] : offsets[-1]]


def words(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words between white space: their offsets, their bytes, and each row's first word."""
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    rows = offsets[:-1][offsets[:-1] < len(data)]
    first[rows] = inside[rows]
    starts = np.flatnonzero(first)
    kept = np.cumsum(inside)
    bounds = np.append(kept[starts] - 1, kept[-1] if len(kept) else 0)
    return bounds, data[inside], np.searchsorted(starts, offsets)


def _shifted(flags: np.ndarray, by: int) -> np.ndarray:
    """``flags`` of the byte ``by`` places before (or after, if negative); False beyond the ends."""
    moved = np.zeros(len(flags), bool)
    if by > 0:
        moved[by:] = flags[:-by]
    else:
        moved[:by] = flags[-by:]
    return moved


def chunks(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of pieces cut where byte-level patterns always end a match, and each row's first piece.

    Such patterns take letters, digits or other signs in runs, each with one
    space before it. So a match ends before a single space, on both sides of a
    single line feed, and between a letter and an ASCII sign. Only ASCII and
    Latin-1 letters are told apart here; near other characters nothing is cut.
    """
    ascii_letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    lead = data == 0xC3
    # C3 97 and C3 B7 are the signs for times and division.
    latin = _shifted(lead, 1) & (data >= 0x80) & (data != 0x97) & (data != 0xB7)
    letter = ascii_letter | latin
    graphic = (data > 32) & (data < 127)
    sign = graphic & ~ascii_letter & ~((data >= 48) & (data <= 57))
    before = _shifted(graphic | latin, 1)
    after = _shifted(graphic | lead, -1)
    feed = (data == 10) & before & after
    cut = np.zeros(len(data) + 1, bool)
    cut[:-1] = ((data == 32) & before & after) | feed | _shifted(feed, 1)
    cut[:-1] |= sign & _shifted(letter, 1)
    cut[offsets] = True
    cut[len(data)] = False
    starts = np.flatnonzero(cut)
    return np.append(starts, len(data)), np.searchsorted(starts, offsets)


def distinct(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The code of each piece and the distinct pieces."""
    if len(offsets) < 2:
        return np.zeros(0, np.int64), []
    held = pa.Array.from_buffers(
        pa.large_binary(),
        len(offsets) - 1,
        [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))],
    ).dictionary_encode()
    return held.indices.to_numpy().astype(np.int64), held.dictionary.to_pylist()


def gather(values: np.ndarray, offsets: np.ndarray, codes: np.ndarray):
    """The runs ``codes`` of ragged ``values`` one after the other, and their offsets."""
    lengths = np.diff(offsets)[codes]
    ends = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(lengths, out=ends[1:])
    places = np.arange(ends[-1]) + np.repeat(offsets[codes] - ends[:-1], lengths)
    return values[places], ends


class Memo:
    """Results of distinct pieces, as bytes; of more than ``limit`` those not used lately are forgotten."""

    def __init__(self, compute: Callable[[list[bytes]], list[bytes]], limit: int = 500_000):
        self.compute, self.limit, self.young, self.old = compute, limit, {}, {}

    def __call__(self, pieces: list[bytes]) -> list[bytes]:
        if len(self.young) + len(pieces) > self.limit // 2:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        found = [young.get(piece) for piece in pieces]
        missing = []
        for i, result in enumerate(found):
            if result is None:
                result = old.get(pieces[i])
                if result is None:
                    missing.append(i)
                else:
                    found[i] = young[pieces[i]] = result
        for i, result in zip(missing, self.compute([pieces[i] for i in missing]) if missing else ()):
            found[i] = result
            if len(pieces[i]) <= 64:
                young[pieces[i]] = result
        return found


_kept: dict = {}


def one_in_worker(key, make: Callable):
    """What ``make`` gives, kept by a worker process until another key is asked for."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def forget() -> None:
    """Let go of what a worker keeps from earlier stages."""
    _kept.clear()


def ragged(results: list[bytes], dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """Results of a ``Memo`` as values and offsets."""
    values = np.frombuffer(b"".join(results), dtype)
    offsets = np.zeros(len(results) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, results), np.int64, len(results)), out=offsets[1:])
    return values, offsets // np.dtype(dtype).itemsize


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over the pieces of each row, zero for a row without any."""
    total = np.zeros((len(first) - 1, *values.shape[1:]), values.dtype)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        total[full] = np.add.reduceat(values, first[:-1][full], axis=0)
    return total
