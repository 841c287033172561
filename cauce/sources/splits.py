"""Exact parts of files whose records go over line ends.

Spark reads a file in blocks, and a block may begin anywhere: in a text, in a
nested object, between quotes. A first pass finds what each block changes (open
quotes, depth) for either state it may begin in; the changes of all blocks
before it tell how a block really begins. A second pass cuts each block into
whole records. What is left at its ends, at most one record's part on each side,
is joined with the neighbours' ends. No record moves but those parts.

The driver holds a few numbers for each block.
"""

import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cauce.shared import shared_dir, written

_BLOCK = ["file", "block"]
_WHITE = " \t\r\n"


def _texts(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """(file, block, value): what ``separator`` ends, in the order of the file within a block."""
    found = spark.read.option("lineSep", separator).text(path)
    return found.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
    )


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """The values of each batch, apart for each block; a block may come in several turns."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file = batch["file"].dictionary_encode()
        code, block = file.indices.to_numpy(), batch["block"].to_numpy()
        cuts = np.flatnonzero((np.diff(code) != 0) | (np.diff(block) != 0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield (file.dictionary[int(code[a])].as_py(), int(block[a])), batch["value"].slice(a, b - a)


def _stitched(edges: DataFrame, glue: str) -> DataFrame:
    """(file, text) of the records that begin in one block and end in another.

    ``edges`` has, for each block, the text before its first cut (head), that after the last
    one (tail, NULL without a cut) and whether it has a cut.
    """
    edges = written(edges, shared_dir(edges.sparkSession))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each block, without its text.
    number = F.coalesce(F.sum(F.col("has_cut").cast("long")).over(before), F.lit(0)).alias("number")
    places = edges.select(*_BLOCK, "has_cut").select(*_BLOCK, number)
    ends = edges.join(places, _BLOCK).select(
        "file",
        "block",
        F.inline(
            F.array(
                F.struct(F.col("number"), F.lit(0).alias("side"), F.col("head").alias("text")),
                F.struct((F.col("number") + 1).alias("number"), F.lit(1).alias("side"), F.col("tail").alias("text")),
            )
        ),
    )
    parts = F.sort_array(F.collect_list(F.struct("block", "side", "text")))
    joined = ends.filter("text is not null").groupBy("file", "number").agg(parts.alias("parts"))
    return joined.select("file", F.array_join(F.col("parts.text"), glue).alias("text"))


def _records(texts: DataFrame, cut: Callable, glue: str) -> DataFrame:
    """(file, text) of all records; ``cut`` makes an object that takes the values of one block."""

    def whole(batches):
        for key, found in _cut_blocks(batches, cut):
            if found:
                yield pa.record_batch([pa.array([key[0]] * len(found)), pa.array(found, pa.string())], ["file", "text"])

    def ends(batches):
        for key, cutter in _blocks_cut(batches, cut):
            columns = [[key[0]], [key[1]], [cutter.head], [cutter.tail], [cutter.has_cut]]
            types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], [*_BLOCK, "head", "tail", "has_cut"])

    inside = texts.mapInArrow(whole, "file string, text string")
    edges = texts.mapInArrow(ends, "file string, block long, head string, tail string, has_cut boolean")
    return inside.unionByName(_stitched(edges, glue))


def _cut_blocks(batches, cut):
    last, cutter = None, None
    for key, values in _by_block(batches):
        if key != last:
            last, cutter = key, cut(key)
        yield key, cutter.add(values)


def _blocks_cut(batches, cut):
    last, cutter = None, None
    for key, values in _by_block(batches):
        if key != last:
            if cutter is not None:
                yield last, cutter.finish()
            last, cutter = key, cut(key)
        cutter.add(values)
    if cutter is not None:
        yield last, cutter.finish()


# --- JSON arrays ---------------------------------------------------------------


def _bytes(values: pa.Array) -> np.ndarray:
    """The values, each with the brace that ended it."""
    return np.frombuffer(("}".join(values.to_pylist()) + "}").encode(), np.uint8)


def _levels(data: np.ndarray, in_string: int) -> tuple[np.ndarray, np.ndarray, int]:
    """For each byte: whether it stands in a string, and its change of depth; the state at the end.

    A quote after an odd number of backslashes does not count; no block begins
    between a backslash and what it escapes, since blocks begin after a brace.
    """
    place = np.arange(len(data))
    last_other = np.maximum.accumulate(np.where(data != 92, place, -1))
    slashes = np.append(0, (place - last_other)[:-1])
    quote = (data == 34) & (slashes % 2 == 0)
    inside = (np.cumsum(quote) + in_string) % 2 == 1
    change = np.zeros(len(data), np.int64)
    change[(data == 123) | (data == 91)] = 1
    change[(data == 125) | (data == 93)] = -1
    change[inside] = 0
    return inside, change, int(inside[-1]) if len(data) else in_string


def _json_states(texts: DataFrame) -> dict[tuple[str, int], tuple[int, int]]:
    """For each block: whether it begins in a string, and at which depth."""

    def measure(batches):
        state: dict[tuple[str, int], list[int]] = {}
        for key, values in _by_block(batches):
            data = _bytes(values)
            held = state.setdefault(key, [0, 0, 0])
            # The block's own quotes tell the state here for either state at its begin.
            for first in (0, 1):
                held[1 + first] += int(_levels(data, (held[0] + first) % 2)[1].sum())
            held[0] = _levels(data, held[0])[2]
        for (file, block), found in state.items():
            yield pa.record_batch(
                [pa.array([x]) for x in (file, block, *found)], [*_BLOCK, "quotes", "outside", "inside"]
            )

    schema = "file string, block long, quotes long, outside long, inside long"
    files = defaultdict(list)
    for r in texts.mapInArrow(measure, schema).collect():  # a row for each block
        files[r.file].append(r)
    states = {}
    for file, blocks in files.items():
        in_string, depth = 0, 0
        for r in sorted(blocks, key=lambda r: r.block):
            states[file, r.block] = in_string, depth
            depth += r.inside if in_string else r.outside
            in_string = (in_string + r.quotes) % 2
        # The text after the last brace was counted with a brace that the file does not have.
        if in_string or depth != -1:
            raise ValueError(f"no whole JSON array: {file}")
    return states


class _JsonCut:
    """Cuts a block before each bracket or comma that belongs to the outermost array."""

    def __init__(self, state: tuple[int, int]):
        self.in_string, self.depth = state
        self.open: list[bytes] = []
        self.head: str | None = None
        self.tail: str | None = None
        self.has_cut = False

    def add(self, values: pa.Array) -> list[str]:
        data = _bytes(values)
        inside, change, self.in_string = _levels(data, self.in_string)
        depth = np.cumsum(change) + self.depth
        self.depth = int(depth[-1])
        before = depth - change
        cut = (data == 44) & ~inside & (depth == 1)
        cut |= ((data == 91) & (change > 0) & (before == 0)) | ((data == 93) & (change < 0) & (depth == 0))
        places = np.flatnonzero(cut).tolist()
        raw = data.tobytes()
        found = []
        for a, b in zip([0, *places], [*places, len(raw)]):
            self.open.append(raw[a:b])
            if b < len(raw):
                found += self._closed()
        return found

    def _closed(self) -> list[str]:
        text = b"".join(self.open).decode()
        self.open = []
        if not self.has_cut:
            self.has_cut, self.head = True, text
            return []
        return [text]

    def finish(self):
        text = b"".join(self.open).decode()
        if self.has_cut:
            self.tail = text
        else:
            self.head = text
        return self


def json_elements(spark: SparkSession, path: str) -> DataFrame:
    """(file, text) of the elements of JSON arrays, however the files are laid out.

    A file that does not hold one whole array is an error. Runs a job that finds
    the state at each block's begin.
    """
    texts = _texts(spark, path, "}")
    sent = spark.sparkContext.broadcast(_json_states(texts))
    found = _records(texts, lambda key: _JsonCut(sent.value[key]), "")
    text = F.col("text")
    first = F.left(text, F.lit(1))
    content = F.trim(F.translate(F.substr(text, F.lit(2)), "\t\r\n", "   "))
    wrong = F.raise_error(F.concat(F.lit("no JSON array of objects: "), F.left(text, F.lit(80)), F.lit(" in "), "file"))
    # Texts before the array's bracket and after its end hold white space alone, and the brace of the end.
    around = F.trim(F.translate(F.regexp_replace(text, "^﻿", ""), "\t\r\n", "   "))
    kept = (
        F.when(first.isin("[", ",") & content.startswith("{") & content.endswith("}"), F.lit(True))
        .when((first == "[") & (content == ""), F.lit(False))
        .when((first == "]") & content.isin("", "}"), F.lit(False))
        .when(around == "", F.lit(False))
        .otherwise(wrong.cast("boolean"))
    )
    return found.filter(kept).select("file", F.substr(text, F.lit(2)).alias("text"))


# --- delimited text -------------------------------------------------------------


def _quote_states(texts: DataFrame) -> dict[tuple[str, int], int]:
    """The blocks that begin between quotes."""
    quotes = F.sum(F.regexp_count("value", F.lit('"'))).alias("quotes")
    files = defaultdict(list)
    for r in texts.groupBy(*_BLOCK).agg(quotes).collect():  # a row for each block
        files[r.file].append(r)
    states = {}
    for file, blocks in files.items():
        odd = 0
        for r in sorted(blocks, key=lambda r: r.block):
            if odd:
                states[file, r.block] = 1
            odd = (odd + r.quotes) % 2
        if odd:
            raise ValueError(f"a quote is not closed: {file}")
    return states


class _LineCut:
    """Cuts a block after each line end that is not between quotes."""

    def __init__(self, in_quotes: int):
        self.in_quotes = in_quotes
        # Without open quotes the first line begins a record of its own.
        self.has_cut = not in_quotes
        self.head: str | None = None
        self.tail: str | None = None
        self.open: list[str] = []

    def add(self, values: pa.Array) -> list[str]:
        found = []
        for line in values.to_pylist():
            self.open.append(line)
            if line.count('"') % 2:
                self.in_quotes = not self.in_quotes
            if not self.in_quotes:
                text = "\n".join(self.open)
                self.open = []
                if self.has_cut:
                    found.append(text)
                else:
                    self.has_cut, self.head = True, text
        return found

    def finish(self):
        text = "\n".join(self.open) if self.open else None
        if self.has_cut:
            self.tail = text
        else:
            self.head = text
        return self


def delimited_records(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """(file, text) of the records of delimited files, line ends between quotes included.

    Quotes stand around whole fields; a quote in a field stands twice. Anything
    else is an error. Blank lines are no records. Runs a job that counts each
    block's quotes.
    """
    texts = _texts(spark, path, "\n")
    states = _quote_states(texts)
    sent = spark.sparkContext.broadcast(states)
    found = _records(texts, lambda key: _LineCut(sent.value.get(key, 0)), "\n")
    text = F.regexp_replace(F.regexp_replace("text", "^﻿", ""), "\r$", "")
    sep = re.escape(separator)
    # A quoted field is matched without going back, so that long texts need no deep stack.
    field = rf'(?:[ \t]*+"(?:[^"]++|"")*+"[ \t]*+|[^"{sep}\n]*+)'
    strict = rf"^{field}(?:{sep}{field})*+$"
    whole = F.contains("text", F.lit('"')) & ~F.col("text").rlike(strict)
    wrong = F.raise_error(F.concat(F.lit("a quote inside a field: "), F.left("text", F.lit(80)), F.lit(" in "), "file"))
    checked = F.when(whole, wrong.cast("string")).otherwise(F.replace("text", F.lit("\r\n"), F.lit("\n")))
    return found.select("file", text.alias("text")).filter("trim(text) <> ''").select("file", checked.alias("text"))


# --- XML elements ---------------------------------------------------------------

#: Where a text between two ``>`` may begin: outside of tags, in a comment, in a
#: CDATA section, in an instruction, or in a quoted value of a tag, which may be
#: the row's own tag.
_OUTSIDE, _COMMENT, _CDATA, _INSTRUCTION = "", "--", "]]", "?"
_XML_STATES = (_OUTSIDE, _COMMENT, _CDATA, _INSTRUCTION, '"', "'", '"row', "'row")


def _open_quote(tag: str, quote: str) -> str:
    """The quote that is open at the end of a tag's text; ``quote`` was open before it."""
    for mark in re.findall("[\"']", tag):
        if not quote:
            quote = mark
        elif mark == quote:
            quote = ""
    return quote


def _xml_step(text: str, state: str, row_tag: str) -> tuple[str, int, int]:
    """From a text up to ``>``: the state behind it, and the row tags that it opens and closes."""
    if state in (_COMMENT, _CDATA, _INSTRUCTION):
        return (_OUTSIDE if text.endswith(state) else state), 0, 0
    if state:  # in a quoted value
        quote, own = _open_quote(text, state[0]), state[1:]
        if quote:
            return quote + own, 0, 0
        return _OUTSIDE, 0, int(bool(own) and text.endswith("/"))
    at = text.find("<")
    if at < 0:
        return _OUTSIDE, 0, 0
    tag = text[at + 1 :]
    if tag[:1] in "!?":
        for begin, end in (("!--", _COMMENT), ("![CDATA[", _CDATA), ("?", _INSTRUCTION)):
            if tag.startswith(begin):
                return (_OUTSIDE if tag[len(begin) :].endswith(end) else end), 0, 0
        return _OUTSIDE, 0, 0
    if tag.startswith("/"):
        return _OUTSIDE, 0, int(tag[1:].rstrip() == row_tag)
    own = tag.startswith(row_tag) and tag[len(row_tag) : len(row_tag) + 1] in ("", " ", "\t", "\n", "\r", "/")
    quote = _open_quote(tag, "") if '"' in tag or "'" in tag else ""
    if quote:
        return quote + ("row" if own else ""), int(own), 0
    return _OUTSIDE, int(own), int(own and tag.endswith("/"))


def _xml_states(texts: DataFrame, row_tag: str) -> dict[tuple[str, int], tuple[str, int]]:
    """For each block: the state it begins in, and how many row tags are open there."""

    def measure(batches):
        # For each state a block may begin in: the state now, and the change of depth.
        held: dict[tuple[str, int], list[list]] = {}
        for key, values in _by_block(batches):
            ways = held.setdefault(key, [[state, 0] for state in _XML_STATES])
            for text in values.to_pylist():
                # Ways soon meet in one state, which is followed once.
                steps = {state: _xml_step(text, state, row_tag) for state in {w[0] for w in ways}}
                for way in ways:
                    way[0], opened, closed = steps[way[0]]
                    way[1] += opened - closed
        for (file, block), ways in held.items():
            ends, depths = [w[0] for w in ways], [w[1] for w in ways]
            columns = [pa.array([file]), pa.array([block]), pa.array([ends]), pa.array([depths])]
            yield pa.record_batch(columns, [*_BLOCK, "ends", "depths"])

    files = defaultdict(list)
    schema = "file string, block long, ends array<string>, depths array<long>"
    for r in texts.mapInArrow(measure, schema).collect():  # a row for each block
        files[r.file].append(r)
    states = {}
    for file, blocks in files.items():
        state, depth = _OUTSIDE, 0
        for r in sorted(blocks, key=lambda r: r.block):
            states[file, r.block] = state, depth
            way = _XML_STATES.index(state)
            state, depth = r.ends[way], depth + r.depths[way]
        if state or depth:
            raise ValueError(f"MALFORMED_RECORD: elements that do not end: {file}")
    return states


class _XmlCut:
    """Cuts a block before and after each outermost element with the row's tag."""

    def __init__(self, state: tuple[str, int], row_tag: str):
        self.state, self.depth = state
        self.row_tag = row_tag
        self.open: list[str] = []
        self.head: str | None = None
        self.tail: str | None = None
        self.has_cut = False

    def add(self, values: pa.Array) -> list[str]:
        found = []
        for text in values.to_pylist():
            self.state, opened, closed = _xml_step(text, self.state, self.row_tag)
            if opened and not self.depth:
                at = text.find("<")
                self.open.append(text[:at])
                found += self._closed()
                text = text[at:]
            self.depth += opened - closed
            self.open.append(text + ">")
            if closed and not self.depth:
                found += self._closed()
        return [x for x in found if x.startswith("<" + self.row_tag)]

    def _closed(self) -> list[str]:
        text = "".join(self.open)
        self.open = []
        if not self.has_cut:
            self.has_cut, self.head = True, text
            return []
        return [text]

    def finish(self):
        text = "".join(self.open)
        if self.has_cut:
            self.tail = text
        else:
            self.head = text
        return self


def xml_elements(spark: SparkSession, path: str, row_tag: str) -> DataFrame:
    """(file, text) of the outermost ``row_tag`` elements of XML files, however they are laid out.

    Tags in comments, CDATA sections and instructions are no tags; an element may
    nest others of its name and be an empty tag. Runs a job that finds the state at
    each block's begin.
    """
    texts = _texts(spark, path, ">")
    sent = spark.sparkContext.broadcast(_xml_states(texts, row_tag))
    found = _records(texts, lambda key: _XmlCut(sent.value[key], row_tag), "")
    return found.filter(F.startswith("text", F.lit("<" + row_tag)) & F.col("text").rlike(rf"^<\Q{row_tag}\E[\s/>]"))
