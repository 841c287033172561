"""Tables inside HTML pages, taken apart with built-in expressions.

Works on a DataFrame with one page per row, so pages run in parallel and stay
inside the JVM. Cells that span rows or columns need ``spans=True``, which folds the
cells of a table row by row in Arrow batches; without it they are an error. Out of
scope, and raised as an error rather than misread: tables inside tables.
"""

from collections.abc import Callable
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cauce.sources.typed import sql_text, typed

_SKIPPED = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"
_TABLE = r"(?is)<table\b[^>]*>(.*?)</table\s*>"
_ROW = r"(?is)<tr\b[^>]*>(.*?)(?=<tr\b|</tr\s*>|</t(?:head|body|foot)\b|\z)"
_CELL = r"(?is)<t[dh]\b[^>]*>(.*?)(?=<t[dh]\b|</t[dh]\s*>|\z)"
_TAG = r"(?s)<[^>]*>"
_SPACE = r"[\s\u00a0]+"
_NESTED = r"(?i)<table\b"
_SPAN = r"(?i)<t[dh]\b[^>]*\b(?:rowspan\s*=\s*[\"']?\s*0*(?:[\"'\s>]|[2-9]|1\d)|colspan\s*=\s*[\"']?\s*0*(?:[2-9]|1\d))"
_SECTION = r"(?i)</?t(?:head|body|foot)\b[^>]*>"
# The most rows and columns that the standard lets a cell span.
_MOST_ROWS, _MOST_COLUMNS = 65534, 1000
_REFERENCE = r"^(#\d+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"

# The standard's named references that end in a semicolon.
_NAMED = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}


def _map_text(items: dict[str, str]) -> str:
    return f"map({', '.join(x for name, value in items.items() for x in (sql_text(name), value))})"


# Maps are searched in order, so that names lie in small ones by their first two letters.
_NAMED_MAP = _map_text(
    {
        start: _map_text({name: sql_text(text) for name, text in _NAMED.items() if name[:2] == start})
        for start in sorted({name[:2] for name in _NAMED})
    }
)


def _referenced(piece: Column) -> Column:
    """The text after an ``&``: its reference as a character, then the rest."""
    name = F.regexp_extract(piece, _REFERENCE, 1)
    code = (
        F.when(name.rlike("^#[xX]"), F.conv(F.regexp_replace(name, "^#[xX]0*", "0"), 16, 10))
        .when(name.startswith("#"), F.regexp_replace(name, "^#0*", "0"))
        .try_cast("int")
    )
    is_character = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    numbered = F.when(
        is_character, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    )
    named = F.try_element_at(F.try_element_at(F.expr(_NAMED_MAP), F.left(name, F.lit(2))), name)
    char = F.coalesce(named, numbered)
    rest = F.regexp_replace(piece, r"^[^;]*;", "")
    return F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), piece))


def decode_references(text: Column) -> Column:
    """Character references of ``text`` as characters; unknown ones stay."""
    pieces = F.split(text, "&")
    decoded = F.concat(
        F.element_at(pieces, 1),
        F.array_join(F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), _referenced), ""),
    )
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)


def _cell_text(markup: Column) -> Column:
    plain = decode_references(F.regexp_replace(markup, _TAG, ""))
    return F.trim(F.regexp_replace(plain, _SPACE, " "))


def _cells(row: Column) -> Column:
    return F.transform(F.regexp_extract_all(row, F.lit(_CELL), F.lit(1)), _cell_text)


def _span(tag: Column, name: str, most: int) -> Column:
    """How many rows or columns a cell covers; 0 is the rest of its section's rows."""
    number = F.regexp_extract(tag, rf"(?i)\b{name}\s*=\s*[\"']?\s*(\d+)", 1)
    found = F.when(F.length(number) > 5, most).otherwise(number.try_cast("int"))
    least = F.when(found == 0, most if name == "rowspan" else 1).otherwise(found)
    return F.least(F.coalesce(least, F.lit(1)), F.lit(most))


def _wide_cells(row: Column) -> Column:
    """(text, rows) of the cells of a row, one for each column that a cell covers."""

    def covered(cell: Column) -> Column:
        tag = F.regexp_extract(cell, r"^<[^>]*>", 0)
        held = F.struct(_cell_text(cell).alias("text"), _span(tag, "rowspan", _MOST_ROWS).alias("rows"))
        return F.array_repeat(held, _span(tag, "colspan", _MOST_COLUMNS))

    return F.flatten(F.transform(F.regexp_extract_all(row, F.lit(_CELL), F.lit(0)), covered))


def _folded(rows: list[list[dict]]) -> list[list[str]]:
    """The rows of a section with its spans: cells from above keep their columns.

    Those of a row take the free columns in order; a column that neither fills is blank.
    """
    grid, above = [], {}
    for cells in rows:
        line, below, column = dict(), {}, 0
        for place, (text, left) in above.items():
            line[place] = text
            if left > 1:
                below[place] = text, left - 1
        for cell in cells:
            while column in line:
                column += 1
            line[column] = cell["text"]
            if cell["rows"] > 1:
                below[column] = cell["text"], cell["rows"] - 1
        grid.append([line.get(i, "") for i in range(max(line, default=-1) + 1)])
        above = below
    return grid


def _span_grid() -> Callable[[Column], Column]:
    """Sections of rows of (text, rows) to the rows of the table."""

    @F.arrow_udf("array<array<string>>")
    def grid(tables: pa.Array) -> pa.Array:
        found = [
            None if table is None else [line for rows in table for line in _folded(rows)]
            for table in tables.to_pylist()
        ]
        return pa.array(found, pa.list_(pa.list_(pa.string())))

    return grid


def _spanned_rows(table: Column) -> Column:
    """The rows of a table with spans; a span of rows ends with the head, body or foot it is in."""

    def section(markup: Column) -> Column:
        return F.transform(F.regexp_extract_all(markup, F.lit(_ROW), F.lit(1)), _wide_cells)

    return _span_grid()(F.transform(F.split(table, _SECTION), section))


def _grid(pages: DataFrame, html: str, table_index: int, required: bool, spans: bool) -> DataFrame:
    """Adds ``_grid``, the table as an array of rows of cell texts, in place of ``html``."""
    kept = [c for c in pages.columns if c != html]
    visible = F.regexp_replace(F.col(html), _SKIPPED, "")
    tables = F.regexp_extract_all(visible, F.lit(_TABLE), F.lit(1))
    table = F.get(F.col("_tables"), F.lit(table_index))
    upto = F.slice(F.col("_tables"), 1, table_index + 1)
    checked = F.when(F.exists(upto, lambda t: t.rlike(_NESTED)), F.raise_error(F.lit("nested table")))
    if not spans:
        spanned = F.raise_error(F.lit("cell that spans rows or columns; read with spans=True"))
        checked = checked.when(table.rlike(_SPAN), spanned)
    if required:
        missing = F.raise_error(F.lit(f"no table number {table_index} in the page"))
        checked = checked.when(table.isNull(), missing)
    checked = checked.otherwise(table)
    found = pages.select(*kept, tables.alias("_tables")).select(*kept, checked.alias("_table"))
    if spans:
        rows = _spanned_rows(F.col("_table"))
    else:
        rows = F.transform(F.regexp_extract_all("_table", F.lit(_ROW), F.lit(1)), _cells)
    return found.select(*kept, F.filter(rows, lambda cells: F.size(cells) > 0).alias("_grid"))


def html_rows(
    pages: DataFrame, html: str = "html", table_index: int = 0, spans: bool = False
) -> DataFrame:
    """``row_no`` (0 is the header) and ``cells`` of a table, with the other columns of ``pages``.

    With ``spans`` a cell over several rows or columns stands in each place it covers.
    """
    kept = [c for c in pages.columns if c != html]
    grid = _grid(pages, html, table_index, False, spans)
    return grid.select(*kept, F.posexplode("_grid").alias("row_no", "cells"))


def _named_cell(name: str) -> Column:
    """The cell of a row under the header ``name``; NULL where the row is too short."""
    place = f"nullif(cast(array_position(_header, {sql_text(name)}) AS int), 0)"
    error = f"raise_error({sql_text(f'no column {name} in the table')})"
    return F.expr(f"get(_cells, coalesce({place}, {error}) - 1)")


def html_table(
    pages: DataFrame,
    schema: StructType,
    html: str = "html",
    table_index: int = 0,
    required: bool = False,
    spans: bool = False,
) -> DataFrame:
    """Typed rows of a table; the header row of each page names its columns.

    Keeps the other columns of ``pages`` and adds ``row_no`` from 1. A page
    without the table gives no rows, or an error with ``required``. Numbers may
    have thousands commas. ``spans`` as for ``html_rows``.
    """
    kept = [c for c in pages.columns if c != html]
    grid = _grid(pages, html, table_index, required, spans)
    rows = grid.select(
        *kept,
        F.get(F.col("_grid"), F.lit(0)).alias("_header"),
        F.posexplode(F.slice("_grid", F.lit(2), F.greatest(F.size("_grid"), F.lit(0)))).alias(
            "_pos", "_cells"
        ),
    )
    texts = [_named_cell(name).alias(name) for name in schema.fieldNames()]
    row_no = (F.col("_pos") + 1).alias("row_no")
    cells = rows.select(*kept, row_no, *texts)
    return typed(cells, schema, markers=True, commas=True, kept=(*kept, "row_no"))
