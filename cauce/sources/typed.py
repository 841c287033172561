"""Text columns to declared types, strictly.

The expressions are written as SQL text, one per column: the readers know their
columns by name, and a plan built this way takes few calls to the JVM.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType, StructField, StructType

# Texts that data files use for "no value" (the pandas defaults).
NULL_MARKERS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def sql_text(text: str) -> str:
    """``text`` as an SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_name(name: str) -> str:
    """``name`` as an SQL column name."""
    return "`" + name.replace("`", "``") + "`"


_MARKERS = ", ".join(sql_text(marker) for marker in NULL_MARKERS)


def text_fields(schema: StructType) -> StructType:
    """The fields of ``schema``, all as text."""
    return StructType([StructField(f.name, StringType()) for f in schema.fields])


def _column(field: StructField, markers: bool, required: bool, commas: bool) -> str:
    text = sql_name(field.name)
    if required:
        text = f"coalesce({text}, raise_error({sql_text(field.name + ': missing')}))"
    if markers:
        text = f"if({text} IN ({_MARKERS}), NULL, {text})"
    if isinstance(field.dataType, StringType):
        return text
    if commas and isinstance(field.dataType, NumericType):
        text = f"replace({text}, ',', '')"
    wanted = field.dataType.simpleString()
    message = f"concat({sql_text(f'{field.name}: not a valid {wanted}: ')}, {text})"
    # The error branch is reached only where the cast gives NULL.
    return f"coalesce(try_cast({text} AS {wanted}), if({text} IS NULL, NULL, raise_error({message})))"


def typed(
    df: DataFrame,
    schema: StructType,
    markers: bool = False,
    required: bool = False,
    commas: bool = False,
    kept: tuple[str, ...] = (),
) -> DataFrame:
    """The text columns of ``df`` cast to ``schema``, after the columns ``kept``.

    Text that a type cannot hold is an error that shows the text, with ANSI mode
    on or off; so is a NULL with ``required``. ``markers`` turns the usual texts
    for "no value" into NULL; ``commas`` allows thousands commas in numbers.
    """
    columns = [
        F.expr(_column(field, markers, required, commas)).alias(field.name)
        for field in schema.fields
    ]
    return df.select(*[F.col(sql_name(c)) for c in kept], *columns)
