"""Exact duplicates by recipes of content-defined chunks, in DataFrame functions alone.

A text is cut into chunks at places that its characters choose. Chunks are
grouped by digest and content once, which proves a digest to stand for one
chunk; then texts are equal when their lists of identifiers are, and no text
moves again.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.llm.common import bucketed, free_name, staged

#: A chunk ends after 512 to 4,096 characters, at the first place where three
#: characters with a code of 1 modulo 4 meet, one of them ASCII white space or a letter.
CHUNK = r"(?s).{512}.{0,3584}?[aeimquy][aeimquy !%)\-159][^aeimquy]|.{1,4096}"


def normalised(text: Column) -> Column:
    """Each run of the bytes 0x09-0x0D and 0x20 as one space; NULL as empty."""
    # A single space is left alone, so that few places are written anew.
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\t-\r][ \t-\r]*| [ \t-\r]+", " ")


def _chunks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def duplicate_groups(rows: DataFrame, row: str = "row") -> DataFrame:
    """Per row of (``row``, doc_id, text): keep_id, group_size, kept and text_sha256.

    ``row`` must tell rows apart. Of equal texts the smallest doc_id stays; of
    rows with the same doc_id the smallest ``row``; NULL doc_ids come last. A
    NULL text equals an empty one. Other columns are not read.
    """
    text = rows.select(F.col(row).alias("row"), "doc_id", normalised(F.col("text")).alias("text"))
    recipes = staged(
        text.select(
            "row",
            "doc_id",
            F.sha2("text", 256).alias("text_sha256"),
            F.transform(_chunks(F.col("text")), lambda c: F.xxhash64(c)).alias("recipe"),
        ),
        "recipes",
    )
    chunks = text.select(F.explode(_chunks(F.col("text"))).alias("chunk"))
    proven = chunks.groupBy(F.xxhash64("chunk").alias("digest"), "chunk").agg(F.lit(1).alias("one"))
    clashes = proven.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest")
    clashes = staged(clashes, "clashes")  # digests of several chunks; mostly none
    unsafe = (
        recipes.select("row", F.explode(F.array_distinct("recipe")).alias("digest"))
        .join(clashes, "digest", "left_semi")
        .select("row", F.lit(True).alias("unsafe"))
        .distinct()
    )
    # Texts with such a digest are told apart by their own checksum as well.
    keyed = recipes.join(unsafe, "row", "left").withColumn(
        "own", F.when(F.col("unsafe"), F.col("text_sha256")).otherwise(F.lit(""))
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    groups = keyed.groupBy("recipe", "own").agg(first, F.count("*").alias("size"))
    # Written, so that the join below may split the rows of a large group.
    groups = staged(groups.filter("size > 1"), "copies")
    joined = keyed.join(groups, ["recipe", "own"], "left")
    return joined.select(
        F.col("row").alias(row),
        "doc_id",
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).alias("group_size"),
        (F.col("first").isNull() | (F.col("first.row") == F.col("row"))).alias("kept"),
        "text_sha256",
    )


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """``duplicate_groups`` of a table whose rows have no number yet, without that number."""
    numbered = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    return duplicate_groups(numbered).drop("row")


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts; all columns stay."""
    row = free_name(docs, "row")
    numbered = bucketed(docs, row)
    dropped = duplicate_groups(numbered, row).filter(~F.col("kept")).select(row)
    return numbered.join(staged(dropped, "dropped"), row, "left_anti").drop(row)
