"""Connected components of links, by alternating stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cauce.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """(id, root) of all ends of ``links`` (a, b): root is the smallest id reachable.

    Every round links the larger neighbours of a node to its smallest one, then
    the smaller ones; links only get fewer or shorter, so the number of rounds
    grows with the logarithm of the nodes. Minima are written before they are
    joined, which lets adaptive joins split a node with very many links. Links
    of a node to itself and repeated ones do no harm; without links the result
    is empty.
    """
    high, low = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = staged(links.filter("a <> b").select(high, low).distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).union(
                edges.select("v", "v").distinct()
            )
        before = state
        both = edges.union(edges.select("v", "u"))
        least = staged(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.distinct(), "large-star")
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        end = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
        small = large.join(least, "u").select(end.alias("u"), F.col("m").alias("v"))
        edges = staged(small.distinct(), "small-star")
