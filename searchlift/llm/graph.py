"""Connected components of a graph given as edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchlift.llm.tables import stored


def components(edges: DataFrame) -> DataFrame:
    """`node, component` for every node of `edges(a, b)`; a component is named by its least node.

    Large stars hang each node's larger neighbours on its least one, small stars its smaller ones; both keep the
    components and end in one star for each. Neighbourhoods are only ever reduced to a minimum, which combines before
    the shuffle, and joined back, where Spark can split a node with many edges. Loops and null ends count as nothing.
    """
    current = stored(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = None
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.join(least, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b")
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        current = stored(small, "edges")
        state = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
