"""Connected components of a graph given as an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.llm.common import written

MAX_ROUNDS = 60  # the number of rounds grows with the logarithm of the longest path


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b), any order, repeats and loops allowed -> (node, label), smallest node as label.

    Each round hooks every node's larger neighbours to its smallest one, then the same for smaller
    neighbours, until every node of a component hangs on its smallest node. A round is two
    aggregations (combined before the shuffle) and two joins, so a node with very many neighbours
    is never gathered in one task. Rounds are cut by written tables. Null ends are ignored.
    An empty edge table gives an empty result.
    """
    pairs = edges.select("a", "b").where("a <> b")
    pairs = written(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            joined.select("u", F.col("m").alias("v"))
        )
        pairs = written(small.where("u <> v").distinct(), "edges")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("label"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots).distinct()
