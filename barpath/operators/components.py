"""Connected components of a link table, by star contraction over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barpath.session import materialise


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node that occurs in ``links``; component is the smallest node reachable.

    Alternates the large star (every larger neighbour is hung below the smallest neighbour) and the small star
    (every smaller one too) until no edge moves. Minima are pre-aggregated before they are shuffled and handed back
    by an ordinary join, which adaptive execution can split where one node has very many links. Rounds grow with the
    logarithm of the longest path. Nodes keep their type, which only has to be orderable. Null ends and self links
    carry no information and are ignored; repeated links count once; an empty table gives an empty table.
    """
    edges = (
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct()
    )
    edges = materialise(edges, "edges")
    before = None
    for _ in range(max_rounds):
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges = materialise(small.distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)
