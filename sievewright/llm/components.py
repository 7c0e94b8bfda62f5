"""Connected components of a distributed graph, by alternating stars.

The edges stay in the shared folder throughout; only a count and a checksum come
to the driver.  Each round hangs every node below its neighbours' least neighbour
(large star) and then every node's lower neighbours below the least of them
(small star), until the edges are stars whose centre is the least node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import cut, discard


def _large_star(edges: DataFrame) -> DataFrame:
    parent = edges.groupBy("hi").agg(F.min("lo").alias("p")).withColumnRenamed("hi", "node")
    up = edges.join(parent, edges.lo == parent.node, "left")
    return up.select("hi", F.coalesce("p", "lo").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    parent = edges.groupBy("hi").agg(F.min("lo").alias("p"))
    pairs = F.array(F.struct(F.col("hi"), F.col("p").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("p").alias("lo")))
    return edges.join(parent, "hi").select(F.inline(pairs)).where("hi <> lo").distinct()


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 64) -> DataFrame:
    """(node, root) for each node that has an edge to another; root is the least node it reaches.

    Edges may repeat, point either way, or join a node to itself (ignored); null
    ends are ignored; no edges give no rows.
    """
    spark = edges.sparkSession
    now, path = cut(edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where(f"{a} is not null and {b} is not null and hi <> lo").distinct(), "edges")
    seen = _checksum(now)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        after, new = cut(_small_star(_large_star(now)), "edges")
        discard(spark, path)
        now, path, was, seen = after, new, seen, _checksum(after)
        if was == seen:
            break
    else:
        raise RuntimeError("components did not settle")
    stars = now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
    roots, _ = cut(stars, "roots")
    discard(spark, path)
    return roots
