"""Connected components of an edge table by alternating large and small stars.

Each round points every node's neighbours at the smallest node it knows (Kiveris et al.,
2014). Only grouped minima and joins are used, so no neighbour list is ever held in one
place, and the number of rounds grows with the logarithm of the component size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import saved


def _with_minimum(edges: DataFrame) -> DataFrame:
    least = saved(edges.groupBy("u").agg(F.min("v").alias("m")), "components-least")
    return edges.join(least, "u")


def _signature(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mixed)).first())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Rows ``(node, root)`` for every node that has an edge to another node.

    ``root`` is the smallest node of the component (it gets a row itself). Self-loops, null
    ends and repeated edges are allowed and change nothing; no edges give no rows.
    """
    ends = edges.select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    ).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    current = saved(ends.distinct(), "components")
    before = _signature(current)
    while before[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            _with_minimum(both)
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        large = saved(large, "components-large")
        small = _with_minimum(large)
        current = saved(
            small.select("u", F.col("m").alias("v"))
            .unionByName(small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")))
            .distinct(),
            "components",
        )
        after = _signature(current)
        if after == before:
            break
        before = after
    pairs = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pairs.unionByName(pairs.select(F.col("root").alias("node"), "root").distinct())
