"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm.common import write_shared


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable from each node that has a link.

    ``links`` has two long columns ``u`` and ``v``; direction, repeats and
    self-links do not matter.  Each round replaces every link by links to the
    smallest neighbour seen from either side, which keeps reachability and
    shrinks the paths; it ends when nothing changes.  A node's neighbours are
    never gathered: their minimum is a partially aggregated ``min``, written to
    the shared folder, and the join back is a plain equi-join whose hot keys
    adaptive execution can split.  Only a count per round reaches the driver.
    """
    e = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = write_shared(e, "links")
    mark = None
    for _ in range(max_rounds):
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
        # large star: neighbours that are larger go to the smallest neighbour
        both = e.union(e.select("v", "u"))
        m = write_shared(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "mins")
        large = both.where("v > u").join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = write_shared(large.where("u <> v").distinct(), "links")
        # small star: smaller neighbours and the node itself go to the smallest neighbour
        m = write_shared(large.groupBy("u").agg(F.min("v").alias("m")), "mins")
        small = large.join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(m.select("u", F.col("m").alias("v")))
        e = write_shared(small.where("u <> v").distinct(), "links")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    own = e.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(own).groupBy("node").agg(F.min("component").alias("component"))
