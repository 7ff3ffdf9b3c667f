"""Connected components of a link table, by tables instead of driver memory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.shared import stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every linked node.

    ``links`` has ``a`` and ``b`` (long), in any order, repeats allowed; nulls are skipped.
    Every round takes the smallest root among a node's neighbours and then the root's
    root. Each round's table is written, so lost executors cost one round at most and both
    sides of each join are plain tables, which adaptive execution splits at hot nodes.
    """
    edges = links.where("a is not null and b is not null and a <> b").select("a", "b")
    edges = stored(edges.union(edges.select("b", "a")).distinct(), "edges")
    roots = stored(
        edges.groupBy(F.col("a").alias("node")).agg(
            F.least(F.first("a"), F.min("b")).alias("root"), F.lit(True).alias("changed")
        ),
        "roots",
    )
    while roots.where("changed").limit(1).count():
        near = (
            edges.join(roots.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("low"))
        )
        lower = stored(
            roots.join(near, "node").select(
                "node", F.col("root").alias("old"), F.least("root", "low").alias("root")
            ),
            "lower",
        )
        above = lower.select(F.col("node").alias("root"), F.col("root").alias("top"))
        roots = stored(
            lower.join(above, "root").select(
                "node", F.col("top").alias("root"), (F.col("top") != F.col("old")).alias("changed")
            ),
            "roots",
        )
    return roots.select("node", "root")
