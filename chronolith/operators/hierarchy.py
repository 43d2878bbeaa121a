"""Reflexive-transitive closure and searches on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chronolith.operators.lineage import cut


def closure(edges: DataFrame, nodes: DataFrame, child: str = "child", parent: str = "parent", max_depth: int = 64) -> DataFrame:
    """Rows (node, ancestor, depth), each node its own at 0; semi-naive, so cycles and diamonds end. Depth is the least.

    Each round's new pairs and all pairs so far are written to the checkpoint folder, so that a round's plan
    is one join and one anti join, however deep the hierarchy. Deeper than ``max_depth`` is an error.
    """
    every = nodes.select(F.col(nodes.columns[0]).alias("node")).distinct().select("node", F.col("node").alias("ancestor"), F.lit(0).alias("depth"))
    every = front = cut(every)
    e = cut(edges.where(F.col(parent).isNotNull()).select(F.col(child).alias("ancestor"), F.col(parent).alias("up")).distinct())
    for depth in range(1, max_depth + 1):
        new = front.join(e, "ancestor").select("node", F.col("up").alias("ancestor"), F.lit(depth).alias("depth")).distinct()
        new = cut(new.join(every.select("node", "ancestor"), ["node", "ancestor"], "left_anti"))
        if new.isEmpty():
            return every
        every, front = cut(every.union(new)), new
    raise ValueError(f"deeper than {max_depth}")


def subject_search(links: DataFrame, tree: DataFrame, item: str, concept: str, wanted: list, narrower: bool = True) -> DataFrame:
    """Rows (item, subject): items linked with a wanted concept, or (``narrower``) with any concept below it.

    ``links``: (item, concept); ``tree``: (child, parent). The wanted concepts are a parameter, a short list.
    """
    asked = links.sparkSession.createDataFrame([(w,) for w in wanted], f"subject {dict(links.dtypes)[concept]}")
    if narrower:
        nodes = links.select(concept).union(tree.select("child")).distinct()
        up = closure(tree, nodes).join(F.broadcast(asked), F.col("ancestor") == F.col("subject"), "left_semi")
        hit = links.join(up, F.col(concept) == F.col("node")).select(item, F.col("ancestor").alias("subject"))
    else:
        hit = links.join(F.broadcast(asked), F.col(concept) == F.col("subject")).select(item, "subject")
    return hit.distinct()
