"""Connected components of a large graph by random contraction."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerisk.session import drop_staged, stage_table


def components(edges: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """(node, component) of every node of `edges` (a, b); the component is its smallest node.

    Each round every node joins the neighbour that a fresh random order puts first, and the
    graph is contracted; the nodes left shrink by a constant share a round whatever the
    shape. All steps are joins and pre-aggregated groupings of narrow stored tables, so a node
    with very many edges is combined before the shuffle and split by AQE in the join. With
    `rows_per_task` the stored tables get about so many of the edges (for the labels: of the first
    round's edges) a task, so late rounds, which have few, are not spread over every shuffle partition.
    """

    def stored(df: DataFrame, label: str, parts: int) -> DataFrame:
        return stage_table(df.coalesce(parts) if parts else df, label)

    left = stage_table(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    labels, turn, widest = None, 0, 0
    while not left.isEmpty():
        turn += 1
        tasks = max(1, math.ceil(left.count() / rows_per_task)) if rows_per_task else 0
        widest = max(widest, tasks)
        rank = lambda c: F.xxhash64(F.col(c), F.lit(turn))  # noqa: B023, E731
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min(F.struct(rank("b").alias("r"), F.col("b").alias("b"))).alias("m"))
        own = F.struct(rank("a").alias("r"), F.col("a").alias("b"))
        moves = stored(best.select(F.col("a").alias("node"), F.least("m", own)["b"].alias("to")), "moves", tasks)
        if labels is None:
            labels = moves
        else:
            step = moves.withColumnsRenamed({"node": "at", "to": "next"})
            older = labels
            labels = stored(
                older.join(step, F.col("to") == F.col("at"), "left").select("node", F.coalesce("next", "to").alias("to")), "labels", widest
            )
            drop_staged(older)
        x, y = (moves.withColumnsRenamed({"node": n, "to": f"to_{n}"}) for n in ("a", "b"))
        wider = left
        left = stored(
            wider.join(x, "a").join(y, "b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b")).filter("a <> b").distinct(), "edges", tasks
        )
        drop_staged(wider)
        if turn > 1:
            drop_staged(moves)
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    drop_staged(left)
    smallest = stage_table(labels.groupBy("to").agg(F.min("node").alias("component")), "smallest")
    return labels.join(smallest, "to").select("node", "component")
