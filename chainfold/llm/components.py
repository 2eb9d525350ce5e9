"""Connected components of an edge table (alternating large and small stars).

Each round hangs every node under the smallest node it knows of; rounds run
until the edges no longer change, a few for any graph. All state stays in
written tables; the driver sees one row of totals per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainfold.storage import discard, write_intermediate


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def component_labels(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges (u, v)``; the label is the smallest node of its component."""
    state = write_intermediate(edges.where("u != v").select("u", "v").distinct(), "edges")
    last = None
    while True:
        step = write_intermediate(_small_star(_large_star(state)).where("u != v").distinct(), "edges")
        total = step.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(state)
        state = step
        if tuple(total) == last:
            break
        last = tuple(total)
    roots = state.select(F.col("v").alias("node")).distinct().withColumn("label", F.col("node"))
    return state.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
