"""Connected components by alternating star contractions, entirely as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.llm.common import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction. ``large``: larger neighbours are linked to the smallest of the neighbourhood;
    else each node and its smaller neighbours are."""
    if large:
        sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sides = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = sides.groupBy("a").agg(F.min("b").alias("m"))
    joined = sides.join(least.withColumn("m", F.least("a", "m")), "a")
    if large:
        moved = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.filter(F.col("a") != F.col("b")).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)),
            F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)),
        ).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component_id) of every node that ``edges`` (a, b: longs) name; the id is the smallest
    node reachable. Nodes with no edge, self-loops among them, are left out.

    Each round is written to the shared folder. The number of rounds grows with the logarithm of the
    longest path, not with the data. Links of a much-linked node are only ever aggregated or joined.
    """
    current = stored(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
        .distinct(),
        "component-links",
    )
    before = _digest(current)
    while before[0]:
        current = stored(_stars(_stars(current, True), False), "component-links")
        after = _digest(current)
        if after == before:
            break
        before = after
    members = current.select(F.col("a").alias("node"), F.col("b").alias("component_id"))
    centres = current.select(F.col("b").alias("node"), F.col("b").alias("component_id")).distinct()
    return members.unionByName(centres)
