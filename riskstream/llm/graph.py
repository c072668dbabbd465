"""Connected components of a graph whose edges are a distributed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the least node it knows."""
    both = edges.union(edges.select("low", "high")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("v")).select(
        "u", F.least("u", "v").alias("least")
    )
    return (
        both.join(least, "u")
        .where("v > u")
        .select(F.col("v").alias("high"), F.col("least").alias("low"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands its smaller neighbours, and itself, to the least of them."""
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    handed = edges.join(least, "high").where("low > least").select(
        F.col("low").alias("high"), F.col("least").alias("low")
    )
    return handed.union(least.select("high", F.col("least").alias("low"))).distinct()


def components(
    edges: DataFrame, scratch: Scratch, name: str, rounds: int | None = None
) -> DataFrame:
    """(node, root): the least node each linked node can reach; ``edges`` are (a, b).

    With ``rounds``, only a reachable node, the least after so many rounds.

    Alternating stars never add edges, so a round moves no more than the input; a
    node of many edges is split by adaptive execution. Rounds grow with the
    logarithm of the longest path.
    """
    rows = edges.where("a <> b").select(
        F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")
    ).distinct()
    rows = scratch.keep(rows, f"{name}-0")
    done, number = None, 0
    while number != rounds and not rows.isEmpty():
        number += 1
        rows = scratch.keep(_small_star(_large_star(rows)), f"{name}-{number}")
        scratch.drop(f"{name}-{number - 1}")
        if rounds is None:
            seen = rows.select(
                F.count("*"), F.bit_xor(F.xxhash64("high", "low")), F.bit_xor(F.xxhash64("low"))
            ).first()
            if seen == done:
                break
            done = seen
    stars = rows.toDF("node", "root")
    if rounds is not None:
        # A node that others point to may point on itself.
        own = stars.groupBy("node").agg(F.min("root").alias("root"))
        return own.union(
            stars.select(F.col("root").alias("node")).distinct()
            .join(own.select("node"), "node", "left_anti").select("node", "node")
        )
    return stars.union(stars.select("root", "root").distinct())
