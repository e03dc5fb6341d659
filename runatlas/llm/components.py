"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runatlas.llm.scratch import Scratch

HUB_SALTS = 8
LISTED_NODES = 1_000_000  # least neighbours up to which they are broadcast (a counted bound: 32 MB); more are joined by shuffle
ROWS_PER_TASK = 100_000


def _with_least(neighbours: DataFrame, rows: int, tasks: int) -> DataFrame:
    """Add to each (u, v) the least of u and all its v; ``rows`` is a bound of the number of nodes.

    The least is aggregated map-side. A short table of them is broadcast; a longer one is joined on u and a
    salt of v. Either way the rows of a hub stay dealt over several tasks.
    """
    least = neighbours.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(tasks)
    if rows <= LISTED_NODES:
        return neighbours.join(F.broadcast(least), "u")
    salts = F.explode(F.sequence(F.lit(0), F.lit(HUB_SALTS - 1)))
    salt = F.pmod(F.xxhash64("v"), F.lit(HUB_SALTS)).cast("int")
    return neighbours.withColumn("salt", salt).join(least.select("u", "m", salts.alias("salt")), ["u", "salt"])


def _state(edges: DataFrame) -> tuple[int, object]:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, component)`` of every node of ``edges(a, b)``; the component is its least node.

    Each round is written to the shared folder. Rounds go on until the edges no
    longer change; they are then stars around the least nodes. Edges with a null end
    or from a node to itself count for nothing; an empty input gives an empty result.
    """
    current = scratch.save(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u > v and a is not null and b is not null")
        .distinct(),
        "edges",
    )
    state = _state(current)
    while True:
        rows = 2 * state[0]
        tasks = max(4, -(-rows // ROWS_PER_TASK))  # the rounds' tables shrink; so do their tasks
        both = current.select("u", "v").union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, rows, tasks).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct().coalesce(tasks)
        large = scratch.save(large, "large")
        starred = _with_least(large, rows, tasks)
        small = (
            starred.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(starred.select("u", F.col("m").alias("v")))
            .filter("u > v")
            .distinct()
            .coalesce(tasks)
        )
        following = scratch.save(small, "stars")
        before, state = state, _state(following)
        scratch.drop(current, large)
        current = following
        if state == before:
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        current.select("v", "v").distinct()
    )
