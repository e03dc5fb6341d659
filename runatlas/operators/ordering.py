"""Global positions and ranks that never sort the whole data in one task.

Rows are split into buckets that follow the wanted order. Only the bucket
sizes, whose number is bounded, meet in one task; each bucket is sorted on
its own and shifted by the size of the buckets before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from runatlas.functions.scalars import order_bucket

HASH_DIGITS = 4  # 16 ** 4 = 65,536 buckets at most


def hash_bucket(*parts: Column) -> Column:
    """First hex digits of the MD5 of the parts: an even spread, equal in every engine."""
    return F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, HASH_DIGITS)


def with_position(
    df: DataFrame,
    bucket: Column,
    order: Sequence[Column | str],
    name: str,
    start: Column | int = 0,
    first: int | None = None,
) -> DataFrame:
    """Number the rows 1, 2, … in the order (bucket, order), plus ``start``.

    ``bucket`` must have at most 65,536 values: its sizes are broadcast. With ``first``, only
    that many rows are kept, and only the buckets that hold them are shuffled.
    """
    start = F.lit(start) if isinstance(start, int) else start
    bucketed = df.withColumn("_bucket", bucket)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_bucket").orderBy(*order)
    placed = bucketed.join(F.broadcast(offsets), "_bucket")
    if first is not None:
        placed = placed.filter(F.col("_offset") < first)
    numbered = (
        placed.withColumn(name, (start + F.col("_offset") + F.row_number().over(inside)).cast("long"))
        .drop("_bucket", "_offset")
    )
    return numbered if first is None else numbered.filter(F.col(name) <= start + first)


def with_rank(df: DataFrame, value: Column, name: str) -> DataFrame:
    """``RANK() OVER (ORDER BY value DESC NULLS FIRST)``.

    Rows are first counted per distinct value, so ties take no room.
    """
    valued = df.withColumn("_value", value.cast("double"))
    counts = valued.groupBy("_value").agg(F.count(F.lit(1)).alias("_n"))
    # Nulls come first, so they sit in a bucket above every number's.
    tiers = counts.withColumn("_tier", F.coalesce(order_bucket(F.col("_value")), F.lit(2**31 - 1)))
    above = Window.orderBy(F.desc("_tier")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tiers.groupBy("_tier")
        .agg(F.sum("_n").alias("_size"))
        .select("_tier", F.coalesce(F.sum("_size").over(above), F.lit(0)).alias("_offset"))
    )
    inside = (
        Window.partitionBy("_tier")
        .orderBy(F.desc_nulls_first("_value"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = tiers.join(offsets, "_tier").select(
        F.col("_value").alias("_ranked"),
        (F.col("_offset") + F.coalesce(F.sum("_n").over(inside), F.lit(0)) + 1)
        .cast("long")
        .alias(name),
    )
    return valued.join(ranks, F.col("_value").eqNullSafe(F.col("_ranked"))).drop("_value", "_ranked")


def sample_n(df: DataFrame, id_column: str, n: int, seed: int) -> DataFrame:
    """Exactly ``n`` rows without replacement, the same at any partitioning.

    The order is that of the MD5 of seed and id. With ``n`` at or above the
    size all rows return.
    """
    mixed = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_column).cast("string")))
    keyed = df.withColumn("_mix", mixed)
    order = [F.col("_mix"), F.col(id_column)]
    return with_position(keyed, F.substring("_mix", 1, HASH_DIGITS), order, "_place", first=n).drop("_mix", "_place")
