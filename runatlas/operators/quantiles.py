"""Exact continuous quantiles per group, with no group held by one task.

The data are read twice. The first read counts rows per coarse value bucket; the counts (a few thousand
rows per key) are written, and tell which buckets hold the wanted ranks. The second read takes only the values of those
buckets, counted per distinct value. A bucket with more than ``SLOT_ROWS`` values is first cut into slots between values
sampled from its distinct ones, as often as it takes until no slot with a wanted rank has more; so what one task sorts
is bounded however the values cluster.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from runatlas.functions.scalars import order_bucket
from runatlas.session import materialize, workspace

SLOT_ROWS = 1_000_000  # distinct values that one task sorts
BROADCAST_ROWS = 100_000  # located buckets (a counted bound: some 10 MB) that are broadcast; more are joined by shuffle


def neighbours(place: Column) -> Column:
    """The two 0-based ranks between which a place in the sorted values lies."""
    return F.array(F.floor(place), F.ceil(place))


def interpolate(by_rank: Column, place: Column) -> Column:
    """The value at a place, from a map of ranks to values."""
    low = F.element_at(by_rank, F.floor(place))
    high = F.element_at(by_rank, F.ceil(place))
    # Equal neighbours may be infinite, and inf - inf is not a number.
    return F.when(low == high, low).otherwise(low + (high - low) * (place - F.floor(place)))


def wanted_ranks(probs: dict[str, float], count: str = "_count") -> Column:
    """The ranks that the quantiles of ``count`` values need."""
    return F.array_distinct(F.flatten(F.array(*[neighbours((F.col(count) - 1) * F.lit(float(p))) for p in probs.values()])))


def quantile_columns(probs: dict[str, float]) -> list[Column]:
    """The quantiles from ``_count`` and ``_by_rank``."""
    return [interpolate(F.col("_by_rank"), (F.col("_count") - 1) * F.lit(float(p))).alias(name) for name, p in probs.items()]


def _locate(counts: DataFrame, group: Sequence[str], order: str) -> DataFrame:
    """Keep the rows of ``counts`` (``_n`` values each) that hold a wanted rank.

    ``_start`` is the rank at which the group begins; a row that stays carries
    its own, and only its own wanted ranks.
    """
    prior = (
        Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.col("_start") + F.coalesce(F.sum("_n").over(prior), F.lit(0))
    placed = counts.withColumn("_start", start)
    hits = F.filter(
        "_ranks", lambda r: (r >= F.col("_start")) & (r < F.col("_start") + F.col("_n"))
    )
    return placed.withColumn("_ranks", hits).filter(F.size("_ranks") > 0)


def usable(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value)


def bucketed(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``keys``, ``_v`` and its coarse bucket ``_b``; both null where the value is null or not a number."""
    number = F.col(value).cast("double")
    kept = df.select(*keys, number.alias("_given"), F.when(usable(number), number).alias("_v"))
    return kept.withColumn("_b", F.when(F.col("_v").isNotNull(), order_bucket(F.col("_v"))))


def coarse_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Per key and bucket: ``_n`` values; all rows, given values and their sum beside."""
    return bucketed(df, keys, value).groupBy(*keys, "_b").agg(
        F.count("_v").alias("_n"),
        F.count(F.lit(1)).alias("_rows"),
        F.count("_given").alias("_given"),
        F.sum("_given").alias("_sum"),
    )


def buckets_with_ranks(counts: DataFrame, keys: Sequence[str], ranks: Column) -> DataFrame:
    """The rows of ``counts(keys, _b, _n)`` that hold a wanted rank, with ``_start``, ``_ranks`` and ``_count``."""
    kept = counts.filter("_b is not null").select(*keys, "_b", "_n")
    total = F.sum("_n").over(Window.partitionBy(*keys))
    begun = kept.withColumn("_count", total).withColumns({"_ranks": ranks, "_start": F.lit(0).cast("long")})
    return _locate(begun, keys, "_b")


def _written(df: DataFrame, name: str) -> DataFrame:
    return materialize(df, f"{workspace(df.sparkSession)}/quantiles-{uuid.uuid4().hex[:12]}-{name}")


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal columns, nulls equal too; the columns of ``left`` stay, and the others of ``right``."""
    named = right.withColumnsRenamed({c: f"_k_{c}" for c in columns})
    return left.join(named, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in columns], how).drop(*[f"_k_{c}" for c in columns])


def rank_values(values: DataFrame, hits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: ``_count`` and a map ``_by_rank`` of the wanted ranks' values.

    ``values(keys, _b, _v)`` are read once, and only those in the buckets of ``hits`` are shuffled. ``hits`` comes
    from ``buckets_with_ranks`` and should be cheap to read: it is read for its size first.
    """
    keys = list(keys)
    carried = ("_start", "_ranks", "_count")
    rows, most = hits.agg(F.count(F.lit(1)), F.max("_n")).first()
    small = rows <= BROADCAST_ROWS
    group = [*keys, "_b"]
    side = hits.select(*group, *carried)
    near = _same(values.filter("_v is not null"), F.broadcast(side) if small else side, group)
    found = near.groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("_n"), *[F.any_value(c).alias(c) for c in carried])
    cut = 0
    while (most or 0) > SLOT_ROWS:
        # Distinct values only: a slot can always be cut further. Twice as many as needed, as samples are uneven.
        found = _written(found, "values")
        slots = -(-2 * found.count() // SLOT_ROWS)
        cut += 1
        slot = f"_slot{cut}"
        found = _written(found.repartitionByRange(slots, *group, "_v").withColumn(slot, F.spark_partition_id()), "slots")
        sizes = found.groupBy(*group, slot).agg(
            F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_distinct"), *[F.any_value(c).alias(c) for c in carried]
        )
        located = _written(_locate(sizes, group, slot), "located")
        most = located.agg(F.max("_distinct")).first()[0]
        group.append(slot)
        few = located.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        located = located.select(*group, *carried)
        found = _same(found.drop(*carried), F.broadcast(located) if few else located, group)
    picked = _locate(found, group, "_v").select(*keys, "_count", "_v", F.explode("_ranks").alias("_rank"))
    # A few ranks per key are left to gather.
    by_rank = F.map_from_entries(F.collect_list(F.struct("_rank", "_v")))
    return picked.groupBy(*keys, "_count").agg(by_rank.alias("_by_rank"))


def values_at_ranks(df: DataFrame, keys: Sequence[str], value: str, ranks: Column) -> DataFrame:
    """One row per key: ``_count`` and a map ``_by_rank`` of the wanted ranks' values.

    ``ranks`` is an array of 0-based ranks, which may depend on ``_count`` and
    should be few. Nulls and NaN are left out.
    """
    counts = _written(coarse_counts(df, keys, value), "counts")
    return rank_values(bucketed(df, keys, value), buckets_with_ranks(counts, keys, ranks), keys)


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """One row per key: ``_count`` and the interpolated quantile for each name in ``probs``."""
    return values_at_ranks(df, keys, value, wanted_ranks(probs)).select(*keys, "_count", *quantile_columns(probs))


def quantile_summary(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], count: str, mean: str) -> DataFrame:
    """One row per key: all rows, the mean of the value, and its quantiles (null where a key has no number).

    Counts and sums come from the same first read as the quantiles' buckets.
    """
    counts = _written(coarse_counts(df, keys, value), "counts")
    whole = counts.groupBy(*keys).agg(F.sum("_rows").alias(count), (F.sum("_sum") / F.nullif(F.sum("_given"), F.lit(0))).alias(mean))
    ranked = rank_values(bucketed(df, keys, value), buckets_with_ranks(counts, keys, wanted_ranks(probs)), keys)
    tails = ranked.select(*keys, *quantile_columns(probs))
    return _same(whole, tails, keys, "left").select(*keys, count, mean, *probs)
