"""The fact table: one row per run, all attributes replaced by keys."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runatlas.functions.scalars import date_key
from runatlas.schemas import DIMENSIONS, FACT_KEYS, FACT_MEASURES


def attach_keys(staging: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Left-join every dimension on its natural key and keep only its surrogate key.

    No join is hinted: the dimensions are tables of known size, so Spark
    broadcasts those under its threshold and shuffles the experiment one.
    """
    joined = staging
    for table, (key, natural, columns) in DIMENSIONS.items():
        lookup = dims[table].select(key, *[F.col(c).alias(f"_{c}") for c in natural])
        condition = reduce(
            lambda a, b: a & b, [F.col(columns[c]) == F.col(f"_{c}") for c in natural]
        )
        joined = joined.join(lookup, condition, "left").drop(*[f"_{c}" for c in natural])
    return joined.withColumn("date_key", date_key(F.col("timestamp")))


def _resolved():
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in FACT_KEYS])


def fact_rows(keyed: DataFrame) -> DataFrame:
    """Rows whose six keys all resolved, as the fact table stores them."""
    return keyed.filter(_resolved()).select(
        *[F.col(k).cast("long").alias(k) for k in FACT_KEYS],
        "date_key",
        *FACT_MEASURES,
        "status",
        F.col("timestamp").alias("run_timestamp"),
    )


def unresolved_count(keyed: DataFrame) -> DataFrame:
    """How many rows the fact table will not take, and how many it will."""
    return keyed.agg(
        F.count_if(~_resolved()).alias("dropped_rows"),
        F.count_if(_resolved()).alias("kept_rows"),
    )


def out_of_calendar(fact: DataFrame, days: DataFrame) -> DataFrame:
    """Days that the fact table uses and the calendar lacks, with their runs."""
    # One row per day before the join.
    used = fact.groupBy("date_key").agg(F.count(F.lit(1)).alias("run_count"))
    return used.join(days.select("date_key"), "date_key", "left_anti")
