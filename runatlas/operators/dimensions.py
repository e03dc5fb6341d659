"""Dimensions with stable surrogate keys, and the calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runatlas.operators.keyed import keep_first, missing_from
from runatlas.operators.ordering import hash_bucket, with_position
from runatlas.schemas import DIMENSIONS, RECORD_SCHEMA


def dimension_schema(table: str) -> T.StructType:
    """Surrogate key first, then the natural key and the attributes."""
    key, _, columns = DIMENSIONS[table]
    fields = [T.StructField(key, T.LongType())]
    fields += [T.StructField(name, RECORD_SCHEMA[source].dataType) for name, source in columns.items()]
    return T.StructType(fields)


def dimension_rows(staging: DataFrame, table: str) -> DataFrame:
    """Distinct natural keys of one dimension, with attributes, without surrogate key.

    Optional columns that an older staging table lacks come out as null.
    """
    _, natural, columns = DIMENSIONS[table]
    picked = staging.select(
        *[
            (F.col(source) if source in staging.columns else F.lit(None).cast(RECORD_SCHEMA[source].dataType))
            .alias(name)
            for name, source in columns.items()
        ]
    )
    attributes = [c for c in columns if c not in natural]
    if not attributes:
        return picked.distinct()
    # Staging holds one row per experiment; the order only settles a broken input.
    return keep_first(picked, list(natural), [F.col(c) for c in attributes])


def with_surrogate_keys(rows: DataFrame, table: str, existing: DataFrame | None = None) -> DataFrame:
    """Number new dimension rows after the highest key in use.

    The order is that of the MD5 of the natural key, so numbering spreads over
    tasks and comes out the same on every run.
    """
    key, natural, columns = DIMENSIONS[table]
    start = 0
    if existing is not None:
        start = existing.agg(F.coalesce(F.max(key), F.lit(0))).scalar()
    columns_in_key = [F.col(c) for c in natural]
    numbered = with_position(rows, hash_bucket(*columns_in_key), columns_in_key, key, start)
    return numbered.select(key, *columns)


def new_dimension_rows(staging: DataFrame, table: str, existing: DataFrame | None) -> DataFrame:
    """Rows to append: natural keys that ``existing`` lacks, numbered after it."""
    rows = dimension_rows(staging, table)
    if existing is not None:
        rows = missing_from(rows, existing, DIMENSIONS[table][1])
    return with_surrogate_keys(rows, table, existing)


def calendar(spark: SparkSession, start: str | Column, end: str | Column) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    first, last = (F.lit(d).cast("date") if isinstance(d, str) else d for d in (start, end))
    days = spark.range(1).select(F.explode(F.sequence(first, last)).alias("full_date"))
    day = F.col("full_date")
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day"),
        F.weekday(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )


def new_calendar_rows(days: DataFrame, existing: DataFrame | None) -> DataFrame:
    return days if existing is None else missing_from(days, existing, ["date_key"])
