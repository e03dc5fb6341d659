"""The batch pipeline: raw records -> audited -> clean staging -> star schema -> views."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runatlas.operators import clean as cleaning
from runatlas.operators.dimensions import (
    calendar,
    dimension_schema,
    new_calendar_rows,
    new_dimension_rows,
)
from runatlas.operators.fact import attach_keys, fact_rows
from runatlas.operators.validate import audit, records, rejected_rows, valid_rows
from runatlas.plans.views import Star, register_views
from runatlas.schemas import DIMENSIONS
from runatlas.session import freed_shuffles
from runatlas.sources.json_records import write_rejects
from runatlas.sources.tables import TableStore

logger = logging.getLogger(__name__)

# Default calendar.
CALENDAR_START, CALENDAR_END = "2020-01-01", "2030-12-31"


@dataclass(frozen=True)
class Settings:
    """What a pipeline run may vary."""

    strategy: str = "median"
    calendar_start: str | Column = CALENDAR_START
    calendar_end: str | Column = CALENDAR_END
    skip_etl: bool = False
    skip_warehouse: bool = False
    skip_views: bool = False


def run_etl(
    raw: DataFrame, order: Sequence[Column | str], store: TableStore, strategy: str = "median"
) -> bool:
    """Validate and clean ``raw`` into the ``staging`` table; rejects go to ``rejects``.

    False, and no staging table, if no record is valid. Raw input is read once:
    both branches start from the written ``audited`` table.
    """
    if strategy not in cleaning.STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}")
    with freed_shuffles(store.spark):
        return _run_etl(raw, order, store, strategy)


def _run_etl(raw: DataFrame, order: Sequence[Column | str], store: TableStore, strategy: str) -> bool:
    judged = audit(raw).withColumn("is_valid", F.size("errors") == 0)
    # Written and read once each, so the denser codec pays. Not split by validity: that would sort all rows, and a
    # reader of either kind skips the columns of the other.
    judged.write.mode("overwrite").option("compression", "zstd").parquet(store.path("audited"))
    audited = store.read("audited", judged.schema)
    write_rejects(rejected_rows(audited.filter("NOT is_valid")), store.path("rejects"))
    valid = valid_rows(audited.filter("is_valid"))
    if valid.isEmpty():
        logger.error("no valid record; staging is left as it was")
        return False
    # The medians read the deduplicated rows several times.
    deduped = store.overwrite(records(cleaning.deduplicate(valid, order)), "deduped")
    store.overwrite(cleaning.handle_missing_metrics(deduped, strategy), "staging")
    store.remove("deduped")
    return True


def load_calendar(store: TableStore, start: str | Column, end: str | Column) -> DataFrame:
    """Append the days that the calendar table lacks."""
    days = calendar(store.spark, start, end)
    existing = store.read("dim_date", days.schema) if store.exists("dim_date") else None
    return store.append(new_calendar_rows(days, existing).coalesce(1), "dim_date")


def load_dimensions(store: TableStore, staging: DataFrame) -> dict[str, DataFrame]:
    """Append the dimension rows that staging brings; rows already there keep their keys.

    The dimensions do not depend on each other, so their jobs run side by side.
    """

    def load(table: str) -> DataFrame:
        schema = dimension_schema(table)
        existing = store.read(table, schema) if store.exists(table) else None
        return store.append(new_dimension_rows(staging, table, existing), table)

    with ThreadPoolExecutor(len(DIMENSIONS)) as pool:
        return dict(zip(DIMENSIONS, pool.map(load, DIMENSIONS), strict=True))


def load_fact(store: TableStore, staging: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Rebuild the fact table, partitioned by month."""
    fact = fact_rows(attach_keys(staging, dims))
    by_month = fact.withColumn("run_month", F.floor(F.col("date_key") / 100).cast("int"))
    with freed_shuffles(store.spark):
        return store.overwrite(by_month, "fact_training_run", "run_month")


def load_warehouse(store: TableStore, settings: Settings) -> bool:
    """Calendar, dimensions and fact table from staging; False if staging is empty."""
    staging = store.read("staging")
    if staging.isEmpty():
        logger.error("staging is empty; the warehouse is left as it was")
        return False
    with freed_shuffles(store.spark):
        load_calendar(store, settings.calendar_start, settings.calendar_end)
        load_fact(store, staging, load_dimensions(store, staging))
    return True


def run_pipeline(
    spark: SparkSession,
    raw: DataFrame | None,
    order: Sequence[Column | str],
    root: str,
    settings: Settings = Settings(),
) -> Star | None:
    """All stages in one call. A stage that is skipped must have run before."""
    store = TableStore(spark, root)
    if not settings.skip_etl:
        if raw is None:
            raise ValueError("raw records are needed unless skip_etl is set")
        if not run_etl(raw, order, store, settings.strategy):
            return None
    if not settings.skip_warehouse and not load_warehouse(store, settings):
        return None
    star = Star.load(store)
    if not settings.skip_views:
        register_views(star)
    return star
