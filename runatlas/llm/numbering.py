"""Places of rows within their key, without bringing a key together in one task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from runatlas.llm.scratch import Scratch


def _numbered(batches):
    """Rows of a sorted partition, with the partition and the place of the row within the run of its ``key``."""
    part, last, held = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        key = batch.column("key").to_numpy(zero_copy_only=False)
        fresh = np.ones(n, dtype=bool)
        fresh[1:] = key[1:] != key[:-1]
        fresh[0] = last is None or key[0] != last
        begins = np.where(fresh, np.arange(n), -1)
        begin = np.maximum.accumulate(begins)
        place = np.arange(n) - begin
        place[begin < 0] = np.arange(n)[begin < 0] + held
        last, held = key[-1], int(place[-1]) + 1
        more = [pa.array(np.full(n, part, np.int32)), pa.array(place.astype(np.int64))]
        yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "part", "place"])


def with_places(df: DataFrame, key: Column, order: list[Column], scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``pos``: 0, 1, … within ``key`` in the given order; and the table below it, for ``Scratch.drop``.

    ``key`` must not be null. The rows are sorted in ranges, so a key with very many rows lies in several tasks; only the counts of
    the keys at the ranges' ends are added up. ``df`` is read twice (once for the ranges) and should be a written table.
    """
    keyed = df.select(key.alias("key"), *[F.col(f"`{c}`") for c in df.columns])
    ranged = keyed.repartitionByRange("key", *order).sortWithinPartitions("key", *order)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema.fields)
    table = scratch.save(ranged.mapInArrow(_numbered, f"{fields}, part int, place long"), "places")
    # Only the first key of a part can have begun in an earlier one: at most one offset a part.
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = table.groupBy("part", "key").agg(F.max("place").alias("last")).withColumn("offset", F.sum(F.col("last") + 1).over(before))
    offsets = F.broadcast(offsets.filter("offset > 0").select("part", "key", "offset"))
    pos = F.col("place") + F.coalesce("offset", F.lit(0))
    placed = table.join(offsets, ["part", "key"], "left").withColumn("pos", pos.cast("long"))
    return placed.drop("part", "key", "place", "offset"), table
