"""Partial results that micro-batches add and readers sum up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runatlas.streaming.ingest import read_if_there

COMPACT_EVERY = 50  # micro-batches whose partial results are merged into one table


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever it is stored; nothing if it is not there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


class Partials:
    """Sums of ``sums`` per ``keys`` under ``root``.

    A replayed batch overwrites its own partial results. Every ``compact_every`` batches those of all earlier
    batches are merged into ``merged/upto=N``; they are removed one compaction later, so a reader that
    began before still finds them.
    """

    def __init__(self, root: str, keys: Sequence[str], sums: Sequence[str], compact_every: int = COMPACT_EVERY):
        self.root, self.keys, self.sums, self.compact_every = root, list(keys), list(sums), compact_every

    def summed(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in self.sums])

    def add(self, partial: DataFrame, batch_id: int) -> None:
        """Store the partial results of one micro-batch."""
        partial.select(*self.keys, *self.sums).write.mode("overwrite").parquet(f"{self.root}/partial/batch_id={batch_id}")
        if batch_id and batch_id % self.compact_every == 0:
            self._compact(partial.sparkSession, batch_id - 1)

    def _newest(self, spark: SparkSession) -> tuple[DataFrame | None, int]:
        merged = read_if_there(spark, f"{self.root}/merged")
        upto = merged.agg(F.max("upto")).first()[0] if merged is not None else None
        return (None, -1) if upto is None else (merged.filter(F.col("upto") == upto), upto)

    def read(self, spark: SparkSession) -> DataFrame:
        """Rows that together count everything once; a key may have several."""
        merged, upto = self._newest(spark)
        later = spark.read.parquet(f"{self.root}/partial").filter(F.col("batch_id") > upto).drop("batch_id")
        return later if merged is None else later.unionByName(merged.drop("upto"))

    def _compact(self, spark: SparkSession, upto: int) -> None:
        """Merge the partial results of all batches up to ``upto``, the last that is surely complete."""
        merged, before = self._newest(spark)
        if before >= upto:
            return
        rows = spark.read.parquet(f"{self.root}/partial").filter(F.col("batch_id").between(before + 1, upto)).drop("batch_id")
        rows = rows if merged is None else rows.unionByName(merged.drop("upto"))
        self.summed(rows).write.mode("overwrite").parquet(f"{self.root}/merged/upto={upto}")
        for old in range(max(0, before + 1 - self.compact_every), before + 1):
            remove(spark, f"{self.root}/partial/batch_id={old}")
