"""Tables of one warehouse root: versioned Parquet folders with declared schemas, and CSV staging.

A table that is refreshed as a whole lies in ``versions/version=N``. A refresh writes a new version beside the old one and then
creates one small pointer file, by a rename; until that, readers see the version before, and a job that dies leaves it as it was. A
reader is bound to the version it was opened with: the one before the current stays until the next refresh. Of a
partitioned table only the partitions whose rows have changed are written again, and the pointer names the version of each.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runatlas.schemas import RECORD_SCHEMA

_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder name of a null
_CODEC = "zstd"  # of refreshed tables; not of dimensions, as Spark tells from the size of their files whether to broadcast them
KEPT_VERSIONS = 2  # pointers whose folders stay: the current one and that before


@dataclass(frozen=True)
class Version:
    """A number, and the folders (under ``versions``) of the table's partitions; one entry ``""`` if it has none."""

    number: int
    folders: dict[str, str]


class ConcurrentRefresh(RuntimeError):
    """Another job has refreshed the table meanwhile."""


@dataclass(frozen=True)
class TableStore:
    """Reads and writes the tables under ``root``."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _fs(self, path: str):
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), place

    def _names(self, path: str) -> list[str]:
        fs, place = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []

    # --- pointers ---

    def _pointer(self, name: str, number: int) -> Version:
        fs, place = self._fs(f"{self.path(name)}/pointers/{number:08d}")
        stream = fs.open(place)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Version(number, json.loads(text))

    def _numbers(self, name: str) -> list[int]:
        return sorted(int(n) for n in self._names(f"{self.path(name)}/pointers") if n.isdigit())

    def current(self, name: str) -> Version | None:
        """The version that readers see; None for a table that is not versioned or not there."""
        numbers = self._numbers(name)
        return self._pointer(name, numbers[-1]) if numbers else None

    def _switch(self, name: str, version: Version) -> None:
        folder = f"{self.path(name)}/pointers"
        fs, draft = self._fs(f"{folder}/_draft-{uuid.uuid4().hex}")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(version.folders), "utf-8"))
        out.close()
        _, final = self._fs(f"{folder}/{version.number:08d}")
        if fs.exists(final) or not fs.rename(draft, final):
            fs.delete(draft, False)
            raise ConcurrentRefresh(f"{name} has got version {version.number} from another job")

    def _sweep(self, name: str) -> None:
        """Remove what no kept pointer names."""
        numbers = self._numbers(name)
        kept = {folder.split("/")[0] for n in numbers[-KEPT_VERSIONS:] for folder in self._pointer(name, n).folders.values()}
        for n in numbers[:-KEPT_VERSIONS]:
            fs, place = self._fs(f"{self.path(name)}/pointers/{n:08d}")
            fs.delete(place, False)
        for folder in self._names(f"{self.path(name)}/versions"):
            if folder not in kept and int(folder.removeprefix("version=")) <= numbers[-1]:
                fs, place = self._fs(f"{self.path(name)}/versions/{folder}")
                fs.delete(place, True)

    # --- reading ---

    def exists(self, name: str) -> bool:
        if self.current(name):
            return True
        try:
            self.spark.read.text(self.path(name))
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
        return True

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        version = self.current(name)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        if version is None:
            return reader.parquet(self.path(name))
        base = f"{self.path(name)}/versions"
        folders = [f"{base}/{folder}" for folder in version.folders.values()]
        return reader.option("basePath", base).parquet(*folders).drop("version")

    # --- writing ---

    def overwrite(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        """Full refresh, seen by readers all at once.

        Partitioned tables are rebalanced first: files of even size, and a partition with very many rows is split over several
        tasks. Their partitions that hold the same rows as before are left as they are.
        """
        schema, before = df.schema, self.current(name)
        number, kept = (before.number if before else 0) + 1, {}
        if partition_by and before and set(before.folders) != {""}:
            changed, same = self._changed(df, self.read(name, schema), partition_by)
            kept = {p: before.folders[p] for p in same}
            values = [v for v in changed if v is not None]
            wanted = F.col(partition_by).isin(values) if values else F.lit(False)
            df = df.filter(wanted | F.col(partition_by).isNull() if None in changed else wanted)
        folder = f"{self.path(name)}/versions/version={number}"
        writer = (df.hint("rebalance", partition_by) if partition_by else df).write.mode("overwrite").option("compression", _CODEC)
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(folder)
        new = {n.split("=", 1)[1]: f"version={number}/{n}" for n in self._names(folder) if partition_by and "=" in n}
        folders = kept | new or {"": f"version={number}"}
        self._switch(name, Version(number, folders))
        self._sweep(name)
        return self.read(name, schema)

    @staticmethod
    def _changed(new: DataFrame, old: DataFrame, partition_by: str) -> tuple[list, list[str]]:
        """Values of the partitions whose rows differ, and folder names of those that are the same.

        Rows are compared by count and sum of hashes; one row for each partition comes to the driver.
        """

        def sums(df: DataFrame) -> dict:
            # Double zeros and the order of columns do not count; a null is told from any value.
            cells = [c for column in sorted(new.columns) for c in (F.col(column), F.col(column).isNull())]
            hashes = [F.sum(F.xxhash64(F.lit(seed), *cells).cast("decimal(20,0)")).alias(f"h{seed}") for seed in (1, 2)]
            rows = df.groupBy(partition_by).agg(F.count(F.lit(1)).alias("n"), *hashes).collect()
            return {r[partition_by]: (r["n"], r["h1"], r["h2"]) for r in rows}

        now, then = sums(new), sums(old)
        same = [v for v in now if then.get(v) == now[v]]
        return [v for v in now if v not in same], [_NULL_PARTITION if v is None else str(v) for v in same]

    def remove(self, name: str) -> None:
        """Delete a table that nothing reads any more, with all its versions."""
        fs, place = self._fs(self.path(name))
        fs.delete(place, True)

    def append(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("append").parquet(self.path(name))
        return self.read(name)


CSV_RECORDS = 500_000  # of a written file, at most: some 150 MB of text


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header, in gzip and in files of bounded size, as such a file is not split. Timestamps keep their microseconds."""
    (
        df.write.mode("overwrite")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", CSV_RECORDS)
        .option("header", True)
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .csv(path)
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType = RECORD_SCHEMA) -> DataFrame:
    """A clean CSV with the declared column types."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")
        .csv(path)
    )
