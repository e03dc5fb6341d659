"""Keyed state of a stream in parts, of which a micro-batch rewrites only those it touches.

A part lies in ``part=P/version=N``: what it held after batch N. The state after a batch is, of each part, its newest version up
to that batch, so a replayed batch starts from the same state and overwrites its own versions. Versions that no replay needs are removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from runatlas.streaming.partials import remove


class KeyedState:
    """Parts under ``root``; ``parts`` may be any values that are fit for folder names."""

    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def _names(self, path: str, prefix: str) -> list[str]:
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = place.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        names = [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []
        return [n.removeprefix(prefix) for n in names if n.startswith(prefix)]

    def _versions(self, part: str) -> list[int]:
        return sorted(int(v) for v in self._names(f"{self.root}/part={part}", "version="))

    def _folder(self, part: str, version: int) -> str:
        return f"{self.root}/part={part}/version={version}"

    def read(self, upto: int, parts: list | None = None, named: str | None = None) -> DataFrame | None:
        """The state after batch ``upto``, of the parts named or of all; None if there is none.

        With ``named`` the part stands in a column of that name, as text.
        """
        folders = []
        for part in self._names(self.root, "part=") if parts is None else map(str, parts):
            if done := [v for v in self._versions(part) if v <= upto]:
                folders.append(self._folder(part, done[-1]))
        if not folders:
            return None
        if named is None:
            return self.spark.read.schema(self.schema).parquet(*folders)
        beside = self.spark.read.schema(f"{self.schema}, part string").option("basePath", self.root).parquet(*folders)
        return beside.withColumnRenamed("part", named).drop("version")

    def write(self, df: DataFrame, part: str, batch_id: int) -> None:
        """New versions of the parts that ``df`` has rows of; the column ``part`` tells which."""
        touched = f"{self.root}/new-{batch_id}"
        df.withColumnRenamed(part, "part").write.mode("overwrite").partitionBy("part").parquet(touched)
        fs = None
        for name in self._names(touched, "part="):
            jvm = self.spark.sparkContext._jvm.org.apache.hadoop.fs
            source, target = jvm.Path(f"{touched}/part={name}"), jvm.Path(self._folder(name, batch_id))
            fs = fs or source.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
            fs.delete(target, True)
            fs.mkdirs(target.getParent())
            if not fs.rename(source, target):
                raise OSError(f"could not move {source} to {target}")
            # A replay of this batch reads the newest version before it; older ones are done with.
            for old in [v for v in self._versions(name) if v < batch_id][:-1]:
                remove(self.spark, self._folder(name, old))
        remove(self.spark, touched)
