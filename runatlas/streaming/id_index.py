"""Index of all ids that were ever stored: runs that are merged by tiers, and a Bloom filter for each merged run.

Every micro-batch adds a run of its new ids. At batch numbers that ``FAN ** level`` divides, the runs of the last
``FAN ** level`` batches become one; so there are fewer than ``FAN`` runs a level, each id is
rewritten once a level, and files grow with the ids instead of the batches. A run counts once its marker is there; runs that lie
in a larger one are superseded, and removed.

A merged run has a blocked Bloom filter: an id sets ``PROBES`` bits of one block of 4 KB, a row of the filter's table. A
batch asks the filters first, an eighth of the ids' size, and reads only those runs of which some filter says that they may hold one of its
ids; what it then finds there is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FAN = 8
PROBES = 6
BLOCK_BITS = 32_768  # of one bitmap row
BITS_PER_ID = 10  # about 1 % of unknown ids pass
IDS_PER_FILE = 4_000_000
LISTED = 1_000_000  # ids asked for (a counted bound: some 60 MB) that are broadcast; more are joined by shuffle
_SCHEMA = "stream_entry_id string, batch_id bigint, run string"
_FILTER_SCHEMA = "block bigint, bits binary, run string"
_ID = "stream_entry_id"


def _hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(_ID))


def _block(blocks: Column) -> Column:
    return F.pmod(_hash(1), blocks)


def _places() -> list[Column]:
    """The bits of an id within its block."""
    return [F.pmod(_hash(2 + k), F.lit(BLOCK_BITS)) for k in range(PROBES)]


class IdIndex:
    """Ids under ``root``, with the batch that brought them."""

    def __init__(self, spark: SparkSession, root: str, fan: int = FAN):
        self.spark, self.root, self.fan = spark, root.rstrip("/"), fan
        self._held: list[DataFrame] = []

    # --- runs: folders named by the batches they hold, and how many filter blocks they have (0: none) ---

    def _fs(self, path: str):
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), place

    def _folder(self, kind: str, name: str) -> str:
        return f"{self.root}/{kind}/run={name}"

    def _present(self) -> list[str]:
        fs, place = self._fs(f"{self.root}/runs")
        if not fs.exists(place):
            return []
        names = [s.getPath().getName().removeprefix("run=") for s in fs.listStatus(place)]
        return [n for n in names if fs.exists(self._fs(f"{self._folder('runs', n)}/_DONE")[1])]

    @staticmethod
    def _parts(name: str) -> tuple[int, int, int]:
        first, last, blocks = map(int, name.split("-"))
        return first, last, blocks

    def _split(self) -> tuple[list[str], list[str]]:
        """Names of live and of superseded runs."""
        names = sorted(self._present(), key=lambda n: (self._parts(n)[0], -self._parts(n)[1]))
        live, over, upto = [], [], -1
        for name in names:
            first, last, _ = self._parts(name)
            (over if last <= upto else live).append(name)
            upto = max(upto, last)
        return live, over

    def live(self) -> list[str]:
        return self._split()[0]

    def _delete(self, path: str) -> None:
        fs, place = self._fs(path)
        fs.delete(place, True)

    def _read(self, names: list[str], kind: str = "runs") -> DataFrame:
        reader = self.spark.read.schema(_SCHEMA if kind == "runs" else _FILTER_SCHEMA).option("basePath", f"{self.root}/{kind}")
        return reader.parquet(*[self._folder(kind, n) for n in names])

    def _write(self, ids: DataFrame, name: str) -> None:
        ids.select(_ID, "batch_id").write.mode("overwrite").parquet(self._folder("runs", name))
        fs, marker = self._fs(f"{self._folder('runs', name)}/_DONE")
        fs.create(marker, True).close()

    def files(self) -> int:
        """Number of data files of the index, filters included."""
        count = 0
        for kind in ("runs", "filters"):
            fs, place = self._fs(f"{self.root}/{kind}")
            if fs.exists(place):
                found = fs.listFiles(place, True)
                while found.hasNext():
                    count += found.next().getPath().getName().endswith(".parquet")
        return count

    # --- writing ---

    def add(self, ids: DataFrame, batch_id: int) -> None:
        """Add the new ids of a batch; a replayed batch replaces its own run. Earlier batches are merged when it is their turn."""
        own = ids.select(_ID, F.lit(batch_id).cast("bigint").alias("batch_id"))
        self._write(own.hint("rebalance"), f"{batch_id}-{batch_id}-0")
        span = 1
        while batch_id and batch_id % (span * self.fan) == 0:
            span *= self.fan
        if span > 1:
            # The batches before this one are surely complete.
            self._merge(batch_id - span, batch_id - 1)

    def _merge(self, first: int, last: int) -> None:
        names = [n for n in self.live() if first <= self._parts(n)[0] and self._parts(n)[1] <= last]
        if len(names) > 1:
            rows = self._read(names)
            n = rows.count()
            blocks = max(1, -(-n * BITS_PER_ID // BLOCK_BITS))
            name = f"{first}-{last}-{blocks}"
            positions = F.explode(F.array(*_places())).alias("position")
            bits = rows.select(_block(F.lit(blocks)).alias("block"), positions).groupBy("block").agg(F.bitmap_construct_agg("position").alias("bits"))
            # The filter goes first: a run that has its marker has its filter.
            bits.hint("rebalance").write.mode("overwrite").parquet(self._folder("filters", name))
            self._write(rows.repartition(max(1, -(-n // IDS_PER_FILE)), _ID), name)
        for name in self._split()[1]:
            self._delete(self._folder("runs", name))
            self._delete(self._folder("filters", name))

    # --- reading ---

    def maybe_known(self, ids: DataFrame, names: list[str]) -> DataFrame:
        """``(stream_entry_id, run)`` of the ids that the filters of the runs let through."""
        asked = [(n, self._parts(n)[2]) for n in names]  # a few names a level
        pairs = ids.select(_ID).crossJoin(F.broadcast(self.spark.createDataFrame(asked, "run string, blocks bigint")))
        pairs = pairs.withColumn("block", _block(F.col("blocks")))
        met = pairs.join(self._read(names, "filters"), ["run", "block"])
        for place in _places():
            byte = F.conv(F.hex(F.substring("bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
            met = met.filter(F.getbit(byte, (place % 8).cast("int")) == 1)
        return met.select(_ID, "run")

    def known(self, ids: DataFrame, batch_id: int) -> DataFrame | None:
        """Ids that other batches brought: all of the recent ones, and those among ``ids`` of the merged runs.

        None if there is no other batch yet. ``release`` frees what this holds.
        """
        own = f"{batch_id}-{batch_id}-0"
        found = self._rows_near(ids, [n for n in self.live() if n != own])
        return None if found is None else found.filter(F.col("batch_id") != batch_id).select(_ID)

    def located(self, ids: DataFrame) -> DataFrame | None:
        """``(stream_entry_id, batch_id)`` of those among ``ids`` that are stored; None if nothing is. ``release`` frees what this holds."""
        found = self._rows_near(ids, self.live())
        return None if found is None else found.select(_ID, "batch_id").join(ids.select(_ID), _ID, "left_semi")

    def _rows_near(self, ids: DataFrame, live: list[str]) -> DataFrame | None:
        """The rows of the recent runs, and those of the merged ones that hold an id of ``ids``."""
        if not live:
            return None
        merged = [n for n in live if self._parts(n)[2]]
        recent = [n for n in live if not self._parts(n)[2]]
        found = self._read(recent) if recent else None
        if merged:
            maybe = self.maybe_known(ids, merged).persist()
            self._held.append(maybe)
            counts = {r["run"]: r["count"] for r in maybe.groupBy("run").count().collect()}  # a row for each run
            if counts:
                short = sum(counts.values()) <= LISTED
                older = self._read(sorted(counts)).join(F.broadcast(maybe) if short else maybe, ["run", _ID], "left_semi")
                older = older.select(_ID, "batch_id", "run")
                found = older if found is None else found.unionByName(older)
        return found

    def release(self) -> None:
        """Free what ``known`` holds, once its result has been used."""
        while self._held:
            self._held.pop().unpersist()
