"""The tiered id index: nothing lost, few files, and runs that no filter points at are not read."""

import pytest
from pyspark.sql import functions as F

from runatlas.streaming import id_index
from runatlas.streaming.id_index import IdIndex


def ids(spark, first, n):
    return spark.range(first, first + n, 1, 2).select(F.concat(F.lit("e-"), F.col("id").cast("string")).alias("stream_entry_id"))


def known(index, wanted, batch):
    found = index.known(wanted, batch)
    out = set() if found is None else {r[0] for r in found.collect()}
    index.release()
    return out


@pytest.mark.parametrize("fan", [2, 3])
def test_every_id_is_found_whatever_was_merged(spark, tmp_path, fan):
    index = IdIndex(spark, str(tmp_path / "ids"), fan)
    for batch in range(10):
        asked = ids(spark, 0, 10 * batch + 10)
        assert known(index, asked, batch) == {f"e-{k}" for k in range(10 * batch)}
        index.add(ids(spark, 10 * batch, 10), batch)
        # The same batch again does not find itself, and replaces its run.
        assert known(index, asked, batch) == {f"e-{k}" for k in range(10 * batch)}
        index.add(ids(spark, 10 * batch, 10), batch)
    assert sum(r["count"] for r in index._read(index.live()).groupBy("batch_id").count().collect()) == 100
    assert len(index.live()) <= (fan - 1) * 4 + 1


def test_files_stay_few_over_three_hundred_batches(spark, tmp_path):
    """Fewer than ``FAN`` runs a level, with a file of ids and one filter file each, and the current batch."""
    index = IdIndex(spark, str(tmp_path / "ids"))
    most = 0
    for batch in range(301):
        index.add(ids(spark, batch, 1).coalesce(1), batch)
        most = max(most, len(index.live()))
        if batch % 64 == 1:
            assert index.files() <= 2 * len(index.live())
    assert most <= 3 * (id_index.FAN - 1) + 1
    assert index.files() <= 2 * most
    assert known(index, ids(spark, 290, 30), 999) == {f"e-{k}" for k in range(290, 301)}


def test_new_ids_do_not_read_merged_runs(spark, tmp_path, monkeypatch):
    index = IdIndex(spark, str(tmp_path / "ids"), 2)
    for batch in range(5):
        index.add(ids(spark, 1000 * batch, 1000), batch)
    (merged,) = [n for n in index.live() if index._parts(n)[2]]
    assert index._parts(merged)[:2] == (0, 3)
    reads = []
    plain = index._read
    monkeypatch.setattr(index, "_read", lambda names, kind="runs": (reads.append((kind, tuple(names))), plain(names, kind))[1])
    recent = {f"e-{k}" for k in range(4000, 5000)}  # of a run without a filter all ids come back
    assert known(index, ids(spark, 10**6, 3), 9) == recent
    assert ("runs", (merged,)) not in reads
    assert known(index, ids(spark, 1500, 3), 9) - recent == {"e-1500", "e-1501", "e-1502"}
    assert ("runs", (merged,)) in reads


def test_filters_lose_nothing_and_let_few_others_through(spark, tmp_path):
    index = IdIndex(spark, str(tmp_path / "ids"), 2)
    for batch in range(3):
        index.add(ids(spark, 20_000 * batch, 20_000), batch)
    merged = [n for n in index.live() if index._parts(n)[2]]
    assert index._parts(merged[0])[2] > 1
    assert index.maybe_known(ids(spark, 0, 40_000), merged).count() == 40_000
    assert index.maybe_known(ids(spark, 10**6, 40_000), merged).count() < 40_000 * 0.03


def test_a_run_without_its_marker_does_not_count(spark, tmp_path):
    index = IdIndex(spark, str(tmp_path / "ids"), 2)
    index.add(ids(spark, 0, 5), 0)
    ids(spark, 5, 5).withColumn("batch_id", F.lit(1)).write.parquet(index._folder("runs", "0-1-1"))  # a merge that was killed
    assert index.live() == ["0-0-0"]
    assert known(index, ids(spark, 0, 9), 2) == {f"e-{k}" for k in range(5)}
