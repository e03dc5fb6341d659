"""List files split into blocks, against ``json.loads``."""

import json
import random

import pytest

from runatlas.sources.json_lists import _pieces, list_elements

TEXTS = ["", "a,b", 'quo"te', "back\\slash", "\\", '\\"', "],[", "{,}", "é中😀", "tab\tline\n", "[1, 2", '"', ",", " "]


def nested(rng: random.Random, depth: int):
    kind = rng.random()
    if depth == 0 or kind < 0.4:
        return rng.choice([*TEXTS, 0, -1.5, 12345678901, True, False, 1e-7])
    if kind < 0.7:
        return [nested(rng, depth - 1) for _ in range(rng.randint(0, 4))]
    return {rng.choice([*TEXTS, "k", "v"]) + str(k): nested(rng, depth - 1) for k in range(rng.randint(0, 4))}


@pytest.fixture
def small_blocks(spark):
    """Files are cut every few bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def cut(size):
        for n in names:
            spark.conf.set(n, str(size) if n.endswith("maxPartitionBytes") else "1")

    yield cut
    for n, value in before.items():
        spark.conf.set(n, value)


def read(spark, path):
    rows = list_elements(spark, str(path)).selectExpr("_file", "pos", "to_json(v) AS j").collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r._file, r.pos)):
        out.setdefault(r._file.rsplit("/", 1)[1], []).append((r.pos, json.loads(r.j)))
    assert all([pos for pos, _ in found] == list(range(len(found))) for found in out.values())
    return {name: [value for _, value in found] for name, found in out.items()}


@pytest.mark.parametrize("size", [37, 1000, 10**6])
def test_lists_equal_json_loads_wherever_they_are_cut(spark, tmp_path, small_blocks, size):
    small_blocks(size)
    rng = random.Random(size)
    want = {}
    for k in range(6):
        values = [nested(rng, 4) for _ in range(rng.choice([1, 2, 5, 12]))]
        style = rng.choice([{"indent": 2}, {"separators": (",", ":")}, {"ensure_ascii": False}, {}])
        text = rng.choice(["", " \n", "\t"]) + json.dumps(values, **style) + rng.choice(["", "\n", " \n"])
        (tmp_path / f"f{k}.json").write_text(text, encoding="utf-8")
        want[f"f{k}.json"] = values
    (tmp_path / "none.json").write_text(" [ \n ] ")
    assert read(spark, tmp_path) == want


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    values = [{"id": k, "text": "x,]\"\\" * (k % 7)} for k in range(3000)]
    (tmp_path / "big.json").write_text(json.dumps(values))
    small_blocks(8000)
    pieces = _pieces(spark, str(tmp_path))
    blocks = {r["_block"]: r["count"] for r in pieces.groupBy("_block").count().collect()}
    assert len(blocks) > 10 and max(blocks.values()) < 3 * min(list(blocks.values())[:-1] or [1]) + 2000
    assert read(spark, tmp_path)["big.json"] == values


@pytest.mark.parametrize("text", ['{"a": 1}', "[1], [2]", "[1, 2", "[1,, 2]", "[1,]", '["a]', "1, 2", "", "[1] x", "[1]]", "[}", "[1] [2]"])
def test_anything_but_one_list_is_an_error(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    if text == "":
        assert read(spark, tmp_path) == {}
        return
    with pytest.raises(Exception, match="expected a JSON list"):
        read(spark, tmp_path)


def test_small_packed_files_are_read_without_a_shuffle(spark, tmp_path):
    import gzip

    from runatlas.sources import json_lists

    values = {f"p{k}.json.gz": [{"id": i, "text": 'x,]"\\{' * (i % 5)} for i in range(k * 50)] for k in range(4)}
    for name, rows in values.items():
        (tmp_path / name).write_bytes(gzip.compress(("﻿ " + json.dumps(rows)).encode()))
    plan = list_elements(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert read(spark, tmp_path) == {name: rows for name, rows in values.items() if rows}
    # A file that unpacks to much more than it takes is not one row.
    (tmp_path / "wide.json.gz").write_bytes(gzip.compress(json.dumps([" " * 1000] * 9000).encode()))
    assert not json_lists._all_small(spark, str(tmp_path))


@pytest.mark.parametrize("text", ["[1]} x", "[1]], [[2]", '[1], "k": 2', '[1]}, {"l": [2]', "null", "[1]]}", '"[1]"'])
def test_what_follows_the_list_of_a_small_file_is_an_error(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match="expected a JSON list"):
        read(spark, tmp_path)
