import json

import pytest
from pyspark.sql import functions as F

from runatlas.operators.validate import (
    audit,
    audit_events,
    records,
    reject_report,
    rejected_rows,
    valid_rows,
)
from runatlas.sources.json_records import (
    read_json_lines,
    read_json_list,
    read_sources,
    write_rejects,
)


def lines(path, rows):
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))
    return str(path)


def errors_of(spark, tmp_path, rows):
    df = audit(read_json_lines(spark, lines(tmp_path / "in.json", rows)))
    return [r.errors for r in df.orderBy("_row").select("errors").collect()]


@pytest.mark.parametrize(
    ("changes", "expected"),
    [
        ({}, []),
        ({"framework": "Keras", "accuracy": 1.5}, ["framework:enum", "accuracy:range"]),
        ({"learning_rate": "0.001", "batch_size": "32", "epochs": 10.0}, []),
        ({"batch_size": 32.5}, ["batch_size:type"]),
        ({"learning_rate": "fast"}, ["learning_rate:type"]),
        ({"learning_rate": "1.0d"}, ["learning_rate:type"]),
        ({"learning_rate": 0}, ["learning_rate:range"]),
        ({"learning_rate": 1}, ["learning_rate:range"]),
        ({"energy_consumption_kwh": 0}, []),
        ({"training_time_sec": "NaN"}, ["training_time_sec:range"]),
        ({"accuracy": "nan"}, ["accuracy:range"]),
        ({"accuracy": None, "loss": None}, []),
        ({"loss": -0.1}, ["loss:range"]),
        ({"scheduler": ...}, ["scheduler:missing"]),
        ({"status": None}, ["status:missing"]),
        ({"model_name": 7}, ["model_name:type"]),
        ({"source": None}, ["source:type"]),
        ({"source": "other"}, ["source:enum"]),
        ({"timestamp": 1714557600}, []),
        ({"timestamp": "yesterday"}, ["timestamp:type"]),
        ({"timestamp": "10:00:00"}, ["timestamp:type"]),
        ({"timestamp": "T10:00:00"}, ["timestamp:type"]),
        ({"timestamp": "2024-05"}, ["timestamp:type"]),
        ({"timestamp": "2024-05-01"}, []),
        ({"unknown_field": 1}, []),
    ],
)
def test_error_codes(spark, tmp_path, record, changes, expected):
    assert errors_of(spark, tmp_path, [record(**changes)]) == [expected]


def test_defaults_and_provenance(spark, tmp_path, record):
    given = {"source": "mlflow", "mlflow_run_id": "abc", "mlflow_experiment_name": "e"}
    path = lines(tmp_path / "in.json", [record(), record(**given)])
    rows = records(valid_rows(audit(read_json_lines(spark, path)))).collect()
    found = {(r.source, r.mlflow_run_id, r.mlflow_experiment_name) for r in rows}
    assert found == {("synthetic", None, None), ("mlflow", "abc", "e")}


def test_no_record_is_lost(spark, tmp_path, record):
    rows = [record(), "{broken", record(framework="Keras"), "[1, 2]", record(experiment_id=...)]
    audited = audit(read_json_lines(spark, lines(tmp_path / "in.json", rows)))
    assert valid_rows(audited).count() == 1
    rejected = rejected_rows(audited)
    assert rejected.count() == 4
    ids = sorted(r.experiment_id for r in reject_report(rejected).collect())
    assert ids == ["UNKNOWN", "UNKNOWN", "UNKNOWN", "run-7f3a"]
    write_rejects(rejected, str(tmp_path / "rejects"))
    back = spark.read.json(str(tmp_path / "rejects")).collect()
    assert "{broken" in {r.raw_record for r in back}
    assert all(r.validation_error for r in back)


def test_empty_rejects_are_written(spark, tmp_path, record):
    audited = audit(read_json_lines(spark, lines(tmp_path / "in.json", [record()])))
    write_rejects(rejected_rows(audited), str(tmp_path / "rejects"))
    assert spark.read.text(str(tmp_path / "rejects")).count() == 0


def test_list_file_keeps_order_and_keys(spark, tmp_path, record):
    path = tmp_path / "list.json"
    path.write_text(json.dumps([record(experiment_id=f"e{i}", extra=i) for i in range(5)]))
    df = read_json_list(spark, str(path)).orderBy("_row")
    rows = df.select("experiment_id", "raw_record").collect()
    assert [r.experiment_id for r in rows] == [f"e{i}" for i in range(5)]
    assert json.loads(rows[3].raw_record)["extra"] == 3


def test_top_level_must_be_a_list(spark, tmp_path, record):
    path = tmp_path / "object.json"
    path.write_text(json.dumps(record()))
    with pytest.raises(Exception, match="expected a JSON list"):
        read_json_list(spark, str(path)).collect()


def test_sources_merge_in_order(spark, tmp_path, record):
    first = lines(tmp_path / "a.json", [record(experiment_id=f"a{i}") for i in range(2)])
    second = lines(
        tmp_path / "b.json", [record(experiment_id=f"b{i}", source="mlflow") for i in range(2)]
    )
    merged = read_sources(spark, first, [second, str(tmp_path / "absent.json")])
    valid = valid_rows(audit(merged))
    assert valid.count() == 4
    assert valid.filter("source = 'mlflow' AND source_rank = 1").count() == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_sources(spark, str(tmp_path / "absent.json"))


def test_events(spark):
    schema = "model_name string, model_version string, prediction string, ground_truth string, latency_ms string, event_timestamp string"
    rows = [
        ("m", "v1", "0.5", "1.0", "12", "2024-01-01T00:00:00"),
        ("m", "v1", "0.5", "None", "12", "2024-01-01T00:00:00"),
        ("m", "v1", "0.5", None, "-1", "2024-01-01T00:00:00"),
        ("m", None, "x", None, "1", "2024-01-01T00:00:00"),
    ]
    found = audit_events(spark.createDataFrame(rows, schema)).collect()
    assert [r.errors for r in found] == [
        [],
        [],
        ["latency_ms:range"],
        ["model_version:missing", "prediction:type"],
    ]
    assert [r.ground_truth for r in found] == [1.0, None, None, None]


def test_filter_stays_above_the_typed_columns(spark, record):
    raw = spark.createDataFrame([record()]).withColumn("rank", F.lit(1))
    plan = valid_rows(audit(raw))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate")


def test_typed_rejects_keep_their_raw_values(spark, tmp_path):
    raw = spark.createDataFrame([("a", "n/a", None), ("b", "0.1", "16.5")], "experiment_id string, learning_rate string, batch_size string")
    write_rejects(rejected_rows(audit(raw)), str(tmp_path / "rejects"))
    kept = [json.loads(r.raw_record) for r in spark.read.json(str(tmp_path / "rejects")).collect()]
    assert sorted(kept, key=str) == [
        {"experiment_id": "a", "learning_rate": "n/a", "batch_size": None},
        {"experiment_id": "b", "learning_rate": "0.1", "batch_size": "16.5"},
    ]


@pytest.mark.parametrize("name", ["etl_funnel", "dedup_first"])
def test_raw_values_are_written_for_nobody_who_does_not_read_them(spark, name):
    from runatlas.plans import catalog

    plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "to_json" not in plan.lower() and "structstojson" not in plan.lower()


def test_only_faulty_records_keep_their_raw_values(spark, record):
    raw = spark.createDataFrame([(1, "ok", "success"), (None, "x", "lost")], "epochs int, model_name string, status string")
    rows = audit(raw).select("raw_record", "errors").collect()
    assert all(r.errors and json.loads(r.raw_record)["model_name"] in ("ok", "x") for r in rows)
    full = record()
    columns = ", ".join(f"`{c}` string" for c in full)
    (row,) = audit(spark.createDataFrame([tuple(map(str, full.values()))], columns)).collect()
    assert row.errors == [] and row.raw_record is None


def test_rejects_are_written_dense_and_in_files_of_a_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("runatlas.sources.json_records.FILE_RECORDS", 400)
    text = F.concat(F.lit('{"framework": "Keras", "note": "'), F.repeat(F.lit("a b "), 50), F.col("id").cast("string"), F.lit('"}'))
    rejected = spark.range(0, 1000, 1, 1).select(text.alias("raw_record"), F.array(F.lit("framework:enum")).alias("errors"))
    write_rejects(rejected, str(tmp_path / "rejects"))
    files = list((tmp_path / "rejects").glob("part-*"))
    assert len(files) == 3
    assert sum(f.stat().st_size for f in files) * 5 < 1000 * 230
    back = spark.read.json(str(tmp_path / "rejects"))
    assert back.select("raw_record").distinct().count() == 1000
    assert {r.validation_error for r in back.collect()} == {"framework:enum"}


def test_fields_of_a_json_record_are_looked_up_at_once(spark, tmp_path, record):
    read = read_json_lines(spark, lines(tmp_path / "in.json", [record()]))
    plan = read._jdf.queryExecution().analyzed().toString()
    assert plan.count("try_variant_get(") <= 3


def test_csv_staging_is_dense_in_files_of_a_bounded_size(spark, tmp_path, record, monkeypatch):
    from runatlas.sources import tables

    monkeypatch.setattr(tables, "CSV_RECORDS", 400, raising=False)
    one = records(valid_rows(audit(read_json_lines(spark, lines(tmp_path / "in.json", [record()])))))
    rows = one.crossJoin(spark.range(0, 1000, 1, 1)).withColumn("experiment_id", F.concat(F.lit("r"), F.col("id").cast("string"))).drop("id").coalesce(1)
    tables.write_csv(rows, str(tmp_path / "csv"))
    assert len(list((tmp_path / "csv").glob("part-*.csv.gz"))) == 3
    assert tables.read_csv(spark, str(tmp_path / "csv")).exceptAll(rows).isEmpty()


def test_refreshed_tables_take_the_dense_codec(spark, tmp_path):
    from runatlas.sources.tables import TableStore

    store = TableStore(spark, str(tmp_path))
    store.overwrite(spark.range(10), "t")
    assert all(f.name.endswith(".zstd.parquet") for f in tmp_path.rglob("part-*")) and list(tmp_path.rglob("part-*"))
