"""Valid records without the list of errors."""

import json
import re

from runatlas.operators.validate import RAW, audit, valid_only, valid_rows
from runatlas.plans import catalog
from runatlas.sources import json_records


def test_the_same_rows_are_valid_with_and_without_the_list(spark, tmp_path, record):
    changes = [{}, {"epochs": "7.5"}, {"loss": float("nan")}, {"status": "lost"}, {"accuracy": None}, {"scheduler": None}, {"source": None},
               {"source": "mlflow"}, {"gpu": 7}, {"batch_size": "32.0"}, {"learning_rate": "n/a"}, {"ram_gb": 0}, {"timestamp": "soon"}, {"dataset": ...}]
    (tmp_path / "raw.json").write_text("\n".join(json.dumps(record(experiment_id=f"run-{n}", **c)) for n, c in enumerate(changes)))
    raw = json_records.read_sources(spark, str(tmp_path / "raw.json"), [])
    left, right = valid_only(raw), valid_rows(audit(raw)).drop(RAW)
    assert left.columns == right.columns and left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
    assert 0 < left.count() < len(changes)


def test_validation_is_compiled_as_one_method_that_the_jvm_compiles(spark, tmp_path):
    line = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz")
    for name, schema in (("lineitem", line), ("orders", "o_orderkey long, o_custkey long, o_orderpriority string"),
                         ("part", "p_partkey long, p_type string, p_size int, p_retailprice double"), ("supplier", "s_suppkey long, s_nationkey int")):
        spark.createDataFrame([], schema).repartition(1).write.parquet(f"{tmp_path}/{name}.parquet")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = catalog.QUERIES["validate_valid"](spark, str(tmp_path))._jdf.queryExecution()
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", plan.explainString(mode))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes and max(sizes) < 8000
    assert "array" not in plan.optimizedPlan().toString().split("Generate")[0]  # no list above the typed columns
