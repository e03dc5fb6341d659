"""The driver's order tables seen as run records, tracked runs and prediction events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runatlas.functions.profiles import GPU_PROFILES, MODEL_PROFILES
from runatlas.functions.scalars import f1
from runatlas.schemas import FRAMEWORKS, OPTIMIZERS, SCHEDULERS
from runatlas.session import spread

# Order of the raw records, unique within an experiment id.
RAW_ORDER = ("source_rank", "timestamp", "l_partkey", "l_suppkey", "l_extendedprice")


def raw_order() -> list[Column]:
    return [F.col(c) for c in RAW_ORDER]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(choices, index: Column) -> Column:
    """The choice at a 0-based index."""
    return F.element_at(F.array(*[F.lit(c) for c in choices]), (index + 1).cast("int"))


def _utc(column: str) -> Column:
    return F.col(column).cast("timestamp")


def raw_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw run per line item, with the faults that validation is there to find."""
    lines = spread(table(spark, sf_dir, "lineitem"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", "p_retailprice")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    joined = (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(parts, lines.l_partkey == parts.p_partkey)
        .join(suppliers, lines.l_suppkey == suppliers.s_suppkey)
    )
    disc, tax = F.abs("l_discount"), F.abs("l_tax")
    status = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "failed")
        .when(F.col("o_orderpriority") == "2-HIGH", "running")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "killed")
        .otherwise("success")
    )
    measured = status.isin("success", "failed")
    with_scores = joined.withColumns(
        {
            "_precision": F.when(
                measured & (F.col("l_partkey") % 89 != 0), 1 - 60 * disc * tax
            ),
            "_recall": F.when(measured, 1 - 40 * disc * tax),
        }
    )
    accuracy = (
        F.when(~measured | (F.col("l_partkey") % 97 == 0), F.lit(None).cast("double"))
        .when(F.col("l_orderkey") % 83 == 0, F.lit(1.5))
        .otherwise(1 - 50 * disc * tax)
    )
    f1_score = F.when(F.col("l_orderkey") % 41 == 0, F.col("_recall")).otherwise(
        f1(F.col("_precision"), F.col("_recall"))
    )
    rate = (
        F.when(F.col("l_partkey") % 71 == 0, "n/a")
        .when(F.col("l_partkey") % 67 == 0, "NaN")
        .otherwise(pick(("0.00005", "0.0005", "0.005", "0.05", "0.5"), F.col("l_suppkey") % 5))
    )
    return with_scores.select(
        F.concat(
            F.lit("exp_"), F.col("l_orderkey").cast("string"), F.lit("_"), F.col("l_linenumber").cast("string")
        ).alias("experiment_id"),
        pick([m[0] for m in MODEL_PROFILES], F.col("l_partkey") % 12).alias("model_name"),
        F.col("p_type").alias("dataset"),
        F.when(F.col("l_partkey") % 53 == 0, "Keras")
        .otherwise(pick(FRAMEWORKS, F.col("l_partkey") % 3))
        .alias("framework"),
        F.concat(F.lit("Researcher#"), (F.col("o_custkey") % 10).cast("string")).alias("researcher"),
        pick(OPTIMIZERS, F.col("l_suppkey") % 4).alias("optimizer"),
        F.when(F.col("l_partkey") % 61 != 0, pick(SCHEDULERS, F.col("l_orderkey") % 4)).alias(
            "scheduler"
        ),
        rate.alias("learning_rate"),
        pick(("8", "16.0", "32", "64", "128", "256"), F.col("p_size") % 6).alias("batch_size"),
        F.col("l_quantity").cast("int").alias("epochs"),
        pick([g[0] for g in GPU_PROFILES], F.col("l_suppkey") % 6).alias("gpu"),
        F.concat(F.lit("CPU#"), (F.col("s_nationkey") % 6).cast("string")).alias("cpu"),
        (16.0 * (1 + F.col("s_nationkey") % 4)).alias("ram_gb"),
        (F.col("l_extendedprice") / 10).alias("training_time_sec"),
        (F.col("p_retailprice") / 100).alias("inference_time_ms"),
        F.col("p_retailprice").alias("model_size_mb"),
        (F.col("l_extendedprice") * disc / 1000).alias("energy_consumption_kwh"),
        accuracy.alias("accuracy"),
        F.col("_precision").alias("precision"),
        F.col("_recall").alias("recall"),
        f1_score.alias("f1_score"),
        F.when(measured, 10 * tax).alias("loss"),
        F.when(measured & (F.col("l_suppkey") % 29 != 0), 11 * tax).alias("validation_loss"),
        _utc("l_shipdate").alias("timestamp"),
        status.alias("status"),
        F.when(F.col("l_returnflag") == "R", "mlflow")
        .when(F.col("l_returnflag") == "A", "synthetic")
        .alias("source"),
        F.when(F.col("l_returnflag") == "R", F.md5(F.col("l_orderkey").cast("string"))).alias(
            "mlflow_run_id"
        ),
        F.when(F.col("l_returnflag") == "R", "order-lines").alias("mlflow_experiment_name"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("source_rank"),
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
    )


def prediction_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One prediction per event; the error events have no truth yet."""
    truth = F.get_json_object("props", "$.k").try_cast("double") / 100
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("stream_entry_id"),
        F.col("event_type").alias("model_name"),
        F.concat(F.lit("v"), (F.col("user_id") % 3).cast("string")).alias("model_version"),
        (F.col("value") / 500).alias("prediction"),
        F.when(F.col("event_type") != "error", truth).alias("ground_truth"),
        F.col("value").alias("latency_ms"),
        # Left without a cast, so that a bound on it reaches the scan.
        F.col("ts").alias("event_timestamp"),
    )


def late_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truths of two thirds of the error events, each half an hour late."""
    events = table(spark, sf_dir, "events")
    return events.filter((F.col("event_type") == "error") & (F.col("event_id") % 3 != 0)).select(
        F.col("event_id").alias("stream_entry_id"),
        (F.get_json_object("props", "$.k").try_cast("double") / 100).alias("label"),
        (_utc("ts") + F.expr("INTERVAL 30 MINUTES")).alias("label_timestamp"),
    )


def tracked_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tracked run per order, spread over four experiments."""
    key = F.col("o_orderkey")
    status = F.when(key % 29 == 0, "PAUSED").otherwise(
        pick(
            ("FAILED", "RUNNING", "KILLED", "SCHEDULED", "FINISHED"),
            F.substring("o_orderpriority", 1, 1).cast("int") - 1,
        )
    )
    return table(spark, sf_dir, "orders").select(
        F.md5(key.cast("string")).alias("run_id"),
        F.concat(F.lit("experiment-"), (key % 4).cast("string")).alias("experiment_name"),
        status.alias("status"),
        F.when(key % 37 != 0, F.unix_millis(_utc("o_orderdate"))).alias("start_time"),
    )


def _of_runs(rows: DataFrame, runs: DataFrame | None) -> DataFrame:
    """The rows of ``runs``; all rows without."""
    return rows if runs is None else rows.join(runs.select("run_id"), "run_id", "left_semi")


def tracked_params(spark: SparkSession, sf_dir: str, runs: DataFrame | None = None) -> DataFrame:
    """Parameters of the tracked runs as (run, key, text); some runs lack some. Of ``runs`` only, if given."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    values: dict[str, Column] = {
        "model_name": pick([m[0] for m in MODEL_PROFILES], key % 12),
        "dataset": F.concat(F.lit("dataset-"), (cust % 7).cast("string")),
        "framework": pick(FRAMEWORKS, key % 3),
        "researcher": F.when(key % 17 != 0, F.concat(F.lit("Researcher#"), (cust % 10).cast("string"))),
        "optimizer": pick(OPTIMIZERS, cust % 4),
        "scheduler": F.when(key % 5 != 0, pick(SCHEDULERS, cust % 4)),
        "learning_rate": pick(("0.0005", "0.005", "5e-2"), key % 3),
        "batch_size": F.when(key % 11 != 0, pick(("32.0", "64", "128"), cust % 3)),
        "epochs": (1 + key % 50).cast("string"),
        "sys_gpu_name": F.when(key % 2 == 0, pick([g[0] for g in GPU_PROFILES], cust % 6)),
        "sys_cpu_name": F.concat(F.lit("CPU#"), (cust % 6).cast("string")),
        "sys_ram_gb": F.when(key % 13 != 0, pick(("16", "32.0", "64"), cust % 3)),
    }
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in values.items()])
    orders = table(spark, sf_dir, "orders").select(
        F.md5(key.cast("string")).alias("run_id"), "o_orderkey", "o_custkey"
    )
    return (
        _of_runs(orders, runs)
        .select("run_id", F.inline(pairs))
        .filter(F.col("value").isNotNull())
    )


def tracked_metrics(spark: SparkSession, sf_dir: str, runs: DataFrame | None = None) -> DataFrame:
    """Metrics of the tracked runs as (run, key, value, step, ts): one step per line item.

    With ``runs``, the steps of other runs go before a step becomes a row for each metric.
    """
    disc, tax = F.abs("l_discount"), F.abs("l_tax")
    values: dict[str, Column] = {
        "training_duration_sec": F.when(F.col("l_partkey") % 5 == 0, 0.0).otherwise(
            F.col("l_extendedprice") / 10
        ),
        "inference_latency_ms": F.col("l_quantity"),
        "model_size_mb": F.when(F.col("l_orderkey") % 7 != 0, F.col("l_extendedprice") / 100),
        "accuracy": 1 - 50 * disc * tax,
        "precision": 1 - 60 * disc * tax,
        "recall": 1 - 40 * disc * tax,
        "f1": F.when(F.col("l_orderkey") % 3 != 0, 1 - 45 * disc * tax),
        "training_loss": 10 * tax,
        "validation_loss": 11 * tax,
    }
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in values.items()])
    read = ("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    steps = spread(table(spark, sf_dir, "lineitem")).select(
        F.md5(F.col("l_orderkey").cast("string")).alias("run_id"),
        F.col("l_linenumber").alias("step"),
        _utc("l_shipdate").alias("ts"),
        *read,
    )
    return (
        _of_runs(steps, runs)
        .select("run_id", "step", "ts", F.inline(pairs))
        .filter(F.col("value").isNotNull())
    )


def training_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch rows of a training run: one per line item."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("run"),
        F.col("l_linenumber").cast("long").alias("epoch"),
        F.col("l_quantity").alias("samples"),
        (10 * F.abs("l_tax")).alias("loss"),
        (1 - F.abs("l_discount")).alias("accuracy"),
        "l_partkey",
        "l_suppkey",
    )


def graded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label pairs of the documents: quality as truth, toxicity as prediction."""
    labels = table(spark, sf_dir, "labels")
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return labels.join(documents, "doc_id").select("doc_id", "lang", "quality", "toxic")
