"""SQL that states what each registered query must return, for an independent engine."""

from __future__ import annotations

# --- run records ---------------------------------------------------------------

RAW = """
joined AS (
  SELECT *,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'failed' WHEN '2-HIGH' THEN 'running'
      WHEN '3-MEDIUM' THEN 'killed' ELSE 'success' END AS run_status,
    abs(l_discount) AS disc, abs(l_tax) AS tax
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey),
scored AS (
  SELECT *,
    CASE WHEN run_status IN ('success', 'failed') AND l_partkey % 89 <> 0 THEN 1 - 60 * disc * tax END AS prec,
    CASE WHEN run_status IN ('success', 'failed') THEN 1 - 40 * disc * tax END AS rec
  FROM joined),
raw AS (
  SELECT
    'exp_' || l_orderkey || '_' || l_linenumber AS experiment_id,
    ['resnet18', 'resnet50', 'resnet101', 'vit_base', 'vit_large', 'bert_base', 'bert_large',
     'gpt2_small', 'efficientnet_b0', 'efficientnet_b7', 'mobilenet_v3', 'yolo_v8'][l_partkey % 12 + 1] AS model_name,
    p_type AS dataset,
    CASE WHEN l_partkey % 53 = 0 THEN 'Keras' ELSE ['PyTorch', 'TensorFlow', 'JAX'][l_partkey % 3 + 1] END AS framework,
    'Researcher#' || (o_custkey % 10) AS researcher,
    ['Adam', 'AdamW', 'SGD', 'RMSprop'][l_suppkey % 4 + 1] AS optimizer,
    CASE WHEN l_partkey % 61 <> 0
      THEN ['CosineAnnealing', 'StepLR', 'OneCycle', 'Constant'][l_orderkey % 4 + 1] END AS scheduler,
    CASE WHEN l_partkey % 71 = 0 THEN 'n/a' WHEN l_partkey % 67 = 0 THEN 'NaN'
      ELSE ['0.00005', '0.0005', '0.005', '0.05', '0.5'][l_suppkey % 5 + 1] END AS learning_rate_text,
    ['8', '16.0', '32', '64', '128', '256'][p_size % 6 + 1] AS batch_size_text,
    CAST(l_quantity AS INTEGER) AS epochs,
    ['NVIDIA T4', 'NVIDIA RTX 3090', 'NVIDIA RTX 4090', 'NVIDIA V100', 'NVIDIA A100', 'NVIDIA H100'][l_suppkey % 6 + 1] AS gpu,
    'CPU#' || (s_nationkey % 6) AS cpu,
    CAST(16 * (1 + s_nationkey % 4) AS DOUBLE) AS ram_gb,
    l_extendedprice / 10 AS training_time_sec,
    p_retailprice / 100 AS inference_time_ms,
    p_retailprice AS model_size_mb,
    l_extendedprice * disc / 1000 AS energy_consumption_kwh,
    CASE WHEN run_status NOT IN ('success', 'failed') OR l_partkey % 97 = 0 THEN NULL
      WHEN l_orderkey % 83 = 0 THEN 1.5::DOUBLE ELSE 1 - 50 * disc * tax END AS accuracy,
    prec AS "precision",
    rec AS recall,
    CASE WHEN l_orderkey % 41 = 0 THEN rec
      ELSE CAST(round(CAST(2 * prec * rec / (prec + rec + 1e-9::DOUBLE) AS DECIMAL(38,12)), 4) AS DOUBLE) END AS f1_score,
    CASE WHEN run_status IN ('success', 'failed') THEN 10 * tax END AS loss,
    CASE WHEN run_status IN ('success', 'failed') AND l_suppkey % 29 <> 0 THEN 11 * tax END AS validation_loss,
    l_shipdate AS "timestamp",
    run_status AS status,
    CASE l_returnflag WHEN 'R' THEN 'mlflow' WHEN 'A' THEN 'synthetic' END AS source,
    CASE WHEN l_returnflag = 'R' THEN md5(CAST(l_orderkey AS VARCHAR)) END AS mlflow_run_id,
    CASE WHEN l_returnflag = 'R' THEN 'order-lines' END AS mlflow_experiment_name,
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS source_rank,
    l_partkey, l_suppkey, l_extendedprice
  FROM scored)"""

AUDITED = RAW + """,
typed AS (
  SELECT * EXCLUDE (source, learning_rate_text, batch_size_text),
    learning_rate_text, batch_size_text,
    TRY_CAST(learning_rate_text AS DOUBLE) AS learning_rate,
    CASE WHEN TRY_CAST(batch_size_text AS DOUBLE) = floor(TRY_CAST(batch_size_text AS DOUBLE))
      THEN CAST(TRY_CAST(batch_size_text AS DOUBLE) AS INTEGER) END AS batch_size,
    coalesce(source, 'synthetic') AS source
  FROM raw),
audited AS (
  SELECT *,
    list_filter([
      CASE WHEN experiment_id IS NULL THEN 'experiment_id:missing' END,
      CASE WHEN model_name IS NULL THEN 'model_name:missing' END,
      CASE WHEN dataset IS NULL THEN 'dataset:missing' END,
      CASE WHEN framework IS NULL THEN 'framework:missing'
        WHEN framework NOT IN ('PyTorch', 'TensorFlow', 'JAX') THEN 'framework:enum' END,
      CASE WHEN researcher IS NULL THEN 'researcher:missing' END,
      CASE WHEN optimizer IS NULL THEN 'optimizer:missing'
        WHEN optimizer NOT IN ('Adam', 'AdamW', 'SGD', 'RMSprop') THEN 'optimizer:enum' END,
      CASE WHEN scheduler IS NULL THEN 'scheduler:missing'
        WHEN scheduler NOT IN ('CosineAnnealing', 'StepLR', 'OneCycle', 'Constant') THEN 'scheduler:enum' END,
      CASE WHEN learning_rate_text IS NULL THEN 'learning_rate:missing'
        WHEN learning_rate IS NULL THEN 'learning_rate:type'
        WHEN isnan(learning_rate) OR learning_rate <= 0 OR learning_rate >= 1 THEN 'learning_rate:range' END,
      CASE WHEN batch_size_text IS NULL THEN 'batch_size:missing'
        WHEN batch_size IS NULL THEN 'batch_size:type'
        WHEN batch_size <= 0 THEN 'batch_size:range' END,
      CASE WHEN epochs IS NULL THEN 'epochs:missing' WHEN epochs <= 0 THEN 'epochs:range' END,
      CASE WHEN gpu IS NULL THEN 'gpu:missing' END,
      CASE WHEN cpu IS NULL THEN 'cpu:missing' END,
      CASE WHEN ram_gb IS NULL THEN 'ram_gb:missing' WHEN isnan(ram_gb) OR ram_gb <= 0 THEN 'ram_gb:range' END,
      CASE WHEN training_time_sec IS NULL THEN 'training_time_sec:missing'
        WHEN isnan(training_time_sec) OR training_time_sec <= 0 THEN 'training_time_sec:range' END,
      CASE WHEN inference_time_ms IS NULL THEN 'inference_time_ms:missing'
        WHEN isnan(inference_time_ms) OR inference_time_ms <= 0 THEN 'inference_time_ms:range' END,
      CASE WHEN model_size_mb IS NULL THEN 'model_size_mb:missing'
        WHEN isnan(model_size_mb) OR model_size_mb <= 0 THEN 'model_size_mb:range' END,
      CASE WHEN energy_consumption_kwh IS NULL THEN 'energy_consumption_kwh:missing'
        WHEN isnan(energy_consumption_kwh) OR energy_consumption_kwh < 0 THEN 'energy_consumption_kwh:range' END,
      CASE WHEN isnan(accuracy) OR accuracy < 0 OR accuracy > 1 THEN 'accuracy:range' END,
      CASE WHEN isnan("precision") OR "precision" < 0 OR "precision" > 1 THEN 'precision:range' END,
      CASE WHEN isnan(recall) OR recall < 0 OR recall > 1 THEN 'recall:range' END,
      CASE WHEN isnan(f1_score) OR f1_score < 0 OR f1_score > 1 THEN 'f1_score:range' END,
      CASE WHEN isnan(loss) OR loss < 0 THEN 'loss:range' END,
      CASE WHEN isnan(validation_loss) OR validation_loss < 0 THEN 'validation_loss:range' END,
      CASE WHEN "timestamp" IS NULL THEN 'timestamp:missing' END,
      CASE WHEN status IS NULL THEN 'status:missing'
        WHEN status NOT IN ('success', 'failed', 'running', 'killed') THEN 'status:enum' END,
      CASE WHEN source NOT IN ('synthetic', 'mlflow') THEN 'source:enum' END
    ], lambda e: e IS NOT NULL) AS errors
  FROM typed),
valid AS (SELECT * FROM audited WHERE len(errors) = 0)"""

DEDUPED = AUDITED + """,
deduped AS (
  SELECT * FROM valid
  QUALIFY row_number() OVER (PARTITION BY experiment_id
    ORDER BY source_rank, "timestamp", l_partkey, l_suppkey, l_extendedprice) = 1)"""

MISSING = """(status IN ('success', 'failed') AND (accuracy IS NULL OR "precision" IS NULL
  OR recall IS NULL OR f1_score IS NULL OR loss IS NULL OR validation_loss IS NULL))"""

_METRICS = ("accuracy", '"precision"', "recall", "f1_score", "loss", "validation_loss")

CLEAN = DEDUPED + """,
medians AS (
  SELECT status AS median_status, """ + ", ".join(
    f"quantile_cont({m}, 0.5) AS m{i}" for i, m in enumerate(_METRICS)
) + """
  FROM deduped WHERE status IN ('success', 'failed') GROUP BY status),
clean AS (
  SELECT experiment_id, model_name, dataset, framework, researcher, optimizer, scheduler,
    learning_rate, batch_size, epochs, gpu, cpu, ram_gb, training_time_sec, inference_time_ms,
    model_size_mb, energy_consumption_kwh, """ + ", ".join(
    f"coalesce({m}, m{i}) AS {m}" for i, m in enumerate(_METRICS)
) + """,
    "timestamp", status, source, mlflow_run_id, mlflow_experiment_name
  FROM deduped LEFT JOIN medians ON status = median_status)"""

RECORD = """experiment_id, model_name, dataset, framework, researcher, optimizer, scheduler,
  learning_rate, batch_size, epochs, gpu, cpu, ram_gb, training_time_sec, inference_time_ms,
  model_size_mb, energy_consumption_kwh, accuracy, "precision", recall, f1_score, loss,
  validation_loss, "timestamp", status, source, mlflow_run_id, mlflow_experiment_name"""


def rnd(expression: str, digits: int) -> str:
    """Half-up rounding on the decimal value."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def settled(expression: str) -> str:
    return f"CAST(CAST({expression} AS DECIMAL(38,12)) AS DOUBLE)"


def ok_avg(column: str) -> str:
    return f"avg({column}) FILTER (WHERE status = 'success')"


LR_BUCKET = """CASE WHEN learning_rate < 0.0001 THEN '< 1e-4' WHEN learning_rate < 0.001 THEN '1e-4 to 1e-3'
  WHEN learning_rate < 0.01 THEN '1e-3 to 1e-2' WHEN learning_rate < 0.1 THEN '1e-2 to 1e-1' ELSE '>= 1e-1' END"""

FAILURE_RATE = rnd(
    "count(*) FILTER (WHERE status = 'failed')::DOUBLE / nullif(count(*), 0) * 100", 2
)

VIEW_SQL = {
    "executive_kpis": f"""SELECT {rnd(ok_avg('accuracy'), 4)} AS avg_accuracy,
  {rnd(ok_avg('f1_score'), 4)} AS avg_f1_score,
  {rnd('sum(training_time_sec) / 3600.0', 2)} AS total_training_hours,
  {rnd('sum(energy_consumption_kwh)', 2)} AS total_energy_kwh, count(*) AS total_runs,
  count(*) FILTER (WHERE status = 'failed') AS failed_runs, {FAILURE_RATE} AS failure_rate_pct,
  count(*) FILTER (WHERE status = 'running') AS running_runs FROM clean""",
    "model_leaderboard": f"""SELECT model_name, count(*) AS total_runs,
  count(*) FILTER (WHERE status = 'success') AS successful_runs,
  {rnd(ok_avg('accuracy'), 4)} AS avg_accuracy, {rnd(ok_avg('f1_score'), 4)} AS avg_f1_score,
  {rnd(ok_avg('loss'), 4)} AS avg_loss,
  rank() OVER (ORDER BY {settled(ok_avg('accuracy'))} DESC NULLS FIRST) AS accuracy_rank
  FROM clean GROUP BY model_name""",
    "dataset_comparison": f"""SELECT dataset AS dataset_name, count(*) AS total_runs,
  {rnd(ok_avg('accuracy'), 4)} AS avg_accuracy,
  {rnd(ok_avg('training_time_sec'), 2)} AS avg_training_time_sec,
  {FAILURE_RATE} AS failure_rate_pct FROM clean GROUP BY dataset""",
    "framework_comparison": f"""SELECT framework, optimizer, scheduler, count(*) AS total_runs,
  {rnd(ok_avg('accuracy'), 4)} AS avg_accuracy,
  {rnd(ok_avg('training_time_sec'), 2)} AS avg_training_time_sec
  FROM clean GROUP BY framework, optimizer, scheduler""",
    "gpu_performance": f"""SELECT gpu, count(*) AS total_runs,
  {rnd(ok_avg('training_time_sec'), 2)} AS avg_training_time_sec,
  {rnd('avg(energy_consumption_kwh)', 4)} AS avg_energy_kwh,
  {rnd(ok_avg('accuracy'), 4)} AS avg_accuracy,
  {rnd('avg(inference_time_ms)', 3)} AS avg_inference_time_ms FROM clean GROUP BY gpu""",
    "hyperparameter_analysis": f"""SELECT {LR_BUCKET} AS learning_rate_bucket, batch_size,
  count(*) AS total_runs, {rnd(ok_avg('accuracy'), 4)} AS avg_accuracy,
  {rnd('avg(epochs)', 1)} AS avg_epochs FROM clean GROUP BY ALL""",
    "training_timeline": f""", daily AS (
  SELECT CAST("timestamp" AS DATE) AS full_date, count(*) AS runs_count,
    {ok_avg('accuracy')} AS daily FROM clean GROUP BY 1)
SELECT full_date, runs_count, {rnd('daily', 4)} AS daily_avg_accuracy,
  {rnd('avg(daily) OVER (ORDER BY full_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)', 4)}
  AS rolling_7day_avg_accuracy FROM daily""",
    "source_breakdown": f"""SELECT source, count(*) AS total_runs,
  count(*) FILTER (WHERE status = 'success') AS successful_runs,
  {rnd(ok_avg('accuracy'), 4)} AS avg_accuracy,
  {rnd('avg(training_time_sec)', 2)} AS avg_training_time_sec,
  min("timestamp") AS earliest_run, max("timestamp") AS latest_run,
  rank() OVER (ORDER BY {settled(ok_avg('accuracy'))} DESC NULLS FIRST) AS accuracy_rank
  FROM clean GROUP BY source""",
}

# --- dimensions ------------------------------------------------------------------

# table: (key, natural key, columns as selected from the clean rows)
DIMS = {
    "dim_model": ("model_key", ["model_name"], "model_name"),
    "dim_dataset": ("dataset_key", ["dataset_name"], "dataset AS dataset_name"),
    "dim_hardware": ("hardware_key", ["gpu", "cpu", "ram_gb"], "gpu, cpu, ram_gb"),
    "dim_framework": (
        "framework_key",
        ["framework", "optimizer", "scheduler"],
        "framework, optimizer, scheduler",
    ),
    "dim_researcher": ("researcher_key", ["researcher_name"], "researcher AS researcher_name"),
    "dim_experiment": (
        "experiment_key",
        ["experiment_id"],
        "experiment_id, learning_rate, batch_size, epochs, source, mlflow_run_id, mlflow_experiment_name",
    ),
}


def natural_order(natural: list[str]) -> str:
    text = " || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in natural)
    return f"substr(md5({text}), 1, 4), {', '.join(natural)}"


def dim_sql(table: str, rows: str = "clean") -> str:
    key, natural, columns = DIMS[table]
    return f"""SELECT row_number() OVER (ORDER BY {natural_order(natural)}) AS {key}, *
  FROM (SELECT DISTINCT {columns} FROM {rows})"""


DIM_CTES = CLEAN + "".join(f",\n{t} AS ({dim_sql(t)})" for t in DIMS)

CALENDAR = """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
  CAST(year(d) AS INTEGER) AS "year", CAST(quarter(d) AS INTEGER) AS quarter,
  CAST(month(d) AS INTEGER) AS "month", monthname(d) AS month_name, CAST(day(d) AS INTEGER) AS "day",
  CAST(isodow(d) - 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend
FROM range(TIMESTAMP '{start}', TIMESTAMP '{end}' + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d)"""

KEYED = DIM_CTES + """,
keyed AS (
  SELECT c.*, model_key, dataset_key, hardware_key, framework_key, researcher_key, experiment_key,
    CAST(strftime(c."timestamp", '%Y%m%d') AS INTEGER) AS date_key
  FROM clean c
  JOIN dim_model USING (model_name)
  JOIN dim_dataset ON dataset = dataset_name
  JOIN dim_hardware USING (gpu, cpu, ram_gb)
  JOIN dim_framework USING (framework, optimizer, scheduler)
  JOIN dim_researcher ON researcher = researcher_name
  JOIN dim_experiment USING (experiment_id))"""

FACT = """SELECT experiment_key, model_key, dataset_key, hardware_key, framework_key, researcher_key,
  date_key, training_time_sec, inference_time_ms, model_size_mb, energy_consumption_kwh,
  accuracy, "precision", recall, f1_score, loss, validation_loss, status, "timestamp" AS run_timestamp
FROM keyed"""

# --- prediction events -------------------------------------------------------------

EVENTS = """
predictions AS (
  SELECT event_id AS stream_entry_id, event_type AS model_name, 'v' || (user_id % 3) AS model_version,
    value / 500 AS prediction,
    CASE WHEN event_type <> 'error' THEN TRY_CAST(regexp_extract(props, '"k":\\s*(\\d+)', 1) AS DOUBLE) / 100 END AS ground_truth,
    value AS latency_ms, ts AS event_timestamp
  FROM events)"""

WINDOWED = EVENTS + """,
placed AS (
  SELECT *, count(*) OVER m AS event_count,
    row_number() OVER (PARTITION BY model_name, model_version ORDER BY event_timestamp, stream_entry_id) AS from_start,
    row_number() OVER (PARTITION BY model_name, model_version ORDER BY event_timestamp DESC, stream_entry_id DESC) AS from_end
  FROM predictions WINDOW m AS (PARTITION BY model_name, model_version)),
baseline AS (SELECT * FROM placed WHERE from_start <= {w}),
recent AS (SELECT * FROM placed WHERE from_end <= {w}),
sizes AS (
  SELECT model_name, model_version, any_value(event_count) AS event_count, count(*) AS baseline_n,
    greatest(2, least(10, count(*) // 20)) AS bins, list_sort(list(prediction)) AS ordered
  FROM baseline GROUP BY ALL),
shares AS (
  SELECT *, CASE WHEN i = bins THEN 1.0::DOUBLE ELSE i * (1.0::DOUBLE / bins) END * (baseline_n - 1) AS place
  FROM sizes, LATERAL (SELECT unnest(range(bins + 1)) AS i)),
edges AS (
  SELECT model_name, model_version, edge, row_number() OVER (PARTITION BY model_name, model_version ORDER BY edge) - 1 AS edge_index,
    count(*) OVER (PARTITION BY model_name, model_version) AS edge_count
  FROM (SELECT DISTINCT model_name, model_version,
      ordered[CAST(floor(place) AS BIGINT) + 1]
        + (ordered[CAST(ceil(place) AS BIGINT) + 1] - ordered[CAST(floor(place) AS BIGINT) + 1]) * (place - floor(place)) AS edge
    FROM shares)),
cells AS (
  SELECT a.model_name, a.model_version, a.edge_index + 1 AS bin, a.edge AS low, b.edge AS high,
    a.edge_index + 2 = a.edge_count AS is_last
  FROM edges a JOIN edges b ON a.model_name = b.model_name AND a.model_version = b.model_version
    AND b.edge_index = a.edge_index + 1
  WHERE a.edge_count >= 3),
histogram AS (
  SELECT model_name, model_version, s.baseline_n, r.recent_n, bin, low, high,
    (SELECT count(*) FROM baseline x WHERE x.model_name = c.model_name AND x.model_version = c.model_version
      AND x.prediction >= low AND (x.prediction < high OR (is_last AND x.prediction = high))) AS baseline_count,
    (SELECT count(*) FROM recent x WHERE x.model_name = c.model_name AND x.model_version = c.model_version
      AND x.prediction >= low AND (x.prediction < high OR (is_last AND x.prediction = high))) AS recent_count
  FROM cells c JOIN sizes s USING (model_name, model_version)
  JOIN (SELECT model_name, model_version, count(*) AS recent_n FROM recent GROUP BY ALL) r USING (model_name, model_version)),
scores AS (
  SELECT model_name, model_version, sum((r - b) * ln(r / b)) AS psi FROM (
    SELECT model_name, model_version, baseline_count / baseline_n + 1e-6::DOUBLE AS b, recent_count / recent_n + 1e-6::DOUBLE AS r
    FROM histogram) GROUP BY ALL),
scored_models AS (
  SELECT s.*, coalesce(psi, 0.0) AS psi FROM sizes s LEFT JOIN scores USING (model_name, model_version))"""


def windowed(w: int) -> str:
    return WINDOWED.replace("{w}", str(w))


# --- tracked runs -------------------------------------------------------------------

_PICKS = "['32.0', '64', '128']"

TRACKED = """
runs AS (
  SELECT o_orderkey AS k, o_custkey AS c, md5(CAST(o_orderkey AS VARCHAR)) AS run_id,
    CASE WHEN o_orderkey % 29 = 0 THEN 'running'
      ELSE ['failed', 'running', 'killed', 'running', 'success'][CAST(substr(o_orderpriority, 1, 1) AS INTEGER)] END AS status,
    CASE WHEN o_orderkey % 37 <> 0 THEN o_orderdate ELSE TIMESTAMP '2000-01-01' END AS started
  FROM orders WHERE o_orderkey % 4 = 1),
logged AS (
  SELECT l_orderkey AS k, l_linenumber AS step, l_shipdate AS ts, key, value FROM (
    SELECT *, unnest(['training_duration_sec', 'inference_latency_ms', 'model_size_mb', 'accuracy', 'precision',
        'recall', 'f1', 'training_loss', 'validation_loss']) AS key,
      unnest([CASE WHEN l_partkey % 5 = 0 THEN 0.0::DOUBLE ELSE l_extendedprice / 10 END, l_quantity,
        CASE WHEN l_orderkey % 7 <> 0 THEN l_extendedprice / 100 END,
        1 - 50 * abs(l_discount) * abs(l_tax), 1 - 60 * abs(l_discount) * abs(l_tax), 1 - 40 * abs(l_discount) * abs(l_tax),
        CASE WHEN l_orderkey % 3 <> 0 THEN 1 - 45 * abs(l_discount) * abs(l_tax) END,
        10 * abs(l_tax), 11 * abs(l_tax)]) AS value
    FROM lineitem) WHERE value IS NOT NULL),
last_values AS (
  SELECT k, key, value FROM logged
  QUALIFY row_number() OVER (PARTITION BY k, key ORDER BY step DESC, ts DESC, value DESC) = 1),
wide AS (
  SELECT k,
    max(value) FILTER (WHERE key = 'training_duration_sec') AS t, max(value) FILTER (WHERE key = 'inference_latency_ms') AS i,
    max(value) FILTER (WHERE key = 'model_size_mb') AS m, max(value) FILTER (WHERE key = 'accuracy') AS a,
    max(value) FILTER (WHERE key = 'precision') AS p, max(value) FILTER (WHERE key = 'recall') AS r,
    max(value) FILTER (WHERE key = 'f1') AS f, max(value) FILTER (WHERE key = 'training_loss') AS l,
    max(value) FILTER (WHERE key = 'validation_loss') AS v
  FROM last_values GROUP BY k),
tracked AS (
  SELECT 'mlflow_' || substr(run_id, 1, 16) AS experiment_id,
    ['resnet18', 'resnet50', 'resnet101', 'vit_base', 'vit_large', 'bert_base', 'bert_large',
     'gpt2_small', 'efficientnet_b0', 'efficientnet_b7', 'mobilenet_v3', 'yolo_v8'][k % 12 + 1] AS model_name,
    'dataset-' || (c % 7) AS dataset,
    ['PyTorch', 'TensorFlow', 'JAX'][k % 3 + 1] AS framework,
    CASE WHEN k % 17 <> 0 THEN 'Researcher#' || (c % 10) ELSE 'unknown' END AS researcher,
    ['Adam', 'AdamW', 'SGD', 'RMSprop'][c % 4 + 1] AS optimizer,
    CASE WHEN k % 5 <> 0 THEN ['CosineAnnealing', 'StepLR', 'OneCycle', 'Constant'][c % 4 + 1] ELSE 'Constant' END AS scheduler,
    [0.0005::DOUBLE, 0.005::DOUBLE, 0.05::DOUBLE][k % 3 + 1] AS learning_rate,
    CASE WHEN k % 11 <> 0 THEN [32, 64, 128][c % 3 + 1] ELSE 32 END AS batch_size,
    CAST(1 + k % 50 AS INTEGER) AS epochs,
    CASE WHEN k % 2 = 0 THEN ['NVIDIA T4', 'NVIDIA RTX 3090', 'NVIDIA RTX 4090', 'NVIDIA V100', 'NVIDIA A100', 'NVIDIA H100'][c % 6 + 1]
      ELSE 'none' END AS gpu,
    'CPU#' || (c % 6) AS cpu,
    CASE WHEN k % 13 <> 0 THEN [16.0::DOUBLE, 32.0::DOUBLE, 64.0::DOUBLE][c % 3 + 1] ELSE 0.0::DOUBLE END AS ram_gb,
    CASE WHEN coalesce(t, 0) = 0 THEN 0.001::DOUBLE ELSE t END AS training_time_sec,
    CASE WHEN coalesce(i, 0) = 0 THEN 0.001::DOUBLE ELSE i END AS inference_time_ms,
    CASE WHEN coalesce(m, 0) = 0 THEN 0.001::DOUBLE ELSE m END AS model_size_mb,
    0.0::DOUBLE AS energy_consumption_kwh,
    CASE WHEN status IN ('success', 'failed') THEN coalesce(a, 0.0) END AS accuracy,
    CASE WHEN status IN ('success', 'failed') THEN coalesce(p, 0.0) END AS "precision",
    CASE WHEN status IN ('success', 'failed') THEN coalesce(r, 0.0) END AS recall,
    CASE WHEN status IN ('success', 'failed') THEN coalesce(f, 0.0) END AS f1_score,
    CASE WHEN status IN ('success', 'failed') THEN coalesce(l, 0.0) END AS loss,
    CASE WHEN status IN ('success', 'failed') THEN coalesce(v, 0.0) END AS validation_loss,
    started AS "timestamp", status, 'mlflow' AS source, run_id AS mlflow_run_id,
    'experiment-1' AS mlflow_experiment_name
  FROM runs LEFT JOIN wide USING (k))"""
