"""The registered queries: each takes a session and a folder of driver tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runatlas.functions.scalars import half_up
from runatlas.operators import alerts, clean, dimensions, drift, enrich, evaluate, fact, monitoring
from runatlas.operators.ordering import sample_n
from runatlas.operators.tracking import runs_to_records
from runatlas.operators.validate import (
    audit,
    audit_events,
    records,
    reject_reasons,
    reject_report,
    rejected_rows,
    valid_only,
    valid_rows,
)
from runatlas.plans import adapter, oracle, views
from runatlas.plans.pipeline import Settings, load_fact, load_warehouse, run_etl, run_pipeline
from runatlas.schemas import DIMENSIONS, VIEW_NAMES
from runatlas.session import materialize, workspace
from runatlas.sources import event_log, json_records, tables
from runatlas.sources.tables import TableStore
from runatlas.streaming import labels as label_stream
from runatlas.streaming import metrics
from runatlas.streaming.drift_job import DriftJob
from runatlas.streaming.ingest import ingest, read_predictions

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

_SERIAL = iter(range(1, 1 << 30))


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, if there is one, the SQL that states its result."""

    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return add


def scratch(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run of a query."""
    return f"{workspace(spark)}/{name}-{next(_SERIAL)}"


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the SQL side has them."""
    times = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times}) if times else df


def with_sql(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}{select if select.startswith(',') else chr(10) + select}"


# --- staging and star schema are built once per session and folder, then read as tables ----

_STORES: dict[tuple[str, str], str] = {}
_LOADED: set[str] = set()  # roots whose star schema is there
_STARS: dict[str, views.Star] = {}


def _calendar_of(spark: SparkSession, sf_dir: str, **settings: bool) -> Settings:
    """Settings whose calendar spans the data."""
    shipped = adapter.table(spark, sf_dir, "lineitem")
    return Settings(
        calendar_start=shipped.agg(F.min("l_shipdate").cast("date")).scalar(),
        calendar_end=shipped.agg(F.max("l_shipdate").cast("date")).scalar(),
        **settings,
    )


def build_star(spark: SparkSession, sf_dir: str) -> TableStore:
    """Run the whole pipeline into a new root."""
    root = scratch(spark, "warehouse")
    settings = _calendar_of(spark, sf_dir)
    run_pipeline(
        spark, adapter.raw_runs(spark, sf_dir), adapter.raw_order(), root, settings
    )
    return TableStore(spark, root)


def staged_store(spark: SparkSession, sf_dir: str) -> TableStore:
    """The pipeline up to the staging table, for queries that read no further."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORES:
        store = TableStore(spark, scratch(spark, "warehouse"))
        run_etl(adapter.raw_runs(spark, sf_dir), adapter.raw_order(), store, Settings().strategy)
        _STORES[key] = store.root
    return TableStore(spark, _STORES[key])


def star_store(spark: SparkSession, sf_dir: str) -> TableStore:
    """The whole star schema, loaded from the staging table."""
    store = staged_store(spark, sf_dir)
    if store.root not in _LOADED and store.exists("staging"):
        run_pipeline(spark, None, (), store.root, _calendar_of(spark, sf_dir, skip_etl=True))
        _LOADED.add(store.root)
    return store


def _star(spark: SparkSession, sf_dir: str) -> views.Star:
    """The star's tables, whose files are listed once."""
    store = star_store(spark, sf_dir)
    if store.root not in _STARS:
        _STARS[store.root] = views.Star.load(store)
    return _STARS[store.root]


def _staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_store(spark, sf_dir).read("staging")


def _register_view_queries() -> None:
    names = dict(zip(oracle.VIEW_SQL, VIEW_NAMES, strict=True))
    for name, view in names.items():

        def run(spark: SparkSession, sf_dir: str, view: str = view) -> DataFrame:
            return plain_times(views.VIEWS[view](_star(spark, sf_dir)))

        query(name, with_sql(oracle.CLEAN, oracle.VIEW_SQL[name]))(run)


_register_view_queries()


@query(
    "build_warehouse",
    with_sql(
        oracle.DIM_CTES,
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in DIMENSIONS
        )
        + " UNION ALL SELECT 'fact_training_run', count(*) FROM clean"
        + " UNION ALL SELECT 'staging', count(*) FROM clean"
        + " UNION ALL SELECT 'dim_date', max(CAST(l_shipdate AS DATE)) - min(CAST(l_shipdate AS DATE)) + 1 FROM lineitem)",
    ),
)
def build_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch pipeline from raw records on, and the size of what it wrote."""
    store = build_star(spark, sf_dir)
    names = [*DIMENSIONS, "fact_training_run", "staging", "dim_date"]
    sizes = [
        store.read(n).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(n).alias("table_name"), "row_count"
        )
        for n in names
    ]
    return reduce(DataFrame.unionByName, sizes)


@query(
    "view_inventory",
    with_sql(
        oracle.CLEAN,
        "SELECT 'vw_executive_kpis' AS view_name, 1 AS row_count UNION ALL "
        + " UNION ALL ".join(
            f"SELECT '{name}', CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT {columns} FROM clean)"
            for name, columns in (
                ("vw_model_leaderboard", "model_name"),
                ("vw_dataset_comparison", "dataset"),
                ("vw_framework_comparison", "framework, optimizer, scheduler"),
                ("vw_gpu_performance", "gpu"),
                ("vw_hyperparameter_analysis", f"{oracle.LR_BUCKET} AS b, batch_size"),
                ("vw_training_timeline", 'CAST("timestamp" AS DATE) AS d'),
                ("vw_experiment_source_breakdown", "source"),
            )
        ),
    ),
)
def view_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expected views that the catalog has, with their sizes."""
    views.register_views(_star(spark, sf_dir))
    lost = views.missing_views(spark)
    sizes = [
        spark.table(n).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(n).alias("view_name"), "row_count"
        )
        for n in VIEW_NAMES
    ]
    return reduce(DataFrame.unionByName, sizes).join(lost, "view_name", "left_anti")


# --- sources, validation, cleaning ---------------------------------------------------


def _audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(adapter.raw_runs(spark, sf_dir))


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_only(adapter.raw_runs(spark, sf_dir))


def _deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(clean.deduplicate(_valid(spark, sf_dir), adapter.raw_order()))


SLICES = 8  # for each split of the input, so that the distinct ids that one task holds do not grow with a split

_RECORD_SQL = f"SELECT {oracle.RECORD} FROM "


@query(
    "merge_sources",
    with_sql(
        oracle.AUDITED,
        "SELECT source_rank, source, count(*) AS record_count, count(DISTINCT experiment_id) AS experiments "
        "FROM audited GROUP BY ALL",
    ),
)
def merge_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Primary records, then the tracked ones, then nothing for a source that is absent."""
    raw = adapter.raw_runs(spark, sf_dir).drop("source_rank")
    tracked = F.coalesce(F.col("source"), F.lit("")) == "mlflow"
    merged = json_records.merge_sources([raw.filter(~tracked), raw.filter(tracked)]).select(
        "source_rank", F.coalesce("source", F.lit("synthetic")).alias("source"), "experiment_id"
    )
    slices = SLICES * adapter.table(spark, sf_dir, "lineitem").rdd.getNumPartitions()
    return (
        merged.repartition(slices, *merged.columns)
        .groupBy("source_rank", "source")
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            F.count_distinct("experiment_id").alias("experiments"),
        )
    )


@query("json_source", with_sql(oracle.AUDITED, _RECORD_SQL + "valid"))
def json_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as JSON lines, read back as raw values and validated."""
    path = scratch(spark, "raw-json")
    raw = adapter.raw_runs(spark, sf_dir)
    json_records.write_records(raw.drop("source_rank"), path)
    read = json_records.read_sources(spark, path, [path + "-absent"])
    return plain_times(records(valid_rows(audit(read))))


LIST_RECORDS = 4096  # of one list file, at most


def write_lists(raw: DataFrame, path: str) -> None:
    """The records of each source in list files of at most ``LIST_RECORDS``, whose names sort in input order.

    Records are sorted by ranges over all tasks and cut by their number in the range, so no key fills a file.
    """
    place = ("l_partkey", "l_suppkey", "l_extendedprice")
    record = F.to_json(F.struct(*[c for c in raw.columns if c not in (*place, "source_rank")]))
    rows = raw.select("source_rank", (F.col("l_suppkey") % 4).alias("file"), *place, record.alias("json"))
    ranged = rows.repartitionByRange(*rows.columns).sortWithinPartitions(*rows.columns)
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # of the row in its range
    block = F.lpad(F.floor(number / LIST_RECORDS).cast("string"), 9, "0")
    piece = F.concat(F.lit("p"), F.lpad(F.spark_partition_id().cast("string"), 6, "0"), F.lit("-"), block)
    element = F.struct(*place, "json")
    files = ranged.withColumn("piece", piece).groupBy("source_rank", "file", "piece").agg(F.array_sort(F.collect_list(element)).alias("rows"))
    text = F.concat(F.lit("["), F.array_join(F.transform("rows", lambda r: r["json"]), ","), F.lit("]"))
    files.select("source_rank", "file", "piece", text.alias("value")).write.partitionBy("source_rank", "file", "piece").option("compression", "gzip").text(path)


@query(
    "json_list_source",
    with_sql(
        oracle.AUDITED,
        _RECORD_SQL
        + """valid QUALIFY row_number() OVER (PARTITION BY experiment_id
  ORDER BY source_rank, l_suppkey % 4, l_partkey, l_suppkey, l_extendedprice) = 1""",
    ),
)
def json_list_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several list files of two sources and an absent one; the first in input order stays of each id."""
    path = scratch(spark, "raw-lists")
    write_lists(adapter.raw_runs(spark, sf_dir), path)
    lists = [f"{path}/source_rank=0", f"{path}/source_rank=1", f"{path}/source_rank=2"]
    read = json_records.read_sources(spark, lists[0], lists[1:], lines=False)
    return plain_times(records(clean.deduplicate(valid_rows(audit(read)), json_records.input_order())))


@query("csv_staging", with_sql(oracle.CLEAN, _RECORD_SQL + "clean"))
def csv_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean records written as CSV and read back with their types."""
    path = scratch(spark, "clean-csv")
    tables.write_csv(_staging(spark, sf_dir), path)
    return plain_times(tables.read_csv(spark, path))


@query(
    "rejects_sink",
    with_sql(
        oracle.AUDITED,
        "SELECT experiment_id, framework, learning_rate_text AS learning_rate, batch_size_text AS batch_size, "
        "list_aggregate(errors, 'string_agg', '; ') AS validation_error FROM audited WHERE len(errors) > 0",
    ),
)
def rejects_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected records as JSON with their raw values and errors, read back."""
    path = scratch(spark, "rejects")
    json_records.write_rejects(rejected_rows(_audited(spark, sf_dir)), path)
    shown = ("experiment_id", "framework", "learning_rate", "batch_size")
    raw = F.from_json("raw_record", ", ".join(f"{c} string" for c in shown))
    return json_records.read_rejects(spark, path).select(
        *[raw[c].alias(c) for c in shown], "validation_error"
    )


@query("validate_valid", with_sql(oracle.AUDITED, _RECORD_SQL + "valid"))
def validate_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(records(_valid(spark, sf_dir)))


@query(
    "validate_rejects",
    with_sql(
        oracle.AUDITED,
        "SELECT coalesce(experiment_id, 'UNKNOWN') AS experiment_id, errors[1] AS first_error, "
        "list_aggregate(errors, 'string_agg', '; ') AS validation_error, CAST(len(errors) AS BIGINT) AS error_count "
        "FROM audited WHERE len(errors) > 0",
    ),
)
def validate_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_report(rejected_rows(_audited(spark, sf_dir)))


@query(
    "reject_reasons",
    with_sql(
        oracle.AUDITED,
        "SELECT reason, count(*) AS record_count FROM (SELECT unnest(errors) AS reason FROM audited) GROUP BY reason",
    ),
)
def rejection_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_reasons(_audited(spark, sf_dir))


@query(
    "etl_funnel",
    with_sql(
        oracle.AUDITED,
        "SELECT count(*) AS raw_count, count(*) FILTER (WHERE len(errors) = 0) AS valid_count, "
        "count(*) FILTER (WHERE len(errors) > 0) AS rejected_count, "
        "count(DISTINCT experiment_id) FILTER (WHERE len(errors) = 0) AS clean_count FROM audited",
    ),
)
def etl_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records at each stage; deduplication leaves one per valid experiment id."""
    fine = F.size("errors") == 0
    return _audited(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("raw_count"),
        F.count_if(fine).alias("valid_count"),
        F.count_if(~fine).alias("rejected_count"),
        F.count_distinct(F.when(fine, F.col("experiment_id"))).alias("clean_count"),
    )


@query("dedup_first", with_sql(oracle.DEDUPED, _RECORD_SQL + "deduped"))
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(_deduped(spark, sf_dir))


@query("missing_metrics_median", with_sql(oracle.CLEAN, _RECORD_SQL + "clean"))
def missing_metrics_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The medians take several passes, so the deduplicated rows are written once.
    deduped = materialize(_deduped(spark, sf_dir), scratch(spark, "deduped"))
    return plain_times(clean.handle_missing_metrics(deduped, "median"))


@query(
    "missing_metrics_drop",
    with_sql(oracle.DEDUPED, _RECORD_SQL + f"deduped WHERE NOT coalesce({oracle.MISSING}, false)"),
)
def missing_metrics_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(clean.handle_missing_metrics(_deduped(spark, sf_dir), "drop"))


@query(
    "missing_metrics_flag",
    with_sql(
        oracle.DEDUPED, f"SELECT {oracle.RECORD}, {oracle.MISSING} AS data_quality_flag FROM deduped"
    ),
)
def missing_metrics_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(clean.handle_missing_metrics(_deduped(spark, sf_dir), "flag"))


@query(
    "missing_metrics_count",
    with_sql(oracle.DEDUPED, f"SELECT count(*) AS affected_rows FROM deduped WHERE {oracle.MISSING}"),
)
def missing_metrics_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.missing_metrics_count(_deduped(spark, sf_dir))


@query(
    "status_counts",
    with_sql(oracle.RAW, "SELECT status, count(*) AS record_count FROM raw GROUP BY status"),
)
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = adapter.raw_runs(spark, sf_dir)
    return runs.groupBy("status").agg(F.count(F.lit(1)).alias("record_count"))


# --- dimensions and fact ------------------------------------------------------------


def _register_dimension_queries() -> None:
    for table in DIMENSIONS:

        def run(spark: SparkSession, sf_dir: str, table: str = table) -> DataFrame:
            return star_store(spark, sf_dir).read(table)

        query(table, with_sql(oracle.CLEAN, oracle.dim_sql(table)))(run)


_register_dimension_queries()

_CALENDAR_OF_DATA = """WITH bounds AS (
  SELECT date_trunc('day', min(l_shipdate)) AS first_day, date_trunc('day', max(l_shipdate)) AS last_day FROM lineitem),
days AS (SELECT unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS d FROM bounds)
""" + oracle.CALENDAR.split("\nFROM range")[0] + "\nFROM days"


@query("dim_date", _CALENDAR_OF_DATA)
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day between the first and the last run."""
    return star_store(spark, sf_dir).read("dim_date")


@query("calendar_upsert", _CALENDAR_OF_DATA)
def calendar_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calendar that ended too early, extended: no day twice, none missing."""
    shipped = adapter.table(spark, sf_dir, "lineitem")
    first = shipped.agg(F.min("l_shipdate").cast("date")).scalar()
    middle = shipped.agg(
        F.date_add(F.min("l_shipdate").cast("date"), 700)
    ).scalar()
    last = shipped.agg(F.max("l_shipdate").cast("date")).scalar()
    existing = dimensions.calendar(spark, first, middle)
    wanted = dimensions.calendar(spark, first, last)
    return existing.unionByName(dimensions.new_calendar_rows(wanted, existing))


_EARLY = "\"timestamp\" < TIMESTAMP '1998-07-01'"


def _early(staging: DataFrame) -> DataFrame:
    return staging.filter(F.col("timestamp") < F.lit("1998-07-01").cast("timestamp"))


@query(
    "dim_upsert_second_load",
    with_sql(
        oracle.CLEAN,
        f""", ranked AS (
  SELECT *, {_EARLY} AS is_early, substr(md5(experiment_id), 1, 4) AS h FROM clean)
SELECT CASE WHEN is_early THEN row_number() OVER (PARTITION BY is_early ORDER BY h, experiment_id)
    ELSE (SELECT count(*) FROM clean WHERE {_EARLY}) + row_number() OVER (PARTITION BY is_early ORDER BY h, experiment_id) END AS experiment_key,
  experiment_id, learning_rate, batch_size, epochs, source, mlflow_run_id, mlflow_experiment_name FROM ranked""",
    ),
)
def dim_upsert_second_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early runs loaded first, then all: known experiments keep their keys, new ones follow."""
    staging = _staging(spark, sf_dir)
    first_load = dimensions.new_dimension_rows(_early(staging), "dim_experiment", None)
    existing = materialize(first_load, scratch(spark, "dim_experiment"))
    added = dimensions.new_dimension_rows(staging, "dim_experiment", existing)
    return existing.unionByName(added)


@query("fact_training_run", with_sql(oracle.KEYED, oracle.FACT))
def fact_training_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact rows, built anew from staging and the stored dimensions."""
    store = star_store(spark, sf_dir)
    dims = {t: store.read(t) for t in DIMENSIONS}
    return plain_times(fact.fact_rows(fact.attach_keys(store.read("staging"), dims)))


@query("fact_refresh", with_sql(oracle.KEYED, oracle.FACT))
def fact_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored fact table of the early runs, refreshed to all: months that did not change stay as they are."""
    built = star_store(spark, sf_dir)
    dims = {t: built.read(t) for t in DIMENSIONS}
    store = TableStore(spark, scratch(spark, "refresh"))
    load_fact(store, _early(built.read("staging")), dims)
    return plain_times(load_fact(store, built.read("staging"), dims).drop("run_month"))


@query(
    "dim_experiment_old_staging",
    with_sql(
        oracle.CLEAN,
        "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS mlflow_run_id, CAST(NULL AS VARCHAR) AS mlflow_experiment_name) FROM ("
        + oracle.dim_sql("dim_experiment")
        + ")",
    ),
)
def dim_experiment_old_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Experiments from a staging table that does not have the optional columns yet."""
    old = _staging(spark, sf_dir).drop("mlflow_run_id", "mlflow_experiment_name")
    return dimensions.new_dimension_rows(old, "dim_experiment", None)


@query(
    "pipeline_guards",
    with_sql(
        oracle.AUDITED,
        """SELECT 'no_valid_record' AS guard, false AS went_on, count(*) AS rejected_rows,
  0 AS staged_rows FROM audited
UNION ALL SELECT 'empty_staging', false, 0, 0
UNION ALL SELECT 'unknown_strategy', false, 0, 0""",
    ),
)
def pipeline_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stops the pipeline: only faulty records, an empty staging table, a strategy that there is not."""
    raw, order = adapter.raw_runs(spark, sf_dir), adapter.raw_order()
    faulty = raw.withColumn("status", F.lit("unknown"))
    store = TableStore(spark, scratch(spark, "guards"))
    went_on = run_etl(faulty, order, store)
    rejected = json_records.read_rejects(spark, store.path("rejects")).count()
    empty = TableStore(spark, scratch(spark, "guards"))
    empty.overwrite(records(_audited(spark, sf_dir)).limit(0), "staging")
    loaded = load_warehouse(empty, Settings())
    try:
        run_etl(raw, order, store, "guess")
        known = True
    except ValueError:
        known = False
    rows = [("no_valid_record", went_on, rejected), ("empty_staging", loaded, 0), ("unknown_strategy", known, 0)]
    staged = int(store.exists("staging"))
    return spark.createDataFrame([(*r, staged) for r in rows], "guard string, went_on boolean, rejected_rows long, staged_rows int")


@query(
    "fact_unresolved_keys",
    with_sql(
        oracle.CLEAN,
        f"""SELECT count(*) FILTER (WHERE NOT ({_EARLY})) AS dropped_rows,
  count(*) FILTER (WHERE {_EARLY}) AS kept_rows FROM clean""",
    ),
)
def fact_unresolved_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All runs against the experiment dimension of the early runs: the late ones do not resolve."""
    store = star_store(spark, sf_dir)
    staging = store.read("staging")
    dims = {t: store.read(t) for t in DIMENSIONS}
    early_ids = _early(staging).select("experiment_id")
    dims["dim_experiment"] = dims["dim_experiment"].join(early_ids, "experiment_id", "left_semi")
    return fact.unresolved_count(fact.attach_keys(staging, dims))


@query(
    "fact_out_of_calendar",
    with_sql(
        oracle.CLEAN,
        """SELECT CAST(strftime("timestamp", '%Y%m%d') AS INTEGER) AS date_key, count(*) AS run_count
FROM clean WHERE "timestamp" < TIMESTAMP '2020-01-01' OR "timestamp" >= TIMESTAMP '2031-01-01' GROUP BY 1""",
    ),
)
def fact_out_of_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of the fact table outside the default calendar."""
    days = dimensions.calendar(spark, "2020-01-01", "2030-12-31")
    return fact.out_of_calendar(_star(spark, sf_dir).fact, days)


# --- monitoring -----------------------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.prediction_events(spark, sf_dir)


def _cutoff(minutes: int) -> str:
    return f"event_timestamp >= (SELECT max(event_timestamp) FROM predictions) - INTERVAL {minutes} MINUTE"


_PREDICTION_COLUMNS = (
    "stream_entry_id, model_name, model_version, prediction, ground_truth, latency_ms, event_timestamp"
)


@query(
    "recent_predictions",
    with_sql(
        oracle.EVENTS,
        f"""SELECT {_PREDICTION_COLUMNS} FROM predictions WHERE {_cutoff(10080)}
ORDER BY event_timestamp DESC, stream_entry_id DESC LIMIT 5000""",
    ),
)
def recent_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest 5,000 events of the last week of the log."""
    events = _events(spark, sf_dir)
    cutoff = monitoring.latest_minus(events, 10080)
    return plain_times(monitoring.recent_predictions(events, cutoff))


@query(
    "monitored_models",
    with_sql(
        oracle.EVENTS,
        "SELECT model_name, model_version, count(*) AS event_count, max(event_timestamp) AS latest_event "
        "FROM predictions GROUP BY ALL",
    ),
)
def monitored_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(monitoring.monitored_models(_events(spark, sf_dir)))


_ALLOWED = "click:v1, view:v0,, signup , purchase:v2,absent:v9"


@query(
    "allow_list",
    with_sql(
        oracle.EVENTS,
        f"""SELECT {_PREDICTION_COLUMNS} FROM predictions
WHERE (model_name, model_version) IN (('click', 'v1'), ('view', 'v0'), ('purchase', 'v2'))""",
    ),
)
def allow_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(monitoring.allow_listed(_events(spark, sf_dir), _ALLOWED))


def _latency_sql(condition: str) -> str:
    return f"""SELECT model_name, model_version, count(*) AS event_count,
  {oracle.rnd('avg(latency_ms)', 6)} AS avg_latency_ms,
  {oracle.rnd('quantile_cont(latency_ms, 0.5)', 6)} AS p50_latency_ms,
  {oracle.rnd('quantile_cont(latency_ms, 0.95)', 6)} AS p95_latency_ms
FROM predictions {condition} GROUP BY ALL"""


def _rounded_latency(summary: DataFrame) -> DataFrame:
    names = ("avg_latency_ms", "p50_latency_ms", "p95_latency_ms")
    return summary.withColumns({c: half_up(F.col(c), 6) for c in names})


@query("latency_summary", with_sql(oracle.EVENTS, _latency_sql(f"WHERE {_cutoff(60)}")))
def latency_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    cutoff = monitoring.latest_minus(events, 60)
    return _rounded_latency(monitoring.latency_summary(events, cutoff))


@query("latency_history", with_sql(oracle.EVENTS, _latency_sql("")))
def latency_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latency summary over the whole log."""
    events = _events(spark, sf_dir)
    start = events.agg(F.min("event_timestamp")).scalar()
    return _rounded_latency(monitoring.latency_summary(events, start))


_VOLUME = with_sql(
    oracle.EVENTS,
    "SELECT date_trunc('minute', event_timestamp) AS \"minute\", model_name, count(*) AS event_count "
    "FROM predictions GROUP BY ALL",
)


@query("volume_per_minute", _VOLUME)
def volume_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(monitoring.volume_per_minute(_events(spark, sf_dir)))


_LATE_LABELS = with_sql(
    oracle.EVENTS,
    """SELECT stream_entry_id, model_name, model_version, prediction,
  CASE WHEN model_name = 'error' AND stream_entry_id % 3 <> 0
    THEN TRY_CAST(regexp_extract(props, '"k":\\s*(\\d+)', 1) AS DOUBLE) / 100 ELSE ground_truth END AS ground_truth,
  latency_ms, event_timestamp
FROM predictions JOIN events ON event_id = stream_entry_id""",
)


@query("late_labels", _LATE_LABELS)
def late_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = adapter.late_labels(spark, sf_dir)
    return plain_times(monitoring.with_late_labels(_events(spark, sf_dir), labels))


@query(
    "daily_prediction_rollup",
    with_sql(
        oracle.EVENTS,
        f"""SELECT CAST(event_timestamp AS DATE) AS event_date, model_name, model_version,
  count(*) AS event_count, count(ground_truth) AS labelled_count,
  {oracle.rnd('avg(abs(prediction - ground_truth))', 6)} AS mean_abs_error,
  {oracle.rnd('avg(latency_ms)', 6)} AS avg_latency_ms FROM predictions GROUP BY ALL""",
    ),
)
def daily_prediction_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_rollup(monitoring.daily_rollup(_events(spark, sf_dir)))


def _rounded_rollup(rollup: DataFrame) -> DataFrame:
    return rollup.withColumns(
        {c: half_up(F.col(c), 6) for c in ("mean_abs_error", "avg_latency_ms")}
    )


@query(
    "event_validation",
    with_sql(
        oracle.EVENTS,
        """SELECT CASE WHEN latency_ms < 0.5 THEN 'latency_ms:range' WHEN stream_entry_id % 13 = 0 THEN 'prediction:type'
    ELSE 'valid' END AS outcome, count(*) AS event_count,
  count(ground_truth) FILTER (WHERE stream_entry_id % 7 <> 0) AS with_truth FROM predictions GROUP BY ALL""",
    ),
)
def event_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as text, some spoilt: negative latency, no number, a truth that reads ``None``."""
    number = F.col("stream_entry_id")
    spoilt = _events(spark, sf_dir).select(
        number,
        "model_name",
        "model_version",
        F.when((number % 13 == 0) & (F.col("latency_ms") >= 0.5), "n/a")
        .otherwise(F.col("prediction").cast("string"))
        .alias("prediction"),
        F.when(number % 7 == 0, "None")
        .otherwise(F.col("ground_truth").cast("string"))
        .alias("ground_truth"),
        F.when(F.col("latency_ms") < 0.5, "-1").otherwise(F.col("latency_ms").cast("string")).alias(
            "latency_ms"
        ),
        F.col("event_timestamp").cast("string").alias("event_timestamp"),
    )
    first = F.coalesce(F.get("errors", F.lit(0)), F.lit("valid"))
    return (
        audit_events(spoilt)
        .groupBy(first.alias("outcome"))
        .agg(F.count(F.lit(1)).alias("event_count"), F.count("ground_truth").alias("with_truth"))
    )


# --- drift ----------------------------------------------------------------------------


@query(
    "psi_edges",
    with_sql(
        oracle.windowed(200),
        f"SELECT model_name, model_version, edge_index, {oracle.rnd('edge', 9)} AS edge FROM edges",
    ),
)
def psi_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = drift.edge_rows(drift.model_windows(_events(spark, sf_dir)))
    return rows.withColumn("edge", half_up(F.col("edge"), 9))


@query(
    "psi_histogram",
    with_sql(
        oracle.windowed(200),
        f"""SELECT model_name, model_version, baseline_n, recent_n, bin,
  {oracle.rnd('low', 9)} AS low, {oracle.rnd('high', 9)} AS high, baseline_count, recent_count FROM histogram""",
    ),
)
def psi_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = drift.histogram_rows(drift.model_windows(_events(spark, sf_dir)))
    return rows.withColumns({c: half_up(F.col(c), 9) for c in ("low", "high")})


@query(
    "psi",
    with_sql(
        oracle.windowed(150),
        f"SELECT model_name, model_version, {oracle.rnd('psi', 9)} AS psi FROM scored_models",
    ),
)
def psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index of 150-event windows, which take seven bins."""
    scored = drift.with_psi(drift.model_windows(_events(spark, sf_dir), 150))
    return scored.select("model_name", "model_version", half_up(F.col("psi"), 9).alias("psi"))


_DRIFT_SQL = f"""SELECT model_name, model_version, {oracle.rnd('psi', 4)} AS psi, psi > 0.25 AS is_drifted,
  200::BIGINT AS baseline_n, 200::BIGINT AS recent_n FROM scored_models WHERE event_count >= 200"""


@query("drift_check", with_sql(oracle.windowed(200), _DRIFT_SQL))
def drift_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.check_drift(_events(spark, sf_dir))


@query(
    "drift_status",
    with_sql(
        oracle.windowed(300),
        f"""SELECT model_name, model_version, event_count, 600::BIGINT AS events_needed,
  event_count >= 600 AS has_enough_data,
  CASE WHEN event_count >= 600 THEN {oracle.rnd('psi', 4)} END AS psi,
  CASE WHEN event_count >= 600 THEN 300::BIGINT END AS baseline_n,
  CASE WHEN event_count >= 600 THEN 300::BIGINT END AS recent_n,
  CASE WHEN event_count >= 600 THEN CASE WHEN {oracle.rnd('psi', 4)} > 0.25 THEN 'drift detected' ELSE 'stable' END END AS label
FROM scored_models""",
    ),
)
def drift_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status with windows of 300, where some models of the small data have too few events."""
    return drift.drift_status(_events(spark, sf_dir), window=300)


_ALERT_SQL = f"""SELECT model_name, model_version, psi, 'warning' AS severity, 'WARNING' AS log_level,
  'Drift detected for ' || model_name || '/' || model_version || ': PSI=' || psi || ' (threshold=0.05, baseline_n=200, recent_n=200)' AS message,
  '{{"text":"[WARNING] Model Monitoring: Drift detected for ' || model_name || '/' || model_version || ': PSI=' || psi || ' (threshold=0.05, baseline_n=200, recent_n=200)"}}' AS payload
FROM (SELECT model_name, model_version, {oracle.rnd('psi', 4)} AS psi FROM scored_models
  WHERE event_count >= 200 AND psi > 0.05)"""


@query("alerts", with_sql(oracle.windowed(200), _ALERT_SQL))
def drift_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts at a threshold that the driver's events exceed."""
    return alerts.drift_alerts(drift.check_drift(_events(spark, sf_dir), threshold=0.05), 0.05)


_PLACE = "(CASE WHEN i = bins THEN 1.0::DOUBLE ELSE i * (1.0::DOUBLE / bins) END * (n - 1))"


@query(
    "psi_first_half_vs_second_half",
    with_sql(
        oracle.EVENTS,
        f""", halves AS (
  SELECT *, event_timestamp < (SELECT min(event_timestamp) FROM predictions) + INTERVAL 15 DAY AS is_base FROM predictions),
sizes AS (
  SELECT model_name, list_sort(list(prediction)) AS o, count(*) AS n, greatest(2, least(10, count(*) // 20)) AS bins
  FROM halves WHERE is_base GROUP BY 1),
edges AS (
  SELECT model_name, list_sort(list_distinct(list_transform(range(bins + 1), lambda i:
    o[CAST(floor({_PLACE}) AS BIGINT) + 1] + (o[CAST(ceil({_PLACE}) AS BIGINT) + 1] - o[CAST(floor({_PLACE}) AS BIGINT) + 1])
      * ({_PLACE} - floor({_PLACE}))))) AS e
  FROM sizes),
binned AS (
  SELECT model_name, is_base, CASE WHEN prediction BETWEEN e[1] AND e[-1]
    THEN least(len(list_filter(e, lambda x: x <= prediction)), len(e) - 1) END AS bin
  FROM halves JOIN edges USING (model_name)),
cells AS (
  SELECT model_name, bin, count(*) FILTER (WHERE is_base) AS b, count(*) FILTER (WHERE NOT is_base) AS r FROM binned GROUP BY ALL),
shares AS (
  SELECT model_name, bin, b / sum(b) OVER m + 1e-6::DOUBLE AS b, r / sum(r) OVER m + 1e-6::DOUBLE AS r
  FROM cells WINDOW m AS (PARTITION BY model_name))
SELECT model_name, {oracle.rnd('sum((r - b) * ln(r / b))', 9)} AS psi FROM shares WHERE bin IS NOT NULL GROUP BY 1""",
    ),
)
def psi_first_half_vs_second_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index of two samples of any size: the first 15 days against the rest."""
    events = _events(spark, sf_dir)
    middle = events.agg(F.min("event_timestamp") + F.expr("INTERVAL 15 DAYS")).scalar()
    before = F.col("event_timestamp") < middle
    scored = drift.sample_psi(events.filter(before), events.filter(~before), ["model_name"])
    return scored.select("model_name", half_up(F.col("psi"), 9).alias("psi"))


# --- tracked runs ----------------------------------------------------------------------


@query("tracked_runs_to_records", with_sql(oracle.TRACKED, _RECORD_SQL + "tracked"))
def tracked_runs_to_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = adapter.tracked_runs(spark, sf_dir)
    chosen = runs.filter(F.col("experiment_name") == "experiment-1")
    return plain_times(
        runs_to_records(
            runs,
            adapter.tracked_params(spark, sf_dir, chosen),
            adapter.tracked_metrics(spark, sf_dir, chosen),
            "experiment-1",
            F.lit("2000-01-01").cast("timestamp"),
        )
    )


# --- evaluation and enrichment -----------------------------------------------------------


@query(
    "macro_prf",
    """WITH pairs AS (SELECT lang, quality AS t, toxic AS p FROM labels JOIN documents USING (doc_id)),
per_class AS (
  SELECT lang, c, count(*) FILTER (WHERE t = c AND p = c) AS hit, count(*) FILTER (WHERE p = c) AS guessed,
    count(*) FILTER (WHERE t = c) AS actual
  FROM pairs CROSS JOIN range(3) r(c) GROUP BY ALL),
macro AS (
  SELECT lang, sum(CASE WHEN guessed > 0 THEN hit / guessed ELSE 0 END) / 3 AS p,
    sum(CASE WHEN actual > 0 THEN hit / actual ELSE 0 END) / 3 AS r
  FROM per_class GROUP BY lang)
SELECT lang, """
    + f"{oracle.rnd('p', 9)} AS macro_precision, {oracle.rnd('r', 9)} AS macro_recall, "
    + f"{oracle.rnd('CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END', 9)} AS macro_f1 FROM macro",
)
def macro_prf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Macro scores per language over three classes, one of which never occurs."""
    pairs = adapter.graded_documents(spark, sf_dir)
    scores = evaluate.macro_precision_recall_f1(pairs, "quality", "toxic", 3, ["lang"])
    names = ("macro_precision", "macro_recall", "macro_f1")
    return scores.withColumns({c: half_up(F.col(c), 9) for c in names})


@query(
    "accuracy_by_group",
    f"""SELECT lang, count(*) AS n, {oracle.rnd('avg(CAST(quality = toxic AS INTEGER))', 9)} AS accuracy
FROM labels JOIN documents USING (doc_id) GROUP BY lang""",
)
def accuracy_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = adapter.graded_documents(spark, sf_dir)
    return evaluate.accuracy(pairs, "quality", "toxic", ["lang"]).withColumn(
        "accuracy", half_up(F.col("accuracy"), 9)
    )


@query(
    "weighted_loss",
    f"""SELECT l_orderkey AS run, sum(l_quantity) AS samples,
  {oracle.rnd('sum(10 * abs(l_tax) * l_quantity) / nullif(sum(l_quantity), 0)', 9)} AS mean_loss
FROM lineitem GROUP BY 1""",
)
def weighted_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = adapter.training_history(spark, sf_dir)
    return evaluate.weighted_loss(history, "loss", "samples", ["run"]).withColumn(
        "mean_loss", half_up(F.col("mean_loss"), 9)
    )


@query(
    "final_epoch",
    """SELECT l_orderkey AS run, CAST(l_linenumber AS BIGINT) AS epoch, l_quantity AS samples, 10 * abs(l_tax) AS loss,
  1 - abs(l_discount) AS accuracy, l_partkey, l_suppkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) = 1""",
)
def final_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = adapter.training_history(spark, sf_dir)
    return evaluate.final_epoch(history, "run", "epoch", ["l_partkey", "l_suppkey", "samples"])


@query(
    "f1_consistency",
    with_sql(
        oracle.CLEAN,
        f"""SELECT experiment_id, f1_score, f1_recomputed, abs(f1_score - f1_recomputed) <= 1e-4::DOUBLE + 1e-9::DOUBLE AS f1_consistent
FROM (SELECT *, {oracle.rnd('2 * "precision" * recall / ("precision" + recall + 1e-9::DOUBLE)', 4)} AS f1_recomputed FROM clean)""",
    ),
)
def f1_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.f1_consistency(_staging(spark, sf_dir)).select(
        "experiment_id", "f1_score", "f1_recomputed", "f1_consistent"
    )


_GPU_SQL = """, gpu_profiles(gpu, speed_factor, power_watts) AS (VALUES
  ('NVIDIA T4', 1.0::DOUBLE, 70.0::DOUBLE), ('NVIDIA RTX 3090', 2.2, 350.0), ('NVIDIA RTX 4090', 3.0, 450.0),
  ('NVIDIA V100', 2.5, 300.0), ('NVIDIA A100', 4.0, 400.0), ('NVIDIA H100', 6.0, 700.0))
"""


@query(
    "energy_estimate",
    with_sql(
        oracle.CLEAN,
        _GPU_SQL
        + f"""SELECT experiment_id, energy_consumption_kwh, {oracle.rnd('power_watts / 1000 * (training_time_sec / 3600)', 9)} AS estimated_kwh
FROM clean LEFT JOIN gpu_profiles USING (gpu)""",
    ),
)
def energy_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.energy_estimate(_staging(spark, sf_dir)).select(
        "experiment_id",
        "energy_consumption_kwh",
        half_up(F.col("estimated_kwh"), 9).alias("estimated_kwh"),
    )


@query(
    "time_residual",
    with_sql(
        oracle.CLEAN,
        _GPU_SQL
        + f"""SELECT experiment_id, {oracle.rnd('expected', 6)} AS expected_time_sec, {oracle.rnd('training_time_sec / expected', 6)} AS time_ratio
FROM (SELECT *, epochs * 45.0::DOUBLE * (64.0::DOUBLE / batch_size) / speed_factor AS expected FROM clean LEFT JOIN gpu_profiles USING (gpu))""",
    ),
)
def time_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.time_residual(_staging(spark, sf_dir)).select(
        "experiment_id",
        half_up(F.col("expected_time_sec"), 6).alias("expected_time_sec"),
        half_up(F.col("time_ratio"), 6).alias("time_ratio"),
    )


@query(
    "accuracy_residual",
    with_sql(
        oracle.CLEAN,
        f""", model_profiles(model_name, base_accuracy) AS (VALUES
  ('resnet18', 0.90::DOUBLE), ('resnet50', 0.94), ('resnet101', 0.95), ('vit_base', 0.96), ('vit_large', 0.97),
  ('bert_base', 0.91), ('bert_large', 0.93), ('gpt2_small', 0.88), ('efficientnet_b0', 0.89), ('efficientnet_b7', 0.95),
  ('mobilenet_v3', 0.85), ('yolo_v8', 0.92))
SELECT experiment_id, {oracle.rnd('expected', 9)} AS expected_accuracy, {oracle.rnd('accuracy - expected', 9)} AS accuracy_residual
FROM (SELECT *, least(greatest(base_accuracy * (1 - 1 / (1 + epochs / 20.0::DOUBLE))
    - CASE WHEN learning_rate > 0.02 THEN least(0.15::DOUBLE, (learning_rate - 0.02::DOUBLE) * 2) ELSE 0 END, 0.4::DOUBLE), 0.995::DOUBLE) AS expected
  FROM clean LEFT JOIN model_profiles USING (model_name) WHERE status = 'success')""",
    ),
)
def accuracy_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.accuracy_residual(_staging(spark, sf_dir)).select(
        "experiment_id",
        half_up(F.col("expected_accuracy"), 9).alias("expected_accuracy"),
        half_up(F.col("accuracy_residual"), 9).alias("accuracy_residual"),
    )


@query(
    "model_size",
    f"""SELECT p_partkey, {oracle.rnd('p_retailprice * 1000 * 4 / (1024.0::DOUBLE * 1024)', 9)} AS parameter_mb FROM part""",
)
def model_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts seen as models with a thousand parameters per unit of price."""
    parts = adapter.table(spark, sf_dir, "part").withColumn("parameters", F.col("p_retailprice") * 1000)
    return enrich.model_size(parts, "parameters").select(
        "p_partkey", half_up(F.col("parameter_mb"), 9).alias("parameter_mb")
    )


@query(
    "sample_n",
    "SELECT doc_id, lang, source, n_chars FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 150",
)
def sample_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seeded sample of exactly 150 documents."""
    documents = adapter.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return sample_n(documents, "doc_id", 150, seed=42)


# --- streams ---------------------------------------------------------------------------


def _published(spark: SparkSession, sf_dir: str) -> str:
    """The driver's events as a log of many files in random order.

    A tenth is delivered twice, and every fiftieth again with another date.
    """
    path = scratch(spark, "event-log")
    events = _events(spark, sf_dir)
    event_log.publish(events.repartition(12, F.xxhash64("stream_entry_id")), path)
    event_log.publish(events.filter(F.col("stream_entry_id") % 10 == 0), path)
    moved = F.col("event_timestamp") + F.expr("INTERVAL 400 DAYS")
    # Published last, so the first delivery is the one that is read first.
    event_log.publish(events.filter(F.col("stream_entry_id") % 50 == 0).withColumn("event_timestamp", moved), path)
    return path


def _drained(started) -> None:
    started.awaitTermination()


@query("stream_ingest_dedup", with_sql(oracle.EVENTS, f"SELECT {_PREDICTION_COLUMNS} FROM predictions"))
def stream_ingest_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log drained into the prediction table, repeated deliveries dropped."""
    log, root = _published(spark, sf_dir), scratch(spark, "ingest")
    for _ in range(2):  # the second run finds nothing new
        _drained(ingest(spark, log, f"{root}/table", f"{root}/bad", f"{root}/checkpoint", max_files=4))
    stored = read_predictions(spark, f"{root}/table")
    return plain_times(
        stored.select(
            F.col("stream_entry_id").cast("long").alias("stream_entry_id"),
            *_PREDICTION_COLUMNS.split(", ")[1:],
        )
    )


@query("stream_drift_alerts", with_sql(oracle.windowed(200), _ALERT_SQL))
def stream_drift_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts after the last micro-batch of an ingest in several batches."""
    log, root = scratch(spark, "event-log"), scratch(spark, "drift")
    event_log.publish(_events(spark, sf_dir).repartitionByRange(4, "event_timestamp"), log)
    job = DriftJob(f"{root}/drift", threshold=0.05)
    last: list[int] = []

    def after(fresh: DataFrame, batch_id: int) -> None:
        job(fresh, batch_id)
        last[:] = [batch_id]

    _drained(
        ingest(
            spark, log, f"{root}/table", f"{root}/bad", f"{root}/checkpoint", max_files=2, after_batch=after
        )
    )
    return alerts.drift_alerts(job.check(spark, last[0]), 0.05)


def _ingested(spark: SparkSession, sf_dir: str, name: str, hook=None) -> tuple[DataFrame, object, str]:
    """The stored events and the hook's partial results after an ingest in several micro-batches."""
    log, root = _published(spark, sf_dir), scratch(spark, name)
    job = hook and hook(f"{root}/partial", compact_every=3)
    _drained(
        ingest(spark, log, f"{root}/table", f"{root}/bad", f"{root}/checkpoint", max_files=3, after_batch=job)
    )
    return read_predictions(spark, f"{root}/table"), job, root


@query("stream_volume", _VOLUME)
def stream_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume per minute, added up from the partial results of several micro-batches."""
    _, job, _ = _ingested(spark, sf_dir, "volume", metrics.VolumeJob)
    return plain_times(job.volume(spark))


@query(
    "stream_latency",
    with_sql(
        oracle.EVENTS,
        f""", starts AS (
  SELECT *, to_timestamp(CAST(floor(epoch(event_timestamp) / 300) * 300 AS BIGINT) - k * 300)::TIMESTAMP AS window_start
  FROM predictions, (SELECT unnest(range(12)) AS k))
SELECT window_start, window_start + INTERVAL 60 MINUTES AS window_end, model_name, model_version, count(*) AS event_count,
  {oracle.rnd('avg(latency_ms)', 6)} AS avg_latency_ms, {oracle.rnd('quantile_cont(latency_ms, 0.5)', 6)} AS p50_latency_ms,
  {oracle.rnd('quantile_cont(latency_ms, 0.95)', 6)} AS p95_latency_ms
FROM starts GROUP BY ALL""",
    ),
)
def stream_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latency over sliding hours after several micro-batches in random order."""
    stored, panes, _ = _ingested(spark, sf_dir, "latency", metrics.LatencyPanes)
    return plain_times(_rounded_latency(panes.sliding(stored)))


@query("stream_latency_trailing", with_sql(oracle.EVENTS, _latency_sql(f"WHERE {_cutoff(10080)}")))
def stream_latency_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latency summary of the last week of the stored events, from the panes' histograms."""
    stored, panes, _ = _ingested(spark, sf_dir, "trailing", metrics.LatencyPanes)
    return _rounded_latency(panes.trailing(stored, 10080))


def _sent_labels(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """A stream of labels in several micro-batches; half of them also came before, with another value."""
    labels = adapter.late_labels(spark, sf_dir).withColumn("stream_entry_id", F.col("stream_entry_id").cast("string"))
    early = labels.withColumns({"label": F.lit(-1.0), "label_timestamp": F.col("label_timestamp") - F.expr("INTERVAL 1 MINUTE")})
    labels.unionByName(early.filter("cast(stream_entry_id AS BIGINT) % 2 = 0")).repartition(6).write.parquet(f"{root}/sent")
    return (
        spark.readStream.schema("stream_entry_id string, label double, label_timestamp timestamp")
        .option("maxFilesPerTrigger", 2)
        .parquet(f"{root}/sent")
    )


def _maintained(spark: SparkSession, sf_dir: str, name: str) -> tuple[label_stream.LabelJob, str]:
    """Kept labels and rollup after an ingest whose middle the labels came in: some wait for events, some are corrected."""
    log, root = scratch(spark, "event-log"), scratch(spark, name)
    job = label_stream.LabelJob(f"{root}/labels", f"{root}/table", compact_every=3)
    events, half = _events(spark, sf_dir), F.pmod(F.xxhash64("stream_entry_id"), F.lit(2))
    stream = _sent_labels(spark, sf_dir, root)
    for part in (0, 1):
        event_log.publish(events.filter(half == part).repartition(3), log)
        _drained(
            ingest(spark, log, f"{root}/table", f"{root}/bad", f"{root}/checkpoint", max_files=2, after_batch=job.add_events)
        )
        if part == 0:
            _drained(label_stream.keep_labels(spark, stream, job, f"{root}/labels-checkpoint"))
    return job, f"{root}/table"


@query("stream_kept_labels", _LATE_LABELS)
def stream_kept_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored events with their kept labels; half of the events came after their labels."""
    job, table = _maintained(spark, sf_dir, "kept-labels")
    labelled = job.labelled(read_predictions(spark, table))
    return plain_times(
        labelled.select(F.col("stream_entry_id").cast("long").alias("stream_entry_id"), *_PREDICTION_COLUMNS.split(", ")[1:])
    )


@query(
    "stream_daily_rollup",
    f"""WITH labelled AS ({_LATE_LABELS})
SELECT CAST(event_timestamp AS DATE) AS event_date, model_name, model_version,
  count(*) AS event_count, count(ground_truth) AS labelled_count,
  {oracle.rnd('avg(abs(prediction - ground_truth))', 6)} AS mean_abs_error,
  {oracle.rnd('avg(latency_ms)', 6)} AS avg_latency_ms FROM labelled GROUP BY ALL""",
)
def stream_daily_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily rollup with late and corrected labels, from signed changes."""
    job, _ = _maintained(spark, sf_dir, "daily-rollup")
    return _rounded_rollup(job.rollup(spark))


@query("stream_late_labels", _LATE_LABELS)
def stream_late_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored events with the latest label of each; both came in several micro-batches, some labels twice."""
    stored, _, root = _ingested(spark, sf_dir, "labels")
    stream = _sent_labels(spark, sf_dir, root)
    _drained(metrics.ingest_labels(spark, stream, f"{root}/labels", f"{root}/labels-checkpoint"))
    labelled = monitoring.with_late_labels(stored, spark.read.parquet(f"{root}/labels"))
    return plain_times(
        labelled.select(F.col("stream_entry_id").cast("long").alias("stream_entry_id"), *_PREDICTION_COLUMNS.split(", ")[1:])
    )
