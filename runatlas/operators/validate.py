"""Record validation: every row is kept, with the list of what is wrong with it."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runatlas.functions.coerce import coerce, to_double
from runatlas.schemas import EVENT_FIELDS, RECORD_COLUMNS, RECORD_FIELDS, Field

ABSENT = "_absent"  # optional array column: names of the fields the raw record does not have
RAW = "raw_record"
NOT_TEXT = "_not_text"  # optional array column: text fields that hold something else


def _out_of_range(field: Field) -> str:
    """True where a value breaks its bounds. NaN breaks any bound."""
    checks = [f"isnan({field.name})"] if isinstance(field.dtype, T.DoubleType) else []
    for bound, breaks in ((field.gt, "<="), (field.ge, "<"), (field.lt, ">="), (field.le, ">")):
        if bound is not None:
            checks.append(f"{field.name} {breaks} {bound}")
    return " OR ".join(checks)


def _checks(field: Field, flags: set[str]) -> list[tuple[str, str]]:
    """SQL conditions of what is wrong with one typed field, and their error codes; the first that is true counts."""
    name, was_null = field.name, f"_null_{field.name}"
    steps: list[tuple[str, str]] = []
    if not field.nullable:
        if field.default is None:
            steps.append((was_null, "missing"))
        elif ABSENT in flags:
            # An explicit null does not take the default.
            steps.append((f"{was_null} AND NOT array_contains({ABSENT}, '{name}')", "type"))
    if isinstance(field.dtype, T.StringType):
        if NOT_TEXT in flags:
            steps.append((f"array_contains({NOT_TEXT}, '{name}')", "type"))
    else:
        steps.append((f"NOT {was_null} AND {name} IS NULL", "type"))
    if field.allowed:
        choices = ", ".join(f"'{a}'" for a in field.allowed)
        steps.append((f"{name} NOT IN ({choices})", "enum"))
    if field.bounded:
        steps.append((_out_of_range(field), "range"))
    return [(condition, f"{name}:{kind}") for condition, kind in steps]


def _typed(raw: DataFrame, fields: Sequence[Field]) -> tuple[DataFrame, list[str], list[str], list[list[tuple[str, str]]]]:
    """Every field typed, with the raw values beside; the columns that pass through, those that show what came in, and the fields' checks."""
    given = [f.name for f in fields if f.name in raw.columns]
    beside = []
    if RAW in raw.columns:
        beside = [RAW]
    elif fields is RECORD_FIELDS:
        beside = [f"struct({', '.join(f'`{name}`' for name in given)}) AS _raw"]
    kinds = {f.name: f.dataType for f in raw.schema.fields}
    flags = {ABSENT, NOT_TEXT} & set(kinds)
    columns: list[str] = []
    numbers: list[str] = []
    for field in fields:
        kind = kinds.get(field.name, T.StringType())
        source = field.name if field.name in kinds else "cast(NULL AS STRING)"
        if isinstance(field.dtype, T.IntegerType) and isinstance(kind, T.StringType):
            # Read once below the generator; whether it is whole is then asked of a number.
            numbers.append(f"{to_double(source, kind)} AS _number_{field.name}")
            value = coerce(f"_number_{field.name}", T.DoubleType(), field.dtype)
        else:
            value = coerce(source, kind, field.dtype)
        if field.default is not None:
            value = f"coalesce({value}, '{field.default}')"
        columns += [f"{value} AS {field.name}", f"{source} IS NULL AS _null_{field.name}"]
    names = [f.name for f in fields]
    rest = [c for c in raw.columns if c not in names and c not in flags and c != RAW]
    read = raw.selectExpr("*", *numbers) if numbers else raw
    typed = read.selectExpr(*beside, f"inline(array(struct({', '.join([*columns, *rest, *sorted(flags)])})))")
    checks = [found for found in (_checks(field, flags) for field in fields) if found]
    shows = ["_raw"] if RAW not in raw.columns and beside else [RAW] if beside else []
    return typed, rest, shows, checks


def audit(raw: DataFrame, fields: Sequence[Field] = RECORD_FIELDS) -> DataFrame:
    """Type every field and add ``errors``, one code per faulty field in field order.

    Raw columns may be text or already typed; missing optional columns count
    as null. Other columns pass through. ``raw_record`` shows what came in: the source's own text where it
    has one, else the raw values of faulty records as JSON, nulls included, before any value is typed.

    The typed columns come out of a generator. A filter on what follows stays
    above it; Spark would otherwise copy the whole expression of every column
    into the filter, and with many derived columns that grows out of hand. The raw values go beside the
    generator, so they are pruned where nothing reads them.
    """
    typed, rest, shows, checks = _typed(raw, fields)
    names = [f.name for f in fields]
    faults = ", ".join("CASE " + " ".join(f"WHEN {condition} THEN '{code}'" for condition, code in steps) + " END" for steps in checks)
    # Most records are fine: the list is only built where some fault is found.
    errors = (
        f"CASE WHEN coalesce({faults}) IS NULL THEN array() "
        f"ELSE array_compact(array({faults})) END AS errors"
    )
    judged = typed.selectExpr(*names, *rest, *shows, errors)
    if "_raw" not in judged.columns:
        return judged
    shown = F.when(F.size("errors") > 0, F.to_json("_raw", {"ignoreNullFields": "false"}))
    return judged.select(*names, *rest, shown.alias(RAW), "errors")


def valid_only(raw: DataFrame, fields: Sequence[Field] = RECORD_FIELDS) -> DataFrame:
    """The typed rows without a fault, as ``valid_rows(audit(raw))`` less ``raw_record``: no list of errors is built.

    The checks are compiled together with the typing of the columns. For typed raw columns the method stays under the 8,000 bytes
    up to which the JVM compiles it; typing 27 columns of text takes more, and ``valid_rows`` is faster there.
    """
    typed, rest, _, checks = _typed(raw, fields)
    for condition, _ in (step for steps in checks for step in steps):
        typed = typed.filter(f"NOT coalesce({condition}, false)")
    return typed.select(*[f.name for f in fields], *rest)


def valid_rows(audited: DataFrame) -> DataFrame:
    return audited.filter(F.size("errors") == 0).drop("errors")


def rejected_rows(audited: DataFrame) -> DataFrame:
    return audited.filter(F.size("errors") > 0)


def reject_report(rejected: DataFrame) -> DataFrame:
    """Per rejected record: its id or ``UNKNOWN``, its first error and all of them."""
    return rejected.select(
        F.coalesce("experiment_id", F.lit("UNKNOWN")).alias("experiment_id"),
        F.element_at("errors", 1).alias("first_error"),
        F.concat_ws("; ", "errors").alias("validation_error"),
        F.size("errors").cast("long").alias("error_count"),
    )


def reject_reasons(audited: DataFrame) -> DataFrame:
    """How many records carry each error."""
    return (
        audited.select(F.explode("errors").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("record_count"))
    )


def audit_events(raw: DataFrame) -> DataFrame:
    """Validation of prediction events; a truth that does not parse becomes null."""
    kind = raw.schema["ground_truth"].dataType
    truth = F.expr(coerce("ground_truth", kind, T.DoubleType()))
    lenient = raw.withColumn("ground_truth", truth)
    return audit(lenient, EVENT_FIELDS)


def records(df: DataFrame) -> DataFrame:
    """The declared record columns only, in order."""
    return df.select(*RECORD_COLUMNS)
