"""Raw run records from JSON: list files, or one object per line for large data."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runatlas.operators.validate import ABSENT, NOT_TEXT
from runatlas.schemas import RECORD_FIELDS
from runatlas.sources.json_lists import list_elements

logger = logging.getLogger(__name__)

# Where a row stood in its input; sorting by these restores the input order.
INPUT_ORDER = ("source_rank", "_file", "_offset", "_row")

FILE_RECORDS = 200_000  # of a written file, at most: some 150 MB of text
REJECT_SCHEMA = "raw_record string, validation_error string"


def input_order() -> list[Column]:
    return [F.col(c) for c in INPUT_ORDER]


def _unpacked(rows: DataFrame) -> DataFrame:
    """Text columns for every record field from the variant column ``v``.

    What text alone cannot tell (key absent or null, text field holding a
    number) goes to two flag columns that validation reads.
    """
    # One lookup of all fields each, as a walk from the top for every field would cost most of the reading.
    texts = [f.name for f in RECORD_FIELDS if isinstance(f.dtype, T.StringType)]

    def all_as(kind: str, names: Sequence[str]) -> Column:
        return F.try_variant_get("v", "$", f"struct<{', '.join(f'`{n}`: {kind}' for n in names)}>")

    looked_up = rows.withColumns({"_text": all_as("string", [f.name for f in RECORD_FIELDS]), "_value": all_as("variant", texts)})
    kinds = [F.when(~F.coalesce(F.schema_of_variant(F.col(f"_value.{n}")), F.lit("VOID")).isin("STRING", "VOID"), n) for n in texts]
    absent = [F.when(F.col(f"_value.{f.name}").isNull(), f.name) for f in RECORD_FIELDS if f.default is not None]
    return looked_up.select(
        *[F.col(f"_text.{f.name}").alias(f.name) for f in RECORD_FIELDS],
        F.array_compact(F.array(*absent)).alias(ABSENT),
        F.array_compact(F.array(*kinds)).alias(NOT_TEXT),
        "raw_record",
        "_file",
        "_offset",
        "_row",
    )


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per line; splittable. A line that does not parse stays as a faulty record."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return _unpacked(
        lines.select(
            F.try_parse_json("value").alias("v"),
            F.col("value").alias("raw_record"),
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_offset"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )


def read_json_list(spark: SparkSession, path: str) -> DataFrame:
    """Files that each hold one JSON list; anything else at the top level is an error. Large files are split."""
    return _unpacked(
        list_elements(spark, path).select(
            "v",
            F.to_json("v").alias("raw_record"),
            "_file",
            F.lit(0).cast("long").alias("_offset"),
            F.col("pos").cast("long").alias("_row"),
        )
    )


def merge_sources(sources: Sequence[DataFrame]) -> DataFrame:
    """All sources in one frame; ``source_rank`` keeps the primary source first."""
    ranked = [df.withColumn("source_rank", F.lit(i)) for i, df in enumerate(sources)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)


def read_sources(
    spark: SparkSession, primary: str, extras: Sequence[str] = (), lines: bool = True
) -> DataFrame:
    """The primary source, which must exist, followed by the extra ones that do."""
    read = read_json_lines if lines else read_json_list
    found = [read(spark, primary)]
    for path in extras:
        try:
            found.append(read(spark, path))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            logger.warning("skipping extra source %s: not found", path)
    return merge_sources(found)


def _write_lines(df: DataFrame, path: str) -> None:
    """JSON lines in gzip: a tenth of the text. A file of these is not split, so each holds few enough for one task."""
    writer = df.write.mode("overwrite").option("compression", "gzip")
    writer.option("maxRecordsPerFile", FILE_RECORDS).json(path)


def write_records(df: DataFrame, path: str) -> None:
    """Records as JSON lines."""
    _write_lines(df, path)


def write_rejects(rejected: DataFrame, path: str) -> None:
    """Each rejected record with its errors; written even if there are none."""
    _write_lines(rejected.select("raw_record", F.concat_ws("; ", "errors").alias("validation_error")), path)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_rejects`` wrote; the declared columns spare a read that finds them out."""
    return spark.read.schema(REJECT_SCHEMA).json(path)
