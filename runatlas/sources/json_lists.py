"""Elements of JSON list files, found in parallel by byte blocks.

A file is read in pieces between commas, which Spark's text source splits like lines: no block needs what
stands before it. Whether a piece begins inside a string, and how deep it is nested, depends on all before it, but what a
piece *does* to that state is known for either case: it flips "in string" if it has an odd number of quotes, and changes the depth by
one number where it begins outside a string and by another where it begins inside one. These compose, so
blocks are summed up on their own for both cases, the blocks' sums are combined in order (one row a block), and each block then knows its
true state. A comma outside strings at depth one ends an element; pieces of one element are joined, also over block borders.

Where no file is larger than a few MB, every file is one row instead, and nothing is shuffled.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from runatlas.operators.keyed import is_small
from runatlas.session import materialize, workspace

BROADCAST_BLOCKS = 200_000  # blocks (a counted bound: some 20 MB) whose states are broadcast; more are joined by shuffle
_BLOCK = ("_file", "_block")
WHOLE_BYTES = 8 << 20  # text of a file that is parsed as one row, at most, and no more than a split
PACKED_BYTES = WHOLE_BYTES // 16  # of a compressed file whose text is measured to find that out
_PACKED = r"(?i)\.(gz|gzip|bz2|deflate|lz4|snappy|zst|zstd)$"


def _depth_change(text: Column) -> Column:
    """Brackets opened less those closed in a text without escapes that begins outside a string."""
    outside = F.regexp_replace(text, r'"[^"]*("|$)', "")
    return F.length(F.translate(outside, "]}", "")) - F.length(F.translate(outside, "[{", ""))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Every piece between commas with its place, and its state before and after relative to the block's begin.

    ``before``: in a string, if the block begins outside one; ``depth0`` and ``depth1``: the depth
    after the piece, less that at the block's begin, if the block begins outside or inside a string.
    """
    text = spark.read.option("lineSep", ",").text(path)
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    rows = text.select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("id"),
        (F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))).cast("long").alias("quotes"),
        _depth_change(plain).alias("outside"),
        _depth_change(F.concat(F.lit('"'), plain)).alias("inside"),
    )
    so_far = Window.partitionBy(*_BLOCK).orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    ordered = Window.partitionBy(*_BLOCK).orderBy("id")
    rows = rows.withColumns({"before": F.pmod(F.sum("quotes").over(so_far) - F.col("quotes"), F.lit(2)), "n": F.row_number().over(ordered)})
    in_string = F.col("before") == 1
    return rows.withColumns(
        {
            "depth0": F.sum(F.when(in_string, F.col("inside")).otherwise(F.col("outside"))).over(so_far),
            "depth1": F.sum(F.when(in_string, F.col("outside")).otherwise(F.col("inside"))).over(so_far),
        }
    )


def _after(begins: Column) -> Column:
    """Whether a string is open after the piece, from whether one is at the block's begin."""
    return F.pmod(F.col("before") + F.col("quotes") + begins, F.lit(2))


def _blocks(pieces: DataFrame) -> DataFrame:
    """One row a block: its true state at the begin, the number of its first element, and facts of its file."""
    # A comma outside strings, by the depth it would have: both cases are counted, the true one is picked below.
    cases = F.explode(F.array(*[F.struct(F.lit(c).alias("case"), F.col(f"depth{c}").alias("depth"), (_after(F.lit(c)) == 0).alias("free")) for c in (0, 1)]))
    commas = pieces.select(*_BLOCK, cases.alias("c")).filter("c.free").groupBy(*_BLOCK, "c.case", "c.depth").agg(F.count(F.lit(1)).alias("commas"))
    opens = F.max(F.when(F.col("n") == 1, F.col("value").rlike(r"^[\s\x{FEFF}]*\[")))
    blocks = pieces.groupBy(*_BLOCK).agg(
        F.pmod(F.sum("quotes"), F.lit(2)).alias("flips"),
        F.max_by("depth0", "n").alias("deeper0"),
        F.max_by("depth1", "n").alias("deeper1"),
        F.max("n").alias("size"),
        opens.alias("opens"),
        F.max_by(F.col("value").rlike(r"\]\s*$"), "n").alias("closes"),
    )
    whole = Window.partitionBy("_file")
    earlier = whole.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("case", F.pmod(F.coalesce(F.sum("flips").over(earlier), F.lit(0)), F.lit(2)))
    deeper = F.when(F.col("case") == 0, F.col("deeper0")).otherwise(F.col("deeper1"))
    blocks = blocks.withColumns(
        {
            "deeper": deeper,
            "depth_at": F.coalesce(F.sum(deeper).over(earlier), F.lit(0)),
            "last_block": F.max("_block").over(whole),
            "odd": F.pmod(F.sum("flips").over(whole), F.lit(2)),
            "depth_end": F.sum(deeper).over(whole),
        }
    )
    seen = blocks.join(commas, [*_BLOCK, "case"], "left")
    depth = F.col("depth_at") + F.col("depth")
    seen = seen.groupBy(*[c for c in blocks.columns]).agg(
        F.coalesce(F.sum(F.when(depth == 1, F.col("commas"))), F.lit(0)).alias("ends"),
        F.coalesce(F.sum(F.when(depth < 1, F.col("commas"))), F.lit(0)).alias("outside"),
    )
    is_last = F.col("_block") == F.col("last_block")
    # The end of the file is no comma, but lies at depth zero like one that is out of place.
    fine = F.when(F.col("_block") == 0, F.col("opens")).otherwise(True) & F.when(is_last, F.col("closes")).otherwise(True)
    fine = fine & (F.col("odd") == 0) & (F.col("depth_end") == 0) & (F.col("outside") == is_last.cast("int"))
    return seen.select(
        *_BLOCK,
        "case",
        "depth_at",
        F.coalesce(F.sum("ends").over(earlier), F.lit(0)).alias("first"),
        F.sum("ends").over(whole).alias("commas"),
        (is_last & (F.col("size") > 0)).alias("is_last"),
        "size",
        F.min(fine).over(whole).alias("is_list"),
    )


def _all_small(spark: SparkSession, path: str) -> bool:
    """Whether no file's text is larger than ``WHOLE_BYTES`` or than a split."""
    most = min(WHOLE_BYTES, spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    files = spark.read.format("binaryFile").load(path).select(F.col("path").rlike(_PACKED).alias("packed"), "length")
    plain, packed = files.agg(F.max(F.when(~F.col("packed"), F.col("length"))), F.max(F.when(F.col("packed"), F.col("length")))).first()
    if (plain or 0) > most or (packed or 0) > min(PACKED_BYTES, most):
        return False
    if packed is None:
        return True
    return (spark.read.text(path, wholetext=True).agg(F.max(F.octet_length("value"))).first()[0] or 0) <= most


def _whole_lists(spark: SparkSession, path: str) -> DataFrame:
    """``list_elements`` for small files: one row each, without a shuffle."""
    rows = spark.read.text(path, wholetext=True).filter(F.col("value") != "")
    text = F.regexp_replace("value", r"^[\s\x{FEFF}]+", "")
    # The parser stops after the first value. What may follow it differs inside a list and inside an object, but for a comma.
    listed = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    parsed = rows.select(F.col("_metadata.file_path").alias("_file"), listed.alias("listed"), text.alias("value"))
    lone = F.try_parse_json(F.concat(F.lit('{"l":'), F.col("value"), F.lit("}"))).isNotNull() & F.col("value").startswith("[")
    found = F.when(lone & (F.size("listed") == 1), F.try_variant_get(F.get("listed", F.lit(0)), "$", "array<variant>"))
    broken = F.raise_error(F.concat(F.lit("expected a JSON list at the top of "), "_file"))
    checked = parsed.select("_file", found.alias("found")).select("_file", F.when(F.col("found").isNotNull(), F.col("found")).otherwise(broken).alias("found"))
    # For an inner generator Spark puts a filter on its input below the parsing, and parses each file several times more.
    elements = checked.select("_file", F.posexplode_outer("found").alias("pos", "v")).filter(F.col("pos").isNotNull())
    return elements.withColumn("pos", F.col("pos").cast("long"))


def list_elements(spark: SparkSession, path: str) -> DataFrame:
    """``_file``, ``pos`` and ``v`` (a variant) of every element of the list files under ``path``.

    A file that does not hold one JSON list is an error. What one task holds is a block, an element, or a small file.
    """
    if _all_small(spark, path):
        return _whole_lists(spark, path)
    pieces = _pieces(spark, path)
    blocks = materialize(_blocks(pieces), f"{workspace(spark)}/list-blocks-{uuid.uuid4().hex[:12]}")
    side = F.broadcast(blocks) if is_small(blocks, BROADCAST_BLOCKS) else blocks
    rows = pieces.join(side, list(_BLOCK))
    depth = F.col("depth_at") + F.when(F.col("case") == 0, F.col("depth0")).otherwise(F.col("depth1"))
    is_end = F.col("is_last") & (F.col("n") == F.col("size"))
    ends = ((_after(F.col("case")) == 0) & (depth == 1) & ~is_end).cast("long")
    earlier = Window.partitionBy(*_BLOCK).orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("ends", ends).withColumn("pos", F.col("first") + F.coalesce(F.sum("ends").over(earlier), F.lit(0)))
    text = F.when((F.col("_block") == 0) & (F.col("n") == 1), F.regexp_replace("value", r"^[\s\x{FEFF}]*\[", "")).otherwise(F.col("value"))
    text = F.when(is_end, F.regexp_replace(text, r"\]\s*$", "")).otherwise(text)
    listed = F.when(F.col("is_list"), text).otherwise(F.raise_error(F.concat(F.lit("expected a JSON list at the top of "), "_file")))
    joined = (
        rows.select("_file", "pos", "commas", F.struct("_block", "n", listed.alias("text")).alias("piece"))
        .groupBy("_file", "pos", "commas")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list("piece")), lambda p: p["text"]), ",").alias("text"))
    )
    kept = joined.filter((F.col("commas") > 0) | (F.trim(F.translate("text", "\n\r\t", "   ")) != ""))  # no element in []
    parsed = kept.withColumn("v", F.try_parse_json("text"))
    broken = F.raise_error(F.concat(F.lit("expected a JSON list at the top of "), "_file", F.lit(": bad element "), F.col("pos").cast("string")))
    return parsed.select("_file", "pos", F.when(F.col("v").isNotNull(), F.col("v")).otherwise(broken).alias("v"))
