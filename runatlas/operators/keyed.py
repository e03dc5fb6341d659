"""First rows per key, insert-if-absent and checked broadcasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

SALTS = 256


def first_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of every key in the given order.

    For one row, Spark cuts each key inside every map task before it shuffles. For more, a salted round
    comes first: each of its tasks cuts a part of a key to ``n`` rows, so the last
    one takes ``SALTS * n`` rows of a key however many map tasks there were.
    """
    rank = F.row_number()
    if n > 1:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order_inputs(df)), F.lit(SALTS)))
        within = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = salted.withColumn("_rn", rank.over(within)).filter(F.col("_rn") <= n).drop("_rn", "_salt")
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", rank.over(window)).filter(F.col("_rn") <= n).drop("_rn")


def order_inputs(df: DataFrame) -> list[Column]:
    """All hashable columns of ``df``, to spread rows over salts."""
    return [F.col(f"`{name}`") for name, kind in df.dtypes if kind not in ("variant",) and "map" not in kind]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in the given order."""
    return first_n_per_key(df, keys, order, 1)


def is_small(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; reads no further than that."""
    return df.limit(max_rows + 1).count() <= max_rows


def missing_from(incoming: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` whose key ``existing`` does not hold."""
    return incoming.join(existing.select(*keys), list(keys), "left_anti")
