"""Lax conversion of raw values: text that reads as the wanted type is accepted.

The expressions are SQL text: validation builds several per field, and text
costs one call to the JVM each.
"""

from __future__ import annotations

from pyspark.sql import types as T

_NUMBER = r"^\\s*[+-]?(\\d+\\.?\\d*([eE][+-]?\\d+)?|\\.\\d+([eE][+-]?\\d+)?|[iI]nf(inity)?|[nN]a[nN])\\s*$"
_DATED = r"^\\s*\\d{4}-\\d{2}-\\d{2}"
_PLAIN_NUMBER = r"^\\s*[+-]?\\d+(\\.\\d+)?\\s*$"


def to_double(raw: str, dtype: T.DataType) -> str:
    """A double, or null where the raw value does not read as one."""
    if isinstance(dtype, T.StringType):
        return f"CASE WHEN {raw} RLIKE '{_NUMBER}' THEN try_cast(trim({raw}) AS DOUBLE) END"
    return f"cast({raw} AS DOUBLE)"


def to_int(raw: str, dtype: T.DataType) -> str:
    """An int; ``32`` and ``32.0`` pass, ``32.5`` does not."""
    if isinstance(dtype, T.IntegerType):
        return raw
    value = to_double(raw, dtype)
    return f"CASE WHEN {value} = floor({value}) THEN try_cast({value} AS INT) END"


def to_timestamp(raw: str, dtype: T.DataType) -> str:
    """A timestamp from ISO-8601 text with its full date, or from a unix time in seconds or milliseconds."""
    if not isinstance(dtype, T.StringType):
        return f"cast({raw} AS TIMESTAMP)"
    number = f"try_cast(trim({raw}) AS DOUBLE)"
    micros = f"{number} * if(abs({number}) > 2e10, 1e3, 1e6)"
    return (
        f"CASE WHEN {raw} RLIKE '{_PLAIN_NUMBER}' THEN timestamp_micros(try_cast({micros} AS BIGINT)) "
        f"WHEN {raw} RLIKE '{_DATED}' THEN try_cast({raw} AS TIMESTAMP) END"
    )


def coerce(raw: str, dtype: T.DataType, target: T.DataType) -> str:
    """SQL text for ``raw`` (of Spark type ``dtype``) as ``target``; null where it does not fit."""
    if isinstance(target, T.DoubleType):
        return to_double(raw, dtype)
    if isinstance(target, T.IntegerType):
        return to_int(raw, dtype)
    if isinstance(target, T.TimestampType):
        return to_timestamp(raw, dtype)
    return f"cast({raw} AS STRING)"
