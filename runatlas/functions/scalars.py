"""Scalar column expressions used by several operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row.

    Without this, Spark may copy the value's expression into a lambda and
    compute it again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _finite(value: Column, body: Callable[[Column], Column]) -> Column:
    number = value.cast("double")
    return F.when(F.abs(number) < 1e25, body(value.cast("decimal(38,12)")).cast("double")).otherwise(number)


def half_up(value: Column, digits: int) -> Column:
    """Round half away from zero on the decimal value, not on its binary form.

    The value is first brought to 12 decimals, which removes the noise that
    the order of a distributed sum leaves in the last bits. Values that no
    decimal holds (infinite, NaN, 1e25 and more) stay as they are.
    """
    return _finite(value, lambda v: F.round(v, digits))


def settled(value: Column) -> Column:
    """The value at 12 decimals: equal averages compare as equal."""
    return _finite(value, lambda v: v)


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent; null when ``whole`` is zero."""
    return half_up(part.cast("double") / F.nullif(whole, F.lit(0)) * 100, 2)


def date_key(ts: Column) -> Column:
    """Calendar key ``YYYYMMDD`` as an integer."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def learning_rate_bucket(rate: Column) -> Column:
    """Name of the decade a learning rate falls in."""
    return (
        F.when(rate < 0.0001, "< 1e-4")
        .when(rate < 0.001, "1e-4 to 1e-3")
        .when(rate < 0.01, "1e-3 to 1e-2")
        .when(rate < 0.1, "1e-2 to 1e-1")
        .otherwise(">= 1e-1")
    )


def f1(precision: Column, recall: Column) -> Column:
    """Harmonic mean of precision and recall at 4 decimals."""
    return half_up(2 * precision * recall / (precision + recall + F.lit(1e-9)), 4)


def energy_kwh(training_time_sec: Column, power_watts: Column) -> Column:
    """Energy drawn at constant power."""
    return power_watts / 1000.0 * (training_time_sec / 3600.0)


def expected_training_sec(epochs: Column, batch_size: Column, speed_factor: Column) -> Column:
    """Training time that the run's size and its GPU would suggest."""
    return epochs * 45.0 * (F.lit(64.0) / batch_size) / speed_factor


def expected_accuracy(base: Column, epochs: Column, learning_rate: Column) -> Column:
    """Accuracy on a diminishing-returns curve, less a penalty for a high rate."""
    curve = 1 - 1 / (1 + epochs / 20.0)
    penalty = F.when(
        learning_rate > 0.02, F.least(F.lit(0.15), (learning_rate - 0.02) * 2.0)
    ).otherwise(0.0)
    return F.least(F.greatest(base * curve - penalty, F.lit(0.4)), F.lit(0.995))


def parameters_to_mb(parameters: Column) -> Column:
    """Size of float32 parameters in MiB."""
    return parameters * 4 / (1024.0 * 1024.0)


def order_bucket(value: Column) -> Column:
    """A whole number that never falls as ``value`` grows.

    Steps are about 0.4 % wide, so all doubles fit in under 400,000 buckets
    and ordinary measurements in a few thousand.
    """
    size = F.log1p(F.least(F.abs(value), F.lit(1e300)) * 1e6)
    return F.floor(F.signum(value) * size * 256).cast("int")
