"""Population-stability drift between the earliest and the latest predictions of a model."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runatlas.functions.scalars import half_up, let
from runatlas.operators.keyed import first_n_per_key, is_small
from runatlas.operators.quantiles import (
    interpolate,
    neighbours,
    values_at_ranks,
)

MODEL = ("model_name", "model_version")
BROADCAST_KEYS = 20_000  # keys whose edges are broadcast

# Fixed values.
WINDOW = 200
THRESHOLD = 0.25
MAX_BINS = 10
ROWS_PER_BIN = 20
EPSILON = 1e-6


def bin_count(n: Column) -> Column:
    """Number of bins for a baseline of ``n`` values: about 20 values per bin."""
    return F.greatest(F.lit(2), F.least(F.lit(MAX_BINS), F.floor(n / ROWS_PER_BIN))).cast("int")


def usable(edges: Column) -> Column:
    """Fewer than three edges make no two bins."""
    return F.size(edges) >= 3


def bin_of(value: Column, edges: Column) -> Column:
    """1-based bin of a value: half-open bins, the last closed, null outside."""
    inside = (value >= F.element_at(edges, 1)) & (value <= F.element_at(edges, -1))
    place = F.size(F.filter(edges, lambda e: e <= value))
    return F.when(inside, F.least(place, F.size(edges) - 1))


def stability_term(base_count: Column, base_n: Column, late_count: Column, late_n: Column) -> Column:
    """One bin's part of the index. Values outside all bins still count in the sizes."""
    base = base_count / base_n + EPSILON
    late = late_count / late_n + EPSILON
    return (late - base) * F.ln(late / base)


# --- windows: a bounded number of values per model, held as one array ---------


def model_windows(events: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per model: ``event_count``, its earliest ``baseline`` and latest ``recent`` values.

    Each array has at most ``window`` values and each key is cut to that many
    rows before the shuffle. The three branches are partitioned by model alike,
    so neither the gathering nor the joins shuffle again. The two windows
    overlap where a model has fewer than twice ``window`` events.
    """
    slim = events.select(*MODEL, "event_timestamp", "stream_entry_id", "prediction")
    first = first_n_per_key(
        slim, MODEL, [F.asc("event_timestamp"), F.asc("stream_entry_id")], window
    )
    last = first_n_per_key(
        slim, MODEL, [F.desc("event_timestamp"), F.desc("stream_entry_id")], window
    )
    counts = events.groupBy(*MODEL).agg(F.count(F.lit(1)).alias("event_count"))
    baseline = first.groupBy(*MODEL).agg(F.collect_list("prediction").alias("baseline"))
    recent = last.groupBy(*MODEL).agg(F.collect_list("prediction").alias("recent"))
    return counts.join(baseline, list(MODEL)).join(recent, list(MODEL))


def grid(n: Column, place_to: Callable[[Column], Column]) -> Column:
    """One element per bin edge of ``n`` values, from the edge's place among them."""
    bins = bin_count(n)

    def element(i: Column) -> Column:
        share = F.when(i == bins, 1.0).otherwise(i * (F.lit(1.0) / bins))
        return place_to((n - 1) * share)

    return F.transform(F.sequence(F.lit(0), bins), element)


def distinct_edges(edges: Column) -> Column:
    return F.array_sort(F.array_distinct(edges))


def array_edges(sample: Column) -> Column:
    """Distinct bin edges: evenly spaced quantiles of the array; null if it is empty."""

    def quantiles(ordered: Column) -> Column:
        def at(place: Column) -> Column:
            low = F.element_at(ordered, F.floor(place).cast("int") + 1)
            high = F.element_at(ordered, F.ceil(place).cast("int") + 1)
            return low + (high - low) * (place - F.floor(place))

        return grid(F.size(ordered), at)

    edges = distinct_edges(let(F.array_sort(sample), quantiles))
    return F.when(F.size(sample) > 0, edges)


def histogram(baseline: Column, recent: Column) -> Column:
    """Per bin its bounds and the counts of both arrays, empty bins too; null without two bins."""

    def count(bins: Column, i: Column) -> Column:
        return F.size(F.filter(bins, lambda b: b == i)).cast("long")

    def cells(edges: Column) -> Column:
        placed = F.struct(
            F.transform(baseline, lambda v: bin_of(v, edges)).alias("baseline"),
            F.transform(recent, lambda v: bin_of(v, edges)).alias("recent"),
        )

        def table(bins: Column) -> Column:
            return F.transform(
                F.sequence(F.lit(1), F.size(edges) - 1),
                lambda i: F.struct(
                    i.cast("long").alias("bin"),
                    F.element_at(edges, i).alias("low"),
                    F.element_at(edges, i + 1).alias("high"),
                    count(bins["baseline"], i).alias("baseline_count"),
                    count(bins["recent"], i).alias("recent_count"),
                ),
            )

        return F.when(usable(edges), let(placed, table))

    return let(array_edges(baseline), cells)


def with_psi(windows: DataFrame) -> DataFrame:
    """Adds the unrounded ``psi``: 0.0 where a window is empty or the baseline is constant."""
    base_n, late_n = F.size("baseline"), F.size("recent")

    def score(cells: Column) -> Column:
        total = F.aggregate(
            cells,
            F.lit(0.0),
            lambda t, c: t + stability_term(c["baseline_count"], base_n, c["recent_count"], late_n),
        )
        return F.when(cells.isNotNull() & (base_n > 0) & (late_n > 0), total).otherwise(0.0)

    cells = histogram(F.col("baseline"), F.col("recent"))
    return windows.withColumn("psi", let(cells, score))


def edge_rows(windows: DataFrame) -> DataFrame:
    """One row per bin edge."""
    return windows.select(
        *MODEL, F.posexplode(array_edges(F.col("baseline"))).alias("edge_index", "edge")
    ).withColumn("edge_index", F.col("edge_index").cast("long"))


def histogram_rows(windows: DataFrame) -> DataFrame:
    """One row per bin, with the sizes of both windows."""
    return windows.select(
        *MODEL,
        F.size("baseline").cast("long").alias("baseline_n"),
        F.size("recent").cast("long").alias("recent_n"),
        F.inline(histogram(F.col("baseline"), F.col("recent"))),
    )


def check_drift(
    events: DataFrame, window: int = WINDOW, threshold: float = THRESHOLD
) -> DataFrame:
    """Drift result of every model that has at least one full window."""
    eligible = model_windows(events, window).filter(F.col("event_count") >= window)
    return with_psi(eligible).select(
        *MODEL,
        half_up(F.col("psi"), 4).alias("psi"),
        (F.col("psi") > threshold).alias("is_drifted"),
        F.size("baseline").cast("long").alias("baseline_n"),
        F.size("recent").cast("long").alias("recent_n"),
    )


def drift_status(
    events: DataFrame, window: int = WINDOW, threshold: float = THRESHOLD
) -> DataFrame:
    """Every model: its drift once it has two full windows, else what it still needs."""
    enough = F.col("event_count") >= 2 * window
    psi = half_up(F.col("psi"), 4)
    return with_psi(model_windows(events, window)).select(
        *MODEL,
        "event_count",
        F.lit(2 * window).cast("long").alias("events_needed"),
        enough.alias("has_enough_data"),
        F.when(enough, psi).alias("psi"),
        F.when(enough, F.size("baseline").cast("long")).alias("baseline_n"),
        F.when(enough, F.size("recent").cast("long")).alias("recent_n"),
        F.when(enough, F.when(psi > threshold, "drift detected").otherwise("stable")).alias("label"),
    )


# --- samples of any size: long rows, counted per bin ---------------------------


def sample_edges(sample: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Bin edges per key for a sample of any size."""
    n = F.col("_count")
    ranks = F.array_distinct(F.flatten(grid(n, neighbours)))
    picked = values_at_ranks(sample, keys, value, ranks)
    edges = grid(n, lambda place: interpolate(F.col("_by_rank"), place))
    return picked.select(*keys, distinct_edges(edges).alias("edges"))


def sample_psi(
    baseline: DataFrame, recent: DataFrame, keys: Sequence[str], value: str = "prediction"
) -> DataFrame:
    """Stability index per key of two samples of any size.

    Keys of either sample get a row; 0.0 stands where the index has no meaning.
    """
    keys = list(keys)
    edges = sample_edges(baseline, keys, value)
    if is_small(baseline.select(*keys).distinct(), BROADCAST_KEYS):
        edges = F.broadcast(edges)
    both = baseline.select(*keys, F.col(value).alias("_v"), F.lit(1).alias("_base")).unionByName(
        recent.select(*keys, F.col(value).alias("_v"), F.lit(0).alias("_base"))
    )
    counted = (
        both.join(edges, keys, "left")
        .groupBy(*keys, bin_of(F.col("_v"), F.col("edges")).alias("bin"), F.size("edges").alias("_edges"))
        .agg(F.sum("_base").alias("base"), F.sum(1 - F.col("_base")).alias("late"))
    )
    # At most eleven rows per key are left.
    cells = counted.groupBy(*keys, "_edges").agg(
        F.sum("base").alias("base_n"),
        F.sum("late").alias("late_n"),
        F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("base", "late"))).alias("cells"),
    )

    def add(total: Column, c: Column) -> Column:
        return total + stability_term(c["base"], F.col("base_n"), c["late"], F.col("late_n"))

    filled = F.aggregate("cells", F.lit(0.0), add)
    # A bin that neither sample reached has equal shares and adds nothing.
    measurable = F.coalesce(F.col("_edges") >= 3, F.lit(False)) & (F.col("base_n") > 0) & (F.col("late_n") > 0)
    return cells.select(*keys, F.when(measurable, filled).otherwise(0.0).alias("psi"))
