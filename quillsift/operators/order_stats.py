"""Exact order statistics that never sort one group in one task.

Values are first counted, so equal values collapse before the shuffle. Each
group is then cut into slices of neighbouring values. Totals per slice are
small; their running sum tells where a slice starts, and only inside a slice is
a window needed. The number of slices follows the number of counted rows, their
borders come from an approximate sketch: both steer the balance of the work and
never the result. Counts are read several times, so the
callers pass them through ``session.cut`` first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsift.session import small_side

LEAST_SLICES, MOST_SLICES = 16, 4096
ROWS_PER_SLICE = 100_000
SKETCH_ACCURACY = 10_000
SMALL_ROWS = 100_000
HASH_PREFIX = 4


def _before(total: str, window) -> Column:
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(total).over(earlier), F.lit(0))


def sliced(counts: DataFrame, group: list[str], value: str, slices: int | None = None) -> DataFrame:
    """Add ``slice``, an order-preserving bucket of the values within each group."""
    slices = slices or min(MOST_SLICES, max(LEAST_SLICES, counts.count() // ROWS_PER_SLICE))
    shares = [i / slices for i in range(1, slices)]
    borders = counts.groupBy(*group).agg(
        F.percentile_approx(value, shares, SKETCH_ACCURACY).alias("borders")
    )
    below = F.coalesce(F.size(F.filter("borders", lambda border: border < F.col(value))), F.lit(0))
    return counts.join(small_side(borders, SMALL_ROWS), group).withColumn("slice", below).drop("borders")


def running_totals(
    counts: DataFrame,
    group: list[str],
    value: str,
    totals: list[str],
    carry: list[str] | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Add ``before_<t>`` for each t in ``totals``: its sum over the group's smaller values.

    ``counts`` holds one row per (group, value); columns in ``carry`` pass through.
    """
    marked = sliced(counts, group, value, slices)
    order = Window.partitionBy(*group).orderBy("slice")
    starts = (
        marked.groupBy(*group, "slice")
        .agg(*[F.sum(t).alias(f"slice_{t}") for t in totals])
        .select(*group, "slice", *[_before(f"slice_{t}", order).alias(f"start_{t}") for t in totals])
    )
    inside = Window.partitionBy(*group, "slice").orderBy(value)
    return (
        marked.join(starts, [*group, "slice"])
        .select(
            *group,
            value,
            *totals,
            *(carry or []),
            *[(F.col(f"start_{t}") + _before(t, inside)).alias(f"before_{t}") for t in totals],
        )
    )


def quantiles(
    counts: DataFrame, group: list[str], value: str, n: str, probs: list[float], slices: int | None = None
) -> DataFrame:
    """(group, rows, quantiles): exact quantiles with linear interpolation.

    ``counts`` holds one row per (group, value) with its frequency ``n``. Only
    slices that hold a wanted rank are looked into.
    """
    def place(p: float) -> Column:
        return F.lit(p) * (F.col("rows") - 1)

    def holds(p: float, start: str, size: str) -> Column:
        def hit(rank: Column) -> Column:
            return (rank >= F.col(start)) & (rank < F.col(start) + F.col(size))

        return hit(F.floor(place(p))) | hit(F.ceil(place(p)))

    marked = sliced(counts, group, value, slices)
    everything = Window.partitionBy(*group)
    sizes = (
        marked.groupBy(*group, "slice")
        .agg(F.sum(n).alias("size"))
        .withColumn("rows", F.sum("size").over(everything))
        .withColumn("start", _before("size", everything.orderBy("slice")))
    )
    wanted = F.lit(False)
    for p in probs:
        wanted = wanted | holds(p, "start", "size")
    inside = Window.partitionBy(*group, "slice").orderBy(value)
    ranked = (
        marked.join(sizes.where(wanted), [*group, "slice"])
        .withColumn("first_rank", F.col("start") + _before(n, inside))
    )

    def at(rank: Column) -> Column:
        here = (rank >= F.col("first_rank")) & (rank < F.col("first_rank") + F.col(n))
        return F.max(F.when(here, F.col(value)))

    ends = ranked.groupBy(*group).agg(
        F.max("rows").alias("rows"),
        *[at(F.floor(place(p))).alias(f"low{i}") for i, p in enumerate(probs)],
        *[at(F.ceil(place(p))).alias(f"high{i}") for i, p in enumerate(probs)],
    )
    points = [
        F.col(f"low{i}")
        + (F.col(f"high{i}") - F.col(f"low{i}")) * (place(p) - F.floor(place(p)))
        for i, p in enumerate(probs)
    ]
    return ends.select(*group, "rows", F.array(*points).alias("quantiles"))


def hash_cutoffs(rows: DataFrame, stratum: str, key: str, wanted: DataFrame) -> DataFrame:
    """(stratum, cut_no, cutoff): the ``rank``-th smallest hash of each stratum.

    ``rows`` has one hex hash per row in ``key``; ``wanted`` is (stratum, cut_no,
    rank). A histogram over the first hex digits finds the one bucket that holds
    a rank, and only that bucket is sorted. With the cutoffs a split is a
    comparison per row: no message moves.
    """
    keyed = rows.select(stratum, key, F.substring(key, 1, HASH_PREFIX).alias("bucket"))
    order = Window.partitionBy(stratum).orderBy("bucket")
    histogram = (
        keyed.groupBy(stratum, "bucket")
        .agg(F.count("*").alias("size"))
        .withColumn("start", _before("size", order))
    )
    targets = (
        histogram.join(wanted, stratum)
        .where((F.col("start") < F.col("rank")) & (F.col("rank") <= F.col("start") + F.col("size")))
        .select(stratum, "bucket", "cut_no", (F.col("rank") - F.col("start")).alias("inner_rank"))
    )
    inside = Window.partitionBy(stratum, "bucket", "cut_no").orderBy(key)
    return (
        keyed.join(small_side(targets, SMALL_ROWS), [stratum, "bucket"])
        .withColumn("place", F.row_number().over(inside))
        .where(F.col("place") == F.col("inner_rank"))
        .select(stratum, "cut_no", F.col(key).alias("cutoff"))
    )
