"""Reports on the log of a scoring service."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsift.operators.order_stats import quantiles
from quillsift.session import cut

CELL = ["users", "batch_size"]
POINTS = {"median_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}
#: A sketched percentile's rank is off by at most 1 / ACCURACY of the rows.
ACCURACY = 10_000


def request_summary(log: DataFrame) -> DataFrame:
    """Per (users, batch_size): requests, failures, requests per second, response percentiles."""
    counts = cut(
        log.groupBy(*CELL, "response_ms").agg(
            F.count("*").alias("n"), F.sum("failed").alias("failed"), F.min("ts").alias("first"), F.max("ts").alias("last")
        )
    )
    span = (F.unix_micros(F.max("last").cast("timestamp")) - F.unix_micros(F.min("first").cast("timestamp"))) / 1e6
    totals = counts.groupBy(*CELL).agg(
        F.sum("n").alias("requests"),
        F.sum("failed").cast("bigint").alias("failures"),
        F.try_divide(F.sum("n").cast("double"), span).alias("rps"),
    )
    points = quantiles(counts.select(*CELL, "response_ms", "n"), CELL, "response_ms", "n", [0.5, 0.95, 0.99])
    return totals.join(points, CELL).select(
        *CELL,
        "requests",
        "failures",
        "rps",
        F.col("quantiles")[0].alias("median_ms"),
        F.col("quantiles")[1].alias("p95_ms"),
        F.col("quantiles")[2].alias("p99_ms"),
    )


def request_pivot(summary: DataFrame, users: list[int]) -> DataFrame:
    """Requests per second, one row per batch size and one column per number of users."""
    table = summary.groupBy("batch_size").pivot("users", users).agg(F.first("rps"))
    return table.select("batch_size", *[F.col(f"`{u}`").alias(f"u{u}") for u in users])


def request_peak(summary: DataFrame) -> DataFrame:
    """The cell with the highest throughput."""
    return summary.select("batch_size", "users", "rps").orderBy(F.desc("rps"), "batch_size", "users").limit(1)


def sweep_grid(summary: DataFrame, users: list[int], batch_sizes: list[int]) -> DataFrame:
    """Every planned point of a sweep with its number of requests, 0 where it is missing.

    The plan is the product of two short lists, made by two explodes of one row.
    """
    spark = summary.sparkSession
    plan = (
        spark.range(1)
        .select(F.explode(F.array(*map(F.lit, users))).alias("users"))
        .select("users", F.explode(F.array(*map(F.lit, batch_sizes))).alias("batch_size"))
    )
    measured = summary.select(*CELL, "requests")
    return plan.join(measured, CELL, "left").select(
        *CELL,
        F.col("requests").isNotNull().alias("measured"),
        F.coalesce("requests", F.lit(0)).alias("requests"),
    )


def request_windows(log: DataFrame, length: str = "1 day") -> DataFrame:
    """Requests, failures and response times per time window; the same plan serves a stream."""
    return log.groupBy(F.window("ts", length).alias("window")).agg(
        F.count("*").alias("requests"),
        F.sum("failed").cast("bigint").alias("failures"),
        F.avg("response_ms").alias("mean_ms"),
        F.max("response_ms").alias("max_ms"),
    ).select(F.col("window.start").alias("start"), "requests", "failures", "mean_ms", "max_ms")


def _with_rates(windows: DataFrame) -> DataFrame:
    """Requests and failures per second of the window's whole length."""
    seconds = (F.unix_micros(F.col("window.end").cast("timestamp")) - F.unix_micros(F.col("window.start").cast("timestamp"))) / 1e6
    return windows.withColumns({"rps": F.col("requests") / seconds, "failures_per_s": F.col("failures") / seconds})


def request_percentile_windows(log: DataFrame, length: str = "1 day") -> DataFrame:
    """Requests, failures, both per second, and exact response percentiles per time window.

    Response times are counted per window first and the percentiles taken from slices, so a window that holds most
    of the log is no single task's work. Requests without a time are in no window; a window without
    any response time has null percentiles.
    """
    timed = log.select(F.window("ts", length).alias("window"), "response_ms", "failed")
    counts = cut(timed.groupBy("window", "response_ms").agg(F.count("*").alias("n"), F.sum("failed").alias("failed")))
    totals = counts.groupBy("window").agg(F.sum("n").alias("requests"), F.sum("failed").cast("bigint").alias("failures"))
    points = quantiles(counts.where("response_ms is not null").select("window", "response_ms", "n"), ["window"], "response_ms", "n", list(POINTS.values()))
    return _with_rates(totals.join(points, ["window"], "left")).select(
        F.col("window.start").alias("start"), "requests", "failures", "rps", "failures_per_s",
        *[F.col("quantiles")[i].alias(name) for i, name in enumerate(POINTS)],
    )


def sketched_percentile_windows(log: DataFrame, length: str = "1 day") -> DataFrame:
    """The same on a stream: the state of a window is one mergeable sketch, and percentiles are values that occurred."""
    sketch = F.percentile_approx("response_ms", list(POINTS.values()), ACCURACY).alias("points")
    windows = log.groupBy(F.window("ts", length).alias("window")).agg(
        F.count("*").alias("requests"), F.sum("failed").cast("bigint").alias("failures"), sketch
    )
    return _with_rates(windows).select(
        F.col("window.start").alias("start"), "requests", "failures", "rps", "failures_per_s",
        *[F.col("points")[i].alias(name) for i, name in enumerate(POINTS)],
    )


def percentiles_within(sketched: DataFrame, log: DataFrame, length: str = "1 day", slack: float = 1 / ACCURACY) -> DataFrame:
    """(start, one flag per percentile): does its value hold a rank within ``slack`` of the rows, or one rank, of the exact one?"""
    timed = log.select(F.window("ts", length)["start"].alias("start"), "response_ms").where("response_ms is not null")
    counted = timed.groupBy("start", "response_ms").agg(F.count("*").alias("n"))
    both = counted.join(sketched.select("start", *POINTS), "start")
    sums = both.groupBy("start").agg(
        F.sum("n").alias("rows"),
        *[F.sum(F.when(F.col("response_ms") < F.col(p), F.col("n")).otherwise(0)).alias(f"below_{p}") for p in POINTS],
        *[F.sum(F.when(F.col("response_ms") <= F.col(p), F.col("n")).otherwise(0)).alias(f"upto_{p}") for p in POINTS],
    )

    def near(name: str, share: float) -> Column:
        room = F.col("rows") * slack + 1
        return (F.col(f"below_{name}") <= share * F.col("rows") + room) & (F.col(f"upto_{name}") >= share * F.col("rows") - room)

    return sums.select("start", *[near(name, share).alias(name) for name, share in POINTS.items()])
