"""Rolling figures of heat from mergeable sketches: one for each platform and day, merged over the days of a window.

Rows are read once and shuffled as sketches, a few kilobytes each; a window of any length merges stored sketches and never
reads rows again. `relational.heat_percentiles` is the exact form, for one batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def daily(rows: DataFrame, by: list[str], time: str, heat: str, who: str, k: int = 400, lg: int = 12) -> DataFrame:
    """(by, day, n, heat_sketch, who_sketch): a KLL sketch of heat as a double and an HLL sketch of who, a row a key and day.

    Null heats and null names count in neither sketch; a row without a time has no day and is left out. A day without a heat
    has a null sketch.
    """
    d = rows.where(F.col(time).isNotNull())
    kept = F.when(F.count(heat) > 0, F.kll_sketch_agg_double(F.col(heat).cast("double"), k))
    return d.groupBy(*by, F.to_date(time).alias("day")).agg(F.count("*").alias("n"), kept.alias("heat_sketch"), F.hll_sketch_agg(F.col(who).cast("string"), lg).alias("who_sketch"))


def rolling(days: DataFrame, by: list[str], length: int) -> DataFrame:
    """(by, day, n, heat_sketch, who_sketch) over each day and the length - 1 before it; days that have rows only.

    Each day's row goes to the windows that hold it: `length` small rows, and no range join.
    """
    later = F.explode(F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda k: F.date_add("day", k)))
    sent = days.select(*by, later.alias("day"), "n", "heat_sketch", "who_sketch")
    merged = sent.groupBy(*by, "day").agg(F.sum("n").alias("n"), F.when(F.count("heat_sketch") > 0, F.kll_merge_agg_double("heat_sketch")).alias("heat_sketch"), F.hll_union_agg("who_sketch").alias("who_sketch"))
    return merged.join(days.select(*by, "day"), [*by, "day"], "left_semi")


#: Points of a window's distribution that its rows are placed between.
POINTS = 200


def points(sketch: Column) -> Column:
    """The heats at POINTS evenly spaced ranks of a sketch: what a row needs to know, read off once for each window."""
    return F.kll_sketch_get_quantile_double(sketch, F.array(*(F.lit((k + 0.5) / POINTS) for k in range(POINTS))))


def percentile_of(of_window: Column, heat: Column) -> Column:
    """The share of a window's heats that are `heat` or less: within the sketch's error (one percent) and half a point."""
    return F.size(F.filter(of_window, lambda q: q <= heat.cast("double"))) / POINTS


def rolling_percentiles(rows: DataFrame, by: list[str], time: str, heat: str, who: str, length: int = 7, out: str = "percentile") -> DataFrame:
    """Rows with a time and their heat's percentile among the key's heats of the last `length` days, their own day included."""
    w = rolling(daily(rows, by, time, heat, who), by, length).select(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(by)), F.col("day").alias("_day"), points(F.col("heat_sketch")).alias("_points"))
    same = F.to_date(time) == F.col("_day")
    for i, c in enumerate(by):
        same &= F.col(c).eqNullSafe(F.col(f"_k{i}"))
    met = rows.join(w, same)
    return met.withColumn(out, F.when(F.col(heat).isNotNull(), percentile_of(F.col("_points"), F.col(heat)))).drop("_day", "_points", *(f"_k{i}" for i in range(len(by))))
