"""Order-dependent columns without a task for a key: ranges of (key, order), and what each range hands to the next.

Rows are dealt by range of key and order, so a key of a third of all rows is many ranges. A window inside a range and key gives
the local figures; one row for each range and key carries the totals, of which a key has no more than there are ranges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

_RANGE = "_range"


class Ranges:
    """Rows of `df` in ranges of (by, order); `order` names columns that leave no ties. Written once: ranges are sampled."""

    def __init__(self, df: DataFrame, by: list[str], order: list[str], parts: int | None = None):
        spark = df.sparkSession
        self.by, self.order = by, order
        n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = df.repartitionByRange(n, *by, *order).withColumn(_RANGE, F.spark_partition_id())
        self.rows = Scratch(spark).table(dealt, "ranges", kept=True)

    def _inside(self):
        return Window.partitionBy(_RANGE, *self.by).orderBy(*self.order)

    def _handed(self, total: Column, carried, name: str) -> DataFrame:
        """(range, key, what all earlier ranges of the key hand over)."""
        totals = self.rows.groupBy(_RANGE, *self.by).agg(total.alias("_total"))
        earlier = Window.partitionBy(*self.by).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
        return totals.select(F.col(_RANGE).alias("_r"), *(F.col(c).alias(f"_k{i}") for i, c in enumerate(self.by)), carried(F.col("_total")).over(earlier).alias(name))

    def _met(self, local: DataFrame, handed: DataFrame) -> DataFrame:
        same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(self.by)), F.col(_RANGE) == F.col("_r"))
        return local.join(handed, same).drop("_r", *(f"_k{i}" for i in range(len(self.by))))

    def running_sum(self, value: Column, out: str) -> DataFrame:
        """The rows with the sum of `value` from the key's first row to this one; nulls count nothing."""
        w = self._inside().rowsBetween(Window.unboundedPreceding, 0)
        local = self.rows.withColumn("_local", F.coalesce(F.sum(value).over(w), F.lit(0)))
        met = self._met(local, self._handed(F.sum(value), F.sum, "_before"))
        return met.withColumn(out, F.col("_local") + F.coalesce("_before", F.lit(0))).drop("_local", "_before", _RANGE)

    def last_known(self, value: Column, out: str, before: bool = False) -> DataFrame:
        """The rows with the key's last non-null `value` up to this row, or, with `before`, up to the row before it."""
        w = self._inside().rowsBetween(Window.unboundedPreceding, -1 if before else 0)
        local = self.rows.withColumn("_local", F.last(value, ignorenulls=True).over(w))
        end = F.max_by(value, F.when(value.isNotNull(), F.struct(*self.order)))
        met = self._met(local, self._handed(end, lambda c: F.last(c, ignorenulls=True), "_before"))
        return met.withColumn(out, F.coalesce("_local", "_before")).drop("_local", "_before", _RANGE)


def ranked(df: DataFrame, by: list[str], order: list[str], out: str = "rank", valid: Column | None = None, parts: int | None = None) -> DataFrame:
    """Adds each row's place among its key's rows (among the valid ones so far, if asked), from one."""
    return Ranges(df, by, order, parts).running_sum(F.lit(1) if valid is None else valid.cast("int"), out)


def as_of(left: DataFrame, right: DataFrame, by: list[str], time: str, values: list[str], parts: int | None = None) -> DataFrame:
    """Rows of `left` with the values of the key's latest row of `right` at that time or before; nulls where there is none.

    Rows of `right` at one time and key are decided by the greatest values. Rows of `left` may repeat. Null keys are a key;
    null times come before all others. Both sides stand in one order and the last known row of `right` is carried forward,
    from range to range.
    """
    seen = F.struct(*(F.col(c) for c in values))
    none = F.lit(None).cast(right.select(seen.alias("x")).schema["x"].dataType)
    mine = F.struct(*(F.col(c) for c in left.columns))
    lefts = left.select(*by, time, F.lit(1).alias("_side"), none.alias("_right"), mine.alias("_left"))
    rights = right.select(*by, time, F.lit(0).alias("_side"), seen.alias("_right"), F.lit(None).cast(left.select(mine.alias("x")).schema["x"].dataType).alias("_left"))
    r = Ranges(lefts.unionByName(rights), by, [time, "_side", "_right"], parts)
    out = r.last_known(F.col("_right"), "_known").where("_side = 1")
    return out.select("_left.*", *(F.col(f"_known.{c}").alias(c) for c in values))


def in_intervals(points: DataFrame, intervals: DataFrame, by: list[str], time: str, start: str, stop: str, width: int = 3600) -> DataFrame:
    """Pairs of a point and an interval of its key with start <= time < stop: all columns of both, keys once.

    Intervals are cut into bins of `width` seconds and points meet them by key and bin, so a hot key is many joins, each of which
    may be split; a pair is found once, in the point's own bin. Rows with a null key, time or end pair with nothing.
    """
    bin_of = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / (width * 1_000_000))
    cut = intervals.where(F.col(start) < F.col(stop)).withColumn("_bin", F.explode(F.sequence(bin_of(start), bin_of(stop))))
    met = points.withColumn("_bin", bin_of(time)).join(cut, [*by, "_bin"])
    return met.where((F.col(time) >= F.col(start)) & (F.col(time) < F.col(stop))).drop("_bin")
