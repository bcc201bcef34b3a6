"""Filters, joins, folds and rankings of the domain: each one query over whole tables, none a lookup per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# ---- filters ----
def date_decision(df: DataFrame, ref_time: Column, max_age_hours: int = 72, missing: str = "keep") -> DataFrame:
    """Adds outcome, reason and details: items older than the limit go, future ones stay, undated ones by policy."""
    old = F.col("published_at") < ref_time - F.make_interval(hours=F.lit(max_age_hours))
    reason = F.when(F.col("published_at").isNull(), F.lit("missing_published_at") if missing == "drop" else F.lit(None).cast("string")).when(old, F.lit("expired"))
    out = df.withColumn("reason", reason)
    return out.withColumn("outcome", F.when(F.col("reason").isNull(), "accepted").otherwise("discarded")).withColumn(
        "details", F.when(F.col("reason").isNotNull(), F.to_json(F.struct(F.lit(max_age_hours).alias("max_age_hours"), F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss").alias("published_at"))))
    )


def select_events(events: DataFrame, flags: dict[str, tuple[bool, bool]], include_queued: bool = False, level: str | None = None) -> DataFrame:
    """Events of enabled levels, immediate ones unless queued are wanted; pushed down as a set of levels."""
    levels = [k for k, (enabled, immediate) in flags.items() if enabled and (immediate or include_queued) and (level is None or k == level)]
    return events.where(F.col("alert_level").isin(levels))


def due(sources: DataFrame, state: DataFrame, ref_time: Column) -> DataFrame:
    """Sources without state or whose next run has come."""
    return sources.join(state.select("source_key", "next_run_at"), "source_key", "left").where(F.coalesce(F.col("next_run_at") <= ref_time, F.lit(True)))


# ---- joins ----
def pending(raw: DataFrame, decisions: DataFrame) -> DataFrame:
    """Items without a decision."""
    return raw.join(decisions.select(F.col("raw_item_id").alias("id")), "id", "left_anti")


def missing(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right.select(key), key, "left_anti")


def ready_for_scoring(clean: DataFrame, analyses: DataFrame, assessments: DataFrame) -> DataFrame:
    return clean.join(analyses, "clean_item_id").join(assessments.select("clean_item_id"), "clean_item_id", "left_anti")


def comments_by_item(sources: DataFrame, raw: DataFrame, comments: DataFrame) -> DataFrame:
    """Each clean item's comments, once each, through its raw items: (clean_item_id, all columns of comments)."""
    ext = sources.join(raw.select(F.col("id").alias("raw_item_id"), "external_id"), "raw_item_id").select("clean_item_id", "external_id").distinct()
    return ext.join(comments.withColumnRenamed("note_external_id", "external_id"), "external_id").dropDuplicates(["clean_item_id", "id"]).withColumnRenamed("external_id", "note_external_id")


def with_sources(clean: DataFrame, sources: DataFrame) -> DataFrame:
    """Clean items with their raw ids, in order of merging."""
    lists = sources.groupBy("clean_item_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "raw_item_id"))), lambda s: s["raw_item_id"]).alias("source_raw_item_ids"))
    return clean.join(lists, "clean_item_id", "left")


def undelivered(events: DataFrame, deliveries: DataFrame, include_delivered: bool = False) -> DataFrame:
    """Events that haven't arrived; one that may have (`unknown`) isn't sent again unless all are asked for."""
    return events if include_delivered else events.join(deliveries.where("status in ('succeeded', 'unknown')").select("event_id"), "event_id", "left_anti")


def delivery_report(events: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Events, known by the id inside their JSON, with the state of their delivery."""
    e = events.withColumn("event_id", F.get_json_object("event_json", "$.event_id"))
    return e.join(deliveries.select("event_id", "status", "attempt_count"), "event_id", "left")


# ---- folds ----
def table_stats(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def status_fold(status: Column) -> Column:
    """failed if any failed, partial if any is partial, else succeeded; skipped ones don't count."""
    return F.when(F.bool_or(status == "failed"), "failed").when(F.bool_or(status == "partial"), "partial").otherwise("succeeded")


def run_summary(decisions: DataFrame) -> DataFrame:
    return decisions.agg(F.count("*").alias("input_count"), F.count_if(F.col("outcome") == "accepted").alias("accepted_count"), F.count_if(F.col("outcome") == "discarded").alias("discarded_count"))


def engagement_total(engagement: Column) -> Column:
    return F.aggregate(F.map_values(engagement), F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(0)))


def idle_seconds(next_run: Column, ref_time: Column) -> Column:
    return F.coalesce(F.greatest(F.lit(0), F.unix_timestamp(F.min(next_run)) - F.unix_timestamp(ref_time)), F.lit(0))


def selected(df: DataFrame, wanted: list[str] | None = None, platform: str = "platform", enabled: str = "enabled") -> DataFrame:
    """Enabled rows, of the platforms asked for if any are; names are compared without case, and unknown ones select nothing."""
    out = df.where(F.col(enabled))
    return out if not wanted else out.where(F.lower(platform).isin([w.lower() for w in wanted]))


# ---- rankings ----
def listed(df: DataFrame, order: list, limit: int | None = None) -> DataFrame:
    """Rows in the order of a list view; a limit that is missing or negative shows all. A limited one keeps that many rows a task."""
    out = df.orderBy(*order)
    return out if limit is None or limit < 0 else out.limit(limit)


def first_n(df: DataFrame, n: int, by: list[str], order: list) -> DataFrame:
    """The first n rows of each group; a filter on row_number keeps n rows a task before the shuffle."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_rn") <= n).drop("_rn")


def fallback_rank(valid: Column, by: list[str], order: list) -> Column:
    """The place among valid rows so far."""
    return F.sum(valid.cast("int")).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def processing_order(df: DataFrame) -> DataFrame:
    """The order duplicates are judged in, as columns to sort by: no global numbering, so no single task."""
    return df.withColumn("ord_time", F.coalesce("published_at", "collected_at"))


def attempt_number(by: list[str], order: list) -> Column:
    return F.row_number().over(Window.partitionBy(*by).orderBy(*order))


def heat_percentiles(df: DataFrame, by: str, heat: str, out: str = "percentile") -> DataFrame:
    """Adds percent_rank of `heat` in its group, nulls first.

    Rows are counted by value before anything is sorted, so a task sorts a group's distinct values and never its rows, and a
    group of a third of all rows weighs no more than its values.
    """
    values = df.groupBy(by, heat).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(by)
    before = F.sum("_n").over(w.orderBy(heat)) - F.col("_n")
    values = values.select(F.col(by).alias("_by"), F.col(heat).alias("_heat"), F.when(F.sum("_n").over(w) > 1, before / (F.sum("_n").over(w) - 1)).otherwise(F.lit(0.0)).cast("double").alias(out))
    return df.join(values, F.col(by).eqNullSafe(F.col("_by")) & F.col(heat).eqNullSafe(F.col("_heat"))).drop("_by", "_heat")


def heat_rollup(df: DataFrame, keys: list[str], heat: str) -> DataFrame:
    """Grouping sets of heat: rows and their sum for every prefix of the keys, the grand total last; `depth` keys are set."""
    depth = sum((1 - F.grouping(k) for k in keys), F.lit(0))
    return df.rollup(*keys).agg(depth.cast("int").alias("depth"), F.count("*").alias("n"), F.sum(heat).alias("heat"))
