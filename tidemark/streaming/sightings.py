"""First sightings with keyed state: who was first with a URL or an id, whatever order files land in."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

#: kind: `first` leads its group, `again` follows a leader, `moved` tells that an earlier item took the lead, `late` came
#: after its group was given up and is told, not dropped. `seq` numbers a key's rows; `run` numbers its groups.
SIGHTING = "key string, id string, time timestamp, leader string, kind string, run long, seq long"
_STATE = "run long, seq long, lead_id string, lead_time timestamp, newest timestamp"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keyed(items: DataFrame, url: Column | None = None) -> DataFrame:
    """(key, id, time): a row for an item's URL hash and one for its platform and id; blank ones have none."""
    url = F.col("url_hash") if url is None else url
    keys = F.array(F.when(url.isNotNull(), F.concat(F.lit("u:"), url)), F.when(F.length("external_id") > 0, F.concat(F.lit("x:"), F.to_json(F.struct("platform", "external_id")))))
    x = items.select("id", F.coalesce("published_at", "collected_at").cast("timestamp").alias("time"), F.explode(F.filter(keys, lambda k: k.isNotNull())).alias("key"))
    return x.select("key", "id", "time")


class _First(StatefulProcessor):
    """Per key: the leader of the present group, and its newest item. One value, however many items a key has."""

    def __init__(self, seconds: int):
        self.seconds = seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("group", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        f = pd.concat(rows).sort_values(["time", "id"], kind="stable")
        run, seq, lead, lead_time, newest = self.state.get() if self.state.exists() else (0, 0, None, None, None)
        lead_time, newest = (None if t is None else pd.Timestamp(t) for t in (lead_time, newest))
        keep, out = pd.Timedelta(seconds=self.seconds), []
        for item, time in zip(f["id"], f["time"]):
            told = []
            if lead is None or time > newest + keep:
                run, lead, lead_time, newest = run + 1, item, time, time
                told = [(item, time, item, "first")]
            elif time < newest - keep:
                told = [(item, time, None, "late")]
            elif item == lead:
                told = []  # the same item once more
            elif (time, item) < (lead_time, lead):
                told = [(item, time, item, "first"), (lead, lead_time, item, "moved")]
                lead, lead_time = item, time
            else:
                told = [(item, time, lead, "again")]
            newest = max(newest, time)
            for i, t, leader, kind in told:
                seq += 1
                out.append((key[0], i, t, leader, kind, run, seq))
        self.state.update((run, seq, lead, lead_time.to_pydatetime(), newest.to_pydatetime()))
        yield pd.DataFrame(out, columns=["key", "id", "time", "leader", "kind", "run", "seq"])

    def close(self) -> None:
        pass


def sightings(keys: DataFrame, seconds: int = 72 * 3600) -> DataFrame:
    """SIGHTING rows of a stream of (key, id, time). Null keys, ids and times name nothing and are left out.

    A group takes items up to `seconds` after its newest one; a later one begins the next. One further before it is late.
    """
    rows = keys.where("key is not null and id is not null and time is not null")
    return rows.groupBy("key").transformWithStateInPandas(statefulProcessor=_First(seconds), outputStructType=SIGHTING, outputMode="Update", timeMode="None")


def decided(rows: DataFrame) -> DataFrame:
    """(key, id, leader) from all SIGHTING rows so far: each item once, with its group's last leader; late ones with none."""
    leads = rows.where("kind = 'first'").groupBy("key", "run").agg(F.max_by("leader", "seq").alias("leader"))
    of = rows.where("kind <> 'late'").select("key", "run", "id").distinct().join(leads, ["key", "run"]).select("key", "id", "leader")
    return of.unionByName(rows.where("kind = 'late'").select("key", "id", F.lit(None).cast("string").alias("leader")).distinct())


def follow(spark: SparkSession, keys: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, seconds: int = 72 * 3600) -> StreamingQuery:
    """Starts the stream over what is there and gives each micro-batch's sightings to `write` (frame, batch number).

    State lives in RocksDB beside the checkpoint; the session's own choice of state store is put back once the query has
    taken it over. A batch that is run again after a crash has the same number and rows.
    """
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        return sightings(keys, seconds).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)
