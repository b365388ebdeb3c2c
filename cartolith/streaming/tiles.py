"""The live side of the map as structured streams: queues, debouncing, ticks, caches, levels of detail.

State is kept for each key and bounded: a cache has its budget of tiles, a camera one level, a session its last event.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cartolith.functions.fields import HYSTERESIS, LEVELS
from cartolith.runtime import ship

BUDGET, PER_BATCH, PAUSE = 96, 16, "120 milliseconds"


def queued(spark: SparkSession, path: str, schema: str, per_batch: int = PER_BATCH) -> DataFrame:
    """A work queue over Parquet files: at most per_batch files a micro-batch, the rest in later ones, each once."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def debounced(events: DataFrame, key: str, ts: str = "ts", pause: str = PAUSE, late: str = "10 seconds") -> DataFrame:
    """key, fired (when the pause ends), n and the last event of each burst of events no further apart than the pause.

    A burst is given out once the watermark is past it; events later than that are dropped.
    """
    rest = [c for c in events.columns if c not in (key, ts)]
    g = events.withWatermark(ts, late).groupBy(F.session_window(ts, pause).alias("w"), key)
    last = F.max(F.struct(ts, *rest)).alias("last")
    return g.agg(last, F.count("*").alias("n")).select(key, F.col("w.end").alias("fired"), "n", "last.*")


def ticks(spark: SparkSession, per_second: int) -> DataFrame:
    """timestamp and value of a clock with a fixed rate; value numbers the ticks, also those that came late."""
    return spark.readStream.format("rate").option("rowsPerSecond", per_second).load()


def _ordered(frames: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(frames)).sort_values(["ts", "event_id"], kind="stable")


def cached(requests: DataFrame, key: str, budget: int = BUDGET) -> DataFrame:
    """key, event_id, tile, hit, evicted for requests (key, ts, event_id, tile) to a least-recently-used cache a key.

    Requests of a micro-batch are taken in the order of ts and event_id. The state is the cached tiles, oldest first.
    """
    ship(requests.sparkSession)

    def run(k, frames, state: GroupState):
        held = dict.fromkeys(state.get[0]) if state.exists else {}
        out = []
        for r in _ordered(frames).itertuples():
            hit, evicted = r.tile in held, None
            held.pop(r.tile, None)
            held[r.tile] = None
            if len(held) > budget:
                evicted = next(iter(held))
                del held[evicted]
            out.append((k[0], r.event_id, r.tile, hit, evicted))
        state.update((list(held),))
        yield pd.DataFrame(out, columns=[key, "event_id", "tile", "hit", "evicted"])

    kind = dict(requests.dtypes)[key]
    return requests.groupBy(key).applyInPandasWithState(run, f"{key} {kind}, event_id long, tile string, hit boolean, evicted string", "held array<string>", "append", GroupStateTimeout.NoTimeout)


def levels(cameras: DataFrame, key: str) -> DataFrame:
    """key, event_id, lod for cameras (key, ts, event_id, lod exact): the level shown, which lags by the hysteresis."""
    ship(cameras.sparkSession)

    def run(k, frames, state: GroupState):
        now, out = (state.get[0] if state.exists else None), []
        for r in _ordered(frames).itertuples():
            if now is None or abs(r.lod - now) > 0.5 + HYSTERESIS:
                now = min(LEVELS, max(0, math.floor(r.lod + 0.5)))
            out.append((k[0], r.event_id, now))
        state.update((now,))
        yield pd.DataFrame(out, columns=[key, "event_id", "lod"])

    kind = dict(cameras.dtypes)[key]
    return cameras.groupBy(key).applyInPandasWithState(run, f"{key} {kind}, event_id long, lod int", "now int", "append", GroupStateTimeout.NoTimeout)


def warm_up(wanted: DataFrame, store: str, checkpoint: str) -> StreamingQuery:
    """Write each wanted tile (z, x, y, ...) that the store does not have yet; ends when all input there is has been taken."""

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        have = spark.read.schema("z int, x int, y int").option("ignoreMissingFiles", True)
        path = spark._jvm.org.apache.hadoop.fs.Path(store)
        fresh = batch.dropDuplicates(["z", "x", "y"])
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            fresh = fresh.join(have.parquet(store), ["z", "x", "y"], "left_anti")
        fresh.write.mode("append").parquet(store)

    return wanted.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
