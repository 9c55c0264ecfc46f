"""Event logs as streams: incremental counts and the progress series.  The same functions work on static tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..sources.text import EVENT_SCHEMA


def event_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def counts(events: DataFrame, *more: str) -> DataFrame:
    """Events by name and level, and by further columns (run_id)."""
    return events.groupBy("event", "level", *more).agg(F.count("*").alias("count"))


def windowed_counts(events: DataFrame, window: str, late: str) -> DataFrame:
    """Counts per event and window; rows later than the watermark are dropped by the stream, as its state must end."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window).alias("w"), "event").agg(F.count("*").alias("count")).select(F.col("w.start").alias("start"), "event", "count")


def progress_series(events: DataFrame) -> DataFrame:
    """(run, time, done, total, share) of progress events, whose detail is JSON."""
    detail = F.from_json("detail", "done bigint, total bigint")
    rows = events.where("event = 'submit.progress'").select("run_id", "ts", detail["done"].alias("done"), detail["total"].alias("total"))
    return rows.withColumn("share", F.try_divide(F.col("done"), F.col("total")))


#: Points behind a progress event that its rate is taken from.
POINTS = 5
_SERIES = "run_id long, ts timestamp, done long, total long, share double, eta_seconds double"
_STATE = "ts array<timestamp>, done array<long>"


def with_eta(series: DataFrame, points: int = POINTS) -> DataFrame:
    """A static progress series with eta_seconds: what is left at the rate since the point so many events before (or the run's first).

    Null where nothing was done since then.  Events of a run are in order of time, then of what is done.
    """
    over = Window.partitionBy("run_id").orderBy("ts", "done").rowsBetween(-points, 0)
    took = (F.unix_micros("ts") - F.first(F.unix_micros("ts")).over(over)) / 1e6
    did = F.col("done") - F.first("done").over(over)
    return series.withColumn("eta_seconds", F.when(did > 0, (F.col("total") - F.col("done")) * took / did))


def progress_with_eta(series: DataFrame, points: int = POINTS) -> DataFrame:
    """The same of a stream: each run's last points are its state, however many batches lie between them.

    A batch's events of a run are put in order; events of an earlier time in a later batch follow those that were there.  A run's state is
    points rows, and a batch is bounded by the files a trigger takes.
    """

    def step(key, batches, state):
        ts, done = (list(x) for x in state.get) if state.exists else ([], [])
        rows = pd.concat(list(batches), ignore_index=True).sort_values(["ts", "done"], kind="stable")
        eta = []
        for t, d, total in zip(rows["ts"], rows["done"], rows["total"]):
            ts, done = [*ts, t][-points - 1 :], [*done, int(d)][-points - 1 :]
            did = done[-1] - done[0]
            took = (pd.Timestamp(ts[-1]) - pd.Timestamp(ts[0])) / pd.Timedelta(microseconds=1) / 1e6
            eta.append((total - d) * took / did if did > 0 else None)
        state.update(([pd.Timestamp(t).to_pydatetime() for t in ts], done))
        yield rows.assign(eta_seconds=pd.array(eta, dtype="Float64").to_numpy(dtype=float, na_value=np.nan))

    named = series.select("run_id", "ts", "done", "total", "share")
    out = named.groupBy("run_id").applyInPandasWithState(step, _SERIES, _STATE, "append", GroupStateTimeout.NoTimeout)
    return out.withColumn("eta_seconds", F.when(~F.isnan("eta_seconds"), F.col("eta_seconds")))


def run_available(stream: DataFrame, mode: str, out: str, checkpoint: str) -> None:
    """Process what is there and stop: append to Parquet, or rewrite the complete result of each batch."""
    writer = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
    if mode == "append":
        query = writer.outputMode("append").format("parquet").option("path", out).start()
    else:
        query = writer.outputMode("complete").foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out)).start()
    query.awaitTermination()
