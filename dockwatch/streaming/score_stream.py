"""Continuous scoring of requests with Structured Streaming.

Requests ``(station_id, obs_ts)`` arrive as files; each micro-batch is scored
by ``score_requests`` against the readings table (a batch DataFrame, so every
batch sees the readings as of that batch; it scans the days its requests need, and with ``index`` no
older ones). ``streaming.live_score`` is the job for readings that arrive as a stream, too. Output is written per epoch with
overwrite, so a replayed epoch after a failure replaces its own output
(idempotent sink); progress lives in the checkpoint location.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dockwatch.plans.scoring import score_requests
from dockwatch.settings import Settings

REQUEST_SCHEMA = "station_id string, obs_ts timestamp_ntz"


def score_stream(spark: SparkSession, readings: DataFrame, request_dir: str, out_dir: str,
                 checkpoint: str, scorer, s: Settings | None = None,
                 available_now: bool = True, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None, index: DataFrame | None = None) -> StreamingQuery:
    s = s or Settings()
    src = spark.readStream.schema(REQUEST_SCHEMA).format(fmt)
    if max_files_per_trigger:
        src = src.option("maxFilesPerTrigger", max_files_per_trigger)
    requests = src.load(request_dir)

    def handle(batch: DataFrame, epoch_id: int) -> None:
        out = score_requests(readings, batch, scorer, s, index=index).withColumn("epoch", F.lit(epoch_id))
        out.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/epoch={epoch_id}")

    w = requests.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
