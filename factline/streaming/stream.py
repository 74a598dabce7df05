"""Streaming form of the block load (P6) and the gate as watermarks.

The same block body runs per micro-batch through `foreachBatch`: the micro-batch
is the block, its batch id names the block directory, and Structured Streaming's
checkpoint drives the source.  A batch replayed after a failure gets the same id and
overwrites its own directory, or finds it committed, so the sink stays exactly-once over
at-least-once delivery.  The commit row in the position log makes the batch visible and
carries the position reached.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import time
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import position
from ..operators.positions import Position
from ..plans.load import dedup_block
from ..plans.sink import Target, append_log, conform, log_fields, publish
from ..plans.store import PositionStore


def stream_block_id(topic: str, stream: str, batch_id: int) -> str:
    """Folder of a micro-batch: streams and topics that share a destination never share one."""
    return f"s{hashlib.sha256(f'{topic}|{stream}'.encode()).hexdigest()[:12]}-{batch_id:08d}"


def block_writer(spark: SparkSession, topic: str, transform: Callable[[DataFrame], DataFrame], target: Target,
                 store: PositionStore, now=None, stream: str = "", pos: str | None = None, id: str | None = None):
    """A `foreachBatch` function running the block body on each micro-batch.

    `stream` names the stream across restarts (its checkpoint folder): a batch that is
    delivered again overwrites its own folder, and no other stream's; one that is already
    committed is left alone.  The commit row publishes the folder.  With `pos` and `id`, the
    columns of the source's positions, it also moves the topic to the newest position seen, so
    that batch loads can be gated on a streamed table (G1).
    """

    done = []   # newest batch that this writer has committed

    def run(batch: DataFrame, batch_id: int) -> None:
        block_id = stream_block_id(topic, stream, batch_id)
        if done != [batch_id - 1] and store.has_commit(target.root, block_id):   # after a restart
            return
        began, when = time.monotonic(), now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        last, rows = store.current(topic), 0
        last = Position.of(last["last"]) if last else None
        if pos:
            # the batch's own two columns
            seen = batch.agg(F.max(position(pos, id)).alias("m"), F.count(F.lit(1)).alias("n")).first()
            rows = seen["n"]
            newest = Position.of(seen["m"]) if seen["m"] is not None and seen["m"]["pos"] is not None else None
            last = max((p for p in (last, newest) if p), default=None)
        out = dedup_block(transform(batch), target, store, block_id, pos or "pos", id or "id")
        if target.schema:
            out = conform(out, target.schema)
        metrics, commit = publish(out, target, block_id)
        if target.log_path:
            append_log(spark, target.log_path, topic, when, metrics, target.checks, block_id)
        store.append(topic, last=last, rows=rows, run=when, processor="Stream", state=f"batch {batch_id}", block_id=block_id,
                     log=log_fields(metrics, target.checks), elapsed_ms=int(1000 * (time.monotonic() - began)), **commit)
        done[:] = [batch_id]

    return run


def stream_load(spark: SparkSession, source: DataFrame, topic: str, transform, target: Target, checkpoint: str,
                store: PositionStore, now=None, available_now: bool = True, pos: str | None = None,
                id: str | None = None):
    """Drive the block body from a streaming source; returns the finished query."""
    w = (source.writeStream.foreachBatch(block_writer(spark, topic, transform, target, store, now, checkpoint, pos, id))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def file_stream(spark: SparkSession, path: str, schema, max_files: int | None = None, fmt: str = "parquet"):
    """A file source as a stream; `max_files` plays the role of `max_step`."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def with_gate(sources: dict, delay: str) -> dict:
    """Each source gets a watermark `delay` behind its event time; with the
    default `multipleWatermarkPolicy=min`, a join or union of them advances at the
    pace of the slowest source, which is the dependency gate.

    `sources` maps name -> (streaming DataFrame, event-time column); event time is
    cast to TIMESTAMP because watermarks refuse TIMESTAMP_NTZ.
    """
    out = {}
    for name, (df, ts) in sources.items():
        out[name] = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return out


def gated_window_counts(spark: SparkSession, sources: dict, delay: str, window: str, out_path: str,
                        checkpoint: str) -> DataFrame:
    """G2 in use: per-window counts of several sources, emitted only once every
    source's watermark has passed the window end (append mode), i.e. once the
    slowest source has caught up.  Runs to completion with `availableNow`."""
    gated = with_gate(sources, delay)
    parts = [df.select(F.col(ts).alias("ts"), F.lit(name).alias("source")) for name, (df, ts) in
             ((n, (gated[n], sources[n][1])) for n in sources)]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    counts = (u.groupBy(F.window("ts", window), "source")
              .agg(F.count(F.lit(1)).alias("n"))
              .select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window.end").cast("timestamp_ntz").alias("window_end"), "source", "n"))

    def sink(batch, batch_id):   # a folder per batch: a batch delivered again overwrites its own
        batch.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    q = (counts.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema("window_start timestamp_ntz, window_end timestamp_ntz, source string, n bigint") \
        .option("recursiveFileLookup", "true").parquet(out_path) if _has_files(spark, out_path) else spark.createDataFrame(
            [], "window_start timestamp_ntz, window_end timestamp_ntz, source string, n bigint")


def _has_files(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def stream_dedup(df: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """S6 on a stream: drop rows whose keys were already seen, keeping state only
    for `delay` behind the event-time watermark (`dropDuplicatesWithinWatermark`)."""
    return (df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
            .dropDuplicatesWithinWatermark(keys))
