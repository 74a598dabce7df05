"""Positions of Parquet sources from what is known of their files.

`max(pos)` over a source reads a column of all its files at every gate.  `FilePositions`
keeps one row per data file instead, with the newest `(pos, id)` in it, in an append-only
log: a refresh lists the source, reads two columns of the files that the log does not
hold, and nothing of the others.  A gate then reads the log alone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.positions import NULL_ID, Position
from ..functions.exprs import as_col
from ..plans.logfiles import compact_log, read_log

FILES_SCHEMA = ("topic string, file string, modified timestamp, rows bigint, "
                "last struct<pos:timestamp_ntz,id:bigint>")


class FilePositions:
    """The log of file positions at `path`; one refresh per topic at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        return read_log(self.spark, self.path, FILES_SCHEMA)

    def refresh(self, topic: str, source: str, pos: str = "pos", id: str = "id", schema: str | None = None,
                slack_s: int = 86400) -> int:
        """Add the source's new files; returns how many.

        A file is known by its path and modification time, so one that was replaced in place
        is read again.  Files last modified more than `slack_s` before the newest known one
        are taken as known without a look at their names: `slack_s` must exceed the time
        between a file's last byte and its publication, i.e. the longest write job.  Only
        the names of files within the slack pass the driver.  Files without rows, and rows
        without a position, move nothing; a NULL id stands before all others.
        """
        known = self.read().filter(F.col("topic") == topic)
        newest = known.agg(F.max("modified").alias("m")).select(F.unix_seconds("m")).first()[0]
        reader = self.spark.read.schema(schema or self.spark.read.parquet(source).schema)
        recent = []
        if newest is not None:
            since = newest - slack_s - 1
            recent = [r[0] for r in known.filter(F.unix_seconds("modified") >= since).select(_version("file", "modified")).distinct().collect()]
            reader = reader.option("modifiedAfter", _dt.datetime.fromtimestamp(since, _dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")) \
                .option("timeZone", "UTC")
        rows = reader.parquet(source)
        if recent:   # on file metadata alone: applied to the listing
            rows = rows.filter(~_version("_metadata.file_path", "_metadata.file_modification_time").isin(recent))
        at = F.struct(as_col(pos).cast("timestamp_ntz").alias("pos"), F.coalesce(as_col(id).cast("bigint"), F.lit(NULL_ID)).alias("id"))
        files = (rows.groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("modified"))
                 .agg(F.count(F.lit(1)).alias("rows"), F.max(F.when(as_col(pos).isNotNull(), at)).alias("last")))
        files = files.select(F.lit(topic).alias("topic"), "file", "modified", "rows", "last").persist()
        try:
            added = files.count()
            if added:
                files.coalesce(1).write.mode("append").parquet(self.path)
        finally:
            files.unpersist()
        return added

    def positions(self) -> DataFrame:
        """`(topic, last)` per source, for the gate (G1) and the readiness report.

        The newest position any file ever had: a compaction or retention of the source does
        not move it back.
        """
        return self.read().groupBy("topic").agg(F.max("last").alias("last"))

    def position(self, topic: str) -> Position | None:
        row = self.positions().filter(F.col("topic") == topic).first()
        return Position.of(row["last"]) if row else None

    def compact(self, keep_s: int = 3600, min_files: int = 2) -> int:
        return compact_log(self.spark, self.path, FILES_SCHEMA, ["topic", "modified", "file"], keep_s, min_files)


def _version(file: str, modified: str):
    return F.concat_ws("|", F.col(file), F.unix_micros(modified).cast("string"))
