"""Dependency gate and readiness.

Positions tables hold rows `(topic, last struct<pos, id>, run, processor, ...)`.
The gate of a destination is `least(min(last.pos of its dependencies), now - delay)`
with the slowest dependency as laggard (G1).  Readiness (G3) evaluates every
pipeline of a lineage table against the same rule and reports who may run.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import elapsed_seconds, in_time_window, time_delta_seconds, topic_key, topic_parts, ts_lit
from .positions import Position, source_position

STUB_FROM = "2099-01-01 00:00:00"   # positions at or after this are always-ready stubs


def source_positions(spark, sources: dict, pos: str = "pos", id: str = "id") -> DataFrame:
    """B11 for several sources: one `(topic, last)` row per source, read from the data.

    `sources` maps topic -> DataFrame or (DataFrame, pos, id).
    """
    rows = []
    for topic, src in sources.items():
        df, p, i = (src, pos, id) if isinstance(src, DataFrame) else src
        sp = source_position(df, p, i)
        rows.append((topic, sp.pos if sp else None, sp.id if sp else None))
    return spark.createDataFrame(rows, "topic string, pos timestamp_ntz, id bigint").select(
        "topic", F.struct("pos", "id").alias("last"))


def current_positions(positions: DataFrame, shard: str | None = None, all_shards: bool = False) -> DataFrame:
    """Newest row per topic, topics whose newest row is `deleted` skipped.

    A reader takes its own shard's and the unsharded row of a topic (D28); where there is
    neither, it needs the whole topic, and every shard's row counts.  `all_shards` (reports)
    keeps all rows.

    Newest by `seq` within a run where the log has one (a begin and a commit row can tie on
    everything else).  Output adds `t` = topic without its shard suffix.
    """
    p = positions
    newest = [F.col(c).desc() for c in ("run", "seq") if c in p.columns] + [F.col("last").desc()]
    w = Window.partitionBy("topic").orderBy(*newest)
    p = p.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    if "processor" in p.columns:
        # after the choice: the append-only log still holds older rows of a deleted topic
        p = p.filter(F.coalesce(F.col("processor"), F.lit("")) != "deleted")
    p = p.withColumn("t", topic_key("topic"))
    if not all_shards:
        p = p.withColumn("_far", ~_near(_shard("topic"), F.lit(shard or "")))
        p = p.withColumn("_all", F.min("_far").over(Window.partitionBy("t"))).filter(F.col("_far") == F.col("_all"))
        p = p.drop("_far", "_all")
    return p


def _shard(topic) -> Column:
    return F.regexp_extract(topic, r":(.*)$", 1)


def _near(shard: Column, reader: Column) -> Column:
    return (shard == "") | (shard == reader)


def dep_gate_df(positions: DataFrame, deps: list[str], delay_s: int, now, strict: bool = False,
                shard: str | None = None) -> DataFrame:
    """G1 as a one-row DataFrame: gate, laggard, found, blocked."""
    cur = current_positions(positions, shard).filter(F.col("t").isin(list(deps)))
    agg = cur.agg(
        F.min("last.pos").alias("mins"),
        F.min_by("t", F.struct(F.col("last.pos"), F.col("t"))).alias("laggard"),
        F.countDistinct("t").alias("found"),
        F.count_if(F.col("last.pos").isNull()).alias("blocked"),
    )
    limit = ts_lit(now - _dt.timedelta(seconds=delay_s))
    ok = (F.col("found") > 0) & (F.col("blocked") == 0)
    if strict:
        ok = ok & (F.col("found") == F.lit(len(set(deps))))
    return agg.select(
        F.when(ok, F.least(F.col("mins"), limit)).alias("gate"),
        F.when(F.col("found") == 0, F.lit("missing")).otherwise(F.col("laggard")).alias("laggard"),
        F.col("found").cast("bigint").alias("found"),
    )


def dep_gate(positions: DataFrame, deps: list[str], delay_s: int, now, strict: bool = False,
             shard: str | None = None) -> tuple:
    """G1: (gate datetime or None, laggard topic)."""
    r = dep_gate_df(positions, deps, delay_s, now, strict, shard).first()
    return r["gate"], r["laggard"]


def pipelines_from(lineage: DataFrame, destinations: DataFrame) -> DataFrame:
    """Lineage rows (table, depends_on, delay, repeat, time) completed with each
    destination's newest position row (last, run, processor, hostid), e.g. from a
    load's `PositionStore.read()`.  A sharded destination gives one row per shard, its topic
    as `table`.  Destinations never loaded start at NULL `last`."""
    cur = current_positions(destinations, all_shards=True).select(
        F.col("t").alias("table"), "topic", F.col("last.pos").alias("last"), "run",
        F.coalesce(F.col("processor"), F.lit("")).alias("processor"),
        F.coalesce(F.col("hostid"), F.lit("")).alias("hostid"))
    return lineage.join(cur, "table", "left").select(
        F.coalesce("topic", "table").alias("table"), "depends_on", "delay", "repeat", "time", "last", "run",
        F.coalesce(F.col("processor"), F.lit("")).alias("processor"),
        F.coalesce(F.col("hostid"), F.lit("")).alias("hostid"))


def readiness(pipelines: DataFrame, positions: DataFrame, now) -> DataFrame:
    """Which pipelines may run at `now`.

    `pipelines`: table, depends_on (comma list), delay, repeat (time-delta text),
    time ('H:MM-H:MM' or ''), last (timestamp), run (timestamp), processor, hostid.
    Ready when (a full block waits and no host holds the topic) or (the own position
    is behind the gate and `repeat` has passed), and inside the time window or more
    than a day behind (D2, D23, D26).  A destination's shard (`table:i`) looks at the same
    shard of its sources, a whole one at the slowest shard of each.
    """
    now_l = ts_lit(now)
    pl = (pipelines
          .withColumn("delay_s", time_delta_seconds("delay", 0))
          .withColumn("repeat_s", time_delta_seconds("repeat", 3600))
          .withColumn("dep", F.explode(F.transform(F.split("depends_on", ","), lambda x: F.trim(x)))))
    cur = current_positions(positions, all_shards=True).select(
        F.col("t").alias("dep"), F.col("last.pos").alias("dep_pos"), _shard("topic").alias("_dep_shard"))
    joined = pl.join(cur, "dep", "left")
    # of a dependency, the own shard's and the unsharded row; all shards where there is neither
    far = F.coalesce(~_near(F.col("_dep_shard"), _shard("table")), F.lit(False))
    joined = joined.withColumn("_far", far).withColumn("_all", F.min("_far").over(Window.partitionBy("table", "dep")))
    joined = joined.filter(F.col("_far") == F.col("_all"))
    joined = joined.groupBy("table", "dep").agg(
        *[F.first(c).alias(c) for c in ("last", "run", "processor", "hostid", "delay_s", "repeat_s", "time")],
        # a shard without a position holds the whole back
        F.when(F.count("dep_pos") == F.count(F.lit(1)), F.min("dep_pos")).alias("dep_pos"))
    g = joined.groupBy("table").agg(
        F.first("last").alias("last"), F.first("run").alias("run"), F.first("processor").alias("processor"),
        F.first("hostid").alias("hostid"), F.first("delay_s").alias("delay_s"),
        F.first("repeat_s").alias("repeat_s"), F.first("time").alias("time"),
        F.min("dep_pos").alias("mins"), F.count("dep_pos").alias("found"),
    )
    gate = F.when(F.col("found") > 0,
                  F.least(F.col("mins"), F.timestamp_add("SECOND", -F.col("delay_s"), now_l)))
    full = F.col("processor").like("Full%") & (F.coalesce(F.col("hostid"), F.lit("")) == "")
    behind = F.coalesce(F.col("last") < F.col("gate"), F.col("gate").isNotNull()) & \
        F.coalesce(elapsed_seconds("run", now_l) > F.col("repeat_s"), F.lit(True))
    in_window = in_time_window(now_l, F.coalesce(F.col("time"), F.lit(""))) | \
        F.coalesce(F.col("last") < now_l - F.expr("INTERVAL 1 DAY"), F.lit(True))   # never loaded: as if long ago
    return (g.withColumn("gate", gate)
            .withColumn("ready", F.coalesce((full | behind) & in_window, F.lit(False)))
            .select("table", "gate", F.col("found").cast("bigint").alias("found"), "ready"))


def table_writes(spark, tables: dict) -> DataFrame:
    """Newest file modification time of each destination (`table` -> path), from the
    `_metadata` column of a file scan: one small aggregate per table."""
    parts = [spark.read.parquet(path).select(F.lit(name).alias("table"),
                                            F.col("_metadata.file_modification_time").alias("m"))
             .groupBy("table").agg(F.max("m").cast("timestamp_ntz").alias("parts"))
             for name, path in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def position_report(positions: DataFrame, now, tables: dict | None = None) -> DataFrame:
    """Newest row per topic with elapsed seconds since its run; stubs hidden.

    With `tables` (destination table -> path), each row also gets `parts`, the last
    write to its destination, matched on the topic without `#tag` and `:shard` (D4).
    """
    cur = current_positions(positions, all_shards=True)
    now_l = ts_lit(now)
    out = cur.filter(F.col("last.pos") < ts_lit(STUB_FROM)).filter(F.col("topic") != "null")
    cols = [F.col("topic"), F.col("last.pos").alias("last"), F.col("last.id").alias("last_id")]
    if "run" in cur.columns:
        cols.append(elapsed_seconds("run", now_l).alias("elapsed_s"))
    cols += [F.col(c) for c in ("rows", "processor", "state", "hostid") if c in cur.columns]
    if "next" in cur.columns:
        cols.append(F.col("next.pos").alias("next"))     # of an open block
    rep = out.withColumn("table", topic_parts("topic")["table"]).select(*cols, "table")
    if tables:
        rep = rep.join(table_writes(positions.sparkSession, tables), "table", "left")
    return rep.drop("table")


def precheck_message(topic: str, last: Position | None, nxt: Position | None, rows: int,
                     laggard: str | None, now) -> str:
    """One log line for a planned block; empty blocks name the laggard."""
    if rows == 0 or nxt is None:
        return f"NOJOBS {topic}: waiting for {laggard or 'data'}"
    step = int((nxt.pos - last.pos).total_seconds() // 60) if last else 0
    lag = int((now - nxt.pos).total_seconds() // 60)
    return f"{topic} processing {rows} rows, step:{step}min, lag:{lag}min"
