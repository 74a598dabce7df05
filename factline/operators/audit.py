"""Quality log and reports (Q1-Q6).

The block log is one aggregate over the written block: rows, newest id, time range
and a map of non-zero problem counters (`count_if` of each check).  When the block
is written, the same aggregates ride along as `DataFrame.observe` metrics, so the
data are read once.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import elapsed_seconds, ts_lit
from .merge import sum_map

LOG_SCHEMA = ("topic string, ts timestamp_ntz, rows bigint, max_id bigint, min_ts timestamp_ntz, "
              "max_ts timestamp_ntz, nulls map<string,bigint>, run_id string")


def block_log_exprs(ts: str | None = None, id: str | None = None, checks: dict | None = None) -> list[Column]:
    """Aggregates of one block: rows, max_id, min_ts, max_ts and one counter per check."""
    out = [F.count(F.lit(1)).alias("rows")]
    out.append((F.max(F.col(id).cast("bigint")) if id else F.lit(None).cast("bigint")).alias("max_id"))
    out.append((F.min(ts) if ts else F.lit(None).cast("timestamp_ntz")).alias("min_ts"))
    out.append((F.max(ts) if ts else F.lit(None).cast("timestamp_ntz")).alias("max_ts"))
    for name, cond in (checks or {}).items():
        out.append(F.count_if(cond).cast("bigint").alias(f"chk_{name}"))
    return out


def nulls_map(checks: dict | None) -> Column:
    """Non-zero counters as map<string, bigint> (zero counters dropped)."""
    if not checks:
        return F.create_map().cast("map<string,bigint>")
    m = F.create_map(*[x for n in checks for x in (F.lit(n), F.col(f"chk_{n}"))])
    return F.map_filter(m, lambda k, v: v != 0)


def block_log(df: DataFrame, topic, ts: str | None = None, id: str | None = None,
              checks: dict | None = None, by: list | None = None) -> DataFrame:
    """Q1: log row(s) of a block, optionally one per group in `by`."""
    by = by or []
    agg = df.groupBy(*by).agg(*block_log_exprs(ts, id, checks)) if by else df.agg(*block_log_exprs(ts, id, checks))
    t = topic if isinstance(topic, Column) else F.lit(topic)
    return agg.select(*by, t.alias("topic"), "rows", "max_id", "min_ts", "max_ts", nulls_map(checks).alias("nulls"))


def merge_log(log: DataFrame, by: list | None = None) -> DataFrame:
    """Q2: merge log rows per topic: sums, extremes, summed counters, run ids, max lag."""
    by = by or ["topic"]
    merged_nulls = sum_map(log.select(*by, "nulls"), by, "nulls")
    base = log.groupBy(*by).agg(
        F.sum("rows").alias("rows"), F.max("max_id").alias("max_id"), F.min("min_ts").alias("min_ts"),
        F.max("max_ts").alias("max_ts"), F.max("ts").alias("ts"),
        F.array_sort(F.collect_set(F.col("run_id"))).alias("run_ids"),
    )
    return (base.join(merged_nulls, by, "left")
            .withColumn("max_lag", elapsed_seconds("min_ts", "ts")))


def error_summary(errors: DataFrame, now, ts: str = "ts", topic: str = "topic", err: str = "err",
                  marker: str = "DB::Exception: ") -> DataFrame:
    """Q3: errors of the last day except NOJOBS, per topic and message tail."""
    now_l = ts_lit(now)
    tail = F.element_at(F.split(F.col(err), re.escape(marker), -1), -1)
    recent = errors.filter(~F.col(err).like("NOJOBS%") & (F.col(ts) > now_l - F.expr("INTERVAL 1 DAY")))
    return recent.groupBy(tail.alias("error"), F.col(topic).alias("topic")).agg(
        F.max(ts).alias("time"), F.count(F.lit(1)).alias("c"))


def rate_report(log: DataFrame, runs: DataFrame) -> DataFrame:
    """Q4: log joined to run metrics on run id: rounded seconds, rows and rows per second."""
    ex = log.select("topic", "rows", "max_ts", F.explode("run_ids").alias("run_id"))
    j = ex.join(runs, "run_id")
    dur = F.round(F.col("duration_ms") / 1000).cast("bigint")
    return j.select("run_id", "topic", "rows", "max_ts", dur.alias("dur_s"),
                    F.when(dur > 0, F.round(F.col("rows") / dur, 6)).alias("rows_per_sec"))


def last_run(log: DataFrame, topic: str, now, within_s: int = 3600) -> DataFrame:
    """Q5: rows, newest ts, merged counters and seconds since the newest run of a topic within the hour."""
    recent = log.filter((F.col("topic") == topic) & (F.col("ts") > ts_lit(now - _dt.timedelta(seconds=within_s))))
    per_run = recent.groupBy("run_id").agg(
        F.sum("rows").alias("rows"), F.max("max_ts").alias("max_ts"), F.max("ts").alias("ts"))
    nulls = sum_map(recent.select("run_id", "nulls"), ["run_id"], "nulls")
    per_run = per_run.withColumn("elapsed_s", elapsed_seconds("ts", ts_lit(now)))
    return per_run.join(nulls, "run_id", "left").orderBy(F.col("ts").desc(), F.col("run_id").desc()).limit(1)


class CheckFailed(Exception):
    def __init__(self, tag: str, message: str):
        super().__init__(f"|{tag}\t{message}|")
        self.tag, self.message = tag, message


def check(df: DataFrame, cond, tag: str, message: str) -> int:
    """Q6: raise `CheckFailed(tag, message)` when any row satisfies `cond`.

    Counts violations in one distributed aggregate; only the count reaches the driver.
    """
    c = F.expr(cond) if isinstance(cond, str) else cond
    n = df.agg(F.count_if(c).alias("n")).first()["n"]
    if n:
        raise CheckFailed(tag, f"{message} ({n} rows)")
    return 0


def assert_column(cond, tag: str, message: str) -> Column:
    """Q6 inside a plan: fails the task when `cond` holds on a row."""
    c = F.expr(cond) if isinstance(cond, str) else cond
    return F.when(c, F.raise_error(F.lit(f"|{tag}\t{message}|")))
