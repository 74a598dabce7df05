"""Catalogue: load jobs drained into a fresh folder under the shared checkpoint
folder (P1-P7, U2, K1).  Each query returns the final destination table."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..functions.exprs import month_key, ts_lit
from ..operators.lookup import latest
from ..operators.positions import Position
from ..session import work_dir
from ..streaming.stream import file_stream, stream_load
from .catalog_blocks import FACT_SQL, fact_transform
from .load import (PositionStore, Target, compact_blocks, drain_planned, drain_ranges, load_incremental,
                   load_reload, read_fact, read_published, sql_transform)
from .registry import register, table

D = _dt.datetime
FAR_GATE = D(2099, 1, 1)   # explicit gate past the end of the data (D27)


# ------------------------------------------------------------------ step_load
def order_fact_target(root):
    return Target(root=f"{root}/fact", partition_by=["o_month"], dedup="new", keys=["o_orderkey"],
                  log_ts="o_orderdate", log_id="o_orderkey",
                  checks={"no_customer": F.col("c_name").isNull(), "zero_price": F.col("o_totalprice") == 0})


@register("step_load", FACT_SQL)
def q_step_load(spark, sf):
    root = work_dir(spark, "step_load")
    store = PositionStore(spark, f"{root}/positions")
    cust, nat, reg = (table(spark, sf, t) for t in ("customer", "nation", "region"))

    def transform(block):
        return fact_transform(block, cust, nat, reg).withColumn("o_month", month_key("o_orderdate"))

    target = order_fact_target(root)
    src = table(spark, sf, "orders")
    drain_planned(spark, "order_fact", src, transform, target, store, D(2024, 2, 1), gate=FAR_GATE,
                  max_step=5000, pos="o_orderdate", id="o_orderkey")
    return read_fact(spark, target.root, store).drop("block_id", "o_month")


# ------------------------------------------------------------------ uniq_load
@register("uniq_load", """
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
                               ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS rn
  FROM lineitem) WHERE rn = 1
""")
def q_uniq_load(spark, sf):
    root = work_dir(spark, "uniq_load")
    store = PositionStore(spark, f"{root}/positions")
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"]
    target = Target(root=f"{root}/fact", dedup=None)
    src = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey")
    drain_planned(spark, "line_state", src, lambda b: b, target, store, D(2024, 2, 1), gate=FAR_GATE,
                  max_step=5000, pos="l_shipdate", id="l_orderkey", uniq=True, uniq_order=order[1:])
    return latest(read_fact(spark, target.root, store).drop("block_id"), ["l_orderkey"], order)


# ------------------------------------------------------------------ range_load
@register("range_load", """
SELECT event_id, ts, user_id, event_type FROM events
WHERE (ts > TIMESTAMP '2024-01-01 00:00:00' OR (ts = TIMESTAMP '2024-01-01 00:00:00' AND event_id > 0))
  AND (ts < TIMESTAMP '2024-02-01 00:00:00' OR (ts = TIMESTAMP '2024-02-01 00:00:00' AND event_id <= 0))
""")
def q_range_load(spark, sf):
    root = work_dir(spark, "range_load")
    store = PositionStore(spark, f"{root}/positions")
    store.init("event_copy", Position(D(2024, 1, 1), 0))
    target = Target(root=f"{root}/fact", dedup="new", keys=["event_id"])
    src = table(spark, sf, "events")
    drain_ranges(spark, "event_copy", src, lambda b: b.select("event_id", "ts", "user_id", "event_type"), target,
                 store, D(2024, 2, 1), max_step_s=7 * 86400, pos="ts", id="event_id")
    return read_fact(spark, target.root, store).drop("block_id")


# ------------------------------------------------------------------ incremental_load (P5)
@register("incremental_load", """
SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour, event_type, count(*) AS n
FROM events WHERE ts <= TIMESTAMP '2024-02-01 00:00:00' GROUP BY ALL
""")
def q_incremental_load(spark, sf):
    root = work_dir(spark, "incremental_load")
    store = PositionStore(spark, f"{root}/positions")
    target = Target(root=f"{root}/fact", dedup=None)

    def hourly(block):
        return block.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "event_type") \
            .agg(F.count(F.lit(1)).alias("n"))

    src = table(spark, sf, "events")
    for now in (D(2024, 1, 15), D(2024, 2, 1)):
        load_incremental(spark, "hourly_events", src, hourly, target, store, now, pos="ts", id="event_id")
    # an hour never straddles the cut at midnight, so the blocks' counts add up per hour
    return read_fact(spark, target.root, store).groupBy("hour", "event_type").agg(F.sum("n").alias("n"))


# ------------------------------------------------------------------ reload_load
@register("reload_load", """
SELECT c.c_custkey, c.c_name, n.n_name FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def q_reload_load(spark, sf):
    root = work_dir(spark, "reload_load")
    store = PositionStore(spark, f"{root}/positions")

    def build():
        c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
        return c.join(n, c["c_nationkey"] == n["n_nationkey"], "left").select("c_custkey", "c_name", "n_name")

    for now in (D(2024, 1, 1), D(2024, 1, 2)):
        load_reload(spark, "customer_dim", build, f"{root}/table", store, now)
    return read_published(spark, store, "customer_dim")


# ------------------------------------------------------------------ tagged_load
@register("tagged_load", """
SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders
""")
def q_tagged_load(spark, sf):
    root = work_dir(spark, "tagged_load")
    store = PositionStore(spark, f"{root}/positions")
    target = Target(root=f"{root}/fact", dedup="new", keys=["o_orderkey"])
    src = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    # two transform views feeding one destination, one topic per #tag
    views = {
        "open": "SELECT o_orderkey, o_orderstatus, o_orderdate FROM {block} WHERE o_orderstatus = 'O'",
        "rest": "SELECT o_orderkey, o_orderstatus, o_orderdate FROM {block} WHERE o_orderstatus <> 'O'",
    }
    for tag, sql in views.items():
        drain_planned(spark, f"orders_copy#{tag}", src, sql_transform(sql), target, store,
                      D(2024, 2, 1), gate=FAR_GATE, max_step=10000, pos="o_orderdate", id="o_orderkey")
    return read_fact(spark, target.root, store).drop("block_id")


# ------------------------------------------------------------------ stream_load
@register("stream_load", """
SELECT event_id, ts, user_id, event_type, value FROM events
""")
def q_stream_load(spark, sf):
    root = work_dir(spark, "stream_load")
    ev = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    # land the stage as several files in time order, the way an ingest would
    ev.repartitionByRange(6, "ts").write.mode("overwrite").parquet(f"{root}/stage")
    target = Target(root=f"{root}/fact", dedup="new", keys=["event_id"])
    src = file_stream(spark, f"{root}/stage", ev.schema, max_files=2)
    store = PositionStore(spark, f"{root}/positions")
    stream_load(spark, src, "event_stream", lambda b: b, target, f"{root}/checkpoint", store, pos="ts", id="event_id")
    return read_fact(spark, target.root, store).drop("block_id")


# ------------------------------------------------------------------ watermark_gate
@register("watermark_gate", """
WITH c AS (
  SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start,
         CAST(date_trunc('day', ts) + INTERVAL 1 DAY AS TIMESTAMP) AS window_end,
         event_type AS source, count(*) AS n
  FROM events WHERE event_type IN ('view', 'error') GROUP BY 1, 2, 3)
SELECT * FROM c
WHERE window_end <= (SELECT min(m) - INTERVAL 1 HOUR
                     FROM (SELECT max(ts) AS m FROM events WHERE event_type IN ('view', 'error') GROUP BY event_type))
""")
def q_watermark_gate(spark, sf):
    from ..streaming.stream import gated_window_counts
    root = work_dir(spark, "watermark_gate")
    ev = table(spark, sf, "events")
    sources = {}
    for t in ("view", "error"):
        feed = ev.filter(F.col("event_type") == t).select("ts", "event_id")
        # land each feed week by week, in time order (file streams read by modification time); only weeks that have rows
        week = F.date_trunc("week", "ts").cast("timestamp_ntz")
        weeks = [r["w"] for r in feed.filter("ts is not null").select(week.alias("w")).distinct().orderBy("w").collect()]
        feed.limit(0).write.mode("append").parquet(f"{root}/{t}")
        for lo in weeks:
            hi = lo + _dt.timedelta(days=7)
            feed.filter((F.col("ts") >= ts_lit(lo)) & (F.col("ts") < ts_lit(hi))).sortWithinPartitions("ts") \
                .write.mode("append").parquet(f"{root}/{t}")
        sources[t] = (file_stream(spark, f"{root}/{t}", feed.schema, max_files=2), "ts")
    return gated_window_counts(spark, sources, "1 hour", "1 day", f"{root}/out", f"{root}/checkpoint")


# ------------------------------------------------------------------ compact_blocks (K6 on a load's folders)
@register("compact_blocks", """
SELECT o_orderkey, o_orderstatus, o_orderdate, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice FROM orders
""")
def q_compact_blocks(spark, sf):
    root = work_dir(spark, "compact_blocks")
    store = PositionStore(spark, f"{root}/positions")
    target = Target(root=f"{root}/fact", dedup="new", keys=["o_orderkey"], partition_by=["o_year"])
    src = table(spark, sf, "orders")

    def transform(block):
        return block.select("o_orderkey", "o_orderstatus", "o_orderdate",
                            F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
                            F.year("o_orderdate").alias("o_year"))

    drain_planned(spark, "orders_by_year", src, transform, target, store, D(2024, 2, 1), gate=FAR_GATE,
                  max_step=4000, pos="o_orderdate", id="o_orderkey")
    compact_blocks(spark, "orders_by_year", target, store, D(2024, 2, 1))
    return read_fact(spark, target.root, store).drop("block_id", "o_year")


# ------------------------------------------------------------------ load_log (Q1 + Q2 from a real load)
@register("load_log", """
SELECT 'orders_checked' AS topic, count(*) AS rows, max(o_orderkey) AS max_id, min(o_orderdate) AS min_ts,
       max(o_orderdate) AS max_ts,
       concat_ws(',',
         CASE WHEN count(*) FILTER (WHERE o_totalprice > 300000) > 0
              THEN 'high_price=' || count(*) FILTER (WHERE o_totalprice > 300000) END,
         CASE WHEN count(*) FILTER (WHERE o_orderpriority = '1-URGENT') > 0
              THEN 'urgent=' || count(*) FILTER (WHERE o_orderpriority = '1-URGENT') END) AS nulls
FROM orders
""")
def q_load_log(spark, sf):
    from ..operators.audit import merge_log
    from .catalog_aggs import _map_text
    root = work_dir(spark, "load_log")
    store = PositionStore(spark, f"{root}/positions")
    target = Target(root=f"{root}/fact", dedup=None, log_ts="o_orderdate", log_id="o_orderkey",
                    checks={"high_price": F.col("o_totalprice") > 300000,
                            "urgent": F.col("o_orderpriority") == "1-URGENT"})
    src = table(spark, sf, "orders")
    drain_planned(spark, "orders_checked", src, lambda b: b.select("o_orderkey", "o_orderdate", "o_totalprice",
                                                                    "o_orderpriority"),
                  target, store, D(2024, 2, 1), gate=FAR_GATE, max_step=5000, pos="o_orderdate", id="o_orderkey")
    merged = merge_log(store.block_log())
    return merged.select("topic", "rows", "max_id", "min_ts", "max_ts", _map_text("nulls").alias("nulls"))
