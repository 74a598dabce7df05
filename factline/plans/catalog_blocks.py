"""Catalogue: wide fact, block predicates, block planning, gate, readiness (B*, G*, J1)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..functions.exprs import position
from ..operators.gate import dep_gate_df, position_report, readiness, source_positions
from ..operators.lookup import build_fact
from ..operators.positions import (Position, block_filter, block_numbers, next_block, next_block_uniq,
                                   pending, range_series)
from .registry import register, table

D = _dt.datetime

# ------------------------------------------------------------------ fact_build
FB_LAST = Position(D(1996, 1, 1), 0)
FB_NEXT = Position(D(1996, 12, 31), 7000)


def fact_transform(orders, customer, nation, region):
    """The wide order fact of one block: orders -> customer -> nation -> region."""
    f = build_fact(orders, [
        (customer, [("o_custkey", "c_custkey")], ["c_name", "c_mktsegment", "c_nationkey"]),
        (nation, [("c_nationkey", "n_nationkey")], ["n_name", "n_regionkey"]),
        (region, [("n_regionkey", "r_regionkey")], ["r_name"]),
    ])
    return f.select("o_orderkey", "o_orderdate", "o_custkey", "c_name", "c_mktsegment", "n_name", "r_name",
                    F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"), "o_orderstatus")


FACT_SQL = """
SELECT o.o_orderkey, o.o_orderdate, o.o_custkey, c.c_name, c.c_mktsegment, n.n_name, r.r_name,
       CAST(o.o_totalprice AS DECIMAL(18,2)) AS o_totalprice, o.o_orderstatus
FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""


@register("fact_build", FACT_SQL + """
WHERE (o.o_orderdate > TIMESTAMP '1996-01-01 00:00:00'
       OR (o.o_orderdate = TIMESTAMP '1996-01-01 00:00:00' AND o.o_orderkey > 0))
  AND (o.o_orderdate < TIMESTAMP '1996-12-31 00:00:00'
       OR (o.o_orderdate = TIMESTAMP '1996-12-31 00:00:00' AND o.o_orderkey <= 7000))
""")
def q_fact_build(spark, sf):
    orders = block_filter(table(spark, sf, "orders"), FB_LAST, FB_NEXT, "o_orderdate", "o_orderkey")
    return fact_transform(orders, table(spark, sf, "customer"), table(spark, sf, "nation"),
                          table(spark, sf, "region"))


# ------------------------------------------------------------------ block_filter (B1)
def _edge(events, event_id):
    r = events.filter(F.col("event_id") == event_id).select("ts", "event_id").first()
    return Position(r["ts"], int(r["event_id"]))


@register("block_filter", """
WITH m AS (SELECT max(event_id) AS mx FROM events),
l AS (SELECT ts AS lp, event_id AS li FROM events WHERE event_id = (SELECT mx // 10 FROM m)),
n AS (SELECT ts AS np, event_id AS ni FROM events WHERE event_id = (SELECT mx // 2 FROM m))
SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value
FROM events e, l, n
WHERE (e.ts > l.lp OR (e.ts = l.lp AND e.event_id > l.li))
  AND (e.ts < n.np OR (e.ts = n.np AND e.event_id <= n.ni))
""")
def q_block_filter(spark, sf):
    ev = table(spark, sf, "events")
    mx = ev.agg(F.max("event_id")).first()[0]
    last, nxt = _edge(ev, mx // 10), _edge(ev, mx // 2)
    return block_filter(ev, last, nxt, "ts", "event_id").select("event_id", "ts", "user_id", "event_type", "value")


# ------------------------------------------------------------------ next_block
def _block_row(spark, blk):
    return spark.createDataFrame(
        [(int(blk.rows), blk.next.pos if blk.next else None, blk.next.id if blk.next else None, bool(blk.full))],
        "rows bigint, next_pos timestamp_ntz, next_id bigint, full boolean")


NB_LAST = Position(D(1996, 1, 1), 5000)
NB_GATE = D(1999, 1, 1)


@register("next_block", """
WITH d AS (
  SELECT o_orderdate AS pos, o_orderkey AS id FROM orders
  WHERE (o_orderdate > TIMESTAMP '1996-01-01 00:00:00'
         OR (o_orderdate = TIMESTAMP '1996-01-01 00:00:00' AND o_orderkey > 5000))
    AND o_orderdate < TIMESTAMP '1999-01-01 00:00:00'
  ORDER BY pos, id LIMIT 1000)
SELECT CAST(count(*) AS BIGINT) AS rows,
       (SELECT pos FROM d ORDER BY pos DESC, id DESC LIMIT 1) AS next_pos,
       (SELECT id FROM d ORDER BY pos DESC, id DESC LIMIT 1) AS next_id,
       count(*) >= 1000 AS full
FROM d
""")
def q_next_block(spark, sf):
    blk = next_block(table(spark, sf, "orders"), NB_LAST, NB_GATE, 1000, "o_orderdate", "o_orderkey")
    return _block_row(spark, blk)


@register("next_block_uniq", """
WITH d AS (
  SELECT max(l_shipdate) AS pos, l_orderkey AS id FROM lineitem
  WHERE (l_shipdate > TIMESTAMP '1996-01-01 00:00:00'
         OR (l_shipdate = TIMESTAMP '1996-01-01 00:00:00' AND l_orderkey > 0))
    AND l_shipdate < TIMESTAMP '1998-01-01 00:00:00'
  GROUP BY l_orderkey
  ORDER BY pos, id LIMIT 1000)
SELECT CAST(count(*) AS BIGINT) AS rows,
       (SELECT pos FROM d ORDER BY pos DESC, id DESC LIMIT 1) AS next_pos,
       (SELECT id FROM d ORDER BY pos DESC, id DESC LIMIT 1) AS next_id,
       count(*) >= 1000 AS full
FROM d
""")
def q_next_block_uniq(spark, sf):
    blk = next_block_uniq(table(spark, sf, "lineitem"), Position(D(1996, 1, 1), 0), D(1998, 1, 1), 1000,
                          "l_shipdate", "l_orderkey")
    return _block_row(spark, blk)


# ------------------------------------------------------------------ range_block
RB_LAST = Position(D(2024, 1, 1), 0)
RB_STEP, RB_DELAY, RB_NOW = 6 * 3600, 3600, D(2024, 1, 30, 12)
_RB_N = -(-int((RB_NOW - _dt.timedelta(seconds=RB_DELAY) - RB_LAST.pos).total_seconds()) // RB_STEP)


@register("range_block", f"""
WITH w AS (
  SELECT k,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds(k * {RB_STEP}) AS ws,
         least(TIMESTAMP '2024-01-01 00:00:00' + to_seconds((k + 1) * {RB_STEP}),
               TIMESTAMP '2024-01-30 11:00:00') AS we
  FROM range(0, {_RB_N}) t(k))
SELECT w.k AS window_no, w.ws AS window_start, w.we AS window_end, count(e.event_id) AS rows
FROM w LEFT JOIN events e
  ON (e.ts > w.ws OR (e.ts = w.ws AND e.event_id > 0)) AND (e.ts < w.we OR (e.ts = w.we AND e.event_id <= 0))
GROUP BY w.k, w.ws, w.we
""")
def q_range_block(spark, sf):
    return range_series(table(spark, sf, "events"), RB_LAST, RB_STEP, RB_DELAY, RB_NOW, "ts", "event_id")


# ------------------------------------------------------------------ block_series
@register("block_series", """
SELECT o_orderkey, o_orderdate,
       CAST((row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 1000 AS BIGINT) AS block_no
FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01 00:00:00'
""")
def q_block_series(spark, sf):
    o = pending(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), None, D(2001, 1, 1),
                "o_orderdate", "o_orderkey")
    return block_numbers(o, 1000, "o_orderdate", "o_orderkey").select("o_orderkey", "o_orderdate", "block_no")


# ------------------------------------------------------------------ dep_gate
DG_NOW, DG_DELAY = D(2024, 2, 1), 3600


@register("dep_gate", """
WITH p AS (
  SELECT 'orders' AS topic, max(o_orderdate) AS pos FROM orders
  UNION ALL SELECT 'lineitem', max(l_shipdate) FROM lineitem
  UNION ALL SELECT 'events', max(ts) FROM events)
SELECT least(min(pos), TIMESTAMP '2024-01-31 23:00:00') AS gate,
       (SELECT topic FROM p ORDER BY pos, topic LIMIT 1) AS laggard,
       CAST(count(*) AS BIGINT) AS found
FROM p
""")
def q_dep_gate(spark, sf):
    pos = source_positions(spark, {
        "orders": (table(spark, sf, "orders"), "o_orderdate", "o_orderkey"),
        "lineitem": (table(spark, sf, "lineitem"), "l_shipdate", "l_orderkey"),
        "events": (table(spark, sf, "events"), "ts", "event_id"),
    })
    return dep_gate_df(pos, ["orders", "lineitem", "events"], DG_DELAY, DG_NOW)


def type_positions(events):
    """Each event type as a source: its newest (ts, event_id), row count and last move."""
    return events.groupBy(F.col("event_type").alias("topic")).agg(
        F.max(position("ts", "event_id")).alias("last"), F.count(F.lit(1)).alias("rows"),
        F.max("ts").alias("run"))


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


# ------------------------------------------------------------------ gated_pending (B2, G1)
@register("gated_pending", """
WITH p AS (SELECT event_type AS topic, max(ts) AS pos FROM events GROUP BY event_type),
g AS (SELECT least(min(pos), TIMESTAMP '2024-02-01 00:00:00') AS gate,
             (SELECT topic FROM p ORDER BY pos, topic LIMIT 1) AS laggard FROM p)
SELECT g.gate, g.laggard, (SELECT count(*) FROM events WHERE ts < g.gate) AS rows FROM g
""")
def q_gated_pending(spark, sf):
    ev = table(spark, sf, "events")
    g = dep_gate_df(type_positions(ev), EVENT_TYPES, 0, D(2024, 2, 1)).first()
    rows = pending(ev, None, g["gate"], "ts", "event_id").count() if g["gate"] else 0
    return spark.createDataFrame([(g["gate"], g["laggard"], rows)],
                                 "gate timestamp_ntz, laggard string, rows bigint")


# ------------------------------------------------------------------ readiness
RD_NOW = D(2024, 2, 1, 1, 0)
# The inline lineage of the readiness query.
RD_PIPELINES = [
    ("fact_a", "view,click", "", "1h", "", D(2024, 1, 30), D(2024, 1, 31), "Step", ""),
    ("fact_b", "purchase,error", "30m", "", "", D(2024, 1, 30, 23, 30), D(2024, 1, 31), "Step", ""),
    ("fact_c", "view,missing_src", "", "5m", "22:00-2:00", D(2024, 1, 29), D(2024, 1, 31, 23, 58), "Step", ""),
    ("fact_d", "signup", "", "", "0:30-6:00", D(2024, 1, 31, 12), D(2024, 2, 1, 0, 59), "FullStep", ""),
    ("fact_e", "nothing1,nothing2", "", "", "", D(2024, 1, 1), D(2024, 1, 1), "Step", ""),
    ("fact_f", "click", "2h", "", "3:00-4:00", D(2024, 1, 20), D(2024, 1, 31), "Step", ""),
    ("fact_g", "view", "", "2d", "", D(2024, 1, 30), D(2024, 1, 31), "Step", ""),
    ("fact_h", "view, error", "1h 30m", "10m", "0:00-0:59", D(2024, 1, 30), D(2024, 2, 1), "FullStep", "host1"),
]
PIPELINE_SCHEMA = ("table string, depends_on string, delay string, repeat string, time string, "
                   "last timestamp_ntz, run timestamp_ntz, processor string, hostid string")


def _values_sql(rows):
    def lit(v):
        if isinstance(v, D):
            return f"TIMESTAMP '{v.isoformat(sep=' ')}'"
        return "'" + str(v).replace("'", "''") + "'"
    return ",\n  ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


def _delta_sql(col, default):
    unit = ("CASE lower(regexp_extract(x, '([A-Za-z]+)', 1)) "
            "WHEN 's' THEN 1 WHEN 'sec' THEN 1 WHEN 'second' THEN 1 WHEN 'seconds' THEN 1 "
            "WHEN 'm' THEN 60 WHEN 'min' THEN 60 WHEN 'minute' THEN 60 WHEN 'minutes' THEN 60 "
            "WHEN 'h' THEN 3600 WHEN 'hour' THEN 3600 WHEN 'hours' THEN 3600 "
            "WHEN 'd' THEN 86400 WHEN 'day' THEN 86400 WHEN 'days' THEN 86400 "
            "WHEN 'w' THEN 604800 WHEN 'week' THEN 604800 WHEN 'weeks' THEN 604800 END")
    return (f"CASE WHEN trim({col}) = '' THEN {default} ELSE "
            f"list_sum(list_transform(regexp_extract_all({col}, '(\\d+)\\s*([A-Za-z]+)', 0), "
            f"lambda x: CAST(regexp_extract(x, '(\\d+)', 1) AS BIGINT) * {unit})) END")


READINESS_SQL = f"""
WITH pl AS (
  SELECT * FROM (VALUES
  {_values_sql(RD_PIPELINES)}
  ) t("table", depends_on, delay, "repeat", "time", "last", run, processor, hostid)),
p AS (SELECT event_type AS dep, max(ts) AS dep_pos FROM events GROUP BY event_type),
x AS (SELECT pl.*, trim(d.dep) AS dep,
             {_delta_sql('pl.delay', 0)} AS delay_s,
             {_delta_sql('pl."repeat"', 3600)} AS repeat_s
      FROM pl, unnest(string_split(pl.depends_on, ',')) AS d(dep)),
g AS (
  SELECT x."table", any_value(x."last") AS "last", any_value(x.run) AS run, any_value(x.processor) AS processor,
         any_value(x.hostid) AS hostid, any_value(x.delay_s) AS delay_s, any_value(x.repeat_s) AS repeat_s,
         any_value(x."time") AS "time", min(p.dep_pos) AS mins, count(p.dep_pos) AS found
  FROM x LEFT JOIN p ON x.dep = p.dep GROUP BY x."table"),
h AS (
  SELECT *, CASE WHEN found > 0 THEN least(mins, TIMESTAMP '{RD_NOW.isoformat(sep=' ')}' - to_seconds(delay_s)) END AS gate,
         TRY_CAST(regexp_extract("time", '^\\s*(\\d+):(\\d+)', 1) AS INT) * 60
           + TRY_CAST(regexp_extract("time", '^\\s*(\\d+):(\\d+)', 2) AS INT) AS w_start,
         TRY_CAST(regexp_extract("time", '-\\s*(\\d+):(\\d+)\\s*$', 1) AS INT) * 60
           + TRY_CAST(regexp_extract("time", '-\\s*(\\d+):(\\d+)\\s*$', 2) AS INT) AS w_end,
         {RD_NOW.hour * 60 + RD_NOW.minute} AS m
  FROM g)
SELECT "table", gate, CAST(found AS BIGINT) AS found,
  coalesce(
    ((processor LIKE 'Full%' AND hostid = '')
      OR ("last" < gate AND date_sub('second', run, TIMESTAMP '{RD_NOW.isoformat(sep=' ')}') > repeat_s))
    AND ("time" = ''
      OR (w_start <= w_end AND m >= w_start AND m <= w_end)
      OR (w_start > w_end AND (m >= w_start OR m <= w_end))
      OR "last" < TIMESTAMP '{RD_NOW.isoformat(sep=' ')}' - INTERVAL 1 DAY), false) AS ready
FROM h
"""


@register("readiness", READINESS_SQL)
def q_readiness(spark, sf):
    pipelines = spark.createDataFrame(RD_PIPELINES, PIPELINE_SCHEMA)
    return readiness(pipelines, type_positions(table(spark, sf, "events")), RD_NOW)


# ------------------------------------------------------------------ position_report
PR_NOW = D(2024, 2, 1)


@register("position_report", """
SELECT event_type AS topic, max(ts) AS "last", date_sub('second', max(ts), TIMESTAMP '2024-02-01 00:00:00') AS elapsed_s,
       count(*) AS rows
FROM events GROUP BY event_type
""")
def q_position_report(spark, sf):
    pos = type_positions(table(spark, sf, "events"))
    stub = spark.createDataFrame([("stub_source", (D(2099, 12, 31), 0), 0, D(2024, 1, 1))],
                                 "topic string, last struct<pos:timestamp_ntz,id:bigint>, rows bigint, "
                                 "run timestamp_ntz")
    rep = position_report(pos.unionByName(stub), PR_NOW)
    return rep.select("topic", "last", "elapsed_s", "rows")
