"""Catalogue: latest row, dedup, lookups, prefilters, nesting, repair, late rows, shards (W1, S6, L*, J*, B10, B12)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..functions.exprs import ts_lit
from ..operators.lookup import (dim_lookup, kv_join, latest, nest_children_chunked, new_rows, prefilter_in,
                                prefilter_range, repair_missing, write_bucketed)
from ..operators.positions import Position, block_filter, late_rows, shard_filter
from ..session import work_dir
from ..sources.stage import stage_dedup
from .registry import register, table

D = _dt.datetime
LI_KEY = ["l_orderkey", "l_linenumber"]
LI_VERSION = ["l_shipdate", "l_partkey", "l_suppkey"]


def li_cols(df):
    return df.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity",
                     F.col("l_extendedprice").cast("decimal(18,2)").alias("l_extendedprice"))


LI_SQL_COLS = ("l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, "
               "CAST(l_extendedprice AS DECIMAL(18,2)) AS l_extendedprice")


# ------------------------------------------------------------------ latest_per_key
@register("latest_per_key", f"""
SELECT {LI_SQL_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn
  FROM lineitem) WHERE rn = 1
""")
def q_latest_per_key(spark, sf):
    return li_cols(latest(table(spark, sf, "lineitem"), LI_KEY, LI_VERSION))


# ------------------------------------------------------------------ stage_dedup
@register("stage_dedup", """
WITH k AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate, l_partkey, l_suppkey) AS rn FROM lineitem)
SELECT (SELECT count(*) FROM lineitem) AS rows_before, count(*) AS rows_after,
       sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS kept_total,
       CAST(min(l_shipdate) AS TIMESTAMP) AS first_ship
FROM k WHERE rn = 1
""")
def q_stage_dedup(spark, sf):
    li = table(spark, sf, "lineitem")
    kept = stage_dedup(li, LI_KEY, LI_VERSION, keep="first")
    before = li.agg(F.count(F.lit(1)).alias("rows_before"))   # one row, as the other side of the join
    after = kept.agg(F.count(F.lit(1)).alias("rows_after"),
                     F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("kept_total"),
                     F.min("l_shipdate").alias("first_ship"))
    return before.crossJoin(after)


# ------------------------------------------------------------------ dedup_insert (L3)
@register("dedup_insert", """
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey) AS rn
      FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01 00:00:00') b
WHERE rn = 1
  AND NOT EXISTS (SELECT 1 FROM lineitem f
                  WHERE f.l_shipdate < TIMESTAMP '2000-01-01 00:00:00'
                    AND f.l_orderkey = b.l_orderkey AND f.l_linenumber = b.l_linenumber)
""")
def q_dedup_insert(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey")
    split = ts_lit(D(2000, 1, 1))
    fact = li.filter(F.col("l_shipdate") < split)
    block = li.filter(F.col("l_shipdate") >= split)
    return new_rows(block, fact, LI_KEY, order=["l_shipdate", "l_partkey", "l_suppkey"])


# ------------------------------------------------------------------ kv_lookup (L1)
@register("kv_lookup", """
SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment, CAST(c.c_acctbal AS DECIMAL(18,2)) AS c_acctbal
FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o.o_custkey = c.c_custkey
""")
def q_kv_lookup(spark, sf):
    block = table(spark, sf, "orders")
    kv = table(spark, sf, "customer").filter(F.col("c_acctbal") > 0)
    j = kv_join(block, kv, [("o_custkey", "c_custkey")], kv_order=["c_acctbal"], kv_keys=["c_custkey"])
    return j.select("o_orderkey", "o_custkey", "c_name", "c_mktsegment",
                    F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal"))


@register("kv_lookup_composite", """
WITH kv AS (
  SELECT user_id, event_type, ts AS prev_ts, value AS prev_value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
    FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00') WHERE rn = 1)
SELECT e.event_id, e.user_id, e.event_type, kv.prev_ts, kv.prev_value
FROM events e LEFT JOIN kv ON e.user_id = kv.user_id AND e.event_type = kv.event_type
WHERE e.ts >= TIMESTAMP '2024-01-15 00:00:00'
""")
def q_kv_lookup_composite(spark, sf):
    ev = table(spark, sf, "events")
    cut = ts_lit(D(2024, 1, 15))
    block = ev.filter(F.col("ts") >= cut).select("event_id", "user_id", "event_type")
    kv = ev.filter(F.col("ts") < cut).select("user_id", "event_type", F.col("event_id").alias("prev_id"),
                                             F.col("ts").alias("prev_ts"), F.col("value").alias("prev_value"))
    j = kv_join(block, kv, ["user_id", "event_type"], kv_order=["prev_ts", "prev_id"])
    return j.select("event_id", "user_id", "event_type", "prev_ts", "prev_value")


# ------------------------------------------------------------------ dim_lookup (L2)
@register("dim_lookup", """
SELECT c.c_custkey, c.c_nationkey, coalesce(n.n_name, 'unknown') AS n_name, coalesce(n.n_regionkey, -1) AS n_regionkey
FROM customer c LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <= 2) n ON c.c_nationkey = n.n_nationkey
""")
def q_dim_lookup(spark, sf):
    dim = table(spark, sf, "nation").filter(F.col("n_regionkey") <= 2)
    out = dim_lookup(table(spark, sf, "customer"), dim, [("c_nationkey", "n_nationkey")], ["n_name", "n_regionkey"],
                     {"n_name": "unknown", "n_regionkey": -1})
    return out.select("c_custkey", "c_nationkey", "n_name", "n_regionkey")


# ------------------------------------------------------------------ prefilter_in / prefilter_range
PF_SQL = """
SELECT o.o_orderkey, o.o_orderdate, l.l_linenumber, l.l_partkey, l.l_shipdate
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE o.o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' AND o.o_orderdate < TIMESTAMP '1996-07-01 00:00:00'
"""


def _pf_block(spark, sf):
    o = table(spark, sf, "orders")
    return o.filter((F.col("o_orderdate") >= ts_lit(D(1996, 1, 1))) & (F.col("o_orderdate") < ts_lit(D(1996, 7, 1)))) \
        .select("o_orderkey", "o_orderdate")


def _pf_join(block, right):
    j = block.join(right, block["o_orderkey"] == right["l_orderkey"])
    return j.select("o_orderkey", "o_orderdate", "l_linenumber", "l_partkey", "l_shipdate")


@register("prefilter_in", PF_SQL)
def q_prefilter_in(spark, sf):
    block = _pf_block(spark, sf)
    li = table(spark, sf, "lineitem")
    right = prefilter_in(li, block.select(F.col("o_orderkey").alias("l_orderkey")), ["l_orderkey"])
    return _pf_join(block, right)


@register("prefilter_range", PF_SQL)
def q_prefilter_range(spark, sf):
    block = _pf_block(spark, sf)
    right = prefilter_range(table(spark, sf, "lineitem"), block, "o_orderkey", "l_orderkey")
    return _pf_join(block, right)


# ------------------------------------------------------------------ nest_children
NEST_CHUNK = 4   # children per nested row; a busy parent spans several rows


@register("nest_children", f"""
WITH l AS (
  SELECT l.*, (row_number() OVER (PARTITION BY l_orderkey
                                  ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey) - 1) // {NEST_CHUNK} AS chunk_no
  FROM lineitem l)
SELECT o.o_orderkey, CAST(coalesce(l.chunk_no, 0) AS INT) AS chunk_no, CAST(count(l.l_orderkey) AS BIGINT) AS n_lines,
       coalesce(string_agg(CAST(l.l_linenumber AS VARCHAR) || ':' || CAST(l.l_partkey AS VARCHAR), ','
                           ORDER BY l.l_linenumber, l.l_shipdate, l.l_partkey, l.l_suppkey), '') AS lines
FROM orders o LEFT JOIN l ON o.o_orderkey = l.l_orderkey
GROUP BY o.o_orderkey, l.chunk_no
""")
def q_nest_children(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    li = table(spark, sf, "lineitem")
    nested = nest_children_chunked(o.withColumnRenamed("o_orderkey", "l_orderkey"), li, "l_orderkey",
                                   ["l_linenumber", "l_shipdate", "l_partkey", "l_suppkey"], [], NEST_CHUNK,
                                   "children")
    return nested.select(
        F.col("l_orderkey").alias("o_orderkey"), "chunk_no",
        F.coalesce(F.size("children"), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.array_join(F.transform("children", lambda c: F.concat(
            c["l_linenumber"].cast("string"), F.lit(":"), c["l_partkey"].cast("string"))), ","), F.lit(""))
        .alias("lines"))


# ------------------------------------------------------------------ repair_missing
@register("repair_missing", """
SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_mktsegment
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
""")
def q_repair_missing(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf, "customer")
    early = dim_lookup(o, cust.filter(F.col("c_acctbal") > 0), [("o_custkey", "c_custkey")],
                       ["c_name", "c_mktsegment"])
    return repair_missing(early, cust, [("o_custkey", "c_custkey")], ["c_name", "c_mktsegment"])


# ------------------------------------------------------------------ late_rows
@register("late_rows", """
WITH m AS (SELECT max(event_id) AS mx FROM events),
l AS (SELECT ts AS lp, event_id AS li FROM events WHERE event_id = (SELECT mx // 2 FROM m)),
fact AS (SELECT e.event_id FROM events e, l
         WHERE (e.ts < l.lp OR (e.ts = l.lp AND e.event_id <= l.li)) AND e.event_type <> 'error')
SELECT e.event_id, e.ts, e.event_type FROM events e, l
WHERE (e.ts < l.lp OR (e.ts = l.lp AND e.event_id <= l.li))
  AND NOT EXISTS (SELECT 1 FROM fact f WHERE f.event_id = e.event_id)
""")
def q_late_rows(spark, sf):
    ev = table(spark, sf, "events")
    mx = ev.agg(F.max("event_id")).first()[0]
    r = ev.filter(F.col("event_id") == mx // 2).select("ts", "event_id").first()
    last = Position(r["ts"], int(r["event_id"]))
    # the destination as loaded up to `last`, with the error rows still on their way
    fact = block_filter(ev, None, last, "ts", "event_id").filter(F.col("event_type") != "error")
    return late_rows(ev, fact, last, ["event_id"], "ts", "event_id").select("event_id", "ts", "event_type")


# ------------------------------------------------------------------ shard_union
@register("shard_union", """
SELECT CAST(o_orderkey % 2 AS INT) AS shard, count(*) AS rows, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
FROM orders GROUP BY o_orderkey % 2
""")
def q_shard_union(spark, sf):
    o = table(spark, sf, "orders")
    parts = [shard_filter(o, "o_orderkey", 2, i).agg(
        F.lit(i).alias("shard"), F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("total")) for i in range(2)]
    return parts[0].unionByName(parts[1])


# ------------------------------------------------------------------ computed-key inner join
@register("computed_key_join", """
SELECT e.event_id, e.user_id, c.c_name
FROM events e JOIN customer c ON ('user-' || CAST(e.user_id AS VARCHAR)) = ('user-' || CAST(c.c_custkey AS VARCHAR))
""")
def q_computed_key_join(spark, sf):
    ev = table(spark, sf, "events").withColumn("k", F.concat(F.lit("user-"), F.col("user_id").cast("string")))
    cu = table(spark, sf, "customer").withColumn("k", F.concat(F.lit("user-"), F.col("c_custkey").cast("string")))
    return ev.join(cu, "k").select("event_id", "user_id", "c_name")


# ------------------------------------------------------------------ bucket_join
@register("bucket_join", """
SELECT o.o_orderkey, count(*) AS n_lines, sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS revenue
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY o.o_orderkey
""")
def q_bucket_join(spark, sf):
    root = work_dir(spark, "bucket_join")
    tag = root.rsplit("-", 1)[-1]
    o = write_bucketed(table(spark, sf, "orders").select("o_orderkey"), f"fl_orders_{tag}", f"{root}/orders",
                       ["o_orderkey"], keep=False)
    li = write_bucketed(table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_extendedprice"), f"fl_lineitem_{tag}", f"{root}/lineitem",
        ["o_orderkey"], keep=False)
    # both sides are large facts in the intended use: keep the sort-merge join, which the
    # shared bucketing serves without any exchange (a broadcast would hide that at small scale)
    return o.hint("merge").join(li, "o_orderkey").groupBy("o_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("revenue"))
