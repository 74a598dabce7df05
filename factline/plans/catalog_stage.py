"""Catalogue: stage preparation and scalar functions (S1-S7, section 2.11)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..functions.exprs import (bytes_to_uuid, or_zero_decimal, or_zero_int, or_zero_timestamp, readable_delta,
                               readable_quantity, readable_size, split_part, time_delta_seconds, topic_parts)
from ..operators.positions import Position
from ..sources.stage import infer_stage, parse_envelope, pull_window, read_cdc, stamp, to_envelope
from .registry import register, table

D = _dt.datetime


# ------------------------------------------------------------------ envelope_roundtrip
@register("envelope_roundtrip", """
SELECT 'shop' AS database, 'events' AS "table", epoch_us(ts) // 1000 AS env_ts, event_id AS xid,
       event_id, ts, user_id, event_type, value, props FROM events
""")
def q_envelope_roundtrip(spark, sf):
    ev = table(spark, sf, "events")
    env = to_envelope(ev, "shop", "events", ts="ts", id="event_id", unit="MILLISECOND")
    good, bad = parse_envelope(env, ev.schema)
    return good.select("database", "table", F.col("ts").alias("env_ts"), "xid", "data.*")


# ------------------------------------------------------------------ json_stage
@register("json_stage", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""")
def q_json_stage(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "props")
    return infer_stage(ev, "props").select("event_id", "k")


# ------------------------------------------------------------------ or_zero_casts (section 2.11)
@register("or_zero_casts", """
SELECT o_orderkey,
       COALESCE(TRY_CAST(o_orderpriority AS INT), 0) AS prio_whole,
       COALESCE(TRY_CAST(split_part(o_orderpriority, '-', 1) AS INT), 0) AS prio_num,
       COALESCE(TRY_CAST(CAST(o_orderkey AS VARCHAR) || '.4565' AS DECIMAL(18,3)), 0) AS amount,
       COALESCE(TRY_CAST('x' || CAST(o_orderkey AS VARCHAR) AS DECIMAL(18,3)), 0) AS bad_amount
FROM orders
""")
def q_or_zero_casts(spark, sf):
    o = table(spark, sf, "orders")
    key = F.col("o_orderkey").cast("string")
    return o.select("o_orderkey", or_zero_int("o_orderpriority").alias("prio_whole"),
                    or_zero_int(split_part("o_orderpriority", "-", 1)).alias("prio_num"),
                    or_zero_decimal(F.concat(key, F.lit(".4565"))).alias("amount"),
                    or_zero_decimal(F.concat(F.lit("x"), key)).alias("bad_amount"))


@register("or_zero_props", """
SELECT event_id,
       COALESCE(TRY_CAST(regexp_extract(props, '"k":\\s*([0-9.]+)', 1) AS DECIMAL(18,3)), 0) AS k_dec,
       COALESCE(TRY_CAST(CAST(ts AS VARCHAR) AS TIMESTAMP), TIMESTAMP '1970-01-01 00:00:00') AS ts_back,
       COALESCE(TRY_CAST(CASE WHEN value > 40 THEN 'n/a' ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS TIMESTAMP),
                TIMESTAMP '1970-01-01 00:00:00') AS day_or_zero
FROM events
""")
def q_or_zero_props(spark, sf):
    ev = table(spark, sf, "events")
    txt = F.when(F.col("value") > 40, F.lit("n/a")).otherwise(F.to_date("ts").cast("string"))
    return ev.select("event_id",
                     or_zero_decimal(F.regexp_extract("props", r'"k":\s*([0-9.]+)', 1)).alias("k_dec"),
                     or_zero_timestamp(F.col("ts").cast("string")).alias("ts_back"),
                     or_zero_timestamp(txt).alias("day_or_zero"))


# ------------------------------------------------------------------ time_delta (section 2.11)
_DELTA_UNIT_SQL = ("CASE lower(regexp_extract(x, '([A-Za-z]+)', 1)) "
                   "WHEN 's' THEN 1 WHEN 'sec' THEN 1 WHEN 'second' THEN 1 WHEN 'seconds' THEN 1 "
                   "WHEN 'm' THEN 60 WHEN 'min' THEN 60 WHEN 'minute' THEN 60 WHEN 'minutes' THEN 60 "
                   "WHEN 'h' THEN 3600 WHEN 'hour' THEN 3600 WHEN 'hours' THEN 3600 "
                   "WHEN 'd' THEN 86400 WHEN 'day' THEN 86400 WHEN 'days' THEN 86400 "
                   "WHEN 'w' THEN 604800 WHEN 'week' THEN 604800 WHEN 'weeks' THEN 604800 END")


@register("time_delta", f"""
WITH t AS (
  SELECT r_regionkey, unnest([
    '', CAST(r_regionkey AS VARCHAR) || 'm',
    CAST(r_regionkey + 1 AS VARCHAR) || 'h ' || CAST(r_regionkey * 15 AS VARCHAR) || 'm',
    CAST(r_regionkey AS VARCHAR) || 'd', 'junk', CAST(r_regionkey + 2 AS VARCHAR) || ' minutes',
    '1w ' || CAST(r_regionkey AS VARCHAR) || 'd 10s']) AS txt
  FROM region)
SELECT r_regionkey, txt,
  CASE WHEN trim(txt) = '' THEN 3600
       WHEN trim(regexp_replace(txt, '(\\d+)\\s*([A-Za-z]+)', '', 'g')) <> '' THEN NULL
       ELSE CAST(list_sum(list_transform(regexp_extract_all(txt, '(\\d+)\\s*([A-Za-z]+)', 0),
              lambda x: CAST(regexp_extract(x, '(\\d+)', 1) AS BIGINT) * {_DELTA_UNIT_SQL})) AS BIGINT) END AS seconds
FROM t
""")
def q_time_delta(spark, sf):
    r = table(spark, sf, "region")
    k = F.col("r_regionkey")
    s = lambda c: c.cast("string")
    texts = F.array(F.lit(""), F.concat(s(k), F.lit("m")),
                    F.concat(s(k + 1), F.lit("h "), s(k * 15), F.lit("m")),
                    F.concat(s(k), F.lit("d")), F.lit("junk"), F.concat(s(k + 2), F.lit(" minutes")),
                    F.concat(F.lit("1w "), s(k), F.lit("d 10s")))
    t = r.select("r_regionkey", F.explode(texts).alias("txt"))
    return t.select("r_regionkey", "txt", time_delta_seconds("txt", 3600).alias("seconds"))


# ------------------------------------------------------------------ readable (section 2.11)
def _fmt_sql(h):
    return f"(CAST(({h}) // 100 AS VARCHAR) || '.' || lpad(CAST(({h}) % 100 AS VARCHAR), 2, '0'))"


def _ladder_sql(x, base, units):
    parts = []
    for i, u in enumerate(units):
        d = base ** i
        h = f"CAST({x} AS HUGEINT) * 100" if d == 1 else f"(CAST({x} AS HUGEINT) * 100 + {d // 2}) // {d}"
        text = _fmt_sql(h) + (f" || ' {u}'" if u else "")
        if i < len(units) - 1:
            parts.append(f"WHEN CAST({x} AS HUGEINT) < {base ** (i + 1)} THEN {text}")
        else:
            parts.append(f"ELSE {text}")
    return "CASE " + " ".join(parts) + " END"


def _delta_sql(x):
    comps = []
    rest = f"CAST({x} AS BIGINT)"
    for name, size in (("day", 86400), ("hour", 3600), ("minute", 60), ("second", 1)):
        n = f"({rest} // {size})" if size > 1 else rest
        comps.append(f"CASE WHEN {n} > 0 THEN CAST({n} AS VARCHAR) || ' {name}' || CASE WHEN {n} > 1 THEN 's' ELSE '' END END")
        rest = f"({rest} % {size})" if size > 1 else rest
    lst = "list_filter([" + ", ".join(comps) + "], lambda c: c IS NOT NULL)"
    return (f"CASE WHEN len({lst}) = 0 THEN '0 seconds' WHEN len({lst}) = 1 THEN {lst}[1] "
            f"ELSE array_to_string({lst}[1:len({lst}) - 1], ', ') || ' and ' || {lst}[-1] END")


@register("readable", f"""
WITH g AS (
  SELECT l_returnflag, count(*) AS n, sum(CAST(floor(l_extendedprice) AS BIGINT)) AS bytes,
         date_sub('second', min(l_shipdate), max(l_shipdate)) AS span,
         CAST(sum(l_quantity) AS BIGINT) AS qty
  FROM lineitem GROUP BY l_returnflag)
SELECT l_returnflag,
       {_ladder_sql('n * 1000', 1000, ['', 'thousand', 'million', 'billion', 'trillion', 'quadrillion'])} AS n_text,
       {_ladder_sql('bytes', 1024, ['B', 'KiB', 'MiB', 'GiB', 'TiB', 'PiB'])} AS size_text,
       {_ladder_sql('qty', 1024, ['B', 'KiB', 'MiB', 'GiB', 'TiB', 'PiB'])} AS qty_text,
       {_delta_sql('span')} AS span_text,
       {_delta_sql('n')} AS n_delta_text
FROM g
""")
def q_readable(spark, sf):
    li = table(spark, sf, "lineitem")
    g = li.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.floor("l_extendedprice").cast("bigint")).alias("bytes"),
        F.timestamp_diff("SECOND", F.min("l_shipdate"), F.max("l_shipdate")).alias("span"),
        F.sum("l_quantity").cast("bigint").alias("qty"))
    return g.select("l_returnflag", readable_quantity(F.col("n") * 1000).alias("n_text"),
                    readable_size("bytes").alias("size_text"), readable_size("qty").alias("qty_text"),
                    readable_delta("span").alias("span_text"), readable_delta("n").alias("n_delta_text"))


# ------------------------------------------------------------------ bytes_to_uuid (section 2.11)
@register("bytes_to_uuid", """
SELECT c_custkey,
       substr(md5(c_name), 1, 8) || '-' || substr(md5(c_name), 9, 4) || '-' || substr(md5(c_name), 13, 4) || '-' ||
       substr(md5(c_name), 17, 4) || '-' || substr(md5(c_name), 21, 12) AS uuid
FROM customer
""")
def q_bytes_to_uuid(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", bytes_to_uuid(F.unhex(F.md5(F.col("c_name").cast("binary")))).alias("uuid"))


# ------------------------------------------------------------------ topic_parts
@register("topic_parts", """
WITH t AS (
  SELECT DISTINCT 'Fact.' || event_type
         || CASE WHEN user_id % 3 = 0 THEN '' ELSE '#t' || CAST(user_id % 3 AS VARCHAR) END
         || CASE WHEN user_id % 2 = 0 THEN '' ELSE ':' || CAST(user_id % 5 AS VARCHAR) END AS topic
  FROM events)
SELECT topic,
       regexp_extract(topic, '^([^#:]*)(?:#([^:]*))?(?::(.*))?$', 1) AS "table",
       regexp_extract(topic, '^([^#:]*)(?:#([^:]*))?(?::(.*))?$', 2) AS tag,
       regexp_extract(topic, '^([^#:]*)(?:#([^:]*))?(?::(.*))?$', 3) AS shard
FROM t
""")
def q_topic_parts(spark, sf):
    ev = table(spark, sf, "events")
    u = F.col("user_id")
    topic = F.concat(F.lit("Fact."), F.col("event_type"),
                     F.when(u % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("#t"), (u % 3).cast("string"))),
                     F.when(u % 2 == 0, F.lit("")).otherwise(F.concat(F.lit(":"), (u % 5).cast("string"))))
    t = ev.select(topic.alias("topic")).distinct()
    p = topic_parts("topic")
    return t.select("topic", p["table"].alias("table"), p["tag"].alias("tag"), p["shard"].alias("shard"))


# ------------------------------------------------------------------ stamp_hash (S1 by a hash of the key)
@register("stamp_hash", """
SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS ids, TIMESTAMP '2024-02-01 00:00:00' AS pos FROM events GROUP BY event_type
""")
def q_stamp_hash(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "event_type")
    return stamp(ev, D(2024, 2, 1), key=["event_id"]).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"), F.max("pos").alias("pos"))


# ------------------------------------------------------------------ stamp_rows
@register("stamp_rows", """
SELECT event_id, TIMESTAMP '2024-02-01 00:00:00' AS pos, row_number() OVER (ORDER BY ts, event_id) AS id FROM events
""")
def q_stamp_rows(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "ts")
    return stamp(ev, D(2024, 2, 1), order=["ts", "event_id"]).select("event_id", "pos", "id")


# ------------------------------------------------------------------ pull_window
@register("pull_window", """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE (o_orderdate > TIMESTAMP '1997-01-01 00:00:00' OR (o_orderdate = TIMESTAMP '1997-01-01 00:00:00' AND o_orderkey > 0))
  AND (o_orderdate < TIMESTAMP '1997-03-31 00:00:00' OR (o_orderdate = TIMESTAMP '1997-03-31 00:00:00' AND o_orderkey <= 5000))
""")
def q_pull_window(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return pull_window(o, Position(D(1997, 1, 1), 0), Position(D(1997, 3, 31), 5000), "o_orderdate", "o_orderkey")


# ------------------------------------------------------------------ cdc_stage
@register("cdc_stage", """
SELECT user_id, event_type, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1 AND event_type <> 'error'
""")
def q_cdc_stage(spark, sf):
    from ..operators.upsert import apply_changes
    from ..session import work_dir
    root = work_dir(spark, "cdc_stage")
    ev = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    op = F.when(F.col("event_type") == "signup", "insert").when(F.col("event_type") == "error", "delete") \
        .otherwise("update")
    # land change events as JSON envelopes, the way a binlog reader would
    env = to_envelope(ev.withColumn("_op", op), "shop", "events", ts="ts", id="event_id", op_col="_op", unit="MILLISECOND")
    env.write.mode("overwrite").text(f"{root}/landing")
    stage = read_cdc(spark.read.text(f"{root}/landing"), ev.schema, unit="MILLISECOND")
    return apply_changes(None, stage, ["user_id"], ["ts", "event_id"], "_op", ["delete"],
                         ["user_id", "event_type", "ts", "value"])
