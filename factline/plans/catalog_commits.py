"""Catalogue: what commit rows decide (K1, B8, K6, K8), positions of shards and streams (B10, G1, G3, P6), the
worked fact (J1, L1, L3, section 2.11), positions kept per file (B11), deletes as versions (K5), stored distinct counts (A15, M3), funnels by
several columns (A14)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..functions.exprs import ZERO_UUID, base64_bytes, bytes_to_uuid, or_zero_decimal, or_zero_timestamp, ts_lit
from ..operators.audit import merge_log
from ..operators.gate import dep_gate, pipelines_from, readiness
from ..operators.lookup import kv_join
from ..operators.mart import period, refresh_rollup
from ..operators.merge import funnel, funnel_counts, merge_uniq, uniq_estimate, uniq_state
from ..operators.positions import Position
from ..operators.upsert import alive, apply_changes, drop_tombstones
from ..session import work_dir
from ..sources.files import FilePositions
from ..streaming.stream import file_stream, stream_load
from .load import (PositionStore, Target, compact_blocks, drain_planned, load_step, read_fact, retain_partitions,
                   sql_transform)
from .registry import register, table

D = _dt.datetime
FAR_GATE = D(2099, 1, 1)
NOW = D(2024, 2, 1)


class _Crash(Exception):
    pass


def _crash(spark):
    raise _Crash


# ------------------------------------------------------------------ committed_reads
@register("committed_reads", "SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders")
def q_committed_reads(spark, sf):
    """Two tags, two streams and a block that died between its write and its commit, in one destination."""
    root = work_dir(spark, "committed_reads")
    store = PositionStore(spark, f"{root}/positions")
    target = Target(root=f"{root}/fact", keys=["o_orderkey"])
    src = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    kw = dict(gate=FAR_GATE, pos="o_orderdate", id="o_orderkey")
    for tag, status in (("open", "O"), ("done", "F")):
        view = sql_transform(f"SELECT * FROM {{block}} WHERE o_orderstatus = '{status}'")
        drain_planned(spark, f"orders#{tag}", src, view, target, store, NOW, **kw)
    half = F.col("o_orderkey") % 2 == 0
    for name, part in (("even", half), ("odd", ~half)):
        src.filter((F.col("o_orderstatus") == "P") & part).write.parquet(f"{root}/stage_{name}")
        stream_load(spark, file_stream(spark, f"{root}/stage_{name}", src.schema), f"orders#{name}", lambda b: b, target,
                    f"{root}/ck_{name}", store, now=NOW, pos="o_orderdate", id="o_orderkey")
    shifted = src.withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000_000)
    try:
        load_step(spark, "orders#lost", shifted, lambda b: b, target, store, NOW, after=_crash, **kw)
    except _Crash:
        pass
    compact_blocks(spark, "orders", target, store, NOW)
    return read_fact(spark, target.root, store).drop("block_id")


# ------------------------------------------------------------------ stream_gate
@register("stream_gate", "SELECT event_id, ts, event_type FROM events WHERE ts < (SELECT max(ts) FROM events WHERE event_type = 'view')")
def q_stream_gate(spark, sf):
    """A batch load that waits for a streamed table: nothing at or after the stream's position is taken."""
    root = work_dir(spark, "stream_gate")
    store = PositionStore(spark, f"{root}/positions")
    ev = table(spark, sf, "events").select("event_id", "ts", "event_type")
    ev.filter("event_type = 'view'").repartitionByRange(3, "ts").write.parquet(f"{root}/stage")
    stream_load(spark, file_stream(spark, f"{root}/stage", ev.schema, max_files=2), "views", lambda b: b,
                Target(root=f"{root}/views", keys=["event_id"]), f"{root}/checkpoint", store, now=NOW, pos="ts", id="event_id")
    gate, _ = dep_gate(store.read(), ["views"], 0, FAR_GATE)
    target = Target(root=f"{root}/fact", dedup=None)
    drain_planned(spark, "events_after_views", ev, lambda b: b, target, store, NOW, gate=gate, pos="ts", id="event_id")
    return read_fact(spark, target.root, store).drop("block_id")


# ------------------------------------------------------------------ sharded_gate
SHARD_GATES = (D(1997, 1, 1), D(2000, 1, 1), FAR_GATE)


@register("sharded_gate", """
WITH s AS (SELECT 0 AS i, max(o_orderdate) AS p FROM orders WHERE o_orderkey % 3 = 0 AND o_orderdate < TIMESTAMP '1997-01-01 00:00:00'
  UNION ALL SELECT 1, max(o_orderdate) FROM orders WHERE o_orderkey % 3 = 1 AND o_orderdate < TIMESTAMP '2000-01-01 00:00:00'
  UNION ALL SELECT 2, max(o_orderdate) FROM orders WHERE o_orderkey % 3 = 2)
SELECT 'part:0' AS "table", (SELECT p FROM s WHERE i = 0) AS gate, CAST(1 AS BIGINT) AS found, false AS ready
UNION ALL SELECT 'part:1', (SELECT p FROM s WHERE i = 1), 1, true
UNION ALL SELECT 'part:2', (SELECT p FROM s WHERE i = 2), 1, true
UNION ALL SELECT 'whole', (SELECT min(p) FROM s), 1, true
""")
def q_sharded_gate(spark, sf):
    """Shards load on their own; a shard's reader looks at its shard, a reader of the whole at the slowest one."""
    root = work_dir(spark, "sharded_gate")
    store = PositionStore(spark, f"{root}/positions")
    src = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    target = Target(root=f"{root}/stage", dedup=None)
    for i, gate in enumerate(SHARD_GATES):
        drain_planned(spark, "stage", src, lambda b: b, target, store, NOW - _dt.timedelta(days=2), gate=gate, pos="o_orderdate", id="o_orderkey",
                      shard=(3, i))
    # shard 0 of the reader has all of its source, the others had the first year
    parts = Target(root=f"{root}/part", dedup=None)
    for i in range(3):
        gate, _ = dep_gate(store.read(), ["stage"], 0, FAR_GATE, shard=str(i))
        store.append(f"part:{i}", last=Position(gate if i == 0 else D(1996, 1, 1), 0), run=NOW - _dt.timedelta(days=1), processor="Step", root=parts.root)
    lineage = spark.createDataFrame([("part", "stage", "", "", ""), ("whole", "stage", "", "", "")],
                                    "table string, depends_on string, delay string, repeat string, time string")
    positions = store.read()
    return readiness(pipelines_from(lineage, positions), positions, NOW)


# ------------------------------------------------------------------ transaction_fact (J1, L1, L3, 2.11)
BRAND_SQL = "CAST(o_orderkey % 5 AS VARCHAR)"
TRANSACTION_SQL = f"""
WITH t AS (
  SELECT md5('t' || CAST(o_orderkey AS VARCHAR)) AS h, o_custkey, {BRAND_SQL} AS brand, o_orderkey, o_totalprice, o_orderdate FROM orders),
f AS (
  SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS uuid,
         md5('u' || CAST(o_custkey AS VARCHAR) || '-' || brand) AS c, o_custkey % 11 <> 0 AS known, brand,
         CASE WHEN o_orderkey % 7 = 0 THEN CAST(0 AS DECIMAL(18,3)) ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(18,3)) END AS credit_amount,
         CASE WHEN o_orderkey % 5 = 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(18,3)) ELSE CAST(0 AS DECIMAL(18,3)) END AS debit_amount,
         CASE WHEN o_orderkey % 13 = 0 THEN TIMESTAMP '1970-01-01 00:00:00' ELSE o_orderdate END AS created_at
  FROM t),
fact AS (
  SELECT uuid, CASE WHEN known THEN substr(c, 1, 8) || '-' || substr(c, 9, 4) || '-' || substr(c, 13, 4) || '-' || substr(c, 17, 4) || '-' || substr(c, 21, 12)
                    ELSE '{ZERO_UUID}' END AS customer, credit_amount, debit_amount, created_at,
         CASE WHEN known THEN 'C' || brand ELSE '' END AS currency FROM f)
"""


def _text_md5(prefix, *cols):
    return F.unhex(F.md5(F.concat(F.lit(prefix), *cols).cast("binary")))


def transaction_stages(spark, sf):
    """The example's stages, derived from orders: transactions with base64 keys and amounts as text, a tenth of them
    delivered again later with other amounts; accounts by (account, brand), in two versions."""
    o = table(spark, sf, "orders").withColumn("brand", (F.col("o_orderkey") % 5).cast("string"))
    key, amount = F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    tx = o.select(
        F.col("o_orderdate").alias("pos"), F.col("o_orderkey").alias("id"), F.base64(_text_md5("t", key)).alias("uuid"),
        F.base64(F.col("o_custkey").cast("string").cast("binary")).alias("account_uuid"), "brand",
        F.when(F.col("o_orderkey") % 7 == 0, "n/a").otherwise(amount).alias("credit_amount"),
        F.when(F.col("o_orderkey") % 5 == 0, amount).otherwise("").alias("debit_amount"),
        F.when(F.col("o_orderkey") % 13 == 0, "bad").otherwise(text).alias("created"))
    again = tx.filter("id % 10 = 3").select(
        (F.col("pos") + F.expr("INTERVAL 400 DAY")).alias("pos"), (F.col("id") + 1_000_000_000).alias("id"), "uuid", "account_uuid", "brand",
        F.lit("1").alias("credit_amount"), F.lit("1").alias("debit_amount"), "created")
    acc = o.filter("o_custkey % 11 != 0").select(F.col("o_custkey").cast("string").alias("account"), "brand").distinct()
    acc = acc.withColumn("version", F.explode(F.array(F.lit(1), F.lit(2)))).select(
        "account", "brand", "version", F.when(F.col("version") == 2, _text_md5("u", F.col("account"), F.lit("-"), F.col("brand"))).alias("user_uuid"),
        F.when(F.col("version") == 2, F.concat(F.lit("C"), F.col("brand"))).otherwise("old").alias("currency"))
    return tx.unionByName(again), acc


def transaction_transform(accounts):
    """base64 keys to UUIDs, amounts and times or zero, the customer by a two-part key."""
    def run(block):
        b = block.select(
            bytes_to_uuid(base64_bytes("uuid")).alias("uuid"), base64_bytes("account_uuid").cast("string").alias("account"), "brand",
            or_zero_decimal("credit_amount", 18, 3).alias("credit_amount"), or_zero_decimal("debit_amount", 18, 3).alias("debit_amount"),
            or_zero_timestamp("created").cast("timestamp_ntz").alias("created_at"), "pos", "id")
        found = kv_join(b, accounts, ["account", "brand"], kv_order=["version"])
        return found.select("uuid", F.coalesce(bytes_to_uuid("user_uuid"), F.lit(ZERO_UUID)).alias("customer"), "credit_amount", "debit_amount",
                            "created_at", F.coalesce("currency", F.lit("")).alias("currency"), "pos", "id")
    return run


def transaction_load(spark, sf, name):
    """The fact in two loads: what had arrived until 1998, then the rest with the repeated deliveries."""
    root = work_dir(spark, name)
    store = PositionStore(spark, f"{root}/positions")
    tx, accounts = transaction_stages(spark, sf)
    tx.write.parquet(f"{root}/stage")
    tx = spark.read.parquet(f"{root}/stage")
    target = Target(root=f"{root}/fact", keys=["uuid"], order=["pos", "id"], log_ts="created_at",
                    checks={"created_at": F.col("created_at") == ts_lit(D(1970, 1, 1)), "customer": F.col("customer") == ZERO_UUID})
    for gate in (D(1998, 1, 1), FAR_GATE):
        drain_planned(spark, "Transaction", tx, transaction_transform(accounts), target, store, NOW, gate=gate)
    return read_fact(spark, target.root, store), store


@register("transaction_fact", TRANSACTION_SQL + "SELECT * FROM fact")
def q_transaction_fact(spark, sf):
    return transaction_load(spark, sf, "transaction_fact")[0].drop("block_id", "pos", "id")


@register("transaction_log", TRANSACTION_SQL + f"""
SELECT 'Transaction' AS topic, count(*) AS rows, max(created_at) AS max_ts, min(created_at) AS min_ts,
       count(*) FILTER (WHERE created_at = TIMESTAMP '1970-01-01 00:00:00') AS bad_created,
       count(*) FILTER (WHERE customer = '{ZERO_UUID}') AS no_customer FROM fact
""")
def q_transaction_log(spark, sf):
    merged = merge_log(transaction_load(spark, sf, "transaction_log")[1].block_log())
    return merged.select("topic", "rows", "max_ts", "min_ts", F.coalesce(F.col("nulls")["created_at"], F.lit(0)).alias("bad_created"),
                         F.coalesce(F.col("nulls")["customer"], F.lit(0)).alias("no_customer"))


# ------------------------------------------------------------------ file_gate
@register("file_gate", """
WITH p AS (SELECT 'lineitem' AS topic, max(l_shipdate) AS p FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01 00:00:00'
  UNION ALL SELECT 'orders', max(o_orderdate) FROM orders)
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate < (SELECT min(p) FROM p)
""")
def q_file_gate(spark, sf):
    """Two stages that grow by files; the gate takes both positions from what is known of the files, none from a column."""
    root = work_dir(spark, "file_gate")
    known = FilePositions(spark, f"{root}/files")
    li, orders = table(spark, sf, "lineitem").select("l_shipdate", "l_orderkey"), table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    for lo, hi in ((D(1900, 1, 1), D(1995, 1, 1)), (D(1995, 1, 1), D(1998, 1, 1))):
        li.filter(F.col("l_shipdate").between(ts_lit(lo), ts_lit(hi - _dt.timedelta(microseconds=1)))).write.mode("append").parquet(f"{root}/lineitem")
        known.refresh("lineitem", f"{root}/lineitem", "l_shipdate", "l_orderkey")
    orders.write.parquet(f"{root}/orders")
    known.refresh("orders", f"{root}/orders", "o_orderdate", "o_orderkey")
    known.compact(keep_s=0)
    gate, _ = dep_gate(known.positions(), ["lineitem", "orders"], 0, FAR_GATE)
    store, target = PositionStore(spark, f"{root}/positions"), Target(root=f"{root}/fact", dedup=None)
    drain_planned(spark, "orders_gated", spark.read.parquet(f"{root}/orders"), lambda b: b, target, store, NOW, gate=gate, pos="o_orderdate", id="o_orderkey")
    return read_fact(spark, target.root, store).drop("block_id")


# ------------------------------------------------------------------ log_compaction
@register("log_compaction", """
SELECT 'orders_log' AS topic, CAST(count(*) AS BIGINT) AS rows, max(o_orderkey) AS max_id, min(o_orderdate) AS min_ts, max(o_orderdate) AS max_ts,
       CAST(count(DISTINCT o_orderkey) AS BIGINT) AS visible FROM orders
""")
def q_log_compaction(spark, sf):
    """A load a year, the position log merged between them: every commit row stays, once, and the table with it."""
    root = work_dir(spark, "log_compaction")
    store = PositionStore(spark, f"{root}/positions")
    src = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    target = Target(root=f"{root}/fact", keys=["o_orderkey"], log_ts="o_orderdate", log_id="o_orderkey")
    for gate in (D(1994, 1, 1), D(1997, 1, 1), FAR_GATE):
        drain_planned(spark, "orders_log", src, lambda b: b, target, store, NOW, gate=gate, pos="o_orderdate", id="o_orderkey")
        store.compact(keep_s=0)
        PositionStore.forget(store.path)   # a new process
    seen = read_fact(spark, target.root, store).agg(F.countDistinct("o_orderkey").alias("visible"))
    return merge_log(store.block_log()).select("topic", "rows", "max_id", "min_ts", "max_ts").join(F.broadcast(seen))


# ------------------------------------------------------------------ retain_partitions (K8)
@register("retain_partitions", """
SELECT o_orderkey, o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders WHERE year(o_orderdate) >= 1997
""")
def q_retain_partitions(spark, sf):
    root = work_dir(spark, "retain_partitions")
    store = PositionStore(spark, f"{root}/positions")
    target = Target(root=f"{root}/fact", dedup=None, partition_by=["o_year"])
    src = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    for gate in (D(1998, 6, 1), FAR_GATE):
        drain_planned(spark, "orders_by_year", src, lambda b: b.withColumn("o_year", F.year("o_orderdate")), target, store, NOW,
                      gate=gate, pos="o_orderdate", id="o_orderkey")
    gone = retain_partitions(spark, "orders_by_year", target, store, NOW, "o_year", 1997)
    assert all(int(p.rsplit("=", 1)[1]) < 1997 for p in gone)
    return read_fact(spark, target.root, store).drop("block_id")


# ------------------------------------------------------------------ tombstones (K5)
@register("tombstones", """
SELECT user_id, event_type, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1 AND event_type <> 'error'
""")
def q_tombstones(spark, sf):
    """Change events in three batches, the newest first: a late update of a deleted key stays without effect."""
    root = work_dir(spark, "tombstones")
    ev = table(spark, sf, "events").withColumn("_op", F.when(F.col("event_type") == "error", "delete").otherwise("update"))
    cols = ["user_id", "event_type", "ts", "value", "event_id"]
    state = None
    for i in (2, 0, 1):
        lo, hi = ts_lit(D(2024, 1, 1 + 10 * i)), ts_lit(D(2024, 1, 11 + 10 * i) if i < 2 else FAR_GATE)
        part = ev.filter((F.col("ts") >= lo) & (F.col("ts") < hi)) if i else ev.filter(F.col("ts") < hi)
        state = apply_changes(state, part, ["user_id"], ["ts", "event_id"], "_op", ["delete"], cols, tombstone="_deleted")
        state.write.parquet(f"{root}/state{i}")
        state = spark.read.parquet(f"{root}/state{i}")
    state = drop_tombstones(state, "_deleted", "ts", D(2024, 1, 15))
    return alive(state, "_deleted").select("user_id", "event_type", "ts", "value")


# ------------------------------------------------------------------ uniq_sketch
@register("uniq_sketch", """
SELECT CAST(date_trunc('month', ts) AS TIMESTAMP) AS period, event_type, count(*) AS n, count(DISTINCT user_id) AS uniq, true AS close
FROM events GROUP BY ALL
""")
def q_uniq_sketch(spark, sf):
    """A daily mart with stored distinct counts, refreshed block by block, rolled up to months without the events."""
    root = work_dir(spark, "uniq_sketch")
    ev = table(spark, sf, "events")
    mart, keys, rules = None, ["period", "event_type"], {"n": "sum", "users": "uniq"}
    for i, (lo, hi) in enumerate(((None, D(2024, 1, 10, 7)), (D(2024, 1, 10, 7), None))):
        block = ev.filter(F.col("ts") < ts_lit(hi)) if hi else ev.filter(F.col("ts") >= ts_lit(lo))
        block = block.withColumn("period", period("ts", "day"))
        delta = uniq_state(block, keys, "user_id", "users").join(block.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), keys)
        mart = refresh_rollup(mart, delta, keys, rules) if mart is not None else delta
        mart.write.parquet(f"{root}/mart{i}")
        mart = spark.read.parquet(f"{root}/mart{i}")
    month = [period("period", "month").alias("period"), "event_type"]
    rolled = uniq_estimate(merge_uniq(mart.select(*month, "users"), keys, "users"), "users", "estimate")
    rolled = rolled.join(mart.groupBy(*month).agg(F.sum("n").alias("n")), keys)
    exact = ev.groupBy(period("ts", "month").alias("period"), "event_type").agg(F.countDistinct("user_id").alias("uniq"))
    # 2^12 registers: standard error 1.6 %
    close = F.abs(F.col("estimate") - F.col("uniq")) <= 1 + 0.065 * F.col("uniq")
    return rolled.join(exact, keys).select("period", "event_type", "n", "uniq", close.alias("close"))


# ------------------------------------------------------------------ funnel_by
@register("funnel_by", """
WITH e AS (SELECT user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 AS campaign, event_type, ts FROM events),
p1 AS (SELECT user_id, campaign, min(ts) AS t FROM e WHERE event_type = 'view' GROUP BY ALL),
p2 AS (SELECT e.user_id, e.campaign, min(ts) AS t FROM e JOIN p1 ON e.user_id = p1.user_id AND e.campaign = p1.campaign AND ts > p1.t WHERE event_type = 'click' GROUP BY ALL),
p3 AS (SELECT e.user_id, e.campaign, min(ts) AS t FROM e JOIN p2 ON e.user_id = p2.user_id AND e.campaign = p2.campaign AND ts > p2.t WHERE event_type = 'purchase' GROUP BY ALL)
SELECT 1 AS step, 'view' AS step_name, (SELECT count(*) FROM p1) AS users
UNION ALL SELECT 2, 'click', (SELECT count(*) FROM p2)
UNION ALL SELECT 3, 'purchase', (SELECT count(*) FROM p3)
""")
def q_funnel_by(spark, sf):
    ev = table(spark, sf, "events").withColumn("campaign", F.get_json_object("props", "$.k").cast("int") % 4)
    steps = ["view", "click", "purchase"]
    return funnel_counts(funnel(ev, ["user_id", "campaign"], "event_type", "ts", steps), steps)
