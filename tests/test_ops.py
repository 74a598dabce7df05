"""Aggregation laws and upsert semantics (FIXTURES.md section 3, SURVEY section 5)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF
from factline.operators.audit import CheckFailed, block_log, check
from factline.operators.merge import idem_sum, merge_streams, signed_agg, sum_map
from factline.operators.upsert import apply_changes, collapse, sign_rows
from factline.sources.stage import SchemaDrift, check_drift, infer_stage, parse_envelope, to_envelope

D = dt.datetime


def test_sum_map(spark):
    df = spark.createDataFrame([("x", {"a": 1}), ("x", {"a": 2, "b": 3})], "g string, m map<string,bigint>")
    assert sum_map(df, ["g"], "m").first()["m"] == {"a": 3, "b": 3}


def test_zero_counters_dropped(spark):
    df = spark.createDataFrame([(0,), (1,)], "v int")
    log = block_log(df, "t", checks={"a": F.col("v") == 5, "b": F.col("v") >= 0})
    assert log.first()["nulls"] == {"b": 2}


def test_idempotent_sum(spark):
    df = spark.createDataFrame([(1, 7, 5.0), (1, 7, 5.0), (1, 8, 1.0)], "k int, row_id int, v double")
    assert idem_sum(df, "k", "row_id", "v").first()["total"] == 6.0


def test_signed_rows(spark):
    df = spark.createDataFrame([("k", 10, 1), ("k", 10, -1), ("k", 12, 1)], "k string, x int, sign int")
    r = signed_agg(df, ["k"], {"total": "x"}).first()
    assert (r["total"], r["n"]) == (12, 1)


def test_sign_rows_and_collapse(spark):
    s0 = spark.createDataFrame([("k", 1, 10)], "k string, ver int, x int")
    log = sign_rows(None, s0, ["k"], ["ver"])
    state = collapse(log)
    log = log.unionByName(sign_rows(state, spark.createDataFrame([("k", 2, 12)], "k string, ver int, x int"),
                                    ["k"], ["ver"]))
    assert [tuple(r) for r in collapse(log).collect()] == [("k", 2, 12)]


@pytest.mark.parametrize("split", [1, 2, 3])
def test_merge_streams_any_split(spark, split):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    views = ev.filter("event_type = 'view'").select("user_id", F.col("ts").alias("first_view"))
    clicks = ev.filter("event_type = 'click'").select("user_id", F.col("ts").alias("last_click"))
    rules = {"first_view": "min", "last_click": "max"}
    whole = merge_streams([views, clicks], "user_id", rules)
    parts = [views.filter(F.col("user_id") % split == i) for i in range(split)] + [clicks, clicks]  # duplicates too
    got = merge_streams(parts, "user_id", rules)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))


def test_apply_changes(spark):
    ch = spark.createDataFrame([(1, "insert", 1, "a"), (1, "update", 2, "b"), (2, "insert", 1, "c"),
                                (2, "delete", 2, None)], "k int, op string, t int, v string")
    got = apply_changes(None, ch, ["k"], ["t"], "op", ["delete"], ["k", "t", "v"]).collect()
    assert [tuple(r) for r in got] == [(1, 2, "b")]


def test_schema_drift(spark):
    old = spark.createDataFrame([(1, "a")], "a int, b string")
    merged = check_drift(old, spark.createDataFrame([(1.5, "a", 3)], "a double, b string, c int"))
    assert [f.name for f in merged.fields] == ["a", "b", "c"] and merged["a"].dataType.simpleString() == "double"
    with pytest.raises(SchemaDrift, match="column b"):
        check_drift(old, spark.createDataFrame([(1, (1,))], "a int, b struct<x:int>"))


def test_json_stage_and_envelope(spark):
    df = spark.createDataFrame([('{"k": 1}',), ('{"k": 2, "z": "q"}',)], "p string")
    out = infer_stage(df, "p")
    assert sorted(out.columns) == ["k", "z"] and out.filter("k = 2").first()["z"] == "q"
    ev = spark.read.parquet(f"{SF}/events.parquet")
    good, bad = parse_envelope(to_envelope(ev, "db", "events", "ts", "event_id").union(
        spark.createDataFrame([("{broken",)], "value string")), ev.schema)
    assert good.count() == ev.count() and bad.count() == 1


def test_check_raises(spark):
    df = spark.createDataFrame([(1,), (-1,)], "x int")
    with pytest.raises(CheckFailed):
        check(df, F.col("x") < 0, "ERROR", "negative")
    assert check(df, F.col("x") > 5, "ERROR", "big") == 0


def test_uniq_count_exact_and_approx(spark):
    from factline.operators.merge import uniq_count
    ev = spark.read.parquet(f"{SF}/events.parquet").withColumn("day", F.to_date("ts"))
    exact = {r["day"]: r["uniq"] for r in uniq_count(ev, ["day"], "user_id").collect()}
    approx = {r["day"]: r["uniq"] for r in uniq_count(ev, ["day"], "user_id", exact=False).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[d] - exact[d]) <= max(2, 0.1 * exact[d]) for d in exact)


def test_backup_increment_and_restore(spark):
    from factline.operators.positions import Position
    from factline.operators.upsert import backup_increment, restore
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "ts", "user_id")
    cut = ev.orderBy("ts", "event_id").limit(600).agg(F.max(F.struct("ts", "event_id"))).first()[0]
    since = Position(cut["ts"], cut["event_id"])
    full = ev.filter((F.col("ts") < F.lit(since.pos.isoformat(sep=" ")).cast("timestamp_ntz")) |
                     ((F.col("ts") == F.lit(since.pos.isoformat(sep=" ")).cast("timestamp_ntz")) &
                      (F.col("event_id") <= since.id)))
    inc = backup_increment(ev, since, "ts", "event_id")
    assert full.count() + inc.count() == ev.count()
    back = restore([full, inc, inc], ["event_id"], ["ts"])   # an increment applied twice changes nothing
    assert back.count() == ev.count()


def test_dim_is_unique(spark):
    from factline.operators.lookup import dim_is_unique
    nation = spark.read.parquet(f"{SF}/nation.parquet")
    assert dim_is_unique(nation, ["n_nationkey"])
    assert not dim_is_unique(nation, ["n_regionkey"])


def test_kv_join_composite_and_repair(spark):
    from factline.operators.lookup import dim_lookup, kv_join, repair_missing
    block = spark.createDataFrame([(1, "x", 10), (2, "y", 20), (3, "x", 30)], "acct int, brand string, v int")
    kv = spark.createDataFrame([(1, "x", "EUR", 1), (1, "x", "USD", 2), (2, "z", "GBP", 1)],
                               "acct int, brand string, currency string, ver int")
    got = {(r.acct, r.brand): r.currency for r in kv_join(block, kv, ["acct", "brand"], kv_order=["ver"]).collect()}
    assert got == {(1, "x"): "USD", (2, "y"): None, (3, "x"): None}     # newest version; unmatched kept
    dim_early = spark.createDataFrame([(1, "a")], "k int, name string")
    dim_full = spark.createDataFrame([(1, "a"), (2, "b")], "k int, name string")
    fact = dim_lookup(spark.createDataFrame([(1,), (2,)], "k int"), dim_early, ["k"], ["name"])
    fixed = sorted(tuple(r) for r in repair_missing(fact, dim_full, ["k"], ["name"]).collect())
    assert fixed == [(1, "a"), (2, "b")]


def test_prefilter_range_empty_block(spark):
    from factline.operators.lookup import prefilter_range
    right = spark.createDataFrame([(1,), (5,)], "k int")
    left = spark.createDataFrame([], "k int")
    assert prefilter_range(right, left, "k").count() == 0
    assert prefilter_range(right, spark.createDataFrame([(4,), (9,)], "k int"), "k").collect()[0]["k"] == 5


def test_sql_transform(spark):
    from factline.plans.load import sql_transform
    block = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    dim = spark.createDataFrame([(1, "a")], "k int, name string")
    t = sql_transform("SELECT b.k, b.v, d.name FROM {block} b LEFT JOIN {dim} d ON b.k = d.k", dim=dim)
    assert sorted(tuple(r) for r in t(block).collect()) == [(1, 10, "a"), (2, 20, None)]


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_layouts_show_in_plans_and_files(spark, tmp):
    """What the same rows do not show: J4 joins without an exchange, J3 pushes the range, J2 a semi join, M4 files that don't overlap."""
    from factline.operators.lookup import prefilter_in, prefilter_range, write_bucketed
    from factline.operators.mart import recluster
    big = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") * 7919 % 20_011).alias("v"))
    a, b = (write_bucketed(big, f"fl_layout_{n}", f"{tmp}/{n}", ["k"], 4, keep=False) for n in "ab")
    joined = a.hint("merge").join(b.withColumnRenamed("v", "w"), "k")
    assert "Exchange" not in plan(joined) and joined.count() == 20_000
    assert not spark.catalog.tableExists("fl_layout_a")
    big.repartition(5).write.parquet(f"{tmp}/big")
    stored = spark.read.parquet(f"{tmp}/big")
    few = stored.filter("v < 10")
    assert "GreaterThanOrEqual(v" in plan(prefilter_range(stored, few, "v"))
    assert "LeftSemi" in plan(prefilter_in(stored, few, ["v"]))
    ranges = lambda p: sorted((r.lo, r.hi) for r in spark.read.parquet(p).groupBy("_metadata.file_path").agg(
        F.min("v").alias("lo"), F.max("v").alias("hi")).collect())
    recluster(stored, ["v"], 5).write.parquet(f"{tmp}/by_v")
    before, after = ranges(f"{tmp}/big"), ranges(f"{tmp}/by_v")
    assert len(after) >= 3 and all(x[1] < y[0] for x, y in zip(after, after[1:])) and any(x[1] >= y[0] for x, y in zip(before, before[1:]))
