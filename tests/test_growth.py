"""What must not grow with the tables: rows ranked by a plan, runs of a block's transform, rows in one writing task."""

from __future__ import annotations

import datetime as _dt
import glob

from pyspark.sql import functions as F

from factline.operators import positions
from factline.operators.lookup import first_rows
from factline.operators.upsert import compact
from factline.plans import catalog_aggs
from factline.plans.load import PositionStore, Target, drain_planned, read_fact

D = _dt.datetime
FAR = D(2099, 1, 1)


def moments(spark, n=6000):
    """Times with ties, repeated positions, NULL ids."""
    at = F.expr("TIMESTAMP_NTZ '1992-01-01 00:00:00' + make_dt_interval(CAST(id % 700 AS INT), 0, 0, id % 3 / 4)")
    return spark.range(n).select(at.alias("pos"), F.when(F.col("id") % 50 != 0, F.col("id") % 997).alias("id"), F.col("id").alias("x"))


def test_plan_ranks_only_rows_near_the_ends(spark, monkeypatch):
    df, seen = moments(spark).cache(), []
    rank = positions.rank_rows
    monkeypatch.setattr(positions, "rank_rows", lambda d, *a, **kw: seen.append(d.count()) or rank(d, *a, **kw))
    plan = positions.plan_blocks(df, None, FAR, 1500)
    assert 0 < sum(seen) < 600
    got = sorted((r["pos"], positions.NULL_ID if r["id"] is None else r["id"]) for r in df.collect())
    assert [(b.next.pos, b.next.id) for b in plan] == [got[k - 1] for k in (1500, 3000, 4500, 6000)]
    assert [b.rows for b in plan] == [1500] * 4 and [b.last for b in plan] == [None, *[b.next for b in plan[:-1]]]


def test_plan_with_equal_positions_and_no_time(spark):
    same = spark.range(50).select(F.lit(D(2024, 1, 1)).cast("timestamp_ntz").alias("pos"), F.lit(7).cast("bigint").alias("id"))
    assert [(b.next, b.rows) for b in positions.plan_blocks(same, None, FAR, 20)] == [(positions.Position(D(2024, 1, 1), 7), n) for n in (20, 20, 10)]
    timeless = same.limit(30).select(F.lit(None).cast("timestamp_ntz").alias("pos"), "id").unionByName(same)
    assert [b.next and b.next.id for b in positions.plan_blocks(timeless, None, None, 25)] == [None, 7, 7, 7]


def test_transform_runs_once_per_row(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def noted(x):
        runs.add(1)
        return x

    note = F.udf(noted, "bigint").asNondeterministic()
    store, target = PositionStore(spark, f"{tmp_path}/positions"), Target(root=f"{tmp_path}/fact", keys=["k"])
    src = spark.range(300).select(F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(CAST(id AS INT))").alias("pos"), "id")
    for gate in (D(2024, 6, 1), FAR):
        before = runs.value
        loaded = drain_planned(spark, "t", src, lambda b: b.withColumn("k", note(F.when(F.col("id") % 40 != 0, F.col("id") % 200))), target, store,
                               D(2024, 1, 1), gate=gate)
        assert runs.value - before == sum(r.rows for r in loaded) > 0
    assert sorted(r["id"] for r in read_fact(spark, target.root, store).collect()) == [i for i in range(300) if i < 200 or i % 40 == 0]


def test_rows_with_null_keys_stay(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (None, "a"), (None, "a"), (2, "c")], "k int, v string")
    assert sorted(map(tuple, first_rows(df, ["k"], ["v"]).collect()), key=repr) == [(1, "a"), (2, "c"), (None, "a"), (None, "a")]
    assert first_rows(df, ["k"]).count() == 4


def test_compact_counts_appends(spark, tmp_path):
    for i, rows in enumerate(([("A", 1, 1), ("A", 1, 2), ("B", 1, 1)], [("B", 1, 2), ("B", 2, 1)])):
        spark.createDataFrame(rows, "p string, k int, v int").repartition(3).write.partitionBy("p").parquet(f"{tmp_path}/append={i}")
    got = compact(spark.read.parquet(str(tmp_path)), ["p"], ["k"], ["v"], part="append").select("p", "k", "v").collect()
    assert sorted(map(tuple, got)) == [("A", 1, 1), ("A", 1, 2), ("B", 1, 2), ("B", 2, 1)]


def test_compact_query_writes_an_append_by_many_tasks(spark, tmp_path, monkeypatch):
    li = spark.range(400).select((F.col("id") % 100).alias("l_orderkey"), F.lit(1).alias("l_linenumber"),
                                 F.when(F.col("id") < 200, F.lit(D(1996, 1, 1))).otherwise(F.lit(D(1998, 1, 1))).cast("timestamp_ntz").alias("l_shipdate"),
                                 F.col("id").alias("l_partkey"), F.col("id").alias("l_suppkey"), F.when(F.col("id") % 4 < 2, "A").otherwise("N").alias("l_returnflag"))
    li.repartition(4).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(catalog_aggs, "work_dir", lambda spark, name: f"{tmp_path}/{name}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = catalog_aggs.q_compact(spark, str(tmp_path)).groupBy("l_returnflag").count().collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(map(tuple, got)) == [("A", 200), ("N", 50)]
    assert len(glob.glob(f"{tmp_path}/compact/v0/**/l_returnflag=A/*.parquet", recursive=True)) > 1
