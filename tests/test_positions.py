"""Block predicates, planning, gate: FIXTURES.md section 3 and the block properties."""

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

from conftest import SF, SF01
from factline.operators.gate import dep_gate, readiness
from factline.operators.positions import (Position, block_filter, block_numbers, kth_position, next_block,
                                          next_block_uniq, next_range, pending, source_position)

D = dt.datetime


def src(spark, rows):
    return spark.createDataFrame(rows, "pos timestamp_ntz, id bigint")


def test_block_edge_inside_tie(spark):
    t1 = D(2024, 1, 1)
    df = src(spark, [(t1, 1), (t1, 2), (t1, 3)])
    got = [r.id for r in block_filter(df, Position(t1, 1), Position(t1, 2)).collect()]
    assert got == [2]


def test_block_filter_pushed_down(spark):
    df = spark.read.parquet(f"{SF}/events.parquet")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        block_filter(df, Position(D(2024, 1, 2), 5), Position(D(2024, 1, 3), 7), "ts", "event_id").explain("formatted")
    pushed = [ln for ln in buf.getvalue().splitlines() if ln.startswith("PushedFilters")][0]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThanOrEqual(ts" in pushed and "GreaterThan(event_id,5)" in pushed


def test_empty_block(spark):
    t = D(2024, 1, 1)
    b = next_block(src(spark, [(t, 1)]), None, t, 10)
    assert b.rows == 0 and b.next is None and b.empty


def test_gate_strict(spark):
    t = D(2024, 1, 1)
    b = next_block(src(spark, [(t, 1), (t + dt.timedelta(seconds=1), 2)]), None, t + dt.timedelta(seconds=1), 10)
    assert b.rows == 1 and b.next == Position(t, 1)


def test_full_flag(spark):
    t = D(2024, 1, 1)
    rows = [(t + dt.timedelta(minutes=i), i) for i in range(5)]
    assert next_block(src(spark, rows), None, D(2025, 1, 1), 5).full
    assert not next_block(src(spark, rows), None, D(2025, 1, 1), 6).full


def test_uniq_block(spark):
    t = [D(2024, 1, 1, h) for h in (1, 2, 3)]
    b = next_block_uniq(src(spark, [(t[0], 1), (t[1], 2), (t[2], 1)]), None, D(2025, 1, 1), 1)
    assert b.next == Position(t[1], 2) and b.rows == 1


def test_range_end():
    last = Position(D(2024, 1, 1, 10), 0)
    assert next_range(last, 3600, 60, D(2024, 1, 1, 10, 30)) == Position(D(2024, 1, 1, 10, 29), 0)
    assert next_range(last, 3600, 60, D(2024, 1, 1, 10)) is None


@pytest.mark.parametrize("k", [1, 7, 100, 777, 1500, 2999])
def test_kth_position_histogram(spark, k):
    o = spark.read.parquet(f"{SF}/orders.parquet").select(F.col("o_orderdate").alias("pos"),
                                                          F.col("o_orderkey").alias("id"))
    want = sorted((r.pos, r.id) for r in o.collect())[k - 1] if k <= o.count() else None
    got = kth_position(o, k, exact_rows=50)   # force several histogram passes
    assert (got.pos, got.id) == want if want else got is None


def test_kth_position_hot_tie(spark):
    # a third of the rows on one pos: the search must split by id
    t = D(2024, 1, 1)
    rows = [(t, i) for i in range(300)] + [(t + dt.timedelta(seconds=i), 1000 + i) for i in range(600)]
    df = src(spark, rows)
    for k in (1, 150, 300, 301, 899):
        want = sorted(rows)[k - 1]
        got = kth_position(df, k, exact_rows=20, buckets=8)
        assert (got.pos, got.id) == want


def test_blocks_partition_the_source(spark):
    """Union of drained blocks = source; blocks pairwise disjoint; matches block_numbers."""
    o = spark.read.parquet(f"{SF}/orders.parquet")
    gate = D(2099, 1, 1)
    last, seen, blocks = None, 0, []
    while True:
        b = next_block(o, last, gate, 333, "o_orderdate", "o_orderkey", exact_rows=100)
        if b.empty:
            break
        n = block_filter(o, last, b.next, "o_orderdate", "o_orderkey").count()
        assert n == b.rows
        seen += n
        blocks.append(b)
        last = b.next
    assert seen == o.count()
    nums = block_numbers(o, 333, "o_orderdate", "o_orderkey").groupBy("block_no").count().orderBy("block_no")
    assert [r["count"] for r in nums.collect()] == [b.rows for b in blocks]


def test_dep_gate(spark):
    pos = spark.createDataFrame(
        [("a", (D(2024, 1, 1, 10), 0)), ("b", (D(2024, 1, 1, 10, 5), 0))],
        "topic string, last struct<pos:timestamp_ntz,id:bigint>")
    assert dep_gate(pos, ["a", "b"], 300, D(2024, 1, 1, 10, 6)) == (D(2024, 1, 1, 10), "a")
    pos2 = spark.createDataFrame(
        [("a", (D(2024, 1, 1, 10, 5), 0)), ("b", (D(2024, 1, 1, 10, 6), 0))],
        "topic string, last struct<pos:timestamp_ntz,id:bigint>")
    assert dep_gate(pos2, ["a", "b"], 300, D(2024, 1, 1, 10, 6))[0] == D(2024, 1, 1, 10, 1)
    # one dependency missing: ignored; all missing: not ready
    assert dep_gate(pos2, ["a", "zz"], 0, D(2030, 1, 1))[0] == D(2024, 1, 1, 10, 5)
    assert dep_gate(pos2, ["yy", "zz"], 0, D(2030, 1, 1)) == (None, "missing")


def test_source_position(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    want = max((r.o_orderdate, r.o_orderkey) for r in o.collect())
    assert source_position(o, "o_orderdate", "o_orderkey") == Position(*want)


def test_readiness_stale_override(spark):
    pl = spark.createDataFrame(
        [("t", "a", "", "", "3:00-4:00", D(2024, 1, 1), D(2024, 1, 1), "Step", "")],
        "table string, depends_on string, delay string, repeat string, time string, last timestamp_ntz, "
        "run timestamp_ntz, processor string, hostid string")
    pos = spark.createDataFrame([("a", (D(2024, 1, 5), 1))], "topic string, last struct<pos:timestamp_ntz,id:bigint>")
    assert readiness(pl, pos, D(2024, 1, 5, 12)).first()["ready"] is True


def test_plan_blocks_horizon(spark):
    from factline.operators.positions import plan_blocks
    o = spark.read.parquet(f"{SF}/orders.parquet")
    full = plan_blocks(o, None, D(2099, 1, 1), 200, "o_orderdate", "o_orderkey", horizon=1000)
    part = plan_blocks(o, None, D(2099, 1, 1), 200, "o_orderdate", "o_orderkey", horizon=3)
    assert part == full[:3] and len(full) == 8 and sum(b.rows for b in full) == 1500


def test_gate_decisions(spark):
    """D5 deleted processors skipped, D28 own shard or unsharded only, D29 laggard ties by name, D7 NULL blocks."""
    schema = "topic string, last struct<pos:timestamp_ntz,id:bigint>, run timestamp_ntz, processor string"
    t = D(2024, 1, 1)
    pos = spark.createDataFrame([
        ("b", (t, 0), t, "Step"),
        ("a", (t, 0), t, "Step"),                                        # tie with b: smallest name wins
        ("c", (D(2023, 1, 1), 0), D(2024, 1, 2), "deleted"),             # newest row deleted: skipped
        ("c", (D(2024, 6, 1), 0), t, "Step"),
        ("d:2", (D(2020, 1, 1), 0), t, "Step"),                          # another shard: ignored
        ("d:1", (D(2025, 1, 1), 0), t, "Step"),
    ], schema)
    gate, lag = dep_gate(pos, ["a", "b", "c", "d"], 0, D(2030, 1, 1), shard="1")
    assert (gate, lag) == (t, "a")
    nul = spark.createDataFrame([("a", None, t, "Step"), ("b", (t, 0), t, "Step")], schema)
    assert dep_gate(nul, ["a", "b"], 0, D(2030, 1, 1))[0] is None


def test_position_report_with_table_writes(spark, tmp_path):
    from factline.operators.gate import position_report
    path = str(tmp_path / "fact")
    spark.range(3).write.parquet(path)
    pos = spark.createDataFrame([("Fact.T#x:1", (D(2024, 1, 1), 5), D(2024, 1, 1), 3),
                                 ("stub", (D(2099, 12, 31), 0), D(2024, 1, 1), 0)],
                                "topic string, last struct<pos:timestamp_ntz,id:bigint>, run timestamp_ntz, rows bigint")
    rows = position_report(pos, D(2024, 1, 2), tables={"Fact.T": path}).collect()
    assert len(rows) == 1 and rows[0]["elapsed_s"] == 86400 and rows[0]["parts"] is not None


def test_readiness_from_store(spark, tmp_path):
    from factline.operators.gate import pipelines_from
    from factline.plans.load import PositionStore
    store = PositionStore(spark, str(tmp_path / "pos"))
    store.append("fact_x", last=Position(D(2024, 1, 1), 3), run=D(2024, 1, 1), processor="Step")
    lineage = spark.createDataFrame([("fact_x", "src", "", "", ""), ("fact_new", "src", "", "", "")],
                                    "table string, depends_on string, delay string, repeat string, time string")
    src = spark.createDataFrame([("src", (D(2024, 1, 5), 9))], "topic string, last struct<pos:timestamp_ntz,id:bigint>")
    got = {r["table"]: r["ready"] for r in readiness(pipelines_from(lineage, store.read()), src, D(2024, 1, 6)).collect()}
    assert got == {"fact_x": True, "fact_new": True}
    got = {r["table"]: r["ready"] for r in readiness(pipelines_from(lineage, store.read()), src, D(2024, 1, 1, 0, 30))
           .collect()}
    assert got["fact_x"] is False   # behind the gate, but the 1 h default repeat is not over yet
