"""Append-only logs and their compaction, and positions kept per file."""

import datetime as dt
import os

import pytest

from factline.operators.gate import dep_gate
from factline.operators.mart import rollup_factor
from factline.operators.positions import NULL_ID, Position
from factline.plans import logfiles
from factline.plans.logfiles import compact_log, read_log
from factline.plans.store import PositionStore
from factline.sources.files import FilePositions

D = dt.datetime
LOG = "k string, v int"


def put(spark, path, *rows):
    spark.createDataFrame(list(rows), LOG).coalesce(1).write.mode("append").parquet(path)


def held(spark, path):
    return sorted((r.k, r.v) for r in read_log(spark, path, LOG).collect())


def parts(path):
    return [n for n in os.listdir(path) if n.startswith("part-")]


def test_compaction_keeps_every_row_once(spark, tmp):
    path, want = f"{tmp}/log", []
    assert held(spark, path) == [] and compact_log(spark, path, LOG, ["k"]) == 0
    for round_ in range(3):
        for i in range(3):
            row = ("ab"[i % 2], 10 * round_ + i)
            put(spark, path, row, row)   # repeated rows stay repeated
            want += [row, row]
        assert compact_log(spark, path, LOG, ["k", "v"], keep_s=0) == 3
        assert parts(path) == []
        assert held(spark, path) == sorted(want)
    put(spark, path, ("c", None))
    assert compact_log(spark, path, LOG, ["k"]) == 0   # one file is not worth it
    assert held(spark, path) == sorted(want) + [("c", None)]
    assert len([n for n in os.listdir(f"{path}/_merged") if not n.startswith(".")]) == 2   # the newest folder and its manifest


def test_readers_and_writers_go_on_during_compaction(spark, tmp, monkeypatch):
    path = f"{tmp}/log"
    for i in range(3):
        put(spark, path, ("a", i))
    before = read_log(spark, path, LOG)
    publish = logfiles._write_text

    def late(*args):   # a row that arrives between the merge and its manifest
        put(spark, path, ("late", 9))
        assert held(spark, path) == [("a", 0), ("a", 1), ("a", 2), ("late", 9)]
        publish(*args)

    monkeypatch.setattr(logfiles, "_write_text", late)
    assert compact_log(spark, path, LOG, ["k"], keep_s=3600) == 3
    assert held(spark, path) == [("a", 0), ("a", 1), ("a", 2), ("late", 9)]
    assert len(parts(path)) == 4 and before.count() == 3   # covered files stay for readers that know them

    def crash(*_):
        raise RuntimeError

    put(spark, path, ("b", 1))
    monkeypatch.setattr(logfiles, "_write_text", crash)
    with pytest.raises(RuntimeError):
        compact_log(spark, path, LOG, ["k"], keep_s=0)
    want = [("a", 0), ("a", 1), ("a", 2), ("b", 1), ("late", 9)]
    assert held(spark, path) == want
    monkeypatch.setattr(logfiles, "_write_text", publish)
    assert compact_log(spark, path, LOG, ["k"], keep_s=0) == 2
    assert held(spark, path) == want and parts(path) == []


def test_position_log_after_compaction(spark, tmp):
    store = PositionStore(spark, f"{tmp}/pos")
    for i in range(4):
        store.append("t", last=Position(D(2024, 1, 1 + i), i), root=f"{tmp}/fact", folders=[f"b{i}"], removed=["b0"] if i == 3 else None, log={"rows": i})
    store.append("u", last=None, nxt=Position(D(2024, 1, 9), 0))
    want = sorted(map(str, store.read().collect()))
    assert store.compact(keep_s=0) == 5
    fresh = PositionStore(spark, f"{tmp}/pos")
    PositionStore.forget(fresh.path)
    assert sorted(map(str, fresh.read().collect())) == want
    assert fresh.current("t")["seq"] == 3 and fresh.current("u")["next"] is not None
    assert sorted(fresh.live(f"{tmp}/fact").folders) == ["b1", "b2", "b3"]
    fresh.append("t", last=Position(D(2024, 2, 1), 0))
    assert fresh.read().count() == 6


ROWS = "pos timestamp_ntz, id bigint, v string"


def stage(spark, path, *rows):
    spark.createDataFrame(list(rows), ROWS).coalesce(1).write.mode("append").parquet(path)


def test_file_positions_read_new_files_only(spark, tmp):
    source, known = f"{tmp}/a b%c", FilePositions(spark, f"{tmp}/files")   # a name that URIs escape
    stage(spark, source, (D(2024, 1, 1), 5, "x"), (D(2024, 1, 1), 7, "y"), (None, 99, "no position"))
    assert known.refresh("s", source) == 1
    assert known.position("s") == Position(D(2024, 1, 1), 7) and known.position("other") is None
    # the known file's bytes are gone: whoever opened it would fail
    for n in parts(source):
        full, st = f"{source}/{n}", os.stat(f"{source}/{n}")
        with open(full, "wb") as f:
            f.write(b"x" * st.st_size)
        os.utime(full, ns=(st.st_atime_ns, st.st_mtime_ns))
        crc = f"{source}/.{n}.crc"
        if os.path.exists(crc):
            os.remove(crc)
    assert known.refresh("s", source, schema=ROWS) == 0
    stage(spark, source, (D(2024, 1, 3), None, "z"), (D(2024, 1, 2), 8, "z"))
    assert known.refresh("s", source, schema=ROWS) == 1
    assert known.position("s") == Position(D(2024, 1, 3), NULL_ID)
    assert known.read().agg({"rows": "sum"}).first()[0] == 5
    assert known.compact(keep_s=0) == 2 and known.refresh("s", source, schema=ROWS) == 0
    assert dep_gate(known.positions(), ["s"], 0, D(2099, 1, 1)) == (D(2024, 1, 3), "s")


def test_file_positions_slack_replaced_and_empty_files(spark, tmp):
    source, known = f"{tmp}/src", FilePositions(spark, f"{tmp}/files")
    spark.createDataFrame([], ROWS).write.parquet(source)
    assert known.refresh("s", source) == 0 and known.position("s") is None
    stage(spark, source, (D(2024, 1, 5), 1, "new"))
    assert known.refresh("s", source) == 1
    # published late: its bytes are an hour older than the newest known file
    have = set(parts(source))
    stage(spark, source, (D(2024, 1, 6), 1, "late"))
    late = f"{source}/{(set(parts(source)) - have).pop()}"
    st = os.stat(late)
    os.utime(late, ns=(st.st_atime_ns, st.st_mtime_ns - 3600 * 10**9))
    assert known.refresh("s", source, slack_s=60) == 0   # outside the slack: taken as known
    assert known.refresh("s", source) == 1
    # the same name with another modification time is another file
    os.utime(late, ns=(st.st_atime_ns, st.st_mtime_ns - 1800 * 10**9))
    assert known.refresh("s", source) == 1
    # files that go do not move the position back
    os.remove(late)
    assert known.refresh("s", source) == 0 and known.position("s") == Position(D(2024, 1, 6), 1)


def test_rollup_factor_counts_groups_of_every_grain(spark):
    rows = [(D(2024, 1, 31, 23), "a"), (D(2024, 1, 31, 23, 59), "a"), (D(2024, 2, 1), "a"), (D(2024, 2, 1), "b"), (D(2024, 2, 1), None), (None, "a")]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, k string")
    got = {r.grain: (r.rows, r.groups, r.worth) for r in rollup_factor(df, "ts", ["week", "month", "hour"], ["k"], 2).collect()}
    assert got == {"hour": (6, 3, True), "week": (6, 2, True), "month": (6, 3, True)}
    got = {r.grain: r.groups for r in rollup_factor(df, "ts", ["week", "month"], ["k"]).collect()}
    assert got == {"week": 2, "month": 3}
    assert {r.grain: (r.rows, r.groups) for r in rollup_factor(df.limit(0), "ts", ["day"], ["k"]).collect()} == {"day": (0, 0)}
