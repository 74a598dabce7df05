"""Load jobs: incremental = full, replay idempotence, crash between write and commit,
replay that yields fewer partitions, reload publication, streaming = batch."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF
from factline.functions.exprs import month_key
from factline.plans.load import (PositionStore, Target, drain, load_reload, load_step, publish, read_fact,
                                 read_published, write_block)
from factline.streaming.stream import file_stream, stream_load

D = dt.datetime
FAR = D(2099, 1, 1)


def orders(spark):
    return spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_orderdate", "o_custkey",
                                                             "o_totalprice")


def transform(block):
    return block.withColumn("o_month", month_key("o_orderdate"))


def rows(df):
    return sorted(tuple(r) for r in df.select("o_orderkey", "o_orderdate", "o_custkey").collect())


def test_incremental_equals_full(spark, tmp):
    src = orders(spark)
    store = PositionStore(spark, f"{tmp}/pos")
    target = Target(root=f"{tmp}/fact", partition_by=["o_month"], keys=["o_orderkey"])
    res = drain(lambda: load_step(spark, "t", src, transform, target, store, D(2024, 1, 1), gate=FAR,
                                  max_step=400, pos="o_orderdate", id="o_orderkey"))
    assert [r.rows for r in res] == [400, 400, 400, 300]
    assert rows(read_fact(spark, target.root, store)) == rows(src)
    # gate safety: nothing at or after the gate is loaded
    store2 = PositionStore(spark, f"{tmp}/pos2")
    target2 = Target(root=f"{tmp}/fact2", keys=["o_orderkey"])
    gate = D(1997, 1, 1)
    drain(lambda: load_step(spark, "t", src, transform, target2, store2, D(2024, 1, 1), gate=gate,
                            max_step=10000, pos="o_orderdate", id="o_orderkey"))
    f = read_fact(spark, target2.root, store2)
    assert f.filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")).count() == 0
    assert f.count() == src.filter(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")).count()


def test_crash_after_write_replays_same_block(spark, tmp):
    src = orders(spark)
    store = PositionStore(spark, f"{tmp}/pos")
    target = Target(root=f"{tmp}/fact", partition_by=["o_month"], keys=["o_orderkey"])
    first = load_step(spark, "t", src, transform, target, store, D(2024, 1, 1), gate=FAR, max_step=500,
                      pos="o_orderdate", id="o_orderkey")
    # simulate: the next block is planned and written, then the process dies before the commit
    store.append("t", last=first.next, nxt=None, rows=0)  # placeholder to move seq (no-op row)
    cur = store.current("t")
    from factline.operators.positions import next_block
    plan = next_block(src, first.next, FAR, 500, "o_orderdate", "o_orderkey")
    from factline.plans.load import make_block_id
    bid = make_block_id("t", first.next, plan.next)
    store.append("t", last=first.next, nxt=plan.next, rows=plan.rows, processor="FullStep", state="processing",
                 block_id=bid)
    from factline.operators.positions import block_filter
    write_block(transform(block_filter(src, first.next, plan.next, "o_orderdate", "o_orderkey")), target.root,
                bid, ["o_month"])
    # more rows "arrive" below the gate meanwhile: the retry must not compute a new next
    PositionStore.forget(f"{tmp}/pos")
    fresh = PositionStore(spark, f"{tmp}/pos")   # a new process reads the log
    r = load_step(spark, "t", src, transform, target, fresh, D(2024, 1, 1), gate=FAR, max_step=900,
                  pos="o_orderdate", id="o_orderkey")
    assert r.status == "replayed" and r.next == plan.next and r.block_id == bid
    drain(lambda: load_step(spark, "t", src, transform, target, fresh, D(2024, 1, 1), gate=FAR, max_step=500,
                            pos="o_orderdate", id="o_orderkey"))
    f = read_fact(spark, target.root, store)
    assert f.count() == src.count() and f.select("o_orderkey").distinct().count() == src.count()


def test_replay_with_fewer_partitions_leaves_nothing(spark, tmp):
    src = orders(spark).limit(50)
    root, store = f"{tmp}/fact", PositionStore(spark, f"{tmp}/pos")
    target = Target(root=root, dedup=None, partition_by=["o_month"])
    publish(transform(src), target, "bX")
    _, commit = publish(transform(src).limit(1), target, "bX")
    assert read_fact(spark, root, store) is None    # nothing committed
    store.append("t", last=None, **commit)
    assert read_fact(spark, root, store).count() == 1
    _, commit = publish(transform(src).limit(0), target, "bY")
    store.append("t", last=None, **commit)
    assert read_fact(spark, root, store).count() == 1   # a block without rows publishes nothing


def test_dedup_on_insert_and_replay(spark, tmp):
    from factline.operators.lookup import new_rows
    from factline.plans.load import loaded_keys
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n"), (None, "n")], "k bigint, v string")
    store = PositionStore(spark, f"{tmp}/pos")
    for keyed in (True, False):     # the keys of b1 from its digest, or from the rows of a job without one
        root = f"{tmp}/fact{keyed}"
        target = Target(root=root, keys=["k"])
        _, commit = publish(spark.createDataFrame([(2, "old")], "k bigint, v string"), Target(root=root, dedup="new" if keyed else None, keys=["k"]), "b1")
        store.append("t", last=None, **commit)
        for _ in range(2):   # a replay of b2 excludes its own rows from the dedup side: still written once
            _, commit = publish(new_rows(df, loaded_keys(spark, store, root, df, ["k"], "b2"), ["k"]), target, "b2")
        store.append("t", last=None, **commit)
        got = sorted(((r.k, r.v) for r in read_fact(spark, root, store).collect()), key=repr)
        assert got == [(1, "a"), (2, "old"), (None, "n"), (None, "n")]


def test_reload_publishes_versions(spark, tmp):
    store = PositionStore(spark, f"{tmp}/pos")
    c = spark.read.parquet(f"{SF}/customer.parquet")
    r1 = load_reload(spark, "dim", lambda: c.filter("c_acctbal > 0"), f"{tmp}/t", store, D(2024, 1, 1))
    r2 = load_reload(spark, "dim", lambda: c, f"{tmp}/t", store, D(2024, 1, 2))
    assert r1.block_id != r2.block_id
    assert read_published(spark, store, "dim").count() == c.count()


def test_streaming_equals_batch(spark, tmp):
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "ts", "user_id")
    ev.repartitionByRange(4, "ts").write.parquet(f"{tmp}/stage")
    target, store = Target(root=f"{tmp}/fact", keys=["event_id"]), PositionStore(spark, f"{tmp}/pos")
    stream_load(spark, file_stream(spark, f"{tmp}/stage", ev.schema, max_files=1), "s", lambda b: b, target,
                f"{tmp}/ckpt", store)
    # a second run over the same checkpoint finds nothing new and changes nothing
    stream_load(spark, file_stream(spark, f"{tmp}/stage", ev.schema, max_files=1), "s", lambda b: b, target,
                f"{tmp}/ckpt", store)
    f = read_fact(spark, target.root, store)
    assert f.count() == ev.count() and f.select("block_id").distinct().count() == 4


def test_planned_drain_equals_stepwise(spark, tmp):
    from factline.plans.load import drain_planned
    src = orders(spark)
    for uniq in (False, True):
        s1, s2 = PositionStore(spark, f"{tmp}/a{uniq}"), PositionStore(spark, f"{tmp}/b{uniq}")
        t1, t2 = Target(root=f"{tmp}/fa{uniq}", dedup=None), Target(root=f"{tmp}/fb{uniq}", dedup=None)
        kw = dict(gate=FAR, max_step=40 if uniq else 350, pos="o_orderdate",
                  id="o_custkey" if uniq else "o_orderkey", uniq=uniq)
        a = drain(lambda: load_step(spark, "t", src, transform, t1, s1, D(2024, 1, 1), **kw))
        b = drain_planned(spark, "t", src, transform, t2, s2, D(2024, 1, 1), horizon=2, **kw)
        edges = lambda rs: [(r.next, r.rows) for r in rs if r.status != "nojobs"]
        assert edges(a) == edges(b) and len(edges(a)) >= 3
        assert rows(read_fact(spark, t1.root, s1)) == rows(read_fact(spark, t2.root, s2))


def test_compact_blocks_with_crash(spark, tmp, monkeypatch):
    """One copy is visible at every point, and an open block of another tag survives."""
    import factline.plans.sink as K
    from factline.operators.positions import next_block
    from factline.plans.load import block_dirs, compact_blocks, make_block_id
    src = orders(spark)
    store = PositionStore(spark, f"{tmp}/pos")
    target = Target(root=f"{tmp}/fact", partition_by=["o_month"], keys=["o_orderkey"])
    kw = dict(gate=FAR, max_step=400, pos="o_orderdate", id="o_orderkey")
    drain(lambda: load_step(spark, "t", src, transform, target, store, D(2024, 1, 1), **kw))
    before = rows(read_fact(spark, target.root, store))
    assert len(block_dirs(spark, target.root)) == 4
    # another tag has begun a block and died after the write
    extra = src.limit(30).withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000).cache()
    plan = next_block(extra, None, FAR, 400, "o_orderdate", "o_orderkey")
    open_id = make_block_id("t#x", None, plan.next)
    store.append("t#x", last=None, nxt=plan.next, rows=30, processor="Step", state="processing", block_id=open_id)
    write_block(transform(extra), target.root, open_id, ["o_month"])
    assert rows(read_fact(spark, target.root, store)) == before
    # a crash before the merged folder is published, then one after it, before the sources are deleted
    real = PositionStore.append
    monkeypatch.setattr(PositionStore, "append", lambda self, topic, **k: real(self, topic, **k) if k.get("nxt") else 1 / 0)
    try:
        compact_blocks(spark, "t", target, store, D(2024, 1, 2))
    except ZeroDivisionError:
        pass
    monkeypatch.setattr(PositionStore, "append", real)
    assert rows(read_fact(spark, target.root, store)) == before and len(block_dirs(spark, target.root)) == 6
    monkeypatch.setattr(K, "delete_path", lambda *a: 1 / 0)
    try:
        compact_blocks(spark, "t", target, store, D(2024, 1, 2))
    except ZeroDivisionError:
        pass
    monkeypatch.undo()
    assert rows(read_fact(spark, target.root, store)) == before and len(store.live(target.root).folders) == 1
    PositionStore.forget(f"{tmp}/pos")
    fresh = PositionStore(spark, f"{tmp}/pos")
    assert K.vacuum(spark, fresh, target.root, D(2024, 1, 3)) == 4
    assert len(block_dirs(spark, target.root)) == 2     # the merged one and the open one
    assert compact_blocks(spark, "t", target, fresh, D(2024, 1, 3)).status == "nojobs"
    # the open block is replayed on top, and nothing is doubled by a further load
    r = load_step(spark, "t#x", extra, transform, target, fresh, D(2024, 1, 4), **kw)
    assert r.status == "replayed" and read_fact(spark, target.root, fresh).count() == src.count() + 30
    store2 = PositionStore(spark, f"{tmp}/pos")
    store2.append("again", last=None)
    drain(lambda: load_step(spark, "again", src, transform, target, store2, D(2024, 1, 5), **kw))
    assert read_fact(spark, target.root, store2).count() == src.count() + 30


def test_tiers_rewrite_a_row_a_logarithmic_number_of_times(spark, tmp):
    from factline.plans.sink import compact_step, publish
    store, target, written = PositionStore(spark, f"{tmp}/pos"), Target(root=f"{tmp}/fact", dedup=None), 0
    for i in range(16):
        metrics, commit = publish(spark.range(10 * i, 10 * i + 10), target, f"b{i}")
        store.append("t", last=None, log=metrics, block_id=f"b{i}", run=D(2024, 1, 1), **commit)
        while (step := compact_step(spark, "t", target, store, D(2024, 1, 2), 4)) is not None:
            written += 1
            assert read_fact(spark, target.root, store).count() == 10 * i + 10
    # 16 blocks of 10 rows: four merges of four blocks, then one of those four
    assert written == 5 and len(store.live(target.root).folders) == 1
    assert store.block_log().count() == 16      # merges are no loads


def test_retention_deletes_partitions_and_hides_them_first(spark, tmp, monkeypatch):
    import factline.plans.sink as K
    store = PositionStore(spark, f"{tmp}/pos")
    target = Target(root=f"{tmp}/fact", dedup=None, partition_by=["kind", "month"])
    df = spark.range(100).select("id", (F.col("id") % 3).alias("kind"), (F.col("id") % 10).cast("int").alias("month"))
    for i in range(2):
        metrics, commit = K.publish(df, target, f"b{i}")
        store.append("t", last=None, **commit)
    monkeypatch.setattr(K, "delete_path", lambda *a: 1 / 0)
    try:
        K.retain_partitions(spark, "t", target, store, D(2024, 1, 1), "month", 4)
    except ZeroDivisionError:
        pass
    monkeypatch.undo()
    left = lambda: (read_fact(spark, target.root, store).count(), read_fact(spark, target.root, store).agg(F.min("month")).first()[0])
    assert left() == (120, 4)
    assert len(K.retain_partitions(spark, "t", target, store, D(2024, 1, 1), "month", 4)) == 24
    assert left() == (120, 4) and K.retain_partitions(spark, "t", target, store, D(2024, 1, 2), "month", 4) == []


def test_log_rows_and_errors_of_replays(spark, tmp):
    """A replayed block has one log row, in the commit rows and in a log table; a failed run leaves an error row."""
    src, store = orders(spark), PositionStore(spark, f"{tmp}/pos")
    target = Target(root=f"{tmp}/fact", dedup=None, log_path=f"{tmp}/log", error_path=f"{tmp}/errors", log_id="o_orderkey")
    kw = dict(gate=FAR, max_step=5000, pos="o_orderdate", id="o_orderkey")
    crash = lambda *_: (_ for _ in ()).throw(RuntimeError("lost"))
    for hook in (crash, crash, None):
        try:
            load_step(spark, "t", src, transform, target, store, D(2024, 1, 1), after=hook, **kw)
        except RuntimeError:
            assert read_fact(spark, target.root, store) is None
    assert store.block_log().count() == 1 and spark.read.parquet(f"{tmp}/log").count() == 1
    assert [r.err for r in spark.read.parquet(f"{tmp}/errors").collect()] == ["lost", "lost"]
    run = store.runs().first()
    assert run.read_rows == run.written_rows == src.count() and run.duration_ms > 0


def test_group_jobs_do_not_depend_on_the_blocks(spark, tmp):
    from factline.plans.load import drain_planned
    src = orders(spark)
    jobs = []
    for size in (100, 700):
        store, target = PositionStore(spark, f"{tmp}/p{size}"), Target(root=f"{tmp}/f{size}", dedup=None)
        spark.sparkContext.setJobGroup(f"g{size}", "count")
        out = drain_planned(spark, "t", src, transform, target, store, D(2024, 1, 1), gate=FAR, max_step=size,
                            pos="o_orderdate", id="o_orderkey")
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"g{size}")))
        assert len(out) == -(-1500 // size) and rows(read_fact(spark, target.root, store)) == rows(src)
        assert store.read().count() == 2    # a begin and a commit row
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def test_crashed_group_is_replayed_with_its_own_edges(spark, tmp):
    from factline.plans.load import drain_planned
    src = spark.createDataFrame([(D(2024, 1, 1 + i // 3), i % 5, i) for i in range(60)], "pos timestamp_ntz, id bigint, v int")
    kw = dict(gate=FAR, max_step=2, uniq=True, uniq_order=["v"])
    store, target = PositionStore(spark, f"{tmp}/p"), Target(root=f"{tmp}/f", dedup=None)
    want_store, want_target = PositionStore(spark, f"{tmp}/p2"), Target(root=f"{tmp}/f2", dedup=None)
    drain_planned(spark, "t", src, lambda b: b, want_target, want_store, D(2024, 1, 1), **kw)
    try:
        drain_planned(spark, "t", src, lambda b: 1 / 0, target, store, D(2024, 1, 1), **kw)
    except ZeroDivisionError:
        pass
    PositionStore.forget(f"{tmp}/p")
    out = drain_planned(spark, "t", src, lambda b: b, target, PositionStore(spark, f"{tmp}/p"), D(2024, 1, 1), **kw)
    assert out[0].status == "replayed"
    got = lambda s, t: sorted(tuple(r)[:3] for r in read_fact(spark, t.root, s).collect())
    assert got(store, target) == got(want_store, want_target)


def test_stream_moves_a_position_that_gates_batch_loads(spark, tmp):
    from factline.operators.gate import dep_gate
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "ts", "user_id")
    ev.write.parquet(f"{tmp}/stage")
    store, target = PositionStore(spark, f"{tmp}/pos"), Target(root=f"{tmp}/fact", keys=["event_id"])
    load = lambda ck: stream_load(spark, file_stream(spark, f"{tmp}/stage", ev.schema, max_files=1), "s", lambda b: b,
                                  target, ck, store, now=D(2024, 1, 1), pos="ts", id="event_id")
    load(f"{tmp}/a")
    newest = ev.agg(F.max("ts")).first()[0]
    assert dep_gate(store.read(), ["s"], 0, FAR) == (newest, "s")
    # a batch that was committed before the stream's own checkpoint was lost is not written twice
    n = store.read().count()
    import shutil
    shutil.rmtree(f"{tmp}/a")
    load(f"{tmp}/a")
    assert store.read().count() == n and read_fact(spark, target.root, store).count() == ev.count()
    # a second stream into the same table shares nothing but the keys
    load(f"{tmp}/b")
    assert read_fact(spark, target.root, store).count() == ev.count()


def test_stream_dedup(spark, tmp):
    from factline.streaming.stream import stream_dedup
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "ts", "user_id")
    ev.write.parquet(f"{tmp}/a")
    ev.write.parquet(f"{tmp}/b")          # the same rows delivered twice
    src = file_stream(spark, f"{tmp}/[ab]", ev.schema, max_files=1)
    target, store = Target(root=f"{tmp}/fact", dedup=None), PositionStore(spark, f"{tmp}/pos")
    stream_load(spark, stream_dedup(src, ["event_id"], "ts", "365 days"), "s", lambda b: b, target, f"{tmp}/ck", store)
    f = read_fact(spark, target.root, store)
    assert f.count() == ev.count()


def test_shard_union_equals_unsharded(spark, tmp):
    """Each shard is its own topic `t:i` with its own positions; the union of
    the shard loads equals the unsharded load."""
    from factline.operators.positions import shard_filter
    src = orders(spark)
    store = PositionStore(spark, f"{tmp}/pos")
    target = Target(root=f"{tmp}/fact", partition_by=["o_month"], keys=["o_orderkey"])
    for i in range(2):
        part = shard_filter(src, "o_orderkey", 2, i)
        drain(lambda p=part, i=i: load_step(spark, f"t:{i}", p, transform, target, store, D(2024, 1, 1), gate=FAR,
                                            max_step=500, pos="o_orderdate", id="o_orderkey"))
    assert rows(read_fact(spark, target.root, store)) == rows(src)
    assert store.current("t:0")["last"] != store.current("t:1")["last"]


def test_months_between():
    from factline.operators.positions import Position
    from factline.plans.load import months_between
    f = months_between("m")
    assert f(Position(D(1996, 11, 30), 1), Position(D(1997, 2, 1), 0)) == {"m": [199611, 199612, 199701, 199702]}
    assert f(None, Position(D(1997, 2, 1), 0)) is None
