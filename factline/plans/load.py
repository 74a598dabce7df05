"""Incremental load jobs.

One call loads one block, or a group of planned blocks:

1. read the topic's current position row; an unfinished block (a *begin* row
   without its *commit*) is replayed with the same `last`/`next` (B7);
2. otherwise plan: gate (G1 or explicit) + policy (rows, distinct ids, time range, now)
   and append a begin row.  A drain plans up to `horizon` blocks at once and loads them as
   one group: the begin row lists the blocks' edges, so that a replay forms the same ones;
3. read the rows with the pushdown-friendly predicate (B1) - in a group each row finds its
   block by a search in the sorted edges -, run the transform, deduplicate (L3 for append-only
   facts, W1 for mutable ones), and overwrite the folder `block_id=<id>` (K1), collecting log
   metrics with `observe` in the same pass (Q1);
4. append the commit row: `last := next` (B8), and the folder becomes visible.

A crash anywhere before 4 leaves the begin row and a folder that no reader sees; the retry
recomputes the same rows into the same folder.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from typing import Callable

import xxhash
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.gate import dep_gate, precheck_message
from ..operators.lookup import first_rows, latest, new_rows
from ..operators.positions import (DEFAULT_MAX_STEP, Block, Position, block_filter, block_of_edges, next_block,
                                   next_block_uniq, next_now, next_range, plan_blocks, shard_filter)
from ..session import work_dir
from .sink import (Target, append_error, append_log, block_dirs, compact_step, conform, delete_path,  # noqa: F401
                   loaded_keys, log_fields, publish, read_fact, retain_partitions, vacuum, write_block)
from .store import POSITIONS_SCHEMA, PositionStore  # noqa: F401


def make_block_id(topic: str, last: Position | None, nxt: Position) -> str:
    key = f"{topic}|{last.pos.isoformat() if last else ''}|{last.id if last else ''}|{nxt.pos.isoformat()}|{nxt.id}"
    return "b" + xxhash.xxh64_hexdigest(key)


@dataclass
class LoadResult:
    status: str                      # done | nojobs | replayed
    topic: str
    last: Position | None = None
    next: Position | None = None
    rows: int = 0
    full: bool = False
    state: str = ""
    block_id: str = ""
    metrics: dict = field(default_factory=dict)
    message: str = ""


def _minutes(last: Position | None, nxt: Position) -> str:
    return f"{int((nxt.pos - last.pos).total_seconds() // 60) if last else 0}min"


def dedup_block(out: DataFrame, target: Target, store: PositionStore, block_id: str, pos: str = "pos",
                id: str = "id") -> DataFrame:
    """The target's dedup of a transformed block: newest row per key (W1), or rows whose keys are new (L3).

    Without `target.order`, the first version is the one at the least position, if the rows
    still carry it, then the least by content: a replay keeps the same one.
    """
    if target.dedup == "latest" and target.keys:
        return latest(out, target.keys, target.order or [])
    if target.dedup == "new" and target.keys:
        spark, order = out.sparkSession, target.order or first_order(out, target.keys, pos, id)
        live = store.live(target.root)
        if not set(live.folders) - {block_id}:
            return new_rows(out, None, target.keys, order=order)
        # the keys' range, the join that narrows the fact and the anti-join each read the block: its transform runs once
        out = staged(first_rows(out, target.keys, order), block_id)
        return new_rows(out, loaded_keys(spark, store, target.root, out, target.keys, block_id, live), target.keys, first=True)
    return out


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written to a fresh folder below spark.checkpoint.dir and read back; columns of no type are not stored."""
    path, stored = work_dir(df.sparkSession, f"staged-{name}"), [c for c, kind in df.dtypes if kind != "void"]
    held = df.select(*stored)
    held.write.parquet(path)
    back = df.sparkSession.read.schema(held.schema).parquet(path)
    return back.select(*[c if c in stored else F.lit(None).alias(c) for c in df.columns])


def first_order(out: DataFrame, keys: list[str], pos: str = "pos", id: str = "id") -> list:
    """Position, then every column that has an order."""
    named = [c for c in (pos, id) if c in out.columns and c not in keys]
    rest = [f.name for f in out.schema.fields if f.name not in (*keys, *named) and "map<" not in f.dataType.simpleString()
            and "variant" not in f.dataType.simpleString()]
    return named + rest


def _run_block(spark, topic, source, transform, target: Target, store: PositionStore, last, nxt, rows,
               processor, now, pos, id, replay, block_prep=None, before=None, after=None,
               edges: list[Position] | None = None):
    block_id = make_block_id(topic, last, nxt)
    began = time.monotonic()
    if not replay:
        store.append(topic, last=last, nxt=nxt, rows=rows, run=now, processor=processor,
                     state="processing", block_id=block_id, edges=edges)
    try:
        if before:
            before(spark)
        block = block_filter(source, last, nxt, pos, id) if source is not None else None
        if block_prep is not None:
            block = block_prep(block, edges)
        out = dedup_block(transform(block), target, store, block_id, pos, id)
        if target.schema:
            out = conform(out, target.schema)
        metrics, commit = publish(out, target, block_id)
        if target.log_path:
            append_log(spark, target.log_path, topic, now, metrics, target.checks, block_id)
        if after:
            after(spark)
    except Exception as e:
        if target.error_path:
            append_error(spark, target.error_path, topic, now, e)
        raise
    store.append(topic, last=nxt, rows=rows, run=now, processor=processor, state=_minutes(last, nxt),
                 block_id=block_id, log=log_fields(metrics, target.checks),
                 elapsed_ms=int(1000 * (time.monotonic() - began)), **commit)
    return LoadResult("replayed" if replay else "done", topic, last, nxt, rows,
                      processor.startswith("Full"), _minutes(last, nxt), block_id, metrics)


def months_between(column: str):
    """Values of a yyyymm partition column between two positions, for partition filters."""
    def values(last: Position | None, nxt: Position) -> dict | None:
        if last is None:
            return None
        y, m, out = last.pos.year, last.pos.month, []
        while (y, m) <= (nxt.pos.year, nxt.pos.month):
            out.append(y * 100 + m)
            y, m = (y + 1, 1) if m == 12 else (y, m + 1)
        return {column: out}
    return values


def _open_block(store: PositionStore, topic: str):
    cur = store.current(topic)
    if cur is not None and cur["next"] is not None:
        return cur, True
    return cur, False


def _last_of(cur) -> Position | None:
    return Position.of(cur["last"]) if cur is not None and cur["last"] is not None else None


def _uniq_prep(uniq: bool, uniq_order, pos: str, id: str):
    """Newest version of each id inside its block."""
    if not uniq:
        return None
    order = [pos] + list(uniq_order or [])

    def prep(block, edges):
        if not edges:
            return latest(block, [id], order)
        return latest(block.withColumn("_block_no", block_of_edges(edges, pos, id)), ["_block_no", id], order).drop("_block_no")
    return prep


def shard_topic(topic: str, shard: tuple | None) -> str:
    return f"{topic}:{shard[1]}" if shard else topic


def load_step(spark: SparkSession, topic: str, source: DataFrame, transform: Callable[[DataFrame], DataFrame],
              target: Target, store: PositionStore, now, *, gate=None, positions: DataFrame | None = None,
              deps: list[str] | None = None, delay_s: int = 0, max_step: int = DEFAULT_MAX_STEP,
              pos: str = "pos", id: str = "id", uniq: bool = False, uniq_order: list[str] | None = None,
              before=None, after=None, shard: tuple | None = None, shard_key: str | None = None) -> LoadResult:
    """P1 Step (and P2 UniqId with `uniq=True`).

    The gate is `gate` when given, else G1 over `positions` for `deps` (D27: the
    base source is normally its own first dependency).  `shard=(n, i)` loads shard i of n (B10): the
    topic becomes `topic:i` with a position of its own, the source is cut to the shard's
    rows by `shard_key` (the id column if not given), and the gate takes the shard's own
    positions of sharded dependencies.
    """
    if shard:
        topic, source = shard_topic(topic, shard), shard_filter(source, shard_key or id, *shard)
    cur, replay = _open_block(store, topic)
    edges = None
    if replay:
        last, nxt, rows = Position.of(cur["last"]), Position.of(cur["next"]), int(cur["rows"])
        processor, edges = cur["processor"], [Position.of(e) for e in cur["edges"] or []] or None
    else:
        last = _last_of(cur)
        laggard = None
        if gate is None:
            gate, laggard = dep_gate(positions, deps, delay_s, now, shard=str(shard[1]) if shard else None)
            if gate is None:
                return LoadResult("nojobs", topic, last, None, 0, False, laggard or "missing",
                                  message=f"NOJOBS {topic}: dependencies missing")
        plan = (next_block_uniq if uniq else next_block)(source, last, gate, max_step, pos, id)
        if plan.empty:
            return LoadResult("nojobs", topic, last, None, 0, False, laggard or "",
                              message=precheck_message(topic, last, None, 0, laggard, now))
        nxt, rows = plan.next, plan.rows
        base = "UniqId" if uniq else "Step"
        processor = ("Full" + base) if plan.full else base
    res = _run_block(spark, topic, source, transform, target, store, last, nxt, rows, processor, now,
                     pos, id, replay, _uniq_prep(uniq, uniq_order, pos, id), before, after, edges)
    res.message = precheck_message(topic, last, nxt, rows, None, now)
    return res


def _run_group(spark, topic, source, transform, target, store, plan: list[Block], processor, now, pos, id,
               prep=None) -> list[LoadResult]:
    """One write, one begin and one commit row for all blocks of a plan; a result per block."""
    last, nxt, rows = plan[0].last, plan[-1].next, sum(b.rows for b in plan)
    res = _run_block(spark, topic, source, transform, target, store, last, nxt, rows, processor, now, pos, id,
                     False, prep, edges=[b.next for b in plan])
    return [LoadResult(res.status, topic, b.last, b.next, b.rows, b.full, _minutes(b.last, b.next), res.block_id,
                       res.metrics, precheck_message(topic, b.last, b.next, b.rows, None, now)) for b in plan]


def drain_planned(spark: SparkSession, topic: str, source: DataFrame, transform, target: Target,
                  store: PositionStore, now, *, gate, max_step: int = DEFAULT_MAX_STEP, pos: str = "pos",
                  id: str = "id", uniq: bool = False, uniq_order: list[str] | None = None,
                  horizon: int = 1000, per_block: bool = False, shard: tuple | None = None,
                  shard_key: str | None = None) -> list[LoadResult]:
    """P7 under a fixed gate: finish an open block, then plan up to `horizon` blocks in one pass
    (`plan_blocks`) and load them as one group, until nothing is pending.

    The number of jobs depends on the horizons, not on the blocks.  The table equals that of the
    step-by-step drain for transforms that work row by row (joins, filters, projections);
    `uniq` keeps the newest version of an id per block, as stepping would.  A transform that
    aggregates over its block needs `per_block=True`: then every block is a write of its own.
    """
    if shard:
        topic, source = shard_topic(topic, shard), shard_filter(source, shard_key or id, *shard)
    kw = dict(gate=gate, max_step=max_step, pos=pos, id=id, uniq=uniq, uniq_order=uniq_order)
    out = []
    if _open_block(store, topic)[1]:
        out.append(load_step(spark, topic, source, transform, target, store, now, **kw))
    prep, base = _uniq_prep(uniq, uniq_order, pos, id), "UniqId" if uniq else "Step"
    while True:
        plan = plan_blocks(source, _last_of(store.current(topic)), gate, max_step, pos, id, uniq, horizon)
        for group in ([[b] for b in plan] if per_block else [plan] if plan else []):
            processor = ("Full" if group[-1].full else "") + base
            out += _run_group(spark, topic, source, transform, target, store, group, processor, now, pos, id, prep)
        if len(plan) < horizon:
            break
    if not plan:
        out.append(LoadResult("nojobs", topic, _last_of(store.current(topic)), None, 0, False, "",
                              message=precheck_message(topic, None, None, 0, None, now)))
    return out


def load_range(spark: SparkSession, topic: str, source: DataFrame, transform, target: Target,
               store: PositionStore, now, *, max_step_s: int, delay_s: int = 0, pos: str = "pos",
               id: str = "id", before=None, after=None) -> LoadResult:
    """P3 Range: a fixed time window after `last`, no gate, rows not counted."""
    cur, replay = _open_block(store, topic)
    edges = None
    if replay:
        last, nxt = Position.of(cur["last"]), Position.of(cur["next"])
        edges = [Position.of(e) for e in cur["edges"] or []] or None
    else:
        last = _last_of(cur)
        if last is None:
            raise ValueError(f"topic {topic} needs an initial position for Range")
        nxt = next_range(last, max_step_s, delay_s, now)
        if nxt is None:
            return LoadResult("nojobs", topic, last, None, 0, False, "range not forward",
                              message=f"NOJOBS {topic}: range not forward")
    return _run_block(spark, topic, source, transform, target, store, last, nxt, 1, "Range", now,
                      pos, id, replay, None, before, after, edges)


def drain_ranges(spark: SparkSession, topic: str, source: DataFrame, transform, target: Target,
                 store: PositionStore, now, *, max_step_s: int, delay_s: int = 0, pos: str = "pos", id: str = "id",
                 horizon: int = 1000) -> list[LoadResult]:
    """P3 drained: the windows up to `now - delay_s`, at most `horizon` per group, one write per group."""
    out = []
    if _open_block(store, topic)[1]:
        out.append(load_range(spark, topic, source, transform, target, store, now, max_step_s=max_step_s,
                              delay_s=delay_s, pos=pos, id=id))
    while True:
        last, plan = _last_of(store.current(topic)), []
        if last is None:
            raise ValueError(f"topic {topic} needs an initial position for Range")
        while len(plan) < horizon and (nxt := next_range(last, max_step_s, delay_s, now)) is not None:
            plan.append(Block(last, nxt, 1))
            last = nxt
        if not plan:
            return out + [LoadResult("nojobs", topic, last, None, 0, False, "range not forward",
                                     message=f"NOJOBS {topic}: range not forward")]
        out += _run_group(spark, topic, source, transform, target, store, plan, "Range", now, pos, id)


def load_incremental(spark: SparkSession, topic: str, source: DataFrame, transform, target: Target,
                     store: PositionStore, now, *, pos: str = "pos", id: str = "id") -> LoadResult:
    """P5 Incremental2: window (last, (now, 0)], ungated."""
    cur, replay = _open_block(store, topic)
    if replay:
        last, nxt = Position.of(cur["last"]), Position.of(cur["next"])
    else:
        last = _last_of(cur)
        nxt = next_now(last, now)
        if nxt is None:
            return LoadResult("nojobs", topic, last, None, 0, False, "range not forward")
    return _run_block(spark, topic, source, transform, target, store, last, nxt, 1, "Incremental2", now,
                      pos, id, replay)


def load_reload(spark: SparkSession, topic: str, build: Callable[[], DataFrame], root: str,
                store: PositionStore, now, partition_by: list[str] | None = None,
                drop_old: bool = True) -> LoadResult:
    """P4 Reload: build the whole table into a new version folder, then publish it.

    Readers resolve the published folder from the positions row (`read_published`).
    The version number comes from the begin row, so a retry rewrites the same folder.
    """
    cur, replay = _open_block(store, topic)
    last = _last_of(cur)
    if replay:
        nxt, version = Position.of(cur["next"]), cur["block_id"]
    else:
        nxt = Position(now, 0)
        version = f"v{(cur['seq'] + 1) if cur else 0:08d}"
        store.append(topic, last=last, nxt=nxt, rows=1, run=now, processor="Reload", state="processing",
                     block_id=version, published=cur["published"] if cur else None)
    path = f"{root.rstrip('/')}/version={version}"
    obs = Observation(f"reload_{version}")
    w = build().observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    rows = int(obs.get.get("rows", 0))
    old = cur["published"] if cur else None
    store.append(topic, last=nxt, rows=rows, run=now, processor="Reload", state="published",
                 block_id=version, published=path)
    if drop_old and old and old != path:
        delete_path(spark, old)
    return LoadResult("replayed" if replay else "done", topic, last, nxt, rows, False, "published", version)


def read_published(spark: SparkSession, store: PositionStore, topic: str) -> DataFrame:
    cur = store.current(topic)
    if cur is None or not cur["published"]:
        raise ValueError(f"nothing published for {topic}")
    return spark.read.parquet(cur["published"])


def compact_blocks(spark: SparkSession, topic: str, target: Target, store: PositionStore, now,
                   min_blocks: int = 2, keep_s: int = 0) -> LoadResult:
    """K6 for a load's destination: merge tiers of at least `min_blocks` committed blocks of like size until
    there is none (`compact_step`)."""
    ctopic, out = f"{topic}#compact", None
    while (step := compact_step(spark, topic, target, store, now, min_blocks, keep_s)) is not None:
        cid, sources, replay = step
        out = LoadResult("replayed" if replay or (out and out.status == "replayed") else "done", ctopic, None,
                         Position(now, 0), len(sources), False, "compacted", cid)
    return out or LoadResult("nojobs", ctopic, message=f"NOJOBS {ctopic}: no {min_blocks} blocks of like size")


def sql_transform(sql: str, **frames: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A transform written as SQL text (the reference's transform views).

    The block is `{block}` in the text; other sources are passed by name and used as
    `{name}`.  They are bound as DataFrame parameters of `spark.sql`, so no temp
    view names are shared between concurrent loads.
    """
    def run(block: DataFrame) -> DataFrame:
        return block.sparkSession.sql(sql, block=block, **frames)
    return run


def drain(step: Callable[[], LoadResult], max_blocks: int | None = None,
          until_not_full: bool = True) -> list[LoadResult]:
    """Repeat a load while it keeps finding work (a full block continues at once).

    Stops at the first `nojobs`, or after a block that was not full when
    `until_not_full` (row-limited policies); exceptions propagate (D20).
    """
    out = []
    while max_blocks is None or len(out) < max_blocks:
        r = step()
        out.append(r)
        if r.status == "nojobs" or (until_not_full and not r.full):
            break
    return out
