"""The block sink (K1): block folders, their key digests (L3), committed reads, tiered compaction (K6), retention (K8).

A destination `root` holds one folder `block_id=<id>` per write, and beside it
`_keys/block_id=<id>`: the block's keys alone, in files per hash bucket, sorted.  Dedup on
insert reads digests, never the fact.  Which folders count is decided by the position log
(`PositionStore.live`), not by a listing.
"""

from __future__ import annotations

from dataclasses import dataclass

import xxhash
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.audit import LOG_SCHEMA, block_log_exprs
from ..operators.lookup import latest
from ..operators.positions import Position
from .store import Live, PositionStore, exists, hadoop_path


@dataclass
class Target:
    """Where and how a block lands."""
    root: str
    partition_by: list[str] | None = None
    dedup: str | None = "new"          # "new" (first version wins, L3) | "latest" (W1 in block) | None
    keys: list[str] | None = None
    order: list[str] | None = None     # total order within a key; the rows' content where none is given
    schema: str | None = None          # destination schema (D19)
    log_path: str | None = None
    log_ts: str | None = None
    log_id: str | None = None
    checks: dict | None = None
    key_buckets: int = 16              # hash buckets of the key digest
    error_path: str | None = None      # error log (Q3): one row per failed run


def conform(df: DataFrame, schema) -> DataFrame:
    """Sinks match columns by name: missing ones become NULL, extra ones are an error."""
    from pyspark.sql.types import StructType
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    extra = [c for c in df.columns if c not in st.fieldNames()]
    if extra:
        raise ValueError(f"columns not in the destination: {extra}")
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in st.fields])


def _folder(root: str, block_id: str) -> str:
    return f"{root.rstrip('/')}/block_id={block_id}"


def _digest(root: str, block_id: str) -> str:
    return f"{root.rstrip('/')}/_keys/block_id={block_id}"


# ---------------------------------------------------------------- writing

def write_block(df: DataFrame, root: str, block_id: str, partition_by: list[str] | None = None,
                log_ts: str | None = None, log_id: str | None = None, checks: dict | None = None,
                files_per_partition: int | None = None) -> dict:
    """K1: static overwrite of `root/block_id=<id>` (optionally partitioned).

    A replay replaces every file of the block, including partitions the new run no
    longer produces.  Log aggregates are observed during the same write.  Nobody reads
    the folder before a commit row names it.
    """
    obs = Observation(f"blk_{block_id}")
    observed = df.observe(obs, *block_log_exprs(log_ts, log_id, checks))
    if partition_by:
        # REBALANCE groups rows by the partition columns (few files per folder) while AQE
        # may still split a hot partition value across tasks and merge small ones
        observed = observed.repartition(files_per_partition, *partition_by) if files_per_partition \
            else observed.hint("rebalance", *partition_by)
    w = observed.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(_folder(root, block_id))
    try:
        return dict(obs.get)
    except Py4JJavaError:
        # a block that turns out empty while it runs loses its observation with the rest of its plan
        if df.sparkSession.read.schema(df.schema).parquet(_folder(root, block_id)).isEmpty():
            return {"rows": 0}
        raise


def _bucket(keys: list[str], buckets: int):
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def write_keys(spark: SparkSession, root: str, block_id: str, keys: list[str], buckets: int, schema) -> None:
    """The digest of a written block: its keys (rows with a NULL key are no duplicates of anything), per
    hash bucket, sorted, so that statistics prune ranges of growing ids."""
    folder = _folder(root, block_id)
    rows = spark.read.option("basePath", folder).parquet(folder)
    rows = rows.select(*[F.col(k).cast(schema[k].dataType).alias(k) for k in keys]).dropna()
    (rows.withColumn("kb", _bucket(keys, buckets)).repartition("kb").sortWithinPartitions("kb", *keys)
     .write.mode("overwrite").partitionBy("kb").parquet(_digest(root, block_id)))


def publish(df: DataFrame, target: Target, block_id: str) -> tuple[dict, dict]:
    """Write a block and, where the target deduplicates, its digest; returns the log metrics and what the
    commit row must carry.  A block without rows publishes no folder."""
    metrics = write_block(df, target.root, block_id, target.partition_by, target.log_ts, target.log_id, target.checks)
    keyed = target.dedup == "new" and target.keys and metrics.get("rows")
    if keyed:
        write_keys(df.sparkSession, target.root, block_id, target.keys, target.key_buckets, df.schema)
    return metrics, {"root": target.root, "folders": [block_id] if metrics.get("rows") else [],
                     "keys": _keys_text(target.keys, target.key_buckets) if keyed else None}


def _keys_text(keys: list[str], buckets: int) -> str:
    return f"{buckets}:" + ",".join(keys)


# ---------------------------------------------------------------- reading

def read_fact(spark: SparkSession, root: str, store: PositionStore | str, exclude_block: str | None = None,
              live: Live | None = None) -> DataFrame | None:
    """The committed rows of a destination (None where there are none), with `block_id`.

    Folders are taken from the commit rows of `store` and passed as paths: no listing of
    the root, nothing of a block between its write and its commit, one copy during compaction.
    """
    store = PositionStore(spark, store) if isinstance(store, str) else store
    live = live or store.live(root)
    names = sorted(n for n in live.folders if n != exclude_block)
    if not names:
        return None
    df = spark.read.option("basePath", root.rstrip("/")).parquet(*[_folder(root, n) for n in names])
    for column, value in live.cutoffs.items():
        kept = F.col(column) >= F.lit(value).cast(df.schema[column].dataType)
        df = df.filter(kept | F.col(column).isNull())
    return df


def loaded_keys(spark: SparkSession, store: PositionStore, root: str, block: DataFrame, keys: list[str],
                exclude_block: str | None = None, live: Live | None = None) -> DataFrame | None:
    """L3's fact side: the keys that committed blocks hold, from their digests.

    One aggregate over the block's keys gives its hash buckets and the range of its first
    key; both become literals, so other buckets' files are not listed to tasks and row
    groups out of range are skipped.  Folders that another job wrote without a digest of
    these keys are read for their key columns.
    """
    live = live or store.live(root)
    names = sorted(n for n in live.folders if n != exclude_block)
    if not names:
        return None
    groups: dict[int, list[str]] = {}
    for n in names:
        buckets, _, columns = (live.folders[n] or "").partition(":")
        groups.setdefault(int(buckets) if columns == ",".join(keys) else 0, []).append(n)
    sizes = [b for b in groups if b]
    st = block.select(*keys).dropna().agg(F.min(keys[0]).alias("lo"), F.max(keys[0]).alias("hi"),
                                          *[F.collect_set(_bucket(keys, b)).alias(f"b{b}") for b in sizes]).first()
    if st["lo"] is None:
        return None
    kind = block.schema[keys[0]].dataType
    inside = F.col(keys[0]).between(F.lit(st["lo"]).cast(kind), F.lit(st["hi"]).cast(kind))
    parts = []
    for b, members in groups.items():
        if b:
            df = spark.read.option("basePath", f"{root.rstrip('/')}/_keys").parquet(*[_digest(root, n) for n in members])
            parts.append(df.filter(F.col("kb").isin(list(st[f"b{b}"])) & inside).select(*keys))
        else:
            df = read_fact(spark, root, store, live=Live({n: None for n in members}, {}))
            parts.append(df.filter(inside).select(*keys))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def log_fields(metrics: dict, checks: dict | None) -> dict:
    nulls = {n: int(metrics.get(f"chk_{n}") or 0) for n in (checks or {}) if metrics.get(f"chk_{n}")}
    return {"rows": int(metrics.get("rows") or 0), "max_id": metrics.get("max_id"), "min_ts": metrics.get("min_ts"),
            "max_ts": metrics.get("max_ts"), "nulls": nulls}


def append_log(spark: SparkSession, log_path: str, topic: str, now, metrics: dict, checks: dict | None,
               run_id: str) -> None:
    """Q1 to a log table of its own: a folder per block, so that a replay replaces its row."""
    lg = log_fields(metrics, checks)
    row = (topic, now, lg["rows"], lg["max_id"], lg["min_ts"], lg["max_ts"], lg["nulls"], run_id)
    spark.createDataFrame([row], LOG_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{log_path.rstrip('/')}/block={run_id}")


def append_error(spark: SparkSession, path: str, topic: str, now, error: Exception) -> None:
    """Q3: one row (ts, topic, err) of a failed run."""
    spark.createDataFrame([(now, topic, str(error))], "ts timestamp_ntz, topic string, err string") \
        .coalesce(1).write.mode("append").parquet(path)


# ---------------------------------------------------------------- deleting

def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that no commit row names any more, through the Hadoop FileSystem of the path."""
    p, fs = hadoop_path(spark, path)
    fs.delete(p, True)


def child_dirs(spark: SparkSession, path: str) -> list[str]:
    p, fs = hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())


def block_dirs(spark: SparkSession, root: str) -> list[str]:
    """Block ids present on disk under a fact root, committed or not (one directory listing)."""
    return [n.split("=", 1)[1] for n in child_dirs(spark, root) if n.startswith("block_id=")]


def vacuum(spark: SparkSession, store: PositionStore, root: str, before) -> int:
    """Delete the folders that a commit row at or before `before` has removed; returns how many."""
    gone = store.commits(root).filter(F.col("run") <= F.lit(before)).select(F.explode("removed").alias("name")).distinct().collect()
    left = {r["name"] for r in gone} & set(block_dirs(spark, root))
    for name in left:
        delete_path(spark, _digest(root, name))
        delete_path(spark, _folder(root, name))
    return len(left)


def _open(store: PositionStore, topic: str):
    cur = store.current(topic)
    return cur, cur is not None and cur["next"] is not None


def tiers(rows: dict[str, int], fanout: int) -> list[list[str]]:
    """Folders grouped by the order of magnitude (to the base `fanout`) of their rows."""
    by: dict[int, list[str]] = {}
    for name, n in sorted(rows.items()):
        tier = 0
        while n >= fanout ** (tier + 1):
            tier += 1
        by.setdefault(tier, []).append(name)
    return [by[t] for t in sorted(by)]


def compact_step(spark: SparkSession, topic: str, target: Target, store: PositionStore, now, fanout: int = 4,
                 keep_s: int = 0):
    """K6: merge one tier of a destination's committed blocks; returns (merged folder, sources) or None.

    Blocks of like size are merged once there are `fanout` of them, so that a row is
    rewritten a logarithmic number of times.  A begin row (topic `<topic>#compact`) names
    the sources, then the merged folder and its digest are written, then one commit row
    publishes it in place of the sources, and only then are folders deleted, those that
    were replaced `keep_s` seconds ago or more (readers that resolved the old ones keep them
    that long).  A crash at any point leaves one copy visible; the retry rewrites the same
    folder.  Blocks without a commit row, of any tag, are not touched.  With
    `target.dedup == "latest"` the merge keeps the newest row per key (W1).
    """
    import datetime as _dt
    ctopic, root = f"{topic}#compact", target.root.rstrip("/")
    cur, replay = _open(store, ctopic)
    if replay:
        sources, cid = list(cur["removed"]), cur["block_id"]
    else:
        live = store.live(root).folders
        rows = {r["block_id"]: int(r["written"] or 0) for r in store.commits(root).filter("written is not null")
                .select("block_id", "written").filter(F.col("block_id").isin(list(live))).collect()}
        full = [t for t in tiers({n: rows.get(n, 0) for n in live}, fanout) if len(t) >= fanout]
        if not full:
            return None
        sources = full[0]
        cid = "c" + xxhash.xxh64_hexdigest(",".join(sources))
        store.append(ctopic, last=None, nxt=Position(now, 0), rows=len(sources), run=now, processor="Compact",
                     state="compacting", block_id=cid, root=root, removed=sources)
    whole = store.live(root)
    merged = read_fact(spark, root, store, live=Live({n: whole.folders.get(n) for n in sources}, whole.cutoffs)).drop("block_id")
    if target.dedup == "latest" and target.keys:
        merged = latest(merged, target.keys, target.order or [])
    metrics, commit = publish(merged, target, cid)
    store.append(ctopic, last=Position(now, 0), rows=len(sources), run=now, processor="Compact", state="compacted",
                 block_id=cid, removed=sources, log={"rows": metrics.get("rows")}, **commit)
    vacuum(spark, store, root, now - _dt.timedelta(seconds=keep_s))
    return cid, sources, replay


def retain_partitions(spark: SparkSession, topic: str, target: Target, store: PositionStore, now, column: str,
                      cutoff) -> list[str]:
    """K8: remove the whole partitions of `column` (one of `target.partition_by`) below `cutoff`; returns their folders.

    A begin row names the cutoff, the commit row publishes it (readers filter by it from
    then on, as a partition filter), then the folders go.  A retry, or the next run, deletes
    whatever a crash has left.  NULL partitions stay.
    """
    if column not in (target.partition_by or []):
        raise ValueError(f"{column} is no partition column of {target.root}")
    rtopic, root, state = f"{topic}#retain", target.root.rstrip("/"), f"{column}={cutoff}"
    cur, replay = _open(store, rtopic)
    if replay:
        state = cur["state"]
    else:
        store.append(rtopic, last=None, nxt=Position(now, 0), run=now, processor="Retain", state=state, root=root)
    store.append(rtopic, last=Position(now, 0), run=now, processor="Retain", state=state, root=root)
    limit, gone = type(cutoff)(state.split("=", 1)[1]), []
    depth = target.partition_by.index(column)
    for name in store.live(root).folders:
        folders = [_folder(root, name)]
        for _ in range(depth):
            folders = [f"{f}/{c}" for f in folders for c in child_dirs(spark, f)]
        for f in folders:
            for c in child_dirs(spark, f):
                key, _, value = c.partition("=")
                if key == column and value != "__HIVE_DEFAULT_PARTITION__" and type(cutoff)(value) < limit:
                    gone.append(f"{f}/{c}")
    for f in gone:
        delete_path(spark, f)
    return gone
