"""Upserts, collapsing rows, compaction, backup increments and retention (K2-K8).

Plain Parquet has no MERGE; every operation here produces the new state as a
DataFrame (or writes it to a new version folder) and leaves publication to the
caller (see `plans.load.load_reload` for the versioned-folder pattern).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import ts_lit
from .lookup import latest
from .positions import Position, after


def replace_latest(fact: DataFrame, new: DataFrame, keys: list[str], order: list[str],
                   partition_by: list[str] | None = None) -> DataFrame:
    """K2: newest version per key wins (ReplacingMergeTree + FINAL).

    With `partition_by`, only fact partitions that `new` touches (the NULL partition is one
    like others) are read and returned; the caller rewrites just those partitions.
    """
    cols = fact.columns
    if partition_by:
        touched = new.select(*[F.col(c).alias(f"_{c}") for c in partition_by]).distinct()
        fact = fact.join(touched, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in partition_by], "left_semi")
    return latest(fact.unionByName(new.select(*cols)), keys, order)


def sign_rows(state: DataFrame | None, block: DataFrame, keys: list[str], order: list[str],
              sign: str = "sign") -> DataFrame:
    """K3: collapsing rows for a block: `-1` for each key's current row, `+1` for
    the block's newest version of it.  Keys whose current row is newer than the
    block's (`order`) give no rows, so blocks may arrive late."""
    newest = latest(block, keys, order).withColumn(sign, F.lit(1).cast("int"))
    if state is None:
        return newest
    cur = state.drop(sign) if sign in state.columns else state
    newest = newest.join(_newer_keys(cur, newest, keys, order), keys, "left_anti")
    old = cur.join(newest.select(*keys), keys, "left_semi").withColumn(sign, F.lit(-1).cast("int"))
    return old.unionByName(newest.select(*old.columns))


def _newer_keys(state: DataFrame, changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keys whose row in `state` is newer than their row in `changes`; none if `state` lacks an order column."""
    versioned = [c for c in order if isinstance(c, str) and c in state.columns]
    if len(versioned) < len(order):
        return changes.select(*keys).limit(0)
    theirs = changes.select(*keys, F.struct(*order).alias("_change"))
    return state.select(*keys, F.struct(*order).alias("_current")).join(theirs, keys) \
        .filter("_current > _change").select(*keys)


def collapse(df: DataFrame, sign: str = "sign") -> DataFrame:
    """K4: read a collapsing table as state (FINAL): rows whose signs sum above zero."""
    payload = [c for c in df.columns if c != sign]
    return (df.groupBy(*payload).agg(F.sum(sign).alias("_s"))
            .filter(F.col("_s") > 0).drop("_s"))


def collapse_latest(df: DataFrame, keys: list[str], order: list[str], sign: str = "sign") -> DataFrame:
    """K4 for one row per key: newest positive row among keys with positive sum(sign)."""
    alive = df.groupBy(*keys).agg(F.sum(sign).alias("_s")).filter(F.col("_s") > 0).select(*keys)
    pos = df.filter(F.col(sign) > 0).join(alive, keys, "left_semi")
    return latest(pos, keys, order).drop(sign)


def apply_changes(state: DataFrame | None, changes: DataFrame, keys: list[str], order: list[str],
                  op: str, deletes: list[str], columns: list[str] | None = None,
                  tombstone: str | None = None) -> DataFrame:
    """K5: fold insert/update/delete events into the current state.

    The newest event per key decides (W1): a delete removes the key, anything
    else replaces the row.  Keys without events keep their state row, and so do keys
    whose state is newer than their events (a batch delivered late).  A state without
    the order columns can't tell.

    With `tombstone` (a column name), a delete stays in the state as a version: a row with
    its keys and order, that column true and all else NULL.  A late event of a deleted key
    then finds a newer version and changes nothing.  Read the state through `alive`;
    `drop_tombstones` removes those behind the retention horizon.
    """
    newest = latest(changes, keys, order)
    cols = columns or [c for c in changes.columns if c != op]
    gone = F.col(op).isin(deletes)
    if tombstone:
        held = {*keys, *[c for c in order if isinstance(c, str)]}
        newest = newest.select(op, *keys, *[c for c in order if isinstance(c, str) and c not in cols],
                               *[(F.col(c) if c in held else F.when(~gone, F.col(c))).alias(c) for c in cols if c not in keys],
                               F.coalesce(gone, F.lit(False)).alias(tombstone))
        cols = [*cols, *[c for c in order if isinstance(c, str) and c not in cols], tombstone]
    else:
        newest = newest.withColumn("_gone", gone)
    if state is not None:
        newest = newest.join(_newer_keys(state, newest, keys, order), keys, "left_anti")
    written = newest.select(*cols) if tombstone else newest.filter(~F.col("_gone")).select(*cols)
    if state is None:
        return written
    return state.join(newest.select(*keys), keys, "left_anti").select(*cols).unionByName(written)


def alive(state: DataFrame, tombstone: str) -> DataFrame:
    """K5: the state's rows without its deleted keys."""
    return state.filter(~F.col(tombstone)).drop(tombstone)


def drop_tombstones(state: DataFrame, tombstone: str, ts: str, horizon) -> DataFrame:
    """K5, K6: forget deletes older than `horizon`, the age beyond which no event is delivered."""
    return state.filter(~(F.col(tombstone) & (F.col(ts) < ts_lit(horizon))))


def files_per_partition(df: DataFrame, partition_by: list[str], part: str | None = None) -> DataFrame:
    """Number of files behind every partition of a file-based DataFrame, or of values of the column `part`."""
    counted = F.col(part or "_metadata.file_path").alias("_file")
    return df.select(*partition_by, counted).groupBy(*partition_by).agg(F.countDistinct("_file").alias("files"))


def compact(df: DataFrame, partition_by: list[str], keys: list[str], order: list[str], part: str | None = None) -> DataFrame:
    """K6: partitions made of more than one file are collapsed to the newest row per
    key; single-file partitions pass through unchanged.  The caller writes the
    result to a new version folder.

    An append of any size is written by many tasks, as many files.  Where appends lie in folders
    of their own, `part` names the column of these folders: appends are counted, not files.
    """
    # a row per partition: the bound of this broadcast, which keeps partitions from being dealt to a task each
    multi = F.broadcast(files_per_partition(df, partition_by, part).filter(F.col("files") > 1).select(*partition_by))
    cols = df.columns
    busy = df.join(multi, partition_by, "left_semi")
    quiet = df.join(multi, partition_by, "left_anti")
    return quiet.unionByName(latest(busy, partition_by + keys, order).select(*cols))


def backup_increment(fact: DataFrame, since: Position | None, pos: str = "pos", id: str = "id") -> DataFrame:
    """K7: rows added after the previous rotation's position."""
    return fact.filter(after(since, pos, id))


def restore(parts: list[DataFrame], keys: list[str], order: list[str]) -> DataFrame:
    """K7 restore: union of the full copy and its increments, newest per key."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return latest(u, keys, order)


def retain(df: DataFrame, ts: str, keep_days: int, now) -> DataFrame:
    """K8: keep whole days newer than `now - keep_days` (a date-partition filter)."""
    return df.filter(F.to_date(F.col(ts)) > F.date_sub(F.to_date(ts_lit(now)), keep_days))
