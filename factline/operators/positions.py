"""Positions and blocks.

A position is the pair `(pos, id)`, ordered lexicographically.  A block of a source
is every row with `last < (pos, id) <= next`.  Block predicates are written as scalar
comparisons (plus redundant `pos` bounds) so they reach the Parquet scan as pushed
filters; a struct comparison would push nothing.

Block planning never sorts the whole pending set: `kth_position` finds the k-th
position with a few histogram passes (distributed partial aggregation, one row per
bucket to the driver) and orders only the final bucket, whose size is bounded by
`exact_rows` no matter how skewed the data are.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import as_col, position, ts_lit

DEFAULT_MAX_STEP = 1_000_000   # D1
NULL_ID = -2**63               # a NULL id stands before all others at its position
HIST_BUCKETS = 1024            # buckets per histogram pass
EXACT_ROWS = 200_000           # rows ordered exactly in the last pass


@dataclass(frozen=True, order=True)
class Position:
    pos: _dt.datetime
    id: int = 0

    def lit(self) -> Column:
        return F.struct(ts_lit(self.pos).alias("pos"), F.lit(int(self.id)).cast("bigint").alias("id"))

    @staticmethod
    def of(row) -> "Position | None":
        if row is None:
            return None
        if isinstance(row, Position):
            return row
        if isinstance(row, (tuple, list)):
            p, i = row[0], row[1]
        else:
            p, i = row["pos"], row["id"]
        if p is None:
            return None
        return Position(p, int(i) if i is not None else 0)


@dataclass(frozen=True)
class Block:
    """A planned block: `rows` rows of the source in `(last, next]`."""
    last: Position | None
    next: Position | None
    rows: int
    max_step: int | None = None

    @property
    def full(self) -> bool:
        return self.max_step is not None and self.rows >= self.max_step

    @property
    def empty(self) -> bool:
        return self.rows == 0 or self.next is None


# ---------------------------------------------------------------- predicates

def after(last: Position | None, pos="pos", id="id") -> Column:
    """(pos, id) > last, pushdown-friendly."""
    if last is None:
        return F.lit(True)
    p, i = as_col(pos), as_col(id)
    lp = ts_lit(last.pos)
    return (p >= lp) & ((p > lp) | (i > F.lit(int(last.id))))


def at_or_before(nxt: Position | None, pos="pos", id="id") -> Column:
    """(pos, id) <= next, pushdown-friendly; NULL ids come first at their position."""
    if nxt is None:
        return F.lit(True)
    p, i = as_col(pos), as_col(id)
    np_ = ts_lit(nxt.pos)
    return (p <= np_) & ((p < np_) | (i <= F.lit(int(nxt.id))) | i.isNull())


def block_filter(df: DataFrame, last: Position | None, nxt: Position | None,
                 pos: str = "pos", id: str = "id") -> DataFrame:
    """B1: rows with last < (pos, id) <= next."""
    return df.filter(after(last, pos, id) & at_or_before(nxt, pos, id))


def pending(df: DataFrame, last: Position | None, gate, pos: str = "pos", id: str = "id") -> DataFrame:
    """B2: rows after `last` and strictly before the gate time."""
    cond = after(last, pos, id)
    if gate is not None:
        cond = cond & (as_col(pos) < ts_lit(gate))
    return df.filter(cond)


def _placed(df: DataFrame, pos: str, id: str) -> DataFrame:
    """The position columns alone, with NULL ids in their place."""
    return df.select(F.col(pos).alias("pos"), F.coalesce(F.col(id).cast("bigint"), F.lit(NULL_ID)).alias("id"))


def block_of_edges(edges: list[Position], pos="pos", id="id") -> Column:
    """Number of the block (0-based) that a row of a group falls in, by a binary search in the sorted `edges`
    (the blocks' `next`): the number of edges before the row's position."""
    steps, k = [], 1
    while k <= len(edges):
        steps.insert(0, k)
        k *= 2
    table = F.array(*[e.lit() for e in edges])
    at = F.struct(as_col(pos).alias("pos"), F.coalesce(as_col(id).cast("bigint"), F.lit(NULL_ID)).alias("id"))
    before = lambda n: (n <= len(edges)) & (F.get(table, n - 1) < at)
    return F.aggregate(F.array(*[F.lit(x) for x in steps]), F.lit(0),
                       lambda n, step: F.when(before(n + step), n + step).otherwise(n))


# ---------------------------------------------------------------- k-th position

def _add_micros(t: _dt.datetime, us: int) -> _dt.datetime:
    return t + _dt.timedelta(microseconds=us)


def kth_position(df: DataFrame, k: int, pos: str = "pos", id: str = "id",
                 count: int | None = None, buckets: int = HIST_BUCKETS,
                 exact_rows: int = EXACT_ROWS) -> Position | None:
    """The k-th smallest (pos, id) of `df` (1-based), found without a global sort.

    Each pass counts rows per equal-width bucket of the current range (partial
    aggregation; at most `buckets` rows come back), keeps the bucket where the
    running count reaches k, and narrows the range to it.  Ranges over `pos`
    first; a single `pos` value with many rows (a hot tie) is then split by `id`.
    Once the bucket holds at most `exact_rows` rows they are ordered directly.
    """
    cur = _placed(df, pos, id)
    if count is None:
        count = cur.count()
    if k < 1 or k > count:
        return None
    dim = "pos"
    while True:
        if count <= exact_rows:
            # at most `exact_rows` rows: rank them in one task, send one row to the driver
            w = Window.orderBy("pos", "id")
            row = cur.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == k).select("pos", "id").first()
            return Position.of(row)
        st = cur.agg(F.min("pos").alias("lo_p"), F.max("pos").alias("hi_p"),
                     F.min("id").alias("lo_i"), F.max("id").alias("hi_i")).first()
        if dim == "pos" and st["lo_p"] == st["hi_p"]:
            dim = "id"
        if dim == "id" and st["lo_i"] == st["hi_i"]:
            return Position(st["lo_p"], int(st["lo_i"]))
        if dim == "pos":
            lo = st["lo_p"]
            span = int((st["hi_p"] - lo) / _dt.timedelta(microseconds=1)) + 1
            width = -(-span // buckets)
            key = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '{lo.isoformat(sep=' ')}', pos) div {width}")
        else:
            lo_i = int(st["lo_i"])
            span = int(st["hi_i"]) - lo_i + 1
            width = -(-span // buckets)
            # decimals: the distance of two hashed ids doesn't fit in 64 bits
            key = F.expr(f"(CAST(id AS DECIMAL(20,0)) - CAST('{lo_i}' AS DECIMAL(20,0))) div CAST('{width}' AS DECIMAL(20,0))")
        hist = sorted((int(r["b"]), int(r["n"])) for r in
                      cur.groupBy(key.cast("bigint").alias("b")).agg(F.count(F.lit(1)).alias("n")).collect())
        seen = 0
        for b, n in hist:
            if seen + n >= k:
                break
            seen += n
        k -= seen
        count = n
        if dim == "pos":
            b_lo = _add_micros(lo, b * width)
            b_hi = _add_micros(lo, (b + 1) * width)
            cur = cur.filter((F.col("pos") >= ts_lit(b_lo)) & (F.col("pos") < ts_lit(b_hi)))
        else:
            b_lo = lo_i + b * width
            cur = cur.filter(F.col("id").between(F.lit(b_lo), F.lit(min(b_lo + width, 2**63) - 1)))


# ---------------------------------------------------------------- block planning

def _plan_from(pend: DataFrame, last: Position | None, max_step: int, exact_rows: int) -> Block:
    st = pend.agg(F.count(F.lit(1)).alias("n"), F.max(position("pos", "id")).alias("mx")).first()
    n = int(st["n"])
    if n == 0:
        return Block(last, None, 0, max_step)
    if n <= max_step:
        return Block(last, Position.of(st["mx"]), n, max_step)
    nxt = kth_position(pend, max_step, count=n, exact_rows=exact_rows)
    return Block(last, nxt, max_step, max_step)


def next_block(df: DataFrame, last: Position | None, gate, max_step: int = DEFAULT_MAX_STEP,
               pos: str = "pos", id: str = "id", exact_rows: int = EXACT_ROWS) -> Block:
    """The first `max_step` pending rows by (pos, id)."""
    pend = pending(_placed(df, pos, id), last, gate)
    return _plan_from(pend, last, max_step, exact_rows)


def next_block_uniq(df: DataFrame, last: Position | None, gate, max_step: int = DEFAULT_MAX_STEP,
                    pos: str = "pos", id: str = "id", exact_rows: int = EXACT_ROWS) -> Block:
    """The first `max_step` distinct ids, each placed at its newest pending pos.

    The per-id grouping is a shuffle; when more than one pass is needed it is
    checkpointed to the shared folder so the passes do not repeat it.
    """
    pend = pending(_placed(df, pos, id), last, gate)
    grouped = pend.groupBy("id").agg(F.max("pos").alias("pos")).select("pos", "id")
    st = grouped.agg(F.count(F.lit(1)).alias("n"), F.max(position("pos", "id")).alias("mx")).first()
    n = int(st["n"])
    if n == 0:
        return Block(last, None, 0, max_step)
    if n <= max_step:
        return Block(last, Position.of(st["mx"]), n, max_step)
    if n > exact_rows:
        grouped = grouped.checkpoint(eager=True)
    nxt = kth_position(grouped, max_step, count=n, exact_rows=exact_rows)
    return Block(last, nxt, max_step, max_step)


def next_range(last: Position, max_step_s: int, delay_s: int, now) -> Position | None:
    """next = (least(last.pos + max_step s, now - delay), 0); None when not forward."""
    end = min(last.pos + _dt.timedelta(seconds=max_step_s), now - _dt.timedelta(seconds=delay_s))
    nxt = Position(end, 0)
    return nxt if nxt > last else None


def next_now(last: Position | None, now) -> Position | None:
    """next = (now, 0)."""
    nxt = Position(now, 0)
    return nxt if last is None or nxt > last else None


RANK_ROWS_PER_PARTITION = 4_000_000


def rank_rows(df: DataFrame, order: list[str], partitions: int | None = None, count: int | None = None) -> DataFrame:
    """Global 0-based rank of every row in `order` (a total order), without a
    single-partition window and without Python.

    Rows are range-partitioned and sorted within partitions; `monotonically_increasing_id`
    then counts them from the partition's own start.  The sorted rows are checkpointed
    (reliably, to the shared folder), so that the counts per partition (one row per
    partition, joined back as its starting rank) belong to the same partitions.
    """
    spark = df.sparkSession
    if partitions is None:
        # enough range partitions that each holds a few million rows, whatever the input size
        rows = df.count() if count is None else count
        partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // RANK_ROWS_PER_PARTITION))
    ranged = (df.repartitionByRange(partitions, *[F.col(c) for c in order]).sortWithinPartitions(*order)
              .withColumn("_place", F.monotonically_increasing_id()).checkpoint(eager=True))
    part = F.shiftright("_place", 33).cast("int")
    counts = sorted((r["p"], r["c"]) for r in ranged.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("c")).collect())
    starts, acc = [], 0
    for p, c in counts:
        starts.append((p, acc))
        acc += c
    # a row per partition: the bound of this broadcast
    table = F.broadcast(spark.createDataFrame(starts, "_part int, _start bigint"))
    rank = F.col("_start") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.withColumn("_part", part).join(table, "_part").select(*df.columns, rank.alias("row_rank"))


def block_numbers(df: DataFrame, size: int, pos: str = "pos", id: str = "id",
                  partitions: int | None = None) -> DataFrame:
    """Drain plan in one pass: every row's block when the source is drained in
    blocks of `size` rows (B3 repeated until empty, P7): `rank // size`."""
    return rank_rows(df, [pos, id], partitions).withColumn(
        "block_no", F.floor(F.col("row_rank") / F.lit(size)).cast("bigint"))


def plan_blocks(df: DataFrame, last: Position | None, gate, max_step: int, pos: str = "pos", id: str = "id",
                uniq: bool = False, horizon: int = 1000) -> list[Block]:
    """The next `horizon` blocks under a fixed gate, planned in one distributed pass.

    Gives the same edges as calling `next_block` (or `next_block_uniq`) after each
    commit, as long as the source does not change below the gate meanwhile: the k-th
    block ends at the (k*max_step)-th position, the last one at the largest.  One count of rows per
    range of time tells the ranges that hold an end; only their rows are ranked (`rank_rows`).
    One row per range and one per block reach the driver.
    """
    pend = pending(_placed(df, pos, id), last, gate)
    if uniq:
        pend = pend.groupBy("id").agg(F.max("pos").alias("pos")).select("pos", "id")
    st = pend.agg(F.count(F.lit(1)).alias("n"), F.max(position("pos", "id")).alias("mx"), F.min("pos").alias("lo"), F.max("pos").alias("hi")).first()
    n = int(st["n"])
    ends = [k * max_step for k in range(1, min(horizon, -(-n // max_step)) + 1)]
    inner = [k for k in ends if k < n]
    if inner and uniq and n > EXACT_ROWS:
        pend = pend.checkpoint(eager=True)
    at = _positions_at(pend, inner, st["lo"], st["hi"]) if inner else {}
    out, prev = [], last
    for k in ends:
        nxt = at[k] if k < n else Position.of(st["mx"])
        out.append(Block(prev, nxt, min(max_step, n - k + max_step), max_step))
        prev = nxt
    return out


def _moment(pos, kind: str, days: bool) -> Column:
    """Whole days or seconds of a column or value, ordered as it is, in any session time zone."""
    if kind == "timestamp":
        return F.unix_seconds(pos)
    t = pos.cast("timestamp_ntz")
    day = F.unix_date(t.cast("date")).cast("bigint")
    return day if days else day * 86400 + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def _positions_at(df: DataFrame, places: list[int], lo, hi) -> dict[int, Position | None]:
    """The positions at the (1-based, sorted) `places` in the order of `df`, whose times lie in [lo, hi]."""
    buckets, kind = max(HIST_BUCKETS, 8 * len(places)), df.schema["pos"].dataType.typeName()
    if lo is None:
        bucket = F.expr("CAST(-1 AS BIGINT)")
    else:
        days = (hi - lo).days >= buckets // 4   # cheaper to take, and fine enough
        first, last = df.sparkSession.range(1).select(*[_moment(F.lit(x), kind, days) for x in (lo, hi)]).first()
        width = -(-(last - first + 1) // buckets)
        # rows without a time come first
        bucket = F.coalesce(F.floor((_moment(F.col("pos"), kind, days) - first) / width).cast("bigint"), F.lit(-1))
    df = df.withColumn("_b", bucket)
    hist = sorted((r["_b"], r["n"]) for r in df.groupBy("_b").agg(F.count(F.lit(1)).alias("n")).collect())
    todo, wanted, ranked, seen, below = list(places), {}, [], 0, 0
    for b, n in hist:
        held = [k for k in todo if k <= seen + n]
        if held:
            todo = todo[len(held):]
            wanted.update({k - 1 - seen + below: k for k in held})   # its rank among the rows of such ranges
            ranked.append(b)
            below += n
        seen += n
    found = rank_rows(df.filter(F.col("_b").isin(ranked)).drop("_b"), ["pos", "id"], partitions=-(-below // EXACT_ROWS)) \
        .filter(F.col("row_rank").isin(list(wanted))).collect()
    return {wanted[r["row_rank"]]: Position.of(r) for r in found}


# ---------------------------------------------------------------- sources, shards, late rows

def source_position(df: DataFrame, pos: str = "pos", id: str = "id") -> Position | None:
    """Newest (pos, id) of a source.

    Two small jobs: `max(pos)`, which reads that one column, then `max(id)` among the
    rows at that pos (row groups pruned by the equality filter).  No full sort, no struct
    aggregate over everything.  Tables that this library loads need no scan: their
    position is in the position log, streams included; nor do Parquet sources whose files
    are kept in `sources.files.FilePositions`.
    """
    p = df.agg(F.max(pos).alias("p")).first()["p"]
    if p is None:
        return None
    i = df.filter(F.col(pos) == ts_lit(p)).agg(F.max(F.col(id).cast("bigint")).alias("i")).first()["i"]
    return Position(p, int(i) if i is not None else NULL_ID)


def shard_filter(df: DataFrame, key, n: int, i: int, hash_key: bool = False) -> DataFrame:
    """Rows of shard `i` of `n`; the shards partition the source."""
    k = as_col(key)
    k = F.xxhash64(k) if hash_key else k.cast("bigint")
    return df.filter(F.pmod(k, F.lit(n)) == F.lit(i))


def late_rows(src: DataFrame, fact: DataFrame, last: Position, keys: list[str],
              pos: str = "pos", id: str = "id") -> DataFrame:
    """Source rows at or below `last` that the destination does not hold.

    The destination is first narrowed to the candidates' keys (semi join), so no
    aggregate over all of its keys is needed; then the candidates are anti-joined.
    """
    old = src.filter(at_or_before(last, pos, id))
    seen = fact.select(*keys).join(old.select(*keys), keys, "left_semi")
    return old.join(seen, keys, "left_anti")


def range_series(df: DataFrame, last: Position, max_step_s: int, delay_s: int, now,
                 pos: str = "pos", id: str = "id") -> DataFrame:
    """B5 drained: the Range windows `((last + k*step, 0), (least(last + (k+1)*step, now - delay), 0)]`
    with their row counts, every window present even when empty.

    Each row finds its window by arithmetic (no range join): k = micros since `last`
    div step, moved one back when the row sits exactly on a window end with id <= 0.
    """
    spark = df.sparkSession
    limit = now - _dt.timedelta(seconds=delay_s)
    if limit <= last.pos:
        return spark.createDataFrame([], "window_no bigint, window_start timestamp_ntz, "
                                         "window_end timestamp_ntz, rows bigint")
    step_us = int(max_step_s) * 1_000_000
    span_us = int((limit - last.pos) / _dt.timedelta(microseconds=1))
    n_windows = -(-span_us // step_us)
    rows = (df.filter(after(last, pos, id) & at_or_before(Position(limit, 0), pos, id))
            .select(F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '{last.pos.isoformat(sep=' ')}', {pos})")
                    .alias("_us"), F.col(id).alias("_id"))
            .select(F.when((F.pmod("_us", F.lit(step_us)) == 0) & (F.col("_id") <= 0),
                           F.expr(f"_us div {step_us}") - 1).otherwise(F.expr(f"_us div {step_us}"))
                    .cast("bigint").alias("window_no"))
            .groupBy("window_no").agg(F.count(F.lit(1)).alias("rows")))
    windows = spark.range(n_windows).select(
        F.col("id").alias("window_no"),
        F.timestamp_add("SECOND", F.col("id") * max_step_s, ts_lit(last.pos)).alias("window_start"),
        F.least(F.timestamp_add("SECOND", (F.col("id") + 1) * max_step_s, ts_lit(last.pos)),
                ts_lit(limit)).alias("window_end"))
    return (windows.join(rows, "window_no", "left")
            .select("window_no", "window_start", "window_end",
                    F.coalesce(F.col("rows"), F.lit(0)).cast("bigint").alias("rows")))
