"""Joins and lookups.

Broadcasts are left to Spark: a static size estimate under
`spark.sql.autoBroadcastJoinThreshold`, then AQE's runtime re-plan from the real
shuffle size.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import as_col

def latest(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Newest row per key (`ORDER BY order DESC LIMIT 1 BY keys`).

    `order` must be a total order inside a key.  `row_number() = 1` is planned with
    a partial WindowGroupLimit before the shuffle, so a hot key ships at most one
    row per map partition.
    """
    w = Window.partitionBy(*keys).orderBy(*[as_col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def kv_join(df: DataFrame, kv: DataFrame, on: list[tuple] | list[str], kv_order: list | None = None,
            kv_keys: list[str] | None = None, how: str = "left") -> DataFrame:
    """L1: left join a block to a key-value stage on a composite key.

    `on` is a list of column names present on both sides or of (left, right) pairs.
    When `kv_order` is given the stage is first reduced to its newest row per key.
    The join stays on separate key columns (D24).
    """
    pairs = [(c, c) if isinstance(c, str) else tuple(c) for c in on]
    right_keys = [r for _, r in pairs]
    if kv_order is not None:
        kv = latest(kv, kv_keys or right_keys, kv_order)
    same = all(l == r for l, r in pairs)
    if same:
        return df.join(kv, [l for l, _ in pairs], how)
    cond = None
    for l, r in pairs:
        c = df[l] == kv[r]
        cond = c if cond is None else cond & c
    return df.join(kv, cond, how)


def dim_lookup(df: DataFrame, dim: DataFrame, on: list[tuple] | list[str], attrs: list[str],
               defaults: dict | None = None) -> DataFrame:
    """L2: dictionary lookup with a default for keys the dimension lacks."""
    pairs = [(c, c) if isinstance(c, str) else tuple(c) for c in on]
    right = dim.select(*[F.col(r).alias(f"_k{i}") for i, (_, r) in enumerate(pairs)], *attrs)
    cond = None
    for i, (l, _) in enumerate(pairs):
        c = df[l] == right[f"_k{i}"]
        cond = c if cond is None else cond & c
    out = df.join(right, cond, "left").drop(*[f"_k{i}" for i in range(len(pairs))])
    for a, v in (defaults or {}).items():
        out = out.withColumn(a, F.coalesce(F.col(a), F.lit(v).cast(dim.schema[a].dataType)))
    return out


def dim_is_unique(dim: DataFrame, keys: list[str]) -> bool:
    """Dimension keys must be unique for L2; one aggregate pass."""
    return dim.groupBy(*keys).count().filter("count > 1").limit(1).count() == 0


def first_rows(block: DataFrame, keys: list[str], order: list | None = None) -> DataFrame:
    """L3 inside a block: the first version of each key by `order` (any one without it);
    rows with a NULL in the key are no duplicates of each other and all stay."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    # a number of its own keeps each row with a NULL apart: one pass over the block, and no group of all of them
    apart = block.withColumn("_apart", F.when(~known, F.monotonically_increasing_id()))
    if order:
        w = Window.partitionBy(*keys, "_apart").orderBy(*[as_col(c) for c in order])
        apart = apart.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    else:
        apart = apart.dropDuplicates([*keys, "_apart"])
    return apart.drop("_apart")


def new_rows(block: DataFrame, fact: DataFrame | None, keys: list[str],
             prune: dict | None = None, order: list | None = None, first: bool = False) -> DataFrame:
    """L3: rows of the block whose keys the fact does not hold yet, one per key (`first_rows`),
    so that the fact does not depend on where blocks end.

    The fact side is first narrowed to the block's keys (`fact IN block`) and by partition
    values (`prune`, NULL among them), then the block is anti-joined to that small set.
    AQE broadcasts from real sizes; no `NOT IN`: it plans a null-aware anti join.
    The block is read twice, by its keys and by the anti-join; `first` tells that it holds
    its first rows alone already.
    """
    if not first:
        block = first_rows(block, keys, order)
    if fact is None:
        return block
    narrowed = fact
    for c, values in (prune or {}).items():
        inside = F.col(c).isin([v for v in values if v is not None])
        narrowed = narrowed.filter(inside | F.col(c).isNull() if any(v is None for v in values) else inside)
    fk = narrowed.select(*keys)
    bkeys = block.select(*keys).distinct()
    seen = fk.join(bkeys, keys, "left_semi").distinct()
    return block.join(seen, keys, "left_anti")


def semi_filter(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """L4: `df WHERE keys IN (SELECT keys FROM other)`; duplicates on the right are harmless."""
    return df.join(other.select(*keys), keys, "left_semi")


def build_fact(block: DataFrame, joins: Iterable[tuple]) -> DataFrame:
    """Chain of left joins from the block to several sources.

    `joins` holds (source, on, attrs) where `on` is a list of (left, right) column
    pairs or shared names and `attrs` the source columns to bring.  Join order
    follows the list; Spark picks broadcast or shuffle per join from sizes.
    """
    out = block
    for src, on, attrs in joins:
        pairs = [(c, c) if isinstance(c, str) else tuple(c) for c in on]
        r = src.select(*[F.col(rr).alias(f"__r{i}") for i, (_, rr) in enumerate(pairs)], *attrs)
        cond = None
        for i, (l, _) in enumerate(pairs):
            c = out[l] == r[f"__r{i}"]
            cond = c if cond is None else cond & c
        out = out.join(r, cond, "left").drop(*[f"__r{i}" for i in range(len(pairs))])
    return out


def prefilter_in(right: DataFrame, left: DataFrame, keys: list[str]) -> DataFrame:
    """Keep right rows whose keys occur on the left (IN-list precomputed)."""
    return right.join(left.select(*keys).distinct(), keys, "left_semi")


def prefilter_range(right: DataFrame, left: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """Bound the right side by the left's key range.

    One aggregate gives min/max; they become literals, so the filter reaches the
    Parquet scan and skips row groups by their statistics.
    """
    st = left.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    rk = right_key or key
    if st["lo"] is None:
        return right.limit(0)
    return right.filter((F.col(rk) >= F.lit(st["lo"])) & (F.col(rk) <= F.lit(st["hi"])))


def write_bucketed(df: DataFrame, table: str, path: str, key: list[str], buckets: int | None = None,
                   keep: bool = True) -> DataFrame:
    """Write a table bucketed and sorted on the join key so later joins on it
    need no exchange.  Returns the table read back.

    Both sides of a join need the same number of buckets, by default that of the
    session's shuffle partitions.  With `keep=False` the catalog entry goes at once; the
    returned DataFrame and its files below `path` stay.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.write.mode("overwrite").bucketBy(n, *key).sortBy(*key)
     .option("path", path).saveAsTable(table))
    out = spark.table(table)
    if not keep:
        spark.sql(f"DROP TABLE {table}")
    return out


def repair_missing(fact: DataFrame, dim: DataFrame, on: list[tuple] | list[str], attrs: list[str]) -> DataFrame:
    """Rebuild rows whose lookup found nothing once the dimension has arrived.

    Rows with every attr NULL are re-joined; the other rows pass through untouched.
    """
    missing = None
    for a in attrs:
        m = F.col(a).isNull()
        missing = m if missing is None else missing & m
    broken = fact.filter(missing).drop(*attrs)
    kept = fact.filter(~missing)
    fixed = dim_lookup(broken, dim, on, attrs)
    return kept.unionByName(fixed.select(*fact.columns))


def nest_children(parent: DataFrame, child: DataFrame, key: list[str] | str, order: list[str],
                  fields: list[str], name: str = "children") -> DataFrame:
    """1:N children as a sorted array of structs in the parent row.

    The aggregation is partial before the shuffle; the array of one parent holds
    that parent's children, so its size is the fan-out of the key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    packed = child.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in order + [f for f in fields if f not in order]])))
        .alias(name))
    return parent.join(packed, keys, "left")


def nest_children_chunked(parent: DataFrame, child: DataFrame, key: list[str] | str, order: list[str],
                          fields: list[str], chunk_rows: int, name: str = "children") -> DataFrame:
    """J6 with a bound on the array size: children of a parent are split, in order,
    into chunks of at most `chunk_rows`; output is one row per (parent, chunk_no).

    Children are counted per parent first (partial aggregation).  Parents with at
    most `chunk_rows` children are grouped directly into chunk 0.  Only the
    children of larger parents are ranked globally by (key, order) with a range
    exchange, so a parent with a third of all children is spread over many tasks;
    its first rank turns the global rank into a rank inside the parent.  Every
    collected group holds at most `chunk_rows` children.  Parents without children
    get one row with chunk 0 and a NULL array.
    """
    from .positions import rank_rows
    keys = [key] if isinstance(key, str) else list(key)
    cols = order + [f for f in fields if f not in order]
    kids = child.select(*keys, *cols)
    sizes = kids.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    big_keys = sizes.filter(F.col("_n") > chunk_rows).select(*keys)
    pack = F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in cols]))).alias(name)
    small = (kids.join(sizes.filter(F.col("_n") <= chunk_rows).select(*keys), keys, "left_semi")
             .groupBy(*keys).agg(pack).withColumn("chunk_no", F.lit(0)))
    packed = small.select(*keys, "chunk_no", name)
    if big_keys.limit(1).count() > 0:
        ranked = rank_rows(kids.join(big_keys, keys, "left_semi"), keys + order)
        first = ranked.groupBy(*keys).agg(F.min("row_rank").alias("_first"))
        chunked = ranked.join(first, keys).withColumn(
            "chunk_no", F.floor((F.col("row_rank") - F.col("_first")) / F.lit(chunk_rows)).cast("int"))
        packed = packed.unionByName(chunked.groupBy(*keys, "chunk_no").agg(pack).select(*keys, "chunk_no", name))
    out = parent.join(packed, keys, "left")
    return out.withColumn("chunk_no", F.coalesce(F.col("chunk_no"), F.lit(0)))
