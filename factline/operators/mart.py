"""Marts and indexes (M1-M6): rollups, the 10x rule, incremental refresh,
re-clustering, reverse indexes and partition-pruned reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import as_col

GRAINS = ("second", "minute", "hour", "day", "week", "month", "year")


def period(ts, grain: str) -> Column:
    """Start of the grain period, kept as TIMESTAMP_NTZ (date_trunc returns LTZ)."""
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain}")
    return F.date_trunc(grain, as_col(ts)).cast("timestamp_ntz")


def rollup(df: DataFrame, ts: str, grain: str, dims: list[str], aggs: dict) -> DataFrame:
    """M1: aggregate by period and dimensions; `aggs` maps name -> aggregate Column."""
    return df.groupBy(period(ts, grain).alias("period"), *dims).agg(*[c.alias(n) for n, c in aggs.items()])


def rollup_factor(df: DataFrame, ts: str, grains: list[str], dims: list[str], min_factor: int = 10) -> DataFrame:
    """M2: rows per group at each grain and whether the mart clears the 10x rule.

    Rows are first counted per period of the finest grain, which every coarser period
    follows from; only those groups are expanded per grain, not the rows.
    """
    base = min(grains, key=GRAINS.index)
    if base == "week" and set(grains) & {"month", "year"}:   # a week may lie in two months
        base = "day"
    fine = df.groupBy(period(ts, base).alias("_at"), *[F.col(d) for d in dims]).agg(F.count(F.lit(1)).alias("_n"))
    aggs = [F.coalesce(F.sum("_n"), F.lit(0)).alias("rows")]
    aggs += [F.countDistinct(period("_at", g), *[F.col(d) for d in dims]).alias(f"g_{g}") for g in grains]
    wide = fine.agg(*aggs)
    stack = ", ".join(f"'{g}', g_{g}" for g in grains)
    out = wide.select("rows", F.expr(f"stack({len(grains)}, {stack}) as (grain, groups)"))
    return out.select("grain", F.col("rows").cast("bigint").alias("rows"), F.col("groups").cast("bigint").alias("groups"),
                      (F.col("rows") >= F.col("groups") * min_factor).alias("worth"))


# merge rule per aggregate when partial rollups are combined
MERGE = {"sum": F.sum, "min": F.min, "max": F.max, "uniq": F.hll_union_agg}


def refresh_rollup(mart: DataFrame, delta: DataFrame, keys: list[str], rules: dict) -> DataFrame:
    """M3: fold the rollup of a new block into the mart.

    sum/min/max and stored distinct counts (`uniq`: sketches, `merge.uniq_state`) are mergeable, so mart and delta are combined by one grouping, in which
    a NULL dimension is a value like others.  For mutable facts, feed signed deltas
    (sum of sign * x) and they cancel the old contribution.
    """
    merged = mart.unionByName(delta.select(*mart.columns)).groupBy(*keys).agg(
        *[MERGE[r](F.col(c)).alias(c) for c, r in rules.items()])
    return merged.select(*mart.columns)


def recluster(df: DataFrame, cols: list[str], partitions: int | None = None) -> DataFrame:
    """M4: the same rows range-partitioned and sorted by other columns, so Parquet
    row-group statistics prune reads on them."""
    ranged = df.repartitionByRange(partitions, *[F.col(c) for c in cols]) if partitions \
        else df.repartitionByRange(*[F.col(c) for c in cols])   # AQE sizes the partitions
    return ranged.sortWithinPartitions(*cols)


def build_reverse_index(df: DataFrame, attr: str, ids: list[str], partitions: int | None = None) -> DataFrame:
    """M5: distinct (attr, id) pairs clustered by attr."""
    return recluster(df.select(attr, *ids).distinct(), [attr] + ids, partitions)


def lookup_via_index(index: DataFrame, wide: DataFrame, attr: str, value, ids: list[str],
                     wide_ids: list[str] | None = None) -> DataFrame:
    """M5 lookup: resolve ids from the clustered index, then semi join the wide table.

    One plan for any number of ids: the filter on `attr` prunes the index, and Spark
    broadcasts few ids or builds a runtime filter from them.
    """
    wide_ids = wide_ids or ids
    hits = index.filter(F.col(attr) == F.lit(value)).select(*ids).distinct()
    renamed = hits.select(*[F.col(a).alias(b) for a, b in zip(ids, wide_ids)])
    return wide.join(renamed, wide_ids, "left_semi")


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "overwrite") -> None:
    """M6: time-partitioned layout (one folder per period value)."""
    df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).parquet(path)
