"""Aggregations that replace joins or make sums repeatable.

All of them are plain grouped aggregates with partial (map-side) aggregation, so a
hot key is pre-combined in every task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import as_col


def sum_map(df: DataFrame, by: list[str], col: str, name: str | None = None) -> DataFrame:
    """A5: add maps key-wise per group; zero sums are kept, keys absent everywhere stay absent."""
    name = name or col
    ex = df.select(*by, F.explode(F.col(col)).alias("_k", "_v"))
    per_key = ex.groupBy(*by, "_k").agg(F.sum("_v").alias("_v"))
    return per_key.groupBy(*by).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("_k", "_v")))).alias(name))


def sum_map_exploded(df: DataFrame, by: list[str], col: str) -> DataFrame:
    """A5 emitted as rows (by..., key, value): the form reports and tests compare."""
    ex = df.select(*by, F.explode(F.col(col)).alias("key", "value"))
    return ex.groupBy(*by, "key").agg(F.sum("value").alias("value"))


# Merge rules for `merge_streams`.
RULES = {
    "max": lambda c: F.max(c),
    "min": lambda c: F.min(c),
    "sum": lambda c: F.sum(c),
    "any": lambda c: F.any_value(c, ignoreNulls=True),
    "set": lambda c: F.array_sort(F.collect_set(c)),
}


def merge_streams(parts: list[DataFrame], key: list[str] | str, rules: dict) -> DataFrame:
    """Aggregate instead of join.

    Each part is a sparse feed carrying the key and some of the attributes; parts
    are unioned by name (missing columns NULL) and merged per key with one rule per
    attribute: max, min, sum, any (non-null), set, or ('last', order_col) for the
    non-null value with the greatest order.  Nulls are ignored by every rule.
    """
    keys = [key] if isinstance(key, str) else list(key)
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    aggs = []
    for c, rule in rules.items():
        if isinstance(rule, tuple) and rule[0] == "last":
            order = rule[1]
            aggs.append(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c))
        else:
            aggs.append(RULES[rule](F.col(c)).alias(c))
    return u.groupBy(*keys).agg(*aggs)


def idem_sum(df: DataFrame, key: list[str] | str, row_id: str, value: str, name: str = "total",
             version: str | None = None) -> DataFrame:
    """Sum where each (key, row_id) counts once, however often it arrives.

    Of several values of one (key, row_id), that with the largest `version` counts, without
    one the largest value: the result does not depend on the order of arrival.
    """
    keys = [key] if isinstance(key, str) else list(key)
    pick = F.max_by(value, F.struct(version, value)) if version else F.max(value)
    uniq = df.groupBy(*keys, row_id).agg(pick.alias(value))
    return uniq.groupBy(*keys).agg(F.sum(value).alias(name), F.count(F.lit(1)).alias("n"))


def signed_agg(df: DataFrame, by: list[str], sums: dict, sign: str = "sign") -> DataFrame:
    """Totals of collapsing rows: sum(sign * x) and sum(sign) as count; groups with count > 0."""
    aggs = [F.sum(as_col(c) * F.col(sign)).alias(n) for n, c in sums.items()]
    aggs.append(F.sum(sign).cast("bigint").alias("n"))
    return df.groupBy(*by).agg(*aggs).filter(F.col("n") > 0)


def funnel(events: DataFrame, by: list[str] | str, step_col: str, ts: str, steps: list[str]) -> DataFrame:
    """Per key, the times at which it goes through `steps` in order.

    `t1` is the first time of step 1, `t(i)` the first time of step i after `t(i-1)`; steps may be
    repeated before and between (click, view, click reaches view -> click).  Returns a row
    per key that has any of the steps, with `t1..tn` and `reached`.

    The fold over a key's events holds one time: step by step, the events of that step
    meet the key's time so far and are aggregated (partially before the shuffle), so no
    key's events are collected and a hot key's are split by the skew join.
    """
    keys = [by] if isinstance(by, str) else list(by)
    same = lambda a, b: [a[k].eqNullSafe(b[k]) for k in keys]
    out = events.filter(F.col(step_col).isin(steps)).groupBy(*keys).agg(
        F.min(F.when(F.col(step_col) == steps[0], F.col(ts))).alias("t1"))
    for i, step in enumerate(steps[1:], 2):
        before = out.filter(F.col(f"t{i - 1}").isNotNull()).select(*keys, F.col(f"t{i - 1}").alias("_before"))
        seen = events.filter(F.col(step_col) == step).select(*keys, F.col(ts).alias("_ts"))
        later = seen.join(before, same(seen, before)).filter(F.col("_ts") > F.col("_before")).select(
            *[seen[k] for k in keys], "_ts").groupBy(*keys).agg(F.min("_ts").alias(f"t{i}"))
        out = out.join(later, same(out, later), "left").select(*[out[c] for c in out.columns], f"t{i}")
    reached = sum((F.col(f"t{i + 1}").isNotNull().cast("int") for i in range(len(steps))), F.lit(0))
    return out.withColumn("reached", reached.cast("int"))


def funnel_counts(per_key: DataFrame, steps: list[str]) -> DataFrame:
    """A14 report: keys reaching at least each step."""
    aggs = [F.count_if(F.col("reached") >= i + 1).cast("bigint").alias(f"s{i + 1}") for i in range(len(steps))]
    wide = per_key.agg(*aggs)
    stack = ", ".join(f"{i + 1}, '{s}', s{i + 1}" for i, s in enumerate(steps))
    return wide.select(F.expr(f"stack({len(steps)}, {stack}) as (step, step_name, users)"))


def uniq_count(df: DataFrame, by: list[str], col: str, exact: bool = True) -> DataFrame:
    """Distinct counts per group, exact or HyperLogLog++ (approx_count_distinct)."""
    f = F.countDistinct(col) if exact else F.approx_count_distinct(col)
    return df.groupBy(*by).agg(f.cast("bigint").alias("uniq"))


def uniq_state(df: DataFrame, by: list[str], col: str, name: str = "uniq_state", lg_k: int = 12) -> DataFrame:
    """A mergeable distinct count per group (an HLL sketch of at most 2^lg_k bytes), to be stored as a column."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(col, lg_k).alias(name))


def merge_uniq(states: DataFrame, by: list[str], name: str = "uniq_state") -> DataFrame:
    """Fold stored sketches: of blocks into a mart (M3), or of a fine grain into a coarse one."""
    return states.groupBy(*by).agg(F.hll_union_agg(name).alias(name))


def uniq_estimate(df: DataFrame, name: str = "uniq_state", out: str = "uniq") -> DataFrame:
    """The counts that the sketches stand for (standard error about 1 / sqrt(2^lg_k))."""
    return df.withColumn(out, F.hll_sketch_estimate(name)).drop(name)
