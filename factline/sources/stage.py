"""Stage preparation (S1-S8): stamping positions, CDC envelopes, schema-free JSON
stages with a drift check, stage dedup and bounded pulls."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DataType, DecimalType, DoubleType, FloatType, IntegerType,
                               LongType, MapType, ShortType, StructField, StructType, ByteType)

from ..functions.exprs import as_col, ts_lit
from ..operators.lookup import latest
from ..operators.positions import Position, after, at_or_before, rank_rows


# ------------------------------------------------------------------ S1 stamp
def stamp(df: DataFrame, pos, id=None, key: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """Give arriving rows a position.

    `pos`: a column name or a timestamp (arrival time of the batch).  `id`: a column,
    or a hash of `key` columns (`xxhash64`), or the row's rank within the batch by
    `order` (a total order; repeatable on retry, unlike monotonically_increasing_id).
    """
    p = as_col(pos) if isinstance(pos, str) else ts_lit(pos)
    out = df.withColumn("pos", p.cast("timestamp_ntz"))
    if id is not None:
        return out.withColumn("id", as_col(id).cast("bigint"))
    if key:
        return out.withColumn("id", F.xxhash64(*[F.col(k) for k in key]))
    if order:
        ranked = rank_rows(out, order)
        return ranked.withColumn("id", F.col("row_rank") + 1).drop("row_rank")
    raise ValueError("stamp needs id, key or order")


# ------------------------------------------------------------------ S2-S4 CDC envelopes
ENVELOPE_FIELDS = "database string, table string, type string, ts bigint, xid bigint, commit boolean"
# JSON text layouts for timestamps (microseconds kept).
JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def envelope_schema(payload: StructType | str) -> StructType:
    p = payload if isinstance(payload, StructType) else StructType.fromDDL(payload)
    return StructType(StructType.fromDDL(ENVELOPE_FIELDS).fields + [StructField("data", p)])


def parse_envelope(df: DataFrame, payload: StructType | str, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """S3: JSON envelope text -> typed columns.  Returns (good rows, rejected rows).

    A row is rejected when its text does not parse or lacks `data`.
    """
    parsed = df.withColumn("_e", F.from_json(F.col(col).cast("string"), envelope_schema(payload),
                                             {"mode": "PERMISSIVE", **JSON_OPTIONS}))
    ok = F.col("_e").isNotNull() & F.col("_e.data").isNotNull()
    good = parsed.filter(ok).select("_e.*")
    bad = parsed.filter(~ok | F.col("_e").isNull()).drop("_e")
    return good, bad


def read_cdc(df: DataFrame, payload: StructType | str, col: str = "value", unit: str = "SECOND") -> DataFrame:
    """A landed CDC stream (batch or streaming DataFrame of envelope text) as
    stage rows: payload columns plus `pos` (event time) and `id` (transaction id).
    `unit` is that of the envelope's epoch `ts`; `cdc_rejects` has the other rows."""
    good, _ = parse_envelope(df, payload, col)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return good.select("data.*", F.col("type").alias("_op"),
                       F.timestamp_add(unit, F.col("ts"), epoch).alias("pos"),
                       F.col("xid").alias("id"))


def cdc_rejects(df: DataFrame, payload: StructType | str, col: str = "value") -> DataFrame:
    """The landed rows that `read_cdc` can't use (unreadable text, no `data`), as they came."""
    return parse_envelope(df, payload, col)[1]


def to_envelope(df: DataFrame, database: str, table: str, ts: str, id: str | None = None,
                since=None, op: str = "insert", op_col: str | None = None, unit: str = "SECOND") -> DataFrame:
    """Bootstrap envelopes from an existing table, bounded to rows newer than
    `since` when given; `ts` (event time) -> epoch in `unit`s, `id` -> xid.
    The operation is `op`, or per row the column `op_col` (kept out of `data`)."""
    src = df if since is None else df.filter(F.col(ts) > ts_lit(since))
    # epoch by NTZ arithmetic: independent of the session time zone
    epoch_ts = F.timestamp_diff(unit, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts))
    kind = F.col(op_col) if op_col else F.lit(op)
    payload = [F.col(c) for c in df.columns if c != op_col]
    env = F.struct(F.lit(database).alias("database"), F.lit(table).alias("table"), kind.alias("type"),
                   epoch_ts.alias("ts"), (F.col(id).cast("bigint") if id else F.lit(0).cast("bigint")).alias("xid"),
                   F.lit(True).alias("commit"), F.struct(*payload).alias("data"))
    return src.select(F.to_json(env, JSON_OPTIONS).alias("value"))


# ------------------------------------------------------------------ S5 schema-free stages
def infer_json_schema(df: DataFrame, col: str) -> str:
    """Schema merged over every readable row of a JSON text column (one aggregate), as DDL."""
    text = df.select(F.expr(f"schema_of_variant_agg(try_parse_json(`{col}`))").alias("s")).first()["s"]
    if text is None:
        return "STRUCT<>"
    return re.sub(r"\bOBJECT<", "STRUCT<", text)


def malformed(df: DataFrame, col: str) -> DataFrame:
    """The rows whose JSON text can't be read, to be kept beside `infer_stage` of the others."""
    return df.filter(F.col(col).isNotNull() & F.expr(f"try_parse_json(`{col}`) IS NULL"))


def infer_stage(df: DataFrame, col: str, schema: str | None = None) -> DataFrame:
    """Typed columns from a JSON text column: `from_json` with the merged schema.
    Malformed rows are left out; `malformed` returns them."""
    ddl = schema or infer_json_schema(df, col)
    df = df.filter(F.col(col).isNull() | F.expr(f"try_parse_json(`{col}`) IS NOT NULL"))
    return df.withColumn("_j", F.from_json(F.col(col), ddl)).select(*[c for c in df.columns if c != col], "_j.*")


_WIDER = {
    (ByteType, ShortType), (ByteType, IntegerType), (ByteType, LongType), (ShortType, IntegerType),
    (ShortType, LongType), (IntegerType, LongType), (IntegerType, DoubleType), (LongType, DoubleType),
    (FloatType, DoubleType), (ByteType, DoubleType), (ShortType, DoubleType), (IntegerType, DecimalType),
    (LongType, DecimalType),
}


class SchemaDrift(Exception):
    pass


def _merge_type(path: str, old: DataType, new: DataType) -> DataType:
    if old == new:
        return old
    if isinstance(old, StructType) and isinstance(new, StructType):
        return merge_schema(old, new, path + ".")
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return ArrayType(_merge_type(path + "[]", old.elementType, new.elementType), True)
    if isinstance(old, MapType) and isinstance(new, MapType) and old.keyType == new.keyType:
        return MapType(old.keyType, _merge_type(path + "{}", old.valueType, new.valueType), True)
    if isinstance(old, DecimalType) and isinstance(new, DecimalType):
        if new.precision - new.scale >= old.precision - old.scale and new.scale >= old.scale:
            return new
        if old.precision - old.scale >= new.precision - new.scale and old.scale >= new.scale:
            return old
    if (type(old), type(new)) in _WIDER:
        return new
    if (type(new), type(old)) in _WIDER:
        return old
    raise SchemaDrift(f"column {path.rstrip('.')} changed type from {old.simpleString()} to {new.simpleString()}")


def merge_schema(old: StructType, new: StructType, prefix: str = "") -> StructType:
    """S5 drift check: new columns are accepted, numeric widening is accepted, any
    other type change raises `SchemaDrift` naming the column."""
    fields, new_by = [], {f.name: f for f in new.fields}
    for f in old.fields:
        if f.name in new_by:
            fields.append(StructField(f.name, _merge_type(prefix + f.name, f.dataType, new_by[f.name].dataType), True))
        else:
            fields.append(f)
    names = {f.name for f in old.fields}
    fields += [f for f in new.fields if f.name not in names]
    return StructType(fields)


def check_drift(old: DataFrame | StructType, new: DataFrame | StructType) -> StructType:
    o = old.schema if isinstance(old, DataFrame) else old
    n = new.schema if isinstance(new, DataFrame) else new
    return merge_schema(o, n)


def union_stage(old: DataFrame, new: DataFrame) -> DataFrame:
    """Append a new stage batch to an old one under the merged schema."""
    merged = check_drift(old, new)

    def fit(df):
        return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in merged.fields])
    return fit(old).unionByName(fit(new))


# ------------------------------------------------------------------ S6, S7
def stage_dedup(df: DataFrame, keys: list[str] | None = None, order: list[str] | None = None,
                keep: str = "first") -> DataFrame:
    """One row per key before joining.  `order` must be total inside a key;
    `keep='first'` keeps the earliest version.  Without keys, identical rows are
    dropped."""
    if not keys:
        return df.dropDuplicates()
    if keep == "first":
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc() for c in order])
        return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    return latest(df, keys, order)


def pull_window(df: DataFrame, last: Position | None, upper: Position, pos: str = "pos", id: str = "id") -> DataFrame:
    """The bounded window (last, upper] of an operational source; the upper
    bound is fixed before reading so rows arriving meanwhile wait for the next pull."""
    return df.filter(after(last, pos, id) & at_or_before(upper, pos, id))
