"""Scalar Column expressions used by loads, lookups and reports.

Every helper returns a built-in Column expression, so it stays inside whole-stage
codegen; none of them is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal; built from text so no time-zone shift can happen."""
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        text = value.isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        text = value.isoformat() + " 00:00:00"
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")


def position(pos="pos", id="id") -> Column:
    """The `(pos, id)` position as a struct; structs compare field by field."""
    return F.struct(as_col(pos).alias("pos"), as_col(id).cast("bigint").alias("id"))


def split_part(c, sep: str, n: int) -> Column:
    """`n`-th part (1-based, negative from the end) or NULL when absent."""
    return F.try_element_at(F.split(as_col(c), sep, -1), F.lit(n))


def topic_parts(c) -> Column:
    """`table[#tag][:shard]` -> struct(table, tag, shard); absent parts are ''."""
    c = as_col(c)
    pat = r"^([^#:]*)(?:#([^:]*))?(?::(.*))?$"
    return F.struct(
        F.regexp_extract(c, pat, 1).alias("table"),
        F.regexp_extract(c, pat, 2).alias("tag"),
        F.regexp_extract(c, pat, 3).alias("shard"),
    )


def topic_key(c) -> Column:
    """Topic without its `:shard` suffix (lineage key, D3)."""
    return F.regexp_extract(as_col(c), r"^([^:]*)", 1)


def or_zero_decimal(c, precision: int = 18, scale: int = 3) -> Column:
    t = f"decimal({precision},{scale})"
    return F.coalesce(as_col(c).cast("string").try_cast(t), F.lit(0).cast(t))


def or_zero_int(c, type_name: str = "int") -> Column:
    return F.coalesce(as_col(c).cast("string").try_cast(type_name), F.lit(0).cast(type_name))


# Timestamp layouts tried, in order, by `or_zero_timestamp`.
BEST_EFFORT_FORMATS = [
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd HH:mm:ss.SSS",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss.SSS",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd",
    "dd.MM.yyyy HH:mm:ss",
    "dd.MM.yyyy",
]


def or_zero_timestamp(c, formats=None) -> Column:
    """Parse text with the first layout that fits; epoch when none does."""
    c = as_col(c).cast("string")
    tries = [F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in (formats or BEST_EFFORT_FORMATS)]
    return F.coalesce(*tries, ts_lit("1970-01-01 00:00:00"))


def base64_bytes(c) -> Column:
    """Base64 text -> bytes; NULL where the text is none."""
    return F.try_to_binary(as_col(c), F.lit("base64"))


def bytes_to_uuid(c) -> Column:
    """16 bytes -> canonical 8-4-4-4-12 lower-case text (bytes in natural order, D25)."""
    h = F.lower(F.hex(as_col(c)))
    text = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))
    return F.when(F.length(h) == 32, text)


ZERO_UUID = "00000000-0000-0000-0000-000000000000"

# Time-delta units in seconds.
TIME_UNITS = {
    "s": 1, "sec": 1, "second": 1, "seconds": 1,
    "m": 60, "min": 60, "minute": 60, "minutes": 60,
    "h": 3600, "hour": 3600, "hours": 3600,
    "d": 86400, "day": 86400, "days": 86400,
    "w": 604800, "week": 604800, "weeks": 604800,
}
_DELTA_TOKEN = r"(\d+)\s*([A-Za-z]+)"


def time_delta_seconds(c, default: int | None = None) -> Column:
    """'5m' -> 300, '1h 30m' -> 5400; '' -> default; text that does not parse -> NULL."""
    c = F.trim(as_col(c))
    units = F.create_map(*[x for k, v in TIME_UNITS.items() for x in (F.lit(k), F.lit(v).cast("bigint"))])
    nums = F.regexp_extract_all(c, F.lit(_DELTA_TOKEN), 1)
    names = F.regexp_extract_all(c, F.lit(_DELTA_TOKEN), 2)
    parts = F.zip_with(nums, names, lambda n, u: n.cast("bigint") * F.try_element_at(units, F.lower(u)))
    total = F.aggregate(parts, F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    leftover = F.trim(F.regexp_replace(c, _DELTA_TOKEN, ""))
    valid = (F.size(parts) > 0) & (leftover == "") & (F.size(F.filter(parts, lambda x: x.isNull())) == 0)
    dflt = F.lit(default).cast("bigint") if default is not None else F.lit(None).cast("bigint")
    return F.when(c.isNull() | (c == ""), dflt).when(valid, total)


def time_window_minutes(c) -> Column:
    """'0:30-6:00' -> struct(start=30, end=360) in minutes of the day; NULL when empty."""
    c = as_col(c)
    pat = r"^\s*(\d+):(\d+)\s*-\s*(\d+):(\d+)\s*$"
    g = [F.regexp_extract(c, pat, i).try_cast("int") for i in range(1, 5)]
    return F.when(F.regexp_extract(c, pat, 1) != "",
                  F.struct((g[0] * 60 + g[1]).alias("start"), (g[2] * 60 + g[3]).alias("end")))


def in_time_window(ts, window_text) -> Column:
    """True when ts's minute of the day lies in the window (inclusive; start > end wraps midnight)."""
    ts = as_col(ts)
    w = time_window_minutes(window_text)
    m = F.hour(ts) * 60 + F.minute(ts)
    inside = F.when(w.start <= w.end, (m >= w.start) & (m <= w.end)).otherwise((m >= w.start) | (m <= w.end))
    return F.when(w.isNull(), F.lit(True)).otherwise(inside)


def month_key(ts) -> Column:
    ts = as_col(ts)
    return F.year(ts) * 100 + F.month(ts)


def _fixed2(hundredths: Column) -> Column:
    """Integer hundredths -> 'x.yy' text (exact integer arithmetic)."""
    h = hundredths.cast("bigint")
    return F.concat(F.floor(h / F.lit(100)).cast("string"), F.lit("."),
                    F.lpad(F.pmod(h, F.lit(100)).cast("string"), 2, "0"))


def _ladder(x: Column, base: int, units: list[str], sep: str) -> Column:
    """Pick the largest unit below `base`, round to hundredths half up, all in exact decimals."""
    xd = x.cast("decimal(38,0)")
    out = None
    for i, u in enumerate(units):
        d = base ** i
        scaled = F.floor((xd * F.lit(100) + F.lit(d // 2)) / F.lit(d)) if d > 1 else xd * F.lit(100)
        text = F.concat(_fixed2(scaled), F.lit(sep + u) if u else F.lit(""))
        cond = xd < F.lit(base ** (i + 1)) if i < len(units) - 1 else F.lit(True)
        out = F.when(cond, text) if out is None else out.when(cond, text)
    return F.when(x.isNotNull(), out)


# Units of the readable formats.
SIZE_UNITS = ["B", "KiB", "MiB", "GiB", "TiB", "PiB"]
QUANTITY_UNITS = ["", "thousand", "million", "billion", "trillion", "quadrillion"]
DELTA_UNITS = [("day", 86400), ("hour", 3600), ("minute", 60), ("second", 1)]


def readable_size(c) -> Column:
    """Bytes -> '1.50 KiB' (two decimals, half up, base 1024)."""
    return _ladder(as_col(c), 1024, SIZE_UNITS, " ")


def readable_quantity(c) -> Column:
    """Count -> '1.50 million' (two decimals, half up, base 1000)."""
    return _ladder(as_col(c), 1000, QUANTITY_UNITS, " ")


def readable_delta(c) -> Column:
    """Seconds -> '1 hour and 30 minutes'; zero parts are left out; 0 -> '0 seconds'."""
    s = as_col(c).cast("bigint")
    parts = []
    rest = s
    for name, size in DELTA_UNITS:
        n = F.floor(rest / F.lit(size)) if size > 1 else rest
        parts.append(F.when(n > 0, F.concat(n.cast("string"), F.lit(" " + name),
                                            F.when(n > 1, F.lit("s")).otherwise(F.lit("")))))
        rest = F.pmod(rest, F.lit(size)) if size > 1 else rest
    arr = F.filter(F.array(*parts), lambda x: x.isNotNull())
    n = F.size(arr)
    joined = F.when(n == 0, F.lit("0 seconds")).when(n == 1, F.element_at(arr, 1)).otherwise(
        F.concat(F.array_join(F.slice(arr, 1, n - 1), ", "), F.lit(" and "), F.element_at(arr, -1)))
    return joined


def elapsed_seconds(start, end) -> Column:
    """Whole seconds elapsed from start to end (not boundaries crossed, D17)."""
    return F.timestamp_diff("SECOND", as_col(start), as_col(end))


def map_filter_nonzero(m) -> Column:
    return F.map_filter(as_col(m), lambda k, v: v != 0)
