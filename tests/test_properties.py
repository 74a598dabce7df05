"""Merge laws under random splits and orders."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from factline.operators.merge import idem_sum, signed_agg, sum_map

SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

maps = st.lists(st.tuples(st.sampled_from("gh"), st.dictionaries(st.sampled_from("abcd"), st.integers(-5, 5),
                                                                 max_size=3)), min_size=1, max_size=12)


@settings(**SETTINGS)
@given(rows=maps, cut=st.integers(0, 12))
def test_sum_map_any_split(spark, rows, cut):
    df = spark.createDataFrame(rows, "g string, m map<string,bigint>")
    whole = {r["g"]: r["m"] for r in sum_map(df, ["g"], "m").collect()}
    a, b = rows[:cut], rows[cut:]
    parts = [spark.createDataFrame(x, "g string, m map<string,bigint>") for x in (a, b) if x]
    partial = parts[0] if len(parts) == 1 else sum_map(parts[0], ["g"], "m").unionByName(sum_map(parts[1], ["g"], "m"))
    again = {r["g"]: r["m"] for r in sum_map(partial, ["g"], "m").collect()}
    assert whole == again


@settings(**SETTINGS)
@given(vals=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 20), st.integers(-100, 100)), min_size=1,
                     max_size=30),
       dup=st.lists(st.integers(0, 29), max_size=10))
def test_idem_sum_ignores_redelivery(spark, vals, dup):
    uniq = {}
    for k, rid, v in vals:
        uniq.setdefault((k, rid), v)
    base = [(k, rid, v) for (k, rid), v in uniq.items()]
    redelivered = base + [base[i % len(base)] for i in dup]
    df = spark.createDataFrame(redelivered, "k int, rid int, v bigint")
    got = {r["k"]: r["total"] for r in idem_sum(df, "k", "rid", "v").collect()}
    want = {}
    for k, _, v in base:
        want[k] = want.get(k, 0) + v
    assert got == want


@settings(**SETTINGS)
@given(versions=st.lists(st.tuples(st.sampled_from("xyz"), st.integers(1, 50)), min_size=1, max_size=15))
def test_signed_rows_give_latest_totals(spark, versions):
    # each new version of a key cancels the previous one with a -1 row
    rows, cur = [], {}
    for k, v in versions:
        if k in cur:
            rows.append((k, cur[k], -1))
        rows.append((k, v, 1))
        cur[k] = v
    df = spark.createDataFrame(rows, "k string, x int, sign int")
    got = {r["k"]: (r["total"], r["n"]) for r in signed_agg(df, ["k"], {"total": "x"}).collect()}
    assert got == {k: (v, 1) for k, v in cur.items()}
