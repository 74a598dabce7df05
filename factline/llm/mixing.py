"""Mixing sources to target weights by pivotal dependent rounding (Deville and Tille 1998). DataFrame functions only.

A source's target over its size is the number of copies that each of its documents should have. The whole part is
given to all; the fractions are rounded together: two documents are paired, and words move at random from the one to
the other until one has a whole copy or none. Expected copies stay as they were and, since words move, so does the
source's sum of words. The document still between goes on to the next pair.

The pairing is a tree: the documents of a chunk are folded one after the other, and each chunk hands at most one
undecided document to the next round, where these are dealt to chunks again, until one per source is left; it is
rounded by a last draw. Draws are hashes of the documents' ids and contents, so that reruns agree however the table is split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, content_key, cut, drawn_key, whole_rows, with_row_id

#: Weights of the sources in their order, repeated.
WEIGHTS = (5, 2, 1)
_UNIT = "struct<id:bigint,size:bigint,f:double,row:bigint>"
_EPS = 1e-9


def word_count(text: Column) -> Column:
    """Words of the text: each, with the white space around it, becomes one mark."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACES}]*[^{SPACES}]+[{SPACES}]*", "x")
    return F.length(F.translate(marks, SPACES, "")).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size): ``share`` of all words, dealt by weight, at most ``cap`` times the source.

    Sources stand in the order of their code points, null last. A target over its cap is cut to it and the excess is
    shared again by weight, round by round. One row per source passes through one task.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    table = cut(sizes.withColumn("w", w).withColumn("cap", cap * F.col("source_size")).withColumn("_all", F.sum("source_size").over(Window.partitionBy())), "mix-sources")
    # level at which a source is full: cap / w. Full are those below the level that shares out the rest exactly.
    by_level = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source").cast("binary"))
    upto, every = by_level.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    before = F.coalesce(F.sum("cap").over(upto), F.lit(0.0))
    left_w = F.sum("w").over(every) - F.coalesce(F.sum("w").over(upto), F.lit(0.0))
    level = (share * F.col("_all") - before) / left_w  # if all sources before this one are full
    table = table.withColumn("level", level).withColumn("full", F.col("level") >= F.col("cap") / F.col("w"))
    rest = F.max(F.when(~F.col("full"), F.col("level"))).over(every)  # that of the first which isn't full
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("w") * rest))
    return table.select("source", "source_size", target.alias("target"))


def _draw(*parts: Column) -> Column:
    """Uniform in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)).cast("double") / float(1 << 52)


def _pair(held: Column, unit: Column, seed: Column) -> Column:
    """(held, done): of the two, the one still undecided (or null) and those decided, after words have moved at random."""
    a, b = held, unit
    total = a["f"] * a["size"] + b["f"] * b["size"]
    to_a = F.least((1 - a["f"]) * a["size"], b["f"] * b["size"])  # words that can move from b to a
    to_b = F.least(a["f"] * a["size"], (1 - b["f"]) * b["size"])
    up = _draw(a["id"], b["id"], seed) * (to_a + to_b) < to_b
    words_a = F.when(up, a["f"] * a["size"] + to_a).otherwise(a["f"] * a["size"] - to_b)
    fa, fb = words_a / a["size"], (total - words_a) / b["size"]
    clean = lambda f: F.when(f < _EPS, 0.0).when(f > 1 - _EPS, 1.0).otherwise(f)
    new = lambda u, f: F.struct(u["id"].alias("id"), u["size"].alias("size"), clean(f).alias("f"), u["row"].alias("row"))
    return F.array(new(a, fa), new(b, fb))


def _fold(units: Column, seed: Column) -> Column:
    """The units of a chunk after pairing them one after the other: at most one has a fraction left."""
    whole = lambda u: (u["f"] == 0.0) | (u["f"] == 1.0)
    start = F.struct(F.lit(None).cast(_UNIT).alias("held"), F.array().cast(f"array<{_UNIT}>").alias("done"))

    def step(acc, u):
        held, done = acc["held"], acc["done"]
        both = F.when(held.isNull(), F.array(u)).otherwise(_pair(held, u, seed))
        # _pair is written once in the plan: the pair goes through a one-element array
        return F.element_at(F.transform(F.array(both), lambda x: F.struct(
            F.element_at(F.concat(F.filter(x, lambda v: ~whole(v)), F.array(F.lit(None).cast(_UNIT))), 1).alias("held"),
            F.concat(done, F.filter(x, whole)).alias("done"))), 1)

    return F.aggregate(units, start, step)


def round_copies(units: DataFrame, chunk: int = 256, seed: int = 1) -> DataFrame:
    """(row, copy) with copy 0 or 1 from units (source, row, id, size, f), 0 <= f <= 1, size > 0 where 0 < f < 1.

    Draws and order depend on the ids alone, not on the rows' places.

    A chunk holds about ``chunk`` units, whatever the source's share of all rows.
    """
    whole = (F.col("f") <= _EPS) | (F.col("f") >= 1 - _EPS)
    decided = units.filter(whole).select("row", F.round("f").cast("int").alias("copy"))
    left, level = cut(units.filter(~whole), "mix-units"), 0
    while True:
        per_source = left.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
        if per_source.filter("n > 1").isEmpty():
            last = _draw(F.col("id"), F.lit(seed), F.lit(-1)) < F.col("f")
            return decided.unionByName(left.select("row", last.cast("int").alias("copy")))
        chunks = F.ceil(F.col("n") / chunk)
        dealt = left.join(per_source.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).withColumn(
            "chunk", F.pmod(F.xxhash64("id", F.lit(seed + level)), chunks))
        unit = F.struct("id", "size", "f", "row")
        folded = dealt.groupBy("source", "chunk").agg(F.array_sort(F.collect_list(unit)).alias("units")).withColumn(
            "r", _fold(F.col("units"), F.lit(seed * 1000 + level)))
        folded = cut(folded.select("source", "r"), "mix-level")
        decided = decided.unionByName(folded.select(F.explode("r.done").alias("u")).select("u.row", F.round("u.f").cast("int").alias("copy")))
        left, level = folded.filter("r.held is not null").select("source", "r.held.*"), level + 1


def mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0, chunk: int = 256, seed: int = 1,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: _row, doc_id, size, source_size, target, copies, taken (copies times size).

    A null text has size 0; documents without words are never taken. A null source is a source of its own, the last. Null
    and repeated doc_ids are rows like others. A source's taken words miss its target by less than one document's
    size. Rows that are equal in doc_id, source and text are drawn for one by one. Very long texts are counted whole. Other columns of ``docs`` are not read. An empty table gives an empty result. ``docs`` must be a stored table.
    """
    sized = with_row_id(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("_text")))
    sized = cut(sized.select("_row", "doc_id", "source", word_count(F.col("_text")).alias("size"),
                             content_key(F.col("doc_id"), F.col("source"), F.col("_text")).alias("_key")), "mix-sizes")
    sized = cut(drawn_key(sized, "id"), "mix-keys")
    targets = cut(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap), "mix-targets")
    rows = sized.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    ratio = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = rows.withColumn("ratio", F.least(ratio, F.lit(cap))).withColumn("base", F.floor("ratio").cast("int"))
    units = rows.select("source", F.col("_row").alias("row"), "id", "size", (F.col("ratio") - F.col("base")).alias("f"))
    copies = round_copies(units, chunk, seed).withColumnRenamed("row", "_row")
    out = rows.join(copies, "_row").withColumn("copies", F.col("base") + F.col("copy"))
    return out.select("_row", "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it has copies. Null ids and sources, empty texts, repeated rows and empty tables as in :func:`mix`; columns may have any names besides those that it reads."""
    taken = mix(docs, **options).filter("copies > 0").select("_row", "copies")
    both = whole_rows(docs).join(taken, "_row")
    return both.select("_doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_doc.*")
