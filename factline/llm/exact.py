"""Exact dedup by deterministic block naming (Karp, Miller and Rosenberg 1972). DataFrame functions only.

The text without white space is cut into blocks of a fixed size. Equal blocks get one integer name: the distinct
blocks are sorted inside their shuffle partition and numbered. Then the names of adjacent blocks are paired and
the pairs named in the same way, halving each document's names per round until one is left. That name and its
round identify the text: no two different texts share it, since names are given to strings and pairs, not hashes.

The text is shuffled once, to name the blocks. Blocks find their names again by a 64-bit hash; a hash that two
different blocks share is found when names are counted per hash, and those blocks are joined by their content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, cut, with_row_id

#: Name that stands in for the missing right half of an odd pair.
NO_NAME = -1


def squeeze(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACES}]+", "")


def _named(keys: DataFrame, order: list[str]) -> DataFrame:
    """Distinct ``order`` columns with an integer ``name``; sorting makes a rerun of a partition give the same names."""
    distinct = keys.groupBy(*order).agg(F.count(F.lit(1)).alias("_n"))
    return distinct.sortWithinPartitions(*order).withColumn("name", F.monotonically_increasing_id()).drop("_n")


def _block_hash(block: Column, hash_bits: int) -> Column:
    h = F.xxhash64(block)
    return h if hash_bits == 64 else F.pmod(h, F.lit(1 << hash_bits))


def _blocks(text: Column, block_size: int) -> Column:
    """The text's blocks in order; an empty text has one empty block."""
    n = F.greatest(F.lit(1), F.ceil(F.length(text) / block_size)).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(text, i * block_size + 1, F.lit(block_size)))


def name_blocks(heads: DataFrame, texts: DataFrame, hash_bits: int = 64) -> DataFrame:
    """(_row, _ix, _n, name) for each block. heads: (_row, hashes of its blocks); texts: (_row, _blocks)."""
    places = heads.select("_row", F.size("hashes").alias("_n"), F.posexplode("hashes").alias("_ix", "h"))
    blocks = texts.select(F.explode("_blocks").alias("block")).select(_block_hash(F.col("block"), hash_bits).alias("h"), "block")
    names = cut(_named(blocks, ["h", "block"]).select("h", "name"), "exact-names")
    # written, so that the join reads both sides from a shuffle and splits a block that many texts share
    per_hash = cut(names.groupBy("h").agg(F.min("name").alias("name"), F.count(F.lit(1)).alias("n")), "exact-hashes")
    clashes = per_hash.filter("n > 1").select("h")
    found = places.join(per_hash.filter("n = 1").select("h", "name"), "h").select("_row", "_ix", "_n", "name")
    if clashes.isEmpty():
        return found
    # the rare way: only blocks whose hash has several names travel with their content
    again = _named(blocks.join(clashes, "h", "left_semi"), ["h", "block"])
    again = cut(again.withColumn("name", -2 - F.col("name")), "exact-clashes")  # apart from the other names
    content = texts.select("_row", F.size("_blocks").alias("_n"), F.posexplode("_blocks").alias("_ix", "block"))
    content = content.withColumn("h", _block_hash(F.col("block"), hash_bits))
    return found.unionByName(content.join(again, ["h", "block"]).select("_row", "_ix", "_n", "name"))


def identities(heads: DataFrame, texts: DataFrame, hash_bits: int = 64) -> DataFrame:
    """(_row, level, name): rows have the same level and name exactly if their texts are equal."""
    names, done, level = cut(name_blocks(heads, texts, hash_bits), "exact-level"), None, 0
    while True:
        single = names.filter("_n = 1").select("_row", F.lit(level).alias("level"), "name")
        done = single if done is None else done.unionByName(single)
        longer = names.filter("_n > 1")
        if longer.isEmpty():
            return done
        pairs = longer.groupBy("_row", F.expr("_ix div 2").cast("int").alias("_ix"), F.expr("(_n + 1) div 2").cast("int").alias("_n")).agg(
            F.max(F.when(F.col("_ix") % 2 == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(F.col("_ix") % 2 == 1, F.col("name"))), F.lit(NO_NAME)).alias("right"))
        pairs = cut(pairs, "exact-pairs")
        named = cut(_named(pairs, ["left", "right"]), "exact-named")
        names = cut(pairs.join(named, ["left", "right"]).select("_row", "_ix", "_n", "name"), "exact-level")
        level += 1


def exact_dedup(docs: DataFrame, block_size: int = 4096, hash_bits: int = 64, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are identical without white space; the row with the most code points, then the
    smallest doc_id, stays. A null text counts as empty; empty texts form one group. A null doc_id ranks after
    all others; of rows that tie in both, one stays. Other columns of ``docs`` are not read. An empty table gives
    an empty result. ``hash_bits`` below 64 only serves to force hash clashes in tests.
    """
    rows = with_row_id(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")))
    rows = rows.withColumn("_squeezed", squeeze(F.col("_text")))
    texts = rows.select("*", _blocks(F.col("_squeezed"), block_size).alias("_blocks"))
    heads = cut(texts.select(
        "_row", "doc_id", F.coalesce(F.length("_text"), F.lit(0)).alias("n"), F.sha2("_squeezed", 256).alias("text_sha256"),
        F.transform("_blocks", lambda b: _block_hash(b, hash_bits)).alias("hashes")), "exact-heads")
    return _keep_one(heads.drop("hashes"), identities(heads, texts, hash_bits))


def _keep_one(facts: DataFrame, ids: DataFrame) -> DataFrame:
    """Groups are aggregated before any shuffle of rows and written, so that the join reads both sides from a shuffle and splits a hot group."""
    facts = cut(facts.join(ids, "_row"), "exact-facts")
    first = F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("null"), "doc_id", "_row")
    groups = facts.groupBy("level", "name").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("group_size"))
    groups = groups.select("level", "name", "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first._row").alias("_keep"))
    groups = cut(groups, "exact-groups")
    return facts.join(groups, ["level", "name"]).select(
        "doc_id", "keep_id", "group_size", (F.col("_row") == F.col("_keep")).alias("kept"), "text_sha256")
