"""Quality classifier by importance resampling (Xie et al. 2023).

Two generative models over hashed word n-grams, one of the target text (labelled as good) and one of the raw text (all
documents), give each document a log importance weight: the sum of the log ratios of its n-grams. Gumbel noise is added, and the top k documents are a sample without replacement by these
weights.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import content_key, cut, drawn_key, with_row_id


class _Words(dict):
    """Hash of a word; emptied when it has grown large."""

    def __missing__(self, word):
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh32_intdigest(word)
        return h


def gram_slots(text: str | None, cache: _Words, bits: int) -> np.ndarray:
    """Slots of the text's words and word pairs, A-Z lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    h = np.fromiter(map(cache.__getitem__, words), np.uint32, len(words))
    pairs = (h[:-1] * np.uint32(0x85EBCA6B)) ^ (h[1:] * np.uint32(0xC2B2AE35)) ^ np.uint32(0x27D4EB2F)
    pairs ^= pairs >> np.uint32(15)
    return np.concatenate([h, pairs * np.uint32(0x9E3779B1)]) >> np.uint32(32 - bits)


def gram_counts(rows: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts per slot over the target rows and over all rows of (text, target); 2 x 2^bits numbers reach the driver."""
    def count(batches):
        cache, tables = _Words(), np.zeros((2, 1 << bits), np.int64)
        for pdf in batches:
            for text, target in zip(pdf["text"], pdf["target"]):
                slots = gram_slots(text, cache, bits)
                for table in tables[:2 if target else 1]:
                    if len(slots) > 1 << bits:
                        table += np.bincount(slots, minlength=1 << bits)
                    else:
                        np.add.at(table, slots, 1)
        yield pd.DataFrame({"model": [0, 1], "counts": [t.tobytes() for t in tables]})

    def merge(batches):
        sums = np.zeros((2, 1 << bits), np.int64)
        for pdf in batches:
            for m, blob in zip(pdf["model"], pdf["counts"]):
                sums[m] += np.frombuffer(blob, np.int64)
        yield pd.DataFrame({"model": [0, 1], "counts": [t.tobytes() for t in sums]})

    kind = "model int, counts binary"
    parts = rows.mapInPandas(count, kind)
    summed = parts.repartition(8).mapInPandas(merge, kind).collect()  # 16 rows
    out = np.zeros((2, 1 << bits), np.int64)
    for r in summed:
        out[r["model"]] += np.frombuffer(r["counts"], np.int64)
    return out[1], out[0]


def kth_largest(keys: DataFrame, k: int, buckets: int = 1024, few: int = 4096) -> tuple[float, int] | None:
    """(key, _row) of the k-th row of (_row, key) in descending order of key, ascending of _row; None if there are fewer.

    Counts per bucket narrow the range until ``few`` rows are left or all have one key; then the rows are the split.
    """
    n, lo, hi = keys.agg(F.count(F.lit(1)), F.min("key"), F.max("key")).first()
    if k > n or k < 1:
        return None
    inside, column = keys, "key"
    while n > few:
        if lo == hi:
            if column == "_neg":
                break
            # all keys are one: the row ids decide
            key, column = lo, "_neg"
            inside = inside.withColumn("_neg", -F.col("_row").cast("double"))
            lo, hi = inside.agg(F.min(column), F.max(column)).first()
            continue
        step = (hi - lo) / buckets
        at = F.least(F.floor((F.col(column) - F.lit(lo)) / F.lit(step)), F.lit(buckets - 1))
        counts = sorted(inside.groupBy(at.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).collect(), reverse=True)
        for b, m, blo, bhi in counts:
            if k <= m:
                inside, n, lo, hi = inside.filter((F.col(column) >= blo) & (F.col(column) <= bhi)), m, blo, bhi
                break
            k -= m
    found = sorted(((r["key"], -r["_row"]) for r in inside.select("key", "_row").collect()), reverse=True)[k - 1]
    return found[0], -found[1]


def importance(docs: DataFrame, labels: DataFrame, bits: int = 16, max_labels: int = 50_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_row, doc_id, log_weight, _key) of every row of ``docs``; the target are those whose doc_id has a label of quality 1.

    A text without words has log weight 0 (it says nothing), and so has every text if no target has words. A
    doc_id with several labels is a target if one of them is 1; a null doc_id has no label. The target model is fitted on at most
    ``max_labels`` such doc_ids, the first by a hash: so many fit a broadcast, and no text is shuffled to meet its label. The raw
    model counts all texts.
    """
    good = labels.filter("quality = 1").select(F.col(id_col).alias("doc_id")).filter("doc_id is not null").distinct()
    good = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels).withColumn("target", F.lit(True))
    rows = with_row_id(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    marked = rows.join(F.broadcast(good), "doc_id", "left").select("text", F.coalesce("target", F.lit(False)).alias("target"))
    target, raw = gram_counts(marked, bits)
    ratio = np.zeros(1 << bits)
    if target.sum():
        # the raw model is the target model's prior, so that an n-gram which the target lacks isn't held against a text for that alone
        p = (raw + 1.0) / (raw.sum() + len(raw))
        ratio = np.log((target + len(p) * p) / (target.sum() + len(p))) - np.log(p)
    sent = docs.sparkSession.sparkContext.broadcast(ratio.astype(np.float32))  # 4 bytes x 2^bits

    @F.pandas_udf("double")
    def weigh(texts: pd.Series) -> pd.Series:
        cache, table = _Words(), sent.value
        out = []
        for t in texts:
            slots = gram_slots(t, cache, bits)
            out.append(float(table[slots].sum(dtype=np.float64)))
        return pd.Series(out, dtype="float64")

    return rows.select("_row", "doc_id", weigh("text").alias("log_weight"), content_key(F.col("doc_id"), F.col("text")).alias("_key"))


def resample(docs: DataFrame, labels: DataFrame, share: float = 0.8, seed: int = 1, bits: int = 16, max_labels: int = 50_000,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: _row, doc_id, log_weight, gumbel_key, kept. ``share`` of the rows, rounded down, are kept.

    Repeated rows draw noise of their own; draws depend on doc_id and text, not on how the table is split. Very long texts count whole. Other columns are not read. An empty table gives an empty result.
    """
    weights = drawn_key(cut(importance(docs, labels, bits, max_labels, id_col, text_col), "quality-weights"))
    u = (F.pmod(F.xxhash64("_draw", F.lit(seed)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    keyed = cut(weights.select("_row", "doc_id", "log_weight", (F.col("log_weight") - F.log(-F.log(u))).alias("gumbel_key")), "quality-keys")
    split = kth_largest(keyed.select("_row", F.col("gumbel_key").alias("key")), int(keyed.count() * share))
    if split is None:
        return keyed.withColumn("kept", F.lit(False))
    key, row = split
    kept = (F.col("gumbel_key") > key) | ((F.col("gumbel_key") == key) & (F.col("_row") <= row))
    return keyed.withColumn("kept", kept)
