"""SimHash near-dedup by anchor-point covering.

The anchors are the code words of the perfect binary Golay code of length 23: every 23-bit word lies within 3 bits of
exactly one of its 4,096 code words. A fingerprint is cut into three parts of 23, 23 and 18 bits (the last filled up
with zeros); if two fingerprints differ in at most ``max_distance`` bits, they differ in at most
``max_distance // 3`` bits in one of the parts. There, the anchor nearest to the one lies within 3 + max_distance // 3
bits of the other. So every fingerprint is sent, per part, to all anchors within the covering radius plus that
threshold, and is compared, on all 64 bits, with those whose nearest anchor it is. No pair is missed.

Only distinct fingerprints are compared. An anchor with many fingerprints is dealt to a grid of tasks, each of which
compares one chunk with another, so the size of a task is bounded. A task returns a spanning forest of the
links it finds, not the links: components need no more.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, whole_rows, with_row_id
from .components import components

#: Bits of the three parts, from the highest bit down.
PARTS = (23, 23, 18)
#: Fixed value: generator polynomial of the binary Golay code of length 23.
GOLAY = 0b101011100011


def code_words() -> np.ndarray:
    """The 4,096 multiples of the generator polynomial."""
    words = np.zeros(1, np.int64)
    for i in range(12):
        words = np.concatenate([words, words ^ (GOLAY << i)])
    return np.sort(words)


class Anchors:
    """For each 23-bit word, its nearest code word, and the code words within 3 + ``extra`` bits."""

    def __init__(self, extra: int):
        self.words, self.extra = code_words(), extra
        # the syndrome of a word names the error pattern to its nearest code word
        self.errors = np.zeros(1 << 11, np.int64)
        for pattern in _patterns(3):
            self.errors[self._syndrome(np.array([pattern]))[0]] = pattern
        # code words at distance d from w are w ^ e for the patterns e of weight d in w's coset
        far = np.array(_patterns(3 + extra), np.int64)
        syndromes = self._syndrome(far)
        order = np.argsort(syndromes, kind="stable")
        self.far, self.starts = far[order], np.searchsorted(syndromes[order], np.arange((1 << 11) + 1))

    @staticmethod
    def _syndrome(words: np.ndarray) -> np.ndarray:
        """Remainder of the words' polynomials modulo the generator."""
        r = words.copy()
        for bit in range(22, 10, -1):
            r = np.where((r >> bit) & 1 == 1, r ^ (GOLAY << (bit - 11)), r)
        return r

    def nearest(self, words: np.ndarray) -> np.ndarray:
        return words ^ self.errors[self._syndrome(words)]

    def within(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``words``, anchor) for all anchors within the covering radius plus the threshold."""
        s = self._syndrome(words)
        counts = self.starts[s + 1] - self.starts[s]
        at = np.repeat(np.arange(len(words)), counts)
        k = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
        return at, words[at] ^ self.far[self.starts[s][at] + k]


def _patterns(weight: int) -> list[int]:
    """All 23-bit words with at most ``weight`` ones."""
    out, last = [0], [(0, -1)]
    for _ in range(weight):
        last = [(w | 1 << b, b) for w, top in last for b in range(top + 1, 23)]
        out += [w for w, _ in last]
    return out


def part_words(fingerprints: np.ndarray) -> list[np.ndarray]:
    x, out, low = fingerprints.view(np.uint64), [], 64
    for n in PARTS:
        low -= n
        out.append(((x >> np.uint64(low)) & np.uint64((1 << n) - 1)).astype(np.int64))
    return out


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash of the text's word shingles, as an unsigned integer."""
    hashes = shingle_hashes(text, shingle)
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # a long text is counted in slices
        ones += np.unpackbits(hashes[at:at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)] if words else [], np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-shingle] + 1]).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], 42) for a, b in zip(starts, ends[shingle - 1:].tolist())), np.uint64, len(starts))


def fingerprints(rows: DataFrame, shingle: int) -> DataFrame:
    """(_row, doc_id, fp) of every row; ``fp`` is the fingerprint as a signed 64-bit integer."""
    def run(batches):
        for pdf in batches:
            fp = np.array([fingerprint(t, shingle) for t in pdf["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"_row": pdf["_row"], "doc_id": pdf["doc_id"], "fp": fp})

    kind = rows.schema["doc_id"].dataType
    keyed = rows.select("_row", F.col("doc_id").cast("string"), "text").mapInPandas(run, "_row long, doc_id string, fp long")
    return keyed.withColumn("doc_id", F.col("doc_id").cast(kind))


def _forest(x: np.ndarray, y: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links between ``x`` and ``y`` at most ``max_distance`` bits apart."""
    nodes, at = np.unique(np.concatenate([x, y]), return_inverse=True)
    ax, ay = at[:len(x)], at[len(x):]
    label = np.arange(len(nodes))
    step = max(1, (1 << 20) // max(1, len(y)))
    for i in range(0, len(x), step):
        near = np.bitwise_count(x[i:i + step, None].view(np.uint64) ^ y[None, :].view(np.uint64)) <= max_distance
        a, b = np.nonzero(near)
        a, b = ax[i:i + step][a], ay[b]
        while True:  # only roots are hung on smaller roots, so what earlier slices have joined moves as a whole
            ra, rb = label[a], label[b]
            apart = ra != rb
            if not apart.any():
                break
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))
            while (label[label] != label).any():
                label = label[label]
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def links(distinct: DataFrame, max_distance: int, chunk: int = 4096) -> DataFrame:
    """(a, b): a set of pairs of fingerprints whose components are those of all links."""
    extra = max_distance // len(PARTS)
    if extra > 2:
        raise ValueError("max_distance above 8 needs too many anchors")

    def spread(batches):
        anchors = Anchors(extra)
        for pdf in batches:
            fp = pdf["fp"].to_numpy(np.int64)
            for part, words in enumerate(part_words(fp)):
                at, anchor = anchors.within(words)
                yield pd.DataFrame({"anchor": (anchor | part << 23).astype(np.int32), "fp": fp[at], "home": anchors.nearest(words)[at] == anchor})

    spread_out = distinct.select("fp").mapInPandas(spread, "anchor int, fp long, home boolean")
    spread_out = cut(spread_out, "simhash-anchors")
    sizes = spread_out.groupBy("anchor").agg(F.expr("count_if(home)").alias("homes"), F.count(F.lit(1)).alias("n"))
    sizes = sizes.filter("homes > 0 and n > 1").select(
        "anchor", F.ceil(F.col("homes") / chunk).cast("int").alias("rows"), F.ceil(F.col("n") / chunk).cast("int").alias("columns"))
    dealt = spread_out.join(F.broadcast(sizes), "anchor")  # one row per anchor: 12,288 at most
    # the grid of an anchor: chunks of its own fingerprints against chunks of all it has got
    home = dealt.filter("home").withColumn("i", F.pmod(F.xxhash64("fp"), F.col("rows")).cast("int")).withColumn(
        "j", F.explode(F.sequence(F.lit(0), F.col("columns") - 1))).withColumn("side", F.lit(0))
    guest = dealt.withColumn("j", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("columns")).cast("int")).withColumn(
        "i", F.explode(F.sequence(F.lit(0), F.col("rows") - 1))).withColumn("side", F.lit(1))
    cells = home.select("anchor", "i", "j", "side", "fp").unionByName(guest.select("anchor", "i", "j", "side", "fp"))
    cells = cells.repartition("anchor", "i", "j").sortWithinPartitions("anchor", "i", "j", "side")

    def compare(batches):
        rest = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            keys = pdf[["anchor", "i", "j"]].to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
            yield _compare_cells(pdf, starts, max_distance)
            rest = pdf.iloc[starts[-1]:]  # the last cell may go on in the next batch
        if rest is not None and len(rest):
            yield _compare_cells(rest, np.array([0, len(rest)]), max_distance)

    return cells.mapInPandas(compare, "a long, b long").distinct()


def _compare_cells(pdf: pd.DataFrame, starts: np.ndarray, max_distance: int) -> pd.DataFrame:
    """Links of the cells [starts[k], starts[k + 1])."""
    fp, side = pdf["fp"].to_numpy(np.int64), pdf["side"].to_numpy()
    a, b = [], []
    for lo, hi in zip(starts[:-1], starts[1:]):
        mid = lo + np.searchsorted(side[lo:hi], 1)
        if lo < mid < hi:
            x, y = _forest(fp[lo:mid], fp[mid:hi], max_distance)
            a.append(x)
            b.append(y)
    none = np.zeros(0, np.int64)
    return pd.DataFrame({"a": np.concatenate([none, *a]), "b": np.concatenate([none, *b])})


def simhash_components(docs: DataFrame, shingle: int = 4, max_distance: int = 4, chunk: int = 4096, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: _row, doc_id, fp, root (least fingerprint of the component), component_id (the smallest doc_id reachable by links).

    Words are split at white space, A-Z lower-cased; a text of fewer words than ``shingle`` has one shingle, one
    without words (null, empty) the fingerprint zero, which is linked like any other. Repeated rows share a component.
    A null doc_id counts as the largest; a component of nulls only has a null component_id. Other columns of ``docs``
    are not read. An empty table gives an empty result.
    """
    rows = with_row_id(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    ids = F.struct(F.col("doc_id").isNull().alias("null"), F.col("doc_id").alias("id"))
    keyed = cut(fingerprints(rows, shingle), "simhash-prints")
    distinct = cut(keyed.groupBy("fp").agg(F.min(ids).alias("first")), "simhash-distinct")
    labels = components(cut(links(distinct, max_distance, chunk), "simhash-links"))  # (node, root), only linked ones
    rooted = distinct.join(labels, distinct["fp"] == labels["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    least = rooted.groupBy("root").agg(F.min("first").alias("first"))
    named = rooted.select("fp", "root").join(least, "root").select("fp", "root", F.col("first.id").alias("component_id"))
    return keyed.join(named, "fp").select("_row", "doc_id", "fp", "root", "component_id")


def hex_fingerprint(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def simhash_dedup(docs: DataFrame, shingle: int = 4, max_distance: int = 4) -> DataFrame:
    """The rows of ``docs`` that stay: of every component the row with its smallest doc_id, of repeats the first.

    Components are those of the fingerprints, so that documents without or with repeated doc_ids stay apart if their texts do; a null
    doc_id counts as the largest. Texts without words form one component. All columns are kept, whatever their names; an empty table stays empty.
    """
    found = simhash_components(docs, shingle, max_distance)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "_row")).alias("first"))
    return whole_rows(docs).join(first.select(F.col("first._row").alias("_row")), "_row", "left_semi").select("_doc.*")
