"""Suffix-array dedup by distributed prefix doubling: repeated byte strings of a fixed length across documents.

Prefix doubling names the strings of length h that begin at each position, and gets the names of longer ones from pairs of
names at a growing offset; positions whose name is unique are done. Three things make it fit for text of any size:

* Not all positions are ranked. Every string of 50 bytes holds an anchor: of its 24-byte strings, the one whose name is the
  least. Equal strings have their anchor at the same place, so only anchors (one position in fourteen) are sorted, and
  an anchor stands for the neighbouring strings that share it.
* Names come from running sums: the name of two adjacent strings is the name of the left one times a power of the base plus that of the
  right one, so the pairs of any offset are read off without another sort.
* Tasks send each distinct name once per block of documents, with the smallest doc_id that holds it there, packed in arrays.
  A name that a third of all documents hold is thus sent once per block.

Rounds: 24 bytes at anchors (unique ones are done); the whole stretch of strings that share an anchor (equal stretches are
decided at once); 37 bytes, to the right and to the left of anchors whose stretches differ; 50 bytes, string by string, for
those that are left. Spark deals names to buckets by their value, and each bucket is sorted and ranked on its own. The answers
go back to the blocks, which lie in a bucketed table and are not shuffled again.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import work_dir
from .common import cut, drop_table, shuffle_partitions, with_row_id

NO_ID = 2**63 - 1  # stands for a null doc_id: the largest
_SLICE = 1 << 20
_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(29))


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    run = lambda b: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, b, np.uint64)]))
    return run(base), run(pow(base, -1, 1 << 64))


def names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = 0) -> np.ndarray:
    """Names of the strings [starts, ends), which ascend and are at most a few hundred bytes long."""
    out = np.empty(len(starts), np.uint64)
    up, down = _powers(_BASES[base], _SLICE + 4096)
    lo = 0
    while lo < len(starts):
        first = int(starts[lo])
        hi = int(np.searchsorted(starts, first + _SLICE))
        last = int(ends[lo:hi].max())
        x = data[first:last].astype(np.uint64) + np.uint64(1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * up[:len(x)])])
        s = starts[lo:hi] - first
        out[lo:hi] = (sums[ends[lo:hi] - first] - sums[s]) * down[s]
        lo = hi
    return _mix(out)


def _gram_names(x: np.ndarray, length: int) -> np.ndarray:
    """Names of the ``length``-byte strings at all positions, by doubling."""
    have, out, done = x.astype(np.uint64) + np.uint64(1), None, 0
    base, size = _BASES[0], 1
    while True:
        if length & size:
            if out is None:
                out, done = have, size
            else:
                n = len(x) - done - size + 1
                out = out[:n] * np.uint64(pow(base, size, 1 << 64)) + have[done:done + n]
                done += size
        if done == length:
            return _mix(out)
        have = have[:-size] * np.uint64(pow(base, size, 1 << 64)) + have[size:]
        size *= 2


def anchors(data: np.ndarray, doc_ends: np.ndarray, length: int, gram: int):
    """(anchor, first and last start of the strings that share it, name); strings of ``length`` bytes within one document.

    Of the strings' ``gram``-byte strings the anchor is the one with the least name, the leftmost of equal ones.
    """
    width = length - gram + 1
    a, left, right, name = [], [], [], []
    total = len(data) - length + 1
    valid_end = doc_ends - length  # last start in each document
    for lo in range(0, max(total, 0), _SLICE):
        hi = min(total, lo + _SLICE)
        g = _gram_names(data[lo:hi + length - 1], gram)
        least = (g >> np.uint64(32) << np.uint64(32)) | np.arange(len(g), dtype=np.uint64)
        size = 1
        while size * 2 <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < width:
            least = np.minimum(least[:len(least) - (width - size)], least[width - size:])
        at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        starts = np.arange(lo, hi)
        inside = starts <= valid_end[np.searchsorted(doc_ends, starts, side="right")]
        starts, at = starts[inside], at[inside]
        if not len(at):
            continue
        new = np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)])
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(at)]]) - 1
        a.append(at[first] + lo)
        left.append(starts[first])
        right.append(starts[last])
        name.append(g[at[first]])
    if not a:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    a, left, right, name = (np.concatenate(x) for x in (a, left, right, name))
    # an anchor at a slice's edge was found twice
    again = np.concatenate([[False], (a[1:] == a[:-1]) & (left[1:] == right[:-1] + 1)])
    keep = np.flatnonzero(~again)
    ends = np.concatenate([keep[1:], [len(a)]]) - 1
    return a[keep], left[keep], right[ends], name[keep]


class Distinct:
    """The distinct keys of a block, in order of their first place."""

    def __init__(self, keys: list[np.ndarray], ids: np.ndarray):
        """ids: doc_id of each key, ascending."""
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(order), bool)
        new[:1] = True
        for k in keys:
            s = k[order]
            new[1:] |= s[1:] != s[:-1]
        starts = np.flatnonzero(new)
        first = order[starts]
        last = order[np.concatenate([starts[1:], [len(order)]]) - 1] if len(order) else first
        rank = np.argsort(first)
        place = np.empty(len(rank), np.int64)
        place[rank] = np.arange(len(rank))
        self.of = np.empty(len(order), np.int64)
        self.of[order] = place[np.cumsum(new) - 1]
        first, last = first[rank], last[rank]
        self.keys, self.first, self.several = [k[first] for k in keys], ids[first], ids[last] != ids[first]

    def bucket(self, buckets: int) -> np.ndarray:
        return ((self.keys[0] >> np.uint64(40)) % np.uint64(buckets)).astype(np.int32)

    def rows(self, block: int, buckets: int, widths: tuple[int, ...]):
        """(bucket, block, payload): the low ``widths`` bytes of each key, the first doc_ids, whether several documents of the block hold it."""
        b = self.bucket(buckets)
        order = np.argsort(b, kind="stable")
        edges = np.searchsorted(b[order], np.arange(buckets + 1))
        for k in np.flatnonzero(np.diff(edges)):
            at = order[edges[k]:edges[k + 1]]
            packed = b"".join(np.ascontiguousarray(x[at].astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :w].tobytes() for x, w in zip(self.keys, widths))
            ids = zlib.compress(np.diff(self.first[at], prepend=0).tobytes(), 1)
            flags = np.packbits(self.several[at]).tobytes()
            yield int(k), block, len(at).to_bytes(4, "little") + len(ids).to_bytes(4, "little") + ids + flags + packed

    def read(self, buckets: int, answers: dict[int, bytes]) -> np.ndarray:
        """The answer to each of the block's keys, repeats included."""
        out, b = np.zeros(len(self.first), np.uint8), self.bucket(buckets)
        order = np.argsort(b, kind="stable")
        edges = np.searchsorted(b[order], np.arange(buckets + 1))
        for k, blob in answers.items():
            out[order[edges[k]:edges[k + 1]]] = np.frombuffer(zlib.decompress(blob), np.uint8)
        return out[self.of]


def _unpack(payload: bytes, widths: tuple[int, ...]):
    n, m = int.from_bytes(payload[:4], "little"), int.from_bytes(payload[4:8], "little")
    ids = np.cumsum(np.frombuffer(zlib.decompress(payload[8:8 + m]), np.int64))
    at = 8 + m
    flags = np.unpackbits(np.frombuffer(payload, np.uint8, -(-n // 8), at))[:n].astype(bool)
    at += -(-n // 8)
    keys = []
    for w in widths:
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :w] = np.frombuffer(payload, np.uint8, n * w, at).reshape(n, w)
        keys.append(wide.view("<u8").ravel())
        at += n * w
    return keys, ids, flags


def _rank(payloads: list[bytes], kind: str, widths: tuple[int, ...]) -> list[bytes]:
    """Sorts a bucket's names and answers each payload. shared: 1 if two documents hold the name; first: 1 if one before the
    block's first does; stretch: first, for name and stretch, plus 2 if two documents hold the name with different stretches."""
    parts = [_unpack(p, widths) for p in payloads]
    keys = [np.concatenate([p[0][i] for p in parts]) for i in range(len(widths))]
    ids, several = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
    order = np.lexsort(keys[::-1])
    changes = np.zeros((len(keys), len(order)), bool)
    changes[:, :1] = True
    for i, k in enumerate(keys):
        s = k[order]
        changes[i, 1:] = s[1:] != s[:-1]

    def groups(new):
        starts, of = np.flatnonzero(new), np.cumsum(new) - 1
        low, high = np.minimum.reduceat(ids[order], starts), np.maximum.reduceat(ids[order], starts)
        return of, low, (low != high) | np.logical_or.reduceat(several[order], starts)

    of, low, shared = groups(changes.any(axis=0))
    if kind == "shared":
        answer = shared[of].astype(np.uint8)
    else:
        answer = (low[of] < ids[order]).astype(np.uint8)
        if kind == "stretch":
            named, _, held = groups(changes[0])
            stretches = np.bincount(named, changes.any(axis=0))
            answer |= ((stretches > 1) & held)[named].astype(np.uint8) << np.uint8(1)
    back = np.empty(len(order), np.uint8)
    back[order] = answer
    sizes = np.cumsum([len(p[1]) for p in parts])[:-1]
    return [zlib.compress(x.tobytes(), 1) for x in np.split(back, sizes)]


def rank_names(sent: DataFrame, kind: str, widths: tuple[int, ...], round_no: int) -> DataFrame:
    """(block, round, bucket, answer) from (bucket, block, payload). A task holds one bucket at a time."""
    def run(batches):
        bucket, blocks, payloads = None, [], []

        def answers():
            return pd.DataFrame({"block": blocks, "round": round_no, "bucket": bucket, "answer": _rank(payloads, kind, widths)})

        for pdf in batches:
            for b, block, payload in zip(pdf["bucket"].tolist(), pdf["block"].tolist(), pdf["payload"]):
                if b != bucket:
                    if payloads:
                        yield answers()
                    bucket, blocks, payloads = b, [], []
                blocks.append(block)
                payloads.append(payload)
        if payloads:
            yield answers()

    dealt = sent.repartition("bucket").sortWithinPartitions("bucket", "block")
    return cut(dealt.mapInPandas(run, "block long, round int, bucket int, answer binary"), "suffix-answers")


class Block:
    """Documents of a block, with what the rounds so far have found out."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray, ids: np.ndarray, length: int, gram: int, buckets: int, answers: dict[int, dict[int, bytes]]):
        self.data, self.length, self.gram, self.buckets = data, length, gram, buckets
        self.ends = np.cumsum(lengths)
        self.starts, self.ids = self.ends - lengths, ids
        self.a, self.l, self.r, self.name = anchors(data, self.ends, length, gram)
        self.doc = np.searchsorted(self.ends, self.a, side="right")
        self.answers = answers
        self.half = (length - gram) // 2  # bytes that the middle round adds to an anchor

    def _read(self, d: Distinct, round_no: int) -> np.ndarray:
        return d.read(self.buckets, self.answers.get(round_no, {}))

    def grams(self) -> Distinct:
        return Distinct([self.name], self.ids[self.doc])

    def stretches(self) -> tuple[np.ndarray, Distinct]:
        """Anchors whose name two documents hold, with the name of their stretch."""
        at = np.flatnonzero(self._read(self.grams(), 1))
        whole = names(self.data, self.l[at], self.r[at] + self.length)
        whole = _mix(whole + (self.a[at] - self.l[at]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (self.r[at] - self.l[at]).astype(np.uint64))
        return at, Distinct([self.name[at], whole], self.ids[self.doc[at]])

    def decided(self) -> tuple[np.ndarray, np.ndarray]:
        """Anchors all of whose strings an earlier document holds, and those whose strings must be looked at."""
        at, d = self.stretches()
        answer = self._read(d, 2)
        repeated = (answer & 1 == 1) | (self.ids[self.doc[at]] > d.first[d.of])
        return at[repeated], at[~repeated & (answer & 2 == 2)]

    def halves(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, Distinct]:
        """Undecided anchors, the positions among them that reach far enough to the right and to the left, and both's names."""
        at = self.decided()[1]
        a, doc, reach = self.a[at], self.doc[at], self.gram + self.half
        right = np.flatnonzero(a + reach + (self.length - self.gram) % 2 <= self.ends[doc])
        left = np.flatnonzero(a - self.half >= self.starts[doc])
        rn = names(self.data, a[right], a[right] + reach + (self.length - self.gram) % 2)
        ln = _mix(names(self.data, a[left] - self.half, a[left] + self.gram) + np.uint64(1))
        # keys ascend by document, so that the first place of a name is in the first document that holds it
        both = np.concatenate([right, left])
        order = np.argsort(both, kind="stable")
        return at, both[order], np.concatenate([np.ones(len(right), bool), np.zeros(len(left), bool)])[order], Distinct(
            [np.concatenate([rn, ln])[order]], self.ids[doc[both[order]]])

    def strings(self) -> tuple[np.ndarray, Distinct]:
        """Starts of the strings that are left, and their names."""
        at, both, is_right, d = self.halves()
        shared = self._read(d, 3) == 1
        right, left = np.zeros(len(at), bool), np.zeros(len(at), bool)
        right[both[shared & is_right]] = True
        left[both[shared & ~is_right]] = True
        # a string that begins up to half bytes before its anchor holds the right half, one that begins half or more before it the left
        lo = np.where(left, self.l[at], np.maximum(self.l[at], self.a[at] - self.half))
        hi = np.where(right, self.r[at], np.minimum(self.r[at], self.a[at] - self.half))
        n = np.where(left | right, np.maximum(hi - lo + 1, 0), 0)
        s = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        keys = [names(self.data, s, s + self.length, k) for k in (0, 1)]
        return s, Distinct(keys, self.ids[np.repeat(self.doc[at], n)])

    def removed(self) -> np.ndarray:
        """Whether each byte goes."""
        whole = self.decided()[0]
        s, d = self.strings()
        doc = np.searchsorted(self.ends, s, side="right")
        repeated = (self._read(d, 4) == 1) | (self.ids[doc] > d.first[d.of])
        edge = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(edge, self.l[whole], 1)
        np.add.at(edge, self.r[whole] + self.length, -1)
        np.add.at(edge, s[repeated], 1)
        np.add.at(edge, s[repeated] + self.length, -1)
        return np.cumsum(edge[:-1]) > 0


#: Rounds: the block's names, kind of answer, bytes of each name that are sent.
ROUNDS = (
    (lambda b: b.grams(), "shared", (5,)),
    (lambda b: b.stretches()[1], "stretch", (5, 8)),
    (lambda b: b.halves()[3], "shared", (5,)),
    (lambda b: b.strings()[1], "first", (8, 8)),
)


def write_blocks(docs: DataFrame, block_bytes: int, partitions: int, id_col: str, text_col: str) -> str:
    """Writes a table of blocks of about ``block_bytes`` (or one document), bucketed by block; returns its name."""
    doc_id = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    rows = with_row_id(docs.select(doc_id.alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")))

    def pack(batches):
        held, n, k = [], 0, 0

        def block():
            held.sort(key=lambda x: x[0])
            return pd.DataFrame({
                "block": [(part << 24) + k], "row": [np.array([x[1] for x in held], np.int64).tobytes()], "ids": [np.array([x[0] for x in held], np.int64).tobytes()],
                "lengths": [np.array([len(x[2]) for x in held], np.int64).tobytes()], "n_bytes": [n], "data": [zstandard.ZstdCompressor(level=3).compress(b"".join(x[2] for x in held))]})

        part = 0
        for pdf in batches:
            for row, doc, text in zip(pdf["_row"].tolist(), pdf["doc_id"].tolist(), pdf["text"]):
                part = row >> 33
                held.append((doc, row, text.encode("utf-8", "surrogatepass")))
                n += len(held[-1][2])
                if n >= block_bytes:
                    yield block()
                    held, n, k = [], 0, k + 1
        if held:
            yield block()

    table = "suffix_blocks_" + uuid.uuid4().hex[:12]
    blocks = rows.mapInPandas(pack, "block long, row binary, ids binary, lengths binary, n_bytes long, data binary")
    blocks.repartition(partitions, "block").write.bucketBy(partitions, "block").sortBy("block").option("compression", "uncompressed").option(
        "path", work_dir(docs.sparkSession, "suffix-blocks")).saveAsTable(table)
    return table


def suffix_dedup(docs: DataFrame, length: int = 50, gram: int = 24, block_bytes: int = 4 << 20, blocks_per_bucket: int = 32, min_buckets: int = 64,
                 partitions: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (removed [begin, end) in bytes).

    Every byte of a text that is covered by a string of ``length`` bytes that also starts in a document with a smaller doc_id is
    removed; strings are those of the input. A null or empty text has no bytes. A null doc_id counts as the largest; rows
    that repeat a doc_id don't remove each other's bytes. Texts shorter than ``length`` keep all. Other columns of ``docs``
    are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    table = write_blocks(docs, block_bytes, partitions or shuffle_partitions(spark), id_col, text_col)
    try:
        result = _dedup(spark.table(table), length, gram, blocks_per_bucket, min_buckets)
    finally:
        drop_table(spark, table)
    return result.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))


def _dedup(blocks: DataFrame, length: int, gram: int, blocks_per_bucket: int, min_buckets: int) -> DataFrame:
    buckets = max(min_buckets, blocks.count() // blocks_per_bucket)
    answers = None

    def loaded(batches):
        for pdf in batches:
            for block, ids, lengths, blob, found in zip(pdf["block"].tolist(), pdf["ids"], pdf["lengths"], pdf["data"], pdf["found"]):
                per_round: dict[int, dict[int, bytes]] = {}
                for x in found if found is not None else ():
                    per_round.setdefault(x["round"], {})[x["bucket"]] = x["answer"]
                data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8) if len(lengths) else np.zeros(0, np.uint8)
                yield block, Block(data, np.frombuffer(lengths, np.int64), np.frombuffer(ids, np.int64), length, gram, buckets, per_round)

    def joined():
        if answers is None:
            return blocks.withColumn("found", F.lit(None).cast("array<struct<round:int,bucket:int,answer:binary>>"))
        found = answers.groupBy("block").agg(F.collect_list(F.struct("round", "bucket", "answer")).alias("found"))  # one answer per round and bucket
        return blocks.join(found, "block", "left")

    for round_no, (keys, kind, widths) in enumerate(ROUNDS, 1):
        def send(batches, keys=keys, widths=widths):
            for block, b in loaded(batches):
                rows = list(keys(b).rows(block, buckets, widths))
                if rows:
                    yield pd.DataFrame(rows, columns=["bucket", "block", "payload"])

        new = rank_names(joined().mapInPandas(send, "bucket int, block long, payload binary"), kind, widths, round_no)
        answers = new if answers is None else answers.unionByName(new)

    def finish(batches):
        for _, b in loaded(batches):
            gone = b.removed()
            out = []
            for doc, lo, hi in zip(b.ids.tolist(), b.starts.tolist(), b.ends.tolist()):
                g = gone[lo:hi]
                flips = np.flatnonzero(np.diff(np.concatenate([[0], g.view(np.int8), [0]])))
                kept = b.data[lo:hi][~g].tobytes()
                out.append((doc, hi - lo, int(g.sum()), len(flips) // 2, hashlib.sha256(kept).hexdigest(),
                            [{"begin": int(x), "end": int(y)} for x, y in zip(flips[::2], flips[1::2])]))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<begin:long,end:long>>"
    return cut(joined().mapInPandas(finish, schema), "suffix-result")
