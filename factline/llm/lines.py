"""Line dedup with a sharded minimal perfect hash over the repeated lines.

Lines are counted by a 128-bit hash of their key. The hashes of the keys to thin out are dealt to shards; each shard
gets a minimal perfect hash (level bit arrays with ranks, as in Limasset et al. 2017), which maps its n keys to 0..n-1,
and three arrays in that order: a 64-bit fingerprint, the number of documents, the doc_id that keeps the line.
A document probes the arrays with its own lines' hashes: a line that is no key gets some place in the arrays, where
the fingerprint tells it apart. No line is joined.

The arrays go to the documents by broadcast while their summed size, which is read first, is below a bound. Beyond it the
documents' line hashes go to the shards, salted so that a line of many documents is probed in many tasks.
"""

from __future__ import annotations

import hashlib
import io

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, with_row_id

_STRIP = b" \t\n\x0b\x0c\r"
_GAMMA = 1.5  # bits per key and level
_NO_ID = -(2**63)  # stands for a null doc_id inside the operator


def line_key(line: bytes) -> bytes:
    """UTF-8 line without white space at its ends, A-Z lower-cased."""
    return line.strip(_STRIP).lower()


def _code_points(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode("utf-8"))


def _hashes(line: bytes, min_length: int):
    """(slot hash, fingerprint) of the line's key, None if the key is short."""
    key = line_key(line)
    if len(key) < min_length or _code_points(key) < min_length:
        return None
    h = xxhash.xxh3_128_digest(key)
    return int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True)


def _mix(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys.view(np.uint64) + np.uint64((level * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys. Each level is a bit array: a key that has its bit alone rests there."""

    def __init__(self, levels: list[np.ndarray], last: np.ndarray):
        self.levels, self.last = levels, last
        self.ranks, self.starts, n = [], [], 0
        for bits in levels:
            ones = np.cumsum(np.unpackbits(bits).reshape(-1, 64).sum(axis=1, dtype=np.int64))
            self.ranks.append(np.concatenate([[0], ones[:-1]]))
            self.starts.append(n)
            n += int(ones[-1])
        self.n = n + len(last)

    @staticmethod
    def build(keys: np.ndarray, max_levels: int = 32) -> "PerfectHash":
        levels = []
        while len(keys) and len(levels) < max_levels:
            m = -(-int(len(keys) * _GAMMA + 1) // 64) * 64
            at = (_mix(keys, len(levels)) % np.uint64(m)).astype(np.int64)
            counts = np.bincount(at, minlength=m)
            levels.append(np.packbits(counts == 1))
            keys = keys[counts[at] > 1]
        return PerfectHash(levels, np.sort(keys))

    def index(self, keys: np.ndarray) -> np.ndarray:
        """0..n-1 for the built keys; any place or -1 for others."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (bits, ranks, start) in enumerate(zip(self.levels, self.ranks, self.starts)):
            if not len(left):
                return out
            at = (_mix(keys[left], level) % np.uint64(len(bits) * 8)).astype(np.int64)
            hit = (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
            place = at[hit]
            word = place >> 6
            window = np.unpackbits(bits.reshape(-1, 8)[word], axis=1)
            before = (window * (np.arange(64) < (place & 63)[:, None])).sum(axis=1)
            out[left[hit]] = start + ranks[word] + before
            left = left[~hit]
        if len(left) and len(self.last):
            at = np.searchsorted(self.last, keys[left])
            known = (at < len(self.last)) & (self.last[np.minimum(at, len(self.last) - 1)] == keys[left])
            out[left[known]] = self.n - len(self.last) + at[known]
        return out


class Shard:
    """Perfect hash of a shard's keys with the arrays it indexes."""

    def __init__(self, hasher: PerfectHash, prints: np.ndarray, counts: np.ndarray, keepers: np.ndarray):
        self.hasher, self.prints, self.counts, self.keepers = hasher, prints, counts, keepers

    @staticmethod
    def build(keys, prints, counts, keepers) -> "Shard":
        # keys that share the slot hash, not the fingerprint, can't share a place: all but one rest beside the arrays
        order = np.lexsort((prints, keys))
        keys, prints, counts, keepers = (x[order] for x in (keys, prints, counts, keepers))
        first = np.ones(len(keys), bool)
        first[1:] = keys[1:] != keys[:-1]
        hasher = PerfectHash.build(keys[first])
        at = hasher.index(keys[first])
        place = np.empty(len(at), np.int64)
        place[at] = np.arange(len(at))
        rest = lambda x: np.concatenate([x[first][place], x[~first]])
        shard = Shard(hasher, rest(prints), rest(counts), rest(keepers))
        shard.extra = keys[~first]
        return shard

    extra = np.zeros(0, np.int64)

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, last=self.hasher.last, prints=self.prints, counts=self.counts, keepers=self.keepers, extra=self.extra,
                 **{f"level{i}": x for i, x in enumerate(self.hasher.levels)})
        return out.getvalue()

    @staticmethod
    def unpack(blob: bytes) -> "Shard":
        x = np.load(io.BytesIO(blob))
        levels = [x[f"level{i}"] for i in range(sum(k.startswith("level") for k in x.files))]
        shard = Shard(PerfectHash(levels, x["last"]), x["prints"], x["counts"], x["keepers"])
        shard.extra = x["extra"]
        return shard

    def probe(self, keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each (slot hash, fingerprint) is a key, and the doc_id that keeps its line."""
        at = self.hasher.index(keys)
        known = at >= 0
        at = np.maximum(at, 0)
        if not len(self.prints):
            return known & False, at
        known &= self.prints[at] == prints
        for i in range(len(self.extra)):
            same = (keys == self.extra[i]) & (prints == self.prints[self.hasher.n + i])
            at[same], known = self.hasher.n + i, known | same
        return known, self.keepers[at]


def count_lines(rows: DataFrame, min_length: int) -> DataFrame:
    """(slot, print, docs, keeper) of every distinct line key of at least ``min_length`` code points."""
    def emit(batches):
        for pdf in batches:
            slots, prints, ids = [], [], []
            for text, doc in zip(pdf["text"], pdf["doc_id"]):
                found = {h for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n") if (h := _hashes(line, min_length))}
                slots += [h[0] for h in found]
                prints += [h[1] for h in found]
                ids += [doc] * len(found)
            yield pd.DataFrame({"slot": np.array(slots, np.int64), "print": np.array(prints, np.int64), "doc_id": np.array(ids, np.int64)})

    lines = rows.select("text", "doc_id").mapInPandas(emit, "slot long, print long, doc_id long")
    once = lines.distinct()  # rows of one doc_id are one document
    return once.groupBy("slot", "print").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("keeper"))


def build_shards(keys: DataFrame, keys_per_shard: int) -> tuple[DataFrame, int]:
    """(shard, arrays) with about ``keys_per_shard`` keys each, and the number of shards."""
    n_shards = max(1, -(-keys.count() // keys_per_shard))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        shard = Shard.build(*(pdf[c].to_numpy(np.int64) for c in ("slot", "print", "docs", "keeper")))
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "arrays": [shard.pack()]})

    dealt = keys.withColumn("shard", F.pmod(F.col("slot"), F.lit(n_shards)).cast("int"))
    return dealt.groupBy("shard").applyInPandas(build, "shard int, arrays binary"), n_shards


def _digest(text, doc, drop) -> tuple[int, int, str, bytes]:
    """n_lines, n_dropped, sha256 and bytes of the kept lines; drop: numbers of lines to leave out."""
    lines = (text or "").encode("utf-8", "surrogatepass").split(b"\n")
    kept = [x for i, x in enumerate(lines) if i not in drop] if drop else lines
    joined = b"\n".join(kept)
    return len(lines), len(lines) - len(kept), hashlib.sha256(joined).hexdigest(), joined


_OUT = "doc_id long, n_lines long, n_dropped long, kept_sha256 string"


def _finish(pdf: pd.DataFrame, drops: list[set], with_text: bool) -> pd.DataFrame:
    found = [_digest(t, d, x) for t, d, x in zip(pdf["text"], pdf["doc_id"], drops)]
    out = pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy(np.int64), "n_lines": [x[0] for x in found], "n_dropped": [x[1] for x in found],
                        "kept_sha256": [x[2] for x in found]})
    if with_text:
        out["kept_text"] = [x[3].decode("utf-8", "surrogatepass") for x in found]
    return out


def _candidates(pdf: pd.DataFrame, min_length: int):
    """Of a batch's long lines: position of the document in the batch, line number, slot hash, fingerprint."""
    at, number, slots, prints = [], [], [], []
    for i, text in enumerate(pdf["text"]):
        for k, line in enumerate((text or "").encode("utf-8", "surrogatepass").split(b"\n")):
            if h := _hashes(line, min_length):
                at.append(i)
                number.append(k)
                slots.append(h[0])
                prints.append(h[1])
    return at, number, np.array(slots, np.int64), np.array(prints, np.int64)


def line_dedup(docs: DataFrame, min_length: int = 40, min_docs: int = 5, keys_per_shard: int = 1 << 18, broadcast_bytes: int = 64 << 20,
               salts: int = 32, with_text: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, kept_sha256 (and kept_text).

    Lines end at \\n; a null or empty text has one empty line. Keys of at least ``min_length`` code points found in at
    least ``min_docs`` distinct doc_ids (null is one of them) lose their lines except in the largest doc_id that holds
    them, where repeats stay too; rows that repeat that doc_id keep them as well. A key found only without doc_id
    keeps its lines. Other columns of ``docs`` are not read. An empty table gives an empty result.
    """
    doc_id = F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID))
    rows = with_row_id(docs.select(doc_id.alias("doc_id"), F.col(text_col).alias("text")))
    keys = cut(count_lines(rows, min_length).filter(F.col("docs") >= min_docs), "line-keys")
    shards, n_shards = build_shards(keys, keys_per_shard)
    shards = cut(shards, "line-shards")
    size = shards.agg(F.coalesce(F.sum(F.length("arrays")), F.lit(0))).first()[0]
    if size <= broadcast_bytes:
        out = _probe_broadcast(rows, shards, n_shards, min_length, with_text)
    else:
        out = _probe_routed(rows, shards, n_shards, min_length, with_text, salts)
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(_NO_ID)))


def _schema(with_text: bool) -> str:
    return _OUT + (", kept_text string" if with_text else "")


def _probe_broadcast(rows, shards, n_shards, min_length, with_text) -> DataFrame:
    """The arrays, whose size was checked, are sent to every executor."""
    sent = rows.sparkSession.sparkContext.broadcast({r["shard"]: bytes(r["arrays"]) for r in shards.collect()})

    def probe(batches):
        loaded = {k: Shard.unpack(v) for k, v in sent.value.items()}
        for pdf in batches:
            at, number, slots, prints = _candidates(pdf, min_length)
            known, keeper = np.zeros(len(slots), bool), np.zeros(len(slots), np.int64)
            shard_of = slots % n_shards
            for k, shard in loaded.items():
                mine = np.flatnonzero(shard_of == k)
                known[mine], keeper[mine] = shard.probe(slots[mine], prints[mine])
            ids, drops = pdf["doc_id"], [set() for _ in range(len(pdf))]
            for j in np.flatnonzero(known):
                if ids.iloc[at[j]] != keeper[j]:
                    drops[at[j]].add(number[j])
            yield _finish(pdf, drops, with_text)

    return rows.select("doc_id", "text").mapInPandas(probe, _schema(with_text))


def _probe_routed(rows, shards, n_shards, min_length, with_text, salts) -> DataFrame:
    """The documents' line hashes go to (shard, salt), where the shard's arrays stand first in order."""
    def emit(batches):
        for pdf in batches:
            at, number, slots, prints = _candidates(pdf, min_length)
            yield pd.DataFrame({"_row": pdf["_row"].to_numpy()[at], "doc_id": pdf["doc_id"].to_numpy()[at], "number": np.array(number, np.int64),
                                "slot": slots, "print": prints, "shard": (slots % n_shards).astype(np.int32)})

    probes = rows.mapInPandas(emit, "_row long, doc_id long, number long, slot long, print long, shard int")
    probes = probes.withColumns({"salt": F.pmod(F.xxhash64("_row"), F.lit(salts)).cast("int"), "arrays": F.lit(None).cast("binary")})
    arrays = shards.select("shard", "arrays", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    # zeros, not nulls, beside the arrays: pandas would turn the hashes into floats
    both = probes.unionByName(arrays.withColumns({c: F.lit(0).cast("long") for c in ("_row", "doc_id", "number", "slot", "print")}))
    both = both.repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("arrays").isNull())

    def probe(batches):
        loaded = {}
        for pdf in batches:
            for (k, _), part in pdf.groupby(["shard", "salt"], sort=False):
                head = part["arrays"].iloc[0]
                if head is not None:
                    loaded = {k: Shard.unpack(head)}
                part = part[part["arrays"].isna()]
                if k in loaded and len(part):
                    known, keeper = loaded[k].probe(part["slot"].to_numpy(np.int64), part["print"].to_numpy(np.int64))
                    yield part[["_row", "number"]][known & (keeper != part["doc_id"].to_numpy(np.int64))]

    hits = both.mapInPandas(probe, "_row long, number long")
    drops = hits.groupBy("_row").agg(F.collect_set("number").alias("drop"))  # at most a document's own lines
    joined = rows.join(drops, "_row", "left").select("doc_id", "text", "drop")

    def finish(batches):
        for pdf in batches:
            yield _finish(pdf, [set() if x is None else set(x) for x in pdf["drop"]], with_text)

    return joined.mapInPandas(finish, _schema(with_text))
