"""Substring dedup by Rabin-Karp hashes of every fixed-length window of words.

A word is a 64-bit digit (a hash of it, in two independent versions), a window the polynomial of its digits modulo 2^64.
Polynomials of twice the length come from two neighbours, so a window of any length takes a few vector operations. Windows
are counted in two rounds, both grouped by Spark on the hash:

1. Short hashes of all windows: each block of documents sends every hash once, packed as differences of sorted numbers, to
   the bucket of its highest bits. The bucket answers with a bit per hash: whether another block has it, too.
2. The windows so marked send both whole hashes (64 and 40 bits) and the smallest doc_id that holds them in their block; the answer
   tells whether a smaller doc_id holds the window elsewhere. Windows that share a short hash only by chance part here.

A window that is repeated within its block alone is decided there. Repeated windows that overlap or touch merge into maximal
intervals of removed words. Blocks lie in a bucketed table and are not shuffled again; a window that a third of all documents
hold is sent once per block. Work per bucket is bounded: their number grows with the text.
"""

from __future__ import annotations

import hashlib
from array import array

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop_table, shuffle_partitions
from .suffix import NO_ID, write_blocks

#: Odd multipliers of the two polynomials.
_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_VOCABULARY = 1_000_000
#: Windows that a bucket gets on average.
_BUCKET = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the hashes over all 64 bits, one to one."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _Digits(dict):
    """Word -> place of its two 64-bit digits."""

    def __init__(self):
        super().__init__()
        self.first, self.second = array("Q"), array("Q")

    def __missing__(self, word):
        h = xxhash.xxh3_128_intdigest(word)
        self.first.append(h & 0xFFFFFFFFFFFFFFFF)
        self.second.append(h >> 64)
        at = self[word] = len(self.first) - 1
        return at


def rolling(digits: np.ndarray, width: int, base: int) -> np.ndarray:
    """Polynomials of all ``width`` digits in a row, from those of half the length."""
    n = len(digits) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power = lambda e: np.uint64(pow(base, e, 1 << 64))
    out, done, part, length = None, 0, digits, 1
    left = width
    while left:
        if left & 1:
            # the parts are read from the shortest to the longest, each after those already read
            here = part[done:done + n]
            out = here.copy() if out is None else out * power(length) + here
            done += length
        left >>= 1
        if left:
            part, length = part[:-length] * power(length) + part[length:], 2 * length
    return out


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned numbers as byte planes of their differences, compressed."""
    steps = np.diff(values, prepend=np.uint64(0))
    planes = max(1, (int(steps.max()).bit_length() + 7) // 8)
    low = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :planes]
    return bytes([planes]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(low.T).tobytes())


def unpack_sorted(blob: bytes) -> np.ndarray:
    planes = blob[0]
    low = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), np.uint8).reshape(planes, -1)
    steps = np.zeros((low.shape[1], 8), np.uint8)
    steps[:, :planes] = low.T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def pack_entries(keys: np.ndarray, second: np.ndarray, docs: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """(keys, low 40 bits of the second hash, doc ids as places in a table of them)."""
    ids, at = np.unique(docs, return_inverse=True)
    width = 2 if len(ids) <= 1 << 16 else 4
    places = np.ascontiguousarray(at.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].T)
    table = len(ids).to_bytes(4, "little") + ids.astype("<i8").tobytes() + places.tobytes()
    return pack_sorted(keys), np.ascontiguousarray(second.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes(), zstandard.ZstdCompressor(level=1).compress(table)


def unpack_entries(keys: bytes, second: bytes, docs: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    k = unpack_sorted(keys)
    s = np.zeros((len(k), 8), np.uint8)
    s[:, :5] = np.frombuffer(second, np.uint8).reshape(-1, 5)
    table = zstandard.ZstdDecompressor().decompress(docs)
    n = int.from_bytes(table[:4], "little")
    ids = np.frombuffer(table[4:4 + 8 * n], "<i8")
    places = np.frombuffer(table[4 + 8 * n:], np.uint8).reshape(-1, len(k))
    at = np.zeros((len(k), 4), np.uint8)
    at[:, :len(places)] = places.T
    return k, s.view("<u8").ravel(), ids[at.view("<u4").ravel()]


class Block:
    """The windows of a block of documents, in the order of their first hash."""

    def __init__(self, texts: list[bytes], ids: np.ndarray, width: int, words: _Digits, bits: int):
        split = [t.split() for t in texts]
        self.words, self.ids, self.width, self.bits = split, ids, width, bits
        self.lengths = np.fromiter(map(len, split), np.int64, len(split))
        self.ends = np.cumsum(self.lengths)
        self.total = int(self.lengths.sum())
        at = np.empty(self.total, np.int64)
        for ws, end, n in zip(split, self.ends.tolist(), self.lengths.tolist()):
            at[end - n:end] = np.fromiter(map(words.__getitem__, ws), np.int64, n)
        # windows that begin in the last words of a document would reach into the next one
        inside = np.ones(self.total, bool)
        for end, n in zip(self.ends.tolist(), self.lengths.tolist()):
            inside[end - min(n, width - 1):end] = False
        starts = np.flatnonzero(inside)
        digits = [np.frombuffer(x, np.uint64)[at] if len(at) else np.zeros(0, np.uint64) for x in (words.first, words.second)]
        first = mix(rolling(digits[0], width, _BASES[0])[starts]) if len(starts) else np.zeros(0, np.uint64)
        second = rolling(digits[1], width, _BASES[1])[starts] & np.uint64((1 << 40) - 1) if len(starts) else np.zeros(0, np.uint64)
        order = np.argsort(first, kind="stable")
        if len(order) and (np.diff(second[order])[np.diff(first[order]) == 0] != 0).any():
            order = np.lexsort((second, first))  # two different windows share a first hash
        self.starts, self.first, self.second = starts[order], first[order], second[order]
        self.doc = np.searchsorted(self.ends, self.starts, side="right")
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(self.first) != 0) | (np.diff(self.second) != 0)
        #: place of each window among the distinct ones, and of those the first window
        self.of, self.heads = np.cumsum(new) - 1, np.flatnonzero(new)
        self.least = np.minimum.reduceat(ids[self.doc], self.heads) if len(order) else np.zeros(0, np.int64)

    def short(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct short hashes, and the place of each distinct window's among them."""
        s = self.first[self.heads] >> np.uint64(64 - self.bits)
        new = np.ones(len(s), bool)
        new[1:] = np.diff(s) != 0
        return s[new], np.cumsum(new) - 1

    def marked(self, answers: dict[int, bytes], buckets: int) -> np.ndarray:
        """Places among the distinct windows of those whose short hash another block has, too."""
        s, of = self.short()
        return np.flatnonzero(_read(answers, _bucket(s, self.bits, buckets))[of])

    def gone(self, marked: np.ndarray, answers: dict[int, bytes], buckets: int) -> np.ndarray:
        """Whether each word is removed."""
        smaller = np.zeros(len(self.heads), bool)
        keys = self.first[self.heads[marked]]
        smaller[marked] = _read(answers, _bucket(keys, 64, buckets))
        repeated = smaller[self.of] | (self.least[self.of] < self.ids[self.doc])
        edge = np.zeros(self.total + 1, np.int32)
        np.add.at(edge, self.starts[repeated], 1)
        np.add.at(edge, self.starts[repeated] + self.width, -1)
        return np.cumsum(edge[:-1]) > 0


def _bucket(values: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Bucket of each of the ascending values by its highest bits; at most 2^31 buckets."""
    top = values >> np.uint64(bits - 32) if bits > 32 else values << np.uint64(32 - bits)
    return ((top * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _slices(bucket: np.ndarray):
    """(bucket, begin, end) of the runs in an ascending array."""
    if len(bucket):
        at = np.flatnonzero(np.diff(bucket, prepend=bucket[0] - 1))
        yield from zip(bucket[at].tolist(), at.tolist(), [*at[1:].tolist(), len(bucket)])


def _read(answers: dict[int, bytes], bucket: np.ndarray) -> np.ndarray:
    """The answers' bits, in the order in which the values were sent; a bucket that didn't answer says no."""
    out = np.zeros(len(bucket), bool)
    for b, lo, hi in _slices(bucket):
        if b in answers:
            out[lo:hi] = np.unpackbits(np.frombuffer(answers[b], np.uint8), count=hi - lo)
    return out


def _answer(pdf: pd.DataFrame, sizes: list[int], yes: np.ndarray, round_no: int) -> pd.DataFrame:
    """One row per message whose hashes have a yes among them."""
    out, lo = [], 0
    for bucket, block, n in zip(pdf["bucket"].tolist(), pdf["block"].tolist(), sizes):
        bits = yes[lo:lo + n]
        if bits.any():
            out.append((block, round_no, bucket, np.packbits(bits).tobytes(), int(bits.sum())))
        lo += n
    return pd.DataFrame(out, columns=["block", "round", "bucket", "answer", "n"])


_ANSWER = "block long, round int, bucket int, answer binary, n long"


def shared_hashes(pdf: pd.DataFrame) -> pd.DataFrame:
    """Round 1, one bucket: which hashes came from more than one block."""
    parts = [unpack_sorted(b) for b in pdf["payload"]]
    values = np.concatenate(parts)
    order = np.argsort(values, kind="stable")
    same = np.diff(values[order]) == 0
    yes = np.zeros(len(values), bool)
    yes[order[1:][same]] = True
    yes[order[:-1][same]] = True
    return _answer(pdf, list(map(len, parts)), yes, 1)


def smaller_elsewhere(pdf: pd.DataFrame) -> pd.DataFrame:
    """Round 2, one bucket: which windows also start in a document with a doc_id smaller than the smallest of their block."""
    parts = [unpack_entries(k, s, d) for k, s, d in zip(pdf["payload"], pdf["second"], pdf["docs"])]
    keys, second, docs = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((docs, second, keys))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(keys[order]) != 0) | (np.diff(second[order]) != 0)
    least = docs[order][new][np.cumsum(new) - 1]
    yes = np.zeros(len(order), bool)
    yes[order] = least < docs[order]
    return _answer(pdf, [len(p[0]) for p in parts], yes, 2)


def window_dedup(docs: DataFrame, width: int = 13, block_bytes: int = 8 << 20, bits: int | None = None, with_text: bool = False,
                 partitions: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, spans (removed [begin, end) in words), and kept text if asked.

    Words are split at white space and taken unchanged. Every word covered by ``width`` words in a row that also start in a document with a
    smaller doc_id is removed; windows are those of the input. A null, empty or blank text has no words; texts of
    fewer words than ``width`` keep all. A null doc_id counts as the largest; rows that repeat a doc_id don't remove each other's words. Other
    columns of ``docs`` are not read. An empty table gives an empty result. Texts of any length are read whole: a block
    holds one document at least. ``bits`` (of the first round's hash) changes the work, not the result: it follows the amount of text, so that about one
    window in a hundred is marked by chance.
    """
    spark = docs.sparkSession
    table = write_blocks(docs, block_bytes, partitions or shuffle_partitions(spark), id_col, text_col)
    try:
        return _dedup(spark.table(table), width, block_bytes, bits, with_text)
    finally:
        drop_table(spark, table)


def _dedup(blocks: DataFrame, width: int, block_bytes: int, bits: int | None, with_text: bool) -> DataFrame:
    about = blocks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0] // 4  # windows, rather too many
    bits = bits or min(64, max(32, about.bit_length() + 6))
    buckets = max(16, about // _BUCKET)

    def loaded(batches):
        words = _Digits()
        for pdf in batches:
            for block, ids, lengths, blob, found in zip(pdf["block"].tolist(), pdf["ids"], pdf["lengths"], pdf["data"], pdf["found"]):
                rounds: dict[int, dict[int, bytes]] = {1: {}, 2: {}}
                for x in found if found is not None else ():
                    rounds[x["round"]][x["bucket"]] = x["answer"]
                data, ends = zstandard.ZstdDecompressor().decompress(blob) if blob else b"", np.cumsum(np.frombuffer(lengths, np.int64)).tolist()
                texts = [data[a:b] for a, b in zip([0, *ends], ends)]
                if len(words) > _VOCABULARY:
                    words = _Digits()
                yield block, Block(texts, np.frombuffer(ids, np.int64), width, words, bits), rounds

    def with_answers(answers: DataFrame | None) -> DataFrame:
        if answers is None:
            return blocks.withColumn("found", F.lit(None).cast("array<struct<round:int,bucket:int,answer:binary>>"))
        found = answers.groupBy("block").agg(F.collect_list(F.struct("round", "bucket", "answer")).alias("found"))  # one per round and bucket
        return blocks.join(found, "block", "left")

    def send_short(batches):
        for block, b, _ in loaded(batches):
            s = b.short()[0]
            rows = [(k, block, pack_sorted(s[lo:hi])) for k, lo, hi in _slices(_bucket(s, bits, buckets))]
            yield pd.DataFrame(rows, columns=["bucket", "block", "payload"])

    sent = with_answers(None).mapInPandas(send_short, "bucket int, block long, payload binary")
    marks = cut(sent.groupBy("bucket").applyInPandas(shared_hashes, _ANSWER), "windows-marks")
    entries = max(16, (marks.agg(F.sum("n")).first()[0] or 0) // _BUCKET)

    def send_entries(batches):
        for block, b, rounds in loaded(batches):
            at = b.marked(rounds[1], buckets)
            keys, second, least = b.first[b.heads[at]], b.second[b.heads[at]], b.least[at]
            rows = [(k, block, *pack_entries(keys[lo:hi], second[lo:hi], least[lo:hi])) for k, lo, hi in _slices(_bucket(keys, 64, entries))]
            yield pd.DataFrame(rows, columns=["bucket", "block", "payload", "second", "docs"])

    sent = with_answers(marks).mapInPandas(send_entries, "bucket int, block long, payload binary, second binary, docs binary")
    answers = cut(sent.groupBy("bucket").applyInPandas(smaller_elsewhere, _ANSWER), "windows-answers")

    def finish(batches):
        for _, b, rounds in loaded(batches):
            gone = b.gone(b.marked(rounds[1], buckets), rounds[2], entries)
            out = []
            for doc, ws, end in zip(b.ids.tolist(), b.words, b.ends.tolist()):
                g = gone[end - len(ws):end]
                flips = np.flatnonzero(np.diff(np.concatenate([[0], g.view(np.int8), [0]])))
                kept = b" ".join([w for w, x in zip(ws, g.tolist()) if not x] if len(flips) else ws)
                out.append((doc, len(ws), int(g.sum()), hashlib.sha256(kept).hexdigest(),
                            [{"begin": int(x), "end": int(y)} for x, y in zip(flips[::2], flips[1::2])],
                            kept.decode("utf-8", "surrogatepass") if with_text else None))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_sha256", "spans", "kept_text"])

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<begin:long,end:long>>, kept_text string"
    result = cut(with_answers(marks.unionByName(answers)).mapInPandas(finish, schema), "windows-result")
    result = result.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))
    return result if with_text else result.drop("kept_text")
