"""Token-ID output in training order.

Every text is tokenised and cut into sequences of a fixed number of 16-bit ids. A keyed Feistel permutation of 0..N-1
(a balanced network over the next power of four, walked again while it leads outside) gives each sequence a global
slot; no shuffle buffer and no random sort is needed, and anyone with the key can say where a sequence lies. The
sequences are dealt to shards of a fixed number of slots and written in slot order. Every record takes the same number of
bytes, so that record k of the order is found in shard k div S at byte (k mod S) times the stride: a reader can stop
and go on at any slot.

Spark's text writer does the writing: its commit protocol publishes a file only when its task has succeeded. A
record is the ids, low byte first, and a line feed that ends it.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from pathlib import Path

import numpy as np
import pandas as pd
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import work_dir
from .common import with_row_id

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Ends every text; the vocabulary leaves it free. Also fills up the last sequence of a text.
END_OF_TEXT = 50256
#: Fixed value: the published pre-token pattern of this vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_CUT = regex.compile(r"(?<=\S)(?=\s)")
_ROUNDS = 4
_KIND = "doc_id long, seq long, slot long, shard long, byte_offset long, n_tokens long, tokens_sha256 string"
_NO_ID = -(2**63)  # stands for a null doc_id in a record


def _two_bytes(ids: list[int]) -> bytes:
    out = array("H", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Tokenizer:
    """Ids of a text as bytes.

    Pre-tokens never reach over the begin of white space, so long texts are cut there and encoded piece by piece; a text or
    a run of white space that offers no such place is cut every ``most`` characters, which the ids' decoding doesn't show.
    """

    def __init__(self, source: str | bytes, piece: int = 1 << 18, most: int = 1 << 19):
        import tiktoken

        lines = (Path(source).read_bytes() if isinstance(source, str) else source).splitlines()
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.piece, self.most = piece, most

    def _pieces(self, text: str):
        at = 0
        while len(text) - at > self.most:
            found = _CUT.search(text, at + self.piece, at + self.most)
            to = found.start() if found else at + self.most
            yield text[at:to]
            at = to
        yield text[at:]

    def ids(self, text: str):
        """Lists of ids, one per piece."""
        return map(self.encoding.encode_ordinary, self._pieces(text))

    def count(self, text: str) -> int:
        return sum(map(len, self.ids(text)))

    def encode(self, text: str) -> bytes:
        return b"".join([_two_bytes(x) for x in self.ids(text)])

    def decode(self, ids) -> str:
        return self.encoding.decode_bytes([int(i) for i in ids]).decode("utf-8")


_loaded: dict[str | bytes, Tokenizer] = {}


def tokenizer(source: str | bytes) -> Tokenizer:
    """One per worker process, from the path or the contents of a vocabulary file."""
    if source not in _loaded:
        _loaded[source] = Tokenizer(source)
    return _loaded[source]


def vocabulary(spark, path: str) -> Broadcast:
    """The vocabulary file (a few MB), read on the driver and sent to the executors, which need no copy of their own."""
    if "://" in path:
        return spark.sparkContext.broadcast(bytes(spark.read.format("binaryFile").load(path).first()["content"]))
    return spark.sparkContext.broadcast(Path(path).read_bytes())


def half_bits(n: int) -> int:
    """Bits of each half of the network over the least power of four that holds n values."""
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def feistel(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """The permutation of 0..n-1 under ``key``, by cycle-walking."""
    half = half_bits(n)
    mask = np.uint64((1 << half) - 1)
    keys = [np.uint64(int.from_bytes(hashlib.sha256(f"{key}:{r}".encode()).digest()[:8], "little")) for r in range(_ROUNDS)]
    out, todo = np.asarray(x, np.uint64).copy(), np.arange(len(x))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in keys:
            f = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            f ^= f >> np.uint64(29)
            f *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f ^ (f >> np.uint64(32))) & mask)
        out[todo] = left << np.uint64(half) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def _sequences(ids: bytes, length: int) -> list[bytes]:
    """Cuts the ids and END_OF_TEXT into sequences; END_OF_TEXT fills up the last."""
    end = np.array([END_OF_TEXT], "<u2").tobytes()
    ids, width = ids + end, 2 * length
    ids += end * (-len(ids) % width // 2)
    return [ids[i:i + width] for i in range(0, len(ids), width)]


def count_tokens(rows: DataFrame, sent: Broadcast) -> DataFrame:
    """(_row, n) with n the text's ids, END_OF_TEXT included."""
    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        t = tokenizer(sent.value)
        return pd.Series([t.count(x or "") + 1 for x in texts], dtype="int64")

    return rows.select("_row", count("text").alias("n"))


def _starts(counts: DataFrame, length: int) -> tuple[dict[int, int], int]:
    """First sequence number of each scan partition, and the number of all; one row per partition reaches the driver."""
    part = F.shiftright("_row", 33).cast("int")
    sums = counts.groupBy(part.alias("part")).agg(F.sum(F.ceil(F.col("n") / length)).alias("k")).collect()
    starts, n = {}, 0
    for r in sorted(sums):
        starts[r["part"]] = n
        n += int(r["k"])
    return starts, n


def record_stride(length: int) -> int:
    """Bytes of a record: doc_id (8), number of the sequence in its text (4), the ids, a line feed."""
    return 12 + 2 * length + 1


def write_shards(docs: DataFrame, path: str, length: int = 256, per_shard: int = 1 << 14, key: int = 1, tokenizer_path: str = TOKENIZER,
                 id_col: str = "doc_id", text_col: str = "text") -> int:
    """Writes the sequences of ``docs`` in training order to ``path``/shard=K/ and returns their number."""
    spark = docs.sparkSession
    doc_id = F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID))
    rows = with_row_id(docs.select(doc_id.alias("doc_id"), F.col(text_col).alias("text")))
    words = vocabulary(spark, tokenizer_path)
    starts, total = _starts(count_tokens(rows, words), length)
    sent = spark.sparkContext.broadcast(starts)  # one number per scan partition

    def emit(batches):
        t, at = tokenizer(words.value), None
        for pdf in batches:
            if at is None and len(pdf):
                at = sent.value[int(pdf["_row"].iloc[0]) >> 33]
            slots, records, ids = [], [], pdf["doc_id"].tolist()
            for doc, text in zip(ids, pdf["text"]):
                head = doc.to_bytes(8, "little", signed=True)
                records += [head + i.to_bytes(4, "little") + s for i, s in enumerate(_sequences(t.encode(text or ""), length))]
            if records:
                slots = feistel(np.arange(at, at + len(records)), total, key)
                at += len(records)
                yield pd.DataFrame({"slot": slots, "record": records})

    sequences = rows.mapInPandas(emit, "slot long, record binary").withColumn("shard", F.expr(f"slot div {per_shard}"))
    # the slots are 0..total-1, so the bounds of the ranges are known: partition k gets those of shard k, and one task writes one shard
    ordered = sequences.repartitionById(max(1, -(-total // per_shard)), F.col("shard").cast("int")).sortWithinPartitions("shard", "slot")
    ordered.select(F.col("record").cast("string").alias("value"), "shard").write.partitionBy("shard").text(path)
    return total


def read_shards(spark, path: str, length: int = 256, per_shard: int = 1 << 14, with_ids: bool = True, from_slot: int = 0) -> DataFrame:
    """One row per record of the shards below ``path``: doc_id, seq, slot, shard, byte_offset, n_tokens, tokens_sha256, and ids if asked for.

    Reading goes on at ``from_slot``: the shards before its own aren't opened, and the records before it are skipped by the stride.
    """
    stride = record_stride(length)

    def parse(batches):
        for pdf in batches:
            for shard, blob in zip(pdf["shard"], pdf["content"]):
                skip = max(0, from_slot - shard * per_shard)
                table = np.frombuffer(blob, np.uint8).reshape(-1, stride)[skip:]
                if not len(table):
                    continue
                ids = np.ascontiguousarray(table[:, 12:12 + 2 * length]).view("<u2")
                used = np.where((ids == END_OF_TEXT).any(axis=1), (ids == END_OF_TEXT).argmax(axis=1) + 1, length)
                tokens = [x[:n].tobytes() for x, n in zip(ids, used)]
                found = pd.DataFrame({
                    "doc_id": np.ascontiguousarray(table[:, :8]).view("<i8").ravel(), "seq": np.ascontiguousarray(table[:, 8:12]).view("<u4").ravel().astype(np.int64),
                    "slot": shard * per_shard + skip + np.arange(len(table)), "shard": shard, "byte_offset": (skip + np.arange(len(table))) * stride,
                    "n_tokens": used.astype(np.int64), "tokens_sha256": [hashlib.sha256(t).hexdigest() for t in tokens]})
                yield found.assign(ids=tokens) if with_ids else found

    kind = _KIND + ", ids binary" * with_ids
    files = spark.read.format("binaryFile").load(path).filter(F.col("shard") >= from_slot // per_shard).select(F.col("shard").cast("long"), "content")
    return files.mapInPandas(parse, kind).withColumn("doc_id", F.nullif("doc_id", F.lit(_NO_ID)))


def training_order(docs: DataFrame, path: str | None = None, length: int = 256, per_shard: int = 1 << 14, key: int = 1,
                   tokenizer_path: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Writes the shards below ``path`` (a fresh shared folder by default) and returns what they hold, a row per sequence; its ids too if ``with_ids``.

    A null or empty text is one sequence of END_OF_TEXT only. Repeated rows are sequences of their own; a null doc_id
    stays null. Other columns of ``docs`` are not read. An empty table writes nothing and gives an empty result.
    ``docs`` must be a stored table: it is tokenised twice, to number the sequences and to write them, which takes
    less room than to keep the ids in between.
    """
    spark = docs.sparkSession
    path = path or work_dir(spark, "training-order")
    if not write_shards(docs, path, length, per_shard, key, tokenizer_path, id_col, text_col):
        return spark.createDataFrame([], _KIND + ", ids binary" * with_ids)
    return read_shards(spark, path, length, per_shard, with_ids)
