"""The position log: begin and commit rows of every destination topic (B7, B8), and what they publish.

The log is append-only Parquet.  A *begin* row carries `next`; the *commit* row that
closes it names, in one append, the new position, the folder that now holds the rows,
the folders it replaces, and the block's log metrics (Q1).  Readers resolve a
destination from commit rows only (`live`): a folder that no commit row names does not
exist for them, whatever lies on disk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators.positions import Position
from .logfiles import compact_log, exists, hadoop_path, read_log  # noqa: F401

POSITIONS_SCHEMA = ("topic string, last struct<pos:timestamp_ntz,id:bigint>, rows bigint, "
                    "next struct<pos:timestamp_ntz,id:bigint>, run timestamp_ntz, seq bigint, "
                    "processor string, state string, hostid string, block_id string, published string, "
                    "written bigint, max_id bigint, min_ts timestamp_ntz, max_ts timestamp_ntz, "
                    "nulls map<string,bigint>, root string, folders array<string>, removed array<string>, "
                    "keys string, edges array<struct<pos:timestamp_ntz,id:bigint>>, elapsed_ms bigint")
_FIELDS = ("topic last rows next run seq processor state hostid block_id published written max_id min_ts max_ts nulls "
           "root folders removed keys edges elapsed_ms").split()


class Live:
    """What a destination's commit rows publish: folders (with the key columns of their digest) and retention cutoffs."""

    def __init__(self, folders: dict[str, str | None], cutoffs: dict[str, str]):
        self.folders, self.cutoffs = folders, cutoffs


class PositionStore:
    """The current row of a topic has the largest `seq`.

    One writer per destination topic is a requirement (as in the reference), so the
    store remembers the newest row of the topics it has touched.  What a destination
    holds may be written by several topics and processes and is always read anew.
    """

    _cache: dict = {}   # path -> {topic: newest row}, shared by every store object of the process

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._known = PositionStore._cache.setdefault(path.rstrip("/"), {})

    @classmethod
    def forget(cls, path: str) -> None:
        """Drop what this process remembers about a store (as a new process would)."""
        cls._cache.get(path.rstrip("/"), {}).clear()

    def read(self) -> DataFrame:
        return read_log(self.spark, self.path, POSITIONS_SCHEMA)

    def compact(self, keep_s: int = 3600, min_files: int = 2) -> int:
        """Merge the log's part files, sorted by topic and `seq`, while writers go on; returns how many were merged."""
        return compact_log(self.spark, self.path, POSITIONS_SCHEMA, ["topic", "seq"], keep_s, min_files)

    def current(self, topic: str):
        if topic in self._known:
            return self._known[topic]
        rows = (self.read().filter(F.col("topic") == topic)
                .orderBy(F.col("seq").desc()).limit(1).collect())
        self._known[topic] = rows[0] if rows else None
        return self._known[topic]

    def append(self, topic: str, *, last: Position | None, nxt: Position | None = None, rows: int = 0,
               run=None, processor: str = "", state: str = "", hostid: str = "", block_id: str = "",
               published: str | None = None, seq: int | None = None, log: dict | None = None,
               root: str | None = None, folders: list[str] | None = None, removed: list[str] | None = None,
               keys: str | None = None, edges: list[Position] | None = None, elapsed_ms: int | None = None) -> None:
        """Append one row; a commit row may carry the block's log metrics (Q1) and publishes
        `folders` of `root` in place of `removed`."""
        if seq is None:
            cur = self.current(topic)
            seq = (cur["seq"] + 1) if cur else 0
        lg = log or {}
        pair = lambda p: (p.pos, p.id) if p else None
        row = (topic, pair(last), int(rows), pair(nxt), run, int(seq), processor, state, hostid, block_id, published,
               lg.get("rows"), lg.get("max_id"), lg.get("min_ts"), lg.get("max_ts"), lg.get("nulls"),
               root.rstrip("/") if root else None, folders, removed, keys,
               [pair(e) for e in edges] if edges else None, elapsed_ms)
        self.spark.createDataFrame([row], POSITIONS_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        d = dict(zip(_FIELDS, row))
        for k in ("last", "next"):
            d[k] = Row(pos=d[k][0], id=d[k][1]) if d[k] is not None else None
        self._known[topic] = Row(**d)

    def commits(self, root: str) -> DataFrame:
        """Commit rows of a destination."""
        return self.read().filter((F.col("root") == root.rstrip("/")) & F.col("next").isNull())

    def live(self, root: str) -> Live:
        """The folders that commit rows have added and none has removed, and the newest cutoff per column.

        Added minus removed does not depend on the order of rows: folder names are never
        used twice.  Only live folders reach the driver; compaction bounds their number.
        """
        if not exists(self.spark, self.path):
            return Live({}, {})
        name = lambda c, gone: F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.struct(
            F.lit("folder").alias("kind"), x.alias("name"), F.col("keys").alias("value"), F.lit(gone).alias("gone")))
        cutoff = F.when(F.col("processor") == "Retain", F.array(F.struct(
            F.lit("cutoff").alias("kind"), F.split("state", "=", 2)[0].alias("name"), F.split("state", "=", 2)[1].alias("value"),
            F.lit(False).alias("gone")))).otherwise(F.array())
        events = self.commits(root).select("run", "seq", F.explode(F.concat(
            name(F.col("folders"), False), name(F.col("removed"), True), cutoff)).alias("e")).select("run", "seq", "e.*")
        found = (events.groupBy("kind", "name").agg(F.max_by("value", F.struct("run", "seq")).alias("value"), F.bool_or("gone").alias("gone"))
                 .filter("not gone").collect())
        of = lambda kind: {r["name"]: r["value"] for r in found if r["kind"] == kind}
        return Live(of("folder"), of("cutoff"))

    def has_commit(self, root: str, block_id: str) -> bool:
        """Whether a block (a stream's micro-batch) is already committed."""
        return not self.commits(root).filter(F.col("block_id") == block_id).limit(1).isEmpty()

    def _loads(self) -> DataFrame:
        return self.read().filter("written is not null and processor != 'Compact'")

    def block_log(self) -> DataFrame:
        """Q1 log rows of committed blocks, read from the commit rows."""
        return (self._loads()
                .select("topic", F.col("run").alias("ts"), F.col("written").alias("rows"), "max_id", "min_ts",
                        "max_ts", F.coalesce("nulls", F.create_map().cast("map<string,bigint>")).alias("nulls"),
                        F.col("block_id").alias("run_id")))

    def runs(self) -> DataFrame:
        """Run metrics per committed block, for the rate report (Q4): read rows, written rows, duration."""
        return (self._loads()
                .select(F.col("block_id").alias("run_id"), F.col("run").alias("event_time"), F.col("elapsed_ms").alias("duration_ms"),
                        F.col("rows").alias("read_rows"), F.col("written").alias("written_rows")))

    def init(self, topic: str, last: Position | None, run=None) -> None:
        """Start a topic at `last` (None = before the first row)."""
        self.append(topic, last=last, run=run, processor="init", state="init")
