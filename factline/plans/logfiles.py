"""Append-only Parquet logs of small files, and their compaction without a gap for readers.

Writers append part files to the log's folder and never look at anything else.  A
compaction writes all rows to a folder of its own below `_merged`, sorted, and then
publishes it with one manifest file that names the part files it covers.  Readers take
the newest manifest: its folder, and every part file that it does not cover.  A part
file that a writer adds meanwhile is covered by no manifest and so is read; a compaction
that dies before its manifest leaves a folder that nobody reads.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def hadoop_path(spark: SparkSession, path: str):
    """(Path, FileSystem) of any shared store."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = hadoop_path(spark, path)
    return fs.exists(p)


def _read_text(spark: SparkSession, path: str) -> str:
    p, fs = hadoop_path(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """The file appears whole or not at all."""
    half, fs = hadoop_path(spark, path + ".half")
    stream = fs.create(half, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if not fs.rename(half, hadoop_path(spark, path)[0]):
        raise OSError(f"could not publish {path}")


def _manifests(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """(number, milliseconds of publication) of the manifests, oldest first."""
    p, fs = hadoop_path(spark, f"{path.rstrip('/')}/_merged")
    if not fs.exists(p):
        return []
    names = [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(p) if s.isFile()]
    return sorted((int(n.removesuffix(".files")), t) for n, t in names if n.endswith(".files"))


def _manifest(spark: SparkSession, path: str, number: int) -> tuple[str, list[str]]:
    """(merged folder, names of the covered part files)."""
    folder, *covered = _read_text(spark, f"{path.rstrip('/')}/_merged/{number}.files").split("\n")
    return folder, covered


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows of a log, each once; an empty frame where nothing was written."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    parts, made = spark.read.schema(schema).parquet(path), _manifests(spark, path)
    if not made:
        return parts
    folder, covered = _manifest(spark, path, made[-1][0])
    merged = spark.read.schema(schema).parquet(f"{path.rstrip('/')}/_merged/{folder}")
    # a filter on file names is applied to the listing, so covered files are not opened
    return merged.unionByName(parts.filter(~F.col("_metadata.file_name").isin(covered)) if covered else parts)


def compact_log(spark: SparkSession, path: str, schema: str, order: list[str], keep_s: int = 3600, min_files: int = 2) -> int:
    """Merge the part files of a log into one folder sorted by `order`; returns how many files were merged.

    Nothing is dropped.  Part files that a manifest has covered for `keep_s` seconds, and
    the merged folders replaced that long ago, are deleted (readers that resolved an older
    manifest have that long).  One compaction per log at a time is a requirement, writers
    need not pause.
    """
    base = path.rstrip("/")
    if not exists(spark, base):
        return 0
    made = _manifests(spark, base)
    before, covered = _manifest(spark, base, made[-1][0]) if made else (None, [])
    p, fs = hadoop_path(spark, base)
    names = sorted(n for n in (s.getPath().getName() for s in fs.listStatus(p) if s.isFile()) if not n.startswith(("_", ".")))
    new = [n for n in names if n not in set(covered)]
    if len(new) >= min_files:
        rows = spark.read.schema(schema).parquet(*[f"{base}/{n}" for n in new])
        if before is not None:
            rows = rows.unionByName(spark.read.schema(schema).parquet(f"{base}/_merged/{before}"))
        number = made[-1][0] + 1 if made else 0
        folder = f"{number}-{uuid.uuid4().hex[:12]}"
        rows.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(f"{base}/_merged/{folder}")
        _write_text(spark, f"{base}/_merged/{number}.files", "\n".join([folder, *names]))
    _drop_covered(spark, base, keep_s)
    return len(new) if len(new) >= min_files else 0


def _drop_covered(spark: SparkSession, base: str, keep_s: int) -> None:
    made, until = _manifests(spark, base), 1000 * (time.time() - keep_s)
    for (number, _), later in zip(made, made[1:] + [None]):
        if later is not None and later[1] <= until:   # replaced long enough ago: folder, then manifest
            folder, _ = _manifest(spark, base, number)
            _delete(spark, f"{base}/_merged/{folder}")
            _delete(spark, f"{base}/_merged/{number}.files")
    old = [number for number, t in made if t <= until]
    if old:
        for name in _manifest(spark, base, old[-1])[1]:
            _delete(spark, f"{base}/{name}")


def _delete(spark: SparkSession, path: str) -> None:
    p, fs = hadoop_path(spark, path)
    fs.delete(p, True)
