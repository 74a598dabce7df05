"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_dir

#: Characters that separate words in every contract: blank and 0x09 to 0x0D.
SPACES = " \t\n\x0b\x0c\r"


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def read_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def with_row_id(df: DataFrame, name: str = "_row") -> DataFrame:
    """Adds a 64-bit id per input row, so that repeated rows and null or repeated doc_ids stay apart.

    The id is the row's place in its scan partition: it is the same in every job over the same stored table.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def whole_rows(docs: DataFrame) -> DataFrame:
    """(_row, _doc) with each row of ``docs`` as one struct, so that its column names can't clash with others."""
    return with_row_id(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")))


def content_key(*columns: Column) -> Column:
    """64-bit hash of the columns' values; a null differs from all values."""
    return F.xxhash64(*[x for c in columns for x in (c.isNull(), c)])


def drawn_key(rows: DataFrame, name: str = "_draw") -> DataFrame:
    """Turns the content key ``_key`` of rows with ``_row`` into a key of their own, ``name``, which doesn't depend on where they lie.

    Rows with one content are numbered, and it doesn't matter which gets which number. The numbers start anew in each scan partition,
    behind those of the partitions before it, so that a content that a third of all rows have is numbered in many tasks.
    """
    rows = rows.withColumn("_part", F.shiftright("_row", 33))
    per_part = rows.groupBy("_key", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.withColumn("_start", F.sum("_n").over(before)).filter("_start is not null").drop("_n")
    numbered = rows.withColumn("_no", F.row_number().over(Window.partitionBy("_key", "_part").orderBy("_row")))
    numbered = numbered.join(starts, ["_key", "_part"], "left")
    return numbered.withColumn(name, F.xxhash64("_key", F.col("_no") + F.coalesce("_start", F.lit(0)))).drop("_key", "_part", "_no", "_start")


def cut(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Writes ``df`` to a fresh folder below spark.checkpoint.dir and reads it back, which cuts its lineage."""
    path = work_dir(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")
