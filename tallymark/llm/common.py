"""Helpers the operators share: staged tables, bounded broadcasts, word arrays, window hashes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table is broadcast only when it was counted and has no more rows than this.
BROADCAST_ROWS = 50_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; a session on one machine may do without the setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tallymark-"))
    return context.getCheckpointDir().rstrip("/")


def staged(df: DataFrame) -> DataFrame:
    """Written once to the shared folder and read from there: survives lost executors, is computed once.

    The files go with `released`, or else when the session ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = where
    return out


def released(*staged_tables: DataFrame) -> None:
    """Deletes staged tables that nothing will read again, and lets Spark's cleaner remove the shuffles written for them."""
    for df in staged_tables:
        context = df.sparkSession.sparkContext
        df.staged_path.getFileSystem(context._jsc.hadoopConfiguration()).delete(df.staged_path, True)
    context._jvm.System.gc()


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A staged table, marked for broadcast if it has at most so many rows, else left to a shuffled join."""
    kept = staged(df)
    return F.broadcast(kept) if kept.count() <= rows else kept


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def space_words(text: Column) -> Column:
    """Runs of characters other than space and U+0009 to U+000D, as an array."""
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def ascii_lower(text: Column) -> Column:
    """Only A-Z become lower case. lower() does the same, and faster, where every character is ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def window_hashes(words: Column, width: int = 3) -> Column:
    """64-bit hash of every run of `width` words, in order. `words` must be a stored column."""
    return F.when(
        F.size(words) >= width,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - width),
            lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
