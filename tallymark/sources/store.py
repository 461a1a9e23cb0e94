"""Reading and writing whole ledgers as Parquet; reading one over JDBC."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallymark.operators.ledger import Ledger
from tallymark.sources import schemas

ROWS_PER_FILE = 500_000
LEDGER_TABLES = tuple(Ledger.__dataclass_fields__)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns in declared order and type."""
    return df.select(
        *[F.col(c.name).cast(schemas.KINDS[c.kind]).alias(c.name) for c in schemas.TABLES[table]]
    )


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.schema(schemas.schema(table)).parquet(f"{root}/{table}")


def write_table(df: DataFrame, root: str, table: str, mode: str = "errorifexists", rows_per_file: int = ROWS_PER_FILE) -> None:
    conform(df, table).write.mode(mode).option("maxRecordsPerFile", rows_per_file).parquet(f"{root}/{table}")


def write_tables(tables: Mapping[str, DataFrame], root: str, mode: str = "errorifexists") -> None:
    for name, df in tables.items():
        write_table(df, root, name, mode)


def write_counted(
    tables: Mapping[str, DataFrame], root: str, also: Mapping[str, Mapping[str, Column]] | None = None, mode: str = "errorifexists"
) -> dict[str, dict[str, int]]:
    """Write each table in files of bounded size; its rows, and other aggregates asked for, are counted by the write itself."""
    found = {}
    for name, df in tables.items():
        seen = Observation(f"write {name}")
        wanted = {"rows": F.count(F.lit(1)), **(also or {}).get(name, {})}
        observed = df.observe(seen, *[c.alias(n) for n, c in wanted.items()])
        observed.write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE).parquet(f"{root}/{name}")
        found[name] = {n: v or 0 for n, v in seen.get.items()}
    return found


def read_tables(spark: SparkSession, root: str, names: Iterable[str] = tuple(schemas.TABLES)) -> dict[str, DataFrame]:
    return {name: read_table(spark, root, name) for name in names}


def read_ledger(spark: SparkSession, root: str, optional: Iterable[str] = ()) -> Ledger:
    base = ("coupons", "grades", "coupon_stocks", "issuances", "issuance_histories", "issuance_usages")
    return Ledger(**read_tables(spark, root, (*base, *optional)))


def write_bucketed(df: DataFrame, name: str, table: str, buckets: int) -> None:
    """Save histories, usages or issuances clustered by issuance.

    Replay, chain and usage counts over tables bucketed alike need no shuffle.
    """
    key = "id" if table == "issuances" else "issuance_id"
    conform(df, table).write.bucketBy(buckets, key).sortBy(key).mode("errorifexists").saveAsTable(name)


def write_clustered(df: DataFrame, path: str, key: str, group_bytes: int = 8 << 20, mode: str = "errorifexists") -> None:
    """Files that hold ranges of ``key``, each sorted by it in row groups of about ``group_bytes``.

    The groups' statistics then leave all but a slice of a key range unread.
    """
    ranges = df.repartitionByRange(key).sortWithinPartitions(key)
    ranges.write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE).option("parquet.block.size", group_bytes).parquet(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    lower: int,
    upper: int,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A ledger table from a database, read in parallel ranges of its key.

    The bounds only place the ranges; rows outside them are read as well.
    """
    key = schemas.PRIMARY_KEYS[table][0]
    kinds = {c.name: c.kind for c in schemas.TABLES[table]}
    options = {"preferTimestampNTZ": "true", **(properties or {})}
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if kinds[key] in ("long", "int", "byte"):
        reader = reader.options(
            partitionColumn=key, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(partitions)
        )
    return conform(reader.load(), table)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table_name, row_count for each table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    out = counted[0]
    for one in counted[1:]:
        out = out.unionByName(one)
    return out


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; only a local session without one gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir().rstrip("/")


def staged(df: DataFrame, name: str = "staged") -> DataFrame:
    """Written once to the shared folder and read from there; the files go when the session ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder the cluster names.

    Only a local session without such a folder gets one of its own.
    """
    context = df.sparkSession.sparkContext
    folder = shared_folder(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint()
