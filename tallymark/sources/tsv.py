"""Tab-separated exchange files: \\N for NULL, backslash escapes, hex binary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.text import NULL_MARK, escape_tsv, unescape_tsv
from tallymark.functions.times import micros_text, seconds_text
from tallymark.sources import schemas
from tallymark.sources.store import ROWS_PER_FILE


def format_value(value: Column, kind: str) -> Column:
    text = {
        "bool": lambda c: F.when(c, "1").when(~c, "0"),
        "bin": lambda c: F.lower(F.hex(c)),
        "dt6": micros_text,
        "dt": seconds_text,
        "str": escape_tsv,
    }.get(kind, lambda c: c.cast("string"))(value)
    return F.coalesce(text, F.lit(NULL_MARK))


def parse_value(text: Column, kind: str) -> Column:
    present = F.when(text != NULL_MARK, text)
    if kind == "str":
        return unescape_tsv(present)
    if kind == "bin":
        return F.unhex(present)
    if kind == "bool":
        return present == "1"
    return present.cast(schemas.KINDS[kind])


def to_lines(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """One string column ``value``; ``columns`` are (name, kind) in file order."""
    return df.select(F.concat_ws("\t", *[format_value(F.col(n), k) for n, k in columns]).alias("value"))


def from_lines(lines: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    cells = lines.select(F.split("value", "\t", -1).alias("c"))
    return cells.select(*[parse_value(F.get("c", F.lit(i)), k).alias(n) for i, (n, k) in enumerate(columns)])


def table_columns(table: str) -> list[tuple[str, str]]:
    return [(c.name, c.kind) for c in schemas.TABLES[table]]


def read_tsv(spark: SparkSession, path: str, table: str) -> DataFrame:
    # only \n ends a record; a raw carriage return is always escaped
    return from_lines(spark.read.option("lineSep", "\n").text(path), table_columns(table))


def write_tsv(df: DataFrame, path: str, table: str, mode: str = "errorifexists", rows_per_file: int = ROWS_PER_FILE) -> None:
    to_lines(df, table_columns(table)).write.mode(mode).option("maxRecordsPerFile", rows_per_file).text(path)


def checked(lines: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    """The parsed columns, and ``reason``: NULL, or what makes the line unreadable (the columns are NULL then).

    A value that is not the NULL mark and cannot be read as its kind is named; nothing raises.
    """
    cells = lines.select("*", F.split("value", "\t", -1).alias("_cells"))

    def cell(i: int) -> Column:
        return F.get("_cells", F.lit(i))

    def read(i: int, kind: str) -> Column:
        if kind in ("str", "bin"):
            return parse_value(cell(i), kind)
        present = F.when(cell(i) != NULL_MARK, cell(i))
        if kind == "bool":
            return F.when(present == "1", True).when(present == "0", False)
        return present.try_cast(schemas.KINDS[kind])

    wrong = [F.when((cell(i) != NULL_MARK) & read(i, kind).isNull(), F.lit(f"{name} is no {kind}")) for i, (name, kind) in enumerate(columns)]
    reason = F.when(F.size("_cells") != len(columns), F.lit(f"not {len(columns)} cells")).otherwise(F.coalesce(*wrong))
    told = cells.withColumn("reason", reason)
    fine = F.col("reason").isNull()
    return told.select(*lines.columns, *[F.when(fine, read(i, kind)).alias(name) for i, (name, kind) in enumerate(columns)], "reason")


def write_shards(df: DataFrame, path: str, columns: list[tuple[str, str]], rows_per_file: int = ROWS_PER_FILE, mode: str = "errorifexists") -> None:
    """Files of at most so many lines."""
    to_lines(df, columns).write.mode(mode).option("maxRecordsPerFile", rows_per_file).text(path)


def read_shards(spark: SparkSession, path: str, columns: list[tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """What the files hold: the rows, and (file, value, reason) of lines that are none."""
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"))
    told = checked(lines, columns)
    return told.where("reason IS NULL").select(*[n for n, _ in columns]), told.where("reason IS NOT NULL").select("file", "value", "reason")
