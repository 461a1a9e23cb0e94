"""Files: exchange format, Parquet store, bucketed tables."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from tallymark.sources import adapter, schemas, store, tsv

TEXTS = [None, "", "plain", "a\tb", "a\nb", "a\rb", "back\\slash", "\\N", "\\t", "\\\\n", "end\\", 'quo"te', "한글"]


def test_tsv_text_survives(spark, tmp_path):
    rows = [(i, i, f"event{i}", t, "S", t, None, dt.datetime(2024, 1, 1, 0, 0, 0, i)) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, schemas.schema("issuance_histories")).coalesce(1)
    path = str(tmp_path / "h")
    tsv.write_tsv(df, path, "issuance_histories")
    back = tsv.read_tsv(spark, path, "issuance_histories")
    assert back.schema == df.schema
    assert sorted(back.collect(), key=lambda r: r["id"]) == sorted(df.collect(), key=lambda r: r["id"])
    lines = "".join(open(f, newline="").read() for f in glob.glob(path + "/part-*")).split("\n")
    assert len(lines) == len(TEXTS) + 1
    assert lines[0].split("\t") == ["0", "0", "event0", "\\N", "S", "\\N", "\\N", "2024-01-01 00:00:00.000000"]
    assert lines[6].split("\t")[3] == "back\\\\slash"


def test_tsv_kinds(spark, tmp_path):
    when = dt.datetime(2024, 2, 29, 23, 59, 59, 999_999)
    members = spark.createDataFrame([(1, "VIP", bytearray(b"\x00\xff"), None, "h", None, None, when)], schemas.schema("members"))
    lines = tsv.to_lines(members, tsv.table_columns("members")).first()["value"]
    assert lines == "1\tVIP\t00ff\t\\N\th\t\\N\t\\N\t2024-02-29 23:59:59.999999"
    cells = [("active", "bool"), ("at", "dt"), ("start", "time")]
    df = spark.createDataFrame([(True, when, "07:00:00"), (False, None, None)], "active boolean, at timestamp_ntz, start string").coalesce(1)
    got = [r["value"] for r in tsv.to_lines(df, cells).collect()]
    assert got == ["1\t2024-02-29 23:59:59\t07:00:00", "0\t\\N\t\\N"]
    assert [tuple(r) for r in tsv.from_lines(tsv.to_lines(df, cells), cells).collect()] == [
        (True, when.replace(microsecond=0), "07:00:00"),
        (False, None, None),
    ]


def test_files_are_bounded_by_rows(spark, tmp_path):
    grades = spark.range(25).select(F.col("id").cast("string").alias("code"), F.lit(1).alias("bit_value")).coalesce(1)
    store.write_table(grades, str(tmp_path), "grades", rows_per_file=10)
    files = glob.glob(str(tmp_path / "grades" / "part-*.parquet"))
    assert len(files) == 3
    assert sum(spark.read.parquet(f).count() for f in files) == 25


def test_store_round_trip(spark, tmp_path):
    led = adapter.tidy_ledger(spark, "/root/testdata/sf0.001")
    names = ("issuances", "issuance_histories", "issuance_usages", "coupon_stocks")
    store.write_tables({n: getattr(led, n) for n in names}, str(tmp_path))
    for n in names:
        back = store.read_table(spark, str(tmp_path), n)
        assert back.schema == schemas.schema(n)
        assert back.exceptAll(store.conform(getattr(led, n), n)).isEmpty()
    counts = {r["table_name"]: r["row_count"] for r in store.row_counts({n: getattr(led, n) for n in names}).collect()}
    assert counts["issuances"] == 1_500


def test_every_table_has_keys():
    assert len(schemas.TABLES) == 17 == len(schemas.PRIMARY_KEYS)
    assert len(schemas.FOREIGN_KEYS) == 19
    for table, key in [*schemas.PRIMARY_KEYS.items(), *schemas.UNIQUE_KEYS, *schemas.UNIQUE_KEYS_CLEAN]:
        assert set(key) <= {c.name for c in schemas.TABLES[table]}


@pytest.mark.parametrize("table", ["members", "issuances", "grades"])
def test_schema_types(table):
    assert [f.name for f in schemas.schema(table)] == [c.name for c in schemas.TABLES[table]]
