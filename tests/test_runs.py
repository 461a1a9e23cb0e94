"""Committed runs, clustered slices, damaged files, members by any key, exact member choice."""

import pytest
from pyspark.sql import functions as F

from tallymark.operators import inject, pii, replay, rules
from tallymark.plans import runs
from tallymark.plans.registry import AS_OF, KEYS
from tallymark.sources import adapter, store, tsv
from tests.test_sweep import ledger, rows  # noqa: F401


def test_half_written_run_is_invisible_and_a_repeat_replaces_it(spark, ledger, tmp_path, monkeypatch):  # noqa: F811
    root = str(tmp_path)
    first = runs.verify_and_commit(spark, ledger, "1995-01-01 00:00:00", root, run_id=1).first()
    other = runs.verify_and_commit(spark, ledger, AS_OF, root, run_id=2).first()
    assert first["finding_count"] == runs.findings(spark, root).where("run_id = 1").count() != other["finding_count"]
    kept = rows(runs.findings(spark, root).where("run_id = 2"))

    def stop(*_):
        raise KeyboardInterrupt

    for step in ("write_record", "commit"):
        with monkeypatch.context() as patch:
            patch.setattr(runs, step, stop)
            for run_id in (1, 3):
                with pytest.raises(KeyboardInterrupt):
                    runs.verify_and_commit(spark, ledger, AS_OF, root, run_id=run_id)
        # neither the new run nor the one being replaced shows a part; the others are whole
        assert {r["run_id"] for r in runs.findings(spark, root).select("run_id").distinct().collect()} == {2}
        assert rows(runs.findings(spark, root)) == kept
    again = runs.verify_and_commit(spark, ledger, AS_OF, root, run_id=1).first()
    assert again["finding_count"] == other["finding_count"] and again["findings_checksum"] == other["findings_checksum"]
    assert sorted(r["id"] for r in runs.records(spark, root).collect()) == [1, 2]
    assert runs.findings(spark, root).where("run_id = 1").count() == again["finding_count"]


def test_run_without_findings_replaces_one_with(spark, ledger, tmp_path):  # noqa: F811
    root = str(tmp_path)
    runs.verify_and_commit(spark, ledger, AS_OF, root, run_id=5)
    tidy = adapter.tidy_ledger(spark, "/root/testdata/sf0.001")
    record = runs.verify_and_commit(spark, tidy, adapter.TIDY_AS_OF, root, run_id=5).first()
    assert record["finding_count"] == 0 and runs.findings(spark, root).count() == 0
    assert record["verdict"] == "FAIL"  # no members and statistics: invariants that nothing is known of do not hold


def test_slice_of_clustered_files_reads_a_fraction(spark, tmp_path):
    path = str(tmp_path / "clustered")
    events = adapter.histories(spark, "/root/testdata/sf0.1").repartition(4)
    store.write_clustered(events, path, "issuance_id", group_bytes=64 << 10)
    whole = spark.read.parquet(path)
    low, high = 50_000, 50_500
    cut = replay.key_range(whole, low, high)
    found = cut.collect()
    read = cut._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()
    total = whole.count()
    assert len(found) <= read < total / 5
    alone = rows(replay.replay_state(cut, AS_OF))
    assert alone == rows(replay.key_range(replay.replay_state(whole, AS_OF), low, high)) and alone


COLUMNS = [("id", "long"), ("name", "str"), ("seen", "dt6"), ("good", "bool"), ("blob", "bin")]


def test_damaged_lines_are_kept_apart(spark, tmp_path):
    path = str(tmp_path / "shards")
    rows_ = [(i, None if i == 1 else f"a\t{i}\\", None, i % 2 == 0, bytearray([i])) for i in range(10)]
    df = spark.createDataFrame(rows_, "id long, name string, seen timestamp_ntz, good boolean, blob binary").coalesce(1)
    tsv.write_shards(df, path, COLUMNS, rows_per_file=4)
    assert len([p for p in (tmp_path / "shards").iterdir() if p.suffix == ".txt"]) == 3
    bad = ["x\tn\t\\N\t1\t00", "1\tn\tnever\t1\t00", "2\tn\t\\N\tyes\t00", "3\tn\t\\N\t1\tzz", "4\tn", "", "5\tn\t\\N\t1\t00\t"]
    spark.createDataFrame([(b,) for b in bad], "value string").coalesce(1).write.mode("append").text(path)
    good, lost = tsv.read_shards(spark, path, COLUMNS)
    assert sorted(map(tuple, good.collect())) == sorted(rows_)
    told = {r["value"]: r["reason"] for r in lost.collect()}
    assert told == dict(zip(bad, ["id is no long", "seen is no dt6", "good is no bool", "blob is no bin", *["not 5 cells"] * 3]))
    assert lost.select("file").distinct().count() == 1


def test_members_met_by_both_keys_come_once(spark):
    people = spark.createDataFrame([(i, f"n{i}", f"m{i}@x.org", f"0{i}") for i in range(6)], "id long, name string, email string, phone string")
    stored = pii.protect(people, KEYS)
    ids = spark.createDataFrame([(1,), (2,), (99,), (None,)], "id long")
    emails = spark.createDataFrame([("M2@X.org",), ("m4@x.org",), (None,)], "e string")
    found = pii.find_members(stored, KEYS, ids, emails)
    assert found.columns == stored.columns
    assert [(r["id"], r["email"]) for r in pii.show_page(found, KEYS).collect()] == [(i, f"m{i}@x.org") for i in (1, 2, 4)]
    assert pii.find_members(stored, KEYS).isEmpty()


def test_the_last_free_member_is_found(spark):
    members = spark.createDataFrame([(i * 7,) for i in range(40)], "id long")
    held = [(1, i * 7) for i in range(40) if i != 23] + [(2, 0), (2, 0), (2, 14), (3, 7 * 39)]
    led = adapter.tidy_ledger(spark, "/root/testdata/sf0.001").with_tables(members=members, issuances=spark.createDataFrame(held, "coupon_id long, member_id long"))
    asked = [(5, 100, 1)] + [(5, 200 + i, 2) for i in range(30)] + [(8, 200, 2)] + [(5, 300 + i, 3) for i in range(39)]
    clones = spark.createDataFrame(asked, "fault int, id long, coupon_id long")
    got = {(r["fault"], r["id"]): (r["coupon_id"], r["new_member"]) for r in inject._new_members(led, clones, 3).collect()}
    assert got[5, 100] == (1, 23 * 7)
    assert len(got) == len(asked) and len(set(got.values())) == len(asked) and not set(got.values()) & set(held)
    none_left = spark.createDataFrame([(5, 100, 1), (5, 101, 1)], "fault int, id long, coupon_id long")
    assert inject._new_members(led, none_left, 3).count() == 1  # the second finds none; inject raises then
