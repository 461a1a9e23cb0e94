"""What bounds a task: the number of tasks follows from counted rows, and keys that hardly repeat are not combined first."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tallymark.operators import audits, reconcile, rules, skew
from tallymark.sources import adapter
from tests.test_plans import plan

SF = "/root/testdata/sf0.001"
AS_OF = adapter.AS_OF


@pytest.fixture
def tasks_of_a_hundred(monkeypatch):
    monkeypatch.setattr(skew, "TASK_ROWS", 100)


def rows(df):
    return sorted(map(str, df.collect()))


def dealt_to(df):
    """Numbers of tasks of shuffles whose number is fixed."""
    first = plan(df).split("== Final Plan ==")[-1]
    return [int(n) for n in re.findall(r"hashpartitioning\([^\n]*?, (\d+)\), REPARTITION_BY_NUM", first)]


def test_rules_are_dealt_to_more_tasks_as_the_history_grows(spark, monkeypatch):
    led = adapter.ledger(spark, SF)
    few = rules.run_rules(led, AS_OF)
    want = rows(few)
    monkeypatch.setattr(skew, "TASK_ROWS", 100)
    many = rules.run_rules(led, AS_OF)
    n = led.history_rows()
    assert n == led.issuance_histories.count() and dealt_to(many).count(-(-n // 100)) == 2  # the sweep and its findings
    assert len(dealt_to(many)) == 5  # and pairs of coupon with member and code, and duplicates
    assert rows(many) == want


def test_two_instants_and_checksum_are_dealt_by_rows(spark, tasks_of_a_hundred):
    led = adapter.ledger(spark, SF)
    n = -(-led.history_rows() // 100)
    both = reconcile.compare_instants(rules.rules_at(led, ["1998-01-01 00:00:00", AS_OF], rules.TIMED), led.history_rows())
    assert dealt_to(both).count(n) == 3
    assert n in dealt_to(reconcile.findings_checksum(rules.run_rules(led, AS_OF), led.history_rows()))


def test_invariants_and_audits_read_lines_dealt_by_rows(spark, tasks_of_a_hundred):
    n = -(-adapter.table(spark, SF, "lineitem").count() // 100)
    led = adapter.ledger(spark, SF, stored=False)
    assert n in dealt_to(audits.check_invariants(led, "CLEAN"))
    assert n in dealt_to(audits.audit_tables(led.tables(), "CLEAN"))


def test_rules_of_a_run_read_lines_once(spark):
    led = adapter.ledger(spark, SF)
    assert not {f for t in (led.issuance_histories, led.issuance_usages) for f in t.inputFiles() if "lineitem" in f}


@pytest.mark.parametrize("flags", [("A", "R"), ("N", "A"), ("", "A", None), (None, None), ("AB", "B"), ("Z", "R"), ("é", "A")])
def test_flags_of_repeated_lines(spark, tmp_path, flags):
    """The largest flag and status of a line's copies decide, as text by bytes."""
    t = dt.datetime(1997, 1, 1)
    kind = adapter.SCHEMAS["lineitem"]
    data = [(1, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, f, f and f.replace("A", "F"), t) for f in flags]
    spark.createDataFrame(data, kind).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = adapter.lines(spark, str(tmp_path)).first()
    known = [f for f in flags if f is not None]
    flag = max(known, key=lambda f: f.encode()) if known else None
    status = max((f.replace("A", "F") for f in known), key=lambda f: f.encode()) if known else None
    assert got["flag"] == (flag if flag in ("A", "R", None) else "other")
    assert got["line_status"] == (status if status in ("F", None) else "other")


def test_hot_lines_are_combined_first(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 40)
    t = dt.datetime(1997, 1, 1)
    data = [(i if i % 3 else 0, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "A", "F", t) for i in range(600)]
    spark.createDataFrame(data, adapter.SCHEMAS["lineitem"]).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = adapter.lines(spark, str(tmp_path))
    assert not dealt_to(found) and found.count() == 401


def test_numbers_are_those_of_the_whole_order(spark, tasks_of_a_hundred):
    kind = "finding_type string, target_key string, expected string, actual string, campaign_id long, member_id long, coupon_id long, history_id long"
    data = [(f"T{i % 3}", f"K:{i % 700}", "x", str(i), i, None, None, None) for i in range(2_000)]
    df = spark.createDataFrame(data, kind).repartition(7)
    got = reconcile.numbered_findings(df, 5, 2_000)
    text = plan(got)
    assert "ExistingRDD" not in text and "NestedLoop" not in text  # written and read once, no search for a row's range
    keys = sorted({(r[0], r[1]) for r in data})
    found = sorted(got.select("id", "finding_type", "target_key", "campaign_id", "run_id").collect())
    smallest = {k: min((r[3], r[4]) for r in data if r[:2] == k)[1] for k in keys}
    assert [tuple(r) for r in found] == [(i + 1, *k, smallest[k], 5) for i, k in enumerate(keys)]
    assert reconcile.numbered_findings(df.limit(0), 5).count() == 0


def test_checksum_of_findings_told_apart_already(spark):
    df = spark.range(500).select(F.lit("T").alias("finding_type"), F.concat(F.lit("K:"), "id").alias("target_key"))
    assert reconcile.findings_checksum(df, distinct=True).first() == reconcile.findings_checksum(df.union(df)).first()
