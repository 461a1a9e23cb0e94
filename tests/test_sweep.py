"""The one-pass sweep, several instants, stored state, the combined audit and counted writes."""

import pytest
from pyspark.sql import functions as F

from tallymark.operators import audits, reconcile, replay, rules, stats, sweep
from tallymark.plans.registry import EARLIER, WINDOW
from tallymark.sources import adapter, store
from tallymark.streaming import incremental
from tests.test_plans import exchanges, plan

SF = "/root/testdata/sf0.001"
AS_OF = adapter.AS_OF


@pytest.fixture(scope="module")
def ledger(spark, tmp_path_factory):
    """The untidy ledger as stored tables."""
    root = str(tmp_path_factory.mktemp("untidy"))
    led = adapter.ledger(spark, SF)
    names = ("coupons", "coupon_stocks", "issuances", "issuance_histories", "issuance_usages")
    for name in names:
        getattr(led, name).write.parquet(f"{root}/{name}")
    return led.with_tables(**{name: spark.read.parquet(f"{root}/{name}") for name in names})


def rows(df):
    return sorted(map(str, df.collect()))


def test_all_rules_shuffle_the_history_once(ledger):
    df = rules.run_rules(ledger, AS_OF)
    text = plan(df).split("== Physical Plan ==")[1].split("\n\n\n")[0]
    assert text.count("Window (") == 2  # the sweep, and repeated codes
    assert exchanges(df) <= 6


def test_sweep_equals_the_rules_one_by_one(ledger):
    digest = replay.digest(ledger.issuance_histories, AS_OF, ledger.issuances, ledger.issuance_usages)
    apart = rules.state_findings(ledger.coupon_stocks, digest).unionByName(
        rules.illegal_transition(replay.chain(ledger.issuance_histories, AS_OF))
    )
    swept = rules.run_rules(ledger, AS_OF, rules.TIMED)
    assert rows(swept.select(apart.columns)) == rows(apart)


def test_instants_side_by_side_equal_runs_of_their_own(ledger):
    instants = [EARLIER, AS_OF, "1992-03-01 00:00:00"]
    both = rules.rules_at(ledger, instants).cache()
    for j, t in enumerate(instants):
        alone = rules.run_rules(ledger, t)
        assert rows(both.where(F.col("instant") == j).select(alone.columns)) == rows(alone)
    two = rules.rules_at(ledger, instants[:2], rules.TIMED)
    assert exchanges(two) <= 3
    assert rows(reconcile.compare_instants(two)) == rows(reconcile.compare_sets(rules.run_rules(ledger, EARLIER), rules.run_rules(ledger, AS_OF)))
    with pytest.raises(ValueError):
        sweep.state_and_chain(ledger.issuance_histories, ledger.issuance_usages, ledger.issuances, ledger.coupon_stocks, [])


def test_incremental_reads_no_event_before_its_window(spark, ledger, tmp_path):
    state = incremental.state_at(ledger, WINDOW)
    incremental.save(state, str(tmp_path))
    state = incremental.load(spark, str(tmp_path), WINDOW)
    found = incremental.incremental_findings(ledger, WINDOW, AS_OF, state)
    scans = [part for part in plan(found).split("\n\n") if "Scan parquet" in part and "event_type" in part and "created_at" in part]
    assert scans and all("GreaterThan(created_at,1998-12-01T00:00)" in part for part in scans)
    ids = {r[0] for r in incremental.touched_issuances(ledger, WINDOW, AS_OF).collect()}
    full = rules.run_rules(ledger, AS_OF).where("finding_type <> 'STOCK_MISMATCH' AND finding_type <> 'DUP_PER_MEMBER'")
    # in the untidy ledger a history's number is its issuance's times a hundred and more
    owner = F.when(F.col("history_id").isNotNull(), F.floor(F.col("history_id") / 100)).otherwise(F.col("coupon_id"))
    of_touched = full.where(owner.isin(*ids))
    got = found.where("finding_type <> 'STOCK_MISMATCH' AND finding_type <> 'DUP_PER_MEMBER'")
    assert ids and rows(got) == rows(of_touched)


def test_state_advanced_equals_state_replayed(ledger):
    first = incremental.state_at(ledger, EARLIER)
    later = incremental.advanced(ledger, incremental.advanced(ledger, first, WINDOW), AS_OF)
    whole = incremental.state_at(ledger, AS_OF)
    for name in ("issuances", "coupons", "chains"):
        assert rows(getattr(later, name)) == rows(getattr(whole, name)), name
    with pytest.raises(ValueError):
        incremental.incremental_findings(ledger, WINDOW, AS_OF, first)


def test_audit_scans_each_table_once_and_names_what_it_cannot_check(spark):
    tables = {
        "members": spark.createDataFrame([(1, "GOLD", "a"), (2, "NONE", "a"), (2, None, None)], "id long, membership_grade string, email_hash string"),
        "grades": spark.createDataFrame([("GOLD", 4), ("A GRADE TOO LONG", 1)], "code string, bit_value int"),
    }
    found = audits.audit_tables(tables, "CORRUPT")
    assert exchanges(found) == 1
    got = {(r[0], r[1]): r[2] for r in found.where("violations IS NOT NULL").collect()}
    assert got == {
        ("unique members(id)", "2"): 2,
        ("unique members(email_hash)", "a"): 2,
        ("fk members.membership_grade -> grades.code", "NONE"): 1,
        ("not null members.membership_grade", None): 1,
        ("length grades.code", None): 1,
    }
    missing = {r[0]: r[1] for r in found.where("violations IS NULL").collect()}
    assert missing["not null members.created_at"] == "column members.created_at is absent"
    assert missing["unique issuances(id)"] == "table issuances is absent"
    assert "unique issuances(code)" not in missing  # for CLEAN only


def test_invariants_without_a_table_are_unknown(ledger):
    whole = {r[0]: r[1] for r in audits.check_invariants(ledger, "CLEAN").collect()}
    assert len(whole) == 8 and all(v is not None for v in whole.values())
    part = {r[0]: r[1] for r in audits.check_invariants(ledger.with_tables(members=None, coupon_stats=None), "CLEAN").collect()}
    assert {k for k, v in part.items() if v is None} == {"duplicate email_hash", *audits.FUNNEL}
    assert {k: v for k, v in part.items() if v is not None} == {k: whole[k] for k in whole if part[k] is not None}


def test_writes_count_their_own_rows(spark, ledger, tmp_path):
    seen = store.write_counted(
        {"issuances": ledger.issuances, "grades": ledger.grades.limit(0)}, str(tmp_path), {"issuances": {"used": F.count_if(F.col("status") == "USED")}}
    )
    assert seen["issuances"] == {"rows": ledger.issuances.count(), "used": ledger.issuances.where("status = 'USED'").count()}
    assert seen["grades"]["rows"] == 0 and spark.read.parquet(f"{tmp_path}/issuances").count() == seen["issuances"]["rows"]
    tables = {n: getattr(ledger, n) for n in ("issuances", "coupon_stocks", "coupon_stats")}
    measures = {r[0]: r[1] for r in stats.run_summary(tables, str(tmp_path / "all")).collect()}
    want = {r[0]: r[1] for r in stats.status_summary(ledger.issuances, ledger.coupon_stocks).collect()}
    assert {k: v for k, v in measures.items() if not k.startswith("rows")} == want
