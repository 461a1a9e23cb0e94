"""A stored ledger: no finding on the clean one, exactly the planted ones on the corrupt one, and what is recorded."""

import pytest
from pyspark.sql import functions as F

from tallymark import contract as C
from tallymark.operators import audits, inject, reconcile, replay, rules, stats
from tallymark.plans import runs, verify
from tallymark.sources import adapter, schemas, store
from tallymark.streaming.incremental import incremental_findings, touched_issuances

AS_OF = adapter.TIDY_AS_OF
FREE = (230, None)
SLOTS = {1: C.SLOT_STOCK, 3: (100, 230), **{f: FREE for f in (2, 4, 5, 6, 7)}}


def stored(ledger, root):
    """The ledger's tables as files, columns in their declared types."""
    for name, df in ledger.tables().items():
        kinds = {c.name: schemas.KINDS[c.kind] for c in schemas.TABLES[name]}
        df.select(*[F.col(c).cast(kinds[c]).alias(c) for c in df.columns if c in kinds]).write.parquet(f"{root}/{name}")
    return root


@pytest.fixture(scope="module")
def tidy(spark):
    led = adapter.tidy_ledger(spark, "/root/testdata/sf0.001")
    people = led.members.select("id", F.sha2(F.col("id").cast("string"), 256).alias("email_hash"), F.lit("GOLD").alias("membership_grade"))
    funnel = stats.coupon_funnel(led.coupons, led.issuances, led.coupon_stocks)
    seeded = spark.createDataFrame([(1, "CLEAN", "FULL", 1, "COMPLETE", 0, "SEED")], "id long, dataset string, scope string, attempt int, stats_status string, finding_count int, origin string")
    run = seeded.select("*", F.lit(AS_OF).cast("timestamp_ntz").alias("as_of"), F.lit(AS_OF).cast("timestamp_ntz").alias("started_at"))
    return led.with_tables(members=people, coupon_stats=funnel.select(F.lit(1).cast("bigint").alias("run_id"), *funnel.columns), verification_runs=run)


@pytest.fixture(scope="module")
def clean(tidy, tmp_path_factory):
    return stored(tidy, str(tmp_path_factory.mktemp("clean")))


@pytest.fixture(scope="module")
def corrupt(tidy, tmp_path_factory):
    return stored(inject.inject(tidy, AS_OF, slots=SLOTS, plant_grade_fault=True), str(tmp_path_factory.mktemp("corrupt")))


def test_clean_has_no_findings(spark, clean):
    result = verify.verify(spark, clean, dataset="CLEAN", run_id=50)
    assert result.passed and not any(result.counts.values()) and not result.invariant_problems
    recorded = store.read_table(spark, clean, "verification_runs")
    record = recorded.where("id = 50").first()
    assert (record["verdict"], record["origin"], record["finding_count"]) == ("PASS", "BATCH", 0)
    assert reconcile.latest_verdict(recorded).first()["id"] == 50 and reconcile.latest_stats_run(recorded).first()["id"] == 1


def test_corrupt_gives_exactly_the_planted_findings(spark, corrupt, tmp_path):
    result = verify.verify(spark, corrupt, AS_OF, "CORRUPT", run_id=60)
    assert result.passed and (result.expected, result.missing, result.false_positive) == (801, 0, 0)
    assert result.counts == dict(zip(C.FINDING_TYPES, (200, 200, 100, 200, 100, 1)))
    record = store.read_table(spark, corrupt, "verification_runs").where("id = 60").first()
    assert record["verdict"] == "FAIL" and record["finding_count"] == 801
    findings = verify.read_findings(spark, corrupt, 60).orderBy("id").collect()
    keys = [(f["finding_type"], f["target_key"]) for f in findings]
    assert keys == sorted(keys) and [f["id"] for f in findings] == list(range(1, 802))
    led = store.read_ledger(spark, corrupt, ("members", "expected_findings"))
    committed = runs.verify_and_commit(spark, led, AS_OF, str(tmp_path), run_id=1, dataset="CORRUPT").first()
    assert (committed["stats_status"], committed["findings_checksum"]) == ("COMPLETE", record["findings_checksum"])


def test_planted_faults_fill_the_matrix_and_keep_common_constraints(spark, corrupt):
    expected = store.read_table(spark, corrupt, "expected_findings")
    assert reconcile.check_fault_matrix(expected).isEmpty()
    names = ("grades", "coupons", "members", "issuances", "issuance_histories", "issuance_usages", "coupon_stocks", "expected_findings")
    tables = {n: spark.read.parquet(f"{corrupt}/{n}") for n in names}
    broken = lambda dataset: {r[0] for r in audits.audit_tables(tables, dataset).where("violations IS NOT NULL").collect()}
    assert broken("CORRUPT") == set()
    assert broken("CLEAN") - {"check coupon_stocks stock range"} == {"unique issuances(coupon_id, member_id)", "unique issuances(code)"}


def test_incremental_equals_full_on_what_changed(spark, corrupt):
    led = store.read_ledger(spark, corrupt)
    start = "1998-06-01 00:00:00"
    got = {(r[0], r[1]) for r in incremental_findings(led, start, AS_OF).select("finding_type", "target_key").collect()}
    ids = touched_issuances(led, start, AS_OF)
    coupons = led.issuances.join(ids.withColumnRenamed("issuance_id", "id"), "id").select("coupon_id").distinct()
    full = rules.run_rules(led, AS_OF)
    h = led.issuance_histories.select(F.col("id").alias("history_id"), "issuance_id")
    parts = (
        full.where(F.col("finding_type").isin("STOCK_MISMATCH", "DUP_PER_MEMBER")).join(coupons.withColumnRenamed("coupon_id", "campaign_id"), "campaign_id", "left_semi"),
        full.where("history_id IS NOT NULL").join(h, "history_id").join(ids, "issuance_id", "left_semi"),
        full.where("finding_type IN ('REPLAY_MISMATCH', 'USAGE_MISMATCH', 'GRADE_VIOLATION')").join(ids.withColumnRenamed("issuance_id", "coupon_id"), "coupon_id", "left_semi"),
    )
    want = {(r[0], r[1]) for part in parts for r in part.select("finding_type", "target_key").collect()}
    assert got == want and want


def test_faults_need_room(tidy):
    with pytest.raises(ValueError, match="too small"):
        inject.inject(tidy, AS_OF, slots=SLOTS | {3: (100, 120)})


def test_replay_matches_stored_status(spark, clean):
    led = store.read_ledger(spark, clean)
    state = replay.replay_state(led.issuance_histories, AS_OF)
    both = led.issuances.join(state.withColumnRenamed("issuance_id", "id"), "id")
    assert both.count() == led.issuances.count() and both.where("status <> state").isEmpty()
