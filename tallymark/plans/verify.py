"""Jobs: verify a ledger on storage, record the run."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.times import ntz
from tallymark.operators import audits, reconcile, rules
from tallymark.operators.ledger import Ledger
from tallymark.sources import store


@dataclass(frozen=True)
class Verdict:
    dataset: str
    passed: bool
    counts: dict[str, int]
    invariant_problems: dict[str, int]
    expected: int | None = None
    missing: int = 0
    false_positive: int = 0


def verdict(ledger: Ledger, as_of, dataset: str, findings: DataFrame, seed_run_id: int = 1) -> Verdict:
    """CLEAN passes with no finding, CORRUPT when exactly the expected keys are found.

    Either way every invariant must hold. Only counts reach the driver.
    """
    counts = {r["finding_type"]: r["finding_count"] for r in rules.finding_counts(findings).collect()}
    problems = {
        r["invariant"]: r["violations"]
        for r in audits.check_invariants(ledger, dataset).where("violations > 0").collect()
    }
    if dataset == "CLEAN":
        return Verdict(dataset, not problems and not any(counts.values()), counts, problems)
    if ledger.expected_findings is None:
        raise ValueError("a CORRUPT ledger is judged by its expected_findings")
    expected = ledger.expected_findings.where(F.col("seed_run_id") == seed_run_id)
    c = reconcile.comparison_counts(expected, findings).first()
    return Verdict(
        dataset, bool(c["passed"]) and not problems, counts, problems, c["expected"], c["missing"], c["false_positive"]
    )


def verify(
    spark: SparkSession,
    root: str,
    as_of: dt.datetime | str | None = None,
    dataset: str = "CLEAN",
    *,
    run_id: int,
    seed_run_id: int = 1,
    attempt: int = 1,
) -> Verdict:
    """Verify the ledger under ``root``: write findings, state and the run record.

    Findings are written once and read back for counting and comparing, so the
    rules run a single time and a lost executor costs no rerun.
    """
    optional = ["members", "verification_runs"] + (["coupon_stats"] if dataset == "CLEAN" else ["expected_findings"])
    ledger = store.read_ledger(spark, root, optional)
    if as_of is None:
        as_of = reconcile.default_as_of(ledger.verification_runs).first()["as_of"]
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if ledger.coupon_stats is not None:  # one statistics run is compared, not every repetition of it
        latest = reconcile.latest_stats_run(ledger.verification_runs).select(F.col("id").alias("run_id"))
        ledger.coupon_stats = ledger.coupon_stats.join(F.broadcast(latest), "run_id", "left_semi")  # one row
    _write_findings(rules.run_rules(ledger, as_of), root, run_id)
    findings = read_findings(spark, root, run_id)
    result = verdict(ledger, as_of, dataset, findings, seed_run_id)
    record = run_record(
        spark,
        run_id=run_id,
        as_of=as_of,
        dataset=dataset,
        # of the data: a CORRUPT ledger fails even when every planted fault was found
        verdict="FAIL" if any(result.counts.values()) or result.invariant_problems else "PASS",
        stats_status="SKIPPED",
        attempt=attempt,
        seed_run_id=seed_run_id if dataset == "CORRUPT" else None,
        finding_count=sum(result.counts.values()),
        checksum=reconcile.findings_checksum(findings, distinct=True),  # by their numbering
        fingerprint=reconcile.dataset_fingerprint(
            ledger.issuance_histories, ledger.issuances, ledger.coupon_stocks, as_of
        ),
        started=started,
        finished=dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
        origin="BATCH",
    )
    store.write_table(record, root, "verification_runs", mode="append")
    return result


def _write_findings(findings: DataFrame, root: str, run_id: int) -> None:
    numbered = reconcile.numbered_findings(findings, run_id)
    store.conform(numbered, "verification_findings").drop("run_id").write.mode("errorifexists").option(
        "maxRecordsPerFile", store.ROWS_PER_FILE
    ).parquet(f"{root}/verification_findings/run_id={run_id}")


def read_findings(spark: SparkSession, root: str, run_id: int) -> DataFrame:
    one = spark.read.parquet(f"{root}/verification_findings/run_id={run_id}")
    return one.withColumn("run_id", F.lit(run_id).cast("bigint"))


def run_record(
    spark: SparkSession,
    *,
    run_id: int,
    as_of,
    dataset: str,
    verdict: str,
    stats_status: str,
    finding_count: int,
    checksum: DataFrame,
    fingerprint: DataFrame,
    started,
    finished,
    origin: str,
    scope: str = "FULL",
    attempt: int = 1,
    seed_run_id: int | None = None,
) -> DataFrame:
    """One row of ``verification_runs``."""
    start = ntz(as_of) - F.make_dt_interval(days=F.lit(1)) if scope == "INCREMENTAL" else F.lit(None).cast("timestamp_ntz")
    return checksum.crossJoin(fingerprint).select(  # one row each
        F.lit(run_id).alias("id"),
        ntz(as_of).alias("as_of"),
        start.alias("from_ts"),
        F.lit(scope).alias("scope"),
        F.lit(dataset).alias("dataset"),
        F.lit(seed_run_id).cast("bigint").alias("seed_run_id"),
        F.lit(attempt).alias("attempt"),
        F.lit(verdict).alias("verdict"),
        F.lit(stats_status).alias("stats_status"),
        F.lit(finding_count).alias("finding_count"),
        "findings_checksum",
        "dataset_fingerprint",
        ntz(started).alias("started_at"),
        ntz(finished).alias("finished_at"),
        F.lit(origin).alias("origin"),
    )
