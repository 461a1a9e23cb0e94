"""Edge cases of replay and rules on hand-made ledgers."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from tallymark.operators import audits, reconcile, replay, rules, stats
from tallymark.operators.ledger import Ledger
from tallymark.sources import adapter

AS_OF = "2024-01-10 00:00:00"


def at(text):
    return dt.datetime.fromisoformat(f"2024-01-{text}" if len(text) > 2 else f"2024-01-{text} 00:00:00")


H = "id bigint, issuance_id bigint, event_type string, from_status string, to_status string, created_at timestamp_ntz"
U = "id bigint, issuance_id bigint, used_at timestamp_ntz, canceled_at timestamp_ntz"
I = "id bigint, coupon_id bigint, member_id bigint, code string, issued_grade string, status string, issued_at timestamp_ntz, expires_at timestamp_ntz, updated_at timestamp_ntz"


class Build:
    """A tiny ledger; each method adds one row."""

    def __init__(self, spark):
        self.spark, self.h, self.u, self.i = spark, [], [], []
        self.coupons, self.stocks = {1: 15, 2: 12}, {1: (100, 0), 2: (100, 0)}

    def issuance(self, id, status="ISSUED", coupon=1, member=None, code=None, grade="GOLD"):
        self.i.append((id, coupon, member or id, code or f"C{id}", grade, status, at("01"), at("20"), at("01")))
        return self

    def event(self, issuance, event, before, after, when, id=None):
        self.h.append((id or len(self.h) + 1, issuance, event, before, after, at(when)))
        return self

    def usage(self, issuance, start, end=None):
        self.u.append((len(self.u) + 1, issuance, at(start), at(end) if end else None))
        return self

    def ledger(self):
        s = self.spark
        return Ledger(
            coupons=s.createDataFrame(
                [(c, m, at("01"), at("02")) for c, m in self.coupons.items()],
                "id bigint, eligible_grades_mask int, open_at timestamp_ntz, close_at timestamp_ntz",
            ),
            grades=s.createDataFrame([("WELCOME", 1), ("SILVER", 2), ("GOLD", 4), ("VIP", 8)], "code string, bit_value int"),
            coupon_stocks=s.createDataFrame(
                [(c, *v) for c, v in self.stocks.items()], "coupon_id bigint, total_quantity int, active_count int"
            ),
            issuances=s.createDataFrame(self.i, I),
            issuance_histories=s.createDataFrame(self.h, H),
            issuance_usages=s.createDataFrame(self.u, U),
        )

    def found(self, *only):
        df = rules.run_rules(self.ledger(), AS_OF, only or rules.C.FINDING_TYPES)
        return {(r["finding_type"], r["target_key"]) for r in df.collect()}


@pytest.fixture
def build(spark):
    return Build(spark)


def issue(b, id, **kw):
    return b.issuance(id, **kw).event(id, "ISSUE", None, "ISSUED", "01")


def test_equal_times_are_ordered_by_id(build):
    build.event(1, "USE", "ISSUED", "USED", "02", id=8).event(1, "ISSUE", None, "ISSUED", "02", id=7)
    build.event(2, "USE", "ISSUED", "USED", "02", id=10).event(2, "CANCEL_USE", "USED", "ISSUED", "02", id=11)
    got = {r["issuance_id"]: (r["state"], r["last_history_id"]) for r in replay.replay_state(build.ledger().issuance_histories, AS_OF).collect()}
    assert got == {1: ("USED", 8), 2: ("ISSUED", 11)}


def test_as_of_is_inclusive_to_the_microsecond(build):
    build.event(1, "ISSUE", None, "ISSUED", "10").event(2, "ISSUE", None, "ISSUED", "10 00:00:00.000001")
    assert [r["issuance_id"] for r in replay.replay_state(build.ledger().issuance_histories, AS_OF).collect()] == [1]


def test_chain_rules(build):
    V4 = "ILLEGAL_TRANSITION"
    build.event(1, "ISSUE", None, "ISSUED", "01", id=1)  # legal start
    build.event(2, "USE", "ISSUED", "USED", "01", id=2)  # no ISSUE before
    for i, (e, a, b) in enumerate([("ISSUE", None, "ISSUED"), ("USE", "ISSUED", "USED"), ("CANCEL_USE", "USED", "ISSUED"), ("CANCEL_USE", "USED", "ISSUED")]):
        build.event(3, e, a, b, f"0{i + 1}", id=10 + i)  # second CANCEL_USE breaks the chain
    for i, (e, a, b) in enumerate([("ISSUE", None, "ISSUED"), ("EXPIRE", "ISSUED", "EXPIRED"), ("USE", "EXPIRED", "USED")]):
        build.event(4, e, a, b, f"0{i + 1}", id=20 + i)  # chain holds, step is illegal
    assert build.found(V4) == {(V4, "HISTORY:2"), (V4, "HISTORY:13"), (V4, "HISTORY:22")}


def test_orphan_history_is_an_invariant_not_a_chain_fault(build):
    issue(build, 1).event(99, "ISSUE", None, "ISSUED", "01")
    assert build.found("ILLEGAL_TRANSITION") == set()
    led = build.ledger()
    assert audits.orphans("o", led.issuance_histories, led.issuances).first()["violations"] == 1


def test_usage_interval_and_counts(build):
    V5 = "USAGE_MISMATCH"
    for id in (1, 2, 3, 4, 5, 6):
        issue(build, id)
    build.usage(1, "02", "10")  # cancelled exactly at as-of: inactive
    build.usage(2, "02", "11")  # cancelled later: active
    build.usage(3, "02")  # never cancelled: active
    build.usage(4, "10")  # starts at as-of: active
    build.usage(5, "11")  # starts later: inactive
    for id in (7, 8):
        issue(build, id, status="USED").event(id, "USE", "ISSUED", "USED", "02")
    build.usage(8, "02").usage(8, "03")  # 7 has none, 8 two
    assert build.found(V5) == {(V5, f"ISSUANCE:{i}") for i in (2, 3, 4, 7, 8)}


def test_duplicates(build):
    V2 = "DUP_PER_MEMBER"
    issue(build, 1, member=5)
    issue(build, 2, member=5, code="C1")  # same member and same code: one finding
    issue(build, 3, member=6, code="X")
    issue(build, 4, member=7, code="X", coupon=2)  # same code in another coupon
    issue(build, 5, member=8, code="X")  # same code again: the later row
    assert build.found(V2) == {(V2, "COUPON:1|MEMBER:5"), (V2, "COUPON:1|MEMBER:8")}
    df = rules.run_rules(build.ledger(), AS_OF, [V2])
    assert df.count() == 2
    assert audits.duplicate_code(build.ledger().issuances).first()["violations"] == 2


def test_issuance_without_history_is_not_replayed(build):
    build.issuance(1, status="USED")
    assert build.found("REPLAY_MISMATCH", "USAGE_MISMATCH") == set()
    build.stocks[1] = (100, 1)
    assert build.found("STOCK_MISMATCH") == {("STOCK_MISMATCH", "COUPON:1")}


def test_coupon_without_stock_row_is_not_reported(build):
    issue(build, 1)
    del build.stocks[1]
    assert build.found("STOCK_MISMATCH") == set()


def test_grade_rule_uses_the_snapshot(build):
    V6 = "GRADE_VIOLATION"
    issue(build, 1, grade="WELCOME")
    issue(build, 2, coupon=2, grade="WELCOME")
    issue(build, 3, coupon=2, grade="VIP")
    assert build.found(V6) == {(V6, "ISSUANCE:2")}


def test_texts(build):
    issue(build, 1, status="USED")
    row = rules.run_rules(build.ledger(), AS_OF, ["REPLAY_MISMATCH"]).first()
    assert (row["expected"], row["actual"]) == ("replay=ISSUED", "issuances.status=USED")
    one = rules.replay_mismatch(replay.digest(build.ledger().issuance_histories, AS_OF, build.ledger().issuances)).first()
    assert one.asDict() == row.asDict()


def test_empty_checksum_and_known_checksum(spark):
    rows = [("B", "2"), ("A", "10"), ("A", "9"), ("B", "2")]
    df = spark.createDataFrame(rows, "finding_type string, target_key string")
    hashes = [hashlib.sha256(f"{a}\x1f{b}\x1e".encode()).hexdigest() for a, b in set(rows)]
    sums = [sum(int(h[8 * i : 8 * i + 8], 16) for h in hashes) % 2**32 for i in range(8)]
    text = ":".join(map(str, [len(hashes), *sums]))
    assert reconcile.findings_checksum(df).first()[0] == hashlib.sha256(text.encode()).hexdigest()
    assert reconcile.findings_checksum(df.repartition(5).union(df)).first() == reconcile.findings_checksum(df).first()
    assert reconcile.findings_checksum(df.limit(0)).first()[0] == hashlib.sha256(b"0:0:0:0:0:0:0:0:0").hexdigest()


def test_comparison(spark):
    make = lambda *keys: spark.createDataFrame([("T", k) for k in keys], "finding_type string, target_key string")
    got = {(r["target_key"], r["difference"]) for r in reconcile.compare_sets(make("a", "b"), make("b", "c", "c")).collect()}
    assert got == {("a", "missing"), ("c", "false_positive")}
    assert reconcile.comparison_counts(make("a"), make("a")).first()["passed"]


def test_nulls_do_not_violate(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 7), (4, 7)], "id int, k int")
    assert [r["offender"] for r in audits.audit_unique(df, ["k"], "k").collect()] == ["7"]
    parent = spark.createDataFrame([(8,)], "k int")
    assert [tuple(r)[1:] for r in audits.audit_fk(df, "k", parent, "k", "k").collect()] == [("7", 2)]
    assert sorted(r["offender"] for r in audits.audit_check(df, "k < 5", ["id"], "k").collect()) == ["3", "4"]


def test_statistics_keep_empty_cells(build):
    issue(build, 1).coupons.update({9: 15})
    led = build.ledger()
    funnel = {r["coupon_id"]: r for r in stats.coupon_funnel(led.coupons, led.issuances, led.coupon_stocks).collect()}
    assert funnel[9]["issued_total"] == 0 and funnel[9]["sold_out_seconds"] is None
    assert stats.hourly_stats(led.issuance_histories).count() == 168


def test_sold_out_seconds(build):
    issue(build, 1)
    build.stocks[1] = (1, 1)
    led = build.ledger()
    later = led.issuances.withColumn("issued_at", F.lit("2024-01-01 00:01:30.9").cast("timestamp_ntz"))
    row = stats.coupon_funnel(led.coupons, later, led.coupon_stocks).where("coupon_id = 1").first()
    assert row["sold_out_seconds"] == 90


def test_latest_run_prefers_the_later_attempt(spark):
    rows = [(1, at("01"), 1), (2, at("01"), 2)]
    runs = spark.createDataFrame(rows, "id bigint, as_of timestamp_ntz, attempt int").selectExpr(
        "*", "'CLEAN' dataset", "'FULL' scope", "'COMPLETE' stats_status"
    )
    assert reconcile.latest_stats_run(runs).first()["id"] == 2


def test_run_comparison(spark):
    rows = [(1, 1, "f", "c"), (2, 2, "f", "c"), (3, 3, "f", "d"), (4, 4, "g", "d")]
    runs = spark.createDataFrame(rows, "id bigint, attempt int, dataset_fingerprint string, findings_checksum string").selectExpr(
        "*", "TIMESTAMP_NTZ '2024-01-01' as_of", "'CLEAN' dataset", "'FULL' scope"
    )
    got = {r["second_run_id"]: r["outcome"] for r in reconcile.compare_runs(runs).collect()}
    assert got == {2: "DETERMINISTIC", 3: "VERIFIER_BUG", 4: "DATA_CHANGED"}


def test_a_key_range_replays_like_the_whole(spark):
    h = adapter.histories(spark, "/root/testdata/sf0.001")
    whole = {r["issuance_id"]: r["state"] for r in replay.replay_state(h, adapter.AS_OF).collect()}
    part = replay.replay_state(replay.key_range(h, 100, 199), adapter.AS_OF).collect()
    assert {r["issuance_id"]: r["state"] for r in part} == {k: v for k, v in whole.items() if 100 <= k <= 199}


def test_results_do_not_depend_on_the_session_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    got = []
    try:
        for zone in ("UTC", "Asia/Seoul"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            led = adapter.ledger(spark, "/root/testdata/sf0.001")
            found = rules.run_rules(led, adapter.AS_OF)
            fingerprint = reconcile.dataset_fingerprint(led.issuance_histories, led.issuances, led.coupon_stocks, adapter.AS_OF)
            got.append((reconcile.findings_checksum(found).first()[0], fingerprint.first()[1]))
            hours = stats.hourly_stats(led.issuance_histories).where("issued_total > 0").count()
            got[-1] += (hours,)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got[0] == got[1]


def test_default_as_of_falls_back_to_utc_now(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Seoul")
        runs = spark.createDataFrame([], "as_of timestamp_ntz, origin string")
        now = reconcile.default_as_of(runs).first()["as_of"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    utc = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert abs((utc - now).total_seconds()) < 120
