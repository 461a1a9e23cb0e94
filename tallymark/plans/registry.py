"""Every operator as a query over the given tables: (spark, folder) -> DataFrame."""

from __future__ import annotations

import base64
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.rows import fixed_rows
from tallymark import contract as C
from tallymark.functions import numbers, text, times
from tallymark.operators import apportion, audits, inject, pii, reconcile, replay, rules, skew, stats
from tallymark.plans import runs
from tallymark.sources import adapter, store, tsv
from tallymark.streaming import incremental as incremental_

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = adapter.AS_OF
EARLIER = "1998-01-01 00:00:00"
WINDOW = "1998-12-01 00:00:00"
FINDING = ["target_key", "expected", "actual"]
LATEST = 1_000
SLICE = (200, 899)  # of keys, for a partial check
PAGE = 50
SHARD_ROWS = 300
# published keys of the test vectors, no secret
KEYS = pii.Keys(
    base64.b64decode("6QFuC9nG//rkMttxxFPGIhUpCrNolTrLMv3jh5LZm+E="),
    base64.b64decode("omrv1gVpdi/QroTOIQ+udlsEtbTzNk+Qcp9fyYhgrD4="),
)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- replay -------------------------------------------------------------------

@query
def replay_state(spark, sf):
    return replay.replay_state(adapter.histories(spark, sf), AS_OF).drop("last_event_at")


@query
def event_chain(spark, sf):
    linked = replay.chain(adapter.histories(spark, sf), AS_OF)
    return linked.select("id", "issuance_id", "previous", "from_status", "to_status")


@query
def range_slice(spark, sf):
    """Replay of a slice of keys from files that are clustered by key."""
    path = f"{store.shared_folder(spark)}/clustered-{uuid.uuid4().hex}"
    store.write_clustered(adapter.histories(spark, sf), path, "issuance_id")
    stored = spark.read.parquet(path)
    return replay.replay_state(replay.key_range(stored, *SLICE), AS_OF).drop("last_event_at")


@query
def active_usages(spark, sf):
    return replay.active_usage_counts(adapter.usages(spark, sf), AS_OF)


@query
def asof_state(spark, sf):
    return replay.asof_state(adapter.histories(spark, sf), adapter.usages(spark, sf), AS_OF)


@query
def live_counts(spark, sf):
    return stats.live_counts(replay.digest(adapter.histories(spark, sf), AS_OF, adapter.issuances(spark, sf)))


# --- rules --------------------------------------------------------------------

@query
def v1_stock_mismatch(spark, sf):
    digest = replay.digest(adapter.histories(spark, sf), AS_OF, adapter.issuances(spark, sf))
    return rules.stock_mismatch(adapter.stocks(spark, sf), digest).select(*FINDING)


@query
def v2_dup_per_member(spark, sf):
    return rules.dup_per_member(adapter.issuances(spark, sf)).select(*FINDING)


@query
def v3_replay_mismatch(spark, sf):
    digest = replay.digest(adapter.histories(spark, sf), AS_OF, adapter.issuances(spark, sf))
    return rules.replay_mismatch(digest).select(*FINDING)


@query
def v4_illegal_transition(spark, sf):
    return rules.illegal_transition(replay.chain(adapter.histories(spark, sf), AS_OF)).select(*FINDING)


@query
def v5_usage_mismatch(spark, sf):
    digest = replay.digest(adapter.histories(spark, sf), AS_OF, usages=adapter.usages(spark, sf))
    return rules.usage_mismatch(digest).select(*FINDING)


@query
def v6_grade_violation(spark, sf):
    found = rules.grade_violation(adapter.issuances(spark, sf), adapter.coupons(spark, sf), adapter.grades(spark))
    return found.select(*FINDING)


@query
def all_findings(spark, sf):
    return rules.run_rules(adapter.ledger(spark, sf), AS_OF).select("finding_type", *FINDING)


@query
def finding_counts(spark, sf):
    return rules.finding_counts(rules.run_rules(adapter.ledger(spark, sf), AS_OF))


@query
def numbered_findings(spark, sf):
    led = adapter.ledger(spark, sf)
    found = rules.run_rules(led, AS_OF)
    return reconcile.numbered_findings(found, 1, led.history_rows()).select("id", "run_id", "finding_type", *FINDING)


@query
def findings_checksum(spark, sf):
    led = adapter.ledger(spark, sf)
    return reconcile.findings_checksum(rules.run_rules(led, AS_OF), led.history_rows())


@query
def dataset_fingerprint(spark, sf):
    led = adapter.ledger(spark, sf, stored=False)
    return reconcile.dataset_fingerprint(led.issuance_histories, led.issuances, led.coupon_stocks, AS_OF)


@query
def expected_vs_actual(spark, sf):
    """Findings of two points in time, as set differences both ways."""
    led = adapter.ledger(spark, sf)
    both = rules.rules_at(led, [EARLIER, AS_OF], rules.TIMED)
    return reconcile.compare_instants(both, led.history_rows())


@query
def incremental(spark, sf):
    """The state of an earlier run, stored, and the window verified from it."""
    led = adapter.ledger(spark, sf)
    state = incremental_.state_at(led, WINDOW)
    return incremental_.incremental_findings(led, WINDOW, AS_OF, state).select("finding_type", *FINDING)


@query
def advanced_state(spark, sf):
    """The stored state brought up to date from the window's events alone."""
    led = adapter.ledger(spark, sf)
    later = incremental_.advanced(led, incremental_.state_at(led, WINDOW), AS_OF)
    return later.issuances


@query
def turn_chain_legal(spark, sf):
    log = adapter.turn_log()
    return rules.illegal_transition(replay.chain(adapter.turns(spark, sf), None, log), log).select(*FINDING)


@query
def turn_chain_strict(spark, sf):
    """The same log when an assistant's turn may not be answered."""
    log = adapter.turn_log(adapter.TURN_TRANSITIONS[:4])
    return rules.illegal_transition(replay.chain(adapter.turns(spark, sf), None, log), log).select(*FINDING)


# --- planted faults -----------------------------------------------------------

@query
def tidy_control(spark, sf):
    return rules.finding_counts(rules.run_rules(adapter.tidy_ledger(spark, sf), adapter.TIDY_AS_OF))


@query
def planted_faults(spark, sf):
    """All 700 faults, and one of the grade, planted in the tidy ledger and found again, per rule."""
    free = (230, None)
    faulty = inject.inject(
        adapter.tidy_ledger(spark, sf),
        adapter.TIDY_AS_OF,
        slots={1: C.SLOT_STOCK, 3: (100, 230), 2: free, 4: free, 5: free, 6: free, 7: free},
        plant_grade_fault=True,
    )
    found = store.checkpoint(rules.run_rules(faulty, adapter.TIDY_AS_OF).select("finding_type", "target_key"))
    wrong = reconcile.compare_sets(faulty.expected_findings, found)
    names = fixed_rows(spark, [(t,) for t in C.FINDING_TYPES], "finding_type string")
    tally = (
        faulty.expected_findings.select("finding_type", F.lit("planted").alias("what"))
        .unionByName(found.select("finding_type", F.lit("found").alias("what")))
        .unionByName(wrong.select("finding_type", F.col("difference").alias("what")))
        .groupBy("finding_type")
        .agg(*[F.count_if(F.col("what") == w).alias(w) for w in ("planted", "found", "missing", "false_positive")])
    )
    return F.broadcast(names).join(tally, "finding_type")


@query
def fault_matrix(spark, sf):
    """Cells of (type, rule) that do not hold the wanted number."""
    found = rules.run_rules(adapter.ledger(spark, sf), AS_OF)
    place = F.array_position(F.array(*[F.lit(t) for t in C.FINDING_TYPES]), F.col("finding_type")).cast("int")
    return reconcile.check_fault_matrix(found.withColumn("corrupt_type", place), free_types=(6,))


# --- invariants and audits ----------------------------------------------------

@query
def inv_orphan_history(spark, sf):
    return audits.orphans("orphan histories", adapter.histories(spark, sf), adapter.issuances(spark, sf))


@query
def inv_orphan_usage(spark, sf):
    """Usages against the issuances of finished orders only, so some are lost."""
    finished = adapter.issuances(spark, sf).where("status = 'USED'")
    return audits.orphans("orphan usages", adapter.usages(spark, sf), finished)


@query
def inv_status_vocab(spark, sf):
    renamed = adapter.issuances(spark, sf).withColumn(
        "status", F.when(F.col("issued_grade") == "5-LOW", "LOST").otherwise(F.col("status"))
    )
    return audits.status_vocabulary(renamed)


@query
def inv_active_range(spark, sf):
    return audits.active_range(adapter.stocks(spark, sf))


@query
def inv_dup_code(spark, sf):
    return audits.duplicate_code(adapter.issuances(spark, sf))


@query
def inv_dup_email(spark, sf):
    """Document texts in the place of addresses: the corpus repeats some."""
    docs = adapter.table(spark, sf, "documents")
    return audits.duplicate_email(docs.select(F.sha2("text", 256).alias("email_hash")))


@query
def inv_funnel_sum(spark, sf):
    """Issuances of one grade have a status that no column of the funnel counts."""
    led = adapter.ledger(spark, sf, stored=False)
    renamed = led.issuances.withColumn("status", F.when(F.col("issued_grade") == "5-LOW", "LOST").otherwise(F.col("status")))
    return audits.funnel_sum(stats.coupon_funnel(led.coupons, renamed, led.coupon_stocks))


@query
def inv_funnel_stock(spark, sf):
    """Funnel of stored states against the replayed live counters."""
    led = adapter.ledger(spark, sf, stored=False)
    funnel = stats.coupon_funnel(led.coupons, led.issuances, led.coupon_stocks)
    replayed = stats.live_counts(replay.digest(led.issuance_histories, AS_OF, led.issuances))
    return audits.funnel_matches_stock(funnel, replayed)


@query
def invariants(spark, sf):
    return audits.check_invariants(adapter.ledger(spark, sf, stored=False), "CLEAN")


@query
def audit_unique(spark, sf):
    lines = adapter.table(spark, sf, "lineitem")
    return audits.audit_unique(lines, ["l_orderkey", "l_linenumber"], "lineitem")


@query
def audit_fk(spark, sf):
    docs, labels = adapter.table(spark, sf, "documents"), adapter.table(spark, sf, "labels")
    return audits.audit_fk(docs, "doc_id", labels, "doc_id", "documents.doc_id -> labels.doc_id")


@query
def audit_check(spark, sf):
    lines = adapter.table(spark, sf, "lineitem")
    rule = "l_quantity <= 40 OR l_discount <= 0.05"
    return audits.audit_check(lines, rule, ["l_orderkey", "l_linenumber"], "bulk discount")


@query
def audit_nulls(spark, sf):
    docs = adapter.table(spark, sf, "documents")
    return audits.audit_required(docs, "documents", ["doc_id", "text", "lang"], {"text": 2_000, "source": 5})


@query
def audit_ledger(spark, sf):
    """Every declared constraint of a CLEAN ledger on the untidy one; what cannot be checked says why."""
    led = adapter.ledger(spark, sf, stored=False)
    tables = led.tables() | {
        "coupon_stocks": led.coupon_stocks.withColumn("updated_at", times.ntz(AS_OF)),
        "verification_runs": adapter.runs(spark, sf),
    }
    known = F.col("violations").isNotNull()
    return audits.audit_tables(tables, "CLEAN").groupBy("constraint_name").agg(
        F.count_if(known).alias("offenders"),
        F.sum("violations").alias("violations"),
        F.max(F.when(~known, F.col("offender"))).alias("not_checked"),
    )


# --- runs ---------------------------------------------------------------------

@query
def latest_run(spark, sf):
    return reconcile.latest_stats_run(adapter.runs(spark, sf)).select("id", "as_of", "attempt")


@query
def latest_verdict(spark, sf):
    return reconcile.latest_verdict(adapter.runs(spark, sf)).select("id", "finished_at")


@query
def default_as_of(spark, sf):
    return reconcile.default_as_of(adapter.runs(spark, sf))


@query
def run_determinism(spark, sf):
    return reconcile.compare_runs(adapter.runs(spark, sf))


@query
def verdict(spark, sf):
    """The untidy ledger verified and the run committed; its record as a reader sees it."""
    root = f"{store.shared_folder(spark)}/runs-{uuid.uuid4().hex}"
    record = runs.verify_and_commit(spark, adapter.ledger(spark, sf), AS_OF, root, run_id=7)
    return record.select("id", "dataset", "scope", "verdict", "stats_status", "finding_count", "findings_checksum", "dataset_fingerprint", "origin")


@query
def committed_findings(spark, sf):
    """A run's findings, committed by a repeated run after one that stopped half-way."""
    root = f"{store.shared_folder(spark)}/runs-{uuid.uuid4().hex}"
    led = adapter.ledger(spark, sf)
    runs.write_findings(rules.run_rules(led, EARLIER, ["STOCK_MISMATCH"]), root, 7, "stopped")
    runs.write_findings(rules.run_rules(led, AS_OF, ["STOCK_MISMATCH", "REPLAY_MISMATCH"]), root, 7, "whole")
    runs.commit(spark, root, 7, "whole")
    return runs.findings(spark, root).select("id", "run_id", "finding_type", *FINDING)


# --- statistics ---------------------------------------------------------------

@query
def coupon_funnel(spark, sf):
    led = adapter.ledger(spark, sf, stored=False)
    return stats.coupon_funnel(led.coupons, led.issuances, led.coupon_stocks)


@query
def sold_out_seconds(spark, sf):
    return coupon_funnel(spark, sf).where("sold_out_seconds IS NOT NULL").select("coupon_id", "sold_out_seconds")


@query
def grade_stats(spark, sf):
    return stats.grade_stats(adapter.issuances(spark, sf))


@query
def hourly_heatmap(spark, sf):
    return stats.hourly_stats(adapter.table(spark, sf, "events"), event="signup", at="ts")


@query
def status_summary(spark, sf):
    return stats.status_summary(adapter.issuances(spark, sf), adapter.stocks(spark, sf))


@query
def run_summary(spark, sf):
    """The six tables of the ledger written out, with what the writes counted."""
    led = adapter.ledger(spark, sf)
    names = ("coupons", "coupon_stocks", "coupon_stats", "issuances", "issuance_histories", "issuance_usages")
    root = f"{store.shared_folder(spark)}/summary-{uuid.uuid4().hex}"
    return stats.run_summary({n: getattr(led, n) for n in names}, root)


@query
def late_expiry(spark, sf):
    return stats.late_expiry(adapter.issuances(spark, sf), AS_OF)


@query
def expiring_soon(spark, sf):
    return stats.expiring_within(adapter.issuances(spark, sf), AS_OF, 72).select("id", "expires_at")


@query
def recent_requests(spark, sf):
    events = adapter.table(spark, sf, "events")
    return stats.recent_only(events, "2024-01-20 00:00:00", "ts").select("event_id", "ts")


@query
def topn_requests(spark, sf):
    events = adapter.table(spark, sf, "events").withColumnRenamed("event_id", "request_id")
    body = F.to_json(
        F.struct(
            F.col("user_id").alias("issuanceId"),
            F.lit("OK").alias("status"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("appliedAt"),
        )
    )
    return stats.latest_requests(events, LATEST, "ts").select("request_id", "ts", body.alias("response_body"))


# --- functions ----------------------------------------------------------------

@query
def code_encode(spark, sf):
    return adapter.table(spark, sf, "orders").select("o_orderkey", text.issue_code(F.col("o_orderkey")).alias("code"))


@query
def nth_weekday(spark, sf):
    names = F.array(*[F.lit(d) for d in C.DAYS_OF_WEEK])
    day = times.nth_weekday(
        F.col("o_orderdate"), F.col("o_orderkey") % 5 + 1, F.element_at(names, (F.col("o_custkey") % 7 + 1).cast("int"))
    )
    return adapter.table(spark, sf, "orders").select("o_orderkey", day.alias("day"))


@query
def brand_calendar(spark, sf):
    """Monthly opening day of every nation's second Friday, a year back from each order month."""
    months = adapter.table(spark, sf, "orders").select(F.trunc("o_orderdate", "MM").alias("month")).distinct()
    nations = adapter.table(spark, sf, "nation").select("n_nationkey")
    nth = F.col("n_nationkey") % 4 + 1
    start = times.month_back(F.col("month"), F.lit(12))
    return (
        F.broadcast(nations)
        .crossJoin(months)  # 25 nations by calendar months
        .select("n_nationkey", "month", times.nth_weekday(start, nth, F.lit("FRI")).alias("opens"))
    )


@query
def whole_seconds(spark, sf):
    return adapter.table(spark, sf, "events").select("event_id", times.truncate_second(times.plus_micros(F.col("ts"), F.col("event_id") % 1_000_000)).alias("second"))


@query
def discount_amount(spark, sf):
    o = adapter.table(spark, sf, "orders")
    policy = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "PERCENT_CAPPED")
        .when(F.col("o_orderpriority") == "2-HIGH", "FIXED_AMOUNT")
        .otherwise("DATA_GRANT")
    )
    order = F.floor("o_totalprice").cast("bigint")
    return o.select(
        "o_orderkey", numbers.discount(policy, order, F.lit(20), F.lit(20_000), F.lit(5_000)).alias("discount")
    )


@query
def scatter_ids(spark, sf):
    """Customer numbers scattered by a bijection, and brought back."""
    c = adapter.table(spark, sf, "customer")
    n = c.agg((F.max("c_custkey") + 1).alias("n")).first()["n"]
    there = F.pmod(numbers.times_mod(F.lit(2147483659 % n), F.col("c_custkey"), F.lit(n), n) + 12_345, F.lit(n))
    back = pow(2147483659 % n, -1, n)
    again = numbers.times_mod(F.lit(back), F.pmod(F.col("scattered") - 12_345, F.lit(n)), F.lit(n), n)
    return c.select("c_custkey", there.alias("scattered")).withColumn("restored", again)


@query
def sample_without_replacement(spark, sf):
    """Per order, as many distinct parts as it has lines, by permutation."""
    sizes = adapter.lines(spark, sf).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("k"))
    parts = adapter.table(spark, sf, "part").count()
    enough = F.when(F.col("k") <= parts, F.col("k")).otherwise(
        F.raise_error(F.concat(F.lit("cannot draw that many different parts: "), F.col("k").cast("string"))).cast("bigint")
    )
    picks = skew.expand(sizes.withColumn("k", enough), "k", "i").select(
        "l_orderkey", numbers.shuffle_index(7, "parts", F.col("i"), F.lit(parts), F.col("l_orderkey"), parts).alias("part")
    )
    each = picks.groupBy("l_orderkey", "part").agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy("l_orderkey").agg(
        F.sum("n").alias("drawn"),
        F.count(F.lit(1)).alias("different"),
        F.count_if((F.col("part") < 0) | (F.col("part") >= parts)).alias("outside"),
    )


# --- apportionment ------------------------------------------------------------

def _order_counts(spark, sf):
    return adapter.table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


@query
def rebalance(spark, sf):
    """Order counts raised, customers in order, until the total is a tenth more."""
    counts = _order_counts(spark, sf).withColumn("low", F.lit(0)).withColumn("high", F.col("n") + 3)
    target = counts.agg((F.sum("n") + F.floor(F.sum("n") / 10)).alias("t"))
    return apportion.rebalance(counts, ["o_custkey"], "n", "low", "high", target).select("o_custkey", "n")


@query
def quota_spread(spark, sf):
    customers = adapter.table(spark, sf, "customer").count()
    spread = apportion.spread_quota(_order_counts(spark, sf), "o_custkey", "n", customers * 3)
    return spread.select("o_custkey", F.col("quota").cast("bigint").alias("quota"))


@query
def running_total(spark, sf):
    return skew.running_total(_order_counts(spark, sf), ["o_custkey"], "n", "before").select("o_custkey", "before")


@query
def raked_margins(spark, sf):
    """Customers by priorities fitted to both margins; the margins of the result."""
    priorities = [g for g, _ in adapter.GRADES]
    orders = adapter.table(spark, sf, "orders")
    counts = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    listed = orders.where(F.col("o_orderpriority").isin(priorities))  # so at most five margins
    margin = {r["o_orderpriority"]: r["count"] for r in listed.groupBy("o_orderpriority").count().collect()}
    weights = F.array(*[((F.col("o_custkey") * (j + 2)) % 7 + 1).cast("double") for j in range(len(priorities))])
    targets = [margin.get(p, 0) for p in priorities]
    raked = apportion.rake(counts.withColumn("w", weights), "n", "w", targets)
    whole = store.checkpoint(apportion.round_rows(raked, "n", "raked").drop("raked"))
    fitted = apportion.repair_columns(whole, ["o_custkey"], "counts", "w", targets)
    rows = fitted.select(
        F.concat(F.lit("customer "), F.col("o_custkey").cast("string")).alias("margin"),
        F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("total"),
    )
    columns = fitted.select(F.posexplode("counts").alias("j", "c")).groupBy("j").agg(F.sum("c").alias("total"))
    name = F.get(F.array(*[F.lit(p) for p in priorities]), F.col("j"))
    return rows.unionByName(columns.select(name.alias("margin"), "total"))


# --- personal data ------------------------------------------------------------

PERSON = (pii.Field("email", text.normalize_email), pii.Field("phone", text.normalize_phone))


def _people(spark, sf):
    c = adapter.table(spark, sf, "customer")
    return c.select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit(" "), "c_name", F.lit("@Example.COM ")).alias("email"),
        F.format_string("010-%04d-%04d", F.col("c_custkey") % 10_000, F.col("c_nationkey")).alias("phone"),
        (F.col("c_acctbal") < 0).alias("owes"),
    )


@query
def blind_index(spark, sf):
    p = _people(spark, sf)
    return p.select("id", *[pii.blind_index(KEYS, f, F.col(f.name)).alias(f.hash) for f in PERSON])


@query
def pii_roundtrip(spark, sf):
    shown = pii.reveal(pii.protect(_people(spark, sf), KEYS, PERSON), KEYS, PERSON)
    return shown.select("id", "email", "phone")


@query
def pii_audit(spark, sf):
    """Customers in debt have a hash that was made from something else."""
    wrong = F.when(F.col("owes"), F.sha2("email_hash", 256)).otherwise(F.col("email_hash"))
    stored = pii.protect(_people(spark, sf), KEYS, PERSON).withColumn("email_hash", wrong)
    return pii.round_trip(stored, KEYS, PERSON)


@query
def pii_lookup(spark, sf):
    """Customers of one segment found by their addresses alone."""
    wanted = adapter.table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'")
    asked = wanted.select(F.concat(F.upper("c_name"), F.lit("@example.com")).alias("plaintext"))
    stored = pii.protect(_people(spark, sf), KEYS, PERSON)
    return pii.find_by_plaintext(stored, asked, KEYS, PERSON[0]).select("id", "email_hash")


@query
def members_found(spark, sf):
    """Members by id or by address in one look-up: the first of them by id, decrypted."""
    c = adapter.table(spark, sf, "customer")
    stored = pii.protect(_people(spark, sf).withColumn("name", F.lit(None).cast("string")), KEYS)
    ids = c.where("c_nationkey = 3").select(F.col("c_custkey").alias("id"))
    emails = c.where("c_mktsegment = 'BUILDING' AND c_acctbal < 0").select(F.concat(F.upper("c_name"), F.lit("@example.com")).alias("plaintext"))
    return pii.show_page(pii.find_members(stored, KEYS, ids, emails), KEYS, PAGE).select("id", "email", "phone")


@query
def pii_sizes(spark, sf):
    """Encrypted page addresses outside the allowed size: empty ones, and ones with bytes appended after encryption."""
    url = pii.Field("url")
    pages = adapter.table(spark, sf, "pages").select(
        F.col("page_id").alias("id"),
        F.when(F.length("html") % 11 == 0, "").otherwise(F.col("url")).alias("url"),
        (F.length("html") % 7 == 0).alias("longer"),
    )
    stored = pii.protect(pages, KEYS, (url,))
    appended = F.when(F.col("longer"), F.concat(url.enc, F.repeat(F.lit("x"), F.lit(300)).cast("binary"))).otherwise(F.col(url.enc))
    return pii.size_audit(stored.withColumn(url.enc, appended), (url,))


# --- exchange format ----------------------------------------------------------

@query
def tsv_roundtrip(spark, sf):
    columns = [("doc_id", "long"), ("text", "str"), ("lang", "str"), ("source", "str"), ("n_chars", "long")]
    return tsv.from_lines(tsv.to_lines(adapter.table(spark, sf, "documents"), columns), columns)


@query
def tsv_lines(spark, sf):
    columns = [("id", "long"), ("issuance_id", "long"), ("used_at", "dt"), ("canceled_at", "dt6")]
    return tsv.to_lines(adapter.usages(spark, sf), columns)


@query
def tsv_files(spark, sf):
    """Documents through real files of bounded size, some lines damaged on the way: what was read, and what was not and why."""
    columns = [("doc_id", "long"), ("text", "str"), ("lang", "str"), ("source", "str"), ("n_chars", "long")]
    docs = adapter.table(spark, sf, "documents")
    path = f"{store.shared_folder(spark)}/shards-{uuid.uuid4().hex}"
    tsv.write_shards(docs.where("doc_id % 10 <> 0"), path, columns, rows_per_file=SHARD_ROWS)
    broken = tsv.to_lines(docs.where("doc_id % 10 = 0"), columns)
    cut = F.when(F.col("value").startswith("1"), F.regexp_replace("value", "\t[^\t]*$", "")).otherwise(F.regexp_replace("value", "[0-9]+$", "many"))
    broken.select(cut.alias("value")).write.mode("append").option("maxRecordsPerFile", SHARD_ROWS).text(path)
    good, bad = tsv.read_shards(spark, path, columns)
    read = good.agg(F.lit("read").alias("outcome"), F.count(F.lit(1)).alias("lines"), F.sum("doc_id").alias("total"))
    lost = bad.groupBy(F.col("reason").alias("outcome")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.split("value", "\t")[0].cast("bigint")).alias("total")
    )
    return read.unionByName(lost)
