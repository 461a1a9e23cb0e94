"""Planting labelled faults in a clean ledger.

Each fault touches everything it must so that only the intended rule fires; the
code that plants it also writes the findings to expect. The faults themselves
are few (fixed counts); the ledger's tables are only filtered, extended, or
joined to those few rows.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark import contract as C
from tallymark.functions.hashing import uniform
from tallymark.functions.text import issue_code, target_key
from tallymark.functions.times import micros_between, ntz, plus_days, plus_micros, seconds_between, truncate_second
from tallymark.operators import skew
from tallymark.operators.ledger import Ledger
from tallymark.sources.store import checkpoint

GAP_MICROS = 100  # free time a fault needs between two events

_EXPECTED = ("corrupt_type", "finding_type", "target_key", "campaign_id", "member_id", "coupon_id", "history_id", "note")


def _expected(df: DataFrame, fault: Column | int, rule: str, key: Column, note: str, **refs: Column) -> DataFrame:
    return df.select(
        (fault if isinstance(fault, Column) else F.lit(fault)).cast("tinyint").alias("corrupt_type"),
        F.lit(rule).alias("finding_type"),
        key.alias("target_key"),
        *[refs.get(n, F.lit(None)).cast("bigint").alias(n) for n in ("campaign_id", "member_id", "coupon_id", "history_id")],
        F.lit(note).alias("note"),
    )


def coupon_slots(ledger: Ledger, as_of) -> DataFrame:
    """Past coupons by age with their place (0-based): one row per coupon."""
    issued = ledger.issuances.select(F.col("coupon_id").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("issued_rows"))
    past = (
        ledger.coupons.where(F.col("close_at") <= ntz(as_of))
        .select("id", "eligible_grades_mask", "open_at", "close_at", "valid_days")
        .join(issued, "id")
    )
    ranked = skew.dense_number(checkpoint(past), ["id"], "place")
    return ranked.withColumn("place", F.col("place") - 1)


def fault_candidates(ledger: Ledger, as_of) -> DataFrame:
    """Issuances with the event times a fault has to fit between."""
    times = ledger.issuance_histories.groupBy(F.col("issuance_id").alias("id")).agg(
        F.min(F.when(F.col("event_type") == "USE", F.col("created_at"))).alias("first_use"),
        F.max("created_at").alias("last_at"),
    )
    horizon = F.least(F.col("expires_at"), ntz(as_of))
    status = F.col("status")
    return (
        ledger.issuances.join(times, "id")
        .withColumn("horizon", horizon)
        .withColumn(
            "fits_double_cancel",
            (status == C.USED) & (micros_between(F.col("issued_at"), F.col("first_use")) > GAP_MICROS),
        )
        .withColumn(
            "fits_open_usage",
            (status == C.ISSUED) & (micros_between(F.col("last_at"), F.col("horizon")) > GAP_MICROS),
        )
    )


class FaultPlan:
    """Chosen targets, small tables that are checkpointed.

    All types choose at once: every issuance is offered to the types it suits, each coupon ranks its offers of a type by a
    hash, and a type takes first the best offer of each coupon, in order of age, then the second ones. So faults spread
    evenly, and no task keeps more than a type needs. Types 1 and 3 take one offer a coupon.
    """

    def __init__(self, ledger: Ledger, as_of, seed: int, counts: dict[int, int], slots: dict[int, tuple[int, int | None]], plant_grade_fault: bool):
        self.as_of, self.seed = as_of, seed
        counts = dict(counts) | ({C.FAULT_GRADE: 1} if plant_grade_fault else {})
        slots = dict(slots) | {C.FAULT_GRADE: slots[5]}
        coupons = checkpoint(coupon_slots(ledger, as_of)).withColumnRenamed("id", "coupon_id")
        place = F.col("place")

        def inside(fault: int) -> Column:
            low, high = slots[fault]
            return place >= low if high is None else place.between(low, high - 1)

        restricted = F.col("eligible_grades_mask") != C.MASK_ALL
        suits = {
            1: F.lit(True),
            2: F.col("status") == C.USED,
            3: F.col("fits_double_cancel"),
            4: F.col("status") == C.EXPIRED,
            5: F.lit(True),
            6: F.lit(True),
            7: F.col("fits_open_usage"),
            C.FAULT_GRADE: restricted,
        }
        single = (1, 3, C.FAULT_GRADE)
        offers = skew.lookup_join(fault_candidates(ledger, as_of), coupons, ["coupon_id"]).withColumn(
            "fault", F.explode(F.filter(F.array(*[F.when(suits[f] & inside(f), F.lit(f)) for f in counts]), lambda f: f.isNotNull()))
        )
        by_hash = Window.partitionBy("fault", "coupon_id").orderBy(F.xxhash64(F.lit(seed), "fault", "id"), "id")
        in_turn = Window.partitionBy("fault").orderBy("pick", "place")
        need = max(counts.values())  # a literal: map tasks keep so many rows of a group at most
        wanted = F.coalesce(*[F.when(F.col("fault") == f, F.lit(n)) for f, n in counts.items()])
        self.targets = checkpoint(
            offers.withColumn("pick", F.row_number().over(by_hash))
            .where((F.col("pick") <= need) & (~F.col("fault").isin(*single) | (F.col("pick") == 1)))
            .withColumn("turn", F.row_number().over(in_turn))
            .where((F.col("turn") <= need) & (F.col("turn") <= wanted))
        )
        self.stock_targets = self.of(1).select(F.col("coupon_id").alias("id"), F.lit(1).alias("fault"))
        got = {r["fault"]: r["count"] for r in self.targets.groupBy("fault").count().collect()}  # one row per fault type
        short = {f: (n, got.get(f, 0)) for f, n in counts.items() if got.get(f, 0) < n}
        if short:
            raise ValueError(f"ledger too small for the planned faults, type: (wanted, possible) {short}")

    def of(self, *faults: int) -> DataFrame:
        return self.targets.where(F.col("fault").isin(*faults))


def _new_members(ledger: Ledger, clones: DataFrame, seed: int) -> DataFrame:
    """A member who holds nothing of the coupon yet, for every cloned row: fault, id, coupon_id, new_member.

    Members have ranks by id. A clone asks for the k-th of the members its coupon leaves free, a k of its own within the
    coupon. With the i-th taken rank t_i (from 0), t_i - i free ranks lie below it, so the k-th free rank is k plus the number
    of taken ones with t_i - i <= k: a count, exact as long as one member is free. Ranges are numbered, never a whole coupon
    or table in one task.
    """
    ranked = checkpoint(skew.dense_number(checkpoint(ledger.members.select("id").distinct()), ["id"], "rank").withColumn("rank", F.col("rank") - 1))
    members = ranked.count()
    mine = clones.select("coupon_id").distinct()  # at most as many coupons as faults
    holders = ledger.issuances.join(F.broadcast(mine), "coupon_id", "left_semi").select("coupon_id", F.col("member_id").alias("id")).distinct()
    taken = checkpoint(skew.lookup_join(holders, ranked, ["id"]).select("coupon_id", "rank"))
    numbered = skew.dense_number(taken, ["coupon_id", "rank"], "number")
    sizes = taken.groupBy("coupon_id").agg(F.count(F.lit(1)).alias("held"))
    asking = Window.partitionBy("coupon_id").orderBy("fault", "id")  # at most as many rows as faults
    asked = (
        clones.select("fault", "id", "coupon_id", (F.row_number().over(asking) - 1).alias("j"))
        .join(sizes, "coupon_id", "left")
        .withColumn("free", F.lit(members) - F.coalesce("held", F.lit(0)))
        .where("j < free")
        .withColumn("k", F.pmod(F.xxhash64(F.lit(seed), "coupon_id") + F.col("j"), F.col("free")))
    )
    asked = checkpoint(asked.select("fault", "id", "coupon_id", "k"))
    first = numbered.groupBy("coupon_id").agg(F.min("number").alias("first"))  # numbers go on from coupon to coupon
    below = numbered.join(F.broadcast(first), "coupon_id").select("coupon_id", (F.col("rank") - (F.col("number") - F.col("first"))).alias("free_below"))
    passed = (
        F.broadcast(asked)  # one row per clone
        .join(below, "coupon_id")
        .where("free_below <= k")
        .groupBy("fault", "id", "coupon_id")
        .agg(F.count(F.lit(1)).alias("passed"))
    )
    wanted = asked.join(passed, ["fault", "id", "coupon_id"], "left").select(
        "fault", F.col("id").alias("source"), "coupon_id", (F.col("k") + F.coalesce("passed", F.lit(0))).alias("rank")
    )
    return ranked.join(F.broadcast(wanted), "rank").select("fault", F.col("source").alias("id"), "coupon_id", F.col("id").alias("new_member"))


def inject(
    ledger: Ledger,
    as_of: str | dt.datetime,
    *,
    seed: int = 7,
    seed_run_id: int = 1,
    counts: dict[int, int] | None = None,
    slots: dict[int, tuple[int, int | None]] | None = None,
    plant_grade_fault: bool = False,
) -> Ledger:
    """The corrupted ledger, with its ``expected_findings``.

    ``counts`` maps fault type to number; ``slots`` the range of past coupons
    (by age) a type may use. Raises when the ledger cannot hold them all.
    """
    counts = {f: n for f, (n, _) in C.FAULT_RULES.items()} if counts is None else counts
    slots = slots or {
        1: C.SLOT_STOCK,
        3: C.SLOT_DOUBLE_CANCEL,
        **{f: (C.SLOT_FREE_FROM, None) for f in (2, 4, 5, 6, 7)},
    }
    plan = FaultPlan(ledger, as_of, seed, counts, slots, plant_grade_fault)
    t = ntz(as_of)
    limits = (
        ledger.issuances.agg(F.max("id").alias("i"))
        .crossJoin(ledger.issuance_histories.agg(F.max("id").alias("h")))
        .crossJoin(ledger.issuance_usages.agg(F.coalesce(F.max("id"), F.lit(0)).alias("u")))
        .first()
    )

    # --- cloned issuances: faults 5, 6 and 8 --------------------------------
    clones = plan.of(5, 6, C.FAULT_GRADE)
    fresh = _new_members(ledger, plan.of(5, C.FAULT_GRADE), seed)
    bits = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(g).alias("g")) for g, b in C.GRADE_BITS.items()])
    inside = lambda wanted: F.filter(bits, lambda e: (e["b"].bitwiseAND(F.col("eligible_grades_mask").cast("int")) != 0) == F.lit(wanted))
    bad_grade = F.col("fault") == C.FAULT_GRADE
    cloned = skew.dense_number(clones, ["coupon_id", "fault", "id"], "number")
    cloned = checkpoint(
        cloned.withColumn("new_id", F.col("number") + limits["i"])
        .join(F.broadcast(fresh), ["fault", "id", "coupon_id"], "left")  # one row per clone
        .withColumn("member_id", F.when(F.col("fault") == 6, F.col("member_id")).otherwise(F.col("new_member")))
        .withColumn("code", F.when(F.col("fault") == 5, F.col("code")).otherwise(issue_code(F.col("new_id"))))
        .withColumn("issued_grade", F.when(bad_grade, F.get(inside(False), F.lit(0))["g"]).otherwise(F.get(inside(True), F.lit(0))["g"]))
        .withColumn(
            "issued_at",
            plus_micros(F.col("open_at"), F.floor(uniform(seed, "clone time", F.col("new_id")) * seconds_between(F.col("open_at"), F.col("close_at")) * 1e6)),
        )
        .withColumn("expires_at", plus_days(F.col("issued_at"), F.col("valid_days")))
    )
    lacking = cloned.where("member_id IS NULL").count()
    if lacking:
        raise ValueError(f"no free member found for {lacking} cloned issuances")
    clone_rows = cloned.select(
        F.col("new_id").alias("id"), "coupon_id", "member_id", "code", "issued_grade",
        F.lit(C.ISSUED).alias("status"), "issued_at", "expires_at", F.col("issued_at").alias("updated_at"),
    )

    # --- added events ---------------------------------------------------------
    def event(fault: Column, row: DataFrame, name: str, before: str | None, after: str, at: Column, step: int) -> DataFrame:
        return row.where(fault).select(
            F.col("id").alias("issuance_id"), "fault", F.lit(step).alias("step"), F.lit(name).alias("event_type"),
            F.lit(before).cast("string").alias("from_status"), F.lit(after).alias("to_status"), at.alias("created_at"),
        )

    rows = plan.targets
    f3, f4, f7 = (F.col("fault") == f for f in (3, 4, 7))
    before_use = micros_between(F.col("issued_at"), F.col("first_use"))
    between = lambda share: plus_micros(F.col("issued_at"), F.floor(before_use * share))
    after_last = lambda share: plus_micros(
        F.col("last_at"), F.floor(micros_between(F.col("last_at"), F.col("horizon")) * share)
    )
    reused_at = F.least(F.col("last_at") + F.make_dt_interval(hours=F.lit(1)), t)
    issue_events = cloned.select(
        F.col("new_id").alias("issuance_id"), "fault", F.lit(0).alias("step"), F.lit("ISSUE").alias("event_type"),
        F.lit(None).cast("string").alias("from_status"), F.lit(C.ISSUED).alias("to_status"), F.col("issued_at").alias("created_at"),
    )
    added = reduce(
        DataFrame.unionByName,
        [
            event(f3, rows, "USE", C.ISSUED, C.USED, between(0.25), 1),
            event(f3, rows, "CANCEL_USE", C.USED, C.ISSUED, between(0.50), 2),
            event(f3, rows, "CANCEL_USE", C.USED, C.ISSUED, between(0.75), 3),  # the second one is the fault
            event(f4, rows, "USE", C.EXPIRED, C.USED, reused_at, 1),
            event(f7, rows, "USE", C.ISSUED, C.USED, after_last(0.33), 1),
            event(f7, rows, "CANCEL_USE", C.USED, C.ISSUED, after_last(0.66), 2),
            issue_events,
        ],
    )
    added = checkpoint(
        skew.dense_number(added, ["issuance_id", "fault", "step"], "number").withColumn("id", F.col("number") + limits["h"])
    )
    added_rows = added.select(
        "id", "issuance_id", "event_type", "from_status", "to_status",
        F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("request_id"), "created_at",
    )

    # --- added usages -----------------------------------------------------------
    def usage(fault: Column, start: Column, end: Column | None) -> DataFrame:
        closed = truncate_second(end) if end is not None else F.lit(None).cast("timestamp_ntz")
        return rows.where(fault).select(
            F.col("id").alias("issuance_id"), truncate_second(start).alias("used_at"), closed.alias("canceled_at")
        )

    used = reduce(
        DataFrame.unionByName,
        [usage(f3, between(0.25), between(0.50)), usage(f4, reused_at, None), usage(f7, after_last(0.33), None)],
    )
    used_rows = skew.dense_number(used, ["issuance_id", "used_at"], "number").select(
        (F.col("number") + limits["u"]).alias("id"), "issuance_id", F.lit(None).cast("bigint").alias("order_id"),
        F.lit(0).alias("discount_amount"), "used_at", "canceled_at",
    )

    # --- changed issuances and stocks -------------------------------------------
    last_event = added.groupBy(F.col("issuance_id").alias("id")).agg(F.max("created_at").alias("touched_at"))
    change = plan.of(2, 3, 4, 7).select(
        "id", F.when(F.col("fault") == 2, C.ISSUED).when(F.col("fault") == 4, C.USED).alias("new_status")
    ).join(last_event, "id", "left")
    changed = ledger.issuances.join(F.broadcast(change), "id", "left").select(  # one row per fault
        "id", "coupon_id", "member_id", "code", "issued_grade",
        F.coalesce("new_status", "status").alias("status"),
        "issued_at", "expires_at",
        F.greatest("updated_at", F.coalesce("touched_at", "updated_at")).alias("updated_at"),
    )
    moves = (
        plan.stock_targets.select(F.col("id").alias("coupon_id"), F.lit(1).alias("d"))
        .unionByName(plan.of(3).select("coupon_id", F.lit(-1).alias("d")))
        .unionByName(plan.of(4).select("coupon_id", F.lit(1).alias("d")))  # EXPIRED became live
        .unionByName(cloned.select("coupon_id", F.lit(1).alias("d")))
        .groupBy("coupon_id")
        .agg(F.sum("d").alias("d"))
    )
    stocks = ledger.coupon_stocks.join(F.broadcast(moves), "coupon_id", "left").select(  # one row per fault at most
        "coupon_id", "total_quantity",
        (F.col("active_count") + F.coalesce("d", F.lit(0))).cast("int").alias("active_count"),
        "updated_at",
    )

    # --- what must be found -------------------------------------------------------
    coupon = lambda c: target_key((C.KEY_COUPON, F.col(c)))
    pair = target_key((C.KEY_COUPON, F.col("coupon_id")), (C.KEY_MEMBER, F.col("member_id")))
    issuance = lambda c: target_key((C.KEY_ISSUANCE, F.col(c)))
    wrong_event = added.where("(fault = 3 AND step = 3) OR fault = 4")
    expected = reduce(
        DataFrame.unionByName,
        [
            _expected(plan.stock_targets, 1, C.STOCK_MISMATCH, coupon("id"), "stock taken without an ISSUE event", campaign_id=F.col("id")),
            _expected(plan.of(2), 2, C.REPLAY_MISMATCH, issuance("id"), "replays to USED, stored as ISSUED", coupon_id=F.col("id")),
            _expected(plan.of(3), 3, C.STOCK_MISMATCH, coupon("coupon_id"), "stock restored twice", campaign_id=F.col("coupon_id")),
            _expected(wrong_event, F.col("fault"), C.ILLEGAL_TRANSITION, target_key((C.KEY_HISTORY, F.col("id"))), "event that does not follow", history_id=F.col("id")),
            _expected(cloned.where("fault IN (5, 6)"), F.col("fault"), C.DUP_PER_MEMBER, pair, "cloned issuance", campaign_id=F.col("coupon_id"), member_id=F.col("member_id"), coupon_id=F.col("new_id")),
            _expected(plan.of(7), 7, C.USAGE_MISMATCH, issuance("id"), "restored, but a usage is still open", coupon_id=F.col("id")),
            _expected(cloned.where(bad_grade), C.FAULT_GRADE, C.GRADE_VIOLATION, issuance("new_id"), "grade outside the mask", campaign_id=F.col("coupon_id"), coupon_id=F.col("new_id")),
        ],
    )
    labelled = skew.dense_number(expected, ["corrupt_type", "finding_type", "target_key"], "id").select(
        "id", F.lit(seed_run_id).cast("bigint").alias("seed_run_id"), *_EXPECTED, t.alias("created_at")
    )
    return ledger.with_tables(
        issuances=changed.unionByName(clone_rows),
        issuance_histories=ledger.issuance_histories.select(*added_rows.columns).unionByName(added_rows),
        issuance_usages=ledger.issuance_usages.select(*used_rows.columns).unionByName(used_rows),
        coupon_stocks=stocks,
        expected_findings=labelled,
        coupon_stats=None,
    )
