"""The six integrity rules and what is done with their findings.

Every rule returns the same columns. A finding is identified by
(finding_type, target_key); ``expected`` and ``actual`` are for reading only.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.rows import fixed_rows
from tallymark import contract as C
from tallymark.functions.text import target_key
from tallymark.operators import replay, skew, sweep
from tallymark.operators.ledger import Ledger
from tallymark.operators.stats import live_counts

IDENTITY = ["finding_type", "target_key"]
REFERENCES = ["campaign_id", "member_id", "coupon_id", "history_id"]


def _finding(
    df: DataFrame,
    finding_type: str,
    key: Column,
    expected: Column,
    actual: Column,
    **references: Column,
) -> DataFrame:
    # in findings campaign_id is a coupon's id and coupon_id an issuance's id
    return df.select(
        F.lit(finding_type).alias("finding_type"),
        key.alias("target_key"),
        expected.alias("expected"),
        actual.alias("actual"),
        *[references.get(n, F.lit(None)).cast("bigint").alias(n) for n in REFERENCES],
    )


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def distinct_findings(findings: DataFrame) -> DataFrame:
    """One row per identity; of several texts the smallest, so runs agree. Findings dealt by IDENTITY stay where they are."""
    rest = [c for c in findings.columns if c not in IDENTITY]
    one = findings.groupBy(*IDENTITY).agg(F.min(F.struct(*rest)).alias("_row"))
    return one.select(*IDENTITY, *[F.col("_row").getField(c).alias(c) for c in rest])


def stock_mismatch(stocks: DataFrame, digest: DataFrame) -> DataFrame:
    """V1: stored live counter differs from the replayed one, per coupon.

    Driven by the stock table; issuances without history are not counted.
    """
    live = live_counts(digest).withColumnRenamed("active_count", "live")
    both = stocks.select("coupon_id", "active_count").join(live, "coupon_id", "left")
    live_count = F.coalesce("live", F.lit(0).cast("bigint"))
    wrong = both.where(F.col("active_count") != live_count)
    return _finding(
        wrong,
        C.STOCK_MISMATCH,
        target_key((C.KEY_COUPON, F.col("coupon_id"))),
        _text("active_count=", F.col("active_count")),
        _text(C.TEXT_LIVE_COUNT, live_count),
        campaign_id=F.col("coupon_id"),
    )


def repeated_members(issuances: DataFrame, hot: skew.Hot | None = None) -> DataFrame:
    """V2 first branch: one member holds several issuances of one coupon.

    Pairs known not to be hot hardly repeat and are not combined before the shuffle.
    """
    rows = issuances.select("id", "coupon_id", "member_id")
    if hot is not None and not hot:
        rows = skew.dealt(rows, hot.rows, "coupon_id", "member_id")
    groups = (
        rows.groupBy("coupon_id", "member_id")
        .agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last_id"))
        .where("n > 1")
    )
    before, after = C.TEXT_N_ISSUES
    return _finding(
        groups,
        C.DUP_PER_MEMBER,
        target_key((C.KEY_COUPON, F.col("coupon_id")), (C.KEY_MEMBER, F.col("member_id"))),
        F.lit(C.TEXT_ONE_ISSUE),
        _text(before, F.col("n"), after),
        campaign_id=F.col("coupon_id"),
        member_id=F.col("member_id"),
        coupon_id=F.col("last_id"),
    )


def repeated_codes(issuances: DataFrame, hot: skew.Hot | None = None) -> DataFrame:
    """V2 second branch: a code repeats in a coupon; all but the lowest id."""
    rows = issuances.select("id", "coupon_id", "member_id", "code")
    kept = skew.group_minimum(rows, ["coupon_id", "code"], "id", "keep", hot=hot)
    before, after = C.TEXT_DUP_CODE
    return _finding(
        kept.where("id > keep"),
        C.DUP_PER_MEMBER,
        target_key((C.KEY_COUPON, F.col("coupon_id")), (C.KEY_MEMBER, F.col("member_id"))),
        F.lit(C.TEXT_UNIQUE_CODE),
        _text(before, F.col("code"), after),
        campaign_id=F.col("coupon_id"),
        member_id=F.col("member_id"),
        coupon_id=F.col("id"),
    )


def dup_per_member(issuances: DataFrame, hot: skew.Hot | None = None, hot_members: skew.Hot | None = None) -> DataFrame:
    """V2: both branches, one row per key. ``hot``: pairs of coupon and code, ``hot_members``: of coupon and member."""
    both = repeated_members(issuances, hot_members).unionByName(repeated_codes(issuances, hot))
    if hot_members is not None and not hot_members:  # so few findings have one key
        both = skew.dealt(both, hot_members.rows, *IDENTITY)
    return distinct_findings(both)


def replay_mismatch(digest: DataFrame) -> DataFrame:
    """V3: stored status differs from the replayed state.

    Needs history: an issuance without any is not compared.
    """
    # status/status_high are equal unless the primary key is violated
    odd = F.when(F.col("status") != F.col("state"), F.col("status")).otherwise(
        F.when(F.col("status_high") != F.col("state"), F.col("status_high"))
    )
    return _finding(
        digest.where(odd.isNotNull()),
        C.REPLAY_MISMATCH,
        target_key((C.KEY_ISSUANCE, F.col("issuance_id"))),
        _text("replay=", F.col("state")),
        _text("issuances.status=", odd),
        coupon_id=F.col("issuance_id"),
    )


def illegal_transition(chained: DataFrame, log: replay.EventLog = replay.LEDGER_LOG) -> DataFrame:
    """V4: a link that does not follow from the event before, or is no legal step.

    Takes the output of ``replay.chain`` and reads nothing else, so events of
    unknown issuances are judged like any other.
    """
    broken = ~F.col("previous").eqNullSafe(F.col(log.before))
    return _finding(
        chained.where(broken | sweep.illegal(log)),
        C.ILLEGAL_TRANSITION,
        target_key((log.target, F.col(log.id))),
        _text("from_status=", F.coalesce("previous", F.lit(C.TEXT_NO_PREVIOUS))),
        _text(
            "from_status=",
            F.coalesce(log.before, F.lit(C.TEXT_NULL_FROM)),
            ", ",
            F.col(log.event),
            "->",
            F.col(log.after),
        ),
        history_id=F.col(log.id),
    )


def usage_mismatch(digest: DataFrame) -> DataFrame:
    """V5: active usages differ from what the replayed state allows.

    Compares replay with usages; the stored status is not looked at.
    """
    due = F.when(F.col("state") == C.USED, 1).otherwise(0)
    return _finding(
        digest.where(F.col("state").isNotNull() & (F.col("active_usage_count") != due)),
        C.USAGE_MISMATCH,
        target_key((C.KEY_ISSUANCE, F.col("issuance_id"))),
        _text("active_usage=", due),
        _text("active_usage=", F.col("active_usage_count")),
        coupon_id=F.col("issuance_id"),
    )


def grade_violation(
    issuances: DataFrame,
    coupons: DataFrame,
    grades: DataFrame,
    hot: skew.Hot | None = None,
) -> DataFrame:
    """V6: the grade snapshot of an issuance is not in its coupon's mask."""
    masks = coupons.select(
        F.col("id").cast("bigint").alias("coupon_id"),
        F.col("eligible_grades_mask").cast("int").alias("mask"),
    )
    bits = grades.select(F.col("code").alias("issued_grade"), F.col("bit_value").cast("int").alias("bit"))
    facts = issuances.select("id", F.col("coupon_id").cast("bigint"), "issued_grade")
    graded = skew.lookup_join(facts, bits, ["issued_grade"])
    joined = skew.lookup_join(graded, masks, ["coupon_id"], hot=hot)
    return _finding(
        joined.where(F.col("mask").bitwiseAND(F.col("bit")) == 0),
        C.GRADE_VIOLATION,
        target_key((C.KEY_ISSUANCE, F.col("id"))),
        _text("mask & bit != 0 (mask=", F.col("mask"), ")"),
        _text("issued_grade=", F.col("issued_grade")),
        campaign_id=F.col("coupon_id"),
        coupon_id=F.col("id"),
    )


_STATE_RULES = {C.STOCK_MISMATCH: 1, C.REPLAY_MISMATCH: 3, C.USAGE_MISMATCH: 5}


def state_findings(stocks: DataFrame, digest: DataFrame, only: Iterable[str] = tuple(_STATE_RULES)) -> DataFrame:
    """V1, V3 and V5 from one pass over the replayed state.

    Each issuance contributes what it shows: one live unit of its coupon, a
    wrong status, a wrong usage count. Stored counters join in as rows, and one
    aggregate, combined map-side, brings counter and live units together.
    """
    wanted = [_STATE_RULES[name] for name in only if name in _STATE_RULES]
    state, count = F.col("state"), F.col("active_usage_count")
    due = F.when(state == C.USED, 1).otherwise(0)
    odd = F.when(F.col("status") != state, F.col("status")).when(F.col("status_high") != state, F.col("status_high"))

    def clue(rule: int, subject: Column, holds: Column, odd: Column | None = None, live: Column | None = None, stored: Column | None = None) -> Column:
        none = F.lit(None)
        return F.when(
            holds,
            F.struct(
                F.lit(rule).alias("rule"),
                subject.cast("bigint").alias("subject"),
                (none if rule == 1 else state).cast("string").alias("state"),
                (none if odd is None else odd).cast("string").alias("odd"),
                (none if live is None else live).cast("bigint").alias("live"),
                (none if stored is None else stored).cast("bigint").alias("stored"),
            ),
        )

    clues = {
        1: clue(1, F.col("coupon_id"), state.isin(*C.LIVE_STATES) & (F.col("snapshots") > 0), live=F.col("snapshots")),
        3: clue(3, F.col("issuance_id"), odd.isNotNull(), odd=odd),
        5: clue(5, F.col("issuance_id"), state.isNotNull() & (count != due), stored=count),
    }
    rows = digest.select(F.explode(F.array(*[clues[r] for r in wanted])).alias("c")).where("c IS NOT NULL").select("c.*")
    if 1 in wanted:
        none = F.lit(None)
        rows = rows.unionByName(
            stocks.select(
                F.lit(1).alias("rule"),
                F.col("coupon_id").cast("bigint").alias("subject"),
                none.cast("string").alias("state"),
                none.cast("string").alias("odd"),
                none.cast("bigint").alias("live"),
                F.col("active_count").cast("bigint").alias("stored"),
            )
        )
    met = rows.groupBy("rule", "subject", "state", "odd").agg(F.sum("live").alias("live"), F.max("stored").alias("stored"))
    live = F.coalesce("live", F.lit(0).cast("bigint"))
    wrong = met.where((F.col("rule") != 1) | (F.col("stored") != live))
    rule, subject = F.col("rule"), F.col("subject")
    by_rule = lambda one, three, five: F.when(rule == 1, one).when(rule == 3, three).otherwise(five)
    coupon, issuance = (F.concat(F.lit(f"{k}:"), subject.cast("string")) for k in (C.KEY_COUPON, C.KEY_ISSUANCE))
    none = F.lit(None).cast("bigint")
    return wrong.select(
        by_rule(F.lit(C.STOCK_MISMATCH), F.lit(C.REPLAY_MISMATCH), F.lit(C.USAGE_MISMATCH)).alias("finding_type"),
        F.when(rule == 1, coupon).otherwise(issuance).alias("target_key"),
        by_rule(_text("active_count=", F.col("stored")), _text("replay=", state), _text("active_usage=", due)).alias("expected"),
        by_rule(
            _text(C.TEXT_LIVE_COUNT, live), _text("issuances.status=", F.col("odd")), _text("active_usage=", F.col("stored"))
        ).alias("actual"),
        F.when(rule == 1, subject).otherwise(none).alias("campaign_id"),
        none.alias("member_id"),
        F.when(rule != 1, subject).otherwise(none).alias("coupon_id"),
        none.alias("history_id"),
    )


def run_rules(ledger: Ledger, as_of: replay.AsOf, only: Iterable[str] = C.FINDING_TYPES) -> DataFrame:
    """All findings of the chosen rules.

    One row per (finding_type, target_key) as long as primary keys hold. Lazy,
    but for bounded probes of key sizes.
    """
    return rules_at(ledger, [as_of], only).drop("instant")


def rules_at(ledger: Ledger, instants: Sequence[replay.AsOf], only: Iterable[str] = C.FINDING_TYPES) -> DataFrame:
    """Findings at every instant, with the instant's number in ``instant``, from one scan of the history.

    State and chain come from one pass (``sweep``). An issuance too large for one task's sort is not swept: then state comes
    from a mergeable aggregate and the chain from ranges, instant by instant.
    """
    only = [name for name in C.FINDING_TYPES if name in set(only)]
    parts = []
    swept = [n for n, name in sweep.RULES.items() if name in only]
    if 4 in swept and ledger.hot("issuance_histories", "issuance_id"):
        hot = ledger.hot("issuance_histories", "issuance_id")
        for j, t in enumerate(instants):
            own = [illegal_transition(replay.chain(ledger.issuance_histories, t, hot=hot))]
            if set(only) & set(_STATE_RULES):
                digest = replay.digest(ledger.issuance_histories, t, ledger.issuances, ledger.issuance_usages)
                own.append(state_findings(ledger.coupon_stocks, digest, only))
            parts += [part.withColumn("instant", F.lit(j)) for part in own]
    elif 4 not in swept and swept:  # nothing is ordered: the aggregate ships one row per issuance and map task
        for j, t in enumerate(instants):
            digest = replay.digest(ledger.issuance_histories, t, ledger.issuances, ledger.issuance_usages)
            parts.append(state_findings(ledger.coupon_stocks, digest, only).withColumn("instant", F.lit(j)))
    elif swept == [4] and len(instants) == 1:
        chained = replay.chain(ledger.issuance_histories, instants[0], hot=skew.Hot(("issuance_id",)))
        parts.append(illegal_transition(chained).withColumn("instant", F.lit(0)))
    elif swept:
        parts.append(
            sweep.state_and_chain(
                ledger.issuance_histories, ledger.issuance_usages, ledger.issuances, ledger.coupon_stocks, instants, swept,
                ledger.history_rows(),
            )
        )
    # these two do not look at time: what they find holds at every instant
    timeless = []
    if C.DUP_PER_MEMBER in only:
        hot = ledger.hot("issuances", "coupon_id", "code")
        timeless.append(dup_per_member(ledger.issuances, hot, ledger.hot("issuances", "coupon_id", "member_id")))
    if C.GRADE_VIOLATION in only:
        timeless.append(grade_violation(ledger.issuances, ledger.coupons, ledger.grades))
    every = F.explode(F.array(*[F.lit(j) for j in range(len(instants))]))
    parts += [part.withColumn("instant", every if len(instants) > 1 else F.lit(0)) for part in timeless]
    return reduce(DataFrame.unionByName, parts)


#: Rules whose findings can differ between two instants.
TIMED = (C.STOCK_MISMATCH, C.REPLAY_MISMATCH, C.ILLEGAL_TRANSITION, C.USAGE_MISMATCH)


def finding_counts(findings: DataFrame) -> DataFrame:
    """Findings per rule; rules without any show 0."""
    spark = findings.sparkSession
    names = fixed_rows(spark, [(t,) for t in C.FINDING_TYPES], "finding_type string")
    counted = findings.groupBy("finding_type").agg(F.count(F.lit(1)).alias("finding_count"))
    return (
        counted.join(F.broadcast(names), "finding_type", "right")  # six names
        .select("finding_type", F.coalesce("finding_count", F.lit(0).cast("bigint")).alias("finding_count"))
    )
