"""One ordered pass over everything known of an issuance, for one or several instants.

Stored state, history, usages and snapshot are stacked, shuffled once by issuance and sorted once. Within an issuance they
come in this order, history by (created_at, id), so that

* ``lag`` is the status before each event; where a stored state stands for all earlier events, it is their last one,
* running aggregates at the last row are the replayed states, usage counts and snapshot values.

Findings of the stock, replay, transition and usage rules follow from the same rows. An instant only decides which rows count:
states and counts of several instants are columns side by side, so a second instant costs no second scan, shuffle or sort.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark import contract as C
from tallymark.functions.times import ntz
from tallymark.operators import replay, skew

STORED, EVENT, USAGE, SNAPSHOT = range(4)
#: The columns of stacked rows. ``seen`` has a bit for each instant at which the row counts, ``n`` is a number of usages.
ROW = {
    "issuance_id": "bigint",
    "kind": "int",
    "at": "timestamp_ntz",
    "id": "bigint",
    "event_type": "string",
    "from_status": "string",
    "to_status": "string",
    "seen": "int",
    "n": "bigint",
    "live": "bigint",
    "coupon_id": "bigint",
    "status": "string",
}
MOST_INSTANTS = 30
CELLS_PER_TASK = 32
#: Rules that this pass decides, by their number.
RULES = {1: C.STOCK_MISMATCH, 3: C.REPLAY_MISMATCH, 4: C.ILLEGAL_TRANSITION, 5: C.USAGE_MISMATCH}


def _rows(df: DataFrame, kind: int, **given: Column | str) -> DataFrame:
    """A table in the columns of ROW."""
    value = lambda name: given[name] if isinstance(given.get(name), Column) else F.col(given[name])
    known = {**{n: value(n) for n in given}, "kind": F.lit(kind)}
    return df.select(*[known.get(name, F.lit(None)).cast(type_).alias(name) for name, type_ in ROW.items()])


def _bits(holds: Sequence[Column]) -> Column:
    """An integer with bit j set where the j-th condition holds."""
    return reduce(lambda a, b: a.bitwiseOR(b), [F.when(c, F.lit(1 << j)).otherwise(0) for j, c in enumerate(holds)])


def events(histories: DataFrame, instants: Sequence[replay.AsOf], after: replay.AsOf | None = None) -> DataFrame:
    """History rows up to the latest instant, later than ``after`` if given; both bounds reach the scan."""
    seen = [F.col("created_at") <= ntz(t) for t in instants]
    rows = histories.where(reduce(lambda a, b: a | b, seen)) if len(instants) > 1 else histories.where(seen[0])
    if after is not None:
        rows = rows.where(F.col("created_at") > ntz(after))
    return _rows(
        rows, EVENT, issuance_id="issuance_id", at="created_at", id="id", event_type="event_type", from_status="from_status",
        to_status="to_status", seen=_bits(seen),
    )


def open_usages(usages: DataFrame, instants: Sequence[replay.AsOf]) -> DataFrame:
    """Usages that are active at some instant."""
    active = [replay.active_at("used_at", "canceled_at", t) for t in instants]
    rows = usages.where(reduce(lambda a, b: a | b, active))
    return _rows(rows, USAGE, issuance_id="issuance_id", seen=_bits(active), n=F.lit(1))


def snapshots(issuances: DataFrame) -> DataFrame:
    return _rows(issuances, SNAPSHOT, issuance_id="id", coupon_id="coupon_id", status="status")


def passed(rows: DataFrame, instants: int = 1, within: Sequence[str] = ()) -> DataFrame:
    """Rows of ROW with ``previous``, ``is_last`` of its issuance and, up to the row, the replayed values.

    state_j (a struct, null without any event), units_j, counted (snapshots), coupon, low and high (of stored statuses), and
    was_live (of the stored state). ``within``: columns that an issuance's rows agree in, by which they are dealt already.
    """
    order = Window.partitionBy(*within, "issuance_id").orderBy("kind", "at", "id")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = [F.col("seen").bitwiseAND(F.lit(1 << j)) != 0 for j in range(instants)]
    told = F.col("kind").isin(STORED, EVENT)
    columns = {
        "previous": F.lag("to_status").over(order),
        "is_last": F.lead("kind").over(order).isNull(),
        "counted": F.count(F.when(F.col("kind") == SNAPSHOT, 1)).over(so_far),
        "coupon": F.max("coupon_id").over(so_far),
        "low": F.min("status").over(so_far),
        "high": F.max("status").over(so_far),
        "was_live": F.sum("live").over(so_far),
    }
    for j, counts in enumerate(seen):
        last = F.when(told & counts, F.struct(F.col("to_status").alias("state"), F.col("id").alias("id"), F.col("at").alias("at")))
        columns[f"state_{j}"] = F.last(last, ignorenulls=True).over(so_far)
        columns[f"units_{j}"] = F.coalesce(F.sum(F.when(counts, F.col("n"))).over(so_far), F.lit(0).cast("bigint"))
    return rows.select("*", *[c.alias(name) for name, c in columns.items()])


def illegal(log: replay.EventLog = replay.LEDGER_LOG) -> Column:
    """Not in the transition table. A NULL ``before`` is the start of a chain."""
    legal = F.lit(False)
    for before, event, after in log.transitions:
        legal = legal | (
            F.coalesce(log.before, F.lit("")).eqNullSafe(F.lit(before or ""))
            & F.col(log.event).eqNullSafe(F.lit(event))
            & F.col(log.after).eqNullSafe(F.lit(after))
        )
    return ~legal


def broken_link() -> Column:
    """An event that does not follow the one before, or is no legal step."""
    return (F.col("kind") == EVENT) & (~F.col("previous").eqNullSafe(F.col("from_status")) | illegal())


_CLUE = {"rule": "int", "instant": "int", "subject": "bigint", "live": "bigint", "stored": "bigint"} | {p: "string" for p in "abcd"}


KEYS = ["rule", "instant", "subject", "a", "b", "c", "d"]


def _clue(holds: Column, **given: Column) -> Column:
    fields = [given.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in _CLUE.items()]
    return F.when(holds, F.struct(*fields))


def clues(
    rows: DataFrame, instants: int = 1, only: Iterable[int] = tuple(RULES), changes: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """What the rules can tell of each row of ``passed``: findings of rules 3, 4 and 5, and live units of coupons (1).

    With ``changes`` live units are counted against those of the stored state.
    """
    found = []
    broken = broken_link()
    here = F.col("is_last")
    for j in range(instants):
        state, units = F.col(f"state_{j}.state"), F.col(f"units_{j}")
        due = F.when(state == C.USED, 1).otherwise(0)
        odd = F.when(F.col("low") != state, F.col("low")).when(F.col("high") != state, F.col("high"))
        live = F.when(state.isin(*C.LIVE_STATES), F.col("counted")).otherwise(0)
        live = live - F.coalesce("was_live", F.lit(0)) if changes else live
        counts = F.col("seen").bitwiseAND(F.lit(1 << j)) != 0
        told = {
            1: (here & F.col("coupon").isNotNull() & (live != 0), {"subject": F.col("coupon"), "live": live}),
            3: (here & odd.isNotNull(), {"subject": F.col("issuance_id"), "a": state, "b": odd}),
            4: (
                counts & broken,
                {"subject": F.col("id"), "a": F.col("previous"), "b": F.col("from_status"), "c": F.col("event_type"), "d": F.col("to_status")},
            ),
            5: (
                here & state.isNotNull() & (units != due),
                {"subject": F.col("issuance_id"), "stored": units, "a": state},
            ),
        }
        found += [_clue(told[rule][0], rule=F.lit(rule), instant=F.lit(j), **told[rule][1]) for rule in only]
    return rows.select(*keep, F.explode(F.array(*found)).alias("clue")).where("clue IS NOT NULL").select(*keep, "clue.*")


def stored_counters(stocks: DataFrame, instants: int = 1) -> DataFrame:
    """The stock table as clues of every instant, to meet the live units of its coupons."""
    given = {"rule": F.lit(1), "instant": F.col("j"), "subject": F.col("coupon_id"), "stored": F.col("active_count")}
    rows = stocks.select("coupon_id", "active_count", F.explode(F.array(*[F.lit(j) for j in range(instants)])).alias("j"))
    return rows.select(*[given.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in _CLUE.items()])


def broken_earlier(links: DataFrame) -> DataFrame:
    """Broken links known from an earlier run, as clues of the first instant."""
    given = {
        "rule": F.lit(4), "instant": F.lit(0), "subject": F.col("id"),
        "a": F.col("previous"), "b": F.col("from_status"), "c": F.col("event_type"), "d": F.col("to_status"),
    }
    return links.select(*[given.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in _CLUE.items()])


def live_units(coupons: DataFrame) -> DataFrame:
    """coupon_id, live: units counted earlier, as clues of the first instant."""
    given = {"rule": F.lit(1), "instant": F.lit(0), "subject": F.col("coupon_id"), "live": F.col("live")}
    return coupons.select(*[given.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in _CLUE.items()])


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def findings(told: DataFrame) -> DataFrame:
    """instant and the columns of a finding, from clues of all kinds. One aggregate, combined before its shuffle.

    A coupon is reported when its stored counter is known and differs from its live units.
    """
    met = told.groupBy(*KEYS).agg(F.sum("live").alias("live"), F.max("stored").alias("stored"))
    rule, subject, state = F.col("rule"), F.col("subject"), F.col("a")
    live = F.coalesce("live", F.lit(0).cast("bigint"))
    wrong = met.where((rule != 1) | (F.col("stored") != live))
    by_rule = lambda one, three, four, five: F.when(rule == 1, one).when(rule == 3, three).when(rule == 4, four).otherwise(five)
    key = lambda name: F.concat(F.lit(f"{name}:"), subject.cast("string"))
    none = F.lit(None).cast("bigint")
    due = F.when(state == C.USED, 1).otherwise(0)
    before = F.coalesce(state, F.lit(C.TEXT_NO_PREVIOUS))
    step = _text("from_status=", F.coalesce("b", F.lit(C.TEXT_NULL_FROM)), ", ", F.col("c"), "->", F.col("d"))
    return wrong.select(
        "instant",
        by_rule(*[F.lit(RULES[r]) for r in (1, 3, 4, 5)]).alias("finding_type"),
        by_rule(key(C.KEY_COUPON), key(C.KEY_ISSUANCE), key(C.KEY_HISTORY), key(C.KEY_ISSUANCE)).alias("target_key"),
        by_rule(
            _text("active_count=", F.col("stored")), _text("replay=", state), _text("from_status=", before), _text("active_usage=", due)
        ).alias("expected"),
        by_rule(
            _text(C.TEXT_LIVE_COUNT, live), _text("issuances.status=", F.col("b")), step, _text("active_usage=", F.col("stored"))
        ).alias("actual"),
        F.when(rule == 1, subject).otherwise(none).alias("campaign_id"),
        none.alias("member_id"),
        F.when(rule.isin(3, 5), subject).otherwise(none).alias("coupon_id"),
        F.when(rule == 4, subject).otherwise(none).alias("history_id"),
    )


def state_and_chain(
    histories: DataFrame,
    usages: DataFrame,
    issuances: DataFrame,
    stocks: DataFrame,
    instants: Sequence[replay.AsOf],
    only: Iterable[int] = tuple(RULES),
    known_rows: int | None = None,
) -> DataFrame:
    """Findings of the chosen rules at every instant, with the instant's number.

    Dealt by cells of issuances, a coupon's live units are added up cell by cell before the second shuffle. Both shuffles
    have a number of tasks that follows from ``known_rows`` of the history, so a task's rows do not grow with the table.
    """
    if not 0 < len(instants) <= MOST_INSTANTS:
        raise ValueError(f"between 1 and {MOST_INSTANTS} instants, not {len(instants)}")
    rows = events(histories, instants).unionByName(open_usages(usages, instants)).unionByName(snapshots(issuances))
    cells = skew.pieces_for(rows, known_rows) * CELLS_PER_TASK
    rows = skew.dealt(rows.withColumn("cell", F.pmod(F.xxhash64("issuance_id"), F.lit(cells))), known_rows, "cell")
    told = clues(passed(rows, len(instants), ["cell"]), len(instants), only, keep=["cell"])
    if 1 in only:
        summed = told.groupBy("cell", *KEYS).agg(F.sum("live").alias("live"), F.max("stored").alias("stored"))
        told = summed.drop("cell").unionByName(stored_counters(stocks, len(instants)))
    return findings(skew.dealt(told, known_rows, *KEYS))
