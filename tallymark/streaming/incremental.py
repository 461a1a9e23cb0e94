"""Verifying what changed since the last run, from what that run stored.

A run stores one row per issuance: its replayed state, its last event, its open usages and whether it counts as live; the
live units of every coupon; and the links of chains it found broken. The next run reads the events of its window only. For an
issuance they touch, the stored row stands for all earlier events: its state is what the window's first event must follow, its
counts are what the window changes, and its broken links are still broken. The history is taken to be append-only: an event
that comes in later but is dated before the watermark is seen by a full run alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark import contract as C
from tallymark.functions.times import ntz
from tallymark.operators import replay, rules, skew, sweep
from tallymark.operators.ledger import Ledger
from tallymark.sources import store

ISSUANCE_STATE = "issuance_id bigint, state string, last_history_id bigint, last_event_at timestamp_ntz, active_usage_count bigint, coupon_id bigint, live bigint"
COUPON_STATE = "coupon_id bigint, live bigint"
CHAIN_STATE = "issuance_id bigint, id bigint, previous string, from_status string, event_type string, to_status string"


@dataclass(frozen=True)
class State:
    """What is known of a ledger at an instant."""

    watermark: replay.AsOf
    issuances: DataFrame
    coupons: DataFrame
    chains: DataFrame


def _coupons(issuances: DataFrame) -> DataFrame:
    return issuances.where("coupon_id IS NOT NULL").groupBy("coupon_id").agg(F.sum("live").cast("bigint").alias("live"))


def _kept(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The issuance rows and broken links of swept rows, from one pass that is written once."""
    live = F.when(F.col("state_0.state").isin(*C.LIVE_STATES), F.col("counted")).otherwise(0)
    last = {
        "issuance_id": F.col("issuance_id"), "state": F.col("state_0.state"), "last_history_id": F.col("state_0.id"),
        "last_event_at": F.col("state_0.at"), "active_usage_count": F.col("units_0"), "coupon_id": F.col("coupon"), "live": live,
    }
    link = {n: F.col(n) for n in ("issuance_id", "id", "previous", "from_status", "event_type", "to_status")}

    def part(columns: dict[str, Column], ddl: str, holds: Column) -> Column:
        return F.when(holds, F.struct(*[columns[f.name].cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(ddl)]))

    known = F.col("state_0.id").isNotNull() | (F.col("units_0") > 0)
    both = rows.select(
        part(last, ISSUANCE_STATE, F.col("is_last") & known).alias("last"), part(link, CHAIN_STATE, sweep.broken_link()).alias("link")
    ).where("last IS NOT NULL OR link IS NOT NULL")
    both = store.staged(both, "swept")
    return both.where("last IS NOT NULL").select("last.*"), both.where("link IS NOT NULL").select("link.*")


def state_at(ledger: Ledger, as_of: replay.AsOf) -> State:
    """The state by a full replay, in one pass."""
    rows = (
        sweep.events(ledger.issuance_histories, [as_of])
        .unionByName(sweep.open_usages(ledger.issuance_usages, [as_of]))
        .unionByName(sweep.snapshots(ledger.issuances))
    )
    issuances, chains = _kept(sweep.passed(rows))
    return State(as_of, issuances, store.staged(_coupons(issuances), "coupon-state"), chains)


def save(state: State, root: str) -> None:
    """The tables under a folder named by the watermark."""
    folder = _folder(root, state.watermark)
    state.issuances.write.mode("overwrite").parquet(f"{folder}/issuances")
    state.coupons.write.mode("overwrite").parquet(f"{folder}/coupons")
    state.chains.write.mode("overwrite").parquet(f"{folder}/chains")


def _folder(root: str, watermark: replay.AsOf) -> str:
    return f"{root}/state/" + str(watermark).replace(":", "-").replace(" ", "T")


def load(spark: SparkSession, root: str, watermark: replay.AsOf) -> State:
    folder = _folder(root, watermark)
    return State(
        watermark,
        spark.read.schema(ISSUANCE_STATE).parquet(f"{folder}/issuances"),
        spark.read.schema(COUPON_STATE).parquet(f"{folder}/coupons"),
        spark.read.schema(CHAIN_STATE).parquet(f"{folder}/chains"),
    )


def _inside(at: str, from_ts, as_of) -> Column:
    return (F.col(at) > ntz(from_ts)) & (F.col(at) <= ntz(as_of))


def touched_issuances(ledger: Ledger, from_ts, as_of) -> DataFrame:
    """issuance_id of everything with an event, usage or update in (from_ts, as_of]."""
    u = ledger.issuance_usages
    parts = [
        ledger.issuance_histories.where(_inside("created_at", from_ts, as_of)).select("issuance_id"),
        u.where(_inside("used_at", from_ts, as_of) | _inside("canceled_at", from_ts, as_of)).select("issuance_id"),
        ledger.issuances.where(_inside("updated_at", from_ts, as_of)).select(F.col("id").alias("issuance_id")),
    ]
    return reduce(DataFrame.unionByName, parts).distinct()


def _small(keys: DataFrame) -> DataFrame:
    """Marked for broadcast if counted and small, else left to a shuffled join."""
    return F.broadcast(keys) if skew.is_small(keys) else keys


def _changed(ledger: Ledger, state: State, as_of, ids: DataFrame, touched: DataFrame) -> DataFrame:
    """Rows for ``sweep``: the stored row of each touched issuance, the window's events and usage changes, the snapshots."""
    stored = state.issuances.join(ids, "issuance_id", "left_semi")
    usages = ledger.issuance_usages.where(
        _inside("used_at", state.watermark, as_of) | _inside("canceled_at", state.watermark, as_of)
    )
    active = lambda t: F.when(replay.active_at("used_at", "canceled_at", t), 1).otherwise(0)
    parts = [
        sweep._rows(
            stored, sweep.STORED, issuance_id="issuance_id", at="last_event_at", id="last_history_id", to_status="state",
            seen=F.lit(1), n="active_usage_count", live="live",
        ),
        sweep.events(ledger.issuance_histories, [as_of], state.watermark),
        sweep._rows(usages, sweep.USAGE, issuance_id="issuance_id", seen=F.lit(1), n=active(as_of) - active(state.watermark)),
        sweep.snapshots(touched),
    ]
    return reduce(DataFrame.unionByName, parts)


def incremental_findings(ledger: Ledger, from_ts, as_of, state: State | None = None) -> DataFrame:
    """What a full run would find about the touched issuances and their coupons.

    Chain, state, usage and grade rules look at touched issuances; the stock and
    duplicate rules, whose subject is a coupon, at all issuances of the touched
    issuances' coupons. Without a stored state one is made by a full replay first.
    """
    state = state_at(ledger, from_ts) if state is None else state
    if state.watermark != from_ts:
        raise ValueError(f"the state is of {state.watermark}, the window begins at {from_ts}")
    ids = _small(store.staged(touched_issuances(ledger, from_ts, as_of), "touched"))
    touched = ledger.issuances.join(ids.withColumnRenamed("issuance_id", "id"), "id", "left_semi")
    coupons = _small(store.staged(touched.select("coupon_id").distinct(), "touched"))
    told = (
        sweep.clues(sweep.passed(_changed(ledger, state, as_of, ids, touched)), changes=True)
        .unionByName(sweep.stored_counters(ledger.coupon_stocks.join(coupons, "coupon_id", "left_semi")))
        .unionByName(sweep.live_units(state.coupons.join(coupons, "coupon_id", "left_semi")))
        .unionByName(sweep.broken_earlier(state.chains.join(ids, "issuance_id", "left_semi")))
    )
    same_coupon = ledger.issuances.join(coupons, "coupon_id", "left_semi")
    parts = [
        sweep.findings(told).drop("instant"),
        rules.dup_per_member(same_coupon),
        rules.grade_violation(touched, ledger.coupons, ledger.grades),
    ]
    return reduce(DataFrame.unionByName, parts)


def advanced(ledger: Ledger, state: State, as_of) -> State:
    """The state at ``as_of`` from the stored one and the events in between; equal to a full replay's."""
    ids = _small(store.staged(touched_issuances(ledger, state.watermark, as_of), "touched"))
    touched = ledger.issuances.join(ids.withColumnRenamed("issuance_id", "id"), "id", "left_semi")
    fresh, broken = _kept(sweep.passed(_changed(ledger, state, as_of, ids, touched)))
    rows = store.staged(state.issuances.join(ids, "issuance_id", "left_anti").unionByName(fresh), "issuance-state")
    return State(as_of, rows, store.staged(_coupons(rows), "coupon-state"), store.staged(state.chains.unionByName(broken), "chain-state"))
