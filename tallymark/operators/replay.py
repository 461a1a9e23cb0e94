"""As-of replay of an event log: state, chain links and active intervals."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark import contract as C
from tallymark.functions.times import ntz
from tallymark.operators import skew

AsOf = str | dt.datetime


@dataclass(frozen=True)
class EventLog:
    """Names of an event log's columns and its legal transitions."""

    key: str = "issuance_id"
    id: str = "id"
    event: str = "event_type"
    before: str = "from_status"
    after: str = "to_status"
    at: str | None = "created_at"  # None: the log has no clock, ``order`` alone decides
    order: tuple[str, ...] = ("created_at", "id")
    target: str = C.KEY_HISTORY
    transitions: tuple[tuple[str | None, str, str], ...] = C.TRANSITIONS


LEDGER_LOG = EventLog()


def as_of_events(events: DataFrame, as_of: AsOf | None, log: EventLog = LEDGER_LOG) -> DataFrame:
    """Events at or before ``as_of``; the filter reaches the Parquet scan."""
    if as_of is None or log.at is None:
        return events
    return events.where(F.col(log.at) <= ntz(as_of))


def key_range(df: DataFrame, low: int, high: int, key: str = "issuance_id") -> DataFrame:
    """The slice of a table whose keys lie in [low, high], for a partial check.

    Whole keys are kept or left out, so replay and chain of a slice equal those
    of the whole table for its keys. A full run needs no slicing.
    """
    return df.where(F.col(key).between(low, high))


def replay_state(events: DataFrame, as_of: AsOf | None, log: EventLog = LEDGER_LOG) -> DataFrame:
    """Last state per key: issuance_id, state, last_history_id, last_event_at.

    An aggregate rather than a window: each map task ships one row per key, so
    a key with a third of all events costs its reducer no more than any other.
    """
    order = F.struct(*[F.col(c) for c in log.order])
    last = F.max_by(F.struct(log.after, log.id, *([log.at] if log.at else [])), order)
    out = as_of_events(events, as_of, log).groupBy(log.key).agg(last.alias("_last"))
    columns = [
        F.col(log.key),
        F.col("_last").getField(log.after).alias("state"),
        F.col("_last").getField(log.id).alias("last_history_id"),
    ]
    if log.at:
        columns.append(F.col("_last").getField(log.at).alias("last_event_at"))
    return out.select(*columns)


def chain(
    events: DataFrame,
    as_of: AsOf | None,
    log: EventLog = LEDGER_LOG,
    hot: skew.Hot | None = None,
) -> DataFrame:
    """Events with ``previous``, the ``after`` status of the event before."""
    columns = dict.fromkeys([log.key, log.id, log.event, log.before, log.after, *log.order])
    seen = as_of_events(events, as_of, log).select(*columns)
    return skew.lag_in_group(seen, log.key, log.order, log.after, "previous", hot=hot)


def active_at(start: str, end: str, as_of: AsOf) -> Column:
    """Interval [start, end) holds at ``as_of``; an open end never closes."""
    t = ntz(as_of)
    return (F.col(start) <= t) & (F.col(end).isNull() | (F.col(end) > t))


def active_usage_counts(usages: DataFrame, as_of: AsOf) -> DataFrame:
    return (
        usages.where(active_at("used_at", "canceled_at", as_of))
        .groupBy("issuance_id")
        .agg(F.count(F.lit(1)).alias("active_usage_count"))
    )


def asof_state(events: DataFrame, usages: DataFrame, as_of: AsOf, run_id: int = 1) -> DataFrame:
    """Rows of the ``asof_state`` table (its coupon_id holds issuance ids)."""
    both = digest(events, as_of, usages=usages).where("state IS NOT NULL")
    return both.select(
        F.lit(run_id).cast("bigint").alias("run_id"),
        F.col("issuance_id").alias("coupon_id"),
        "state",
        "last_history_id",
        "last_event_at",
        F.col("active_usage_count").cast("int").alias("active_usage_count"),
    )


def digest(
    events: DataFrame,
    as_of: AsOf,
    issuances: DataFrame | None = None,
    usages: DataFrame | None = None,
) -> DataFrame:
    """Everything the rules compare, one row per issuance id.

    History, usages and snapshot are stacked and aggregated together, so the
    three-way comparison needs one shuffle of map-side combined rows and no
    join that a heavy issuance could unbalance.
    """
    empty = {
        "_order": "struct<created_at: timestamp_ntz, id: bigint>",
        "to_status": "string",
        "_use": "bigint",
        "_snap": "bigint",
        "coupon_id": "bigint",
        "status": "string",
    }

    def stack(df: DataFrame, key: str, **given: Column) -> DataFrame:
        return df.select(
            F.col(key).cast("bigint").alias("issuance_id"),
            *[
                (given[name].cast(kind) if name in given else F.lit(None).cast(kind)).alias(name)
                for name, kind in empty.items()
            ],
        )

    parts = [
        stack(
            as_of_events(events, as_of),
            "issuance_id",
            _order=F.struct("created_at", "id"),
            to_status=F.col("to_status"),
        )
    ]
    if usages is not None:
        parts.append(
            stack(usages.where(active_at("used_at", "canceled_at", as_of)), "issuance_id", _use=F.lit(1))
        )
    if issuances is not None:
        given = {"_snap": F.lit(1), "status": F.col("status")}
        if "coupon_id" in issuances.columns:
            given["coupon_id"] = F.col("coupon_id")
        parts.append(stack(issuances, "id", **given))

    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    aggregates = [F.max(F.when(F.col("_order").isNotNull(), F.struct("_order", "to_status"))).alias("_last")]
    if usages is not None:
        aggregates.append(F.count("_use").alias("active_usage_count"))
    if issuances is not None:
        aggregates += [
            F.count("_snap").alias("snapshots"),
            F.max("coupon_id").alias("coupon_id"),
            F.min("status").alias("status"),
            F.max("status").alias("status_high"),
        ]
    out = stacked.groupBy("issuance_id").agg(*aggregates)
    return out.select(
        "issuance_id",
        F.col("_last.to_status").alias("state"),
        F.col("_last._order.id").alias("last_history_id"),
        F.col("_last._order.created_at").alias("last_event_at"),
        *[c for c in out.columns if c not in ("issuance_id", "_last")],
    )
