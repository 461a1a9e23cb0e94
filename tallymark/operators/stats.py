"""Statistics of a ledger, computed from its stored tables.

Dimension-driven: coupons without issuances and empty hours get their zero row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.rows import fixed_rows
from tallymark import contract as C
from tallymark.functions.times import ntz, seconds_between, weekday
from tallymark.operators.replay import AsOf


def coupon_funnel(coupons: DataFrame, issuances: DataFrame, stocks: DataFrame) -> DataFrame:
    """Per coupon: issued_total, one count per status, sold_out_seconds.

    sold_out_seconds runs from opening to the last issue and is NULL unless
    everything was issued.
    """
    counted = issuances.groupBy("coupon_id").agg(
        F.count(F.lit(1)).alias("issued_total"),
        *[F.count_if(F.col("status") == s).alias(s.lower()) for s in C.STATUSES],
        F.max("issued_at").alias("last_issue_at"),
    )
    total = F.coalesce("issued_total", F.lit(0))
    sold_out = (total >= F.col("total_quantity")) & F.col("last_issue_at").isNotNull()
    return (
        coupons.select(F.col("id").alias("coupon_id"), "open_at")
        .join(counted, "coupon_id", "left")
        .join(stocks.select("coupon_id", "total_quantity"), "coupon_id", "left")
        .select(
            "coupon_id",
            total.cast("bigint").alias("issued_total"),
            *[F.coalesce(s.lower(), F.lit(0)).cast("bigint").alias(s.lower()) for s in C.STATUSES],
            F.when(sold_out, seconds_between(F.col("open_at"), F.col("last_issue_at"))).alias("sold_out_seconds"),
        )
    )


def grade_stats(issuances: DataFrame) -> DataFrame:
    """Per coupon and grade snapshot that occurs: issued_total, used_total."""
    return issuances.groupBy("coupon_id", F.col("issued_grade").alias("grade")).agg(
        F.count(F.lit(1)).alias("issued_total"),
        F.count_if(F.col("status") == C.USED).alias("used_total"),
    )


def hourly_stats(events: DataFrame, event: str = "ISSUE", at: str = "created_at", kind: str = "event_type") -> DataFrame:
    """7 x 24 counts of one kind of event by UTC weekday and hour."""
    spark = events.sparkSession
    days = fixed_rows(spark, [(d,) for d in C.DAYS_OF_WEEK], "day_of_week string")
    grid = days.crossJoin(spark.range(24).select(F.col("id").cast("int").alias("hour")))
    counted = (
        events.where(F.col(kind) == event)
        .groupBy(weekday(F.col(at)).alias("day_of_week"), F.hour(at).alias("hour"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # both sides have at most 168 rows
    return F.broadcast(grid).join(counted, ["day_of_week", "hour"], "left").select(
        "day_of_week", "hour", F.coalesce("n", F.lit(0)).cast("bigint").alias("issued_total")
    )


def live_counts(digest: DataFrame) -> DataFrame:
    """Live issuances per coupon by replay: what active_count should be."""
    live = F.col("state").isin(*C.LIVE_STATES) & (F.col("snapshots") > 0)
    return digest.where(live).groupBy("coupon_id").agg(F.sum("snapshots").alias("active_count"))


def status_summary(issuances: DataFrame, stocks: DataFrame) -> DataFrame:
    """measure, value: rows per status, sum of live counters, sold-out coupons."""
    by_status = issuances.groupBy(F.concat(F.lit("status "), "status").alias("measure")).agg(
        F.count(F.lit(1)).alias("value")
    )
    live = stocks.agg(F.coalesce(F.sum("active_count"), F.lit(0)).cast("bigint").alias("value")).select(
        F.lit("sum active_count").alias("measure"), "value"
    )
    issued = issuances.groupBy("coupon_id").agg(F.count(F.lit(1)).alias("n"))
    full = stocks.select("coupon_id", "total_quantity").join(issued, "coupon_id").where("n >= total_quantity")
    sold = full.agg(F.count(F.lit(1)).alias("value")).select(F.lit("sold-out coupons").alias("measure"), "value")
    return by_status.unionByName(live).unionByName(sold)


def late_expiry(issuances: DataFrame, as_of: AsOf) -> DataFrame:
    """One row: issuances past their expiry that are still ISSUED.

    An observation, not a finding: the expiry job may simply not have run yet.
    """
    late = (F.col("expires_at") < ntz(as_of)) & (F.col("status") == C.ISSUED)
    return issuances.where(late).agg(F.count(F.lit(1)).alias("late_expiry"))


def expiring_within(issuances: DataFrame, as_of: AsOf, hours: int = 24) -> DataFrame:
    """Issuances whose expiry falls strictly inside the next ``hours``."""
    t = ntz(as_of)
    until = t + F.make_dt_interval(hours=F.lit(hours))
    return issuances.where((F.col("expires_at") > t) & (F.col("expires_at") < until))


def recent_only(records: DataFrame, as_of: AsOf, at: str = "created_at", hours: int = 24) -> DataFrame:
    """Records the clean-up keeps: those of the last ``hours``."""
    return records.where(F.col(at) > ntz(as_of) - F.make_dt_interval(hours=F.lit(hours)))


def latest_requests(requests: DataFrame, n: int, at: str = "created_at", tie: str = "request_id") -> DataFrame:
    """The n most recent rows; equal times are ordered by ``tie``."""
    return requests.orderBy(F.desc(at), F.asc(tie)).limit(n)


def run_summary(tables: dict[str, DataFrame], root: str) -> DataFrame:
    """measure, value of a ledger as it is written under ``root``: rows of each table, statuses, live counters, sold-out coupons.

    Rows, statuses and counters are counted by the writes themselves; no written table is scanned for them. Which coupons are
    sold out follows from ``coupon_stats`` and ``coupon_stocks``, one row per coupon.
    """
    from tallymark.sources.store import write_counted

    by_status = {f"status {s}": F.count_if(F.col("status") == s) for s in C.STATUSES}
    other = F.count_if(F.coalesce(~F.col("status").isin(*C.STATUSES), F.lit(True)))
    seen = write_counted(
        tables,
        root,
        {
            "issuances": {**by_status, "status of no vocabulary": other},
            "coupon_stocks": {"sum active_count": F.coalesce(F.sum("active_count"), F.lit(0)).cast("bigint")},
        },
    )
    rows = [(f"rows {name}", got["rows"]) for name, got in seen.items()]
    rows += [(m, n) for m, n in seen["issuances"].items() if m.startswith("status") and n]
    rows.append(("sum active_count", seen["coupon_stocks"]["sum active_count"]))
    spark = tables["issuances"].sparkSession
    stats_of = tables["coupon_stats"].select("coupon_id", "issued_total")
    full = stats_of.join(tables["coupon_stocks"].select("coupon_id", "total_quantity"), "coupon_id").where("issued_total >= total_quantity AND issued_total > 0")
    sold = full.agg(F.count(F.lit(1)).alias("value")).select(F.lit("sold-out coupons").alias("measure"), "value")
    return fixed_rows(spark, rows, "measure string, value bigint").unionByName(sold)


def stored_summary(tables: dict[str, DataFrame], issuances: DataFrame, stocks: DataFrame) -> DataFrame:
    """The same measures of a ledger that is written already: row counts by a scan of each table."""
    from tallymark.sources.store import row_counts

    rows = row_counts(tables).select(F.concat(F.lit("rows "), "table_name").alias("measure"), F.col("row_count").alias("value"))
    return rows.unionByName(status_summary(issuances, stocks))
