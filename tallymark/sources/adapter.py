"""A ledger view of an order book: orders become issuances, line items events.

Deliberately untidy data on which every rule fires; used to compare the rules
with plain SQL on the same tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.rows import fixed_rows
from tallymark.contract import GRADE_BITS
from tallymark.functions.text import issue_code
from tallymark.functions.times import plus_days
from tallymark.operators.ledger import Ledger
from tallymark.operators.replay import EventLog
from tallymark.operators.skew import dealt, hot_keys, lag_in_group
from tallymark.operators.stats import coupon_funnel
from tallymark.sources.store import staged

AS_OF = "1999-01-01 00:00:00"
GRADES = (("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 4), ("4-NOT SPECIFIED", 8), ("5-LOW", 16))


# declared, so that reading starts no schema inference job
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def coupon_of(ts):
    return (F.year(ts) * 100 + F.month(ts)).cast("bigint")


def issuances(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        coupon_of(F.col("o_orderdate")).alias("coupon_id"),
        F.col("o_custkey").alias("member_id"),
        F.concat(F.lit("CP"), (F.col("o_orderkey") % 997).cast("string")).alias("code"),
        F.col("o_orderpriority").alias("issued_grade"),
        F.when(F.col("o_orderstatus") == "F", "USED")
        .when(F.col("o_orderstatus") == "O", "ISSUED")
        .otherwise("EXPIRED")
        .alias("status"),
        F.col("o_orderdate").alias("issued_at"),
        plus_days(F.col("o_orderdate"), F.lit(90)).alias("expires_at"),
        F.col("o_orderdate").alias("updated_at"),
    )


def _place(value: str, *known: str) -> Column:
    """Where a text lies among known ones, as a number that grows with the text: 1, 3, .. are the known ones themselves."""
    place = F.when(F.col(value).isNotNull(), 2 * len(known))
    for i, text in reversed(list(enumerate(sorted(known)))):
        place = F.when(F.col(value) < text, 2 * i).when(F.col(value) == text, 2 * i + 1).otherwise(place)
    return place


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (order, line number): the source repeats some.

    Largest flag and status as places among A, R and F: numbers aggregate without sorting, and no other value is asked for.
    """
    raw = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", _place("l_returnflag", "A", "R").alias("flag"), _place("l_linestatus", "F").alias("status")
    )
    keys = ["l_orderkey", "l_linenumber"]
    hot = hot_keys(raw, keys)
    found = (raw if hot else dealt(raw, hot.rows, *keys)).groupBy(*keys).agg(
        F.min("l_shipdate").alias("ship"), F.max("flag").alias("flag"), F.max("status").alias("status")
    )
    return found.select(
        *keys,
        "ship",
        F.when(F.col("flag") == 1, "A").when(F.col("flag") == 3, "R").when(F.col("flag").isNotNull(), "other").alias("flag"),
        F.when(F.col("status") == 1, "F").when(F.col("status").isNotNull(), "other").alias("line_status"),
    )


def histories(spark: SparkSession, sf_dir: str, per_line: DataFrame | None = None) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    first = o.select(
        (F.col("o_orderkey") * 100).alias("id"),
        F.col("o_orderkey").alias("issuance_id"),
        F.lit("ISSUE").alias("event_type"),
        F.lit(None).cast("string").alias("from_status"),
        F.lit("ISSUED").alias("to_status"),
        F.col("o_orderdate").alias("created_at"),
    )
    used, back = F.col("flag") == "A", F.col("flag") == "R"
    later = (lines(spark, sf_dir) if per_line is None else per_line).select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("issuance_id"),
        F.when(used, "USE").when(back, "CANCEL_USE").otherwise("EXPIRE").alias("event_type"),
        F.when(back, "USED").otherwise("ISSUED").alias("from_status"),
        F.when(used, "USED").when(back, "ISSUED").otherwise("EXPIRED").alias("to_status"),
        F.col("ship").alias("created_at"),
    )
    return first.unionByName(later)


def usages(spark: SparkSession, sf_dir: str, per_line: DataFrame | None = None) -> DataFrame:
    return (
        (lines(spark, sf_dir) if per_line is None else per_line)
        .where("flag = 'A'")
        .select(
            (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"),
            F.col("l_orderkey").alias("issuance_id"),
            F.col("ship").alias("used_at"),
            F.when(F.col("line_status") == "F", plus_days(F.col("ship"), F.lit(30))).alias("canceled_at"),
        )
    )


def coupons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        issuances(spark, sf_dir)
        .groupBy(F.col("coupon_id").alias("id"))
        .agg(F.min("issued_at").alias("open_at"))
        .withColumn("eligible_grades_mask", F.col("id") % 31 + 1)
    )


def stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.count(F.lit(1))
    live = F.sum(F.when(F.col("status").isin("ISSUED", "USED"), 1).otherwise(0))
    rest = F.col("coupon_id") % 3
    return (
        issuances(spark, sf_dir)
        .groupBy("coupon_id")
        .agg(n.alias("n"), live.cast("bigint").alias("active_count"))
        .select(
            "coupon_id",
            F.when(rest == 0, F.col("n") + 5)
            .when(rest == 1, F.col("n"))
            .otherwise(F.floor(F.col("n") * 0.66))
            .cast("bigint")
            .alias("total_quantity"),
            "active_count",
        )
    )


def grades(spark: SparkSession) -> DataFrame:
    return fixed_rows(spark, list(GRADES), "code string, bit_value int")


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers; some grades do not exist, and address hashes repeat."""
    names = F.array(*[F.lit(g) for g, _ in GRADES], F.lit("NONE"))
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.get(names, F.col("c_nationkey") % 6).alias("membership_grade"),
        F.sha2(F.concat("c_mktsegment", (F.col("c_custkey") % 700).cast("string")), 256).alias("email_hash"),
        F.lit("1992-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
    )


def ledger(spark: SparkSession, sf_dir: str, stored: bool = True) -> Ledger:
    """``stored``: lines are written once, for jobs that read histories and usages several times."""
    per_line = lines(spark, sf_dir)
    per_line = staged(per_line, "lines") if stored else per_line
    base = Ledger(
        coupons=coupons(spark, sf_dir),
        grades=grades(spark),
        coupon_stocks=stocks(spark, sf_dir),
        issuances=issuances(spark, sf_dir),
        issuance_histories=histories(spark, sf_dir, per_line),
        issuance_usages=usages(spark, sf_dir, per_line),
    )
    funnel = coupon_funnel(base.coupons, base.issuances, base.coupon_stocks)
    return base.with_tables(
        members=members(spark, sf_dir), coupon_stats=funnel.select(F.lit(1).cast("bigint").alias("run_id"), *funnel.columns)
    )



# --------------------------------------------------------------------------- #
# the same orders as a tidy ledger, on which no rule fires
# --------------------------------------------------------------------------- #

TIDY_AS_OF = "2003-01-01 00:00:00"


def tidy_ledger(spark: SparkSession, sf_dir: str) -> Ledger:
    """Coupons are the weeks of a year, so that there are several hundred."""
    week = (F.floor((F.dayofyear("o_orderdate") - 1) / 7) + 1).cast("bigint")
    o = table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") + 1).alias("id"),
        (F.year("o_orderdate").cast("bigint") * 100 + week).alias("coupon_id"),
        F.col("o_orderdate").alias("issued_at"),
        F.col("o_orderstatus"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
    )
    open_to_all = F.col("coupon_id") % 2 == 0
    grade = (
        F.when(open_to_all & (F.col("priority") == 1), "WELCOME")
        .when(open_to_all & (F.col("priority") == 2), "SILVER")
        .when(F.col("priority") <= 3, "GOLD")
        .otherwise("VIP")
    )
    status = F.when(F.col("o_orderstatus") == "F", "USED").when(F.col("o_orderstatus") == "O", "ISSUED").otherwise("EXPIRED")
    base = o.withColumn("status", status).withColumn("expires_at", plus_days(F.col("issued_at"), F.lit(30)))
    used_at = plus_days(F.col("issued_at"), F.lit(10))
    changed_at = F.when(F.col("status") == "USED", used_at).when(F.col("status") == "EXPIRED", F.col("expires_at"))
    issued = base.select(
        "id",
        "coupon_id",
        F.col("id").alias("member_id"),
        issue_code(F.col("id")).alias("code"),
        grade.alias("issued_grade"),
        "status",
        "issued_at",
        "expires_at",
        F.coalesce(changed_at, F.col("issued_at")).alias("updated_at"),
    )
    none = F.lit(None).cast("string")
    first = base.select(
        (F.col("id") * 2).alias("id"),
        F.col("id").alias("issuance_id"),
        F.lit("ISSUE").alias("event_type"),
        none.alias("from_status"),
        F.lit("ISSUED").alias("to_status"),
        none.alias("reason"),
        none.alias("request_id"),
        F.col("issued_at").alias("created_at"),
    )
    second = base.where("status <> 'ISSUED'").select(
        (F.col("id") * 2 + 1).alias("id"),
        F.col("id").alias("issuance_id"),
        F.when(F.col("status") == "USED", "USE").otherwise("EXPIRE").alias("event_type"),
        F.lit("ISSUED").alias("from_status"),
        F.col("status").alias("to_status"),
        none.alias("reason"),
        none.alias("request_id"),
        changed_at.alias("created_at"),
    )
    per_coupon = base.groupBy("coupon_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") != "EXPIRED").alias("live"), F.min("issued_at").alias("t")
    )
    day = F.date_trunc("day", "t").cast("timestamp_ntz")
    return Ledger(
        coupons=per_coupon.select(
            F.col("coupon_id").alias("id"),
            F.when(open_to_all, 15).otherwise(12).alias("eligible_grades_mask"),
            day.alias("open_at"),
            plus_days(day, F.lit(28)).alias("close_at"),
            F.lit(30).alias("valid_days"),
        ),
        grades=fixed_rows(spark, list(GRADE_BITS.items()), "code string, bit_value int"),
        coupon_stocks=per_coupon.select(
            "coupon_id",
            (F.col("n") + 100).cast("int").alias("total_quantity"),
            F.col("live").cast("int").alias("active_count"),
            F.lit(TIDY_AS_OF).cast("timestamp_ntz").alias("updated_at"),
        ),
        issuances=issued,
        issuance_histories=first.unionByName(second),
        issuance_usages=base.where("status = 'USED'").select(
            "id",
            F.col("id").alias("issuance_id"),
            F.lit(None).cast("bigint").alias("order_id"),
            F.lit(0).alias("discount_amount"),
            used_at.alias("used_at"),
            F.lit(None).cast("timestamp_ntz").alias("canceled_at"),
        ),
        members=base.select("id"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read as verification runs."""
    o = table(spark, sf_dir, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        key.alias("id"),
        F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("as_of"),
        F.when(F.col("o_orderstatus") == "F", "CORRUPT").otherwise("CLEAN").alias("dataset"),
        F.when(F.col("o_orderpriority") == "5-LOW", "INCREMENTAL").otherwise("FULL").alias("scope"),
        F.when(F.col("o_orderstatus") == "P", "PARTIAL").otherwise("COMPLETE").alias("stats_status"),
        (cust % 5 + 1).cast("int").alias("attempt"),
        F.when(F.col("o_totalprice") < 250_000, "SEED").otherwise("BATCH").alias("origin"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("finished_at"),
        F.sha2((cust % 3).cast("string"), 256).alias("dataset_fingerprint"),
        F.sha2((cust % 2).cast("string"), 256).alias("findings_checksum"),
    )


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as an event log: each turn leads from role to role."""
    c = table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 10_000 + F.col("turn")).alias("id"), "conv_id", "turn", F.col("role").alias("to_status")
    )
    linked = lag_in_group(c, "conv_id", ("turn",), "to_status", "from_status")
    return linked.withColumn("event_type", F.lit("TURN"))


TURN_TRANSITIONS = (
    (None, "TURN", "system"),
    (None, "TURN", "user"),
    ("system", "TURN", "user"),
    ("user", "TURN", "assistant"),
    ("assistant", "TURN", "user"),
)


def turn_log(transitions=TURN_TRANSITIONS) -> EventLog:
    return EventLog(key="conv_id", at=None, order=("turn", "id"), target="TURN", transitions=transitions)
