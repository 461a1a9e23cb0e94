"""The ledger's seventeen tables: columns, keys and checks.

Fixed values: files written by other producers of this ledger format follow
the same names, order and types. Types are declared once and serve the Parquet
readers, the TSV format and the audits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# kind -> Spark type. dt6 keeps microseconds, dt whole seconds, time is HH:mm:ss text
KINDS = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "byte": T.ByteType(),
    "str": T.StringType(),
    "dt6": T.TimestampNTZType(),
    "dt": T.TimestampNTZType(),
    "time": T.StringType(),
    "bin": T.BinaryType(),
    "bool": T.BooleanType(),
}


@dataclass(frozen=True)
class Col:
    name: str
    kind: str
    required: bool
    length: int | None


def _need(kind: str, *names: str, length: int | None = None) -> list[Col]:
    return [Col(n, kind, True, length) for n in names]


def _may(kind: str, *names: str, length: int | None = None) -> list[Col]:
    return [Col(n, kind, False, length) for n in names]


_POLICY = [
    *_need("str", "policy_type", length=20),
    *_may("int", "discount_rate", "max_discount_amount", "discount_amount", "data_grant_mb", "min_order_amount"),
    *_need("int", "valid_days"),
]
_REFERENCES = _may("long", "campaign_id", "member_id", "coupon_id", "history_id")

TABLES: dict[str, list[Col]] = {
    "grades": [*_need("str", "code", length=10), *_need("byte", "bit_value")],
    "brands": [*_need("long", "id"), *_need("str", "name", length=50), *_need("str", "category", length=20)],
    "coupon_templates": [
        *_need("long", "id", "brand_id"),
        *_need("str", "name", length=100),
        *_POLICY,
        *_may("byte", "nth_week"),
        *_may("str", "day_of_week", length=3),
        *_may("time", "start_time"),
        *_may("int", "duration_hours"),
        *_need("int", "stock_per_occurrence"),
        *_need("byte", "eligible_grades_mask"),
        *_need("bool", "active"),
    ],
    "coupons": [
        *_need("long", "id", "template_id", "brand_id"),
        *_need("str", "name", length=100),
        *_POLICY,
        *_need("byte", "eligible_grades_mask"),
        *_need("dt", "open_at", "close_at"),
        *_need("str", "status", length=20),
        *_need("dt6", "created_at"),
    ],
    "coupon_stocks": [
        *_need("long", "coupon_id"),
        *_need("int", "total_quantity", "active_count"),
        *_need("dt", "updated_at"),
    ],
    "members": [
        *_need("long", "id"),
        *_need("str", "membership_grade", length=10),
        *_may("bin", "name_enc", "email_enc", length=256),
        *_may("str", "email_hash", length=64),
        *_may("bin", "phone_enc", length=256),
        *_may("str", "phone_hash", length=64),
        *_need("dt6", "created_at"),
    ],
    "issuances": [
        *_need("long", "id", "coupon_id", "member_id"),
        *_need("str", "code", length=16),
        *_need("str", "issued_grade", length=10),
        *_need("str", "status", length=12),
        *_need("dt6", "issued_at", "expires_at", "updated_at"),
    ],
    "issuance_histories": [
        *_need("long", "id", "issuance_id"),
        *_need("str", "event_type", length=30),
        *_may("str", "from_status", length=20),
        *_need("str", "to_status", length=20),
        *_may("str", "reason", length=120),
        *_may("str", "request_id", length=36),
        *_need("dt6", "created_at"),
    ],
    "issuance_usages": [
        *_need("long", "id", "issuance_id"),
        *_may("long", "order_id"),
        *_need("int", "discount_amount"),
        *_need("dt", "used_at"),
        *_may("dt", "canceled_at"),
    ],
    "idempotency_records": [
        *_need("str", "idem_key", length=36),
        *_need("long", "member_id", "issuance_id"),
        *_need("str", "request_hash", length=64),
        *_need("str", "status", length=12),
        *_may("str", "response_body"),
        *_need("dt6", "created_at"),
    ],
    "verification_runs": [
        *_need("long", "id"),
        *_need("dt6", "as_of"),
        *_may("dt6", "from_ts"),
        *_need("str", "scope", length=12),
        *_need("str", "dataset", length=10),
        *_may("long", "seed_run_id"),
        *_need("int", "attempt"),
        *_may("str", "verdict", length=8),
        *_may("str", "stats_status", length=10),
        *_need("int", "finding_count"),
        *_may("str", "findings_checksum", "dataset_fingerprint", length=64),
        *_need("dt6", "started_at"),
        *_may("dt6", "finished_at"),
        *_need("str", "origin", length=6),
    ],
    "verification_findings": [
        *_need("long", "id", "run_id"),
        *_need("str", "finding_type", length=40),
        *_need("str", "target_key", length=64),
        *_REFERENCES,
        *_need("str", "expected", "actual", length=200),
    ],
    "asof_state": [
        *_need("long", "run_id", "coupon_id"),
        *_need("str", "state", length=12),
        *_may("long", "last_history_id"),
        *_may("dt6", "last_event_at"),
        *_need("int", "active_usage_count"),
    ],
    "coupon_stats": [
        *_need("long", "run_id", "coupon_id"),
        *_need("int", "issued_total", "issued", "used", "cancelled", "expired"),
        *_may("int", "sold_out_seconds"),
    ],
    "grade_stats": [
        *_need("long", "run_id", "coupon_id"),
        *_need("str", "grade", length=10),
        *_need("int", "issued_total", "used_total"),
    ],
    "hourly_stats": [
        *_need("long", "run_id"),
        *_need("str", "day_of_week", length=3),
        *_need("byte", "hour"),
        *_need("int", "issued_total"),
    ],
    "expected_findings": [
        *_need("long", "id", "seed_run_id"),
        *_need("byte", "corrupt_type"),
        *_need("str", "finding_type", length=40),
        *_need("str", "target_key", length=64),
        *_REFERENCES,
        *_may("str", "note", length=200),
        *_need("dt6", "created_at"),
    ],
}

PRIMARY_KEYS = {
    **{t: ("id",) for t in TABLES},
    "grades": ("code",),
    "coupon_stocks": ("coupon_id",),
    "idempotency_records": ("idem_key",),
    "asof_state": ("run_id", "coupon_id"),
    "coupon_stats": ("run_id", "coupon_id"),
    "grade_stats": ("run_id", "coupon_id", "grade"),
    "hourly_stats": ("run_id", "day_of_week", "hour"),
}

UNIQUE_KEYS = (
    ("members", ("email_hash",)),
    ("coupons", ("template_id", "open_at")),
    ("verification_runs", ("as_of", "dataset", "scope", "attempt")),
    ("verification_findings", ("run_id", "finding_type", "target_key")),
    ("expected_findings", ("seed_run_id", "finding_type", "target_key")),
)
# faults 5 and 6 break these on purpose
UNIQUE_KEYS_CLEAN = (
    ("issuances", ("coupon_id", "member_id")),
    ("issuances", ("code",)),
)

FOREIGN_KEYS = (
    # child table, column, parent table, column
    ("members", "membership_grade", "grades", "code"),
    ("coupon_templates", "brand_id", "brands", "id"),
    ("coupons", "template_id", "coupon_templates", "id"),
    ("coupon_stocks", "coupon_id", "coupons", "id"),
    ("issuances", "coupon_id", "coupons", "id"),
    ("issuances", "member_id", "members", "id"),
    ("issuances", "issued_grade", "grades", "code"),
    ("issuance_histories", "issuance_id", "issuances", "id"),
    ("issuance_usages", "issuance_id", "issuances", "id"),
    ("idempotency_records", "member_id", "members", "id"),
    ("idempotency_records", "issuance_id", "issuances", "id"),
    ("verification_findings", "run_id", "verification_runs", "id"),
    ("asof_state", "run_id", "verification_runs", "id"),
    ("coupon_stats", "run_id", "verification_runs", "id"),
    ("coupon_stats", "coupon_id", "coupons", "id"),
    ("grade_stats", "run_id", "verification_runs", "id"),
    ("grade_stats", "coupon_id", "coupons", "id"),
    ("grade_stats", "grade", "grades", "code"),
    ("hourly_stats", "run_id", "verification_runs", "id"),
)

CHECKS = (
    ("verification_runs", "seed_run_id only for CORRUPT", "seed_run_id IS NULL OR dataset = 'CORRUPT'"),
    ("verification_runs", "origin", "origin IN ('SEED', 'BATCH')"),
    ("issuances", "status", "status IN ('ISSUED', 'USED', 'CANCELLED', 'EXPIRED')"),
)
CHECKS_CLEAN = (
    ("coupon_stocks", "stock range", "active_count >= 0 AND active_count <= total_quantity"),
)


def schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c.name, KINDS[c.kind], True) for c in TABLES[table]])
