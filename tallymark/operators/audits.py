"""Constraint audits: keys, references, checks, required values, lengths.

Spark stores no constraints, so these find what a database would refuse. All
are aggregates with map-side combine: a repeated or missing value that fills a
third of a table arrives at its reducer as one row per map task.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark import contract as C
from tallymark.functions.rows import fixed_rows
from tallymark.operators.ledger import Ledger
from tallymark.sources import schemas


def _shape(df: DataFrame, constraint: str, key: Column, violations: Column) -> DataFrame:
    return df.select(
        F.lit(constraint).alias("constraint_name"),
        key.cast("string").alias("offender"),
        violations.cast("bigint").alias("violations"),
    )


def _key_text(columns: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in columns])


def repeated_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Groups of more than one row: key columns, n, least id if there is one."""
    extra = [F.min("id").alias("keep")] if "id" in df.columns and "id" not in columns else []
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"), *extra).where("n > 1")


def audit_unique(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Keys held by several rows. NULL in a key never violates."""
    known = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))
    return _shape(repeated_keys(known.select(*columns), columns), f"unique {name}", _key_text(columns), F.col("n"))


def audit_fk(child: DataFrame, column: str, parent: DataFrame, parent_column: str, name: str) -> DataFrame:
    """Child values without a parent, with the number of child rows.

    Both sides are stacked and aggregated instead of joined.
    """
    kind = dict(child.dtypes)[column]
    refs = child.where(F.col(column).isNotNull()).select(
        F.col(column).alias("k"), F.lit(1).alias("refs"), F.lit(0).alias("known")
    )
    known = parent.where(F.col(parent_column).isNotNull()).select(
        F.col(parent_column).cast(kind).alias("k"), F.lit(0).alias("refs"), F.lit(1).alias("known")
    )
    lost = (
        refs.unionByName(known)
        .groupBy("k")
        .agg(F.sum("refs").alias("refs"), F.max("known").alias("known"))
        .where("known = 0")
    )
    return _shape(lost, f"fk {name}", F.col("k"), F.col("refs"))


def audit_check(df: DataFrame, predicate: str | Column, key: Sequence[str], name: str) -> DataFrame:
    """Rows for which the predicate is false; NULL passes, as in SQL."""
    condition = F.expr(predicate) if isinstance(predicate, str) else predicate
    bad = df.where(~condition).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return _shape(bad, f"check {name}", _key_text(key), F.col("n"))


def audit_required(
    df: DataFrame,
    name: str,
    required: Sequence[str] = (),
    lengths: Mapping[str, int] | None = None,
) -> DataFrame:
    """Counts of missing values and of values over their length, one pass."""
    counters = {f"not null {name}.{c}": F.count_if(F.col(c).isNull()) for c in required}
    for c, limit in (lengths or {}).items():
        counters[f"length {name}.{c}"] = F.count_if(F.length(c) > limit)
    one = df.agg(*[expr.alias(f"c{i}") for i, expr in enumerate(counters.values())])
    rows = F.array(
        *[
            F.struct(F.lit(label).alias("label"), F.col(f"c{i}").alias("n"))
            for i, label in enumerate(counters)
        ]
    )
    return one.select(F.explode(rows).alias("r")).select(
        F.col("r.label").alias("constraint_name"),
        F.lit(None).cast("string").alias("offender"),
        F.col("r.n").cast("bigint").alias("violations"),
    )


@dataclass(frozen=True)
class Unique:
    name: str
    table: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Reference:
    name: str
    table: str
    column: str
    parent: str
    parent_column: str
    null_is_lost: bool = False  # a database lets a NULL reference pass


@dataclass(frozen=True)
class Check:
    """Rows for which the predicate is false; they are told by ``key``, or counted together without one."""

    name: str
    table: str
    predicate: str
    key: tuple[str, ...] = ()
    columns: tuple[str, ...] = ()  # that the predicate reads


Constraint = Unique | Reference | Check


def declared(dataset: str) -> list[Constraint]:
    """Every constraint of the schema; CLEAN has three more."""
    clean = dataset == "CLEAN"
    found: list[Constraint] = []
    uniques = [*((t, k) for t, k in schemas.PRIMARY_KEYS.items()), *schemas.UNIQUE_KEYS, *(schemas.UNIQUE_KEYS_CLEAN if clean else ())]
    found += [Unique(f"unique {t}({', '.join(columns)})", t, columns) for t, columns in uniques]
    found += [Reference(f"fk {c}.{column} -> {p}.{key}", c, column, p, key) for c, column, p, key in schemas.FOREIGN_KEYS]
    for table, name, predicate in (*schemas.CHECKS, *(schemas.CHECKS_CLEAN if clean else ())):
        read = tuple(c.name for c in schemas.TABLES[table] if re.search(rf"\b{c.name}\b", predicate))
        found.append(Check(f"check {table} {name}", table, predicate, schemas.PRIMARY_KEYS[table], read))
    for table, columns in schemas.TABLES.items():
        found += [Check(f"not null {table}.{c.name}", table, f"{c.name} IS NOT NULL", (), (c.name,)) for c in columns if c.required]
        found += [Check(f"length {table}.{c.name}", table, f"length({c.name}) <= {c.length}", (), (c.name,)) for c in columns if c.length]
    return found


def _lacking(c: Constraint, tables: Mapping[str, DataFrame]) -> str | None:
    """What a constraint needs and is not there."""
    needs = [(c.table, c.columns if not isinstance(c, Reference) else (c.column,))]
    needs += [(c.table, c.key)] if isinstance(c, Check) else [(c.parent, (c.parent_column,))] if isinstance(c, Reference) else []
    for table, columns in needs:
        if table not in tables:
            return f"table {table} is absent"
        for column in columns:
            if column not in tables[table].columns:
                return f"column {table}.{column} is absent"
    return None


OWN, FAILED = -1, -2


def violations(tables: Mapping[str, DataFrame], constraints: Sequence[Constraint]) -> DataFrame:
    """constraint_name, offender, violations of all constraints together: every table is scanned once, one aggregate decides.

    Each row tells the keys it holds, the keys it refers to and the checks it fails. A key and all references to it meet in
    one group, combined before the shuffle: held twice, it is not unique; referred to and not held, it is lost.
    Constraints that cannot be checked give a row with NULL violations and the reason in the place of the offender.
    """
    absent = [(c.name, reason) for c in constraints if (reason := _lacking(c, tables))]
    active = [c for c in constraints if not _lacking(c, tables)]
    spaces: dict[tuple[str, tuple[str, ...]], int] = {}
    held: dict[int, str] = {}  # space -> name of its unique constraint
    referring: dict[int, list[Reference]] = {}
    failing: dict[int, str] = {}
    told: dict[str, list[Column]] = {}

    def space(table: str, columns: tuple[str, ...]) -> int:
        return spaces.setdefault((table, columns), len(spaces))

    def tell(table: str, number: int, key: Column, slot: int, holds: Column) -> None:
        row = F.struct(F.lit(number).alias("space"), key.cast("string").alias("key"), F.lit(slot).alias("slot"))
        told.setdefault(table, []).append(F.when(holds, row))

    known = lambda columns: reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    for c in active:
        if isinstance(c, Unique):
            held[space(c.table, c.columns)] = c.name
        elif isinstance(c, Reference):
            number = space(c.parent, (c.parent_column,))
            referring.setdefault(number, []).append(c)
            tell(c.table, number, F.col(c.column), len(referring[number]) - 1, F.lit(True) if c.null_is_lost else F.col(c.column).isNotNull())
    for (table, columns), number in list(spaces.items()):
        tell(table, number, _key_text(columns), OWN, known(columns))
    for c in active:
        if isinstance(c, Check):
            number = space("", (c.name,))
            failing[number] = c.name
            tell(c.table, number, _key_text(c.key) if c.key else F.lit(None), FAILED, ~F.expr(c.predicate))
    parts = [
        tables[table].select(F.explode(F.array(*rows)).alias("k")).where("k IS NOT NULL").select("k.*") for table, rows in told.items()
    ]
    outcome = "constraint_name string, offender string, violations bigint"
    spark = next(iter(tables.values())).sparkSession
    unchecked = fixed_rows(spark, [(name, reason, None) for name, reason in absent], outcome) if absent else None
    if not parts:
        return unchecked if unchecked is not None else fixed_rows(spark, [("", "", 0)], outcome).limit(0)
    most = max(map(len, referring.values()), default=0)
    met = reduce(DataFrame.unionByName, parts).groupBy("space", "key").agg(
        F.count_if(F.col("slot") == OWN).alias("own"),
        F.count_if(F.col("slot") == FAILED).alias("failed"),
        *[F.count_if(F.col("slot") == k).alias(f"r{k}") for k in range(most)],
    )
    name_of = lambda names: F.get(F.array(*[F.lit(names.get(i)).cast("string") for i in range(len(spaces))]), F.col("space"))
    case = lambda name, n, holds: F.when(holds & name.isNotNull(), F.struct(name.alias("constraint_name"), n.alias("violations")))
    cases = [case(name_of(held), F.col("own"), F.col("own") > 1), case(name_of(failing), F.col("failed"), F.col("failed") > 0)]
    for k in range(most):
        names = {i: refs[k].name for i, refs in referring.items() if len(refs) > k}
        cases.append(case(name_of(names), F.col(f"r{k}"), (F.col("own") == 0) & (F.col(f"r{k}") > 0)))
    bad = met.select("key", F.explode(F.array(*cases)).alias("v")).where("v IS NOT NULL")
    found = bad.select("v.constraint_name", F.col("key").alias("offender"), F.col("v.violations").alias("violations"))
    return found if unchecked is None else found.unionByName(unchecked)


def audit_tables(tables: Mapping[str, DataFrame], dataset: str) -> DataFrame:
    """Every declared constraint, those that cannot be checked included; see ``violations``."""
    return violations(tables, declared(dataset))


# --------------------------------------------------------------------------- #
# invariants: one count each
# --------------------------------------------------------------------------- #

def _counted(label: str, df: DataFrame, count: Column | None = None) -> DataFrame:
    n = F.count(F.lit(1)) if count is None else F.coalesce(count, F.lit(0))
    return df.agg(n.cast("bigint").alias("violations")).select(F.lit(label).alias("invariant"), "violations")


def duplicate_email(members: DataFrame) -> DataFrame:
    return _counted("duplicate email_hash", repeated_keys(members.select("email_hash"), ["email_hash"]))


def active_range(stocks: DataFrame) -> DataFrame:
    bad = stocks.where("active_count < 0 OR active_count > total_quantity")
    return _counted("active_count range", bad)


def orphans(label: str, child: DataFrame, issuances: DataFrame) -> DataFrame:
    """Child rows (NULL references included) whose issuance does not exist."""
    lost = audit_fk(child, "issuance_id", issuances, "id", label).select("violations")
    unset = child.where("issuance_id IS NULL").agg(F.count(F.lit(1)).alias("violations"))
    return _counted(label, lost.unionByName(unset), F.sum("violations"))


def status_vocabulary(issuances: DataFrame) -> DataFrame:
    return _counted("status vocabulary", issuances.where(~F.col("status").isin(*C.STATUSES)))


def funnel_matches_stock(coupon_stats: DataFrame, stocks: DataFrame) -> DataFrame:
    both = coupon_stats.select("coupon_id", "issued", "used").join(
        stocks.select("coupon_id", "active_count"), "coupon_id"
    )
    return _counted("issued + used = active_count", both.where("issued + used <> active_count"))


def funnel_sum(coupon_stats: DataFrame) -> DataFrame:
    bad = coupon_stats.where("issued + used + cancelled + expired <> issued_total")
    return _counted("funnel sums to issued_total", bad)


def duplicate_code(issuances: DataFrame) -> DataFrame:
    return _counted("duplicate code", repeated_keys(issuances.select("code"), ["code"]))


_INVARIANTS: tuple[tuple[str, Constraint], ...] = (
    ("duplicate email_hash", Unique("duplicate email_hash", "members", ("email_hash",))),
    (
        "active_count range",
        Check("active_count range", "coupon_stocks", "NOT (active_count < 0 OR active_count > total_quantity)", ("coupon_id",), ("active_count", "total_quantity")),
    ),
    ("orphan histories", Reference("orphan histories", "issuance_histories", "issuance_id", "issuances", "id", null_is_lost=True)),
    ("orphan usages", Reference("orphan usages", "issuance_usages", "issuance_id", "issuances", "id", null_is_lost=True)),
    ("status vocabulary", Check("status vocabulary", "issuances", f"status IN {C.STATUSES}", (), ("status",))),
)
_INVARIANTS_CLEAN = (("duplicate code", Unique("duplicate code", "issuances", ("code",))),)
FUNNEL = ("issued + used = active_count", "funnel sums to issued_total")


def check_invariants(ledger: Ledger, dataset: str) -> DataFrame:
    """invariant, violations of every invariant: five, and three more for CLEAN.

    NULL violations tell that a table is missing, so nothing is known. One scan of each table, as for constraints; a key held
    several times counts once, a lost reference as often as it occurs.
    """
    wanted = [*_INVARIANTS, *(_INVARIANTS_CLEAN if dataset == "CLEAN" else ())]
    spark = ledger.issuances.sparkSession
    names = [label for label, _ in wanted]
    found = violations(ledger.tables(), [c for _, c in wanted]).groupBy(F.col("constraint_name").alias("invariant")).agg(
        F.when(F.count_if(F.col("violations").isNull()) == 0, F.sum(F.when(F.col("constraint_name").startswith("duplicate"), 1).otherwise(F.col("violations")))).alias("violations"),
        F.count(F.lit(1)).alias("rows"),
    )
    labels = fixed_rows(spark, [(n,) for n in names], "invariant string")
    # at most one row per invariant on either side
    counted = labels.join(found, "invariant", "left").select(
        "invariant", F.when(F.col("rows").isNull(), F.lit(0)).otherwise(F.col("violations")).cast("bigint").alias("violations")
    )
    if dataset != "CLEAN":
        return counted
    if ledger.coupon_stats is None:
        unknown = fixed_rows(spark, [(n, None) for n in FUNNEL], "invariant string, violations bigint")
        return counted.unionByName(unknown)
    return counted.unionByName(funnel_matches_stock(ledger.coupon_stats, ledger.coupon_stocks)).unionByName(funnel_sum(ledger.coupon_stats))
