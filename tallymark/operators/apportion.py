"""Integer apportionment: exact totals under floors, caps and margins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.operators import skew
from tallymark.sources.store import checkpoint


def rebalance(
    df: DataFrame, order: Sequence[str], value: str, floor: str, cap: str, target: int | Column | DataFrame
) -> DataFrame:
    """Change ``value`` so that its total is ``target``, earliest rows first.

    Each row moves as far as its floor or cap allows before the next one does:
    a running total of the room before a row tells how much it takes.
    """
    if not isinstance(target, DataFrame):
        target = df.sparkSession.range(1).select((target if isinstance(target, Column) else F.lit(target)).alias("_target"))
    else:
        target = target.toDF("_target")
    sums = df.agg(
        F.coalesce(F.sum(value), F.lit(0)).alias("_total"),
        F.coalesce(F.sum(F.greatest(F.lit(0), F.col(cap) - F.col(value))), F.lit(0)).alias("_up"),
        F.coalesce(F.sum(F.greatest(F.lit(0), F.col(value) - F.col(floor))), F.lit(0)).alias("_down"),
    ).crossJoin(target)
    need = sums.select(
        (F.col("_target") - F.col("_total")).alias("_diff"),
        F.when(F.col("_target") >= F.col("_total"), F.col("_up")).otherwise(F.col("_down")).alias("_all_room"),
    )
    room = F.greatest(
        F.lit(0), F.when(F.col("_diff") >= 0, F.col(cap) - F.col(value)).otherwise(F.col(value) - F.col(floor))
    )
    roomy = df.crossJoin(F.broadcast(need)).withColumn("_room", room)  # one row
    before = skew.running_total(roomy, order, "_room", "_before")
    size = F.abs("_diff")
    moved = F.least(F.col("_room"), F.greatest(F.lit(0), size - F.col("_before"))) * F.signum("_diff").cast("bigint")
    checked = F.when(
        F.col("_all_room") < size,
        F.raise_error(F.concat(F.lit("cannot rebalance, short of "), (size - F.col("_all_room")).cast("string"))).cast("bigint"),
    ).otherwise((F.col(value) + moved).cast("bigint"))
    return before.withColumn(value, checked).drop("_diff", "_all_room", "_room", "_before")


def spread_quota(df: DataFrame, order: str, cap: str, need: int, name: str = "quota") -> DataFrame:
    """Hand out ``need`` units one per row and round, rows in order, up to caps.

    The number of full rounds is read off running totals over the different caps; the last, partial round goes to the
    first rows that still have capacity, found by numbering these. Rows without capacity get 0; when capacity is short
    everything is handed out. Nothing but one row of totals leaves the tasks.
    """
    capped = df.withColumn("_cap", F.greatest(F.lit(0), F.least(F.col(cap), F.lit(need))).cast("bigint"))
    caps = capped.where("_cap > 0").groupBy("_cap").agg(F.count(F.lit(1)).alias("_n"), F.sum("_cap").alias("_units"))
    below = skew.running_total(skew.running_total(caps, ["_cap"], "_units", "_given"), ["_cap"], "_n", "_closed")
    rows = F.broadcast(capped.agg(F.count_if(F.col("_cap") > 0).alias("_rows")))  # one row
    given = F.col("_given") + F.col("_cap") * (F.col("_rows") - F.col("_closed"))  # after as many rounds as the cap
    whole = F.when(given <= need, F.struct(F.col("_cap").alias("rounds"), given.alias("given"), (F.col("_rows") - F.col("_closed") - F.col("_n")).alias("left")))
    start = F.struct(F.lit(0).cast("bigint").alias("rounds"), F.lit(0).cast("bigint").alias("given"), F.coalesce(F.max("_rows"), F.lit(0)).cast("bigint").alias("left"))
    last = below.crossJoin(rows).agg(F.coalesce(F.max(whole), start).alias("last"))
    rest, still = need - F.col("last.given"), F.col("last.left")
    level = last.select(
        (F.col("last.rounds") + F.when(still > 0, F.floor(rest / still)).otherwise(0)).cast("bigint").alias("_rounds"),
        F.when(still > 0, rest % still).otherwise(0).cast("bigint").alias("_more"),
    )
    out = capped.crossJoin(F.broadcast(level)).withColumn(name, F.least("_cap", "_rounds"))  # one row
    done = out.where("_cap <= _rounds")
    numbered = skew.dense_number(out.where("_cap > _rounds"), [order], "_at")
    more = numbered.withColumn(name, F.col(name) + (F.col("_at") <= F.col("_more")).cast("bigint")).drop("_at")
    return done.unionByName(more).drop("_cap", "_rounds", "_more")


def rake(
    df: DataFrame, row_total: str, weights: str, column_totals: Sequence[float], name: str = "raked",
    rounds: int = 40, tolerance: float = 1e-7,
) -> DataFrame:
    """Scale ``weights`` (an array per row) to row totals and column totals.

    Iterative proportional fitting with one factor per column: a row's factor
    follows from the column factors, so a round is one aggregate of a few sums
    over the table, without a shuffle of its rows.
    """
    m = len(column_totals)
    factors = [1.0] * m
    base = df.select(F.col(row_total).cast("double").alias("t"), F.col(weights).alias("w")).persist()
    try:
        for _ in range(rounds):
            scaled = F.zip_with("w", F.array(*[F.lit(f) for f in factors]), lambda w, f: F.greatest(w, F.lit(0.0)) * f)
            total = F.aggregate("s", F.lit(0.0), lambda a, b: a + b)
            share = F.when(F.col("total") > 0, F.col("t") / F.col("total")).otherwise(0.0)
            sums = (
                base.select("t", scaled.alias("s"))
                .withColumn("total", total)
                .agg(*[F.sum(F.get("s", F.lit(j)) * share).alias(f"c{j}") for j in range(m)])
                .first()
            )
            steps = [column_totals[j] / sums[j] if sums[j] else 1.0 for j in range(m)]
            # twelve digits: sums added in another order must not give other factors
            factors = [float(f"{f * s:.12g}") for f, s in zip(factors, steps)]
            if max(abs(s - 1.0) for s in steps) < tolerance:
                break
    finally:
        base.unpersist()
    scaled = F.zip_with(weights, F.array(*[F.lit(f) for f in factors]), lambda w, f: F.greatest(w, F.lit(0.0)) * f)
    out = df.withColumn("_s", scaled).withColumn("_total", F.aggregate("_s", F.lit(0.0), lambda a, b: a + b))
    value = F.when(F.col("_total") > 0, F.transform("_s", lambda x: x * F.col(row_total) / F.col("_total"))).otherwise(F.col("_s"))
    return out.withColumn(name, value).drop("_s", "_total")


def round_rows(df: DataFrame, row_total: str, values: str, name: str = "counts") -> DataFrame:
    """Whole numbers per row that sum to ``row_total``: largest remainder first.

    Ties go to the earlier column; columns with value 0 get nothing.
    """
    floors = F.transform(values, lambda v: F.floor(v).cast("bigint"))
    with_floor = df.withColumn("_f", floors).withColumn(
        "_left", F.col(row_total) - F.aggregate("_f", F.lit(0).cast("bigint"), lambda a, b: a + b)
    )
    ranked = F.sort_array(
        F.filter(
            F.transform(values, lambda v, j: F.struct((F.floor(v) - v).alias("gap"), j.alias("j"), v.alias("v"))),
            lambda e: e["v"] > 0,
        )
    )
    order = F.transform(ranked, lambda e: e["j"])
    usable = F.size("_order")
    place = lambda j: F.array_position("_order", j)  # 1-based, 0 when absent
    share = lambda j: F.when(
        (place(j) > 0) & (F.col("_left") > 0),
        F.floor((F.col("_left") - place(j)) / usable).cast("bigint") + 1,
    ).otherwise(F.lit(0).cast("bigint"))
    checked = F.when(
        (F.col("_left") > 0) & (usable == 0), F.raise_error(F.lit("row total without any positive weight")).cast("array<bigint>")
    ).otherwise(F.transform("_f", lambda f, j: f + F.greatest(F.lit(0).cast("bigint"), share(j))))
    return with_floor.withColumn("_order", order).withColumn(name, checked).drop("_f", "_left", "_order")


def repair_columns(
    df: DataFrame, order: Sequence[str], counts: str, allowed: str, column_totals: Sequence[int]
) -> DataFrame:
    """Move units inside rows until every column sums to its total.

    Row sums never change. A row gives units of a surplus column to a short one
    if ``allowed`` (array of weights) is positive there; rows in order give all
    they can. At most (columns - 1) moves, each one running total.
    """
    m = len(column_totals)

    def deviations(frame: DataFrame) -> list[int]:
        row = frame.agg(*[F.coalesce(F.sum(F.get(counts, F.lit(j))), F.lit(0)) for j in range(m)]).first()
        return [int(row[j]) - int(column_totals[j]) for j in range(m)]

    off = deviations(df)
    blocked: set[tuple[int, int]] = set()
    while True:
        pairs = [
            (o, u) for o in range(m) for u in range(m) if off[o] > 0 and off[u] < 0 and (o, u) not in blocked
        ]
        if not pairs:
            break
        over, under = pairs[0]
        amount = min(off[over], -off[under])
        giving = df.withColumn(
            "_room", F.when(F.get(allowed, F.lit(under)) > 0, F.get(counts, F.lit(over))).otherwise(F.lit(0))
        )
        before = skew.running_total(giving, order, "_room", "_before")
        take = F.least(F.col("_room"), F.greatest(F.lit(0), F.lit(amount) - F.col("_before"))).cast("bigint")
        df = checkpoint(
            before.withColumn("_take", take)
            .withColumn(
                counts,
                F.transform(
                    counts,
                    lambda c, j: c
                    + F.when(j == under, F.col("_take")).when(j == over, -F.col("_take")).otherwise(0),
                ),
            )
            .drop("_room", "_before", "_take")
        )
        now = deviations(df)
        if now == off or off[over] - now[over] < amount:
            blocked.add((over, under))
        else:
            blocked.clear()
        off = now
    if any(off):
        raise ValueError(f"column totals cannot be met, deviations {off}")
    return df
