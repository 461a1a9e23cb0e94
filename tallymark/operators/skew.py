"""Joins, windows and numbering that hold when one key owns a third of the rows.

Three tools:

* ``hot_keys`` finds all heavy keys, however many, by exact counts in two steps:
  rows per cell of hashed keys, combined map-side, then rows per key in the
  crowded cells alone. The keys stay a table. Nothing downstream depends on
  them for correctness, only for balance.
* ``lookup_join`` attaches a table that is unique per key: broadcast when a
  bounded count proves it small, otherwise shuffled, with hot keys salted.
* ``segments`` cuts an ordered group into many ranges by sampled split points,
  so ordered windows (lag, numbering, running totals) run per range and a small
  table carries state from range to range.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.functions.rows import fixed_rows

CELLS = 1 << 16  # of hashed keys, counted first
HOT_ROWS = 1_000_000  # of one key; up to this one task copes, however large the table is
TASK_ROWS = 1_500_000  # that one task sorts or hashes, see ``dealt``
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20
OVERSAMPLE = 8  # split candidates per segment


@dataclass(frozen=True)
class Hot:
    """Heavy keys of one table: a stored table of hashes of keys and the pieces to cut them in, at most ``most``."""

    columns: tuple[str, ...]
    keys: DataFrame | None = None  # _hot bigint, _pieces int
    most: int = 1
    rows: int | None = None  # of the table, if they were counted

    def __bool__(self) -> bool:
        return self.most > 1

    @property
    def pieces(self) -> dict[int, int]:
        """For looking at: all keys, brought to the driver. No operator uses it."""
        return {r["_hot"]: r["_pieces"] for r in self.keys.collect()} if self.keys is not None else {}

    def hash(self) -> Column:
        return key_hash(self.columns)

    def mark(self, df: DataFrame) -> DataFrame:
        """Add ``_pieces``: 1 for ordinary keys. Joins at most one row for every HOT_ROWS rows of the table."""
        return (
            df.withColumn("_hot", self.hash())
            .join(F.broadcast(self.keys), "_hot", "left")
            .withColumn("_pieces", F.coalesce("_pieces", F.lit(1)))
            .drop("_hot")
        )


def key_hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(c) for c in columns])


def hot_keys(df: DataFrame, columns: Sequence[str], floor: int | None = None) -> Hot:
    """Keys of ``df`` with more rows than one task should hold."""
    from tallymark.sources.store import staged

    columns = tuple(columns)
    threshold = HOT_ROWS if floor is None else floor
    hashed = df.select(key_hash(columns).alias("_hot"))
    cell = F.pmod("_hot", F.lit(CELLS)).alias("_cell")
    cells = hashed.groupBy(cell).agg(F.count(F.lit(1)).alias("n"))
    seen = cells.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.max("n"), F.lit(0)).alias("most")).first()
    if seen["most"] <= threshold:
        return Hot(columns, rows=seen["rows"])
    # a heavy key's cell is crowded: fewer than one for every ``threshold`` rows
    crowded = cells.where(F.col("n") > threshold).select("_cell")
    piece = max(1, threshold // 4)
    counted = (
        hashed.select("_hot", cell)
        .join(F.broadcast(crowded), "_cell", "left_semi")
        .groupBy("_hot")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > threshold)
    )
    keys = staged(counted.select("_hot", F.ceil(F.col("n") / piece).cast("int").alias("_pieces")), "hot-keys")
    most = keys.agg(F.max("_pieces").alias("most")).first()["most"]
    return Hot(columns, keys, most, seen["rows"]) if most else Hot(columns, rows=seen["rows"])


def pieces_for(df: DataFrame, rows: int | None = None) -> int:
    """Tasks to deal a table to: as many as the session shuffles in, more where a task would get over TASK_ROWS of ``rows``."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(rows or 0) // TASK_ROWS))


def dealt(df: DataFrame, rows: int | None, *columns: str) -> DataFrame:
    """Shuffled by ``columns`` for an aggregate or window over them, which then needs no shuffle of its own.

    For keys that hardly repeat and are known not to be hot: combining them before the shuffle fills a task's memory and
    saves nothing. The number of tasks is fixed here, since small shuffled bytes, merged by size, can be very many rows.
    """
    return df.repartition(pieces_for(df, rows), *[F.col(c) for c in columns])


def is_small(df: DataFrame, rows: int | None = None, size: int | None = None) -> bool:
    """True when ``df`` is proven to stay within a number of rows and bytes (a count that combines before it is shuffled)."""
    rows = BROADCAST_ROWS if rows is None else rows
    size = BROADCAST_BYTES if size is None else size

    def width(name: str, kind: str) -> Column:
        if kind in ("string", "binary"):
            return F.coalesce(F.octet_length(name), F.lit(0))
        if kind.startswith(("array", "map", "struct")):
            return F.coalesce(F.octet_length(F.to_json(name)), F.lit(0))
        return F.lit(8)

    widths = reduce(lambda a, b: a + b, [width(f"`{n}`", k) for n, k in df.dtypes])
    got = df.agg(F.count(F.lit(1)).alias("n"), F.sum(widths).alias("b")).first()
    return got["n"] <= rows and (got["b"] or 0) <= size


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    hot: Hot | None = None,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Join ``facts`` to a ``lookup`` that has one row per key.

    Small lookups (rows and bytes counted, up to a limit) are broadcast. Larger ones are
    shuffled; then fact rows of hot keys are spread over ``_pieces`` salts and
    the lookup row of such a key is repeated once per salt.
    """
    on = list(on)
    kinds = [(dict(facts.dtypes)[c], dict(lookup.dtypes)[c]) for c in on]
    if any(a != b for a, b in kinds):  # salts come from hashes, which depend on the type
        raise TypeError(f"key types differ: {dict(zip(on, kinds))}")
    if is_small(lookup, broadcast_rows):
        return facts.join(F.broadcast(lookup), on, how)
    hot = hot_keys(facts, on) if hot is None else hot
    if not hot:
        return facts.join(lookup, on, how)
    salted = hot.mark(facts).withColumn(
        "_salt", F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns]), F.col("_pieces"))
    )
    repeated = (
        hot.mark(lookup)
        .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_pieces").cast("bigint") - 1)))
        .drop("_pieces")
    )
    return salted.drop("_pieces").join(repeated, [*on, "_salt"], how).drop("_salt")


def group_minimum(df: DataFrame, keys: Sequence[str], value: str, name: str, *, hot: Hot | None = None) -> DataFrame:
    """Attach ``min(value)`` of the group to each row whose keys are not NULL.

    One shuffle and no self-join for ordinary groups; hot groups are
    aggregated with map-side combine and joined back salted.
    """
    keys = list(keys)
    df = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    hot = hot_keys(df, keys) if hot is None else hot
    if not hot:
        return dealt(df, hot.rows, *keys).withColumn(name, F.min(value).over(Window.partitionBy(*keys)))
    minima = df.groupBy(*keys).agg(F.min(value).alias(name))
    return lookup_join(df, minima, keys, hot=hot)


# --------------------------------------------------------------------------- #
# ordered segments
# --------------------------------------------------------------------------- #

def _locate(points: Column, key: Column, width: int) -> Column:
    """How many of the sorted ``points`` are <= ``key``: a binary search."""
    steps = []
    step = 1
    while step <= width:
        steps.insert(0, F.lit(step))
        step *= 2
    return F.aggregate(
        F.array(*steps),
        F.lit(0),
        lambda at, s: F.when(F.get(points, at + s - 1) <= key, at + s).otherwise(at),
    )


def _thin(points: Column, every: Column | int) -> Column:
    """Every n-th element of an array."""
    return F.filter(points, lambda _, i: F.pmod(i + 1, every) == 0)


def split_points(df: DataFrame, keys: Sequence[str], order: Sequence[str], pieces: Column) -> DataFrame:
    """Per key, sorted values of ``order`` that cut it in about equal ranges.

    A uniform sample without replacement: rows fall in hash cells and the row
    with the least hash wins its cell, so the sample depends on the data only
    and is combined map-side. At most pieces x OVERSAMPLE rows per key survive.
    """
    point = F.struct(*[F.col(c) for c in order])
    cell = F.pmod(F.xxhash64(F.lit("cell"), point), pieces * OVERSAMPLE)
    sampled = (
        df.select(*keys, point.alias("_point"), pieces.alias("_n"), cell.alias("_cell"))
        .groupBy(*keys, "_cell")
        .agg(F.min_by("_point", F.xxhash64(F.lit("pick"), "_point")).alias("_point"))
    )
    # a key's points: OVERSAMPLE for each of its pieces, which hold at least HOT_ROWS / 4 rows
    return sampled.groupBy(*keys).agg(
        _thin(F.sort_array(F.collect_list("_point")), OVERSAMPLE).alias("_points")
    )


def with_hot_segments(df: DataFrame, key: str, order: Sequence[str], hot: Hot) -> DataFrame:
    """Add ``_segment``: 0 for ordinary keys, a range number within hot ones."""
    marked = hot.mark(df)
    points = split_points(marked.where("_pieces > 1"), [key], order, F.col("_pieces"))
    here = F.struct(*[F.col(c) for c in order])
    return (
        marked.drop("_pieces")
        .join(F.broadcast(points), key, "left")  # one row per hot key, a point for each HOT_ROWS / 4 of its rows
        .withColumn("_segment", F.coalesce(_locate(F.col("_points"), here, hot.most), F.lit(0)))
        .drop("_points")
    )


def lag_in_group(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    name: str,
    *,
    hot: Hot | None = None,
) -> DataFrame:
    """``lag(value)`` over (partition by key order by order), also for huge groups."""
    hot = hot_keys(df, [key]) if hot is None else hot
    ordering = [F.col(c).asc() for c in order]
    if not hot:
        return df.withColumn(name, F.lag(value).over(Window.partitionBy(key).orderBy(*ordering)))

    # whole-row copies cannot be told apart by any split point: those of hot keys
    # become one row with a count, combined map-side
    marked = hot.mark(df)
    single = marked.where("_pieces = 1").select(*df.columns, F.lit(1).cast("bigint").alias("_copies"))
    merged = marked.where("_pieces > 1").groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    cut = with_hot_segments(single.unionByName(merged), key, order, hot)
    within = Window.partitionBy(key, "_segment").orderBy(*ordering)
    lagged = cut.withColumn(name, F.lag(value).over(within)).withColumn("_rn", F.row_number().over(within))
    ends = (
        hot.mark(cut)
        .where("_pieces > 1")
        .groupBy(key, "_segment")
        .agg(F.max_by(F.struct(value), F.struct(*order)).alias("_end"))
    )
    # one row per range of a hot key: about one for each HOT_ROWS / 4 rows
    carried = ends.select(
        key,
        "_segment",
        F.lag("_end").over(Window.partitionBy(key).orderBy("_segment")).getField(value).alias("_carried"),
    )
    linked = (
        lagged.join(F.broadcast(carried), [key, "_segment"], "left")
        .withColumn(name, F.when(F.col("_rn") == 1, F.col("_carried")).otherwise(F.col(name)))
        .drop("_segment", "_rn", "_carried")
    )
    # the second and later copies follow their own like
    more = merged.where("_copies > 1").withColumn("_more", F.col("_copies") - 1)
    repeats = expand(more, "_more", "_i").select(*df.columns, F.col(value).alias(name))
    return linked.select(*df.columns, name).unionByName(repeats)


def _pieces(df: DataFrame, pieces: int | None) -> int:
    """Ranges of a whole table: as many as the session shuffles in, unless told."""
    return pieces or max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _with_global_segment(df: DataFrame, order: Sequence[str], pieces: int) -> DataFrame:
    points = split_points(df.withColumn("_all", F.lit(0)), ["_all"], order, F.lit(pieces)).drop("_all")
    here = F.struct(*[F.col(c) for c in order])
    return (
        df.crossJoin(F.broadcast(points))  # exactly one row, at most `pieces` points
        .withColumn("_segment", _locate(F.col("_points"), here, pieces))
        .drop("_points")
    )


def running_total(
    df: DataFrame,
    order: Sequence[str],
    value: str,
    name: str,
    *,
    pieces: int | None = None,
) -> DataFrame:
    """Sum of ``value`` over all earlier rows (this one excluded) in ``order``.

    ``order`` must identify a row. No window ever sees the whole table: ranges
    are totalled in parallel and their few totals are accumulated.
    """
    cut = _with_global_segment(df, order, _pieces(df, pieces))
    totals = cut.groupBy("_segment").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_segment", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    within = (
        Window.partitionBy("_segment")
        .orderBy(*[F.col(c).asc() for c in order])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        cut.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
        .join(F.broadcast(offsets), "_segment")  # at most pieces + 1 rows
        .withColumn(name, F.col("_within") + F.col("_offset"))
        .drop("_segment", "_within", "_offset")
    )


def dense_number(df: DataFrame, order: Sequence[str], name: str, *, pieces: int | None = None) -> DataFrame:
    """1, 2, 3 .. in ``order`` over the whole table, range by range."""
    one = df.withColumn("_one", F.lit(1).cast("bigint"))
    numbered = running_total(one, order, "_one", name, pieces=pieces)
    return numbered.withColumn(name, F.col(name) + 1).drop("_one")


def number_written(ranges: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``dense_number`` of rows that ``order`` identifies and that lie in ranges of it (``repartitionByRange``), by writing them once.

    A row's place in its range is known as it is written; ranges are then counted and their few offsets added.
    """
    from tallymark.sources.store import staged

    placed = staged(ranges.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    # the id holds the range from bit 33 on, below it the place in the range
    parts = placed.withColumn("_range", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    totals = parts.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        parts.join(F.broadcast(offsets), "_range")  # one row per range
        .withColumn(name, F.col("_at") + F.col("_offset") + 1)
        .drop("_range", "_at", "_offset")
    )


def expand(df: DataFrame, count: str, name: str, block: int = 65_536) -> DataFrame:
    """One row per number 0 .. count-1 of each row, as column ``name``.

    Large counts are cut in blocks that are dealt out to tasks before they are
    expanded, so no task has to emit a whole group.
    """
    largest = df.agg(F.max(count).alias("m")).first()["m"] or 0
    if largest <= block:
        return df.where(F.col(count) > 0).withColumn(
            name, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(count).cast("bigint") - 1))
        )
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-largest // block))
    blocks = df.where(F.col(count) > 0).withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(count) - 1) / block)))
    )
    dealt = blocks.repartition(tasks, *[F.col(c) for c in blocks.columns])
    low = F.col("_block") * block
    return dealt.withColumn(
        name, F.explode(F.sequence(low, F.least(low + block, F.col(count).cast("bigint")) - 1))
    ).drop("_block")
