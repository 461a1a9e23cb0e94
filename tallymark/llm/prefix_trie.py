"""The prefix trie of conversations, with totals of every subtree, by time-forward processing.

1. Turns are numbered and their prefixes identified by running totals of hashes over sorted ranges of the table, so that a
   conversation of any length is spread over many tasks. Equal prefixes of any conversations are one node.
2. Shards are subtrees: a node of few conversations under a node of many is a shard root, and its whole subtree goes to one
   task, sorted by reverse level order with Spark's external sort. The task passes over its nodes once. What a node owes its
   parent waits in a priority queue ordered like the nodes, which spills sorted runs, so memory is bounded whatever the
   shard's size.
3. Totals of shard roots are added up by parent, before and after the shuffle, and are what the remaining nodes start with.
   These form a far smaller trie, which is cut into shards and processed in the same way, until no node remains.

Defined results: rows without conv_id are left out; a null role or text becomes empty; null turns come first; turns with equal
numbers are ordered by role and text, repeated rows are turns of their own; a conversation no row of which is left by the
rebuilding is a member of the root alone; an empty table gives an empty result. Other columns of the input are not read,
whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import struct
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import bounded, released, staged

#: A node with more conversations than this is above the shard roots.
SHARD = 1_000
#: Items a task's queue holds in memory before it spills.
HELD = 100_000
#: Conversations are rebuilt in families of so many ids, with the first turns of the family's first.
FAMILY, MOST_TURNS = 5, 9
NODE = ["hi", "lo"]
EMPTY_HASH = hashlib.sha256().hexdigest()


# --------------------------------------------------------------------------- #
# prefixes
# --------------------------------------------------------------------------- #

def running(df: DataFrame, key: str, order: list[str | Column], values: list[str], pieces: int | None = None) -> DataFrame:
    """Running totals of `values` up to each row, over `key` in `order`, also for a key with most of the rows.

    Rows are dealt out by sorted ranges; a total within a range is a window, and the few keys that go on from one range to
    the next (less than there are ranges) carry their totals over.
    """
    spark = df.sparkSession
    pieces = pieces or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = staged(df.repartitionByRange(pieces, key, *order).withColumn("range_no", F.spark_partition_id()))
    within = Window.partitionBy("range_no", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy(key, "range_no").agg(*[F.sum(v).alias(f"sum_{v}") for v in values])
    carried = sums.select(key, "range_no", *[F.sum(f"sum_{v}").over(before).alias(f"carried_{v}") for v in values]).where(
        F.col(f"carried_{values[0]}").isNotNull()
    )
    totals = dealt.select("*", *[F.sum(v).over(within).alias(f"within_{v}") for v in values])
    joined = totals.join(F.broadcast(carried), [key, "range_no"], "left")  # fewer rows than there are ranges
    zero = F.lit(0)
    return joined.select(*df.columns, *[(F.col(f"within_{v}") + F.coalesce(f"carried_{v}", zero)).alias(f"total_{v}") for v in values])


def crc_of(id: Column) -> Column:
    return F.crc32(id.cast("string").cast("binary"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conv_ids, and the rebuilt turns: c, at (from 1), role, text.

    Conversation c takes the first h turns of the first conversation of its family and goes on with its own after its
    first h.
    """
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("c"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.lit(1).cast("bigint").alias("one"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    numbered = staged(running(turns, "c", order, ["one"]).select("c", F.col("total_one").alias("at"), "role", "text"))
    h = crc_of(F.col("c")) % MOST_TURNS
    first = F.col("c") - F.col("c") % FAMILY
    conversation = staged(
        numbered.groupBy("c").agg(F.max("at").alias("turns")).select("c", first.alias("first"), h.alias("h"), "turns")
    )
    heads = numbered.where((F.col("at") < MOST_TURNS) & (F.col("c") == first)).withColumnRenamed("c", "first")
    given = conversation.select("c", "first", "h").join(heads, "first").where("at <= h").select("c", "at", "role", "text")
    # how many turns the family's first conversation gives; none if it is absent
    lent = conversation.select("c", "first", "h").join(
        conversation.where("c = first").select("first", F.col("turns").alias("there")), "first", "left"
    )
    shift = bounded(lent.select("c", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("taken")))
    own = numbered.join(shift, "c").where("at > h").select("c", (F.col("at") - F.col("h") + F.col("taken")).alias("at"), "role", "text")
    return conversation.select("c"), given.unionByName(own)


def prefixes(conversations: DataFrame) -> DataFrame:
    """A row for every prefix of every rebuilt conversation, the empty one included, in a written table.

    c, depth, hi, lo (the node), up_hi, up_lo (its parent), bytes (of the last text).
    """
    ids, turns = rebuilt(conversations)
    wide = lambda *c: F.xxhash64(*c).cast("decimal(28,0)")  # noqa: E731  sums of 10^10 turns stay exact
    hashed = turns.select(
        "c",
        "at",
        wide(F.lit(1), "at", "role", "text").alias("x"),
        wide(F.lit(2), "at", "role", "text").alias("y"),
        F.octet_length("text").cast("bigint").alias("bytes"),
    )
    name = lambda depth, x, y: [F.xxhash64(F.lit(i), depth, x.cast("decimal(38,0)"), y.cast("decimal(38,0)")) for i in (1, 2)]
    hi, lo = name(F.col("at"), F.col("total_x"), F.col("total_y"))
    up_hi, up_lo = name(F.col("at") - 1, F.col("total_x") - F.col("x"), F.col("total_y") - F.col("y"))
    below = running(hashed, "c", ["at"], ["x", "y"]).select(
        "c", F.col("at").alias("depth"), hi.alias("hi"), lo.alias("lo"), up_hi.alias("up_hi"), up_lo.alias("up_lo"), "bytes"
    )
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    hi, lo = name(zero, F.lit(0), F.lit(0))
    root = ids.select("c", zero.alias("depth"), hi.alias("hi"), lo.alias("lo"), none.alias("up_hi"), none.alias("up_lo"), zero.alias("bytes"))
    return staged(root.unionByName(below))


# --------------------------------------------------------------------------- #
# time-forward processing inside a shard
# --------------------------------------------------------------------------- #

class SpillingQueue:
    """A priority queue of (key..., value...) in whole numbers that adds up values of equal keys and spills sorted runs.

    Runs are unnamed files in Spark's own scratch folders, read back by the same task only; they end with it.
    """

    def __init__(self, keys: int = 3, values: int = 3, held: int = HELD):
        self.keys, self.held = keys, held
        self.record = struct.Struct(f"<{keys + values}q")
        self.heap: list[tuple] = []
        self.heads: list[tuple] = []  # the next record of every run, with the run
        self.spills = 0

    def push(self, item: tuple) -> None:
        if len(self.heap) >= self.held:
            self._spill()
        heapq.heappush(self.heap, item)

    def _spill(self) -> None:
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        run = tempfile.TemporaryFile(dir=folder if folder and os.path.isdir(folder) else None)
        last: tuple | None = None
        for item in sorted(self.heap):
            if last is not None and last[: self.keys] == item[: self.keys]:
                last = (*last[: self.keys], *(a + b for a, b in zip(last[self.keys :], item[self.keys :])))
                continue
            if last is not None:
                run.write(self.record.pack(*last))
            last = item
        if last is not None:
            run.write(self.record.pack(*last))
        self.heap = []
        run.seek(0)
        self.spills += 1
        self._advance(self.spills, self._read(run))

    def _read(self, run) -> Iterator[tuple]:
        size = self.record.size
        while block := run.read(size * 1024):
            yield from self.record.iter_unpack(block)
        run.close()

    def _advance(self, number: int, run: Iterator[tuple]) -> None:
        if (item := next(run, None)) is not None:
            heapq.heappush(self.heads, (item, number, run))

    def pop(self, key: tuple) -> list[int] | None:
        """The summed values of all items of this key, the smallest key left; None if there are none."""
        found = None
        while True:
            if self.heap and self.heap[0][: self.keys] == key:
                item = heapq.heappop(self.heap)
            elif self.heads and self.heads[0][0][: self.keys] == key:
                item, number, run = heapq.heappop(self.heads)
                self._advance(number, run)
            else:
                return found
            values = item[self.keys :]
            found = list(values) if found is None else [a + b for a, b in zip(found, values)]


def passed_up(nodes: Iterator[tuple], held: int = HELD) -> Iterator[tuple[int, int, int]]:
    """(children, leaves, saved) of every node, from (depth, hi, lo, up_hi, up_lo, is_root, own, children, leaves, saved).

    Nodes come by falling depth, then hi and lo; the last three are what shards below have passed on already.
    """
    queue = SpillingQueue(held=held)
    for depth, hi, lo, up_hi, up_lo, is_root, own, children, leaves, saved in nodes:
        if (inside := queue.pop((-depth, hi, lo))) is not None:
            children, leaves, saved = children + inside[0], leaves + inside[1], saved + inside[2]
        leaves, saved = (leaves if children else 1), saved + own
        if not is_root:
            queue.push((1 - depth, up_hi, up_lo, 1, leaves, saved))
        yield children, leaves, saved


def _processed(shards: DataFrame) -> DataFrame:
    """Every node with n_children, n_leaves, saved_tokens. Nodes of a shard carry its root's name as (root_hi, root_lo)."""
    columns = ["depth", "hi", "lo", "up_hi", "up_lo", "is_root", "own", "children", "leaves", "saved"]
    sent = [*columns, "conv_id", "n_convs"]

    def run(batches):
        waiting: list = []  # the batch whose nodes are being read

        def nodes():
            for batch in batches:
                if not batch.num_rows:
                    continue
                waiting.append(batch)
                yield from zip(*[batch.column(c).to_pylist() for c in columns])

        results = passed_up(nodes())
        found: list[tuple] = []
        for result in results:
            found.append(result)
            batch = waiting[0]
            if len(found) == batch.num_rows:
                totals = np.array(found, dtype=np.int64).reshape(-1, 3)
                arrays = [batch.column(c) for c in sent]
                yield pa.RecordBatch.from_arrays([*arrays, *[pa.array(totals[:, i]) for i in range(3)]], names=[*sent, "n_children", "n_leaves", "saved_tokens"])
                found = []
                waiting.pop(0)

    schema = (
        "depth bigint, hi bigint, lo bigint, up_hi bigint, up_lo bigint, is_root boolean, own bigint, children bigint, leaves bigint, "
        "saved bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"
    )
    dealt = shards.repartition("root_hi", "root_lo").sortWithinPartitions(F.desc("depth"), "hi", "lo")
    return dealt.select(*sent).mapInArrow(run, schema)


# --------------------------------------------------------------------------- #
# shards, and what is above them
# --------------------------------------------------------------------------- #

def subtree_totals(paths: DataFrame, shard: int | None = None) -> DataFrame:
    """Every node with its members and the totals of its subtree, from the rows of `prefixes`.

    depth, hi, lo, up_hi, up_lo, conv_id, n_convs, n_children, n_leaves, saved_tokens.
    """
    shard = SHARD if shard is None else shard
    zero = F.lit(0).cast("bigint")
    nodes = staged(
        paths.groupBy("depth", "hi", "lo", "up_hi", "up_lo")
        .agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"))
        .withColumn("own", (F.col("n_convs") - 1) * F.col("bytes"))
        .select("depth", "hi", "lo", "up_hi", "up_lo", "conv_id", "n_convs", "own", *[zero.alias(c) for c in ("children", "leaves", "saved")])
        .withColumn("paths", F.col("n_convs"))
        .withColumn("by", F.col("conv_id"))  # a conversation of this round's that leads through the node
    )
    done: list[DataFrame] = []
    while True:
        upper = staged(nodes.where(F.col("paths") > shard))
        lower = nodes.where(F.col("paths") <= shard)
        # the root of a node's shard: the highest node of few paths on the way to it, whichever of them is followed
        on_way = paths.select("c", "depth", "hi", "lo").join(bounded(upper.select("hi", "lo")), NODE, "left_anti")
        root_of = on_way.groupBy("c").agg(F.min_by(F.struct("hi", "lo"), "depth").alias("root"))
        rooted = (
            lower.join(root_of.withColumnRenamed("c", "by"), "by")
            .withColumn("root_hi", F.col("root.hi"))
            .withColumn("root_lo", F.col("root.lo"))
            .withColumn("is_root", (F.col("root_hi") == F.col("hi")) & (F.col("root_lo") == F.col("lo")))
            .drop("root", "paths", "by")
        )
        totals = staged(_processed(rooted))
        done.append(totals)
        if upper.isEmpty():
            break
        passed = (
            totals.where("is_root")
            .groupBy("up_hi", "up_lo")
            .agg(F.count(F.lit(1)).alias("more"), F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
            .withColumnsRenamed({"up_hi": "hi", "up_lo": "lo"})
        )
        # what is left is a trie whose paths are the ways to its own leaves, each told by one conversation
        leaf = upper.join(upper.select(F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo")), NODE, "left_anti")
        # no conversation stands for two leaves: they would lie on one way
        ends = leaf.select(F.col("by").alias("c"), F.col("depth").alias("end"))
        paths = staged(paths.join(ends, "c").where("depth <= end").drop("end"))
        ways = paths.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("paths"), F.min("c").alias("by"))
        add = lambda c, m: (F.col(c) + F.coalesce(m, zero)).alias(c)
        nodes = staged(
            upper.drop("paths", "by")
            .join(passed, NODE, "left")
            .join(ways, NODE)
            .select(
                "depth", "hi", "lo", "up_hi", "up_lo", "conv_id", "n_convs", "own",
                add("children", "more"), add("leaves", "more_leaves"), add("saved", "more_saved"), "paths", "by",
            )
        )
        released(upper)
    keep = ["depth", "hi", "lo", "up_hi", "up_lo", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    out = done[0].select(*keep)
    for more in done[1:]:
        out = out.unionByName(more.select(*keep))
    return out


def end_hashes(paths: DataFrame) -> DataFrame:
    """hi, lo, ends_sha256 of the nodes where conversations end: of their ids in ascending order, joined by commas.

    A hash of one text is made from its beginning to its end, so the ids of a node pass through one task; they are sorted
    externally and streamed, and none are held.
    """
    last = paths.groupBy("c").agg(F.max_by(F.struct("hi", "lo"), "depth").alias("node")).select("c", "node.hi", "node.lo")

    def run(batches):
        node, digest = None, None
        rows: list[tuple] = []
        for batch in batches:
            for hi, lo, c in zip(*[batch.column(n).to_pylist() for n in ("hi", "lo", "c")]):
                if (hi, lo) != node:
                    if node is not None:
                        rows.append((*node, digest.hexdigest()))
                    node, digest = (hi, lo), hashlib.sha256(str(c).encode())
                else:
                    digest.update(f",{c}".encode())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["hi", "lo", "ends_sha256"])
                rows = []
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, digest.hexdigest())], names=["hi", "lo", "ends_sha256"])

    sorted_rows = last.select("hi", "lo", "c").repartition("hi", "lo").sortWithinPartitions("hi", "lo", "c")
    return sorted_rows.mapInArrow(run, "hi bigint, lo bigint, ends_sha256 string")


def trie(conversations: DataFrame, shard: int | None = None) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    paths = prefixes(conversations)
    nodes = staged(subtree_totals(paths, shard))
    # a parent has one row, its children may be many: a skewed side that adaptive execution splits
    parents = nodes.select(F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(parents, ["up_hi", "up_lo"], "left")
        .join(end_hashes(paths), NODE, "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(EMPTY_HASH)).alias("ends_sha256"),
        )
    )
