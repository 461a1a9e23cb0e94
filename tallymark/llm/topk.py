"""Exact top-k search by the three-phase uniform threshold.

Vectors are turned into integers and packed into blocks; every block of queries meets every block of vectors. The
dimensions are cut into lists, and a vector's score is the sum of its local scores in the lists.

1. Each pair of blocks gathers, per query, the vectors at the head of every list and their whole scores. The k-th best of
   all gathered ones is a score that k vectors reach: a safe cutoff.
2. The cutoffs go back to the blocks. A vector whose score reaches the cutoff must reach its share of the cutoff, the
   cutoff divided by the number of lists, in one list at least: these entries are collected, and none else can matter.
3. Of the collected entries the whole scores are resolved, exactly, and the k best of each pair of blocks go on to the
   ranking.

Sums are exact: 32-bit floats while every sum stays below 2^24, 64-bit floats below 2^53, else 64-bit integers.

Defined results: vectors that are null, empty, or hold a null or non-finite component take no part, nor do rows without id
or whose integers do not fit 31 bits; rows repeating id and vector count once, rows repeating an id with another vector are
candidates each and, as queries, share one ranking; only vectors of equal length are compared; ties go to the smaller id; fewer candidates than k give as many rows; an empty table gives an empty result. Other columns
of the input are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 20
LISTS = 4
#: Vectors in a block; both kinds of blocks stay below some megabytes.
BLOCK = 4_096
QUERY_BLOCK = 1_024
#: A query block is repeated so often, so that so many tasks can share its work.
SPREAD = 16


def quantised(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component as int, or null for a vector that takes no part."""
    limit = float(2**31 - 1)
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    sound = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) * scale < limit),
    )
    return F.when((F.size(vector) > 0) & sound, whole.cast("array<int>"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def exact_kind(queries: np.ndarray, vectors: np.ndarray) -> type:
    """The fastest number type in which every sum of products is exact."""
    most = int(np.abs(queries).max(initial=0)) * int(np.abs(vectors).max(initial=0)) * queries.shape[1]
    if most >= 2**63:
        raise ValueError("scores do not fit 64 bits")
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, ties to the smaller id."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > edge)
        level = np.flatnonzero(scores == edge)
        if len(above) + len(level) > k:
            level = level[np.argsort(ids[level], kind="stable")[: k - len(above)]]
        return np.concatenate([above, level])
    return np.arange(len(scores))


def local_scores(queries: np.ndarray, vectors: np.ndarray, lists: int) -> list[np.ndarray]:
    kind = exact_kind(queries, vectors)
    a, b = queries.astype(kind), vectors.astype(kind)
    bounds = np.linspace(0, a.shape[1], min(lists, a.shape[1]) + 1).astype(int)
    return [a[:, s:e] @ b[:, s:e].T for s, e in zip(bounds, bounds[1:])]


def gather(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, lists: int) -> Iterator[tuple[int, list[int]]]:
    """Phase 1: per query the whole scores of the vectors that head its lists, at most k."""
    parts = local_scores(queries, vectors, lists)
    whole = sum(parts)
    head = min(-(-2 * k // len(parts)), len(ids))
    heads = [np.argpartition(p, len(ids) - head, axis=1)[:, len(ids) - head :] for p in parts]
    for row, (query, found) in enumerate(zip(query_ids.tolist(), np.concatenate(heads, axis=1))):
        found = np.unique(found)
        scores = np.sort(whole[row, found[ids[found] != query]])[::-1][:k]
        yield query, scores.astype(np.int64).tolist()


def resolve(query_ids: np.ndarray, queries: np.ndarray, cutoffs: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, lists: int) -> Iterator[tuple[int, int, int]]:
    """Phases 2 and 3: (query, id, score) of the block's k best among those that reach the cutoff."""
    parts = local_scores(queries, vectors, lists)
    share = (-(-cutoffs // len(parts))).astype(parts[0].dtype)[:, None]  # rounded up
    collected = parts[0] >= share
    for part in parts[1:]:
        collected |= part >= share
    whole = sum(parts)
    collected &= whole >= cutoffs.astype(whole.dtype)[:, None]
    for row in np.flatnonzero(collected.any(axis=1)):
        query = int(query_ids[row])
        found = np.flatnonzero(collected[row])
        found = found[ids[found] != query]
        scores = whole[row, found].astype(np.int64)
        for at in _best(scores, ids[found], k):
            yield query, int(ids[found[at]]), int(scores[at])


def nearest(vectors: DataFrame, is_query: Column, k: int = K, lists: int = LISTS, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the k best vectors of every query.

    Numbers of blocks are counted first; a block's number is a hash of the id, so a query block and its parts stay together.
    """
    sound = (
        vectors.select(F.col(id).cast("bigint").alias("id"), quantised(F.col(vector)).alias("v"), is_query.alias("is_query"))
        .where(F.col("id").isNotNull() & F.col("v").isNotNull())
        .dropDuplicates(["id", "v"])
        .withColumn("dims", F.size("v"))
    )
    sizes = sound.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_query").alias("q")).first()
    blocks = max(1, -(-sizes["n"] // BLOCK))
    query_blocks = max(1, -(-sizes["q"] // QUERY_BLOCK))
    spread = min(SPREAD, blocks)
    number = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    rows = lambda *c: F.collect_list(F.struct(*c))  # noqa: E731  about BLOCK of them, by the hash
    field = lambda name: F.transform("rows", lambda x: x[name])
    pairs = (
        sound.groupBy("dims", number(blocks).alias("block"))
        .agg(rows("id", "v").alias("rows"))
        .select(
            "dims",
            F.pmod("block", F.lit(spread)).alias("share"),
            field("id").alias("ids"),
            F.flatten(field("v")).alias("flat"),
            F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("query_block"),
        )
    )

    def asked(queries: DataFrame) -> DataFrame:
        return (
            queries.groupBy("dims", number(query_blocks).alias("query_block"))
            .agg(rows("id", "v", "cutoff").alias("rows"))
            .select(
                "dims",
                "query_block",
                field("id").alias("query_ids"),
                F.flatten(field("v")).alias("query_flat"),
                field("cutoff").alias("cutoffs"),
                F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("share"),
            )
        )

    keys = ["dims", "query_block", "share"]
    none = F.lit(-(2**62))
    met = pairs.join(asked(sound.where("is_query").withColumn("cutoff", none)), keys)

    def arrays(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                dims = one.column("dims")[0].as_py()
                ints = lambda name: one.column(name).flatten().to_numpy(zero_copy_only=False)  # noqa: B023, E731
                yield ints("query_ids"), ints("query_flat").reshape(-1, dims), ints("ids"), ints("flat").reshape(-1, dims), one

    def first(batches):
        for query_ids, queries, ids, rows, _ in arrays(batches):
            found = list(gather(query_ids, queries, ids, rows, k, lists))
            lengths = np.cumsum([0, *[len(s) for _, s in found]])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(query_ids, np.diff(lengths))),
                    pa.array([x for _, s in found for x in s], type=pa.int64()),
                ],
                names=["query_id", "score"],
            )

    by_query = Window.partitionBy("query_id")
    cutoffs = (
        met.mapInArrow(first, "query_id bigint, score bigint")
        .withColumn("rank", F.row_number().over(by_query.orderBy(F.desc("score"))))
        .where(F.col("rank") <= k)
        .groupBy("query_id")
        .agg(F.min("score").alias("score"), F.count(F.lit(1)).alias("n"))
        .select("query_id", F.when(F.col("n") >= k, F.col("score")).alias("cutoff"))
    )
    queries = sound.where("is_query").join(cutoffs, F.col("id") == F.col("query_id"), "left")
    met = pairs.join(asked(queries.withColumn("cutoff", F.coalesce("cutoff", none))), keys)

    def second(batches):
        for query_ids, queries, ids, rows, one in arrays(batches):
            cutoffs = one.column("cutoffs").flatten().to_numpy(zero_copy_only=False)
            found = list(resolve(query_ids, queries, cutoffs, ids, rows, k, lists))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in zip(*found)], names=["query_id", "vec_id", "score"])

    return (
        met.mapInArrow(second, "query_id bigint, vec_id bigint, score bigint")
        .withColumn("rank", F.row_number().over(by_query.orderBy(F.desc("score"), "vec_id")))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
