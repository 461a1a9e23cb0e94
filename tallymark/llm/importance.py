"""Importance resampling of documents towards a target text.

1. Every text is turned once into the buckets of its features: all runs of one to three words, hashed. The buckets are
   written to the shared folder, from where both the counting and the scoring read them.
2. A bucket's gain is the scaled log ratio of its smoothed shares in target and documents. There are BUCKETS gains, however
   large the corpus; as one array in the plan they turn a document's buckets into its weight by look-up, without a join.
3. A Gumbel draw from a hash of the id makes the highest scores a weighted sample without replacement.
4. The k-th key of (score down, id up) is found by a distributed quickselect: random keys of the rows still in question are
   pivots, one aggregate counts exactly what lies below and at each of them, and the range that must hold the k-th key is
   kept. Only counts and PIVOTS keys a round reach the driver. The rows up to the k-th key alone are sorted and ranked.

Defined results: a null or wordless text has no features and weight 0; a null id draws as the text `42:null` and comes after
all others among ties; rows repeating an id count each, and among rows equal in all results the ranks are dealt out in any
order; an empty target leaves gains that depend on the documents alone; an empty table gives an empty result. Other columns
of the input are not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import released, staged
from tallymark.operators import skew

BUCKETS = 10_000
LONGEST = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: Pivot keys a round of the quickselect; each round leaves about so small a part of the rows.
PIVOTS = 32
#: Texts whose features a task holds at once.
ROWS = 256
#: Bytes inside words, once A-Z are lower case: digits, small letters, and whatever is not ASCII.
INSIDE = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(0x80, 0x100))
_ONLY_WORDS = bytes(i if i in INSIDE else 0x20 for i in range(256))
#: What the k-th key is made of, in order; rows equal in it are equal in all results.
KEY = ("down", "nameless", "id", "n_features")


def feature_buckets(text: str, longest: int = LONGEST, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of every run of 1 to `longest` words, repeats included.

    A run is a slice of the words joined by single spaces. bytes.lower() changes A-Z alone.
    """
    words = text.encode("utf-8", "surrogatepass").lower().translate(_ONLY_WORDS).split()
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.append(0, ends + 1)[: len(words)].tolist()
    ends = ends.tolist()
    sums = [crc32(joined[a:b]) for width in range(longest) for a, b in zip(starts, ends[width:])]
    return len(words), (np.array(sums, dtype=np.int64) % buckets).astype(np.int16)


def with_features(texts: DataFrame, keep: list[str]) -> DataFrame:
    """`keep`, n_words and features (buckets) of each whole text."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):  # long texts make many features: they leave in small batches
                part = batch.slice(at, ROWS)
                found = [feature_buckets(t or "") for t in part.column("text").to_pylist()]
                offsets = np.cumsum([0, *[len(f) for _, f in found]]).astype(np.int32)
                features = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([f for _, f in found])))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keep], pa.array([n for n, _ in found], type=pa.int64()), features], names=[*keep, "n_words", "features"]
                )

    kinds = dict(texts.dtypes)
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in keep], "n_words bigint", "features array<smallint>"])
    return texts.select(*keep, "text").mapInArrow(run, schema)


def bucket_counts(features: DataFrame) -> DataFrame:
    """bucket, n: at most BUCKETS rows, combined before the shuffle."""
    return features.select(F.explode("features").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """floor(1000 * ln of the smoothed target share over the smoothed source share) of every bucket.

    The logarithms are Spark's; the table has `buckets` rows, whatever the size of the corpus.
    """
    spark = source.sparkSession
    zero = F.lit(0).cast("bigint")
    both = (
        spark.range(buckets)
        .select(F.col("id").cast("smallint").alias("bucket"))
        .join(source.withColumnRenamed("n", "s"), "bucket", "left")
        .join(target.withColumnRenamed("n", "t"), "bucket", "left")
        .select("bucket", F.coalesce("s", zero).alias("s"), F.coalesce("t", zero).alias("t"))
    )
    counted = staged(both)
    sums = counted.agg(F.sum("s").alias("S"), F.sum("t").alias("T")).first()
    double = lambda c: c.cast("double")
    ratio = (double(F.col("t")) + 1) * F.lit(float(sums["S"] + buckets)) / ((double(F.col("s")) + 1) * F.lit(float(sums["T"] + buckets)))
    rows = counted.select("bucket", F.floor(1000 * F.log(ratio)).cast("bigint").alias("gain")).collect()  # `buckets` rows
    released(counted)
    found = dict(rows)
    return [found[i] for i in range(buckets)]


def gumbel(id: Column, seed: int = SEED) -> Column:
    """floor(-1000 * ln(-ln u)) of the hashed id, in doubles."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def scored(documents: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row, in a written table."""
    features = staged(with_features(documents, ["doc_id"]))
    table = gains(bucket_counts(features), bucket_counts(with_features(target, [])))
    # one foldable expression of BUCKETS numbers; the optimizer makes it a constant array
    array = F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")
    weight = F.aggregate("features", F.lit(0).cast("bigint"), lambda sum, bucket: sum + F.get(array, bucket.cast("int")))
    out = staged(
        features.select("doc_id", "n_words", F.size("features").cast("bigint").alias("n_features"), weight.alias("weight")).withColumn(
            "score", F.col("weight") + gumbel(F.col("doc_id"))
        )
    )
    released(features)
    return out


@dataclass(frozen=True)
class Place:
    """The k-th key and how many rows come before it."""

    key: tuple
    before: int


def kth_key(rows: DataFrame, key: tuple[str, ...], k: int, pivots: int = PIVOTS) -> Place:
    """The key of the k-th row (from 1) in ascending order of `key`, by a distributed quickselect.

    `rows` is a stored table with at least k rows whose key columns are whole numbers and never null. Rounds end because
    every range kept leaves out the pivots beside it.
    """
    here = F.struct(*key)
    types = dict(rows.dtypes)
    literal = lambda values: F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(key, values)])
    before, turn, narrowed = 0, 0, []
    while True:
        drawn = rows.select(*key).orderBy(F.xxhash64(F.lit(turn), *key), *key).limit(pivots).collect()
        points = sorted({tuple(row) for row in drawn})
        counts = rows.agg(
            *[F.count_if(here < literal(p)).alias(f"below_{i}") for i, p in enumerate(points)],
            *[F.count_if(here == literal(p)).alias(f"at_{i}") for i, p in enumerate(points)],
        ).first()
        low = high = None
        passed = 0
        for i, point in enumerate(points):
            below, at = counts[f"below_{i}"], counts[f"at_{i}"]
            if before + below < k <= before + below + at:
                if narrowed:
                    released(*narrowed)
                return Place(point, before + below)
            if k <= before + below:
                high = point
                break
            low, passed = point, below + at
        kept = rows
        if low is not None:
            kept = kept.where(here > literal(low))
        if high is not None:
            kept = kept.where(here < literal(high))
        rows, before, turn = staged(kept.select(*key)), before + passed, turn + 1
        if narrowed:
            released(*narrowed)
        narrowed = [rows]


def ranked(scores: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """The rows of `scored` with rank: 1, 2, 3 ... of the drawn ones, null of all others."""
    out = ["doc_id", "n_words", "n_features", "weight", "score"]
    none = F.lit(None).cast("bigint")
    fit = F.col("n_words") >= least_words
    keyed = scores.select(
        *out,
        (-F.col("score")).alias("down"),
        F.col("doc_id").isNull().cast("int").alias("nameless"),
        F.coalesce("doc_id", F.lit(0)).cast("bigint").alias("id"),
    )
    n = scores.where(fit).count()
    k = percent * n // 100
    if k == 0:
        return scores.select(*out, none.alias("rank"))
    last = kth_key(keyed.where(fit), KEY, k)
    types = dict(keyed.dtypes)
    edge = F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(KEY, last.key)])
    first = fit & (F.struct(*KEY) <= edge)
    # rows that agree in the whole key agree in all results: they become one row with a number
    winners = staged(keyed.where(first).groupBy(*KEY, *out[:1], *out[3:]).agg(F.count(F.lit(1)).alias("copies"), F.min("n_words").alias("n_words")))
    numbered = skew.expand(skew.running_total(winners, list(KEY), "copies", "before"), "copies", "copy")
    rank = (F.col("before") + F.col("copy") + 1).cast("bigint")
    drawn = numbered.select(*out, F.when(rank <= k, rank).alias("rank"))
    return drawn.unionByName(keyed.where(~first).select(*out, none.alias("rank")))


def resampled(documents: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every document; `target` needs a column text."""
    return ranked(scored(documents, target), percent, least_words)
