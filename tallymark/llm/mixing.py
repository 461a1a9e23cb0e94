"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its target amount over its actual amount. Each document's number of copies is the
inverse of the Poisson distribution with that mean at a uniform number hashed from seed and document id, so it does not
depend on partitioning or order. Copies are dealt to partitions by a hashed key and sorted by it inside: a global shuffle.

Means above `PART_MEAN` are split into equal independent parts, whose Poisson counts add up to one of the whole mean.

Defined results: a null text counts as empty and a null weight as absent; a null source is a source of its own; a null
id is hashed as the text "null"; rows repeating an id draw the same count; a source without characters gets mean 1;
an empty table gives an empty result. All columns of the input are kept; `copy` and `shuffle_key` are added, replacing
columns of these names; no other column may begin with ~.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import bounded, text_of

SEED = 17
#: Without given weights, a source's target share is proportional to its characters to this power.
TEMPERATURE = 0.5
PART_MEAN = 8.0
#: Terms of a part's cumulative distribution; beyond them lies less than 1e-30 of it.
TERMS = 64


def source_rates(
    documents: DataFrame,
    source: str = "source",
    weights: Mapping[str, float] | None = None,
    budget: float = 1.0,
    temperature: float = TEMPERATURE,
) -> DataFrame:
    """Per source: documents, characters, target share and mean repetition rate.

    `weights` are target shares in any unit; sources it does not name get none of the budget and rate 0. `budget` is the
    amount of text to give out, as a multiple of all characters.
    """
    sizes = documents.groupBy(F.col(source).alias("mixed_source")).agg(
        F.count(F.lit(1)).alias("documents"), F.sum(F.length(text_of())).alias("characters")
    )
    if weights is None:
        weight = F.pow(F.col("characters").cast("double"), F.lit(temperature))
    elif weights:
        given = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
        weight = F.coalesce(F.element_at(given, F.coalesce("mixed_source", F.lit(""))), F.lit(0.0)).cast("double")
    else:
        weight = F.lit(0.0)
    sizes = sizes.withColumn("weight", weight)
    totals = sizes.agg(F.sum("characters").alias("all_characters"), F.sum("weight").alias("all_weight"))
    share = F.when(F.col("all_weight") > 0, F.col("weight") / F.col("all_weight")).otherwise(0.0)
    return (
        sizes.crossJoin(F.broadcast(totals))  # one row
        .withColumn("share", share)
        .withColumn(
            "rate",
            F.when(F.col("characters") > 0, F.col("share") * budget * F.col("all_characters") / F.col("characters")).otherwise(1.0),
        )
        .select("mixed_source", "documents", "characters", "share", "rate")
    )


def _uniform(seed: int, key: Column, part: Column) -> Column:
    """In [0, 1), from 52 bits of a digest."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key, part.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def _cumulative(mean: Column) -> Column:
    """P(X <= k) for k = 0 .. TERMS - 1, by the recurrence of the terms."""
    start = F.struct(F.exp(-mean).alias("term"), F.array(F.exp(-mean)).alias("sums"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS - 1)),
        start,
        lambda a, k: F.struct(
            (a["term"] * mean / k).alias("term"),
            F.concat(a["sums"], F.array(F.element_at(a["sums"], -1) + a["term"] * mean / k)).alias("sums"),
        ),
        lambda a: a["sums"],
    )


def replicated(
    documents: DataFrame,
    source: str = "source",
    key: str = "doc_id",
    weights: Mapping[str, float] | None = None,
    budget: float = 1.0,
    seed: int = SEED,
) -> DataFrame:
    """Each document as often as it was drawn, with its `copy` from 1 and `shuffle_key`, dealt out and sorted by the latter.

    Sources are joined by broadcast while they are few, else by a shuffled join that may split a hot source.
    """
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART_MEAN)).cast("int")
    rates = bounded(
        source_rates(documents, source, weights, budget)
        .withColumn("parts", parts)
        .withColumn("cumulative", _cumulative(F.col("rate") / F.col("parts")))
        .select(F.col("mixed_source").alias("~source"), F.col("parts").alias("~parts"), F.col("cumulative").alias("~cumulative"))
    )
    identity = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    count = F.aggregate(
        F.transform(
            F.sequence(F.lit(0), F.col("~parts") - 1),
            lambda p: F.aggregate(
                F.array(_uniform(seed, identity, p)),  # binds the draw, so that it is hashed once
                F.lit(0),
                lambda _, u: F.size(F.filter("~cumulative", lambda c: c <= u)),
            ),
        ),
        F.lit(0),
        lambda a, x: a + x,
    )
    plain = documents.drop("copy", "shuffle_key")
    drawn = (
        plain.join(rates, F.col(source).eqNullSafe(F.col("~source")))
        .withColumn("~copies", count)
        .where(F.col("~copies") > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("~copies"))))
        .select(*[F.col(f"`{c}`") for c in plain.columns], "copy")
    )
    shuffle_key = F.md5(F.concat_ws(":", F.lit(str(seed)), identity, F.col("copy").cast("string"), F.lit("order")))
    return (
        drawn.withColumn("shuffle_key", F.conv(F.substring(shuffle_key, 1, 13), 16, 10).cast("bigint"))
        .repartition("shuffle_key")
        .sortWithinPartitions("shuffle_key")
    )
