"""MinHash near-duplicates by a multi-index Hamming join.

1. Every whole text is turned once into its set of word shingles and the set's signature: VALUES minimum hashes, BITS bits of
   each. Two sets differ in a value with a probability of one minus their similarity.
2. The signature is split into CHUNKS chunks. Two signatures that differ in at most THRESHOLD values differ, by the
   pigeonhole, in at most ERRORS values of some chunk. All errors a chunk may have are enumerated: for every choice of ERRORS
   places the chunk without them, hashed, is an index key. So all pairs within the threshold share a key, at the least.
3. Keys of two documents give a pair at once, keys of few documents are joined. Pairs whose signatures are hopelessly far
   apart go, the others are confirmed on the full sets.
4. Keys of many documents (crowds of near copies) are not paired off. Their documents are described by what they differ in
   from the crowd's consensus. Those close enough to link whatever their differences are form a star. Only between
   documents that are not connected by then, links are looked for through rare differences they share.
5. The components of all confirmed links are found by spreading labels.

At a similarity of 0.8 a pair is within the threshold with a probability of 0.997, and shares a key with one of 0.99998;
whatever shares a key is confirmed, so the second is the recall of a single link. Nothing is sampled or capped.

Defined results: a null or wordless text has an empty set and links with nothing; a text shorter than a shingle is one
shingle; a null id takes no part in links, has a null component and is kept; documents of equal text are one class, for which
the smallest id stands; rows repeating an id are one node; an empty table gives an empty result. Other columns of the input
are not read, whatever their names.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import bounded, released, staged
from tallymark.llm.jaccard_join import components, sets_of, text_keys, with_sets

PERCENT = 80
WIDTH = 4
#: Values of a signature, bits of each, its chunks, and the errors enumerated in a chunk.
VALUES, BITS = 40, 16
CHUNKS, ERRORS = 8, 1
#: All pairs of signatures that differ in at most so many values are found.
THRESHOLD = CHUNKS * (ERRORS + 1) - 1
#: Pairs that share a key but differ in more values than this are not confirmed: at a similarity of 0.8, 2 in 10 millions.
HOPELESS = 22
#: The documents of a key with more than this are a crowd.
LONG = 16
SEED = 0x5EED
#: Shingles hashed at once.
BLOCK = 1 << 16


def _mixers(values: int, seed: int = SEED) -> np.ndarray:
    """Odd multipliers, one for each value of the signature."""
    return np.random.default_rng(seed).integers(0, 2**63, values, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minima(flat: np.ndarray, starts: np.ndarray, values: int = VALUES, bits: int = BITS) -> np.ndarray:
    """Signatures (rows) of the non-empty sets that begin at `starts` in `flat`, an array of 64-bit shingle hashes."""
    out = np.empty((len(starts), values), dtype=np.int32)
    for i, odd in enumerate(_mixers(values)):
        mixed = flat * odd
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        out[:, i] = np.minimum.reduceat(mixed, starts) & np.uint64(2**bits - 1)
    return out


def with_signatures(sets: DataFrame, values: int = VALUES, bits: int = BITS) -> DataFrame:
    """doc_id, f1, f2, n and signature (null for an empty set) from doc_id, f1, f2, set."""

    def run(batches):
        for batch in batches:
            column = batch.column("set")
            offsets = column.offsets.to_numpy()
            sizes = np.diff(offsets)
            flat = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
            full = np.flatnonzero(sizes)
            found = np.zeros((len(sizes), values), dtype=np.int32)
            at = 0
            while at < len(full):  # as many sets as fill a block, one at least
                upto = max(at + 1, int(np.searchsorted(offsets[full], offsets[full[at]] + BLOCK)))
                some = full[at:upto]
                begin, end = offsets[some[0]], offsets[some[-1] + 1]
                found[some] = minima(flat[begin:end], offsets[some] - begin, values, bits)
                at = upto
            signature = pa.ListArray.from_arrays(
                pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * values), pa.array(found.reshape(-1)), mask=pa.array(sizes == 0)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("f1"), batch.column("f2"), pa.array(sizes.astype(np.int64)), signature],
                names=["doc_id", "f1", "f2", "n", "signature"],
            )

    kind = dict(sets.dtypes)["doc_id"]
    return sets.select("doc_id", "f1", "f2", "set").mapInArrow(run, f"doc_id {kind}, f1 bigint, f2 bigint, n bigint, signature array<int>")


def index_keys(signature: Column, values: int = VALUES, chunks: int = CHUNKS, errors: int = ERRORS) -> Column:
    """The keys of a signature: of every chunk, what is left without each choice of `errors` places."""
    bounds = np.linspace(0, values, chunks + 1).astype(int).tolist()
    keys = []
    for begin, end in zip(bounds, bounds[1:]):
        for left in combinations(range(begin, end), max(end - begin - errors, 0)):
            keys.append(F.xxhash64(F.lit(len(keys)), *[F.get(signature, F.lit(i)) for i in left]))
    return F.array(*keys)


def candidates(classes: DataFrame, long: int = LONG) -> tuple[DataFrame, DataFrame]:
    """Written pairs (a, b) to be confirmed, and (id, pivot) for every crowd a document is in, from id, signature."""
    entries = classes.select("id", F.explode(index_keys(F.col("signature"))).alias("key"))
    shared = staged(
        entries.groupBy("key")
        .agg(F.count(F.lit(1)).alias("documents"), F.min("id").alias("a"), F.max("id").alias("b"))
        .where("a < b")
    )
    larger = bounded(shared.where("documents > 2").select("key", "documents"))
    members = staged(entries.join(larger, "key"))
    few = members.where(F.col("documents") <= long)
    x, y = few.alias("x"), few.alias("y")
    met = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.id") < F.col("y.id"))).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    pairs = staged(shared.where("documents = 2").select("a", "b").unionByName(met).distinct())
    many = members.where(F.col("documents") > long)
    # a crowd is named by the document in its middle, whose keys most documents share: keys with the same are one crowd
    central = many.groupBy("id").agg(F.sum("documents").alias("met"))
    pivots = many.join(central, "id").groupBy("key").agg(F.max(F.struct("met", (-F.col("id")).alias("id"))).alias("head"))
    crowds = staged(many.join(pivots.select("key", (-F.col("head.id")).alias("pivot")), "key").select("id", "pivot").distinct())
    released(shared, members)
    return pairs, crowds


def confirmed(documents: DataFrame, classes: DataFrame, pairs: DataFrame, percent: int, width: int, hopeless: int = HOPELESS) -> DataFrame:
    """The pairs that link on their full sets."""
    side = lambda name: classes.select(F.col("id").alias(name), F.col("signature").alias(f"s{name}"))
    differ = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x != y), lambda d: d))
    near = staged(pairs.join(side("a"), "a").join(side("b"), "b").where(differ <= hopeless).select("a", "b").distinct())
    sets = sets_of(documents, near.select("a").union(near.select("b")).toDF("id"), width)
    shared = F.size(F.array_intersect("sa", "sb"))
    linked = staged(
        near.join(sets.withColumnsRenamed({"id": "a", "set": "sa"}), "a")
        .join(sets.withColumnsRenamed({"id": "b", "set": "sb"}), "b")
        .where(100 * shared >= percent * (F.size("sa") + F.size("sb") - shared))
        .select("a", "b")
        .distinct()
    )
    released(near, sets)
    return linked


def described(documents: DataFrame, crowds: DataFrame, width: int) -> DataFrame:
    """id, pivot, n, d: of every document in a crowd its set's size and its symmetric difference from the crowd's consensus.

    The consensus are the tokens that more than half of the crowd hold, at most twice as many as a document has on average.
    Unlike a member it has no peculiarities, which would be differences that all others share.
    """
    sets = sets_of(documents, crowds.select("id"), width)
    held = staged(crowds.join(sets, "id").select("id", "pivot", "set"))
    sizes = held.groupBy("pivot").agg(F.count(F.lit(1)).alias("members"))
    counts = held.select("pivot", F.explode("set").alias("token")).groupBy("pivot", "token").agg(F.count(F.lit(1)).alias("df"))
    most = counts.join(sizes, "pivot").where(2 * F.col("df") > F.col("members"))
    middle = most.groupBy("pivot").agg(F.collect_list("token").alias("middle"))
    both = held.join(middle, "pivot", "left").withColumn("middle", F.coalesce("middle", F.array().cast("array<bigint>")))
    apart = F.concat(F.array_except("set", "middle"), F.array_except("middle", "set"))
    out = staged(both.select("id", "pivot", F.size("set").cast("bigint").alias("n"), apart.alias("d")))
    released(sets, held)
    return out


def stars(crowd: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that the sizes of the differences prove.

    Sets A and B link exactly when |dA xor dB| <= k * (nA + nB), k = (100 - percent) / (100 + percent). Where |dA| - k * nA and
    |dB| - k * nB add up to 0 or less they do so whatever the differences are; if two documents prove their link in this way,
    both prove one with the document of the least such number.
    """
    p, q = 100 - percent, 100 + percent
    weighed = crowd.select("id", "pivot", (q * F.size("d") - p * F.col("n")).cast("bigint").alias("weight"))
    centre = weighed.groupBy("pivot").agg(F.min(F.struct("weight", "id")).alias("centre"))
    proven = (F.col("weight") + F.col("centre.weight") <= 0) & (F.col("id") != F.col("centre.id"))
    return weighed.join(centre, "pivot").where(proven).select(F.col("centre.id").alias("a"), F.col("id").alias("b")).distinct()


def across(crowd: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) inside crowds between documents of different labels (id, component; without one, a document is its own).

    What the sizes do not prove needs a common difference: one among the rarest of either side, as two linked sets differ in
    at most k' * n tokens, k' = (100 - percent) / percent, so that more of a document's differences need not be looked at.
    """
    p, q = 100 - percent, 100 + percent
    labelled = crowd.join(labels.withColumnRenamed("component", "label"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    mixed = labelled.groupBy("pivot").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("pivot")
    open_ = staged(labelled.join(mixed, "pivot", "left_semi"))
    tokens = open_.select("id", "pivot", F.explode("d").alias("token"))
    shared = tokens.groupBy("pivot", "token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    common = tokens.join(shared, ["pivot", "token"]).groupBy("id", "pivot").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("common"))
    # differences that no other document has come first; only their number matters
    ordered = (
        open_.join(common, ["id", "pivot"])
        .select("id", "pivot", "n", "label", F.size("d").cast("bigint").alias("size"), F.size("common").alias("some"), F.posexplode("common").alias("at", "c"))
        .where(percent * (F.col("size") - F.col("some") + F.col("at")) <= p * F.col("n"))
        .select("id", "pivot", "n", "label", "size", "some", "at", F.col("c.token").alias("token"))
    )
    x, y = ordered.alias("x"), ordered.alias("y")
    total, slack = F.col("x.size") + F.col("y.size"), p * (F.col("x.n") + F.col("y.n"))
    # the most they can share, if they share this one: of those that come first in the order, and of those that follow
    room = F.least("x.at", "y.at") + 1 + F.least(F.col("x.some") - F.col("x.at") - 1, F.col("y.some") - F.col("y.at") - 1)
    match = (
        (F.col("x.pivot") == F.col("y.pivot"))
        & (F.col("x.token") == F.col("y.token"))
        & (F.col("x.id") < F.col("y.id"))
        & (F.col("x.label") != F.col("y.label"))
        & (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n"))
        & (q * total > slack)
        & (q * (total - 2 * room) <= slack)
    )
    pairs = x.join(y, match).select("x.pivot", F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    side = lambda name: open_.select("pivot", F.col("id").alias(name), F.col("n").alias(f"n{name}"), F.col("d").alias(f"d{name}"))
    apart = F.size("da") + F.size("db") - 2 * F.size(F.array_intersect("da", "db"))
    linked = pairs.join(side("a"), ["pivot", "a"]).join(side("b"), ["pivot", "b"]).where(q * apart <= p * (F.col("na") + F.col("nb")))
    found = staged(linked.select("a", "b").distinct())
    released(open_)
    return found


def grouped(documents: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """Every row's doc_id, n_shingles, component_id and kept."""
    f1, f2 = text_keys()
    sets = with_sets(documents.select("doc_id", "text", f1.alias("f1"), f2.alias("f2")), ["doc_id", "f1", "f2"], width)
    signed = staged(with_signatures(sets))
    rows = signed.where("doc_id IS NOT NULL")
    one = rows.groupBy("f1", "f2").agg(F.min(F.struct("doc_id", "n", "signature")).alias("one"))
    classes = staged(one.select("f1", "f2", F.col("one.doc_id").alias("id"), F.col("one.n").alias("n"), F.col("one.signature").alias("signature")))
    full = classes.where("n > 0").select("id", "signature")
    pairs, crowds = candidates(full)
    links = confirmed(documents, full, pairs, percent, width)
    if not crowds.isEmpty():
        crowd = described(documents, crowds, width)
        links = staged(links.unionByName(stars(crowd, percent)))
        links = links.unionByName(across(crowd, components(links), percent))
    # an id with several texts is one node and joins their classes
    reused = (
        rows.where("n > 0").groupBy(F.col("doc_id").alias("b")).agg(F.min(F.struct("f1", "f2")).alias("low"), F.max(F.struct("f1", "f2")).alias("high"))
    ).where("low <> high")
    named = rows.select("doc_id", "f1", "f2", "n").join(classes.select("f1", "f2", "id"), ["f1", "f2"])
    several = named.where("n > 0 AND doc_id <> id").select(F.col("id").alias("a"), F.col("doc_id").alias("b")).join(reused, "b", "left_semi").select("a", "b")
    found = components(links.unionByName(several).distinct())
    by_class = named.join(found, "id", "left").select("doc_id", "n", F.when(F.col("n") > 0, F.coalesce("component", "id")).alias("component"))
    own = found.withColumnsRenamed({"id": "doc_id", "component": "own"})
    out = by_class.join(own, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "own", "doc_id").alias("component_id")
    )
    nameless = signed.where("doc_id IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.unionByName(nameless).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
