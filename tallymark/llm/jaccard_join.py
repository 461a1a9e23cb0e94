"""Exact n-gram Jaccard join with several global token orders, and its components.

A document's set are the hashes of its distinct word windows. Two documents link when 100 * intersection >= PERCENT * union.

* Documents with equal texts are one class from the start; its smallest id stands for it.
* Under any order of all tokens, two sets that link share a token among the first n - ceil(PERCENT * n / 100) + 1 of each.
  Two orders are used, and candidates must share such a token under both. Both put rare tokens first: rare ones of a fixed
  quarter of the hash space (their counts are known), then, where a document has too few of these, rare ones of the rest,
  then frequent ones by frequency. They differ in how ties are broken.
* Candidates come from the first order's postings, with length and positional filters in the join. The second order and
  the exact check follow.
* Long postings (many near copies of one text) are not paired off. Their documents are compared with one of them, the
  pivot, and described by what they differ in. Documents whose differences are small enough to link whatever they are form a
  star; all other links must share a difference, and differences, rarest first, are joined by the same prefix and positional
  filters. This yields the same components from far fewer pairs.

Nothing is sampled or capped: the quarter and the limits below only choose between exact ways.

Defined results: a null or wordless text has an empty set and links with nothing; a text shorter than a window is one
window; a null id takes no part in links and has a null component; rows repeating an id are one node, each row counted for
itself; an empty table gives an empty result. Other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import ascii_lower, bounded, released, space_words, staged, text_of, window_hashes

PERCENT = 90
WIDTH = 3
#: A token in more documents than this is frequent.
RARE = 16
#: A posting with more documents than this is handled through a pivot.
LONG = 32
#: Tokens with these low bits zero are counted for all documents.
COUNTED_MASK = 3
#: Rows of a table of ids or tokens with counts that may be broadcast (16 bytes each); beyond, joins shuffle.
IDS = 400_000


def least_prefix(n: Column, percent: int) -> Column:
    """n - ceil(percent * n / 100) + 1"""
    return (n - F.floor((percent * n + 99) / 100) + 1).cast("int")


def least_overlap(n: Column, percent: int) -> Column:
    """The smallest intersection of two linked sets whose sizes add up to n: ceil(percent * n / (100 + percent))."""
    return F.ceil(percent * n / (100 + percent) - 1e-9).cast("bigint")


def _of_words(keep: list[str], documents: DataFrame, what) -> DataFrame:
    """`keep` and what(words) of each whole text. Bound to a variable, the words are split once wherever the optimizer
    repeats the expression."""
    words = F.array(space_words(ascii_lower(text_of())))
    return documents.select(*keep, F.get(F.transform(words, what), F.lit(0)).alias("x"))


def _set(w: Column, width: int) -> Column:
    return (
        F.when(F.size(w) >= width, F.array_distinct(window_hashes(w, width)))
        .when(F.size(w) > 0, F.array(F.xxhash64(F.lit("short"), w)))
        .otherwise(F.array().cast("array<bigint>"))
    )


def with_sets(documents: DataFrame, keep: list[str], width: int = WIDTH) -> DataFrame:
    """`keep` and `set`: the distinct window hashes of each whole text."""
    return _of_words(keep, documents, lambda w: _set(w, width)).withColumnRenamed("x", "set")


def text_keys() -> tuple[Column, Column]:
    """Two hashes that together tell texts apart; the first alone tells those of one id apart."""
    return F.xxhash64(text_of()), F.xxhash64(F.lit("text"), text_of())


def of_ids(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """id, key (of the text), text of the documents with these ids."""
    rows = documents.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), text_keys()[0].alias("key"), "text")
    return rows.join(bounded(ids.distinct(), IDS), "id", "left_semi")


def prefixes(documents: DataFrame, classes: DataFrame, percent: int, width: int) -> tuple[DataFrame, DataFrame, tuple[DataFrame, ...]]:
    """Of every class its size (id, key, n) and its first tokens under either order (id, n, p1, p2), and the latter's tables."""
    sets = with_sets(of_ids(documents, classes.select("id")), ["id", "key"], width)
    is_counted = lambda x: x.bitwiseAND(F.lit(COUNTED_MASK)) == 0
    stored = staged(sets.select("id", "key", F.size("set").cast("bigint").alias("n"), F.filter("set", is_counted).alias("counted")))
    sizes = staged(stored.select("id", "key", "n").distinct())
    counted = stored.where("n > 0")
    tokens = counted.select("id", F.explode("counted").alias("token"))
    frequent = bounded(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") > RARE), IDS)
    held = tokens.join(frequent, "token").groupBy("id").agg(F.collect_set("token").alias("frequent"))
    rare = F.array_except("counted", F.coalesce("frequent", F.array().cast("array<bigint>")))
    m = least_prefix(F.col("n"), percent)
    second = F.transform("rare", lambda x: F.struct(F.xxhash64(F.lit(2), x).alias("h"), x.alias("x")))
    rich = F.size("rare") >= m
    split = staged(
        counted.join(held, "id", "left")
        .select("id", "n", rare.alias("rare"))
        .select(
            "id",
            "n",
            F.when(rich, F.slice(F.sort_array("rare"), F.lit(1), m)).alias("p1"),
            F.when(rich, F.transform(F.slice(F.sort_array(second), F.lit(1), m), lambda s: s["x"])).alias("p2"),
        )
    )
    released(stored)
    # documents with too few rare tokens in the counted part: the rest is counted among these documents alone
    whole = staged(
        with_sets(of_ids(documents, split.where("p1 IS NULL").select("id")), ["id", "key"], width)
        .select("id", "key", F.size("set").cast("bigint").alias("n"), F.explode("set").alias("token"))
        .distinct()
    )
    rest = whole.where(~is_counted(F.col("token"))).groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    often = bounded(rest.where(F.col("df") > RARE).unionByName(frequent), IDS)
    level = F.when(F.col("df").isNotNull(), 2).when(is_counted(F.col("token")), 0).otherwise(1)
    ranked = (
        whole.join(often, "token", "left")
        .groupBy("id", "key", "n")
        .agg(F.collect_list(F.struct(level.alias("level"), F.coalesce("df", F.lit(0)).alias("df"), "token")).alias("all"))
    )
    ordered = lambda ties: F.transform(
        F.slice(F.sort_array(F.transform("all", lambda x: F.struct(x["level"], *ties(x), x["token"].alias("token")))), F.lit(1), m),
        lambda x: x["token"],
    )
    poor = ranked.select(
        "id",
        "n",
        ordered(lambda x: [x["df"]]).alias("p1"),
        ordered(lambda x: [F.floor(F.log2(x["df"] + 1)), F.xxhash64(F.lit(2), x["token"])]).alias("p2"),
    )
    poor = staged(poor)
    released(whole)
    return sizes, split.where("p1 IS NOT NULL").unionByName(poor), (split, poor)


def _room(i: Column, j: Column, a: Column, b: Column) -> Column:
    """The most two ordered sets of sizes a and b can share that share the tokens at i and j (from 0)."""
    return F.least(i, j) + 1 + F.least(a - i - 1, b - j - 1)


def _near(a: str, b: str, percent: int) -> Column:
    """Sizes let two sets link."""
    return 100 * F.least(F.col(f"{a}.n"), F.col(f"{b}.n")) >= percent * F.greatest(F.col(f"{a}.n"), F.col(f"{b}.n"))


def paired(left: DataFrame, right: DataFrame, percent: int, among: Column) -> DataFrame:
    """Distinct pairs (a, b), a < b, of documents in one posting that pass the length and positional filters and `among`."""
    need = least_overlap(F.col("x.n") + F.col("y.n"), percent)
    match = (
        (F.col("x.token") == F.col("y.token"))
        & among
        & _near("x", "y", percent)
        & (_room(F.col("x.at"), F.col("y.at"), F.col("x.n"), F.col("y.n")) >= need)
    )
    return left.alias("x").join(right.alias("y"), match).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def verified(documents: DataFrame, records: DataFrame, pairs: DataFrame, percent: int, width: int, done: tuple[DataFrame, ...]) -> DataFrame:
    """Of the pairs, those that share a prefix token under the second order and link. `done` is not read afterwards.

    Before whole sets are sent, 16 bits of each token bound the intersection from above: it cannot exceed the distinct
    values shared plus the tokens that either set loses by equal values.
    """
    pairs = staged(pairs)
    ids = pairs.select("a").union(pairs.select("b")).toDF("id").distinct()
    second = staged(records.select("id", "p2").join(bounded(ids, IDS), "id", "left_semi"))
    released(*done)
    near = staged(
        pairs.join(second.withColumnsRenamed({"id": "a", "p2": "pa"}), "a")
        .join(second.withColumnsRenamed({"id": "b", "p2": "pb"}), "b")
        .where(F.arrays_overlap("pa", "pb"))
        .select("a", "b")
        .distinct()
    )
    released(pairs, second)
    sets = sets_of(documents, near.select("a").union(near.select("b")).toDF("id"), width)
    low = F.array_distinct(F.transform("set", lambda x: (x.bitwiseAND(F.lit(0xFFFF)) - 0x8000).cast("smallint")))
    short = staged(sets.select("id", F.size("set").alias("n"), low.alias("low")))
    one = lambda side: short.select(*[F.col(c).alias(c + side if c != "id" else side) for c in ("id", "n", "low")])
    most = F.size(F.array_intersect("lowa", "lowb")) + F.least(F.col("na") - F.size("lowa"), F.col("nb") - F.size("lowb"))
    close = staged(
        near.join(one("a"), "a").join(one("b"), "b").where(100 * most >= percent * (F.col("na") + F.col("nb") - most)).select("a", "b").distinct()
    )
    released(near, short)
    shared = F.size(F.array_intersect("sa", "sb"))
    linked = staged(
        close.join(sets.withColumnsRenamed({"id": "a", "set": "sa"}), "a")
        .join(sets.withColumnsRenamed({"id": "b", "set": "sb"}), "b")
        .where(100 * shared >= percent * (F.size("sa") + F.size("sb") - shared))
        .select("a", "b")
        .distinct()
    )
    released(close, sets)
    return linked


def sets_of(documents: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    return staged(with_sets(of_ids(documents, ids), ["id"], width))


def near_pivots(documents: DataFrame, pivots: DataFrame, percent: int, width: int) -> DataFrame:
    """Links among documents of one pivot, enough of them to connect all that are linked.

    With d the differences from the pivot and k = 100 - percent over 100 + percent, documents A and B link exactly when
    |dA xor dB| <= k * (nA + nB). If |dA| + |dB| does not exceed that they link whatever the differences are; of these pairs
    only those with the document of the least |d| - k * n are given, to which every other one is linked as well. Any other
    pair must share more than (|dA| + |dB| - k * (nA + nB)) / 2 differences.
    """
    own = pivots.select("id", "pivot").distinct()
    sets = sets_of(documents, own.select("id").union(own.select("pivot")).toDF("id"), width)
    both = own.join(sets, "id").join(sets.withColumnsRenamed({"id": "pivot", "set": "ps"}), "pivot")
    far = staged(
        both.select(
            "id",
            "pivot",
            F.size("set").cast("bigint").alias("n"),
            F.concat(F.array_except("set", "ps"), F.array_except("ps", "set")).alias("d"),
        )
    )
    released(sets)
    p, q = 100 - percent, 100 + percent
    weight = (q * F.size("d") - p * F.col("n")).cast("bigint")
    weighed = far.select("id", "pivot", weight.alias("weight"))
    centre = weighed.groupBy("pivot").agg(F.min(F.struct("weight", "id")).alias("centre"))
    star = (
        weighed.join(centre, "pivot")
        .where((F.col("weight") + F.col("centre.weight") <= 0) & (F.col("id") != F.col("centre.id")))
        .select(F.col("centre.id").alias("a"), F.col("id").alias("b"))
    )
    # documents of the star are connected by it: pairs of two of them need not be looked for
    starred = weighed.join(centre, "pivot").select("id", "pivot", (F.col("weight") + F.col("centre.weight") <= 0).alias("starred"))
    tokens = far.select("id", "pivot", F.explode("d").alias("token"))
    counts = tokens.groupBy("pivot", "token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = tokens.join(counts, ["pivot", "token"]).groupBy("id", "pivot").agg(F.collect_set(F.struct("df", "token")).alias("shared"))
    # differences no other document has come first in the order; their number is all that matters of them
    ordered = (
        far.join(shared, ["id", "pivot"])
        .join(starred.groupBy("id", "pivot").agg(F.min("starred").alias("starred")), ["id", "pivot"])
        .withColumn("size", F.size("d").cast("bigint"))
        .withColumn("some", F.size("shared").cast("bigint"))
        .select("id", "pivot", "n", "size", "some", "starred", F.posexplode(F.sort_array("shared")).alias("at", "s"))
        # the most two linked sets may differ in: the prefix
        .where(F.col("size") - F.col("some") + F.col("at") <= p * F.col("n") / percent)
        .select("id", "pivot", "n", "size", "some", "starred", "at", F.col("s.token").alias("token"))
    )
    left, right = ordered.alias("a"), ordered.alias("b")
    slack = p * (F.col("a.n") + F.col("b.n"))
    total = F.col("a.size") + F.col("b.size")
    match = (
        (F.col("a.pivot") == F.col("b.pivot"))
        & (F.col("a.token") == F.col("b.token"))
        & (F.col("a.id") < F.col("b.id"))
        & ~(F.col("a.starred") & F.col("b.starred"))
        & _near("a", "b", percent)
        & (q * total > slack)
        # what no other document has cannot be shared: room is that among the others
        & (q * (total - 2 * _room(F.col("a.at"), F.col("b.at"), F.col("a.some"), F.col("b.some"))) <= slack)
    )
    pairs = left.join(right, match).select("a.pivot", F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()
    deltas = far.select("pivot", "id", "n", "d")
    apart = F.size("da") + F.size("db") - 2 * F.size(F.array_intersect("da", "db"))
    linked = (
        pairs.join(deltas.withColumnsRenamed({"id": "a", "n": "na", "d": "da"}), ["pivot", "a"])
        .join(deltas.withColumnsRenamed({"id": "b", "n": "nb", "d": "db"}), ["pivot", "b"])
        .where(q * apart <= p * (F.col("na") + F.col("nb")))
        .select("a", "b")
    )
    found = staged(star.unionByName(linked))
    released(far)
    return found


def links(documents: DataFrame, records: DataFrame, percent: int, width: int, done: tuple[DataFrame, ...]) -> DataFrame:
    """Pairs (a, b) of linked class ids; of links inside a crowd of near copies only as many as connect it."""
    postings = records.select("id", "n", F.posexplode("p1").alias("at", "token"))
    long = bounded(postings.groupBy("token").agg(F.count(F.lit(1)).alias("documents")).where(F.col("documents") > LONG).select("token"), IDS)
    short = postings.join(long, "token", "left_anti")
    found = paired(short, short, percent, F.col("x.id") < F.col("y.id"))
    entries = staged(postings.join(long, "token", "left_semi"))
    # the pivot of a posting is the document in which its token comes first: the one with the fewest rarities
    heads = entries.groupBy("token").agg(F.min(F.struct("at", "id")).alias("head"))
    pivots = entries.join(heads, "token").groupBy("id").agg(F.min("head").alias("head")).select("id", F.col("head.id").alias("pivot"))
    entries = staged(entries.join(staged(pivots), "id"))
    # documents of different pivots in one posting: at least one has not the pivot most of them have
    usual = (
        entries.groupBy("token", "pivot")
        .agg(F.count(F.lit(1)).alias("documents"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("pivots"), F.max(F.struct("documents", "pivot")).alias("usual"))
        .where("pivots > 1")
        .select("token", F.col("usual.pivot").alias("usual"))
    )
    unusual = entries.join(usual, "token").where("pivot <> usual").drop("usual")
    across = paired(unusual, entries, percent, F.col("x.pivot") != F.col("y.pivot"))
    crowd = near_pivots(documents, entries.select("id", "pivot"), percent, width)
    return verified(documents, records, found.unionByName(across).distinct(), percent, width, (*done, entries)).unionByName(crowd).distinct()


def components(edges: DataFrame) -> DataFrame:
    """id, component: the smallest id reachable. Labels spread to neighbours and jump to their labels' labels until none changes."""
    both = staged(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = staged(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("a"), F.min("b")).alias("label")))
    while True:
        around = (
            both.join(labels.withColumnsRenamed({"id": "b"}), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("label").alias("lowest"))
        )
        spread = labels.join(around, "id").select("id", F.least("label", "lowest").alias("next"), "label")
        ahead = labels.select(F.col("id").alias("next"), F.col("label").alias("beyond"))
        moved = staged(spread.join(ahead, "next").select("id", F.least("next", "beyond").alias("next"), "label"))
        labels = moved.select("id", F.col("next").alias("label"))
        if moved.where("next <> label").isEmpty():
            return labels.withColumnRenamed("label", "component")


def grouped(documents: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """Every row's doc_id, n_shingles and component_id."""
    f1, f2 = text_keys()
    rows = staged(documents.where("doc_id IS NOT NULL").select("doc_id", f1.alias("f1"), f2.alias("f2")))
    classes = staged(rows.groupBy("f1", "f2").agg(F.min("doc_id").alias("id")))
    sizes, records, done = prefixes(documents, classes, percent, width)
    sized = staged(classes.join(sizes.withColumnRenamed("key", "f1"), ["id", "f1"]))
    joined = links(documents, records, percent, width, done)
    # an id with several texts is one node of several classes
    reused = rows.groupBy(F.col("doc_id").alias("b")).agg(F.min(F.struct("f1", "f2")).alias("low"), F.max(F.struct("f1", "f2")).alias("high"))
    several = rows.join(sized.where("n > 0"), ["f1", "f2"]).where(F.col("doc_id") != F.col("id")).select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    found = components(joined.unionByName(several.join(reused.where("low <> high"), "b", "left_semi").select("a", "b").distinct()))
    by_class = sized.join(found, "id", "left").select("f1", "f2", "n", F.when(F.col("n") > 0, F.coalesce("component", "id")).alias("component"))
    named = rows.join(by_class, ["f1", "f2"]).join(found.withColumnsRenamed({"id": "doc_id", "component": "own"}), "doc_id", "left")
    nameless = with_sets(documents.where("doc_id IS NULL"), ["doc_id"], width)
    return named.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce(F.when(F.col("n") > 0, F.col("component")), F.col("own"), F.col("doc_id")).alias("component_id")
    ).unionByName(nameless.select("doc_id", F.size("set").cast("bigint").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def one_of_each(documents: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """The documents that have the smallest id of their component, one row of each id. Null ids stay."""
    found = staged(grouped(documents, percent, width))
    later = bounded(found.where("component_id <> doc_id").select("doc_id").distinct(), IDS)
    repeated = bounded(found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), IDS)
    first = documents.join(later, "doc_id", "left_anti").select(*[documents[f"`{c}`"] for c in documents.columns])
    single = first.join(repeated, "doc_id", "left_anti").select(*[f"`{c}`" for c in documents.columns])
    double = first.join(repeated, "doc_id", "left_semi").select(*[f"`{c}`" for c in documents.columns])
    return single.unionByName(double.dropDuplicates(["doc_id"]))
