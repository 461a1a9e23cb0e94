"""Line dedup by a log-template tree.

Lines are led down a tree of fixed depth: by their number of tokens, then by their leading tokens, where tokens with a
digit count as one variable token. At a leaf, positions whose commonest token stays below a share of the leaf's distinct
lines are variable fields; a line's template has a mark in place of these. Lines whose template would keep too little
of its tokens are not generalised, so that lines which merely begin alike stay apart: their template is the line with
its digits marked. Templates found in enough different texts are dropped from all documents but the first that has them.

Copies of a whole text count once, so copying a document does not make its lines recurring ones.

Only hashes of lines and leaves are shuffled, not the lines; tokens are compared only in leaves with several lines.

Defined results: a null or empty text stays as it is; lines without a token are never dropped by themselves; the first
document is the one of the smallest id, nulls first, then of the smallest text hash; rows repeating id and text get the
same result each; a document that loses all its lines with tokens goes, one without any stays; an empty table gives an
empty result. All columns of the input are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import SPACE, bounded, staged, text_of

#: Leading tokens on the way to a leaf.
DEPTH = 3
#: Share of a leaf's distinct lines that a position's commonest token must reach to be constant.
CONSTANT = 0.5
#: Share of the tokens after the leading ones that must be constant for a template.
KEPT = 0.5
#: Shorter lines are not generalised.
LEAST_TOKENS = 8
#: Different texts a template must occur in: lines long enough that two texts have them by no chance, and shorter ones.
TEXTS, SHORT_TEXTS = 2, 16
MARK = "<*>"
#: Rows of a table of leaves or lines (hashes) that may be broadcast; beyond, joins shuffle.
LEAVES = 400_000


def _tokens(line: Column) -> Column:
    return F.split(line, " ")


def _masked(line: Column) -> Column:
    """Tokens with a digit become the mark."""
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*", MARK)).otherwise(line)


def lines(documents: DataFrame) -> DataFrame:
    """id, key (of the text), at, n (tokens), leaf and line (hashes, two of each line), masked, of every line with a token."""
    rows = documents.select(F.col("doc_id").alias("id"), F.xxhash64(text_of()).alias("key"), F.posexplode(F.split(text_of(), "\n")).alias("at", "line"))
    rows = rows.where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))  # on the line itself: a filter on what follows would repeat it
    rows = rows.select("id", "key", "at", _masked(F.btrim("line", F.lit(SPACE))).alias("masked"))
    # single spaces between tokens; then the number of tokens needs no array of them
    odd = F.lit(False)
    for pair in ("  ", *SPACE[1:]):
        odd = odd | F.col("masked").contains(pair)
    single = F.when(odd, F.regexp_replace("masked", r"[\x20\x09-\x0D]+", " ")).otherwise(F.col("masked"))
    rows = rows.select("id", "key", "at", single.alias("masked"))
    spaces = F.length("masked") - F.length(F.replace(F.col("masked"), F.lit(" "), F.lit("")))
    return rows.select(
        "id",
        "key",
        "at",
        "masked",
        (spaces + 1).alias("n"),
        F.xxhash64(spaces, F.substring_index("masked", " ", DEPTH)).alias("leaf"),
        F.xxhash64(F.lit(1), "masked").alias("l1"),
        F.xxhash64(F.lit(2), "masked").alias("l2"),
    )


def generalised(documents: DataFrame, hashes: DataFrame) -> DataFrame:
    """l1, l2, template (hash) of the distinct lines whose template has variable fields. `hashes`: lines without `masked`."""
    distinct = hashes.where(F.col("n") >= LEAST_TOKENS).select("leaf", "l1", "l2").distinct()
    several = bounded(distinct.groupBy("leaf").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), LEAVES)
    rows = lines(documents).select("leaf", "l1", "l2", "masked").join(several, "leaf")
    texts = staged(rows.groupBy("leaf", "size", "l1", "l2").agg(F.first("masked").alias("masked")))
    tokens = texts.select("leaf", "size", "l1", "l2", F.posexplode(_tokens(F.col("masked"))).alias("at", "token")).where(F.col("at") >= DEPTH)
    shares = tokens.groupBy("leaf", "size", "at", "token").agg(F.count(F.lit(1)).alias("lines"))
    fields = (
        shares.groupBy("leaf", "size", "at")
        .agg(F.max("lines").alias("most"))
        .groupBy(F.col("leaf").alias("of_leaf"))
        .agg(F.sort_array(F.collect_list(F.struct("at", (F.col("most") >= CONSTANT * F.col("size")).alias("constant")))).alias("fields"))
        .withColumn("constants", F.size(F.filter("fields", lambda x: x["constant"])))
    )
    rest = F.col("n") - DEPTH
    words = (
        texts.join(fields, F.col("leaf") == F.col("of_leaf"))
        .withColumn("n", F.size("fields") + DEPTH)
        .where((F.col("constants") < rest) & (F.col("constants") >= KEPT * rest))
    )
    template = F.transform(
        _tokens(F.col("masked")), lambda x, i: F.when((i < DEPTH) | F.get(F.col("fields"), i - DEPTH)["constant"], x).otherwise(MARK)
    )
    return words.select("l1", "l2", F.xxhash64(F.lit("template"), F.array_join(template, " ")).alias("template"))


def recurring(documents: DataFrame, texts: int = TEXTS, short_texts: int = SHORT_TEXTS) -> DataFrame:
    """id, key, at of every line to be dropped.

    A line of fewer than LEAST_TOKENS tokens (a short sentence, a brace, a heading) must stand in `short_texts` texts.
    """
    rows = staged(lines(documents).drop("masked"))
    templates = bounded(generalised(documents, rows), LEAVES)
    found = staged(
        rows.select("id", "key", "at", "n", "l1", "l2")
        .join(templates.withColumnsRenamed({"l1": "t1", "l2": "t2"}), (F.col("l1") == F.col("t1")) & (F.col("l2") == F.col("t2")), "left")
        .select("id", "key", "at", "n", F.coalesce("template", "l1").alias("x1"), F.when(F.col("template").isNull(), F.col("l2")).otherwise(F.lit(0)).alias("x2"))
    )
    often = (
        found.groupBy("x1", "x2", "key")
        .agg(F.min(F.struct("id", "key")).alias("first"), F.max("n").alias("n"))
        .groupBy("x1", "x2")
        .agg(F.count(F.lit(1)).alias("texts"), F.min("first").alias("first"), F.max("n").alias("n"))
        .where(F.col("texts") >= F.when(F.col("n") >= LEAST_TOKENS, texts).otherwise(short_texts))
        .select("x1", "x2", "first")
    )
    # one template may have a third of all lines: the table of templates is broadcast while it is small, so that they stay put
    return (
        found.join(bounded(often, LEAVES), ["x1", "x2"])
        .where(~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("key") == F.col("first.key"))))
        .select("id", "key", "at")
    )


def deduplicated(documents: DataFrame, texts: int = TEXTS, short_texts: int = SHORT_TEXTS) -> DataFrame:
    """The documents without their recurring lines, and `dropped_lines`, how many each has lost. No column may begin with ~."""
    drops = recurring(documents, texts, short_texts).groupBy("id", "key").agg(F.collect_set("at").alias("~drops")).withColumnsRenamed({"id": "~id", "key": "~same"})
    rows = documents.withColumn("~key", F.xxhash64(text_of()))
    joined = rows.join(drops, F.col("doc_id").eqNullSafe(F.col("~id")) & (F.col("~key") == F.col("~same")), "left")
    left = lambda x: F.array_join(
        F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("~drops")), lambda i: F.get(x, i)), "\n"
    )
    kept = F.get(F.transform(F.array(F.split("text", "\n")), left), F.lit(0))
    return (
        joined.withColumn("text", F.when(F.col("~drops").isNull(), F.col("text")).otherwise(kept))
        .withColumn("dropped_lines", F.coalesce(F.size("~drops"), F.lit(0)))
        .where(F.col("~drops").isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
        .select(*[F.col(f"`{c}`") for c in documents.columns if c != "dropped_lines"], "dropped_lines")
    )
