"""Quality rules with host verdicts.

Every document is measured in its own row. Rule failures are summed by host, the rates of each rule are shrunk with a
beta prior fitted to all hosts, and hosts whose shrunk rate stays above the limit are rejected with all their documents.

Defined results: a null text counts as empty (no words, so it fails `short`); a null host is a host of its own; every
input row gives one output row, repeated rows included; an empty table gives an empty result; other columns of the input
are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import bounded, space_words, staged, text_of, window_hashes

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: Rule: its condition over the measures, and the shrunk failure rate from which a host is rejected.
RULES: dict[str, tuple[str, float]] = {
    "short": (f"n_words < {MIN_WORDS}", 0.9),
    "repeated": (f"100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words", 0.9),
    "symbols": ("4 * n_symbols > word_chars", 0.9),
    "copied_lines": ("2 * n_dup_lines > n_lines", 0.9),
}
BASE = ("short", "repeated")
#: The prior weighs as much as so many documents, at least and at most.
LEAST_WEIGHT, MOST_WEIGHT = 2.0, 1000.0


def measured(df: DataFrame, keep: list[Column]) -> DataFrame:
    """The columns `keep` and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines of `text`."""
    names = [f"k{i}" for i in range(len(keep))]
    rows = df.select(*[c.alias(n) for c, n in zip(keep, names)], text_of().alias("t"))
    rows = rows.withColumn("w", space_words(F.col("t"))).withColumn(
        "lines", F.filter(F.split("t", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    )
    rows = rows.withColumn("h", window_hashes(F.col("w")))
    # only texts with a repeated window pay for sorting windows by (hash, position)
    rows = rows.withColumn(
        "s",
        F.when(
            F.size(F.array_distinct("h")) < F.size("h"),
            F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i")))),
        ),
    )
    s = F.col("s")
    twice = F.filter(
        s,
        lambda x, k: F.coalesce(F.get(s, k - 1)["x"] == x["x"], F.lit(False))
        | F.coalesce(F.get(s, k + 1)["x"] == x["x"], F.lit(False)),
    )
    places = F.sort_array(F.transform(twice, lambda x: x["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n")),
        lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    long = lambda c: c.cast("bigint")
    return rows.select(
        *names,
        long(F.size("w")).alias("n_words"),
        long(F.length(F.array_join("w", ""))).alias("word_chars"),
        long(F.length("t") - F.length(F.regexp_replace("t", r"[#*$%&|<>]", ""))).alias("n_symbols"),
        long(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.when(s.isNull(), F.lit(0).cast("bigint")).otherwise(covered).alias("n_repeat_words"),
        long(F.size("lines")).alias("n_lines"),
    )


def flagged(measures: DataFrame, rules: Mapping[str, tuple[str, float]] = RULES) -> DataFrame:
    return measures.select("*", *[F.expr(condition).alias(f"fails_{name}") for name, (condition, _) in rules.items()])


def host_rates(flags: DataFrame, host: str, rules: Mapping[str, tuple[str, float]] = RULES) -> DataFrame:
    """Per host and rule the shrunk failure rate, and host_failed.

    The prior is fitted by moments over the hosts' raw rates; with no spread between hosts it is as heavy as allowed.
    """
    counts = flags.groupBy(host).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(f"fails_{name}").alias(f"n_{name}") for name in rules],
    )
    moments = counts.agg(
        *[F.avg(F.col(f"n_{name}") / F.col("n")).alias(f"m_{name}") for name in rules],
        *[F.var_pop(F.col(f"n_{name}") / F.col("n")).alias(f"v_{name}") for name in rules],
    )
    rated = counts.crossJoin(F.broadcast(moments))  # one row
    for name in rules:
        m, v = F.col(f"m_{name}"), F.col(f"v_{name}")
        weight = F.when(
            v > 0, F.greatest(F.lit(LEAST_WEIGHT), F.least(F.lit(MOST_WEIGHT), m * (1 - m) / v - 1))
        ).otherwise(MOST_WEIGHT)
        rated = rated.withColumn(f"rate_{name}", (F.col(f"n_{name}") + m * weight) / (F.col("n") + weight))
    failed = F.lit(False)
    for name, (_, limit) in rules.items():
        failed = failed | (F.col(f"rate_{name}") > limit)
    return rated.select(host, F.col("n").alias("host_documents"), *[f"rate_{name}" for name in rules], failed.alias("host_failed"))


def verdicts(
    documents: DataFrame,
    keys: tuple[str, ...] = ("doc_id",),
    host: str = "source",
    rules: Mapping[str, tuple[str, float]] = RULES,
    base: tuple[str, ...] = BASE,
) -> DataFrame:
    """One row per document: keys, measures, fails_<rule>, host rates, base_failed, host_failed, kept.

    The measures are written once; hosts are joined by broadcast while they are few, else by a shuffle of the measures.
    """
    measures = staged(
        measured(documents, [*[F.col(k) for k in keys], F.col(host)]).withColumnsRenamed(
            {f"k{i}": k for i, k in enumerate([*keys, "host"])}
        )
    )
    flags = flagged(measures, rules)
    rates = bounded(host_rates(flags, "host", rules).withColumnRenamed("host", "rated_host"))
    failed = F.lit(False)
    for name in base:
        failed = failed | F.col(f"fails_{name}")
    return (
        flags.join(rates, F.col("host").eqNullSafe(F.col("rated_host")))
        .drop("rated_host")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))
    )


def filtered(documents: DataFrame, host: str = "source") -> DataFrame:
    """The documents that pass, with their columns (none of which may begin with ~). Rows are told apart by id and text."""
    key = F.xxhash64(text_of())
    keyed = documents.select(F.col("doc_id").alias("id"), key.alias("key"), F.col(host).alias("source"), "text")
    good = verdicts(keyed, ("id", "key"), "source").where("kept").select(
        F.col("id").alias("~id"), F.col("key").alias("~same"), F.col("host").alias("~host")
    )
    rows = documents.withColumn("~key", key)
    return rows.join(
        good.distinct(),
        F.col("doc_id").eqNullSafe(F.col("~id")) & (F.col("~key") == F.col("~same")) & F.col(host).eqNullSafe(F.col("~host")),
        "left_semi",
    ).drop("~key")
