"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import math

import pytest
from pyspark.sql import functions as F

from tallymark.llm import host_rules, jaccard_join, license_join, line_templates, mixing, ordinal, packing, queries, reply_trees, tag_paths, topk

LONG = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
ROWS = [
    (None, "a text without an id but with some words", "en", "s1", 1),
    (1, None, None, None, None),
    (2, "", "en", "s1", 0),
    (3, " \n\t\n ", "en", "s1", 5),
    (4, LONG, "en", "s2", None),
    (5, LONG, "en", "s2", None),
    (6, "one two three four", "en", "s2", None),
    (7, "one two", "en", None, None),
    (7, "one two", "en", None, None),
    (8, "one two", "en", "s1", None),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["id", "key", "n", "copy", "t", "w", "token", "host", "parts", "drops", "kept", "label", "score"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, COLUMNS)
    return rows.select("*", *[F.lit(f"clash {c}").alias(c) for c in CLASHING]).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_mixing(docs, none):
    out = mixing.replicated(docs)
    assert set(out.columns) == set(docs.columns) | {"copy", "shuffle_key"}
    assert by_id(out) == by_id(mixing.replicated(docs.repartition(7)))
    assert mixing.replicated(none).count() == 0
    assert mixing.replicated(docs, weights={"s1": 1.0}).where("source = 's2' OR source IS NULL").where("text <> ''").count() == 0


def test_mixing_means(spark):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("abcd").alias("text"), F.when(F.col("id") < 3900, "big").otherwise("small").alias("source"))
    got = {r["source"]: r["count"] for r in mixing.replicated(rows, weights={"big": 1, "small": 1}).groupBy("source").count().collect()}
    assert abs(got["big"] - 2000) < 6 * math.sqrt(2000) and abs(got["small"] - 2000) < 6 * math.sqrt(2000)


def test_line_templates(docs, none):
    out = line_templates.deduplicated(docs)
    assert out.count() == len(ROWS) and set(out.columns) == set(docs.columns) | {"dropped_lines"}
    assert out.where("dropped_lines > 0").count() == 0
    assert line_templates.deduplicated(none).count() == 0


def test_host_rules(docs, none):
    out = {(r["doc_id"], r["n_words"]): r for r in host_rules.verdicts(docs).collect()}
    assert host_rules.verdicts(docs).count() == len(ROWS)
    assert out[1, 0]["base_failed"] and not out[4, 60_000]["base_failed"] and out[4, 60_000]["n_repeat_words"] == 0
    assert host_rules.verdicts(none).count() == 0
    assert host_rules.filtered(docs).columns == docs.columns
    assert {r["doc_id"] for r in host_rules.filtered(docs).collect()} <= {4, 5}


def test_repeated_windows_cover_words_once(spark):
    text = "a b c d a b c d a b c x"
    row = host_rules.measured(spark.createDataFrame([(text,)], "text string"), []).first()
    assert (row["n_words"], row["n_repeat_words"]) == (12, 11)


def test_bad_hosts_are_rejected(spark):
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(i, "bad", "too short") for i in range(99)] + [(99, "bad", good)] + [(100 + h * 50 + i, f"h{h}", good) for h in range(9) for i in range(50)]
    out = host_rules.verdicts(spark.createDataFrame(rows, "doc_id long, source string, text string"))
    r = {r["doc_id"]: r for r in out.collect()}
    assert not r[99]["base_failed"] and r[99]["host_failed"] and not r[99]["kept"] and r[100]["kept"]


def test_packing(docs, none):
    out = packing.packed(docs, queries.tokenizer_path())
    assert out.where("doc_id = 7").agg(F.sum("length")).first()[0] == 2 * out.where("doc_id = 7").first()["doc_tokens"]
    assert out.where("doc_id = 1").first()["doc_tokens"] == 1
    assert packing.packed(none, queries.tokenizer_path()).count() == 0


def test_license_scan(spark, docs, none):
    assert license_join.scanned(docs).count() == len(ROWS) and license_join.scanned(none).count() == 0
    rows = [
        (1, "x GNU  general-Public\nLicense y; Apache License cc by"),
        (2, "Redistribution and use in source and binary forms, with or without changes, are permitted provided the following conditions are met"),
        (3, "ÀCC by MIT LICENSEx"),
    ]
    got = {r["doc_id"]: r for r in license_join.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["places"] == [1, 6, 8] and got[1]["base_labels"] == ["gpl", "apache", "cc-by"] and got[1]["score"] == 1.0
    assert got[2]["template_labels"] == ["bsd"] and 0.8 <= got[2]["score"] < 1
    assert got[3]["places"] == [] and got[3]["score"] == 0.0


def test_jaccard_edges(docs, none):
    out = by_id(jaccard_join.grouped(docs))
    assert len(out) == len(ROWS) and jaccard_join.grouped(none).count() == 0
    found = {r[0]: r[1:] for r in out}
    assert found[1] == (0, 1) and found[3] == (0, 3) and found[5] == (59_998, 4) and found[8] == (1, 7) and found[None][1] is None
    left = jaccard_join.one_of_each(docs)
    assert left.columns == docs.columns and sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 1, 2, 3, 4, 6, 7]


@pytest.mark.parametrize("limit", [(16, 32), (2, 3)])
def test_jaccard_in_a_crowd_of_near_copies(spark, monkeypatch, limit):
    """Variants of one text with nought to four edits each, and a passage shared by all, against all pairs."""
    import random

    monkeypatch.setattr(jaccard_join, "RARE", limit[0])
    monkeypatch.setattr(jaccard_join, "LONG", limit[1])
    rng = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(150):
        text = list(base)
        for _ in range(rng.randrange(5)):
            text[rng.randrange(120)] = f"e{rng.randrange(400)}"
        rows.append((i, " ".join(text[: rng.choice([120, 120, 118, 110])])))
    rows += [(1000 + i, " ".join([*base[:60], *[f"o{i}x{j}" for j in range(60)]])) for i in range(40)]
    sets = {i: {tuple(t.split()[k : k + 3]) for k in range(len(t.split()) - 2)} for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]) and root(a) != root(b):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.grouped(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: root(i) for i in sets}


MESSAGES = [
    (1, 1, None, "user", "a", 1.0), (1, 2, 1, "assistant", "b", 0.1), (1, 3, 1, "assistant", "c<|x</s> \\</s>[\\INST] <\\s>", 0.9), (1, 4, 3, "user", "d", None),
    (1, 5, 2, "u%0A\n", "e", 5.0), (2, 1, 2, "x", "y", 0.0), (2, 2, 1, "x", "y", 0.0), (2, 3, 2, "x", "y", 0.0), (None, 1, 9, None, None, None),
]
KINDS = "conv_id long, node long, parent long, role string, text string, score double"


def test_reply_trees(spark):
    messages = spark.createDataFrame(MESSAGES, KINDS).withColumn("leaf", F.lit(0)).withColumn("up", F.lit(0))
    out = reply_trees.formatted(messages, 2).select("*", reply_trees.turns_of(F.col("text")).alias("turns"), reply_trees.loss_text(F.col("text"), F.col("loss_spans")).alias("loss"))
    got = {(r["conv_id"], r["branch"]): r for r in out.collect()}
    assert set(got) == {(1, 1), (1, 2), (None, 1)}
    assert [tuple(t) for t in got[1, 1]["turns"]] == [("user", "a"), ("assistant", "b"), ("u%0A\n", "e")]
    assert [tuple(t) for t in got[1, 2]["turns"]] == [("user", "a"), ("assistant", MESSAGES[2][4]), ("user", "d")]
    assert got[1, 2]["loss"] == MESSAGES[2][4] and "</s>" not in got[1, 2]["text"]
    assert [tuple(t) for t in got[None, 1]["turns"]] == [("", "")]
    assert reply_trees.formatted(spark.createDataFrame([], KINDS)).count() == 0


def test_long_conversation(spark):
    rows = [(9, i, "user" if i % 2 == 0 else "assistant", f"turn {i}") for i in range(300)] + [(9, 299, "assistant", "tie")]
    out = reply_trees.formatted(reply_trees.chained(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    turns = out.select(reply_trees.turns_of(F.col("text")).alias("turns")).first()["turns"]
    assert len(turns) == 301 and [t["text"] for t in turns][-2:] == ["tie", "turn 299"]


PAGE = """<html><head><title>t</title></head><body><header class="site"><h1>Site</h1></header><div class="cookie-notice">We use cookies.</div>
<div id="content"><div class="post"><h2>T&eacute;st</h2><p>Hello, <i>wor</i>ld. a &lt; b<p>Second para, with more text.<ul><li>x<li>y</ul>
<div class="share">Share</div></div><section class="comments"><article><p>Nice post, thanks a lot, really.</p></article></section></div>
<aside>Side bar.</aside><form><p>Sign up, now.</p></form><script>var x="<p>no</p>";</script><footer>&copy; x</footer></body></html>"""


def test_tag_paths(spark):
    assert tag_paths.main_text(PAGE) == "Tést Hello, world. a < b Second para, with more text. x y"
    assert tag_paths.main_text("<nav>Menu</nav><article><h1>T</h1><p>cut off <b>he") == "T cut off he"
    assert tag_paths.main_text(None) == tag_paths.main_text("") == tag_paths.main_text("<nav>only a menu</nav>") == ""
    assert tag_paths.main_text("<div>" * 3000 + "deep, text.") == "deep, text."
    rows = spark.createDataFrame([(1, "u", PAGE), (None, None, None), (1, "u", PAGE)], "page_id long, url string, html string").withColumn("text", F.lit(1))
    assert sorted(r["text"] for r in tag_paths.extracted(rows).collect())[0] == ""
    assert tag_paths.extracted(rows.where("false")).count() == 0


def test_topk(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [-1.0, 0.5]), (20, [0.5, 0.5]), (None, [1.0, 1.0]), (7, []), (8, [1.0]), (2, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).withColumn("id", F.lit(1))
    got = sorted(tuple(r) for r in topk.nearest(df, F.col("vec_id") % 20 == 0, k=2).collect())
    assert got == [(0, 1, 1, 4096), (0, 2, 2, 4096), (20, 1, 0, 2048), (20, 2, 1, 2048)]
    assert len(topk.nearest(df, F.col("vec_id") % 20 == 0).where("query_id = 0").collect()) == 4
    assert topk.nearest(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0
    big = spark.createDataFrame([(0, [3e6, 1.0]), (1, [3e6, 2.0]), (2, [3e6, 3.0])], "vec_id long, embedding array<double>")
    assert [r["vec_id"] for r in topk.nearest(big, F.col("vec_id") == 0, k=2).orderBy("rank").collect()] == [2, 1]


def test_toxicity_edges(spark, docs, none):
    kinds = "doc_id long, quality int, toxic int"
    labels = spark.createDataFrame([(4, 1, 0), (5, None, None), (None, 1, 1), (4, 0, 1)], kinds)
    assert by_id(ordinal.grades(labels)) == [(4, 2)]
    model = ordinal.fitted(docs, labels)
    assert model.words == [] and ordinal.scored(docs, model).count() == len(ROWS) and ordinal.scored(none, model).count() == 0
    empty = ordinal.fitted(docs, labels.where("false"))
    assert sorted(empty.thresholds) == empty.thresholds
