"""Every query with SQL against it, and the others against plain code."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallymark.llm import host_rules, jaccard_join, line_templates, ordinal, packing, queries
from tests.check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_equals_sql(spark, duck, name):
    assert compare(queries.QUERIES[name](spark, SF_DIR), duck, queries.SQL[name]) == ""


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def without_recurring_lines(rows, texts=line_templates.TEXTS):
    """Plain counterpart of line_templates.deduplicated: {(id, text): text without the lines, or None}."""
    mask = lambda line: tuple("<*>" if re.search("[0-9]", w) else w for w in words(line))
    distinct = {mask(line) for _, t in rows for line in (t or "").split("\n") if words(line)}
    leaves = {}
    for line in distinct:
        if len(line) >= line_templates.LEAST_TOKENS:
            leaves.setdefault((len(line), line[: line_templates.DEPTH]), []).append(line)
    template = {}
    for (n, _), members in leaves.items():
        if len(members) > 1:
            depth = line_templates.DEPTH
            constant = [
                i < depth or max(map([m[i] for m in members].count, {m[i] for m in members})) >= line_templates.CONSTANT * len(members)
                for i in range(n)
            ]
            held = sum(constant[depth:])
            if held < n - depth and held >= line_templates.KEPT * (n - depth):
                for m in members:
                    template[m] = ("template", *[w if c else "<*>" for w, c in zip(m, constant)])
    found = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if words(line):
                found.setdefault(template.get(mask(line), mask(line)), set()).add((i, t or ""))
    result = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = []
        for line in lines:
            holders = found.get(template.get(mask(line), mask(line)), set()) if words(line) else set()
            often = len({t for _, t in holders}) >= (texts if len(words(line)) >= line_templates.LEAST_TOKENS else line_templates.SHORT_TEXTS)
            keep.append(not often or i == min(i for i, _ in holders))
        left = "\n".join(line for line, k in zip(lines, keep) if k)
        result[i, t] = t if all(keep) else left if words(left) else None
    return result


def test_line_templates_equal_plain_code(spark, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    got = {r["doc_id"]: r["text"] for r in queries.op2_line_templates(spark, SF_DIR).collect()}
    want = without_recurring_lines(rows)
    assert got == {i: t for (i, _), t in want.items() if t is not None}


def test_templates_generalise_fields_behind_the_leading_tokens(spark):
    lines = [f"connection closed by peer {name} after {i} tries on the north gate" for i, name in enumerate(["al", "bo", "cy", "di"])]
    rows = [(i, f"{line}\nown text of number {'xyzw'[i]} here") for i, line in enumerate(lines)]
    got = {r["doc_id"]: r["text"] for r in line_templates.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == rows[0][1] and all("connection" not in got[i] for i in (1, 2, 3))
    assert got == {i: t for (i, _), t in without_recurring_lines(rows).items()}


def check_pieces(rows, want_ids, limits=packing.Limits()):
    """Every id once, sequences gapless and within the limits, little padding."""
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"], bytes(r["ids"])))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["loss_tokens"]))
    for i, ids in want_ids.items():
        at, joined = 0, b""
        for start, length, data in sorted(pieces[i]):
            assert start == at and len(data) == 4 * length
            at, joined = at + length, joined + data
        assert np.frombuffer(joined, dtype="<u4").tolist() == ids
    cost = total = 0
    for parts in sequences.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= limits.tokens and len(parts) <= limits.segments and sum(p[2] for p in parts) <= limits.loss
        total, cost = total + at, cost + (at if at & (at - 1) == 0 else limits.tokens)
    return total / cost


def test_packing_round_trip(spark, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    tokenizer.encode_special_tokens = True
    odd = [(-1, None), (-2, ""), (-3, "  a  b\n\n c\t\td"), (-4, "<|endoftext|> x it's"), (-5, " é ​🙂🙂 !!"), (-6, "word " * 9000)]
    rows = documents.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    want = {r["doc_id"]: tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1] for r in rows.collect()}
    got = packing.packed(rows, queries.tokenizer_path()).collect()
    assert check_pieces(got, want) > 0.99
    tight = packing.Limits(tokens=64, segments=3, loss=40, stock=5)
    assert check_pieces(packing.packed(rows, queries.tokenizer_path(), tight).collect(), want, tight) > 0


def test_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    documents, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = ordinal.fitted(documents, labels.where("doc_id % 2 = 0"))
    held = ordinal.scored(documents, model).join(labels.where("doc_id % 2 = 1").withColumnRenamed("toxic", "label"), "doc_id")
    r = held.agg(
        F.count_if(F.expr("toxic AND label = 1")).alias("hit"), F.count_if(F.expr("label = 1")).alias("all"),
        F.count_if(F.expr("toxic AND label = 0")).alias("wrong"), F.count_if(F.expr("label = 0")).alias("clean"), F.avg(F.expr("if(label = 1, expected_severity, null)")).alias("high"),
        F.avg(F.expr("if(label = 0, expected_severity, null)")).alias("low"),
    ).first()
    assert r["hit"] > 0.7 * r["all"] and r["wrong"] < 0.01 * r["clean"] and r["high"] > 5 * r["low"]


def linked_groups(rows, percent=80, width=5):
    """Plain counterpart of the near-duplicate stage: {id: smallest id linked with it, over any number of links}."""
    sets = {}
    for i, t in rows:
        w = words((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(a, b) for held in holders.values() for a in held for b in held if a < b}
    linked = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while any(label[a] != label[b] for a, b in linked):
        for a, b in linked:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_pipeline_stages(spark, documents):
    """Each stage on its own input against plain code, and the last one by round trip."""
    docs = documents
    good = {r["doc_id"] for r in host_rules.verdicts(docs).where("kept").collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "mix_sources", "pack"]
    docs = stages["quality_rules"](spark, docs, SF_DIR)
    assert docs.columns == documents.columns and {r["doc_id"] for r in docs.collect()} == good
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    docs = stages["line_dedup"](spark, docs, SF_DIR).cache()
    assert docs.columns == documents.columns
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == {i: t for (i, _), t in without_recurring_lines(rows).items() if t is not None}
    groups = linked_groups([tuple(r) for r in docs.select("doc_id", "text").collect()])
    docs = stages["near_duplicates"](spark, docs, SF_DIR).cache()
    assert docs.columns == documents.columns and {r["doc_id"] for r in docs.collect()} == set(groups.values())
    mixed = stages["mix_sources"](spark, docs, SF_DIR).cache()
    assert mixed.columns == documents.columns and 0 < mixed.count()
    assert mixed.join(docs, "doc_id", "left_anti").isEmpty()
    assert stages["pack"](spark, mixed, SF_DIR).agg(F.sum("length")).first()[0] == sum(
        len(packing.encoder(queries.tokenizer_path())(r["text"])) + 1 for r in mixed.collect()
    )
    copies = stages["pack"](spark, mixed, SF_DIR).groupBy("doc_id", "row_id", "doc_tokens").agg(F.sum("length").alias("n")).collect()
    assert len(copies) == mixed.count() > len({r["doc_id"] for r in copies}) and all(r["n"] == r["doc_tokens"] for r in copies)
    assert not corpus_pipeline.run(spark, SF_DIR).isEmpty()


def test_pipeline_edges(spark, documents):
    """Stage after stage: null and repeated texts, missing ids and sources, columns of other names, and nothing at all."""
    good = " ".join(f"word{i}" for i in range(70))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, good + " x", None, None, None), (3, good, "en", "s", 1), (3, good, "en", "s", 1), (4, good + " y", "en", None, 2)]
    whole = spark.createDataFrame(rows, documents.schema).withColumns({c: F.lit("clash") for c in ("id", "key", "copy", "n", "component", "host", "ids")})
    for docs in (whole, whole.where("false")):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF_DIR).cache()
            assert docs.columns == columns, name
            docs.count()
        packed = dict(corpus_pipeline.STAGES)["pack"](spark, docs, SF_DIR)
        assert packed.select("row_id").distinct().count() == docs.count()
