"""What the operators must not leave out: one test for each loss once found."""

import pytest

import corpus_pipeline
from tallymark.llm import jaccard_join, license_join, line_templates, tag_paths


def test_near_duplicate_stage_links_five_word_sets_from_eighty_percent(spark):
    """Two edits in 100 different words: 92/104 on three-word sets, 86/106 on five-word sets."""
    words = [f"w{i}" for i in range(100)]
    edited = ["x" if i == 30 else "y" if i == 70 else w for i, w in enumerate(words)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(edited)), (3, "another text of its own here")], "doc_id long, text string")
    assert jaccard_join.one_of_each(docs).count() == 3
    left = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, "")
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 3]


def test_long_line_in_two_different_documents_stays_in_the_first_only(spark):
    line = " ".join(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60))
    docs = spark.createDataFrame([(1, f"one text\n{line}"), (2, f"{line}\nthe other text")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_templates.deduplicated(docs).collect()}
    assert got == {1: f"one text\n{line}", 2: "the other text"}


def test_short_lines_of_two_texts_stay(spark):
    """A short sentence, a heading or a brace in two texts is chance; in many it is a template."""
    line = "Les."
    rows = [(i, f"own text of number {chr(97 + i)} here\n{line}") for i in range(line_templates.SHORT_TEXTS)]
    texts = lambda some: {r["text"] for r in line_templates.deduplicated(spark.createDataFrame(some, "doc_id long, text string")).collect()}
    assert texts(rows[:-1]) == {t for _, t in rows[:-1]}
    assert sum(line in t for t in texts(rows)) == 1


STORY = "".join(f"<p>Sentence {i}, which is part of the story, has some words.</p>" for i in range(9))
TOLD = " ".join(f"Sentence {i}, which is part of the story, has some words." for i in range(9))
CARD = "<article class=card><p>A teaser, for another story.</p></article>"
THREAD = "<section class=comments>" + "<article><p>Nice post, thanks a lot, really, and so on.</p></article>" * 40 + "</section>"


@pytest.mark.parametrize(
    "html, start",
    [
        (f"<div><h1>Title</h1><div>{STORY}</div></div><div>{CARD * 3}</div>", "Title " + TOLD),
        (f"<h1>Title</h1><p class=lead>The lead, in short.</p><div class=body>{STORY}</div>", "Title The lead, in short. " + TOLD),
        (f"<article class='post comments-open'>{STORY}</article>{THREAD}", TOLD),
        (f"<div class='page has-comments'>{STORY}{THREAD}</div>", TOLD),
        (f"<form>{STORY}</form>", TOLD),
        (f"<div class=with-sidebar>{STORY}<div class=sidebar>Side, bar.</div></div>", TOLD),
    ],
)
def test_main_text_keeps_the_whole_story(html, start):
    text = tag_paths.main_text(f"<html><body><nav><a>Menu</a></nav>{html}</body></html>")
    assert text.startswith(start) and "Menu" not in text and "Nice post" not in text and "Side, bar" not in text


def test_named_threads_and_cards_beside_an_article_still_go():
    card = "<div class=related-posts><article><p>Another story, in short.</p></article></div>"
    assert tag_paths.main_text(f"<body><article>{STORY[:120]}</p></article>{card}{THREAD}</body>").count("story") == STORY[:120].count("story")


@pytest.mark.parametrize(
    "inner",
    [
        "<h2 id='related-work'>A heading that is an anchor</h2>",
        "<section id='social-impact'><p>Impact, as the section says, is large, and so on.</p></section>",
        "<section id='search-for-survivors'><p>The search, which went on, found all of them, at last.</p></section>",
        "<section class='search-for-survivors'><p>The search, which went on, found all of them, at last.</p></section>",
        "<table><tr class='table-header'><th>Year</th><th>Rain</th></tr><tr><td>1999</td><td>12 mm</td></tr></table>",
    ],
)
def test_nothing_inside_the_article_goes_for_a_part_of_a_name(inner):
    import re

    want = " ".join(re.sub("<[^>]*>", " ", inner).split())
    text = tag_paths.main_text(f"<html><body><nav><a>Menu</a></nav><article>{STORY}{inner}<p>The end, of the story.</p></article></body></html>")
    assert text == f"{TOLD} {want} The end, of the story."


@pytest.mark.parametrize(
    "noise",
    [
        "<div class='related-posts'><ul><li><a>Another story</a></li></ul></div>",
        "<div class='reader-comments'><p>Nice post, thanks a lot, really, and so on.</p></div>",
        "<div class='share-buttons-2'><a>Share</a></div>",
        "<ul class='related-reading-tips'><li><a>Tip one</a></li><li><a>Tip two</a></li></ul>",
        "<article class=card><p>A teaser, for another story.</p></article>",
        "<section class=thread-of-replies>" + "<article><p>Nice post, thanks, and so on.</p></article>" * 3 + "</section>",
    ],
)
@pytest.mark.parametrize("page", ["<main><h1>Title</h1><article>{0}</article>{1}</main>", "<main><article><h1>Title</h1>{0}</article></main>{1}", "<main><h1>Title</h1>{0}{1}</main>"])
def test_noise_inside_and_beside_the_article_goes(page, noise):
    if "{0}{1}" in page and "<article" in noise:
        page = page.replace("{0}", "<article>{0}</article>")
    text = tag_paths.main_text(f"<html><body>{page.format(STORY, noise)}</body></html>")
    assert text == f"Title {TOLD}"


def test_ratios_of_paths_by_hand():
    """Three paths: characters and marks per node, smoothed over the neighbours in page order, fused by their geometric mean."""
    page = tag_paths.Page()
    page.feed("<div><a>Home</a><a>News</a><p>One, two.</p><p>Three, four, five.</p><b>End</b></div>")
    page.close()
    got = {path.rsplit("/", 1)[1]: value for path, value in tag_paths.fused_ratios(page.texts).items()}
    sizes, marks = [4.0, 13.5, 3.0], [0.0, 2.5, 0.0]
    smooth = lambda r: [0.75 * r[0] + 0.25 * r[1], 0.25 * r[0] + 0.5 * r[1] + 0.25 * r[2], 0.25 * r[1] + 0.75 * r[2]]
    want = [(a * b) ** 0.5 for a, b in zip(smooth(sizes), smooth(marks))]
    assert [got[t] for t in ("a", "p", "b")] == pytest.approx(want)
    spread = (sum((x - sum(want) / 3) ** 2 for x in want) / 3) ** 0.5
    assert {p.rsplit("/", 1)[1] for p in tag_paths.content_paths(tag_paths.fused_ratios(page.texts))} == {t for t, x in zip("apb", want) if x >= 0.5 * spread}


@pytest.mark.parametrize("prefix", ["", " * ", "# ", "-- "])
def test_every_notice_is_found_however_it_is_wrapped(spark, prefix):
    import textwrap

    before, after = "int main() { return 0; } " * 30, "def f(x): return x + 1 " * 40
    rows = []
    for i, (_, text) in enumerate(license_join.TEMPLATES):
        wrapped = "\n".join(prefix + line for line in textwrap.wrap(" ".join(text.split()), 72))
        rows.append((i, f"{before}\n\n{wrapped}\n\n{after}"))
    got = {r["doc_id"]: r for r in license_join.scanned(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    for i, (label, _) in enumerate(license_join.TEMPLATES):
        assert label in got[i]["template_labels"] and got[i]["score"] == 1.0


def test_words_of_a_notice_far_apart_are_none(spark):
    words = license_join.template_words(dict(license_join.TEMPLATES)["bsd"])
    scattered = " ".join(f"{w} " + " ".join(f"other{i}x{k}" for k in range(12)) for i, w in enumerate(words))
    half = " ".join(words[: len(words) // 2])
    rows = [(1, scattered), (2, half), (3, None), (4, "")]
    got = license_join.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r["template_labels"] for r in sorted(got, key=lambda r: r["doc_id"])] == [[], [], [], []]
    none = license_join.scanned(spark.createDataFrame(rows, "doc_id long, text string"), templates=())
    assert none.where("score > 0").isEmpty()
