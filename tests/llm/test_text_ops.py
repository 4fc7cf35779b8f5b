"""Licence scan, chat format, page text and toxicity on small fixtures."""

import functools
import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import chat_format, html_text, license_scan, page_shapes, toxicity
from millrace.llm.queries import QUERIES, remainder
from tests.conftest import DATA

DOC = "doc_id bigint, text string, labels string, score double"


def docs(spark, pairs):
    return spark.createDataFrame([(i, t, "x", 0.5) for i, t in pairs], DOC)


# ---------------------------------------------------------------- licences


def longest_matches(words, templates):
    """For every end in ``words`` the longest stretch ending there that some template holds."""
    out = []
    for end in range(1, len(words) + 1):
        n = 0
        while n < end and any(words[end - n - 1 : end] == t[i : i + n + 1] for t in templates for i in range(len(t) - n)):
            n += 1
        out.append(n)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=8), min_size=1, max_size=4), st.lists(st.integers(0, 3), max_size=20))
def test_automaton_gives_matching_statistics(templates, words):
    automaton = license_scan.Automaton(templates)
    want = longest_matches(words, templates)
    ends = {e: n for e, n in enumerate(want, 1) if n >= 2 and (e == len(want) or want[e] != n + 1)}
    got = {}
    for end, length, state in automaton.matches(words, 2):
        got[end] = length
        places = {(t, i) for t, x in enumerate(templates) for i in range(len(x) + 1) if x[max(0, i - length) : i] == words[end - length : end] and i >= length}
        assert set(automaton.seen(state)) == places
    assert got == ends


def test_base_places_equal_brute_force(spark):
    table = spark.read.parquet(f"{DATA}/documents.parquet")
    got = {r["doc_id"]: r for r in license_scan.scan_licenses(table).collect()}
    for r in table.collect():
        words = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", r["text"].encode().lower().decode())
        places, labels = [], set()
        for phrase, label in license_scan.PHRASES.items():
            p = phrase.split()
            here = [i for i in range(len(words)) if words[i : i + len(p)] == p]
            places += here
            labels |= {label} if here else set()
        row = got[r["doc_id"]]
        assert (row["n_words"], row["n_base"]) == (len(words), len(places))
        assert (row["first_word"], row["last_word"]) == (min(places, default=None), max(places, default=None))
        assert row["base_labels"] == ",".join(sorted(labels))
        assert labels <= set(row["labels"].split(","))


def test_spans_of_templates(spark):
    mit = license_scan.TEMPLATES["mit-text"]
    cut = mit.replace("to deal in the", "to trade within the")
    texts = [(1, "x " + mit + " y"), (2, cut), (3, None), (4, ""), (5, "the rights of the people to use"), (6, "Licensed under CC BY-NC 4.0."), (6, "a " * 60_000)]
    got = [r for r in license_scan.scan_licenses(docs(spark, texts)).collect()]
    by = {r["doc_id"]: r for r in got if r["n_words"] < 50_000}
    assert by[1]["labels"] == "mit-text" and by[1]["score"] == 1.0
    assert [(s["first_word"], s["covered"]) for s in by[1]["spans"]] == [(1, 1.0)]
    assert by[2]["labels"] == "mit-text" and 0.8 < by[2]["score"] < 1
    assert by[3]["n_words"] == by[4]["n_words"] == 0 and by[3]["score"] == 0 and by[3]["first_word"] is None
    assert by[5]["labels"] == "" and by[5]["score"] < 0.8
    assert by[6]["labels"] == "cc-by,cc-by-nc-4.0" and by[6]["base_labels"] == "cc-by"
    assert len(got) == len(texts)
    assert license_scan.scan_licenses(docs(spark, texts).where("false")).count() == 0


def edited(words, rng, edits):
    """A copy with stretches of other words put in at random places, and the share of words in stretches of four or more."""
    cuts = sorted(rng.sample(range(1, len(words)), edits))
    out, kept = [], 0
    for a, b in zip([0, *cuts], [*cuts, len(words)]):
        out += words[a:b] + (["zzz"] * rng.randint(1, 5) if b < len(words) else [])
        kept += (b - a) * (b - a >= 4)
    return out, kept / len(words)


@pytest.mark.parametrize("label", ["apache-2.0-notice", "bsd", "isc", "mit-text", "gpl-notice"])
def test_edited_copies_keep_their_label(label):
    """Of copies whose stretches cover 0.8 or more, at most one in a hundred loses its label."""
    rng = random.Random(label)
    scanner = license_scan.Scanner(license_scan.TEMPLATES, license_scan.PHRASES, 4, 0.6)
    numbers = {w: i for i, w in enumerate(scanner.vocabulary)}
    words, at = license_scan.words_of(license_scan.TEMPLATES[label]), scanner.labels.index(label)
    tried = lost = 0
    while tried < 1500:
        copy, share = edited(words, rng, rng.randint(2, 6))
        if share >= 0.8:
            tried += 1
            spans = scanner.spans(np.array([numbers.get(w, -1) for w in copy]))
            lost += max((c / len(words) for t, _, _, c in spans if t == at), default=0.0) < 0.8
    assert lost <= tried / 100


def test_stretches_far_apart_are_no_copy():
    scanner = license_scan.Scanner(license_scan.TEMPLATES, license_scan.PHRASES, 4, 0.6)
    numbers = {w: i for i, w in enumerate(scanner.vocabulary)}
    words = license_scan.words_of(license_scan.TEMPLATES["isc"])
    copy = [w for i in range(0, len(words), 6) for w in words[i : i + 6] + ["zzz"] * 60]
    spans = scanner.spans(np.array([numbers.get(w, -1) for w in copy]))
    assert max(c for _, _, _, c in spans) < 0.8 * len(words)


def test_repetitive_templates_stay_linear():
    words = [0, 1] * 20_000
    start = time.perf_counter()
    automaton = license_scan.Automaton([words, words[:1000]])
    assert sum(map(len, automaton.own)) == len(words) + 1000
    assert time.perf_counter() - start < 3


def test_templates_from_a_table(spark):
    table = spark.createDataFrame([("own", "all rights of this text are given away to everyone", 1), ("own", "take it and run far away with it", 2), ("none", None, 3)], "label string, text string, extra int")
    texts = [(1, "x all rights of this text are given away to everyone"), (2, "Take it, and run far away with it!"), (3, "MIT License")]
    got = {r["doc_id"]: r["labels"] for r in license_scan.scan_licenses(docs(spark, texts), templates=table).collect()}
    assert got == {1: "own", 2: "own", 3: "mit"}


# ---------------------------------------------------------------- chats

PIECES = st.lists(st.sampled_from(["\\", "###", "</turn>", ": ", ":", "\n", "### a: b</turn>\n", "é", " ", "x"]), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(PIECES, PIECES), max_size=4))
def test_conversations_read_back(turns):
    made = "".join(chat_format.render(r, t) for r, t in turns)
    assert [t[:2] for t in chat_format.parse(made)] == turns


def test_plain_text_is_left_alone():
    assert chat_format.render("user", "a\\b # c") == "### user: a\\b # c</turn>\n"
    assert chat_format.render("user", "\\### A </turn>") == "### user: \\\\\\### A \\</turn></turn>\n"


def test_chat_odd_rows(spark):
    rows = [(1, 0, None, None, 1), (1, None, "user", "b", 1), (None, 0, "assistant", "x</turn>", 1), (None, 0, "assistant", "x</turn>", 1)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, segment int")
    got = {r["conv_id"]: r for r in chat_format.format_chats(table).collect()}
    assert got[1]["n_turns"] == 2 and got[1]["loss_chars"] == 0
    assert got[None]["n_turns"] == 2 and got[None]["loss_chars"] == 2 * len("x</turn>")
    assert chat_format.format_chats(table.where("false")).count() == 0
    one = chat_format.format_turns(table.where("conv_id = 1")).orderBy("turn").collect()
    assert [t[:2] for t in chat_format.parse("".join(r["segment"] for r in one))] == [("user", "b"), ("", "")]


# ---------------------------------------------------------------- pages

ARTICLE = "many words of running text that go on and on for quite a while, as articles do, and then some more of them too"
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a><li><a href="/x">News</a></ul></nav>
<div class="cookie-notice">We use cookies &amp; more to give you the best possible experience on this site of ours.</div>
<main><article><h2>Title &lt;one&gt;</h2><p>First&nbsp;paragraph
 of <b>text</b>.<p>Short.<script>var t="</p>";</script><div class="ad">Buy <p>now</p></div>
<ul><li>item <a href="#">link</a><li>two</ul><form><p>Name <input></p></form></article>
<section id="comments"><p>A reader says that this is a very long comment about nothing in particular at all.</p></section></main>
<aside><p>Also read this quite long piece about other things that we have written before now.</p></aside>
<footer>&copy; Site</footer></body></html>"""


@functools.cache
def tree():
    return html_text.trained()


def test_page_parts():
    want = ["Title <one>", "First paragraph of text.", "Short.", "item link", "two"]
    assert html_text.main_text(PAGE, tree()) == "\n\n".join(want)


def test_page_without_article_element():
    long = "many words of running text that go on and on for quite a while, as articles do, and then some more of them too"
    page = f"<div><a href=x>Home</a></div><div><a href=y>More</a></div><p>{long}</p><p>{long}</p><div><a href=z>Next</a> | <a href=w>Top</a></div>"
    assert html_text.main_text(page, tree()) == f"{long}\n\n{long}"


def used(node):
    return {node.feature, *used(node.below), *used(node.above)} if node.below else set()


def test_tree_judges_pages_it_has_not_seen():
    """Blocks of held-out shapes; words and link density of the neighbours are among what decides."""
    learnt = html_text.train(*page_shapes.measured())
    for shapes, lengths, least in ((page_shapes.SHAPES, page_shapes.LENGTHS, 0.99), (page_shapes.HELD_OUT, (0.7, 1.0, 2.0), 0.97)):
        rows, labels = page_shapes.measured(shapes, lengths)
        right = (learnt.judge(rows) >= 0.5) == (labels == 1)
        assert right.mean() >= least
    names = {html_text.FEATURES[f] for f in used(learnt)}
    assert names & {"words_before", "words_after"} and names & {"links_before", "links_after"}


LONG = " ".join(["words of a text that goes on"] * 20)


@pytest.mark.parametrize("tag", ["nav", "footer", "aside", "form", "menu", "dialog"])
def test_long_parts_by_tag_are_no_article(tag):
    for inner in (f"<article><p>{ARTICLE}</p></article>", f"<h1>Title</h1><p>{ARTICLE}</p><p>{ARTICLE}</p>"):
        page = inner + f"<{tag}>" + f"<p>{LONG}</p>" * 10 + f"</{tag}>"
        assert LONG not in html_text.main_text(page, tree()) and ARTICLE in html_text.main_text(page, tree())


@pytest.mark.parametrize("name", ["class=comments", "id=comments", "class='comment-list open'", "class=sidebar", "class='post-related'", "role=complementary"])
def test_long_parts_by_name_are_no_article(name):
    comments = "".join(f"<p>{' '.join(['a reader says'] * n)}</p>" for n in (47, 67, 100)) * 4
    for inner in (f"<article><h1>Title</h1><p>{ARTICLE}</p></article>", f"<div><h1>Title</h1><p>{ARTICLE}</p><p>{ARTICLE}</p></div>"):
        text = html_text.main_text(f"{inner}<div {name}>{comments}</div>", tree())
        assert "reader" not in text and ARTICLE in text
    only = html_text.main_text(f"<p>{ARTICLE}</p><p>{ARTICLE}</p><div {name}>{comments}</div>", tree())
    assert ARTICLE in only and ("reader" not in only or "comment" not in name)


def test_short_pages_keep_their_text():
    assert html_text.main_text(f"<p>{' '.join(['word'] * 30)}</p>", tree()) == " ".join(["word"] * 30)
    parts = [" ".join(["word"] * n) for n in (4, 14, 9, 12)]
    page = f"<html><body><h1>{parts[0]}</h1>" + "".join(f"<p>{p}</p>" for p in parts[1:]) + "</body></html>"
    assert html_text.main_text(page, tree()) == "\n\n".join(parts)


@pytest.mark.parametrize("page", [
    "<div>" * 50_000 + "</zz>" * 100_000, "<p>x" + "</i></b></div>" * 40_000, "<div><p>" + "<center>x" * 30_000,
    "<ul><li><center>" * 20_000, "<div>" * 20_000 + "</p>" * 60_000, "<span>" * 50_000 + "</a>" * 50_000,
])
def test_tags_that_do_not_match_take_linear_time(page):
    start = time.perf_counter()
    html_text.main_text(page, tree())
    assert time.perf_counter() - start < 3


def test_carried_columns_that_clash(spark):
    table = spark.createDataFrame([(1, f"<p>{ARTICLE}</p>", "mine", 5, "u")], "page_id bigint, html string, text string, n_chars int, page string")
    got = html_text.extract_text(table, carry=["text", "n_chars", "page", "page_id"])
    assert got.columns == ["page_id", "page_text", "page_n_chars", "page", "page_page_id", "text", "n_chars"]
    assert got.first()[:] == (1, "mine", 5, "u", 1, ARTICLE, len(ARTICLE))


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<!--", "<script>", "</p></div>", "<a href='", "&#xFFFFFFF; &bogus; &am", "<p>" * 5000])
def test_broken_pages(page):
    html_text.main_text(page, tree())


def test_pages_of_the_table(spark):
    import html as h

    table = spark.read.parquet(f"{DATA}/pages.parquet")
    got = {r["page_id"]: r for r in html_text.extract_text(table, carry=["url"]).collect()}
    for r in table.collect():
        inner = re.split(r"</article>|<footer>", r["html"].split("<article>")[1])[0]
        parts = [" ".join(h.unescape(re.sub(r"<[^>]*>|<[a-zA-Z/][^>]*$", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n\n".join(p for p in parts if p)
        assert (got[r["page_id"]]["text"], got[r["page_id"]]["n_chars"], got[r["page_id"]]["url"]) == (want, len(want), r["url"])


def test_page_rows(spark):
    table = spark.createDataFrame([(1, None, "t"), (1, None, "t"), (None, "", "t")], "page_id bigint, html string, text string")
    got = html_text.extract_text(table)
    assert [(r["text"], r["n_chars"]) for r in got.collect()] == [("", 0)] * 3
    assert html_text.extract_text(table.where("false")).count() == 0


# ---------------------------------------------------------------- toxicity


def test_toxicity_separates(spark):
    """On the larger table, whose labels are enough to judge by."""
    folder = "/root/testdata/sf0.1"
    got = QUERIES["op3_toxicity"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").toPandas()
    rank, y = got["score"].rank(), got["toxic"] == 1
    auc = (rank[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum())
    assert auc > 0.9
    assert (got["predicted"] == got["toxic"]).mean() > 0.95


def test_toxicity_odd_inputs(spark):
    table = docs(spark, [(1, None), (2, ""), (2, ""), (None, "idiot " * 20_000), (3, "plain text here")])
    labels = spark.createDataFrame([(1, 0, None), (2, None, 1), (3, 1, 0)], "doc_id bigint, quality int, toxic int")
    for known in (labels, labels.where("false"), labels.withColumn("toxic", F.lit(1))):
        model = toxicity.fit(table, known)
        got = toxicity.score(table, model).collect()
        assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
        assert toxicity.score(table.where("false"), model).count() == 0
    assert toxicity.without_toxic(table, toxicity.fit(table, labels)).columns == table.columns


def test_labels_of_the_held_out_rows_do_not_matter(spark):
    table = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    learn = remainder("doc_id", 5) != 0
    flipped = labels.withColumn("toxic", F.when(learn, F.col("toxic")).otherwise(1 - F.col("toxic")))
    a, b = (toxicity.fit(table, x, learn=learn) for x in (labels, flipped))
    assert a.dictionaries == b.dictionaries and (a.weights == b.weights).all()


def test_toxic_phrases_of_usual_words():
    """Every word is as usual in ordinary documents; only the phrase is toxic."""
    import random

    draw = random.Random(3)
    names = [f"{a}{b}" for a in ("mor", "tal", "vek", "sun", "dri", "pol") for b in ("een", "ick", "ath", "own", "ule")]
    phrase = names[:8]

    def text(toxic):
        words = [draw.choice(names) for _ in range(18)]
        loose = phrase[:] if toxic else draw.sample(phrase, 8)
        return " ".join(words[:9] + loose + words[9:]).encode()

    model = toxicity._model([text(False) for _ in range(300)], [text(True) for _ in range(300)], 300, 300)
    judge = model.scorer()
    right = [(judge(text(y)) >= 0.5) == y for y in (False, True) * 100]
    assert sum(right) / len(right) > 0.7


def test_omitted_end_of_the_head():
    page = f"<html><head><title>x</title><meta charset=utf-8><style>p{{}}</style><body><article><p>{ARTICLE}</p></article></body></html>"
    assert html_text.main_text(page, tree()) == ARTICLE
    assert html_text.main_text(page.replace("<body>", ""), tree()) == ARTICLE


@pytest.mark.parametrize("tag", ["button", "select", "object", "audio", "video", "map", "noscript"])
def test_silent_elements_without_their_end(tag):
    page = f"<article><p>{ARTICLE}</p><div><{tag}>Share</div><p>{ARTICLE}</p></article><footer><{tag}>x</{tag}></footer>"
    assert html_text.main_text(page, tree()) == f"{ARTICLE}\n\n{ARTICLE}"
    bare = f"<article><{tag}>Share<p>{ARTICLE}</p><{tag}><div>Hide</div></{tag}></article>"
    assert html_text.main_text(bare, tree()).endswith(ARTICLE)
    assert "Share" not in html_text.main_text(bare.replace(f"<{tag}><div>Hide</div></{tag}>", ""), tree())


@pytest.mark.parametrize("start", ["<div class='layout has-sidebar'>", "<div id='page' class='no-comments'>", "<section class='content with-header'>"])
def test_wrappers_whose_names_hold_a_cue(start):
    end = f"</{start[1:].split()[0]}>"
    for inner in (f"<article><p>{ARTICLE}</p></article>", f"<p>{ARTICLE}</p><p>{ARTICLE}</p>"):
        page = f"<body>{start}{inner}<div class='sidebar'><p>Read also this short piece.</p></div>{end}<footer>c</footer></body>"
        assert html_text.main_text(page, tree()) == "\n\n".join(re.findall("<p>(many.*?)</p>", inner))


def test_hidden_is_an_attribute_of_its_own():
    for said in ("title='the hidden cost'", "style='overflow: hidden !important'", "data-id='comments'"):
        assert html_text.main_text(f"<article><div {said}><p>{ARTICLE}</p></div></article>", tree()) == ARTICLE
    for said in ("hidden", "aria-hidden=true", "style='color:red; display : none'"):
        assert html_text.main_text(f"<article><div {said}><p>{ARTICLE}</p></div></article>", tree()) == ""
