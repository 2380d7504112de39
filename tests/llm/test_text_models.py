"""Toxicity, language identification and page extraction: held-out accuracy and edge cases."""

import random
import re
from html import escape, unescape

import numpy as np
import pytest

from assayer.llm import html_extract, langid, toxicity
from assayer.llm.html_pages import labelled_pages
from assayer.llm.subwords import pieces, subword_buckets
from assayer.llm.tables import held_out, labelled_sample
from pyspark.sql import functions as F


def sentences(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def made_up(rng, n):
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def test_subwords_of_a_word_do_not_depend_on_its_neighbours():
    alone = [sorted(subword_buckets([w], 3, 5, 12)[1].tolist()) for w in ("ab", "straße", "x" * 300)]
    owner, bucket = subword_buckets(["ab", "straße", "x" * 300], 3, 5, 12)
    assert [sorted(bucket[owner == k].tolist()) for k in range(3)] == alone
    assert subword_buckets([], 3, 5, 12)[0].size == 0


def test_pieces_lose_nothing():
    text = " ".join(["word"] * 1000)
    parts = list(pieces(text, re.compile(r"\W"), 64))
    assert "".join(parts) == text and len(parts) > 10
    assert sum(len(re.findall(r"\w+", p)) for p in parts) == 1000
    assert list(pieces("x" * 500, re.compile(r"\W"), 64)) == ["x" * 500]


@pytest.fixture(scope="module")
def toxic_rows():
    rng = random.Random(1)
    plain = made_up(rng, 400)
    rows = []
    for i in range(1500):
        words = [rng.choice(plain) for _ in range(rng.randint(20, 80))]
        for _ in range(3 if i % 4 == 0 else 0):
            words.insert(rng.randrange(len(words)), rng.choice(("qwurzzle", "vuxxo", "zzyqqat")))
        rows.append((" ".join(words), int(i % 4 == 0)))
    return rows


def test_toxicity_held_out_and_misspelt(toxic_rows):
    model = toxicity.train(toxic_rows[:1200])
    scores = model.scorer()([t for t, _ in toxic_rows[1200:]])
    truth = np.array([y for _, y in toxic_rows[1200:]])
    assert ((scores >= 0.5) == truth).mean() > 0.9
    clean = next(t for t, y in toxic_rows if not y)
    low, high = model.scorer()([clean, clean + " qwurzzlle"])
    assert high > low  # an unseen spelling shares n-grams
    edge = model.scorer()([None, "", "...", clean * 2000])
    assert np.isfinite(edge).all() and (0 <= edge).all() and (edge <= 1).all()


def test_toxicity_without_both_labels():
    for rows in ([], [("a b", 0)]):
        assert (toxicity.train(rows).scorer()(["x", None]) < 0.5).all()
    assert (toxicity.train([("a b", 1)]).scorer()(["x"]) > 0.5).all()


def test_scores_as_a_column(spark, toxic_rows):
    model = toxicity.train(toxic_rows[:100])
    docs = spark.createDataFrame(
        [(1, "some text", "keep", 9.0), (1, "some text", "keep", 9.0), (2, None, None, None)],
        "doc_id long, text string, score string, _text double",
    )
    rows = docs.withColumn("t", toxicity.toxicity_score(model, F.col("text"))).collect()
    assert len(rows) == 3 and rows[0].t == rows[1].t and rows[0].score == "keep"
    assert docs.limit(0).select(toxicity.toxicity_score(model, F.col("text"))).count() == 0


def test_sample_is_bounded_and_leaves_the_fold_out(spark):
    docs = spark.createDataFrame([(i, f"text {i} " * 10) for i in range(200)] + [(3, "again")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    rows = labelled_sample(docs, "doc_id", "text", labels.filter(~held_out("doc_id", 5, 0)), "toxic", 20, 10_000)
    assert len(rows) == 40 and sum(y for _, y in rows) == 20
    import zlib

    assert all(zlib.crc32(t.split()[1].encode()) % 5 for t, _ in rows if t != "again")
    assert sum(len(t) for t, _ in labelled_sample(docs, "doc_id", "text", labels, "toxic", 50, 500)) <= 500


LANGS = {"en": "the and thing with ation", "de": "der und schein nicht ung", "fr": "les dans eaux pour ment", "es": "los para ción ado que"}


@pytest.fixture(scope="module")
def language_rows():
    rng = random.Random(2)
    out = []
    for lang, seeds in LANGS.items():
        parts = seeds.split()
        words = parts + [rng.choice(parts) + rng.choice(parts) for _ in range(60)]
        out += [(sentences(rng, words, rng.randint(5, 60)), lang) for _ in range(80)]
    rng.shuffle(out)
    return out


def test_language_held_out(language_rows):
    model = langid.train(language_rows[:240])
    assert sorted(model.members) == ["germanic", "romance"]
    langs, scores = model.predictor()([t for t, _ in language_rows[240:]])
    assert np.mean([a == b for a, (_, b) in zip(langs, language_rows[240:])]) > 0.95
    assert all(0 <= s <= 1 for s in scores)


def test_language_edges(language_rows):
    predict = langid.train(language_rows[:100]).predictor()
    langs, scores = predict([None, "", "123 ... ²", "the and", "the " * 300_000])
    assert langs[:3] == ["und"] * 3 and scores[:3] == [0.0] * 3
    assert langs[3] == langs[4] == "en"
    assert langid.train([]).predictor()(["the"])[0] == ["und"]
    assert langid.train([("the", "xx")]).predictor()(["the", "5"])[0] == ["xx", "und"]


@pytest.fixture(scope="module")
def pages_model():
    return html_extract.train(labelled_pages())  # as the query trains it


def test_pages_held_out(pages_model):
    right = total = 0
    for html, states in labelled_pages(40, seed=99):
        tree = html_extract.Page(html)
        want = html_extract.join_blocks(tree, np.array(states))
        got = pages_model.extract([html])[0]
        a, b = set(want.split("\n")), set(got.split("\n"))
        right += len(a & b)
        total += len(a | b)
    assert right / total > 0.95


def test_marginals_by_brute_force(pages_model):
    rng = np.random.default_rng(4)
    parents = np.array([-1, 0, 0, 1, 1, 2, 5])
    kinds = np.array([4, 1, 3, 0, 2, 4, 0])
    own = rng.normal(size=7)
    weight = np.zeros(7)
    total = 0.0
    for code in range(1 << 7):
        states = [code >> k & 1 for k in range(7)]
        energy = sum(own[k] / 2 * (1 if s else -1) for k, s in enumerate(states))
        energy += sum(pages_model.edge[kinds[k], states[parents[k]], states[k]] for k in range(1, 7))
        total += np.exp(energy)
        weight += np.exp(energy) * np.array(states)
    assert np.allclose(pages_model.marginals(parents, own, kinds), weight / total)


def test_page_edges(pages_model):
    page = (
        "<html><head><title>no</title><script>var a='</p>';</script></head><body><nav><ul><li><a href='/x'>menu</a></ul></nav>"
        "<article><h1>A &amp; B</h1><p>one\n  two<br>three<p><b>four &eacute; &#x41; and some more words here</b> five"
        "<ul><li>six seven eight<li>nine ten</ul></article><div class='ad'>buy</div><footer>&copy; foot</footer>"
    )
    want = "A & B\none two three\nfour é A and some more words here five\nsix seven eight\nnine ten"
    assert pages_model.extract([page, None, "", "<", "<p", "&&<!--", "<a href='x>never closed"])[0] == want
    assert pages_model.extract([None, "", "<!-- only -->"]) == ["", "", ""]
    long = "<article>" + "<p>some words here</p>" * 20_000 + "</article>"
    assert pages_model.extract([long])[0].count("\n") == 19_999
    deep = "<article>" + "<div>" * 3000 + "<p>deep text here</p>"
    assert pages_model.extract([deep]) == ["deep text here"]


def test_given_pages(spark, pages_model):
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    for html, got in zip([r.html for r in rows], pages_model.extract([r.html for r in rows])):
        inner = re.search(r"<article>(.*)</article>", html, re.S).group(1).replace("<br>", " ")
        blocks = [re.sub(r"\s+", " ", unescape(re.sub(r"<[^>]+>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", inner)]
        assert got == "\n".join(b for b in blocks if b)


P = "<p>Some ordinary words of the article that form a sentence.</p>"
LINE = "Some ordinary words of the article that form a sentence."


@pytest.mark.parametrize(
    "html, want",
    [
        ("<article><h1>T</h1><div><div><div>" + P + "</div></div></div></article>", ["T", LINE]),
        ("<body><h1>T</h1>" + P * 2 + "</body>", ["T", LINE, LINE]),
        ("<body><h1>T</h1><p>..</p><p>..</p></body>", ["T", "..", ".."]),
        ("<div class='q7z'>" + P * 2 + "</div>", [LINE, LINE]),
        ("<body>" + "<div>" * 3000 + P * 3, [LINE] * 3),
        ("<article><p class='ad-free'>Some words here</p>" + P + "</article>", ["Some words here", LINE]),
        ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be</p></article>", ["Let x=2 be"]),
        ("<article><h1>T</h1>" + P * 3 + "<div class='kommentare'><h3>K</h3><div class='kommentar'><p>Nice</p></div></div></article>", ["T"] + [LINE] * 3),
        ("<article><h1>T</h1>" + P * 3 + "<div class='werbung'>Buy now</div></article><div class='werbung'><p>Buy it</p></div>", ["T"] + [LINE] * 3),
        ("<article><h1>T</h1>" + P * 3 + "</article><section id=comments><article class=comment><p>I think so.</p></article></section>", ["T"] + [LINE] * 3),
        ("<form><p>Your name</p><input></form><main>" + P * 2 + "</main>", [LINE, LINE]),
    ],
)
def test_page_shapes(pages_model, html, want):
    assert pages_model.extract([html]) == ["\n".join(want)]


SITES = [  # (page, with {0} for the article's blocks), written by hand, unlike the layouts of the training pages
    "<!doctype html><html><head><title>x</title></head><body class='home blog'><div id='site'><div id='masthead'><a href='/'>The site</a>"
    "<p class='tagline'>What we say</p></div><div id='nav'><a href='/a'>One</a> <a href='/b'>Two</a></div><div id='primary'><div class='hentry'>{0}</div></div>"
    "<div id='sidebar'><h3>Recent</h3><ul><li><a href='/1'>First one</a><li><a href='/2'>Second one</a></ul></div><div id='footer'>&copy; The site</div></div></body></html>",
    "<html><body><header role='banner'><nav><a href='/'>Home</a><a href='/n'>News</a></nav></header><div class='cookie-bar'>We use cookies <button>Ok</button></div>"
    "<main><article itemprop='articleBody'><div class='rte'>{0}</div><aside class='related'><h4>More</h4><ul><li><a href='/3'>Third</a></ul></aside></article></main>"
    "<section class='comments'><h3>Replies</h3><div class='comment'><p>I do not agree with this at all.</p></div></section><footer><p>All rights reserved</p></footer></body></html>",
    "<html><body><table><tr><td><ul class='menu'><li><a href='/x'>X</a><li><a href='/y'>Y</a></ul></td><td><div class='body'>{0}</div></td></tr></table></body></html>",
    "<html><body>{0}<footer>Imprint</footer></body></html>",
    "<html><body><div><div><div><div class='k1'><div>{0}</div></div></div></div></div><div class='ads'><p>Buy one now and get one more</p></div></body></html>",
]


def test_pages_of_other_layouts(spark, pages_model):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("text is not null").collect()]
    right = total = 0
    for number, text in enumerate(t for t in texts if len(t.split()) > 20):
        words = text.split()
        size = 10 + 7 * (number % 9)
        blocks = [" ".join(words[at : at + size]) for at in range(0, len(words), size)]
        title = " ".join(words[:6])
        parts = [f"<h1>{escape(title)}</h1>", *[f"<p>{escape(b)}</p>" for b in blocks]]
        got = pages_model.extract([SITES[number % len(SITES)].replace("{0}", "".join(parts))])[0].split("\n")
        want = [title, *blocks]
        right += len(set(got) & set(want))
        total += len(set(got) | set(want))
    assert right / total > 0.95


def test_page_table(spark):
    schema = "page_id bigint, url string, html string, text int, n_chars string"
    rows = [(1, "u", None, 1, "x"), (2, None, "", 2, "y"), (None, "u", "<article>" + P + "</article>", 3, None), (2, None, "", 2, "y")]
    model = html_extract.train(labelled_pages(40))
    for given in (rows, []):
        out = spark.createDataFrame(given, schema).select("page_id", html_extract.main_text(model, F.col("html")).alias("t")).collect()
        assert sorted(((r.page_id or 0, r.t) for r in out)) == sorted((r[0] or 0, LINE if r[2] else "") for r in given)
