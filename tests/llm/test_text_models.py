"""SentencePiece, toxicity, HTML text: against the library, brute force, held-out labels and worked examples."""

import itertools
import math
import random
import time

import numpy as np
import pyarrow as pa
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from titlecorpus.llm import html_text, pieces, toxicity

sentencepiece = pytest.importorskip("sentencepiece")
MODEL = pieces.pieces(pieces.default_model())
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())


def encoded(texts):
    flat, offsets = MODEL.encode(pa.array(texts, pa.string()))
    return [flat[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list(" \n\tabethrings.,'1é日😀\0▁")), max_size=30), min_size=1, max_size=5))
def test_ids_are_the_librarys(texts):
    assert encoded(texts) == LIBRARY.encode(texts)


def test_ids_of_documents_and_round_trip(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    got = pieces.encode_texts(docs, pieces.default_model(), check="same").toPandas().merge(docs.toPandas(), on="doc_id")
    assert got["same"].all() and [list(x) for x in got["ids"]] == LIBRARY.encode(list(got["text"]))
    back = pieces.decode_ids(pieces.encode_texts(docs, pieces.default_model()), pieces.default_model()).toPandas()
    assert dict(zip(back["doc_id"], back["text"])) == dict(zip(got["doc_id"], got["text"]))


def test_pieces_odd_texts(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (2, "", "b"), (3, " ", "c"), (4, "ab " * 50_000, "d")], "k long, text string, ids string")
    got = pieces.encode_texts(df, pieces.default_model(), check="round_trip").orderBy("k").collect()
    assert got[0].ids is None and got[0].round_trip is None and got[1].ids == [] and len(got) == 5 and got[4].round_trip
    assert pieces.encode_texts(df.limit(0), pieces.default_model()).count() == 0
    assert MODEL.decode([1, 2]) == ""


def test_viterbi_of_a_unigram_model_is_the_best_path():
    """A model of log probabilities against all segmentations."""
    r = random.Random(0)
    m = object.__new__(pieces.Pieces)
    m.text = ["<unk>", *"abc", "ab", "bc", "abc", "ca", "cab"]
    m.score = np.array([0.0, *(-r.uniform(1, 6) for _ in m.text[1:])])
    m.bpe, m.longest = False, 3
    m.power = np.array([int(pieces.STEP) ** k % 2**64 for k in range(4)], np.uint64)
    m.keys = {}
    for n in (1, 2, 3):
        ids = np.array([i for i, t in enumerate(m.text) if i and len(t) == n])
        h = pieces.hashes(pieces.points([m.text[i] for i in ids]))[:, n]
        m.keys[n] = (np.sort(h), ids[np.argsort(h)])
    words = ["".join(w) for w in itertools.product("abc", repeat=5)]
    flat, size = m.viterbi(words)
    for w, ids in zip(words, np.split(flat, np.cumsum(size)[:-1])):
        best = max(sum(m.score[m.text.index(w[a:b])] for a, b in zip((0, *cut), (*cut, 5)))
                   for k in range(5) for cut in itertools.combinations(range(1, 5), k)
                   if all(w[a:b] in m.text for a, b in zip((0, *cut), (*cut, 5))))
        assert "".join(m.text[i] for i in ids) == w and abs(m.score[ids].sum() - best) < 1e-9


def test_toxicity_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.fit(docs, labels.where("doc_id % 3 <> 0"))
    held = labels.where("doc_id % 3 = 0").select("doc_id", "toxic").withColumnRenamed("toxic", "label")
    got = toxicity.score(docs.join(held, "doc_id").drop("label"), model).join(held, "doc_id").toPandas()
    clean, bad = got[got.label == 0], got[got.label == 1]
    assert clean.toxic.mean() < 0.02 and bad.toxic.mean() > 0.8
    assert bad.expected_severity.mean() > 10 * clean.expected_severity.mean()
    assert (np.diff(model.thresholds) > 0).all()


def test_toxicity_fit_recovers_the_order():
    r = np.random.default_rng(0)
    x = r.normal(size=(3000, 4))
    w, cuts = np.array([2.0, -1.0, 0.5, 0.0]), np.array([-0.5, 0.5, 2.0])
    grade = (x @ w + r.logistic(size=3000))[:, None] > cuts
    got, theta = toxicity.fit_ordinal(x, grade.sum(1), np.ones(3000))
    assert np.allclose(got, w, atol=0.25) and np.allclose(theta, cuts, atol=0.25)


def test_toxicity_odd_inputs(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (2, "", "y"), (3, "idiot " * 5000, "z"), (None, "a", "w")], "doc_id long, text string, toxic string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one_class = spark.createDataFrame([(1, 1, 0), (3, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, one_class):
        got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
        assert len(got) == 5 and all(r.severity == 0 and not r.toxic for r in got)
    assert toxicity.keep_clean(docs, toxicity.fit(docs, none)).collect() == docs.collect()
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), none)).count() == 0


def test_toxicity_counts_words_and_beginnings():
    n, words = toxicity.counts(pa.array(["Idiots, idiot! Été", None, ""]), ["w:idiot", "4:idio", "5:idiot", "w:été"])
    assert n.tolist() == [[1, 2, 2, 1], [0] * 4, [0] * 4] and words[0] >= 3


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body class="widget">
<header><h1>Site name</h1></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav><div id="cookie-notice">We use cookies, accept them</div>
<div class="layout"><div class="story"><h2>Head &amp; tail</h2><p>First   paragraph with a <a href=x>link</a>,
<b>bold<i>both</b>italic</i> and &lt;tags&gt; that is long enough.<p>Second one<br>after a break.<ul><li>item one<li>item two</ul></div>
<div class="story"><p>Another section of the same article, rather long as well, with more words.</p><blockquote>Quoted</blockquote></div>
<aside><p>Read also this long teaser text about something else entirely</p></aside><div class="ad">Buy now</div></div>
<form><label>Mail</label><input><button>Send</button></form><section id="comments"><p>First! A reader comment that is long and dense and says nothing at all.</p></section>
<footer>&copy; 2024 Site</footer></body></html>"""


def test_main_text_of_a_page():
    assert html_text.main_text(PAGE) == ("Head & tail\nFirst paragraph with a link, boldbothitalic and <tags> that is long enough.\nSecond one after a break.\n"
                                         "item one\nitem two\nAnother section of the same article, rather long as well, with more words.\nQuoted")


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain", "plain"), ("<p>a<p>b", "a\nb"), ("<article><h1>Only</h1></article><footer>f</footer>", "Only"), ("<!-- x", ""), ("<script>x", ""), ("<p>cut off<b", "cut off"),
    ("<p>a&nbsp;&#x41;&am", "a A&am"), ("</div></p>x", "x"), ("<div>" * 5000 + "deep", "deep"), ("<nav>menu</nav>", ""), ("<p>x < y</p>", "x < y"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc")])
def test_main_text_of_odd_pages(page, text):
    assert html_text.main_text(page) == text


LONG = "A sentence of this article that is rather long and dense, with many words and no link. " * 3


@pytest.mark.parametrize("part", [
    f"<section id='discussion'><p>{LONG}</p></section>", "<h2 id='related-work'>Related work</h2>", f"<section id='feedback'><p>{LONG}</p></section>",
    f"<p class='notice-period'>{LONG}</p>", f"<div class='social-policy'><p>{LONG}</p></div>", "<pre><code>x = 1 <span class='hljs-comment'># one</span></code></pre>",
    "<p>Since <math><mi>a</mi><mo>=</mo><mn>2</mn></math> it holds.</p>", "<ul><li><a href=1>First paper</a><li><a href=2>Second one</a><li><a href=3>Third</a></ul>"])
@pytest.mark.parametrize("around", ["<article><h1>Title</h1><p>{0}</p>{1}<p>{0}</p></article>", "<nav>menu</nav><main><p>{0}</p>{1}<p>{0}</p></main><footer>f</footer>"])
def test_article_text_stays_whatever_its_name(part, around):
    import re
    words = [w for w in re.sub(r"<[^>]*>", " ", part).split()]
    text = html_text.main_text(around.format(LONG, part))
    inner = text[len(LONG.strip()):-len(LONG.strip())]
    assert "".join(words) in "".join(inner.split())


def test_furniture_in_an_article_goes():
    links = "<a href=1>One more</a> <a href=2>Another</a> <a href=3>Third</a>"
    page = f"<article><p>{LONG}</p><div class='ad'>Buy</div><div class='related'>{links}</div><div class='comments'><p>{LONG}</p></div></article><div class='cookie-bar'>Cookies</div>"
    assert html_text.main_text(page) == LONG.strip()


def test_html_table(spark):
    df = spark.createDataFrame([(1, "u", "<p>é</p>", "t"), (1, "u", "<p>é</p>", "t"), (None, None, None, None)], "page_id long, url string, html string, text string")
    got = html_text.extract_text(df).collect()
    assert [(r.page_id, r.text, r.n_chars) for r in got] == [(1, "é", 1), (1, "é", 1), (None, "", 0)] and got[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    assert html_text.extract_text(df.limit(0)).count() == 0


def test_expected_severity_by_plain_loops(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    model = toxicity.fit(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    assert model.markers
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    m = len(model.markers)
    for i, text in docs.collect():
        words = [w for w in regex.split(r"[^\p{L}\p{M}\p{N}]+", (text or "").lower())]
        eta = 0.0
        for k, marker in enumerate(model.markers):
            cut, token = toxicity.TAGS[marker[:2]], marker[2:]
            n = sum((w[:cut] if cut else w) == token for w in words)
            eta += model.weights[k] * math.log2(1 + n) + model.weights[m + k] * math.log2(1 + 100 * n / max(len(words), 1))
        chances = [1 / (1 + math.exp(min(40.0, max(-40.0, t - eta)))) for t in model.thresholds]
        assert abs(got[i].expected_severity - sum(chances)) < 1e-9
        assert got[i].severity == sum(p >= 0.5 for p in chances) and got[i].toxic == (chances[0] >= 0.5)


def test_toxicity_markers_in_texts_that_share_common_words(spark):
    """Common words are in every text; copies of one text are one voice, so their own words are no markers."""
    r = np.random.default_rng(3)
    text = lambda *more: " ".join(r.permutation([*(f"common{k}" for k in range(12)), *(f"w{x}" for x in r.integers(0, 10**6, 30)), *more]))
    rows = [(i, text("insult" if i % 4 == 0 else "praise"), int(i % 4 == 0)) for i in range(200)]
    copy = text("onlyhere")
    rows += [(1000 + i, copy, 1) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    markers = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic")).markers
    assert "w:insult" in markers and "w:onlyhere" not in markers and not any("common" in m for m in markers)


def test_long_unbroken_words_are_the_librarys():
    r = random.Random(11)
    words = ["".join(r.choice("etaoinshrdlu") for _ in range(200_000)), "a" * 20_000, "".join(r.choice(["the", "ing", "tion", "x", "日", "é"]) for _ in range(3000)),
             "".join(chr(r.randint(0x4E00, 0x9000)) for _ in range(5000)), "two words " + "abcdefg" * 300]
    began = time.perf_counter()
    assert encoded(words) == LIBRARY.encode(words)
    assert time.perf_counter() - began < 120


def test_lists_decode_as_each_one_alone():
    r = random.Random(12)
    byte = [int(x) for x in MODEL.bytes if x >= 0]
    ids = [[r.choice([r.randrange(len(MODEL.text)), r.choice(byte or [5])]) for _ in range(r.randint(0, 12))] for _ in range(300)]
    ids[7:7] = [None, [], None]
    lists = pa.array([[1], *ids, [2]], pa.list_(pa.int32())).slice(1, len(ids))
    assert MODEL.decode_lists(lists).to_pylist() == [None if x is None else MODEL.decode(x) for x in ids]
    plain = pa.array([x for x in LIBRARY.encode(["", "a b  c", " \n日本"])], pa.list_(pa.int32()))
    assert MODEL.decode_lists(plain).to_pylist() == ["", "a b  c", " \n日本"]
