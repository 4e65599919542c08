import hashlib
import html as html_lib
import json
import re
import time
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tidepool.llm import html_wrappers as H
from tidepool.llm import packing, quality_rules
from tidepool.llm.common import table

from .conftest import words
from .test_counting_operators import waterfill
from .test_dedup_and_join import brute_components, brute_dedup

SF = "/root/testdata/sf0.001"

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><div id="sidebar-2"><p>Side</p></div>
<main><article class="post"><header><h1>{title}</h1></header><p>{first}<p>Second &amp; last&nbsp;line
 wrapped<br>here</p><div class="ad-box">Buy</div><form><input name=q><button>Go</button></form>
<script>var x = "</p>";</script><!-- <p>hidden</p> --><blockquote>Quote</blockquote><table><tr><td>1<td>2</table>
<footer>By me</footer></article><section id="comments"><article class="comment"><p>Nice</p></article></section></main>
<footer>Bottom</footer></body></html>"""


def test_article_without_the_rest():
    text = H.main_text(PAGE.format(title="A &lt;b&gt; C", first="One <b>bold</b> word"))
    assert text == "A <b> C\nOne bold word\nSecond & last line wrapped here\nQuote\n1\n2"


def test_pages_that_are_cut_or_odd():
    assert H.main_text("") == "" and H.main_text("plain\n text") == "plain text"
    assert H.main_text("<article><p>abc <b>de") == "abc de"
    assert H.main_text("<p>1 < 2 and 3 > 1</p>") == "1 < 2 and 3 > 1"
    assert H.main_text("<article>x<!-- never ends <p>y</p>") == "x"
    assert H.main_text("<article>x<script>never ends") == "x"
    assert H.main_text("<div id=content><h2>T</h2><p>a<p>b</div><div class=comments>c</div>") == "T\na\nb"
    assert H.main_text("</div></p><ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == "a\nb\nc\nd"
    assert H.main_text("<nav>only</nav>") == ""


def test_wrapper_alignment():
    pages = ["<h1>A</h1><p>x</p><p>y</p><div>fix</div>", "<h1>B</h1><p>z</p><div>fix</div><ul><li>1</li></ul>"]
    w = H.merge([H.wrapper_of(H.parse(p)) for p in pages])
    assert H.expression(w) == "<h1> # </> (<p> # </>)+ <div> text </> (<ul> <li> text </> </>)?"


def test_template_text_of_a_host_is_left_out(spark):
    def page(i):
        return (i, f"http://h.example/{i}", f"<div><div class=story><p>Text number {i} of many words</p></div>"
                                            f"<div class=tail><span>Read more on this site</span></div></div>", "x")
    other = [(100, "http://one.example/", "<div><p>Only page</p></div>", "x"), (101, None, None, "x"), (102, "", "<p>b</p>", "x")]
    pages = spark.createDataFrame([page(i) for i in range(12)] + other, "page_id long, url string, html string, extra string")
    got = {r["page_id"]: r for r in H.extract(pages.repartition(4)).collect()}
    assert all(got[i]["text"] == f"Text number {i} of many words" for i in range(12))
    assert got[100]["text"] == "Only page" and got[101]["text"] == "" and got[102]["text"] == "b"
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert H.extract(pages.limit(0)).count() == 0


def test_names_inside_an_article_take_only_whole_containers():
    html = ('<article><h2 id="discussion">D</h2><section id="related-work">RW</section><section id="discussion"><p>z</p></section>'
            '<p class="reply">R</p><div class="social-policy">S</div><div class="share-price">P</div><div class="ad-box">Buy</div>'
            '<div id="sidebar-2">x</div><div class="cookie-notice">c</div><ul class="share-buttons"><li>s</li></ul></article>')
    assert H.main_text(html).split("\n") == ["D", "RW", "z", "R", "S", "P"]


def test_formulas_and_fallback_text_stay():
    html = "<article><p>a <math><mi>x</mi><mo>=</mo></math> b</p><svg><text>S</text></svg><object>O</object><canvas>C</canvas></article>"
    assert H.main_text(html) == "a x= b\nSOC"
    assert H.main_text("<article>t<svg><text>un<p>rest</article>") == "tun\nrest"
    assert H.main_text('<a b="x>y">k</a>') == "k"


def test_hostile_pages_take_linear_time():
    assert H.main_text("<div>" * 10_000 + "text" + "</div>" * 10_000) == "text"
    assert json.dumps(H.wrapper_of(H.parse("<div>" * 10_000 + "text")))
    began = time.time()
    for html in ("<a " * 350_000, '<a ">" ' * 150_000, "<a \'" * 250_000, "<!" * 500_000, "</script" * 125_000,
                 "<blockquote>" * 10_000 + "<li></li></x>" * 10_000, "<p class=a>" * 90_000, "&" * 1_000_000):
        H.main_text(html)
    assert time.time() - began < 60


def test_the_wrapper_decides_what_is_main_text(spark):
    """No page here can be read alike without its host's wrapper: an article
    that is the same everywhere, a main part without article or main tags, and
    ``main`` with template texts."""
    def story(i):
        return " ".join(f"w{i}x{k}" for k in range(30))
    rows = [(i, f"http://a.example/{i}", f"<article class=about><p>About this site</p></article><div class=x><div class=y><p>{story(i)}</p>"
                                         f"<p>{story(i + 50)}</p></div><p>Imprint</p></div>") for i in range(5)]
    rows += [(10 + i, f"http://b.example/{i}", f"<main><p>{story(i)}</p><div class=back>Back to start</div></main><p>z{i}</p>") for i in range(5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in H.extract(pages).collect()}
    assert got == {i: f"{story(i)}\n{story(i + 50)}" for i in range(5)} | {10 + i: story(i) for i in range(5)}
    alone = {i: H.main_text(html) for i, _, html in rows}
    assert all(alone[i] != got[i] for i in got)


def test_near_copies_on_a_host_are_no_template(spark):
    rows = [(i, f"http://c.example/{i}", f"<div><p>{'same words ' * 20}</p><p>only {i} differs</p></div>") for i in range(6)]
    got = H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r["text"] == f"{('same words ' * 20).strip()}\nonly {r['page_id']} differs" for r in got)


def test_copies_of_a_page_with_other_repeated_parts_keep_their_article(spark):
    """The list varies within a page, not from page to page."""
    html = "<div><i>x</i><dl><dt>a<dd>b<dt>c<dd>d</dl></div><article><p>The only paragraph</p></article>"
    rows = [(i, "http://g.example/", html) for i in range(1, 6)] + [(9, "http://alone.example/", html)]
    got = H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [r["text"] for r in got] == ["The only paragraph"] * 6


def test_long_sequences_align_like_short_ones():
    a = [[["h%d" % (k % 7), 1, 0, 0, []], False, False] for k in range(500)]
    b = a[:200] + [[["x", 1, 0, 0, []], False, False]] + a[200:]
    w = H._merge_kids([list(k) for k in a], [list(k) for k in b])
    assert len(w) == 501 and [k[0][0] for k in w if k[1]] == ["x"]
    assert H._aligned(a, b) == [(i, i + (i >= 200)) for i in range(500)]


def test_hosts_with_many_wrappers_merge_in_a_tree(spark):
    rows = [(i, "http://d.example/", f"<div><p>page {i} {'w' * (i % 9)}</p></div>", "u") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = H.extract(pages.repartition(40)).collect()
    assert all(r["text"] == rows[r["page_id"]][2][8:-10].strip() for r in got) and len(got) == 60
    assert H.infer(pages.repartition(40)).count() == 1


def test_clashing_columns_do_not_matter(spark):
    rows = [(1, "http://e.example/", "<p>a</p>", "h", "f", "p", 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, rules string, part string, width long")
    assert [r["text"] for r in H.extract(pages).collect()] == ["a"]


def test_driver_pages_equal_a_plain_reading(spark):
    """The tables' pages have one article each; read it with a few patterns."""
    pages = table(spark, SF, "pages")
    got = {r["page_id"]: r["text"] for r in H.extract(pages).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)(</article>|<footer>|$)", r["html"], re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", body).replace("<br>", " "))
        want = [" ".join(html_lib.unescape(b).split()) for b in blocks]
        assert got[r["page_id"]] == "\n".join(b for b in want if b)


# ---------------------------------------------------------------- pipeline

def test_every_stage_equals_brute_force(spark):
    docs = table(spark, SF, "documents")
    steps = dict(corpus_pipeline.STAGES)
    assert [k for k, _ in corpus_pipeline.STAGES][0] == "quality_rules" and len(steps) == 5
    kept = steps["quality_rules"](spark, docs, SF)
    verdict = {r["doc_id"] for r in quality_rules.judge(docs).filter("kept").collect()}
    rows = [tuple(r) for r in kept.collect()]
    assert {r[0] for r in rows} == verdict and kept.columns == docs.columns

    def frame(rows):
        return spark.createDataFrame(rows, docs.schema)

    near = steps["ngram_jaccard_join"](spark, frame(rows), SF)
    want = {d for d, (_, c) in brute_components(rows).items() if c == d}
    rows = [tuple(r) for r in near.collect()]
    assert {r[0] for r in rows} == want and near.columns == docs.columns

    cut = steps["substring_dedup"](spark, frame(rows), SF)
    want = brute_dedup(rows)
    before = {r[0]: r[1] for r in rows}
    rows = [tuple(r) for r in cut.collect()]
    for r in rows:
        n, gone, text = want[r[0]]
        assert r[1] == (text if gone else before[r[0]]) and r[4] == len(r[1])
    assert len(rows) == len(want) and cut.columns == docs.columns

    mixed = steps["source_mix"](spark, frame(rows), SF)
    size = defaultdict(int)
    for r in rows:
        size[r[3]] += len(words(r[1]))
    rows = [tuple(r) for r in mixed.collect()]
    taken = defaultdict(int)
    for r in rows:
        taken[r[3]] += len(words(r[1]))
    for s, t in waterfill(size).items():
        assert abs(taken[s] - t) <= 0.5
    assert mixed.columns == docs.columns

    pieces = steps["packing"](spark, frame(rows), SF).collect()
    encode = packing.Encoder(packing.default_tokenizer())
    want = sorted(hashlib.sha256((encode(r[1] or "").tobytes() + b"\0" * 4)).hexdigest() for r in rows)
    tokens = {r["row"]: r["doc_tokens"] for r in pieces}
    assert len(tokens) == len(want)
    total = sum(len(encode(r[1] or "")) + 1 for r in rows)
    assert sum(r["length"] for r in pieces) == total == sum(tokens.values())
    crc = {zlib.crc32(p.astype("<u4").tobytes()) for r in rows for ids in [np.append(encode(r[1] or ""), 0)]
           for p in [ids[i:i + 1024] for i in range(0, len(ids) - len(ids) % 1024, 1024)]}
    assert crc <= {r["ids_crc32"] for r in pieces}


def test_near_copies_of_the_stage_have_five_words_and_80_percent(spark):
    """Pairs between this limit and that of op10 (four words, 85 %)."""
    base = [[f"d{k}w{i}" for i in range(200)] for k in range(5)]
    swapped = [f"other{i}" if i in (40, 80, 120, 160) else w for i, w in enumerate(base[0])]
    below = [f"other{i}" if i in (30, 60, 90, 120, 150) else w for i, w in enumerate(base[2])]
    texts = [base[0], swapped, base[1], [*base[1], *(f"more{i}" for i in range(40))], base[2], below,
             base[3], base[3], base[4]]
    rows = [(i, " ".join(t), "en", "a", 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    got = sorted(r["doc_id"] for r in dict(corpus_pipeline.STAGES)["ngram_jaccard_join"](spark, docs, SF).collect())
    assert got == sorted(d for d, (_, c) in brute_components(rows, n=5, threshold=80).items() if c == d)
    assert got == [0, 2, 4, 5, 6, 8]


def test_near_copies_of_the_stage_equal_brute_force_on_the_table(spark):
    docs = table(spark, SF, "documents")
    near = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"](spark, docs, SF)
    rows = [tuple(r) for r in docs.collect()]
    want = {d for d, (_, c) in brute_components(rows, n=5, threshold=80).items() if c == d}
    assert {r["doc_id"] for r in near.collect()} == want


def test_run_on_an_empty_and_an_odd_table(spark, documents, tmp_path):
    for name, rows in (("odd", documents), ("empty", documents.limit(0))):
        rows.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        out = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns)
        assert (out.count() > 0) == (name == "odd")
        assert out.filter(F.col("length") <= 0).count() == 0
