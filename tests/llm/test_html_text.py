import re
from html import unescape

import numpy as np

from paddockflow.llm import html_text
from paddockflow.llm.queries import QUERIES

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{a:b}</style></head><body>
<header><p>Site name and slogan of the whole site</p></header><nav><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></nav>
<div class="cookie-notice">We use cookies to give you the best experience on this site.</div>
<article><header><h1>A &lt;title&gt; &amp; more</h1></header><p>First   paragraph,\n with <b>bold</b>&nbsp;text and a <a href=z>link</a>.</p>
<!-- <p>hidden</p> --><p>Et la.<div class="ad-slot">Buy this thing today and save a lot of money on it.</div>
<script>var a = "</p><p>no</p>";</script><form><p>Your mail address please</p><button>Send</button></form>
<p>Last one: 1 < 2.</p></article><aside class=x><p>Related things that you may like to read as well, my friend.</p></aside>
<div id="comments"><p>I, a reader, think that this is a very good article indeed.</p></div>
<footer>&copy; someone and others</footer>"""


def test_parts_of_a_page():
    want = ["A <title> & more", "First paragraph, with bold text and a link.", "Et la.", "Last one: 1 < 2."]
    assert html_text.main_text(PAGE).split("\n\n") == want


def test_pages_without_names_for_their_parts():
    text = "This is a long paragraph of running text that goes on for quite a while without any links in it at all. " * 2
    links = "<div>" + "".join(f'<p><a href="{i}">Entry {i}</a></p>' for i in range(8)) + "</div>"
    got = html_text.main_text(f"<body>{links}<div><p>{text}</p><p>{text}</p></div>{links}")
    assert got == "\n\n".join([text.strip()] * 2)


def test_broken_pages():
    for page in (None, "", "   ", "<", "<p", "<!-- open", "<script>never closed", "<a href=\"", "</div></p>", "<div " * 50,
                 "<div>" * 30_000 + "x" + "</p></x>" * 30_000, "<a href='" * 5000, "<script a=\"" * 300):
        assert isinstance(html_text.main_text(page), str)
    assert html_text.main_text("<article><p>Cut off in the mid") == "Cut off in the mid"
    assert html_text.main_text("<article><h1>One &am</h1><p>Two &amp</p></article>") == "One &am\n\nTwo &"


def test_query_equals_the_articles(spark, sf_dir):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op5_html_extraction"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)(?:</article>|$)", pages[r["page_id"]], re.S)[1]
        blocks = (" ".join(unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>|<br>", article))
        assert r["text"] == "\n\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


def test_tables(spark):
    rows = [(1, "u", None, "m"), (1, "u", None, "m"), (None, None, PAGE, "m"), (2, "u", "<p>" + "word " * 60_000, "m")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, main_text string")
    got = html_text.extracted(frame.withColumnRenamed("url", "the url: of it")).collect()
    assert sorted(len(r["main_text"]) for r in got)[:2] == [0, 0] and len(got) == 4
    assert html_text.extracted(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_tree_fits_its_table():
    table = np.array(html_text.TRAINING, float)
    assert ((html_text.trained().predict(table[:, :-1]) >= 0.5) == (table[:, -1] == 1)).all()
