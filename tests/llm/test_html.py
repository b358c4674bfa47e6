"""Main texts of small hosts made by hand."""

import pytest
from pyspark.sql import functions as F

from tallyframe.llm import html_text
from tallyframe.llm.work import Workspace


@pytest.fixture(scope="module")
def texts(spark):
    def run(*pages):
        table = spark.createDataFrame([(i, f"http://h/{i}", p) for i, p in enumerate(pages)], "page_id long, url string, html string").repartition(3)
        return [r["text"] for r in html_text.extract(table, Workspace(spark, "t")).orderBy(F.col("page_id")).collect()]

    return run


def test_tree_decides_about_main_parts(texts):
    page = "<html><body><div class='top'>Home and more</div><div class='lead'>lead {0}</div><article><p>text {0}</p><div class='follow'><p>Follow us</p></div></article></body></html>"
    assert texts(*[page.format(i) for i in range(5)]) == [f"lead {i}\n\ntext {i}" for i in range(5)]


def test_main_parts_are_never_taken_whole(texts):
    near = "<html><body><div class='top'>top {}</div><main><p>one and the same</p></main></body></html>"
    assert all("one and the same" in t for t in texts(*[near.format(i) for i in range(5)]))
    shared = [f"<article><p>shared</p><p>more of it</p><p>changed {i}</p></article>" for i in range(30)]
    assert texts(*shared, "<article><p>another</p></article>") == [*[f"shared\n\nmore of it\n\nchanged {i}" for i in range(30)], "another"]


def test_copies_of_a_page_count_once(texts):
    copy = "<html><body><div class='post'><p>the same page</p><p>again and again</p></div></body></html>"
    other = "<html><body><div class='post'><p>text {0}</p></div></body></html>"
    assert texts(*[copy] * 40, *[other.format(i) for i in range(4)]) == ["the same page\n\nagain and again"] * 40 + [f"text {i}" for i in range(4)]


def test_names_are_evidence(texts):
    wrapped = "<div class='sidebar'><article><p>in the article</p></article></div>"
    ids = "<div class='content with-sidebar'><article><h2 id='related-work'>Related</h2><h2 id='search'>Search</h2><section id='social-history'><p>history</p></section></article></div>"
    assert texts(wrapped, ids) == ["in the article", "Related\n\nSearch\n\nhistory"]
    page = "<article><p>text {0} <a class='share'>Share</a> end {0}</p><section class='notice'><p>notice {0}</p></section><div class='newsletter'><p>Sign up</p></div></article><div class='ad'>short {0}</div><div class='widget'>{1}</div>"
    long = "only here {0} " * 30
    got = texts(*[page.format(i, long.format(i)) for i in range(5)])
    assert got == [f"text {i} end {i}\n\nnotice {i}\n\n{long.format(i).strip()}" for i in range(5)]


def test_declarations_and_deep_pages():
    assert html_text.main_text("<p>one</p><![foo bar <p>two</p>") == "one\n\ntwo"
    assert html_text.main_text("<p>a</p><![CDATA[x]]><p>b</p><!-- open <p>c</p>") == "a\n\nb"
    assert html_text.main_text("<p>3<!--[if IE]><p>no<![endif]--><p>4<script>//<![CDATA[\n a>b //]]></script><p>5") == "3\n\n4\n\n5"
    assert html_text.main_text("<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>x") == "deep\n\nx"
    assert html_text.main_text(None) == html_text.main_text("") == ""
