"""Main text and stated fields of pages: boilerplate goes, articles stay, broken markup loses nothing."""

from __future__ import annotations

import html
import re

import pyarrow.parquet as pq

from loomcorpus.functions.main_text import FIELDS, main_text, read_page

SF = "/root/testdata/sf0.001"
WORDS = "this is a sentence of running text with quite a few plain words in it"


def test_given_pages(spark):
    """Against a plain reading of these pages: the article's words, without what stands outside of it."""
    rows = [r for r in pq.read_table(f"{SF}/pages.parquet").to_pylist() if r["html"]]
    before = after = 0
    for r in rows:
        text = read_page(r["html"])["text"]
        article = re.search(r"(?s)<article>(.*)</article>", r["html"])[1]
        outside = re.sub(r"(?s)<article>.*</article>", "", r["html"])
        plain = re.sub(r"(?s)<script.*?</script>|<style.*?</style>|<title.*?</title>|<!--.*?-->|<[^>]*>", " ", outside)
        before += len(plain.split())
        ad = re.search(r'(?s)class="ad">([^<]*)', r["html"])
        after += bool(ad and ad[1].strip() and ad[1].strip() in (text or ""))
        words = set(html.unescape(re.sub(r"<[^>]*>", " ", article)).split())
        if len(words) > 20:
            assert text is not None and len(words & set(text.split())) >= 0.95 * len(words), r["page_id"]
    assert before > 20 * len(rows) and after == 0


def test_links_navigation_and_comments():
    menu = "".join(f'<li><a href="/{i}">Link number {i}</a></li>' for i in range(30))
    page = f"<html><head><title>T &amp; U</title></head><body><div id=side><ul>{menu}</ul></div><div id=main><h2>Head</h2><p>{WORDS}.<p>{WORDS}, more.<br>short end</div><div>Share this</div><footer>{WORDS} foot</footer></body></html>"
    got = read_page(page)
    assert got["text"] == f"Head\n{WORDS}.\n{WORDS}, more.\nshort end" and got["title"] == "T & U"
    assert "Link" in menu and "Link" not in got["text"]


def test_stated_fields():
    head = '<meta property="og:title" content=" A title "><meta name="AUTHOR" content="Ann Lee"><meta name=description content="d"><meta property="og:site_name" content="Site"><title>other</title>'
    got = read_page(f"<html><head>{head}</head><body><article><time datetime='2026-01-02'>x</time><p>{WORDS}</p></article></body></html>")
    assert [got[f] for f in FIELDS[1:]] == ["A title", "Ann Lee", "2026-01-02", "d", "Site"]
    assert read_page(f"<p>{WORDS}</p><h1>Only a head</h1><p>{WORDS} again</p>")["title"] == "Only a head"


def test_unclosed_and_empty(spark):
    pages = [None, "", "<p>x", f"<div><nav>menu</div><p>{WORDS}</p><p>{WORDS} two", f"<article><p>{WORDS}<p>{WORDS}</article>" + "<!-- c -->" * 9, "<b>" * 4000 + WORDS]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "k int, p string").select("k", main_text("p").alias("m")).collect()
    got = {r.k: r.m.text for r in rows}
    assert got == {0: None, 1: None, 2: None, 3: f"{WORDS}\n{WORDS} two", 4: WORDS, 5: WORDS}
