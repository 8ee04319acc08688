"""Sources, text functions, JSON repair and planning helpers on small edge cases."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from loomcorpus.functions import semistructured as J
from loomcorpus.functions import markup
from loomcorpus.functions import text as X
from loomcorpus.functions import vectors as V
from loomcorpus.operators import analytics, archives, library, state
from loomcorpus.sources import readers


def values(spark, rows, expression, schema="x string"):
    df = spark.createDataFrame([(r,) for r in rows], schema)
    return [r[0] for r in df.coalesce(1).select(expression).collect()]


def test_titles_and_names(spark):
    names = ["water_purification-guide.pdf", "FM_[1990].pdf", "a.pdf", "USA_notes.pdf"]
    assert values(spark, names, X.title_from_filename(F.col("x"))) == ["Water Purification Guide", "FM (1990)", "a", "USA Notes"]
    assert values(spark, [None, "A & B", "emergency medicine", "Art OF War", " "], X.folder_name(F.col("x"))) == ["Uncategorized", "A-and-B", "Emergency-Medicine", "Art-of-War", "Uncategorized"]
    authors = [None, "Last, First", "First M. Last", "X Y Jr.", "Some University", "van der"]
    assert values(spark, authors, X.author_last_name(F.col("x"))) == [None, "Last", "Last", None, None, None]
    assert values(spark, ["1801 and 2004", "1799", None], X.last_year(F.col("x"))) == ["2004", None, None]


def test_urls(spark):
    paths = [None, "", "http://h/x", "/a b/ü.pdf"]
    assert values(spark, paths, X.download_url(F.col("x"), "https://base/")) == ["", "", "http://h/x", "https://base/a%20b/%C3%BC.pdf"]
    urls = ["https://h.org/a/the-big_one.html", "https://h.org/", "HTTPS://H.org/Can%20do-it%2B1.txt?x#y", "http://h.org/a/b%2Fc%20d/", "h.org/x_y", "http://h.org/a+b%zz", "http://u@h.org:8/don't_3d;p", None]
    assert values(spark, urls, X.title_from_url(F.col("x"))) == ["The Big One", "h.org", "Can Do It+1", "C D", "X Y", "A+B%Zz", "Don'T 3D", None]


def test_text_gates(spark):
    good = "the water is boiled for ten minutes before anyone drinks it at all"
    rows = [good, good[:49], "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 21 22 23", "camelCaseRunTogether " * 5, ""]
    assert values(spark, rows, X.quality_ok(F.col("x"))) == [True, False, False, False, False]
    assert values(spark, ["  short ", "long enough text", None], X.embeddable(F.col("x"))) == [None, "long enough text", None]


def test_chunks(spark):
    para = lambda n, w="w": " ".join([w] * n)
    rows = ["", para(10), para(14), ". ".join([para(4)] * 5) + ".", para(6) + "\n\n" + para(6), para(3) + "\n\n" + para(3)]
    got = values(spark, rows, X.chunk_pages(F.col("x"), 10))
    assert [[len(p.split()) for p in pages] for pages in got] == [[0], [10], [14], [8, 8, 4], [6, 6], [6]]


def test_markup_and_addresses(spark):
    html = "<html><title> T </title><script>x()</script><p>a&amp;b</p><ul><li>one<li>two</ul>c<br>d</html>"
    assert values(spark, [html], markup.html_text(F.col("x"))) == ["T a&b- one\n- two\nc\nd"]
    assert markup.read_html("<nav>n</nav>x<table><tr><th> a\n b</th><td></td><td>c</td></tr><tr><td><br>d</table>y<dl><dt>k<dd>v</dl>&eacute;") == "x\n\na b | c\nd\n\nyk\n v\né"
    assert markup.read_html("<header>h<p>i</header> j<aside>k") == "j"
    # An element that is left open ends with its parent, and a weaker end tag closes no stronger element.
    assert markup.read_html("<div><nav>menu</div><p>text</p>") == "text"
    assert markup.read_html("<div><header>h<div>x</div></div>a<nav>m</span></nav>b</footer>c") == "abc"
    assert markup.read_html("<nav><div>m</nav>still menu</div></nav>text") == "text"
    assert markup.read_html("<ul><li><nav>a<li>b</nav></li><li>c</ul>d<script>var x='</p>'") == "- \n- c\nd"
    assert markup.read_html("<table><tr><td><aside>x</td><td>y</table>z") == "y\n\nz"
    parts = values(spark, ["214 North St, Filer, ID", "214 North St 83328", "no number"], X.parse_address(F.col("x"), ["ID"]))
    assert tuple(parts[0]) == ("214", "NORTH ST", "FILER", "ID", None)
    assert tuple(parts[1]) == ("214", "NORTH ST", None, None, "83328")
    assert parts[2].number is None
    assert values(spark, ["01:02:03.500", "02:03.000"], X.cue_seconds(F.col("x"))) == [3723.5, 123.0]
    assert values(spark, ["a=1;b=x;c=3"], X.counter_map(F.col("x"))) == [{"a": 1, "c": 3}]


def test_json(spark):
    rows = ['[{"a": 1}]', '[{"a": 1},]', '[{"a": "x\\e"}]', '[{"a": 1}, {"b": [1, 2', "hopeless", None]
    fixed = values(spark, rows, J.repair(F.col("x")))
    assert [None if x is None else [sorted(o) for o in json.loads(x)] for x in fixed] == [[["a"]], [["a"]], [["a"]], [["a"]], None, None]
    lists = values(spark, ['"one"', '["a", "b"]', "3", None], J.as_list(F.try_parse_json("x")))
    assert lists == [["one"], ["a", "b"], None, None]
    picked = J.first_valid(F.split("x", ","), ["Water", "Food"], "Other")
    assert values(spark, ["bad,food.", "x", " WATER "], picked) == ["Food", "Other", "Water"]


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [3.0, 4.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    assert [round(r[0], 6) for r in df.coalesce(1).select(V.cosine(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0]


def test_planning(spark):
    files = spark.createDataFrame([("h1", "d", "t", None, None), ("h2", "d", "t", "Ann", None), ("h3", "d", "t", "Bo", 1999), ("h4", "d", "u", None, None)], "hash string, folder string, title string, author string, year int")
    taken = spark.createDataFrame([("d", "t.pdf", "h1"), ("d", "t_Bo.pdf", "h9")], "folder string, name string, hash string")
    got = {r.hash: (r.step, r.name) for r in library.ladder(files, taken).collect()}
    assert got == {"h1": (1, "t.pdf"), "h2": (2, "t_Ann.pdf"), "h3": (3, "t_Bo_1999.pdf"), "h4": (1, "u.pdf")}


def test_state(spark):
    rows = spark.createDataFrame([("a", "enriching", "2024-01-01 10:00:00"), ("b", "enriching", "2024-01-01 07:00:00"), ("c", "enriching", None), ("d", "enriching", "bad"), ("e", "complete", None)], "hash string, status string, extracted_at string")
    got = {r.hash: r.status for r in state.stale(rows, F.lit("2024-01-01 11:00:00").cast("timestamp")).collect()}
    assert got == {"a": "enriching", "b": "extracted", "c": "extracted", "d": "extracted", "e": "complete"}
    assert [tuple(r) for r in state.mark_failed(rows.limit(1), F.repeat(F.lit("x"), F.lit(2000))).select("status", F.length("error_message")).collect()] == [("failed", 1000)]


def test_as_of_before_first_cue(spark):
    rows = spark.createDataFrame([("k", 5), ("k", 10), ("k", 99), ("z", 1)], "key string, pos int")
    cues = spark.createDataFrame([("k", 10, 1.0), ("k", 20, 2.0)], "key string, at int, secs double")
    got = {(r.key, r.pos): r.secs for r in analytics.as_of(rows, cues, "key", "pos", "at", "secs").collect()}
    assert got == {("k", 5): 1.0, ("k", 10): 1.0, ("k", 99): 2.0, ("z", 1): None}


def test_readers(spark, tmp_path):
    for name, data in {"lib/Sub/x/a.pdf": b"1", "lib/_hidden/b.pdf": b"2", "lib/Sub/c.PDF": b"1", "lib/d.txt": b"3"}.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    files = {r.filename: (r.source, r.category) for r in readers.library_files(spark, str(tmp_path / "lib")).collect()}
    assert files == {"a.pdf": ("Sub", "x"), "c.PDF": ("Sub", "Sub")}
    (tmp_path / "urls.txt").write_text("http://a\n\n# no\n http://b \n")
    assert [r.url for r in readers.url_list(spark, str(tmp_path / "urls.txt")).collect()] == ["http://a", "http://b"]
    entry = "<entry><id>urn:uuid:1</id><title>T</title><name>n</name><flavour>maxi</flavour><category></category><articleCount>12</articleCount><link type='image/png' href='/i'/><link type='text/html' href='/content/wiki_en_2025'/></entry>"
    (tmp_path / "feed.xml").write_text(f"<feed>{entry}<entry><id>2</id><category>c</category></entry></feed>")
    got = {r.uuid: (r.title, r.name, r.flavour, r.category, r.article_count, r.zim_filename) for r in readers.opds_entries(spark, str(tmp_path / "feed.xml")).collect()}
    assert got == {"1": ("T", "n", "maxi", None, 12, "wiki_en_2025.zim"), "2": (None, None, None, "c", 0, None)}
    (tmp_path / "i.json").write_text(json.dumps([{"source": "s", "category": "c", "content": "x"}, {"source": "s"}]))
    good, bad = readers.intel_json(spark, str(tmp_path / "i.json"))
    assert (good.count(), bad.count()) == (1, 1)
    windows = tmp_path / "w" / "h1"
    windows.mkdir(parents=True)
    (windows / "window_0001.json").write_text('[{"title": "a"}]')
    (windows / "window_0002.json").write_text("{broken")
    got = {r.win: (r.bad, r.concepts and r.concepts[0].title) for r in readers.concept_windows(spark, str(tmp_path / "w")).collect()}
    assert got == {1: (False, "a"), 2: (True, None)}
    body = "WEBVTT\n\n00:01.000 --> 00:02.000\n<b>Hi</b>\n\n00:02.000 --> 00:03.000\nHi\n\n00:00:04.000 --> 00:05.000\n\n\n00:06.000 --> 00:07.000\nthere\nyou\n"
    cues = readers.vtt_cues(spark.createDataFrame([("v", body)], "id string, body string"), "id", "body").orderBy("pos").collect()
    assert [(r.start, r.text) for r in cues] == [(1.0, "Hi"), (6.0, "there you")]
    captions = spark.createDataFrame([("v", "fr", 0, "a"), ("v", "en", 1, "b"), ("w", "de", 0, "c")], "id string, lang string, pos int, path string")
    assert {(r.id, r.path) for r in readers.caption_choice(captions, "id").collect()} == {("v", "b"), ("w", "c")}
    hopper = spark.createDataFrame([("a.pdf",), ("a.meta.json",), ("b.txt",), ("a.epub",)], "filename string")
    assert {(r.base, r.filename, r.has_meta) for r in readers.hopper_pairs(hopper).collect()} == {("a", "a.epub", True), ("b", "b.txt", False)}


@pytest.mark.parametrize("title,bad", [(None, True), ("abc", True), ("Untitled", True), ("Good title", False)])
def test_garbage_titles(spark, title, bad):
    assert values(spark, [title], X.garbage_title(F.col("x"), ["untitled"], ["microsoft word"])) == [bad]


def test_entries_are_ruled_out_without_their_text(spark):
    """Neither Python nor the pages' HTML is needed; where the text is read, pages that are ruled out aren't sent to Python."""
    rows = [("A/1", "text/html", False), ("A/2/de", "text/html", None), ("A/3", "image/png", False), ("A/4", "text/html", True), ("A/5", "text/html", False), ("A/6", None, False)]
    entries = spark.createDataFrame([(p, "t", m, r, f"<p>{p} {'word ' * 60}") for p, m, r in rows], "path string, title string, mimetype string, redirect boolean, html string")
    seen = spark.createDataFrame([("A/5",), ("A/5",)], "path string")
    found = archives.ruled_out(entries, seen).select("path", "early")
    assert dict(found.collect()) == {"A/1": None, "A/2/de": "foreign", "A/3": "ignored", "A/4": "ignored", "A/5": "ignored", "A/6": "ignored"}
    assert "EvalPython" not in found._jdf.queryExecution().optimizedPlan().toString()
    actions = archives.article_actions(entries, seen, spark.createDataFrame([], "hash string"))
    assert {r.path: (r.action, r.content is not None) for r in actions.collect()} == {
        "A/1": ("article", True), "A/2/de": ("foreign", False), "A/3": ("ignored", False), "A/4": ("ignored", False), "A/5": ("ignored", False), "A/6": ("ignored", False)
    }


def test_archive_articles_reads_no_text(spark):
    from loomcorpus.plans import QUERIES

    assert "EvalPython" not in QUERIES["s17_archive_articles"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()


def test_page_text_sql_reads_references_as_the_parser_does():
    """Names without a semicolon, longer names, references cut by a tag, and blanks at the ends."""
    import duckdb

    from loomcorpus.plans.analytics_queries import page_text_sql

    pages = [
        "<h1>a &ampTo</h1><p>x &amp; &amp;lt; &lt;b&gt; &ltimes; &ltfoo &GT &#39s &#39&#39&#39</p>", "<h1>x &am</h1>pour <b>q&amp</b>; r", " &nbsp;x y&nbsp;",
        "<p>a &quotb&quot; &ampamp; &amp", "a&nbspb &AMPc &QUOT;", "<li>a &lt</li>c &amp;AMP &amp;#39; &am&amp;p;", None,
    ]
    db = duckdb.connect()
    db.execute("CREATE TABLE pages (page_id INT, html VARCHAR)")
    db.executemany("INSERT INTO pages VALUES (?, ?)", list(enumerate(pages)))
    got = [r[1] for r in db.execute(f"{page_text_sql()} ORDER BY page_id").fetchall()]
    assert got == [p if p is None else markup.read_html(p) for p in pages]


def test_enrichment_outcome_and_its_sql_list_ten_windows(spark, tmp_path):
    import duckdb

    from loomcorpus.plans import ORACLES, QUERIES

    rows = [(1, (7 * i) % 13, 30.0, "R") for i in range(13)] + [(1, 2, 40.0, "A"), (2, 1, 9.0, "R"), (2, 1, 9.0, "R"), (3, 1, 9.0, "N")]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_quantity double, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW lineitem AS FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    want = sorted(db.execute(ORACLES["a16_enrichment_outcome"]).fetchall())
    assert sorted(map(tuple, QUERIES["a16_enrichment_outcome"](spark, str(tmp_path)).collect())) == want
    assert want[0][-1] == "13 of 14 windows failed: 0, 1, 2, 3, 4, 5, 6, 7, 8, 9"


def test_archive_actions_measure_stubs_by_the_text_that_the_sql_has(spark, tmp_path):
    """A reference without a semicolon is one character of the 200."""
    import duckdb

    from loomcorpus.plans import ORACLES, QUERIES

    spark.createDataFrame([(1, f"<p>{'x' * 195}&ampTo</p>"), (2, f"<p>{'x' * 197}&ampTo</p>")], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([(1, "text")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    db = duckdb.connect()
    for name in ("pages", "documents"):
        db.execute(f"CREATE VIEW {name} AS FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = sorted(db.execute(ORACLES["s17_archive_actions"]).fetchall())
    assert want == [("article", 1), ("stub", 1)]
    assert sorted(map(tuple, QUERIES["s17_archive_actions"](spark, str(tmp_path)).collect())) == want
