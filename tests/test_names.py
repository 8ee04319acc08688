"""File names: portable forms, titles, authors and the metadata they carry."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loomcorpus.functions import names, text


def ask(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(column).collect()]


SANITIZED = [
    ("Title -- Some Author -- 2nd -- 9781234567897 -- 0123 -- Anna’s Archive.pdf", None, "Title.pdf"),
    ("Book -- Press 1999.pdf", None, "Book.pdf"),
    ("Book -- Part Two.pdf", None, "Book - Part Two.pdf"),
    ("X 978-1-23-456789-7 y.PDF", None, "X y.pdf"),
    ("a 0123456789abcdef0123456789abcdef b.txt", None, "a b.txt"),
    ("abc_deadbeef.pdf", None, "abc.pdf"),
    ("abc_deadbeef.pdf", "deadbeef00", "abc.pdf"),
    ("abc_deadbeef.pdf", "00", "abc deadbeef.pdf"),
    ("“Café” – l’été….pdf", None, "Cafe – l’ete".replace("–", "-").replace("’", "'") + ".pdf"),
    ("CafÃ© â\u0080\u0094 x.pdf", None, "Cafe - x.pdf"),
    ("漢字.pdf", None, "untitled.pdf"),
    ("a.b.c.d.e.f", None, "a b c d e.f"),
    ("U.S. Army.pdf", None, "U.S. Army.pdf"),
    ("example.com_some_page.html", None, "example.com some page.html"),
    ("name", None, "name.pdf"),
    (".hidden", None, "hidden.pdf"),
    ("FM_23_10_x.pdf", None, "FM 23-10 x.pdf"),
    ("J H_ Doe (PDFDrive) {abc1}.pdf", None, "J H. Doe.pdf"),
    ('a<b>:"c|?*\\/d\x07.pdf', None, "abcd.pdf"),
    ("word " * 40 + ".pdf", None, ("word " * 23)[:-1] + ".pdf"),
    ("w" * 200 + ".pdf", None, "w" * 116 + ".pdf"),
    ("", None, "untitled.pdf"),
    (None, None, None),
]


def test_sanitized(spark):
    got = ask(spark, [(n, h) for n, h, _ in SANITIZED], "n string, h string", names.sanitized(F.col("n"), F.col("h")))
    for (n, _, want), x in zip(SANITIZED, got, strict=True):
        assert x == want, n
    changed = ask(spark, [("a b.pdf",), ("a_b.pdf",)], "n string", names.needs_sanitizing(F.col("n")))
    assert changed == [False, True]


def test_library_names(spark):
    rows = [("Field Guide",), ("Field  Guide.pdf",), ("  ",), (None,), ("_",), ("A_-_B.PDF",)]
    assert ask(spark, rows, "n string", names.library_name(F.col("n"))) == ["Field_Guide.pdf", "Field_Guide.pdf", None, None, "untitled.pdf", "A_-_B.pdf"]


def test_titles(spark):
    rows = ["survival_guide-book.pdf", "FM_1_2_x.pdf", "the_U_S_army.pdf", "old_maps [1990].pdf", "NASA_report 3rd.pdf", "a.pdf", "x_PDFDrive_.pdf", "tables_12-13.pdf", "first aid (z-lib.org).epub"]
    got = ask(spark, [(r,) for r in rows], "n string", text.title_from_filename(F.col("n")))
    assert got == ["Survival Guide Book", "FM 1-2 X", "The U.S. Army", "Old Maps (1990)", "NASA Report 3rd", "a", "x_PDFDrive_", "Tables 12-13", "First Aid"]


@pytest.mark.parametrize(("author", "last"), [
    ("John Smith", "Smith"), ("Smith, John", "Smith"), ("smith, john", "smith"), ("First M. Last", "Last"), ("Xa Yb Jr.", "Yb"), ("X Y Jr.", None), ("Y Jr", None), ("Plato", None),
    ("john smith", None), ("Dept of the Army", None), ("Some University", None), ("U.S. Navy", None), ("", None), (None, None), ("  Ann  Öberg ", "Öberg"), ("A B", None),
])
def test_author_last_names(spark, author, last):
    assert ask(spark, [(author,)], "a string", text.author_last_name(F.col("a"))) == [last]


def test_garbage_titles(spark):
    rows = [None, "abc", "  Home \n", "a page of .html", "A page of .HTML", "Chemical/Biological", "http://x", "INDEX", "Index of things", "a\\\\b x"]
    assert ask(spark, [(r,) for r in rows], "t string", text.garbage_title(F.col("t"))) == [True, True, True, True, False, False, True, True, False, True]


def test_metadata(spark):
    rows = [("Knots (1998) 2nd edition by Ann Lee.pdf",), ("Maps_by_Bo Rask.pdf",), ("plain.pdf",), ("Rope 3 ed [2001] by X.pdf",), ("Sails by Bo Rask Lind 4TH ED.pdf",), (None,)]
    got = ask(spark, rows, "n string", names.name_metadata(F.col("n")))
    assert [(r.title, r.author, r.edition, r.year) for r in got] == [
        ("Knots (1998) 2nd Edition By Ann Lee", "Ann Lee", "2nd edition", 1998), ("Maps By Bo Rask", None, None, None), ("Plain", None, None, None),
        ("Rope 3 Ed By X (2001)", None, "3 ed", 2001), ("Sails By Bo Rask Lind 4TH ED", "Bo Rask Lind", "4TH ED", None), (None, None, None, None),
    ]
    rows = [(" A title ", "x", "3rd ed.", "D:1650", "D:2001-01"), ("ab", "Al", None, "1999-05", None), ("Knots 2 Edition", None, "no", None, "x 20010101"), (None, None, None, None, None)]
    got = ask(spark, rows, "t string, a string, s string, c string, m string", names.field_metadata(*map(F.col, "tascm")))
    assert [tuple(r) for r in got] == [("A title", None, "3rd ed.", 2001), (None, "Al", None, 1999), ("Knots 2 Edition", None, "2 Edition", 2001), (None, None, None, None)]
    rows = [("a first page of some length here", "x_y.pdf", 9, 4), (None, "x_y.pdf", 9, 0), ("a first page of some length here", "x_y.pdf", 9, 9)]
    got = ask(spark, rows, "p string, n string, k int, e int", names.partial_extraction(F.col("p"), F.col("n"), F.col("k"), F.col("e"), F.lit("Found")))
    assert [tuple(r) for r in got] == [("Found", True, "extracted", "Partial: 4/9 pages"), ("X Y", True, "extracted", "Partial: 0/9 pages"), ("Found", False, "extracted", None)]
    rows = [("short\nA line that is long enough to be one", "x_y.pdf"), ("short", "x_y.pdf"), (None, "x_y.pdf")]
    assert ask(spark, rows, "p string, n string", names.first_page_title(F.col("p"), F.col("n"))) == ["A line that is long enough to be one", "x y", "x y"]


def test_short_names(spark):
    rows = [("A/B: c!", "u1"), ("!!", "u2"), (None, "u3")]
    assert ask(spark, rows, "t string, u string", names.video_name(F.col("t"), F.col("u"))) == ["AB c", "u2", "u3"]
    assert ask(spark, [("wiki_en_maxi_2024-01.zim",), ("x.zim",)], "n string", names.archive_name(F.col("n"))) == ["wiki_en", "x"]
    assert ask(spark, [("www.a-b.org:80",)], "n string", names.host_folder(F.col("n"))) == ["a-b.org_80"]
    assert ask(spark, [("Knots: a/b", "Ann Lee"), ("x", None)], "t string, a string", names.acquired_name(F.col("t"), F.col("a"))) == ["Knots ab_Lee", "x"]


def test_quality_and_chunks(spark):
    rows = [("\n" * 10 + "ab",), ("word " * 20,), ("1 2 3 " * 20,), ("aB " * 20,), ("ab 1 2 cd ef " * 12,), (None,)]
    assert ask(spark, rows, "t string", text.embeddable(F.col("t")).isNotNull())[:2] == [False, True]
    assert ask(spark, rows, "t string", text.quality_ok(F.col("t"))) == [False, True, False, False, True, None]
    long = " ".join(f"s{i} b c." for i in range(4))
    cases = {"": [""], "a b": ["a b"], "a b c\n\nd e f": ["a b c", "d e f"], "a b\n\n \n\nc": ["a b\n\nc"], f"x\n\n{long}\n\ny": ["x", "s0 b c.", "s1 b c.", "s2 b c.", "s3 b c.\n\ny"], "a b c d e f": ["a b c d e f"]}
    got = ask(spark, [(c,) for c in cases], "t string", text.chunk_pages(F.col("t"), 4))
    assert got == list(cases.values())
