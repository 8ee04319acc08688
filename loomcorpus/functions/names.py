"""File names: portable names, display names, and the metadata that names and PDF fields carry."""

from __future__ import annotations

import functools
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from loomcorpus.functions.text import strip, title_from_filename

# The marks of download sites, identifiers and manual series in file names.
SITE_TAGS = [r"(?i)\s*\(\s*PDFDrive\s*\)\s*", r"(?i)\s*_PDFDrive_\s*", r"(?i)\s*\(\s*z-lib\.org\s*\)\s*", r"(?i)\s*_z-lib\.org_\s*", r"\s*\{[A-Za-z0-9]+\}\s*"]
SITE_SEGMENT = r"97[89]\d{10}|[0-9a-f]{32}|(?:19|20)\d{2}|[Aa]nna"
IDENTIFIERS = [
    r"\s*97[89][\s-]?\d[\s-]?\d{2}[\s-]?\d{5,6}[\s-]?\d\s*",
    r"\s*\d[\s-]\d{2}[\s-]\d{5,6}[\s-][\dXx]\s*",
    r"\s*\b[0-9a-f]{32}\b\s*",
]
MANUALS = r"\b(FM|ATP|TC|TM|AR|STP|GTA|ATTP|FMFRP|ADP|ADRP)[-_](\d+)[-_](\d+)"
# Characters that are repaired where their UTF-8 bytes were read as Latin-1.
MISREAD = {
    "’": "'", "‘": "'", "“": '"', "”": '"', "–": "-", "—": "-", "…": "...",
    "é": "e", "è": "e", "ö": "o", "ü": "u", "ä": "a", "ñ": "n", "í": "i", "á": "a", "ú": "u", "ó": "o",
    "®": "", "©": "", "«": '"', "»": '"',
}
# Punctuation that has a plain form.
PLAIN = {"‘": "'", "’": "'", "‚": "'", "“": '"', "”": '"', "„": '"', "–": "-", "—": "-", "‒": "-", "«": '"', "»": '"'}

# Characters that no file name holds, and what marks a name made from a URL, the tail of a hash, an edition,
# a year between marks, the year of a PDF date, and an author in a name.
ILLEGAL = [r'[<>:"|?*\\/]', r"[\x00-\x1f\x7f]"]
FROM_URL = r"^[a-z0-9-]+\.[a-z]{2,}[_/]"
HASH_TAIL = "_[0-9a-f]{8}$"
EDITION = r"(?i)(\d+)(?:st|nd|rd|th)?\s*(?:edition|ed\.?)"
MARKED_YEAR = r"[\(\[_\s]((?:19|20)\d{2})[\)\]_\s.]"
DATE_YEAR = r"(?:D:)?(\d{4})"
BY_AUTHOR = r"\bby\s+([A-Z][a-z]+(?:\s+[A-Z][a-z]+)*)"

LIMIT = 120

_BROKEN = {good.encode().decode("latin-1"): plain for good, plain in MISREAD.items()}
_BROKEN_PATTERN = re.compile("|".join(map(re.escape, sorted(_BROKEN, key=len, reverse=True))))


@functools.lru_cache(maxsize=4096)
def _plain_character(ch: str) -> str:
    """What a decomposed character becomes: ASCII and Latin letters and digits stay, marks, controls
    and other scripts go, other symbols and spaces are blanks."""
    kind = unicodedata.category(ch)
    if kind[0] == "M" or (kind[0] == "C" and ch != "\t"):
        return ""
    if ord(ch) < 0x80:
        return ch
    if kind[0] in "LN":
        return ch if ord(ch) < 0x250 else ""
    return PLAIN.get(ch, " ")


def plain_characters(text: str) -> str:
    """``text`` with misread bytes repaired, accents dropped, and characters that few file systems share replaced."""
    text = _BROKEN_PATTERN.sub(lambda m: _BROKEN[m[0]], text)
    text = text.replace("â\u0080", "-").replace("H_", "H. ")
    return "".join(map(_plain_character, unicodedata.normalize("NFKD", text)))


@pandas_udf(StringType())
def plain_name(names: pd.Series) -> pd.Series:
    return names.map(plain_characters, na_action="ignore")


def stem(name: Column) -> Column:
    """``name`` without its last extension; dots at the start are no extension."""
    return F.regexp_replace(name, r"(?s)^(\.*[^.].*)\.[^.]*$", "$1")


def extension(name: Column) -> Column:
    return F.substr(name, F.length(stem(name)) + 1)


def _replaced(text: Column, patterns: list[str], by: str = " ") -> Column:
    for pattern in patterns:
        text = F.regexp_replace(text, pattern, by)
    return text


def _cut(text: Column, room: Column) -> Column:
    """At most ``room`` characters, ended at the last blank if that is beyond 60 % of them."""
    head = F.left(text, room)
    blank = room - F.instr(F.reverse(head), " ")  # places before the last blank
    ended = F.left(text, F.when((blank < room) & (blank > 0.6 * room), blank).otherwise(room))
    return F.when(F.length(text) > room, F.rtrim(ended, F.lit(". -,"))).otherwise(text)


def sanitized(name: Column, doc_hash: Column | None = None) -> Column:
    """A portable form of a file name; the extension is lower-cased, and ``.pdf`` where there is none.

    Site marks and identifiers go (a trailing ``_`` and 8 hex digits only if they begin the given
    hash), characters are made plain, word separators become blanks except in names made from
    URLs, and stems are cut to fit ``LIMIT``. Null gives null; a stem of under 2 characters is ``untitled``.
    """
    known = F.nullif(doc_hash if doc_hash is not None else F.lit(None).cast("string"), F.lit(""))

    # (Neither lambdas nor bound values can be the input of a Python function; steps name the one before rarely.)
    body = stem(name)
    sited = body.rlike("(?s) -- .* -- ") | body.rlike(f"(?s) -- .*(?:{SITE_SEGMENT})")
    body = _replaced(F.when(sited, F.substring_index(body, " -- ", 1)).otherwise(body), SITE_TAGS + IDENTIFIERS)
    own = known.isNull() | F.startswith(known, F.right(body, F.lit(8)))
    plain = plain_name(F.when(own, F.regexp_replace(body, HASH_TAIL, "")).otherwise(body))
    manual = F.regexp_replace(plain, MANUALS, "$1 $2-$3")
    dotted = F.length(plain) - F.length(F.replace(plain, F.lit("."), F.lit(""))) >= 4
    body = F.when(plain.rlike(FROM_URL), plain).when(dotted, F.regexp_replace(manual, r"\.(?=[A-Za-z])", " ")).otherwise(manual)
    body = _replaced(F.replace(body, F.lit("_"), F.lit(" ")), ILLEGAL, "")
    body = F.regexp_replace(F.regexp_replace(body, " {2,}", " "), "-{2,}", "-")
    body = F.regexp_replace(strip(F.btrim(body, F.lit(". -"))), "(?s)^.?$", "untitled")
    ending = F.regexp_replace(F.lower(extension(name)), "(?s)^$", ".pdf")
    # Bound to a lambda variable, the name is made once, however often the cut looks at it.
    made = F.array(F.struct(body.alias("body"), ending.alias("ending")))
    return F.get(F.transform(made, lambda x: F.concat(_cut(x["body"], F.lit(LIMIT) - F.length(x["ending"])), x["ending"])), F.lit(0))


def needs_sanitizing(name: Column, doc_hash: Column | None = None) -> Column:
    return sanitized(name, doc_hash) != name


def library_name(name: Column, doc_hash: Column | None = None) -> Column:
    """``sanitized`` with underscores for blanks; titles without ``.pdf`` get it. Blank names give null."""
    full = F.when(F.endswith(F.lower(name), F.lit(".pdf")), name).otherwise(F.concat(name, F.lit(".pdf")))
    body = F.regexp_replace(sanitized(full, doc_hash), r"\.pdf$", "")
    body = F.btrim(F.regexp_replace(F.replace(body, F.lit(" "), F.lit("_")), "_{2,}", "_"), F.lit("_"))
    named = F.get(F.transform(F.array(body), lambda b: F.when(b != "", F.concat(b, F.lit(".pdf")))), F.lit(0))
    return F.when(strip(name) != "", named)


def video_name(title: Column, uuid: Column) -> Column:
    """A video's title without characters other than word characters, blanks, dots and hyphens, at most 200; else its id."""
    return F.coalesce(F.nullif(F.left(strip(F.regexp_replace(title, r"(?U)[^\w\s.-]", "")), F.lit(200)), F.lit("")), uuid)


def archive_name(filename: Column) -> Column:
    """An archive's name without its flavour, date and extension."""
    return F.regexp_replace(F.regexp_replace(filename, r"_(maxi|mini|nopic)_[0-9-]+\.zim$", ""), r"\.zim$", "")


def host_folder(host: Column) -> Column:
    """A host without ``www.``, with other than ASCII letters, digits and ``._-`` as underscores."""
    return F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r"[^a-zA-Z0-9._-]", "_")


def acquired_name(title: Column, author: Column) -> Column:
    """Name of an acquired file: letters, digits and `` ._-`` of the title, at most 60, and the author's last token."""
    safe = strip(F.left(F.regexp_replace(title, r"(?U)[^\p{Alnum} ._-]", ""), F.lit(60)))
    last = F.try_element_at(F.split(strip(author), r"\s+"), F.lit(-1))
    return F.concat_ws("_", safe, F.nullif(last, F.lit("")))


def _edition(text: Column) -> Column:
    return F.nullif(strip(F.regexp_extract(text, EDITION, 0)), F.lit(""))


def name_metadata(filename: Column) -> Column:
    """``struct(title, author, edition, year)`` that a file name states, null where it doesn't.

    The title is the readable form of the name. A year stands between brackets, underscores, blanks or
    a dot; an edition is kept as it is written (``2nd Edition``, ``3 ed``); an author follows ``by`` as one or more names.
    """
    body = stem(filename)
    blank = lambda c: F.nullif(c, F.lit(""))
    return F.struct(
        title_from_filename(filename).alias("title"), blank(F.regexp_extract(body, BY_AUTHOR, 1)).alias("author"), _edition(body).alias("edition"),
        blank(F.regexp_extract(body, MARKED_YEAR, 1)).try_cast("int").alias("year"),
    )


def field_metadata(title: Column, author: Column, subject: Column, created: Column, modified: Column) -> Column:
    """``struct(title, author, edition, year)`` of a PDF's own fields: titles of over 2 and authors of
    over 1 characters, the year 1800 to 2030 of the creation date, else of the modification date (the first
    four digits of either), and the edition of the subject, else of the title, as it is written."""

    def year(date: Column) -> Column:
        found = F.regexp_extract(date, DATE_YEAR, 1).try_cast("int")
        return F.when(found.between(1800, 2030), found)

    def longer(c: Column, least: int) -> Column:
        return F.when(F.length(strip(c)) > least, strip(c))

    edition = F.coalesce(_edition(subject), _edition(title))
    return F.struct(longer(title, 2).alias("title"), longer(author, 1).alias("author"), edition.alias("edition"), F.coalesce(year(created), year(modified)).alias("year"))


def partial_extraction(first_page: Column, filename: Column, pages: Column, extracted: Column, found_title: Column | None = None) -> Column:
    """``struct(title, partial, status, message)`` of a document of which only some pages were read: extracted all the same,
    under the title that was found on a first page of over 20 characters, else under that of its name."""
    named = title_from_filename(filename)
    found = found_title if found_title is not None else F.lit(None).cast("string")
    read = F.length(strip(F.coalesce(first_page, F.lit("")))) > 20
    partial = F.coalesce(extracted < pages, F.lit(False))
    message = F.when(partial, F.concat(F.lit("Partial: "), extracted.cast("string"), F.lit("/"), pages.cast("string"), F.lit(" pages")))
    return F.struct(F.when(read, F.coalesce(F.nullif(found, F.lit("")), named)).otherwise(named).alias("title"), partial.alias("partial"), F.lit("extracted").alias("status"), message.alias("message"))


def first_page_title(first_page: Column, filename: Column) -> Column:
    """The first line of over 20 characters on the first page, else the name's stem."""
    lines = F.filter(F.transform(F.split(first_page, "\n"), strip), lambda x: F.length(x) > 20)
    return F.coalesce(F.try_element_at(lines, F.lit(1)), F.replace(stem(filename), F.lit("_"), F.lit(" ")))
