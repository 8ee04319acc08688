"""Text functions as column expressions: titles, names, years, URLs, chunks, markup, addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that stay lower-case in folder names.
SMALL_WORDS = ["and", "of", "the", "to", "for", "in", "on", "at"]
#: Name suffixes that are no last name.
NAME_SUFFIXES = ["jr", "jr.", "sr", "sr.", "ii", "iii", "iv", "phd", "md", "do"]
#: What names no person, whatever the case.
NO_PERSON = [
    r"^\(YT\)", "^Wikipedia", "^null$", "^unknown$", "^N/A$", "^Various", "^Staff", "^Anonymous",
    r"Department\b", r"Committee\b", r"Organization\b", r"Institute\b", r"Association\b", r"Foundation\b", r"University\b", r"Government\b",
    r"Bureau\b", r"Agency\b", r"Office\b", r"Division\b", r"Center\b", r"Centre\b", r"Ministry\b", r"Commission\b", r"Council\b", r"Board\b",
    r"Corps\b", r"Army\b", r"Navy\b", r"Air Force\b", r"Marine\b", r"U\.?S\.?\b", r"United States\b",
]
#: Marks of download sites in titles.
TITLE_TAGS = [r"(?i)[\s_]*\(?\s*PDFDrive\s*\)?\s*_?", r"(?i)[\s_]*\(?\s*z-lib\.org\s*\)?\s*_?"]
#: Titles, and parts of titles, that name no work.
GARBAGE_TITLES = [
    "download", "cmspage", "plant uses", "natural resources conservation service", "national center for home food preservation",
    "home", "index", "about", "contact", "menu", "page", "search", "untitled",
]
GARBAGE_PARTS = [".html", ".php", ".asp", "://", "\\\\"]


def words(text: Column) -> Column:
    """Whitespace-separated words, none empty."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


#: All ASCII white space, as ``\\s`` matches it.
WHITE = " \t\n\x0b\f\r"


def strip(x: Column) -> Column:
    """``x`` without white space of any kind at both ends."""
    return F.btrim(x, F.lit(WHITE))


def blank_to_null(x: Column) -> Column:
    return F.nullif(strip(x), F.lit(""))


def title_from_filename(name: Column) -> Column:
    """A readable title: no extension and site marks, manual numbers as ``FM 1-2``, ``U.S.``, underscores and
    hyphens between words as blanks, ``[yyyy]`` moved to the end in parentheses, lower-case words
    capitalised; titles shorter than 3 characters give the stem."""
    stem = F.regexp_replace(name, r"(?s)^(\.*[^.].*)\.[^.]*$", "$1")
    body = stem
    for tag in TITLE_TAGS:
        body = F.regexp_replace(body, tag, "")
    body = F.regexp_replace(body, r"\b(FM|ATP|TC|TM|AR|STP|GTA|ATTP|FMFRP|ADP|ADRP)[-_](\d+)[-_](\d+)", "$1 $2-$3")
    body = F.regexp_replace(body, r"(?<![A-Za-z])U[_\s]S(?=[_\s]|$)", "U.S.")
    body = F.replace(F.regexp_replace(body, r"(?<!\d)[-_](?!\d)", " "), F.lit("_"), F.lit(" "))
    year = F.regexp_extract(body, r"\[(\d{4})\]", 1)
    body = strip(F.regexp_replace(F.regexp_replace(body, r"\[\d{4}\]", " "), r"\s+", " "))
    cased = F.transform(F.split(body, " "), lambda w: F.when(w == F.lower(w), F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))).otherwise(w))
    text = F.array_join(cased, " ")
    text = strip(F.when(year != "", F.concat(text, F.lit(" ("), year, F.lit(")"))).otherwise(text))
    return F.when(F.length(text) < 3, stem).otherwise(text)


def folder_name(name: Column) -> Column:
    """``A & B of`` to ``A-and-B-of``; blank gives ``Uncategorized``."""
    tokens = words(F.replace(name, F.lit("&"), F.lit("and")))

    def cased(w: Column) -> Column:
        small = F.lower(w).isin(SMALL_WORDS)
        return F.when(small, F.lower(w)).otherwise(F.concat(F.upper(F.left(w, F.lit(1))), F.lower(F.substr(w, F.lit(2)))))

    joined = F.array_join(F.transform(tokens, cased), "-")
    return F.when(blank_to_null(name).isNull(), "Uncategorized").otherwise(joined)


def author_last_name(author: Column) -> Column:
    """``Last, First`` gives ``Last``; else the last of two or more names, before a suffix such as Jr,
    that starts upper-case and has 2 characters. Bodies and placeholders give null."""
    who = strip(author)
    comma = strip(F.split(who, ",")[0])
    tokens = words(who)
    suffixed = F.lower(F.try_element_at(tokens, F.lit(-1))).isin(NAME_SUFFIXES)
    last = F.when(F.size(tokens) < 2, F.lit(None)).when(~suffixed, F.try_element_at(tokens, F.lit(-1))).when(F.size(tokens) > 2, F.try_element_at(tokens, F.lit(-2)))
    last = F.when((F.length(last) > 1) & last.rlike(r"^\p{Lu}"), last)
    found = F.when(F.contains(who, F.lit(",")) & (F.length(comma) > 1), comma).otherwise(last)
    return F.when(~who.rlike(f"(?i){'|'.join(NO_PERSON)}"), found)


def last_year(*texts: Column) -> Column:
    """The last year 1800 to 2099 that stands as a word in the texts."""
    return F.try_element_at(F.regexp_extract_all(F.concat_ws(" ", *texts), F.lit(r"\b(1[89]\d{2}|20\d{2})\b"), F.lit(1)), F.lit(-1))


def source_and_category(relative: Column) -> tuple[Column, Column]:
    """First folder; second one only if there is another level, else the first again."""
    parts = F.split(relative, "/")
    source = F.element_at(parts, 1)
    return source, F.when(F.size(parts) > 2, F.try_element_at(parts, F.lit(2))).otherwise(source)


def download_url(path: Column, base: str) -> Column:
    """Blank gives '', http(s) stays, else base plus percent-encoded path parts."""
    parts = F.transform(F.split(F.regexp_replace(path, "^/+", ""), "/"), lambda p: F.replace(F.url_encode(p), F.lit("+"), F.lit("%20")))
    return F.when(blank_to_null(path).isNull(), "").when(path.rlike("^https?://"), path).otherwise(F.concat(F.lit(base), F.array_join(parts, "/")))


_SCHEME = r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://"


def unquoted(path: Column) -> Column:
    """Percent escapes resolved; a plus stays one, and a path with broken escapes stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)


def title_case(text: Column) -> Column:
    """Every run of letters with an upper-case first letter, the rest lower-case."""
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1)), F.initcap), "")


def title_from_url(url: Column) -> Column:
    """Last path segment, unquoted, separators as blanks and without extension, in title case; else the host."""
    path = F.when(url.rlike(_SCHEME), F.regexp_extract(url, _SCHEME + r"[^/?#]*([^?#]*)", 1)).otherwise(F.regexp_extract(url, r"(?s)^([^?#]*)", 1))
    segment = F.regexp_extract(F.btrim(unquoted(F.regexp_replace(path, r";[^/]*$", "")), F.lit("/")), r"(?s)([^/]*)$", 1)
    text = title_case(F.regexp_replace(F.regexp_replace(segment, "[-_]", " "), r"\.\w+$", ""))
    return F.when(text == "", host(url)).otherwise(text)


def host(url: Column) -> Column:
    return F.regexp_extract(url, _SCHEME + "([^/?#]*)", 1)


def url_filename(url: Column) -> Column:
    """``host_path`` with unsafe characters as ``_``, at most 200 characters and ``.html``."""
    path = F.regexp_extract(url, _SCHEME + "[^/?#]*([^?#]*)", 1)
    raw = F.concat(host(url), F.regexp_replace(path, "/", "_"))
    return F.concat(F.left(F.regexp_replace(raw, r"[^A-Za-z0-9_.-]", "_"), F.lit(200)), F.lit(".html"))


def slug(text: Column, limit: int = 50) -> Column:
    return F.left(F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", ""), F.lit(limit))


def quality_ok(text: Column, least: int = 50) -> Column:
    """At least ``least`` characters, 60 % of tokens with two ASCII letters, few camel-case joins."""
    body = strip(text)
    tokens = F.regexp_count(body, F.lit(r"\S+"))
    wordy = F.regexp_count(body, F.lit(r"[^\sA-Za-z]*[A-Za-z][^\sA-Za-z]*[A-Za-z]\S*"))
    joins = F.regexp_count(body, F.lit("[a-z][A-Z]"))
    return (F.length(body) >= least) & (tokens > 0) & (10 * wordy >= 6 * tokens) & (10 * joins <= tokens)


def embeddable(content: Column, least: int = 10, limit: int = 8192) -> Column:
    """The trimmed text cut at ``limit``, null if shorter than ``least``."""
    body = strip(content.cast("string"))
    return F.when(F.length(body) >= least, F.left(body, F.lit(limit)))


def html_title(html: Column) -> Column:
    return F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def escape_html(text: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def garbage_title(title: Column, exact: list[str] = GARBAGE_TITLES, parts: list[str] = GARBAGE_PARTS) -> Column:
    """Null, under 4 characters, one of the ``exact`` titles in any case, or with one of the ``parts`` as written."""
    bare = strip(title)
    part = F.lit(False)
    for p in parts:
        part = part | F.contains(bare, F.lit(p))
    return title.isNull() | (F.length(bare) < 4) | F.lower(bare).isin(exact) | part


def matches_any(text: Column, patterns: list[str]) -> Column:
    """Any of the substrings, whatever the case."""
    return F.exists(F.array(*[F.lit(p.lower()) for p in patterns]), lambda p: F.contains(F.lower(text), p))


# Parts of addresses that a crawl passes over, whatever a site's own lists say.
NOT_CRAWLED = [
    "/search", "/404", "/login", "/signup", "/auth/", "/api/", "/assets/", "/static/", "/cart", "/checkout", "/account", "/register", "/subscribe",
    "/membership", "/shop", "/store", "/product", "/wp-admin", "/feed", "/wp-json", "/xmlrpc", "/.well-known", "/cdn-cgi",
]


def crawlable(url: Column, include: list[str] = [], exclude: list[str] = [], always: list[str] = NOT_CRAWLED) -> Column:  # noqa: B006
    """Whether a crawl takes an address: it holds one of ``include``, if there are any, and none of ``exclude`` and ``always``, whatever the case."""
    wanted = matches_any(url, include) if include else F.lit(True)
    out = [*exclude, *always]
    return F.coalesce(wanted & (~matches_any(url, out) if out else F.lit(True)), F.lit(False))


def trip(length: Column, seconds: Column) -> Column:
    """``struct(miles, minutes)``, both to one decimal, halves to the even digit."""
    return F.struct(F.bround(length, 1).alias("miles"), F.bround(seconds / 60, 1).alias("minutes"))


def masked(key: Column) -> Column:
    """First and last 4 characters of long keys, 2 of medium ones, nothing of short ones."""
    return (
        F.when(F.length(key) >= 12, F.concat(F.left(key, F.lit(4)), F.lit("..."), F.right(key, F.lit(4))))
        .when(F.length(key) >= 6, F.concat(F.left(key, F.lit(2)), F.lit("..."), F.right(key, F.lit(2))))
        .otherwise("***")
    )


def cue_seconds(stamp: Column) -> Column:
    """``HH:MM:SS.mmm`` or ``MM:SS.mmm`` as seconds."""
    parts = F.split(stamp, ":")
    return F.aggregate(F.transform(parts, lambda p: p.cast("double")), F.lit(0.0).cast("double"), lambda acc, x: acc * 60 + x)


def counter_map(counter: Column) -> Column:
    """``mime=n;mime=n`` as a map; entries whose number is bad are dropped."""
    pairs = F.transform_values(F.str_to_map(counter, F.lit(";"), F.lit("=")), lambda k, v: v.try_cast("long"))
    return F.map_filter(pairs, lambda k, v: v.isNotNull())


def parse_address(text: Column, states: list[str]) -> Column:
    """``num street, city, ST zip`` as a struct: trailing zip, trailing state, leading number, last token city."""
    tokens = words(F.regexp_replace(F.upper(text), ",", " "))
    n = F.size(tokens)
    zip_ = F.when(F.try_element_at(tokens, F.lit(-1)).rlike(r"^\d{5}$") & (n > 1), F.try_element_at(tokens, F.lit(-1)))
    rest = F.when(zip_.isNotNull(), F.slice(tokens, 1, n - 1)).otherwise(tokens)
    state = F.when((F.size(rest) >= 2) & F.try_element_at(rest, F.lit(-1)).isin(states), F.try_element_at(rest, F.lit(-1)))
    rest2 = F.when(state.isNotNull(), F.slice(rest, 1, F.size(rest) - 1)).otherwise(rest)
    number = F.when(F.try_element_at(rest2, F.lit(1)).rlike(r"^\d+$"), F.try_element_at(rest2, F.lit(1)))
    rest3 = F.when(number.isNotNull() & (F.size(rest2) > 1), F.slice(rest2, 2, F.size(rest2))).when(number.isNotNull(), F.array().cast("array<string>")).otherwise(rest2)
    city = F.when(state.isNotNull() & (F.size(rest3) >= 2), F.try_element_at(rest3, F.lit(-1)))
    street = F.when(city.isNotNull(), F.slice(rest3, 1, F.size(rest3) - 1)).otherwise(rest3)
    return F.struct(number.alias("number"), F.array_join(street, " ").alias("street"), city.alias("city"), state.alias("state"), zip_.alias("zipcode"))


def chunk_pages(text: Column, budget: int) -> Column:
    """Pages of about ``budget`` words: whole pieces, joined by blank lines.

    Paragraphs are packed greedily; one of over 1.5 budgets closes the page and is packed by sentences;
    a piece that would overflow starts a new page only if the page isn't empty. After a long
    paragraph the next piece joins the page that its last sentences left open. A text without
    any piece is one page as it is.
    """
    counted = lambda x, flush: F.struct(x.alias("text"), F.regexp_count(x, F.lit(r"\S+")).alias("n"), flush.alias("flush"))
    # Bound to lambda variables, the pieces are cut and their words counted once.
    bound = lambda x, f: F.get(F.transform(F.array(x), f), F.lit(0))
    paragraphs = F.filter(F.transform(F.split(text, "\n\n"), lambda p: counted(strip(p), F.lit(False))), lambda p: p["text"] != "")

    def cut(p: Column) -> Column:
        sentences = F.transform(F.split(p["text"], r"(?<=[.!?])\s+"), lambda s, i: counted(s, i == 0))
        return F.when(p["n"] * 2 > 3 * budget, sentences).otherwise(F.array(p))

    def pages(pieces: Column) -> Column:
        # The fold runs over numbers only; it keeps the place of the first piece of each page.
        state = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).alias("n"), F.lit(0).alias("at"))

        def step(acc: Column, x: Column) -> Column:
            new = (acc["at"] == 0) | x["flush"] | (acc["n"] + x["n"] > budget)
            starts = F.when(new, F.array_append(acc["starts"], acc["at"])).otherwise(acc["starts"])
            return F.struct(starts.alias("starts"), F.when(new, x["n"]).otherwise(acc["n"] + x["n"]).alias("n"), (acc["at"] + 1).alias("at"))

        def joined(starts: Column) -> Column:
            end = lambda i: F.coalesce(F.get(starts, i + 1), F.size(pieces))
            return F.transform(starts, lambda s, i: F.array_join(F.transform(F.slice(pieces, s + 1, end(i) - s), lambda x: x["text"]), "\n\n"))

        numbers = F.transform(pieces, lambda x: F.struct(x["n"].alias("n"), x["flush"].alias("flush")))
        return bound(F.aggregate(numbers, state, step, lambda acc: acc["starts"]), joined)

    made = bound(F.flatten(F.transform(paragraphs, cut)), pages)
    return bound(made, lambda m: F.when(F.size(m) == 0, F.array(text)).otherwise(m))


def coordinates(text: Column) -> Column:
    """``struct(latitude, longitude)`` of a text that is two numbers and a comma, else null."""
    pattern = r"^\s*(-?\d+\.?\d*)\s*,\s*(-?\d+\.?\d*)\s*$"
    part = lambda i: F.regexp_extract(text, pattern, i).try_cast("double")
    return F.when(text.rlike(pattern), F.struct(part(1).alias("latitude"), part(2).alias("longitude")))


def place_label(*parts: Column) -> Column:
    """Name, city, state and country, without blanks and without a part that repeats the one before."""
    kept = F.filter(F.array(*parts), lambda x: F.coalesce(x, F.lit("")) != "")
    return F.array_join(F.filter(kept, lambda x, i: (i == 0) | (x != F.get(kept, i - 1))), ", ")


def shown_url(url: Column, limit: int = 40) -> Column:
    return F.when(F.length(url) > limit, F.concat(F.left(url, F.lit(limit)), F.lit("…"))).otherwise(url)


def plain_identifier(text: Column) -> Column:
    """Whether a text is safe as a name: ASCII letters and underscores, or a slug of lower-case letters, digits and hyphens."""
    return text.rlike(r"^[A-Za-z_]+\z") | text.rlike(r"^[a-z0-9-]+\z")


def readable_size(size: Column) -> Column:
    """Bytes as ``1.5 MB``, one decimal from KB on."""
    power = F.when(size < 1, 0).otherwise(F.least(F.floor(F.log(1024.0, F.greatest(size, F.lit(1)).cast("double")) + 1e-12), F.lit(4)))
    unit = F.element_at(F.array(*[F.lit(u) for u in ("B", "KB", "MB", "GB", "TB")]), (power + 1).cast("int"))
    return F.when(power == 0, F.concat(size.cast("string"), F.lit(" B"))).otherwise(F.concat(F.format_string("%.1f", size / F.pow(F.lit(1024.0), power)), F.lit(" "), unit))


def age_hours(at: Column, as_of: Column, limit: float) -> Column:
    """``struct(hours, stale)``: a time that can't be read is stale."""
    hours = (as_of.cast("timestamp").cast("double") - F.try_to_timestamp(at.cast("string")).cast("double")) / 3600
    return F.struct(hours.alias("hours"), F.coalesce(hours > limit, F.lit(True)).alias("stale"))
