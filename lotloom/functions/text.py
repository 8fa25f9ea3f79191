"""Lines and labels of filings, as column expressions."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotloom.functions.bind import let
from lotloom.functions.dates import NOTICE_FORMATS, by_formats

#: Breaks besides line feed at which a line ends for the general parser.
ALL_BREAKS = "[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"
#: What a pattern with (?U) takes for white space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space and breaks but blanks and line feeds.
ODD_WHITE = r"[\t\x0b\f\r\x1c-\x1e\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
TOLL_FREE = "1800 266 0058"
# Security types in the order of precedence, and the lines that end a table.
TYPES = (r"F\s*&\s*L", r"Fully\s+Paid", r"F\s*-?\s*Fully", r"Partly\s+Paid", r"Lock[- ]in", r"IPO", r"Anchor")
# What lower-case text holds where a type, in that order, or a footer may stand. Looking for words costs a tenth of a pattern.
TYPE_WORDS = ("&", "fully", "fully", "partly", "lock", "ipo", "anchor")
FOOTER_WORDS = ("name", "designation", "place", "limited", "company secretary", "membership no.", "note", "the distinctive numbers are for", "year", "sd/-")
FOOTER = (
    r"(?i)(^\s*Name\s*:|^\s*Designation\s*:|^\s*Place\s*:|\bFor\s+\w+.*Limited|Company Secretary|Membership No\.|^\s*Notes?:|The Distinctive Numbers are for the purpose"
    r"|DEMAT\s*-\s*\d+\s*YEAR|^\s*For\s+.*\s+Limited\s*$|^\s*Sd/-)"
)


def plain_breaks(text: Column) -> Column:
    """Carriage returns folded into line feeds."""
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(WHITE))


def squeeze(text: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def lines(text: Column, every_break: bool = False) -> Column:
    """The lines of a text, stripped."""
    parts = F.split(plain_breaks(text), ALL_BREAKS if every_break else "\n", -1)
    return F.transform(parts, strip)


def pattern_text(text: Column) -> Column:
    """Lower case without spaces and hyphens."""
    return F.translate(F.lower(text), " -", "")


def without_toll_free(text: Column) -> Column:
    return F.replace(text, F.lit(TOLL_FREE), F.lit(" "))


# What a scan's text holds besides content (page markers, rules, separators).
PAGE, RULES, SEPARATORS = r"(?i)-+\s*PAGE\s+\d+\s*-+", "#+", r"[=_\-*]{3,}"


def page_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(PAGE))


def content(text: Column) -> Column:
    """What is left without page markers, rules, separators and white space."""
    for pattern in (PAGE, RULES, SEPARATORS, r"\s+"):
        text = F.regexp_replace(text, pattern, "")
    return text


def is_blank(text: Column, least: int = 50) -> Column:
    """Whether a document holds next to nothing, as blank scans do."""
    return F.length(content(F.coalesce(text, F.lit("")))) < least


def blank_stats(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.struct(F.length(text).alias("total_chars"), page_count(text).alias("page_count"), F.length(content(text)).alias("content_chars"), is_blank(text).alias("is_blank"))


def blank_error(text: Column, what: str) -> Column:
    """What is said of a document that isn't parsed because it is blank; null for others."""
    stats = blank_stats(text)
    say = F.format_string(f"Blank {what} file detected (%d pages, %d chars of actual content)", stats["page_count"], stats["content_chars"])
    return F.when(stats["is_blank"], say)


def column_ranges(line: Column) -> Column:
    """Columns of a line as an array of (first, last) in characters, the last one exclusive: what gaps of two or more spaces part. Null with fewer than two columns."""
    parts, gaps = F.split(line, " {2,}", -1), F.regexp_extract_all(line, F.lit("( {2,})"), F.lit(1))

    def step(acc: Column, p: Column) -> Column:
        last = acc["at"] + F.length(p["part"])
        own = F.when(p["part"] != "", F.array(F.struct(acc["at"].alias("first"), last.alias("last")))).otherwise(F.array().cast("array<struct<first:int,last:int>>"))
        return F.struct((last + F.coalesce(F.length(p["gap"]), F.lit(0))).alias("at"), F.concat(acc["found"], own).alias("found"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<first:int,last:int>>").alias("found"))
    found = F.aggregate(F.arrays_zip(parts.alias("part"), gaps.alias("gap")), zero, step, lambda acc: acc["found"])
    return F.when(F.size(found) >= 2, found)


def may_have_footer(text: Column) -> Column:
    """Whether a text holds a footer's word, in any case; without one, ``FOOTER`` matches none of its lines."""
    return let(F.lower(text), lambda low: reduce(or_, (low.contains(w) for w in FOOTER_WORDS)))


def security_type(line: Column, between: bool = True) -> Column:
    """The first known type in a line; else, with ``between``, the text after the third number, at most 30 characters."""
    def one(low: Column, word: str, pattern: str) -> Column:
        found = F.nullif(F.regexp_extract(line, f"(?i)({pattern})", 1), F.lit(""))
        return F.when(low.contains(word), squeeze(found) if r"\s" in pattern else found)

    known = let(F.lower(line), lambda low: F.coalesce(*(one(low, w, p) for w, p in zip(TYPE_WORDS, TYPES))))
    if not between:
        return F.coalesce(known, F.lit(""))
    parts = F.filter(F.transform(F.slice(F.split(line, r"\d[\d,\s]*", -1), 4, 1000), squeeze), lambda p: F.length(p) > 2)
    return F.coalesce(known, F.substring(F.get(parts, F.lit(0)), 1, 30), F.lit(""))


def share_form(line: Column) -> Column:
    return F.regexp_extract(line, r"(?i)(Demat|Physical)", 1)


def page_list(spec: Column) -> Column:
    """``2-4,7`` as [2, 3, 4, 7]: sorted, distinct; parts that aren't pages are left out."""
    def one(part: Column) -> Column:
        a, b = F.regexp_extract(part, r"^\s*(\d+)\s*(?:-\s*(\d+)\s*)?$", 1).try_cast("int"), F.regexp_extract(part, r"^\s*(\d+)\s*-\s*(\d+)\s*$", 2).try_cast("int")
        last = F.coalesce(b, a)
        return F.when(a.isNull() | (last < a), F.array().cast("array<int>")).otherwise(F.sequence(a, last))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(F.split(spec, ","), one))))


# Words for a company's form, and which of them another one may follow.
FORMS = {"Limited": True, "Private": True, "Corporation": False, "LLP": False, "PLC": False, r"Ltd\.?": True, r"Pvt\.?": True, r"Inc\.?": False, r"Corp\.?": False}


def without_form(company: Column) -> Column:
    """A company's name without the form it ends in, and without a second one before that."""
    last, before = "|".join(FORMS), "|".join(f for f, more in FORMS.items() if more)
    return F.regexp_replace(company, rf"(?i)(?:\s+(?:{before}))?\s+(?:{last})\s*$", "")


def slugs(company: Column) -> Column:
    """Names under which a company's page may be kept: its words, & as ``and`` or left out, with hyphens or underscores; each once.

    Brackets don't end a word, all else but ASCII letters and digits does.
    """
    name = F.lower(F.translate(without_form(company), "()", ""))
    words = [F.regexp_extract_all(F.replace(name, F.lit("&"), F.lit(to)), F.lit("([a-z0-9]+)"), F.lit(1)) for to in ("and", "")]
    return F.array_distinct(F.array(*(F.concat(F.array_join(w, sep), F.lit(f"{sep}ipo")) for w in words for sep in "-_")))


def json_array(value: Column, kind: str, default: Column | None = None) -> Column:
    """The array that a JSON text holds; where it holds none, ``default`` or an empty one."""
    return F.coalesce(F.from_json(value, f"array<{kind}>"), default if default is not None else F.array().cast(f"array<{kind}>"))


def plain_path(path: Column, root: str = "") -> Column:
    """A path with forward slashes, single ones, and without the leading root."""
    out = F.regexp_replace(F.replace(path, F.lit("\\"), F.lit("/")), "/{2,}", "/")
    return F.when(out.startswith(root), F.substring(out, F.lit(len(root) + 1), F.length(out))).otherwise(out) if root else out


def symbol_token(text: Column) -> Column:
    """Capitals, digits and hyphens only."""
    return F.regexp_replace(F.upper(F.trim(text)), "[^A-Z0-9-]", "")


#: File names of lock-in documents: BSE by code and symbol, NSE by symbol and circular.
BSE_FILE, NSE_FILE = r"^(\d+)-(.+)-Annexure-I\.pdf$", r"^(.+)-CML(\d+)\.pdf$"


def file_identity(name: Column, exchange: Column) -> tuple[Column, Column]:
    """(code, symbol) from the name of a lock-in file; null where it doesn't fit."""
    part = lambda bse, nse: F.nullif(F.when(exchange == "BSE", F.regexp_extract(name, BSE_FILE, bse)).otherwise(F.regexp_extract(name, NSE_FILE, nse)), F.lit(""))
    return part(1, 2), part(2, 1)


def shown_identity(name: Column, key: Column, known_symbol: Column) -> tuple[Column, Column]:
    """(code, symbol) to show: from the file name, else from the record's key.

    A file name counts only if its symbol has nothing but letters and hyphens (BSE: capitals) or also digits (NSE: in any case).
    """
    bse, nse = name.rlike(BSE_FILE) & F.regexp_extract(name, BSE_FILE, 2).rlike("^[A-Z-]+$"), F.lower(name).rlike(r"^[a-z0-9-]+-cml\d+\.pdf$")
    circular = F.regexp_extract(F.lower(name), r"-cml(\d+)\.pdf$", 1)
    rest = F.nullif(F.get(F.split(key, ":"), F.lit(1)), F.lit(""))
    code = F.when(bse, F.regexp_extract(name, BSE_FILE, 1)).when(nse, F.concat(F.lit("CML"), circular)).otherwise(rest)
    stem = F.substring(name, F.lit(1), F.length(name) - F.length(circular) - 8)
    return code, F.when(bse, F.regexp_extract(name, BSE_FILE, 2)).when(nse, F.upper(stem)).otherwise(F.coalesce(known_symbol, rest))


def shp_candidates(stem: Column) -> Column:
    """File names under which the shareholding pattern of a lock-in file may lie, likeliest first."""
    base = F.regexp_replace(stem, r"(?i)_(java|pdfplumber)$", "")
    symbol = F.regexp_extract(base, r"^(.+)-CML\d+$", 1)
    annexure = F.regexp_replace(base, r"-Annexure-I$", "-Annexure-II")
    names = F.array(F.when(symbol != "", F.concat(F.lit("SHP-"), symbol)), F.when(symbol != "", F.concat(F.lit("SHP_"), symbol)), F.when(annexure != base, annexure))
    return F.transform(F.array_compact(names), lambda n: F.concat(n, F.lit("_java.txt")))


def unique_symbol(exchange: Column, code: Column, symbol: Column) -> Column:
    """``NSE:<symbol>`` or ``BSE:<code>``."""
    return F.concat(exchange, F.lit(":"), F.when(exchange == "BSE", code).otherwise(symbol))


def after_colon(key: Column) -> Column:
    return F.substring_index(key, ":", -1)


# What a listing notice writes before the figures, in any case and with any blanks between the words.
LISTED, SECURITIES, COMPANY = "effective from", "No. of Securities", "Name of the company"


def _after(text: Column, words: str, then: str) -> Column:
    """What follows these words, as a pattern with one group says; empty if nothing does."""
    said = r"\s+".join(re.escape(w) for w in words.split()).replace(r"No\.\s+of", r"No\.\s*of")
    return F.regexp_extract(text, rf"(?i){said}{then}", 1)


def notice_hints(text: Column, exchange: Column) -> Column:
    """Listing date, number of shares and company that a listing notice names.

    One exchange writes the day of the week before the date, the other doesn't.
    """
    day = r"([A-Za-z]+\s+\d{1,2},?\s+\d{4})"
    raw = F.when(exchange == "BSE", _after(text, LISTED, rf"\s+\w+,\s+{day}")).otherwise(_after(text, LISTED, rf"\s+{day}"))
    shares = F.translate(_after(text, SECURITIES, r"\s+([\d,]+)"), ",", "").try_cast("bigint")
    company = F.nullif(F.trim(_after(text, COMPANY, r"\s+(.+)")), F.lit(""))
    return F.struct(by_formats(squeeze(raw), NOTICE_FORMATS).alias("listing_date"), shares.alias("shares"), company.alias("company"))
