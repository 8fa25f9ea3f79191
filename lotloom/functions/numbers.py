"""Numbers in text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotloom.functions.bind import let


#: A date as one word: day, month as a number or a short name, year, with marks between.
DATE_WORD = r"(?=\d)(?<!\S)\d{1,2}[-/.](?:\d{1,2}|[A-Za-z]{3})[-/.]\d{2,4}(?!\w)"
#: A mark in a word with a digit that is no ``d-MMM-yyyy``, or far inside any word. Marks are few, so they are looked for before what stands around them.
ODD_MARK = (
    r"[-/.](?!(?<=(?<!\S)\d{1,2}-)[A-Za-z]{3}-\d{4}(?!\S))(?!(?<=(?<!\S)\d{1,2}-[A-Za-z]{3}-)\d{4}(?!\S))"
    r"(?!(?<=(?<!\S)[^\s\d]{1,12})[^\s\d]*+(?!\S))"
)
#: All but digits, points and white space, which is spelt out: the same class with \\s in it takes eight times as long.
_OTHER = r"[^0-9. \t\n\x0b\f\r]+"


def _whole(kept: Column) -> Column:
    """Digits and points as a whole number. A cast that fails costs far more than one that succeeds, so only what is a number is cast."""
    large = lambda k: F.floor(k.try_cast("double")).try_cast("bigint")
    other = lambda k: F.when(k.rlike(r"^\d+$"), F.coalesce(k.try_cast("bigint"), large(k))).when(k.rlike(r"^(?:\d+\.\d*|\.\d+)$"), large(k))
    plain = ~kept.contains(".") & (F.length(kept) < 19)
    return F.when(plain, F.when(kept != "", kept.try_cast("bigint"))).otherwise(let(F.regexp_replace(kept, r"\.0+$", ""), other))


def clean_number(text: Column) -> Column:
    """Digits and points of a token as a whole number; several points (a date) give null."""
    return let(F.regexp_replace(text, "[^0-9.]", ""), _whole)


def number_runs(line: Column) -> Column:
    """All runs of digits and commas, in order; ``33,000.00`` gives 33000 and 0. A run beyond 64 bits is null in its place."""
    tokens = F.regexp_extract_all(line, F.lit(r"(\d[\d,]*)"), F.lit(1))
    return F.transform(tokens, lambda t: F.replace(t, F.lit(","), F.lit("")).try_cast("bigint"))


def line_numbers(line: Column) -> Column:
    """``number_runs`` without those beyond 64 bits."""
    return F.filter(number_runs(line), lambda n: n.isNotNull())


def numbers_by_line(text: Column) -> Column:
    """``line_numbers`` of each line of a text that line feeds part. Commas go before the text is parted, and all tokens are cast at once."""
    bare = F.when(text.contains(","), F.regexp_replace(text, "(?<=[0-9]),+", "")).otherwise(text)
    found = F.transform(F.split(bare, "\n", -1), lambda l: F.regexp_extract_all(l, F.lit("[0-9]+"), F.lit(0))).try_cast("array<array<bigint>>")
    return F.when(bare.rlike("[0-9]{19}"), F.transform(found, F.array_compact)).otherwise(found)


def token_numbers(line: Column, dates: bool = True) -> Column:
    """``clean_number`` of each token between white space, in order; without ``dates`` a date is no number."""
    kept = F.regexp_replace(line, _OTHER if dates else rf"{_OTHER}|{DATE_WORD}", "")
    return F.filter(F.transform(F.regexp_extract_all(kept, F.lit(r"([0-9.]+)"), F.lit(1)), _whole), lambda n: n.isNotNull())


def guarded_numbers(line: Column) -> Column:
    """Runs of digits and commas that no digit precedes or follows."""
    tokens = F.regexp_extract_all(line, F.lit(r"((?<!\d)\d[\d,]*(?!\d))"), F.lit(1))
    return F.filter(F.transform(tokens, lambda t: F.replace(t, F.lit(","), F.lit("")).try_cast("bigint")), lambda n: n.isNotNull())


def contains_number(text: Column, value: Column) -> Column:
    return F.coalesce(F.array_contains(guarded_numbers(text), value), F.lit(False))


def number_between(line: Column, first: Column, last: Column, most: Column | None = None) -> Column:
    """The largest number among the characters [first, last) of a line, of those up to ``most`` where it is given; else null."""
    found = line_numbers(F.substring(line, first + 1, last - first))
    return F.array_max(F.filter(found, lambda n: n <= most) if most is not None else found)


def best_effort_int(text: Column) -> Column:
    """A whole number from a text of digits, with or without commas; else null. (A number's own kind is a cast.)"""
    bare = F.trim(F.replace(text.cast("string"), F.lit(","), F.lit("")))
    return F.when(bare.rlike(r"^\d+$"), bare.try_cast("bigint"))


# A typist's gap is one space between two characters of a number. What may follow it tells a gap from the
# space between two numbers: a comma or a point, after at most two digits, belongs to the same number anywhere; two
# digits at the end of a column do only where the number has just begun, or after a comma. What follows is looked at
# first, for looking back over blanks costs most.
_LAST = r"\d{1,2}(?=\s{2,}|$)"
GAP = rf" (?=\d{{0,2}}[,.])(?<=\d )| (?={_LAST})(?<=(?:,\d{{1,2}}|^\s{{0,99}}\d) )"
EAGER_GAP = rf" (?<=\d )(?=\d{{0,2}}[,.]|{_LAST})"


def may_have_gaps(text: Column) -> Column:
    """Whether a text has a space that ``repair_numbers`` may close in one of its lines."""
    return text.rlike(r"\d [\d,.]")


def repair_numbers(line: Column, eager: bool = False) -> Column:
    """Close single spaces inside numbers. ``eager`` also joins any digit and a short last number."""
    return F.regexp_replace(line, EAGER_GAP if eager else GAP, "")


def grouped(number: Column) -> Column:
    """Thousands set off by commas."""
    return F.format_number(number, 0)


def grouped_indian(number: Column, whole_crores: bool = False) -> Column:
    """The last three digits, then pairs, set off by commas; with ``whole_crores`` no comma parts the number of crores (100,00,00,000)."""
    digits = F.abs(number).cast("string")
    pairs = r"(?<=\d)(?=\d\d$|\d{4}$)" if whole_crores else r"(?<=\d)(?=(\d\d)+$)"
    head = F.regexp_replace(F.substring(digits, F.lit(1), F.greatest(F.length(digits) - 3, F.lit(0))), pairs, ",")
    tail = F.right(digits, F.lit(3))
    return F.concat(F.when(number < 0, "-").otherwise(""), F.when(F.length(digits) > 3, F.concat(head, F.lit(","), tail)).otherwise(tail))
