"""Classes, states and duration buckets of share lots."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotloom.functions.bind import let
from lotloom.functions.dates import is_free_date

# The buckets in ledger order, least days of each, and names before the migration.
BUCKETS = ("3_year_plus", "2_year_plus", "1_year_plus", "1_year_minus", "anchor_90", "anchor_30", "free")
LEAST_DAYS = ((1095, "3_year_plus"), (730, "2_year_plus"), (365, "1_year_plus"), (105, "1_year_minus"), (45, "anchor_90"), (0, "anchor_30"))
RENAMED = {"3+YEARS": "3_year_plus", "2+YEARS": "2_year_plus", "1+YEAR": "1_year_plus", "ANCHOR_90DAYS": "anchor_90", "ANCHOR_30DAYS": "anchor_30", "FREE": "free"}
LABELS = {"3_year_plus": "3+ years", "2_year_plus": "2+ years", "1_year_plus": "1+ year", "1_year_minus": "Below 1 year", "anchor_90": "Anchor 90", "anchor_30": "Anchor 30", "free": "Free"}
#: Legacy bands of days, both ends included.
BANDS = ((15, 45, "anchor_30"), (75, 105, "anchor_90"), (330, 400, "1_year"), (690, 780, "2_year"), (1055, 1145, "3_year"))


def is_locked_type(kind: Column) -> Column:
    """Whether a lower-case security type says that the shares are locked."""
    return kind.contains("lock") | F.replace(kind, F.lit(" "), F.lit("")).contains(",l") | kind.contains("& l") | kind.contains("f,l")


def row_class(kind: Column, raw: Column) -> Column:
    """anchor, free or locked from a security type and a raw lock-in date; the order of the tests matters."""
    def of(t: Column, d: Column, free: Column) -> Column:
        ipo, lock = t.contains("ipo") & t.rlike(r"\bipo\b"), t.contains("lock")
        return (
            F.when(t.contains("anchor") | t.contains("30 day") | t.contains("90 day") | (d.contains("(") & d.rlike(r"(?i)\(anchor")), "anchor")
            .when(ipo & lock & free, "free").when(free & ~is_locked_type(t), "free")
            .when(t.contains("free") | t.contains("not under lock") | t.contains("market maker") | (t.contains("offer for sale") & ~lock), "free")
            .when(ipo & ~lock, F.when(free, "free").otherwise("locked")).when(is_locked_type(t), "locked").when((d != "") & ~free, "locked").otherwise("free")
        )

    plain = lambda c: F.trim(F.coalesce(c, F.lit("")))
    return let(F.lower(plain(kind)), lambda t: let(plain(raw), lambda d: let(is_free_date(d), lambda free: of(t, d, free))))


def status(is_free: Column) -> Column:
    """FREE or LOCKED; whether a lock-in has run out plays no part."""
    return F.when(is_free, "FREE").otherwise("LOCKED")


def bucket(start: Column, to: Column) -> Column:
    """Bucket by the days from ``start`` to ``to``; without either, or below zero, free."""
    days = F.date_diff(to, start)
    out = F.when(days.isNull(), "free")
    for least, name in LEAST_DAYS:
        out = out.when(days >= least, name)
    return out.otherwise("free")


def legacy_band(days: Column) -> Column:
    """Bucket by tolerance bands of the absolute number of days, else unknown."""
    out = F.when(days.isNull(), "free")
    for low, high, name in BANDS:
        out = out.when(F.abs(days).between(low, high), name)
    return out.otherwise("unknown")


def inclusive_bucket(days: Column) -> Column:
    """The alternate rule: closed ranges, the first that holds wins, so 45 days are anchor_30."""
    ranges = ((0, 45, "anchor_30"), (45, 105, "anchor_90"), (105, 365, "1_year_minus"), (365, 730, "1_year_plus"), (730, 1095, "2_year_plus"), (1095, 9999, "3_year_plus"))
    out = F.when(days.isNull(), "free")
    for low, high, name in ranges:
        out = out.when(days.between(low, high), name)
    return out.otherwise("free")


def coarse_class(to_text: Column, is_free: Column) -> Column:
    """free or locked: locked needs a token that looks like a date."""
    return F.when(is_free | to_text.isNull() | ~to_text.rlike(r"^\d{1,2}[-/\.]([A-Za-z]{3}|\d{1,2})[-/\.]\d{4}"), "free").otherwise("locked")


def lookup(value: Column, table: dict[str, str]) -> Column:
    """The table's entry, else the value itself."""
    return F.coalesce(F.create_map(*(F.lit(x) for pair in table.items() for x in pair))[value], value)


def bucket_order(value: Column) -> Column:
    """Place of a bucket in ledger order, as an enumeration sorts."""
    return F.array_position(F.array(*map(F.lit, BUCKETS)), value)
