"""Expressions on literal values."""

import datetime

import pytest
from pyspark.sql import functions as F

from lotloom.functions import classify, dates, numbers, text


@pytest.fixture(scope="module")
def value(spark):
    def run(column):
        return spark.range(1).select(column.alias("v")).first()["v"]

    return run


@pytest.mark.parametrize("raw, want", [("1,23,456", 123456), ("1 234", 1234), ("1234.00", 1234), ("88000*", 88000), ("23.05.2025", None), ("", None), ("12.7", 12), (".", None), (None, None)])
def test_clean_number(value, raw, want):
    assert value(numbers.clean_number(F.lit(raw).cast("string"))) == want


def test_number_lists(value):
    assert value(numbers.line_numbers(F.lit("33,000.00 x 7"))) == [33000, 0, 7]
    assert value(numbers.token_numbers(F.lit("33,000.00 1 L 02-Sep-25"))) == [33000, 1, 225]
    assert value(numbers.guarded_numbers(F.lit("a12,3b 45"))) == [123, 45]
    assert value(numbers.contains_number(F.lit("a 1,000 b"), F.lit(1000))) is True
    assert value(numbers.contains_number(F.lit("a 1,000 b"), F.lit(None).cast("bigint"))) is False
    assert value(numbers.best_effort_int(F.lit(" 12.9 "))) is None
    assert [value(numbers.best_effort_int(F.lit(t))) for t in (" 1,234 ", "-5", "", "12a")] == [1234, None, None, None]


@pytest.mark.parametrize("raw, want", [("9 7,84,937", "97,84,937"), ("3 ,03,091", "3,03,091"), ("1 9.00", "19.00"), ("7 .00", "7.00"), ("4 47  x", "447  x"), ("27,15,072 1", "27,15,072 1")])
def test_repair(value, raw, want):
    assert value(numbers.repair_numbers(F.lit(raw))) == want


def test_grouping(value):
    assert value(numbers.grouped(F.lit(1234567))) == "1,234,567"
    assert [value(numbers.grouped_indian(F.lit(n))) for n in (0, 999, 1000, 123456, 12345678, -1234567)] == ["0", "999", "1,000", "1,23,456", "1,23,45,678", "-12,34,567"]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("28th November 2025", "2025-11-28"), ("15-12-2025 (Anchor)", "2025-12-15"), ("12/11/2028", "12/11/2028"), ("Free IPO Shares", "FREE"), ("N/A", "FREE"), ("", ""), ("23.05.2025", "2025-05-23"),
        ("02-Sep-25", "2025-09-02"), ("January 15, 2025", "2025-01-15"), ("15-Jan-75", "1975-01-15"), ("11/28/2025", "11/28/2025"), ("Juny 19, 2028", "Juny 19, 2028"), (None, ""),
    ],
)
def test_date_text(value, raw, want):
    assert value(dates.date_text(F.lit(raw).cast("string"))) == want


@pytest.mark.parametrize("raw, order, want", [("12/11/2028", None, "2028-11-12"), ("12/11/2028", "mdy", "2028-12-11"), ("11/28/2025", None, "2025-11-28"), ("2025-01-15", "dmy", "2025-01-15"), ("FREE", None, None), ("15 Jan 2025", None, "2025-01-15"), ("nonsense", None, None), (None, None, None)])
def test_date_value(value, raw, order, want):
    got = value(dates.date_value(F.lit(raw).cast("string"), F.lit(order).cast("string")))
    assert got == (datetime.date.fromisoformat(want) if want else None)


def test_date_order(value):
    assert value(dates.date_order(F.lit("on 25/12/2024 and 13-01-2025 and 12/31/2024"))) == "dmy"
    assert value(dates.date_order(F.lit("12/31/2024"))) == "mdy"
    assert value(dates.date_order(F.lit("25.12.2024 1/2/2024"))) is None


def test_line_dates(value):
    assert tuple(value(dates.line_dates(F.lit("L 02-Sep-25  08-Sep-27 Demat")))) == ("02-Sep-25", "08-Sep-27")
    assert tuple(value(dates.line_dates(F.lit("F Free Demat")))) == ("", "Free")
    assert tuple(value(dates.line_dates(F.lit("no date here", )))) == ("", "")


@pytest.mark.parametrize("days, want", [(-1, "free"), (0, "anchor_30"), (44, "anchor_30"), (45, "anchor_90"), (104, "anchor_90"), (105, "1_year_minus"), (365, "1_year_plus"), (730, "2_year_plus"), (1095, "3_year_plus"), (None, "free")])
def test_bucket(value, days, want):
    start = F.lit("2024-01-01").cast("date")
    assert value(classify.bucket(start, F.date_add(start, F.lit(days).cast("int")))) == want


def test_other_buckets(value):
    assert value(classify.inclusive_bucket(F.lit(45))) == "anchor_30"
    assert value(classify.legacy_band(F.lit(-350))) == "1_year"
    assert value(classify.legacy_band(F.lit(50))) == "unknown"
    assert value(classify.lookup(F.lit("1+YEAR"), classify.RENAMED)) == "1_year_plus"
    assert value(classify.lookup(F.lit("x"), classify.RENAMED)) == "x"


@pytest.mark.parametrize(
    "kind, raw, want",
    [
        ("Anchor", "2025-01-01", "anchor"), ("", "15-12-2025 (Anchor)", "anchor"), ("IPO lock", "FREE", "free"), ("", "FREE", "free"), ("Market Maker", "2025-01-01", "free"), ("Offer for sale", "2025-01-01", "free"),
        ("IPO", "2025-01-01", "locked"), ("Lock-in", "FREE", "locked"), ("F & L", "N.A.", "locked"), ("", "2025-01-01", "locked"), (None, None, "free"),
    ],
)
def test_row_class(value, kind, raw, want):
    assert value(classify.row_class(F.lit(kind).cast("string"), F.lit(raw).cast("string"))) == want


def test_text(value):
    assert value(text.page_list(F.lit("2-4,7"))) == [2, 3, 4, 7]
    assert value(text.page_list(F.lit("3,2,3"))) == [2, 3]
    assert value(text.slugs(F.lit("Highness Microelectronics Limited"))) == ["highness-microelectronics-ipo", "highness_microelectronics_ipo"]
    assert value(text.slugs(F.lit("A & B (India) Pvt. Ltd."))) == ["a-and-b-india-ipo", "a_and_b_india_ipo", "a-b-india-ipo", "a_b_india_ipo"]
    assert value(text.is_blank(F.lit("--- PAGE 1 ---\n######\n"))) is True
    assert value(text.is_blank(F.lit(None).cast("string"))) is True
    assert tuple(value(text.blank_stats(F.lit("--- PAGE 1 ---\n####\nab c")))) == (24, 1, 3, True)
    assert value(text.lines(F.lit("a\r\n b \rc"))) == ["a", "b", "c"]
    assert value(text.symbol_token(F.lit(" ab&c-1 "))) == "ABC-1"
    code, symbol = text.file_identity(F.lit("544324-CITI-Annexure-I.pdf"), F.lit("BSE"))
    assert (value(code), value(symbol)) == ("544324", "CITI")
    code, symbol = text.file_identity(F.lit("AAKAAR-CML68761.pdf"), F.lit("NSE"))
    assert (value(code), value(symbol)) == ("68761", "AAKAAR")
    code, symbol = text.shown_identity(F.lit("odd.pdf"), F.lit("NSE:ABC"), F.lit(None).cast("string"))
    assert (value(code), value(symbol)) == ("ABC", "ABC")
    assert value(text.shp_candidates(F.lit("AAKAAR-CML68761_java"))) == ["SHP-AAKAAR_java.txt", "SHP_AAKAAR_java.txt"]


def test_notice(value):
    bse = value(text.notice_hints(F.lit("shares effective from Thursday, April 2, 2026\nNo. of Securities 51,63,600\nName of the company Fine Things Limited\n"), F.lit("BSE")))
    assert tuple(bse) == (datetime.date(2026, 4, 2), 5163600, "Fine Things Limited")
    nse = value(text.notice_hints(F.lit("effective from April 07, 2026"), F.lit("NSE")))
    assert tuple(nse) == (datetime.date(2026, 4, 7), None, None)


@pytest.mark.parametrize("line, found", [
    *((f"100 1 100 L {e} Demat", [e]) for e in ("28th November 2025", "15-12-2025 (Anchor)", "02-Sep-25", "November 28, 2025", "3 May, 2026", "1/Jan/2027")), ("5 1 5 L 1.2.24 3/4/2025 (Anchor 30) x", ["1.2.24", "3/4/2025 (Anchor 30)"]), ("x Free IPO Shares", ["Free IPO Shares"]), ("x N.A. y n/a", ["N.A.", "n/a"]), ("no date", []),
    ("Jan 5th 2024", ["Jan 5th 2024"]),
])
def test_date_tokens(value, line, found):
    assert value(F.regexp_extract_all(F.lit(line), F.lit(dates.WITH_IPO), F.lit(1))) == found


@pytest.mark.parametrize("ipo, want", [(True, ["IPO Shares"]), (False, [])])
def test_ipo_is_a_date_token_only_where_asked(value, ipo, want):
    assert value(F.regexp_extract_all(F.lit("5 1 5 ipo IPO Shares"), F.lit(dates.date_token(ipo)), F.lit(1))) == want


@pytest.mark.parametrize("name, want", [("A & B (India) Pvt. Ltd.", {"a-and-b-india-ipo", "a_and_b_india_ipo", "a-b-india-ipo", "a_b_india_ipo"}), ("X Corp. Limited", {"x-corp-ipo", "x_corp_ipo"}), ("", {"-ipo", "_ipo"})])
def test_slugs_from_rules(value, name, want):
    assert set(value(text.slugs(F.lit(name)))) == want


@pytest.mark.parametrize("name,want", [("Acme Pvt. Ltd.", "Acme"), ("Acme Private Limited", "Acme"), ("Acme Corporation Limited", "Acme Corporation"), ("Acme Ltd", "Acme"), ("Acme Limited.", "Acme Limited."), ("Acme Ltd Inc ", "Acme"), ("Limited", "Limited"), ("Acme pvt LLP", "Acme"), ("Pvt Ltd", "Pvt")])
def test_forms_of_companies(value, name, want):
    assert value(text.without_form(F.lit(name))) == want


def test_places(spark):
    """Hot groups, ties, nulls and empty tables; places are those of a sort."""
    from lotloom.operators.places import numbered

    rows = [(None if i % 3 == 0 else "hot" if i % 3 == 1 else f"g{i % 7}", i * 7919 % 101, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v long, i long").repartition(9)
    for within in ("g", None):
        got = sorted((r["g"] if within else None, r["place"], r["v"], r["i"]) for r in numbered(df, [F.desc("v"), F.col("i")], within=within).collect() if r["g"] is not None or not within) if within else [(None, r["place"], r["v"], r["i"]) for r in numbered(df, [F.desc("v"), F.col("i")]).orderBy("place").collect()]
        want = []
        for g in sorted({r[0] for r in rows} - {None}) if within else [None]:
            own = sorted((-v, i) for k, v, i in rows if not within or k == g)
            want += [(g if within else None, n, -v, i) for n, (v, i) in enumerate(own, 1)]
        assert got == want
    assert sorted(r["place"] for r in numbered(df, [F.col("v")], within="g").where("g is null").collect()) == list(range(1, 1001))
    assert numbered(df.limit(0), [F.col("v")]).count() == 0


@pytest.mark.parametrize("raw,order,want", [
    ("Monday, 3rd of March 2025", None, "2025-03-03"), ("on 3 Sept 2025", None, "2025-09-03"), ("March 2025", None, "2025-03-15"), ("3 March", None, "2026-03-03"), ("Mar 2025 3", None, "2025-03-03"), ("2025 Mar 3", None, "2025-03-03"),
    ("7 8 2025", None, "2025-08-07"), ("7 8 2025", "mdy", "2025-07-08"), ("13 8 2025", "mdy", "2025-08-13"), ("8 13 2025", None, "2025-08-13"), ("2025 8 13", None, "2025-08-13"), ("2025 3 4", None, "2025-04-03"), ("2025 3 4", "mdy", "2025-03-04"),
    ("5 Feb '31", None, "2031-02-05"), ("5 Feb 80", None, "1980-02-05"), ("5/2/75", "x", "1975-02-05"), ("Feb", None, "2026-02-15"), ("2024", None, "2024-05-15"), ("9", None, "2026-05-09"), ("31 Feb 2025", None, None), ("3 Foo 2025", None, None),
    ("March April 2025", None, None), ("1 2 3 4", None, None), ("3 March 2025 10:30", None, None), ("", None, None), ("Friday", None, None), ("free 3 March", None, None), ("12345", None, None), ("29 Feb 2024", None, "2024-02-29"),
])
def test_free_form_dates(value, raw, order, want):
    """Order, noise words, missing parts."""
    found = value(dates.date_value(F.lit(raw), F.lit(order).cast("string"), F.lit("2026-05-15").cast("date")))
    assert found == (datetime.date.fromisoformat(want) if want else None)


def test_free_form_needs_a_day_for_what_is_missing(value):
    assert value(dates.date_value(F.lit("3 March"), F.lit("dmy"))) is None and value(dates.date_value(F.lit("Tue 3 March 2026"), F.lit("dmy"))) == datetime.date(2026, 3, 3)
    assert value(dates.date_value(F.lit("Feb 2025"), F.lit("dmy"), F.lit("2026-05-31").cast("date"))) == datetime.date(2025, 2, 28)


def test_numbers_and_dates_by_short_paths(value):
    shown = lambda *words: value(numbers.token_numbers(F.lit(" ".join(words))))
    assert shown("x", "1.5.2", ".", "..", "12.", ".5", "7.00", ".00", "1234567890123456789", "12345678901234567890123") == [12, 0, 7, 1234567890123456789, 9223372036854775807]
    assert value(numbers.token_numbers(F.lit("5 14-Jul-1999 1/2/24, 23.05.2025 7-8"), dates=False)) == [5, 78]
    days = ("14-jul-1999", "4-FEB-2024", "30-Feb-2024", "01-Xyz-2024", "01-Jan-0000")
    assert [value(dates.date_text(F.lit(d))) for d in days] == ["1999-07-14", "2024-02-04", "30-Feb-2024", "01-Xyz-2024", "0000-01-01"]
    assert [value(dates.date_value(F.lit(d), F.lit(None).cast("string"))) for d in ("2024-02-04", "2024-02-30")] == [datetime.date(2024, 2, 4), None]


def test_a_run_beyond_64_bits_keeps_its_place(value):
    line = F.lit("7 x 99999999999999999999,9 y 1,234")
    assert value(numbers.number_runs(line)) == [7, None, 1234] and value(numbers.line_numbers(line)) == [7, 1234]


def test_crores_as_one_number(value):
    shown = [value(numbers.grouped_indian(F.lit(n), whole_crores=True)) for n in (7, 123456, 12345678, -1000000234, 987654321012)]
    assert shown == ["7", "1,23,456", "1,23,45,678", "-100,00,00,234", "98765,43,21,012"]
    assert value(numbers.grouped_indian(F.lit(1000000234))) == "1,00,00,00,234"


def test_numbers_among_every_blank(value):
    line = F.lit("1,000\t2.5 x3x\x0b4\x0c5\r6 01-Jan-2027 7..8  9")
    assert value(numbers.token_numbers(line)) == [1000, 2, 3, 4, 5, 6, 12027, 9]
    assert value(numbers.token_numbers(line, dates=False)) == [1000, 2, 3, 4, 5, 6, 9]
    assert value(numbers.repair_numbers(F.lit("1 2,345   3 4   5,6 78"))) == "12,345   3 4   5,678"


def test_looking_for_words_first_loses_nothing(spark):
    """A line without a footer's word has no footer, one without the end of a loose date has none, one without a gap isn't mended; the quick readings of dates are those of all formats."""
    rows = [
        "Name : A", "DESIGNATION: b", " place:", "For Alpha Beta Limited", "COMPANY Secretary", "Membership No. 7", "Notes:", "The Distinctive Numbers are for the purpose of", "Demat - 2 Years", "Sd/-", "1,000   1   1,000   Lock-in   01-Jan-2027   Demat", "Sd", "Demat",
        "5th March 2027", "March 5, 2027", "1 may,  2027 ipo shares", "3 1 2027", "x 5 2027", "N/A 2027", "N.A. free  Shares 1/2/27 (x)", "1 2,345 7", "1 2", "12 ,5", "7  8",
    ]
    lines = spark.createDataFrame([(r,) for r in rows], "l string")
    lost = lines.where(F.col("l").rlike(text.FOOTER) & ~text.may_have_footer(F.col("l")) | (numbers.repair_numbers(F.col("l"), eager=True) != F.col("l")) & ~numbers.may_have_gaps(F.col("l")))
    assert lost.count() == 0 and lines.where(text.may_have_footer(F.col("l"))).count() == 10
    for ipo in (True, False):
        raw = F.regexp_extract_all("l", F.lit(dates.date_token(ipo)), F.lit(1))
        last = F.coalesce(F.get(raw, F.least(F.size(raw), F.lit(2)) - 1), F.lit(""))
        assert lines.where(dates.line_dates(F.col("l"), dates.date_token(ipo))["last"] != last).count() == 0
        assert dates.date_token(ipo) in dates._TIGHT_ONLY
    days = [f"{a}{m}{b}{m}{y}" for a in (1, 9, 12, 13, 31, 32) for b in ("2", "02", 12, 30, "Feb", "dec", "Xyz") for m in "-/." for y in ("2024", "0999", "24")] + ["2024-13-05", "2024-02-30", "2024-05-13", "FREE", "", "1-2/2024"]
    frame = spark.createDataFrame([(d, o) for d in days for o in ("dmy", "mdy", None)], "d string, o string")
    formats = dates.BASE_FORMATS + dates.DMY_FORMATS + dates.MDY_FORMATS + dates.LOOSE_FORMATS
    whole = F.when((F.col("d") != "") & (F.col("d") != "FREE"), F.coalesce(dates.by_formats(F.col("d"), formats, F.col("o")), dates.free_date(F.col("d"), F.col("o"))))
    assert frame.where(~whole.eqNullSafe(dates.date_value(F.col("d"), F.col("o")))).collect() == []
    unsure = frame.groupBy("d").agg(F.count_distinct(F.coalesce(dates.date_value(F.col("d"), F.col("o")).cast("string"), F.lit("none"))).alias("n")).where("n > 1")
    assert unsure.count() > 0 and unsure.where(~dates.needs_order(F.col("d"))).count() == 0


def test_strip_takes_all_white_space(value):
    assert value(text.strip(F.lit(f"{text.WHITE}a b{text.WHITE}"))) == "a b"
    assert all(value(F.regexp_replace(F.lit(c), r"(?U)\s", "")) == "" for c in (text.WHITE,)) and value(text.plain_breaks(F.lit("a\r\r\nb\rc\n"))) == "a\n\nb\nc\n"
