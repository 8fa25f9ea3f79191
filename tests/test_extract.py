"""Extractors on filings of known content."""

import datetime

import pytest
from pyspark.sql import functions as F

from lotloom.functions import classify, dates, numbers
from lotloom.plans import lockin, shp

#: Columns one space apart, dates with points. Invented, as all filings here.
CLOSE = """--- PAGE 1 ---
   Tight Columns Ltd
   Number of Securities Distinctive Numbers Type of Security
   12,50,000 1 12,50,000 L 11.03.2024 20.03.2027 Demat
   7,40,500 12,50,001 19,90,500 L 11.03.2024 20.03.2025 Demat
   1,09,500 19,90,501 21,00,000 L 14.03.2024 12.04.2024 Demat
   1,00,000 21,00,001 22,00,000 L 14.03.2024 12.06.2024 Demat
   8,00,000 22,00,001 30,00,000 F FREE Demat

##########
"""
#: Decimals in some rows, two rows whose last columns touch, a total without the word.
WIDE = """--- PAGE 1 ---
     Broad Columns Ltd
   Number of Securities    Distinctive Numbers
        15,000.00             1        15,000  L 05-Jun-24  12-Jun-26    Demat
      4,85,000.00        15,001      5,00,000  L 05-Jun-24  12-Jun-25    Demat
     20,00,000.00      5,00,001     25,00,000  L 05-Jun-24  12-Jun-27    Demat
        2,50,000      25,00,001     27,50,000  L 07-Jun-24  06-Jul-24    Demat
        2,50,000      27,50,001 30,00,000      L 07-Jun-24  05-Sep-24    Demat
       10,00,000      30,00,001 40,00,000      F Free Demat
     40,00,000
"""
NSE = """Annexure I
No. of Equity Shares   From   To   Lock in upto
3104220   1   3104220   17-Mar-2027
87340*   3104221   3191560   Free
250.00   3191561   3191810
3191810   Total
"""


def run(spark, *rows):
    frame = spark.createDataFrame(list(rows), "id string, exchange string, text string, known_total bigint")
    return {r["id"]: r["lockin"] for r in lockin.extract(frame).collect()}


@pytest.fixture(scope="module")
def found(spark):
    return run(
        spark, ("close", "BSE", CLOSE, None), ("wide", "BSE", WIDE, None), ("wide-known", "BSE", WIDE, 4000000), ("nse", "NSE", NSE, None), ("empty", "BSE", "", None), ("null", "NSE", None, None),
        ("ranges", "BSE", "From To Date\n1 1640000 F&L 29/01/2028\n1640001 2000000 F Free\nTotal 2000000\n", None),
        ("total", "BSE", "1,000   1   1,000   Lock-in   01-Jan-2024   01-Jan-2027   Demat\n500   1,001   1,500   Fully Paid   Free   Demat\n1,500   Total\nCompany Secretary\n9 9 9", None),
        ("soft", "BSE", "100 1 90 L 01-Jan-2027 Demat\n200 91 300 L 01-Jan-2027 Demat\n55 301 310 L 01-Jan-2027 Demat\nTotal 300\n", 300),
    )


def test_columns_one_space_apart(found):
    r = found["close"]
    assert (r["strategy"], r["computed_total"], r["locked_shares"], r["free_shares"]) == ("no_malformed_cleanup", 3000000, 2200000, 800000)
    assert [x["bucket"] for x in r["lots"]] == ["3_year_plus", "1_year_plus", "anchor_30", "anchor_90", "free"]
    assert r["lots"][0]["lockin_date_from"] == datetime.date(2024, 3, 11)
    assert [x["status"] for x in r["lots"]] == ["LOCKED"] * 4 + ["FREE"]


def test_hint_decides(found):
    assert (found["wide"]["strategy"], found["wide"]["computed_total"], len(found["wide"]["lots"])) == ("line_by_line", 2750000, 4)
    r = found["wide-known"]
    assert (r["strategy"], r["computed_total"], r["locked_shares"], r["free_shares"]) == ("no_malformed_cleanup", 4000000, 3000000, 1000000)
    assert [x["bucket"] for x in r["lots"]] == ["2_year_plus", "1_year_plus", "3_year_plus", "anchor_30", "anchor_90", "free"]


def test_general(found):
    r = found["nse"]
    assert [(x["shares"], x["is_free"], x["to_date"]) for x in r["lots"]] == [(3104220, False, "17-Mar-2027"), (87340, True, None), (250, True, None)]
    assert r["declared_total"] == 3191810 and r["total_match"]


def test_other_strategies(found):
    assert [(x["shares"], x["from_no"], x["to_no"], x["status"]) for x in found["ranges"]["lots"]] == [(1640000, 1, 1640000, "LOCKED"), (360000, 1640001, 2000000, "FREE")]
    assert found["ranges"]["strategy"] == "range_calculation"
    assert (found["total"]["strategy"], found["total"]["computed_total"]) == ("reverse_from_total", 1500)
    assert (found["soft"]["strategy"], [x["shares"] for x in found["soft"]["lots"]]) == ("sum_first_soft_labels", [100, 200])
    assert found["soft"]["lots"][0]["range_diff"] == 10


def test_nothing(found):
    assert found["empty"]["lots"] == [] and found["null"]["lots"] == []


def test_lots_in_order(spark):
    frame = spark.createDataFrame([("a", "BSE", CLOSE)], "id string, exchange string, text string")
    assert [r["row_order"] for r in lockin.lots(lockin.extract(frame), "id").collect()] == list(range(5))


def test_schedule(spark):
    text = "Annexure II\nDetails of shares eligible to be traded\n17-Mar-2027   1,000\n07-Nov-2025   25\nAnnexure I\n01-Jan-2020   9"
    got = spark.createDataFrame([(text.split("\n"),)], "l array<string>").select(lockin.unlock_schedule(F.col("l")).alias("s")).first()["s"]
    assert [tuple(r) for r in got] == [("17-Mar-2027", 1000), ("07-Nov-2025", 25)]


CLEAN = """Category   No of holders   Shares   Pct   Locked
(A) Promoter & Promoter Group     3     6,000,000     60.00    6,000,000
(B) Public     120     3,500,000     35.00    500,000
(C) Non Promoter Non Public     2     500,000     5.00    0
Total     125     10,000,000     100.00    6,500,000
"""
BARE = "Heading\nx 3 6,000,000 60 6,000,000\ny 120 3,500,000 35 500,000\nz 2 500,000 5 0\n{} 125 10,000,000 100 6,500,000\n"


def test_shareholding(spark):
    rows = [
        ("clean", "NSE", CLEAN, 10000000, 10000000, 6500000), ("two", "BSE", CLEAN.replace("(C) Non Promoter Non Public     2     500,000     5.00    0\n", "").replace("3,500,000", "4,000,000"), 10000000, 10000000, 6500000),
        ("place", "NSE", BARE.format("Total"), 10000000, None, 6500000), ("up", "NSE", BARE.format("Sum"), 10000000, None, 6500000), ("no hint", "NSE", CLEAN, None, None, None),
        ("computed", "BSE", BARE.format("Sum"), None, 10000000, 6500000), ("conflict", "BSE", CLEAN, 9000000, 10000000, 6500000), ("empty", "BSE", "", None, None, None), ("null", "BSE", None, 1, 1, 1),
    ]
    frame = spark.createDataFrame(rows, "id string, exchange string, text string, known_total bigint, computed_total bigint, known_locked bigint")
    got = {r["id"]: r["shp"] for r in shp.extract(frame).collect()}
    whole = (6000000, 3500000, 500000, 10000000, 6500000)
    assert tuple(got["clean"])[:5] == whole and got["clean"]["strategy"] == "spatial_columns"
    assert tuple(got["two"])[:5] == (6000000, 4000000, 0, 10000000, 6500000)
    assert tuple(got["place"])[:5] == whole and got["place"]["strategy"] == "position_based"
    assert tuple(got["up"])[:5] == whole and got["up"]["strategy"] == "boundary_detection"
    assert tuple(got["no hint"])[:5] == whole and got["no hint"]["strategy"] == "sequential"
    assert tuple(got["computed"])[:5] == whole
    assert got["conflict"]["total_shares"] == 10000000
    assert got["empty"]["total_shares"] is None and got["null"]["promoter_shares"] is None


def test_registered_strategy(spark):
    """A strategy of one's own wins by its priority, and only where it finds something; no plan is edited for it."""
    def marked(x):
        lot = lockin._lot(shares=F.lit(7).cast("bigint"), is_free=F.lit(False), security_type=F.lit("own"))
        found = lockin._result(F.array(lot), lambda v: (F.lit(7), F.lit(True), F.lit("marked")))
        return F.when(F.exists(x.lines, lambda l: l.contains("#own#")), found)

    texts = ("1,000   1   1,000   Lock-in   01-Jan-2024   01-Jan-2027   Demat\n1,000   Total\n#own#", "1,000   1   1,000   Lock-in   01-Jan-2024   01-Jan-2027   Demat\n1,000   Total\n")
    rows = [("a", "BSE", texts[0], None), ("b", "BSE", texts[1], None), ("c", "NSE", texts[0], None)]
    before = {k: r["strategy"] for k, r in run(spark, *rows).items()}
    lockin.register(lockin.Strategy("marked", 5, marked, rows=False))
    try:
        found = run(spark, *rows)
    finally:
        del lockin.STRATEGIES["marked"]
    assert found["a"]["strategy"] == "marked" and found["a"]["computed_total"] == 7
    assert {k: r["strategy"] for k, r in found.items() if k != "a"} == {k: v for k, v in before.items() if k != "a"}
    assert {k: r["strategy"] for k, r in run(spark, *rows).items()} == before


@pytest.mark.parametrize("table,want", [
    (None, []), ([], []), ([["From", "To", "Shares"]], []),
    ([["x"], ["From", "To", "No. of shares", "Lock-in upto"], [None, "", None, None], ["1", "500", "5,00", " 01-Jan-2027 "], ["1", "99", "99", "01-Jan-2027"], ["1", "200", "200"], None, ["1", "2", "300", "FREE"]], [(500, "01-Jan-2027", False, "locked"), (200, None, True, "free"), (300, None, True, "free")]),
    ([["Date", "Securities", "Lock"], ["02-Feb-2026", "1,000", "x"]], [(1000, "02-Feb-2026", False, "locked")]),
    ([["no", "header"], ["700", "01-Jan-2027"]], [(700, None, True, "free")]),
])
def test_cell_tables(spark, table, want):
    from lotloom.plans import cells

    row = spark.createDataFrame([(table,)], "t array<array<string>>").select(cells.lots(F.col("t")).alias("l")).first()
    assert [tuple(x) for x in row["l"]] == want


def test_a_date_that_fits_by_chance_is_no_number(spark):
    """The mender joins 1 and 21,000; 121,000 and 14-Jul-1999, its digits taken as 141,999, would then make 21,000 shares."""
    text = "Number of Securities From To\n21,000 1 21,000 Lock-in 14-Jul-1999 14-Jul-1999 Demat\n21,000"
    r = run(spark, ("chance", "BSE", text, 21000))["chance"]
    assert (r["strategy"], r["computed_total"], [x["to_no"] for x in r["lots"]]) == ("no_malformed_cleanup", 21000, [21000])


def test_dates_of_lots_are_read_once(spark):
    size = lambda c: len(str(c._jc.toString()))
    dated = lockin._dated(F.col("r"), dates.WITH_IPO, F.lit(""))
    assert size(lockin._finished()) < 2 * size(dates.date_value(F.col("t"), F.col("o")))
    assert size(dated) < 2 * size(dates.date_text(F.col("t"))) + size(classify.row_class(F.col("k"), F.col("d")))


def test_dates_are_read_of_lots_that_count_only(spark, monkeypatch):
    """Strategies tell by numbers that their total isn't the hint on the page, or not the text's; nothing is dated for it."""
    line = "{0}   {1}   {2}   Lock-in   01-Jan-2024   01-Feb-2027   Demat\n"
    three, ranges = line.format("100", "1", "100") + line.format("200", "101", "300"), "1 100 L 01-Jan-2027\n101 300 L 01-Jan-2027\n"
    docs = [("hint", three + "Total 300", 1), ("ranges", ranges, 1), ("off", three + "Total 301", None)]
    kinds = {"known_total": "bigint", "computed_hint": "bigint", "_every": "array<string>"}
    frame = spark.createDataFrame(docs, "id string, text string, declared_hint bigint").withColumns({c: F.lit(None).cast(k) for c, k in kinds.items()})
    for c in ("_lines", "_gaps", "_numbered", "_page", "_hints", "_footer", "_rows", "_mended"):
        frame = frame.withColumn(c, lockin._column(c))
    lot = lockin.LOTS.removeprefix("array<").removesuffix(">")
    monkeypatch.setattr(lockin, "_dated", lambda *_, **__: F.raise_error(F.lit("dated")).cast(lot))
    tried = {s.name: s.build(lockin._inputs()).alias(s.name) for s in lockin.cascade()}
    two = tried.pop("two_dates_fallback")
    assert [tuple(r) for r in frame.where("id <> 'off'").select(*tried.values()).collect()] == [(None,) * 5] * 2
    assert frame.where("id = 'off'").select(two).first()[0] is None


def test_marks_of_dates_are_not_odd(spark):
    lines = {"1 500 Lock-in 1-Jan-2027 N/A x.y": False, "1 5.00": True, "1/2 5": True, "1 5 01-Jan-27": True, "1 5 01-Jan-2027*": True, "A-1 5": True, "5 (1-Jan-2027": True, "5 7": False}
    got = spark.createDataFrame([(l,) for l in lines], "l string").select("l", F.col("l").rlike(numbers.ODD_MARK).alias("odd")).collect()
    assert {r["l"]: r["odd"] for r in got} == lines


def test_numbers_by_line(spark):
    texts = ["a 1 2,000\n,5 6,,7, 8\n\nx", "12345678901234567890 3\n9223372036854775807 1", "", "-1.50\n \n1,\n,2", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    lines = F.split("t", "\n", -1)
    got = frame.select(numbers.numbers_by_line(F.col("t")).alias("new"), F.transform(lines, numbers.line_numbers).alias("each")).collect()
    assert [r["new"] for r in got] == [r["each"] for r in got] and got[0]["new"] == [[1, 2000], [5, 67, 8], [], []] and got[1]["new"] == [[3], [9223372036854775807, 1]]


def test_shareholding_steps_are_columns(spark):
    """The last strategy stands in no lambda, and nothing is read a second time where no other total is known; odd white space changes nothing."""
    doc = "as of\xa0today\x0bSponsors 3 200 10\n\tOutsiders 90 300 10\r\nRest 1 400 10\u2028Sum 94 900 1 2 3 4 5 6 7"
    frame = spark.createDataFrame([(1, "BSE", doc, 900), (2, "NSE", doc.replace("\x0b", "\n").replace("\t", "").replace("\u2028", "\n"), 900)], "id long, exchange string, text string, known_total long")
    out = shp.extract(frame)
    assert [tuple(r["shp"])[:4] + (r["shp"]["strategy"],) for r in out.collect()] == [(200, 300, 400, 900, "simple_position")] * 2
    steps = [line for line in out._jdf.queryExecution().optimizedPlan().toString().split("Project [") if "simple_position" in line]
    assert len(steps) == 1 and "aggregate(" not in steps[0]
    hinted = spark.createDataFrame([("NSE", "(A) Promoter 75 8500000\n(B) Public 1500000 11\nSum 10000000 locked 5000", 10000000, 5000)], "exchange string, text string, known_total long, known_locked long")
    assert tuple(shp.extract(hinted).first()["shp"])[:3] == (8500000, 1500000, 0)
