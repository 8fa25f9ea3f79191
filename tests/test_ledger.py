"""Versions, edits, master list, rules, sources and streams."""

import datetime
import zipfile

from pyspark.sql import functions as F

from lotloom.operators import calendar, ledger, master, rules
from lotloom.sources import filings
from lotloom.streaming import feed



def now():
    return F.lit("2025-01-02 00:00:00").cast("timestamp_ntz")

LOG = "id long, unique_symbol string, exchange string, file_name string, status string, version int, lockin_pdf_path string, processed_at timestamp_ntz, updated_at timestamp_ntz"


def log_of(spark, *rows):
    t = datetime.datetime(2024, 1, 1)
    return spark.createDataFrame([(*r, t, None) for r in rows], LOG)


def test_upsert_keeps_paths(spark):
    old = log_of(spark, (1, "NSE:A", "NSE", "A-CML1.pdf", "FINALIZED", 3, "/old"))
    new = spark.createDataFrame([("NSE:X", "NSE", "A-CML1.pdf", "VALIDATING", "/new"), ("NSE:B", "NSE", "B-CML2.pdf", "VALIDATING", "/b")], "unique_symbol string, exchange string, file_name string, status string, lockin_pdf_path string")
    got = {r["file_name"]: r for r in ledger.upserted(old, new, now()).collect()}
    assert (got["A-CML1.pdf"]["version"], got["A-CML1.pdf"]["lockin_pdf_path"], got["A-CML1.pdf"]["unique_symbol"]) == (4, "/old", "NSE:A")
    assert (got["B-CML2.pdf"]["version"], got["B-CML2.pdf"]["lockin_pdf_path"]) == (1, "/b")


def test_moves(spark):
    log = log_of(spark, (1, "NSE:A", "NSE", "a", "VALIDATING", 1, ""), (2, "NSE:B", "NSE", "b", "NEW", 1, ""))
    assert [r["id"] for r in ledger.moved(log, "FINALIZED", now()).collect()] == [1]
    assert ledger.failed(log, "NSE:Z", "NSE", "why", now()).first()["status"] == "FAILED"


def test_rename(spark):
    log = log_of(spark, (1, "NSE:OLD", "NSE", "OLD-CML1.pdf", "NEW", 1, "/x/OLD-CML1.pdf"), (2, "NSE:B", "NSE", "TAKEN-CML1.pdf", "NEW", 1, ""))
    names = spark.createDataFrame([("1", "FRESH"), ("2", "taken")], "bse_script_code string, nse_symbol string")
    got = ledger.renamed(log, names, log.where("id = 1"), "FRESH", now()).first()
    assert (got["file_name"], got["lockin_pdf_path"], got["unique_symbol"], got["version"]) == ("FRESH-CML1.pdf", "/x/FRESH-CML1.pdf", "NSE:FRESH", 2)
    assert ledger.renamed(log, names, log.where("id = 1"), "UNKNOWN", now()).count() == 0
    assert ledger.renamed(log, names, log.where("id = 1"), "TAKEN", now()).count() == 0


def test_verdicts_as_json(spark):
    log = spark.createDataFrame([(1, 1)], "id long, version int")
    verdicts = spark.createDataFrame([(1, "RULE1", True, "m", 1, 1), (1, "RULE3", False, "n", 1, 2)], "id long, rule_id string, passed boolean, message string, expected long, actual long")
    got = ledger.with_verdicts(log, verdicts, now()).first()
    assert (got["all_rules_passed"], got["failed_rules"], got["version"]) == (False, "RULE3", 2) and '"RULE1":{"passed":true' in got["validation_results"]


def test_verdicts_in_the_row(spark):
    log = spark.createDataFrame([(1, "NEW", 1), (2, "NEW", 4), (3, "FINALIZED", 1), (4, "NEW", 1)], "id long, status string, version int")
    figures = {c: F.lit(6) for c in ("computed_total", "locked_total", "declared_total", "text_total", "shp_total_shares", "shp_locked_shares", "shp_promoter_shares")} | {c: F.lit(0) for c in ("free_total", "shp_public_shares", "shp_others_shares", *rules.FACTS)}
    records = log.withColumns({
        **figures, "shp_locked_shares": F.when(F.col("id") > 1, 5).otherwise(6), "negative_periods": F.col("id") - 1, "exchange": F.lit("NSE"), "anchor_letter_url": F.lit(None).cast("string"), "reference_date": F.lit(None).cast("date"), "is_blank": F.col("id") == 4,
        "error_message": F.lit("old"), "finalized_at": now(), "processed_at": F.lit(None).cast("timestamp_ntz"),
    })
    judged, long = rules.judged(records, strict=True), rules.verdicts(records, strict=True)
    got = ledger.revalidated_rows(judged, now())
    rows = {r["id"]: r for r in got.collect()}
    assert sorted(rows) == [1, 2] and (rows[1]["status"], rows[1]["error_message"], rows[1]["failed_rules"], rows[1]["version"]) == ("FINALIZED", None, None, 2)
    assert (rows[2]["status"], rows[2]["finalized_at"], rows[2]["failed_rules"], rows[2]["version"]) == ("VALIDATING", None, "RULE4,RULE8", 5)
    assert rows[2]["error_message"].startswith("Finalization skipped: Not all validation rules passed | RULE4: SHP Locked (5) != ") and rows[2]["error_message"].endswith(" | RULE8: Found 1 row(s) with negative lock period")
    assert {r["id"]: r for r in ledger.revalidated(records, long, now()).select(got.columns).collect()} == rows
    strategies = spark.createDataFrame([(2, "line_by_line", None)], "id long, lockin_strategy string, shp_strategy string")
    both = [ledger.with_verdicts_rows(judged, now(), strategies), ledger.with_verdicts(records, long, now(), strategies)]
    json = [{r["id"]: r["validation_results"] for r in b.collect()} for b in both]
    assert json[0] == json[1] and sorted(json[0]) == [1, 2, 3] and json[0][2].endswith(',"_strategies":{"lockin_strategy":"line_by_line"}}') and json[0][3].endswith(',"_strategies":{}}')
    # neither groups verdicts nor reads the records a second time
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan


def test_reviewed_flag(spark):
    row = spark.createDataFrame([('{"a":"x","manual_reviewed":"0"}',), (None,), ("broken",)], "m string").select(ledger.is_reviewed(ledger.reviewed(F.col("m"), F.lit(True))).alias("r"), ledger.is_reviewed(F.col("m")).alias("before"))
    assert [tuple(r) for r in row.collect()] == [(1, 0), (1, 0), (1, 0)]


def test_master_keys_never_repeat_records(spark):
    records = spark.createDataFrame([(1, "BSE", "BSE:500"), (2, "NSE", "NSE:abc"), (3, "NSE", "NSE:none")], "id long, exchange string, unique_symbol string")
    names = spark.createDataFrame([("500", None, "A"), ("500", "ABC", "B"), (None, " ", "C")], "bse_script_code string, nse_symbol string, company_name string")
    got = {r["id"]: r["company_name"] for r in master.with_master(records, names).collect()}
    assert got == {1: "A", 2: "B", 3: None}


def test_slug_fallback(spark):
    fields = "bse_script_code string, nse_symbol string, url_slug string, company_name string, allotment_date date, listing_date_actual date, expected_listing_date date, post_issue_shares long, anchor_letter_url string"
    day = datetime.date(2025, 5, 5)
    names = spark.createDataFrame([("1", None, None, "Keyed", None, None, None, 5, None), (None, None, "fine-things-ipo", "Slugged", day, None, None, 7, "u")], fields)
    records = spark.createDataFrame([(1, "BSE", "BSE:1"), (2, "BSE", "BSE:9")], "id long, exchange string, unique_symbol string")
    hints = spark.createDataFrame([(1, None, None, "Fine Things Ltd"), (2, day, 11, "Nobody Ltd")], "id long, listing_date date, shares long, company_name string")
    got = {r["id"]: r for r in master.resolved(records, names, hints).collect()}
    assert (got[1]["company_name"], got[1]["post_issue_shares"], got[1]["reference_date"]) == ("Slugged", 7, day)
    assert (got[2]["company_name"], got[2]["post_issue_shares"], got[2]["reference_date"]) == ("Nobody Ltd", 11, day)


def test_rule2_overrides(spark):
    base = "id long, exchange string, computed_total long, locked_total long, free_total long, declared_total long, text_total long, shp_total_shares long, shp_locked_shares long, shp_promoter_shares long, shp_public_shares long, shp_others_shares long, anchor_30_rows long, anchor_90_rows long, locked_free_bucket long, negative_periods long, locked_without_end long, anchor_letter_url string, reference_date date"
    rest = (10, 5, 3, 2, 0, 0, 0, 0, 0, None, None)
    frame = spark.createDataFrame([(1, "NSE", 10, 6, 4, 99, 10, *rest[:1], 6, 5, 3, 2, 0, 0, 0, 0, 0, None, None), (2, "NSE", 10, 6, 4, 99, 10, 11, 6, 5, 3, 2, 0, 0, 0, 0, 0, None, None), (3, "NSE", 10, 6, 4, None, None, 10, 6, 5, 3, 2, 0, 0, 0, 0, 0, None, None)], base)
    got = {r["id"]: r for r in rules.verdicts(frame).where("rule_id = 'RULE2'").collect()}
    assert (got[1]["passed"], got[1]["overridden"]) == (True, True)
    assert (got[2]["passed"], got[2]["can_override"]) == (False, True)
    assert got[3]["passed"] is True  # no declared total: the computed one stands in
    assert not rules.verdicts(frame, strict=True).where("rule_id = 'RULE2' and passed").count()


def test_dashboard_filters(spark):
    frame = spark.createDataFrame([(1, "NSE", "ABC", "Alpha", "FINALIZED", 1, [("free",)]), (2, "BSE", "XYZ", None, "NEW", 0, [])], "id long, exchange string, symbol string, company_name string, status string, manual_reviewed int, lots array<struct<bucket:string>>")
    ids = lambda **k: [r["id"] for r in calendar.shown(frame, **k).orderBy("id").collect()]
    assert ids(text="alph") == [1] and ids(exchange="BSE") == [2] and ids(finalized=False) == [2] and ids(reviewed=True) == [1] and ids(bucket="free") == [1] and ids(hide_blank=True) == [1]


def test_files(spark, tmp_path):
    lockins, shps = tmp_path / "nse/pdf/lockin/txt", tmp_path / "nse/pdf/shp/txt"
    lockins.mkdir(parents=True)
    shps.mkdir(parents=True)
    (lockins / "ABC-CML12_java.txt").write_text("line 1\r\nline 2")
    (shps / "SHP-ABC_java.txt").write_bytes(b"x \xff y")
    got = {r["kind"]: r for r in filings.read_texts(spark, str(tmp_path), lenient=True).collect()}
    assert (got["lockin"]["symbol"], got["lockin"]["code"], got["lockin"]["exchange"], got["lockin"]["text"]) == ("ABC", "12", "NSE", "line 1\nline 2")
    assert got["shp"]["symbol"] == "ABC"
    rows = filings.read_texts(spark, str(lockins))
    assert [r["pos"] for r in rows.select(F.posexplode(F.split("text", "\n"))).collect()] == [0, 1]
    both = filings.pattern_file(rows, filings.read_texts(spark, str(shps), lenient=True)).first()
    assert both["shp_path"].endswith("SHP-ABC_java.txt")
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("CML12.txt", "lock")
        z.writestr("readme.md", "no")
        z.writestr("SHP-ABC.txt", "hold")
    assert sorted((r["member"], bytes(r["content"])) for r in filings.read_zips(spark, str(tmp_path)).collect()) == [("CML12.txt", b"lock"), ("SHP-ABC.txt", b"hold")]


def test_stream(spark, tmp_path):
    source = tmp_path / "in/bse/x"
    source.mkdir(parents=True)
    (source / "1-A-Annexure-I_java.txt").write_text("1,000   1   1,000   Lock-in   01-Jan-2024   01-Jan-2027   Demat\n1,000   Total\n")
    for _ in range(2):  # nothing is read twice
        feed.ingest(spark, str(tmp_path / "in"), str(tmp_path / "ledger"), str(tmp_path / "check")).awaitTermination()
    assert [r["shares"] for r in feed.current(spark, str(tmp_path / "ledger")).collect()] == [1000]


def test_windows(spark, tmp_path):
    t = datetime.datetime(2024, 1, 1)
    rows = [(i, t + datetime.timedelta(minutes=20 * i), i % 2, "a", 1.0) for i in range(6)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(str(tmp_path / "e"))
    events = spark.readStream.schema("event_id long, ts timestamp, user_id long, event_type string, value double").parquet(str(tmp_path / "e"))
    q = feed.windowed(events).writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r["n"] for r in spark.table("w").collect()) == [3, 3]


def test_strict_form(spark):
    """Missing figures are zero; only the stored allotment date counts, whatever reference date a record has."""
    from lotloom.operators import rules

    kind = "id long, exchange string, computed_total long, locked_total long, free_total long, declared_total long, text_total long, shp_total_shares long, shp_locked_shares long, shp_promoter_shares long, shp_public_shares long, shp_others_shares long, allotment_date date, reference_date date, anchor_letter_url string"
    day = datetime.date
    rows = [(1, "NSE", 0, 0, 0, None, None, None, None, None, None, None, day(2024, 1, 1), day(2026, 1, 1), "u"), (2, "NSE", 5, 5, 0, 5, None, 5, 5, 5, 0, 0, None, day(2020, 1, 1), "u"), (3, "BSE", 5, 5, 0, 6, 5, 5, 5, 5, 0, 0, day(2026, 1, 1), None, None)]
    lots = [(2, 5, "locked", "ANCHOR_30", None, day(2019, 1, 1), 1, 5), (3, 5, "LOCKED", None, None, day(2025, 1, 1), 1, 5)]
    records = spark.createDataFrame(rows, kind)
    lots = spark.createDataFrame(lots, "processing_log_id long, shares long, status string, bucket string, lockin_date_from date, lockin_date_to date, distinctive_from long, distinctive_to long")
    got = {r["id"]: r["failed_rules"] for r in rules.counted(rules.stored(records, lots), strict=True).collect()}
    assert got == {1: "", 2: "RULE6", 3: "RULE2,RULE8"}
    say = {r["id"]: r["m"] for r in rules.stored(records, lots).select("id", rules.one("RULE6")["message"].alias("m")).collect()}
    assert say[1].endswith("(legacy NSE exception: allotment_date 2024-01-01 <= 2024-12-02)") and "anchor_90" in say[2] and say[3] == "No anchor letter URL and no anchor rows (correct)"


def test_lots_and_records_are_dealt_to_bounded_tasks(spark, monkeypatch):
    """More lines make more tasks, whatever the session's number of partitions, and each record is in one of them."""
    from lotloom.operators import adapter

    monkeypatch.setattr(adapter, "TASK_LINES", 500)
    lots, log = adapter.lots(spark, "/root/testdata/sf0.001"), adapter.log(spark, "/root/testdata/sf0.001")
    assert lots.rdd.getNumPartitions() == log.rdd.getNumPartitions() == -(-lots.count() // 500) > 8
