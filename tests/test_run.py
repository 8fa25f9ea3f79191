"""A folder of filings through to the ledger, and sources that need files."""

import datetime
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from lotloom import run
from lotloom.operators import ledger
from lotloom.operators.store import Store, parts, records
from lotloom.sources import filings

GOOD = "Annexure I of a company whose lots are all in order\nNo. of Equity Shares   From   To   Lock in upto\n6,000   1   6,000   08-Oct-2026\n4,000   6,001   10,000   Free\n10,000   Total\n"
SPLIT = "(A) Promoter & Promoter Group     3     5,000\n(B) Public     90     4,500\n(C) Non Promoter Non Public     1     500\nTotal     94     10,000     6,000\n"
MASTER = "company_name string, url_slug string, bse_script_code string, nse_symbol string, allotment_date date, listing_date_actual date, expected_listing_date date, post_issue_shares bigint, anchor_letter_url string"


@pytest.fixture()
def folder(tmp_path):
    files = {
        "nse/lockin/GOOD-CML1_java.txt": GOOD, "nse/shp/SHP-GOOD_java.txt": SPLIT, "nse/lockin/ODD-CML2_java.txt": GOOD, "nse/shp/SHP-ODD_java.txt": SPLIT, "nse/lockin/EMPTY-CML3_java.txt": "--- PAGE 1 ---\n#####\n",
    }
    for name, content in files.items():
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_text(content)
    return tmp_path


def at(day):
    return F.lit(f"2026-01-{day:02d} 00:00:00").cast("timestamp_ntz")


def test_run_folder(spark, folder):
    day = datetime.date(2025, 10, 1)
    master = spark.createDataFrame([("Good", "good_ipo", None, "GOOD", day, None, None, 10000, None), ("Odd", "odd_ipo", None, "ODD", day, None, None, 11000, None)], MASTER)
    out = str(folder / "out")
    found = {r["finalized"]: r["symbols"] for r in run.run_folder(spark, str(folder / "in"), master, out, at(1)).collect()}
    assert found == {True: ["NSE:GOOD", "NSE:ODD"], False: ["NSE:EMPTY"]}  # ODD's document agrees with itself and the pattern, so the master gives way
    log = {r["unique_symbol"]: r for r in spark.read.parquet(f"{out}/log").collect()}
    assert log["NSE:EMPTY"]["error_message"].startswith("Blank lock-in file") and log["NSE:EMPTY"]["failed_rules"] is None
    assert (log["NSE:GOOD"]["computed_total"], log["NSE:GOOD"]["locked_total"], log["NSE:GOOD"]["shp_locked_shares"]) == (10000, 6000, 6000)
    assert '"_strategies"' in log["NSE:GOOD"]["validation_results"]
    assert spark.read.parquet(f"{out}/lots").count() == 4
    store, work = Store(spark, out), lambda: len(Store(spark, f"{out}/stages").commits())
    done = work()
    # finalized records are left alone until they are rolled back
    again = {r["finalized"]: r["n"] for r in run.run_folder(spark, str(folder / "in"), master, out, at(2)).collect()}
    assert again == {False: 1} and work() == done  # nothing was extracted anew
    assert run.roll_back(spark, out, "NSE:ODD", at(3)) == 1 and run.roll_back(spark, out, "NSE:ODD", at(4)) == 0
    once_more = {r["finalized"]: r["symbols"] for r in run.run_folder(spark, str(folder / "in"), master, out, at(5)).collect()}
    assert once_more == {True: ["NSE:ODD"], False: ["NSE:EMPTY"]} and work() == done
    # versions follow each other, and each record has the lots of its newest reading only
    now = {r["unique_symbol"]: (r["version"], r["status"]) for r in records(store).collect()}
    assert now == {"NSE:GOOD": (1, "FINALIZED"), "NSE:ODD": (3, "FINALIZED"), "NSE:EMPTY": (3, "VALIDATING")}
    assert parts(store, "lots", "processing_log_id").count() == 4 and parts(store, "verdicts", "id").groupBy("id", "rule_id").count().where("count > 1").isEmpty()
    # back to the first run, lots and verdicts included; a dry run stores nothing
    assert run.roll_back(spark, out, "NSE:ODD", at(6), as_of=1) == 1
    assert records(store).where("unique_symbol = 'NSE:ODD'").select("version", "status", "parts_version").first() == (4, "FINALIZED", 1)
    head = store.head()
    run.run_folder(spark, str(folder / "in"), master, out, at(7), dry=True).collect()
    assert store.head() == head and parts(store, "lots", "processing_log_id").count() == 4
    assert run.roll_back(spark, str(folder / "none"), "NSE:ODD", at(8)) == 0


def test_overrides_need_permission(spark, folder):
    """A negative lock period may be overridden by hand, a wrong sum may not."""
    day = datetime.date(2027, 1, 1)  # after the lots end
    master = spark.createDataFrame([("Good", None, None, "GOOD", day, None, None, 10000, None)], MASTER)
    wanted = spark.createDataFrame([("NSE:GOOD", "RULE8", "seen"), ("NSE:GOOD", "RULE7", "seen")], "unique_symbol string, rule_id string, reason string")
    for overrides, failed in ((None, {"RULE7", "RULE8"}), (wanted, {"RULE7"})):
        records, _, verdicts = run.processed(*(filings.read_texts(spark, str(folder / "in")).where(f"kind = '{k}' and path like '%GOOD%'") for k in ("lockin", "shp")), master, at(1), overrides)
        row = records.first()
        assert set(row["failed_rules"].split(",")) == failed and row["status"] == "VALIDATING"
        assert {r["override_reason"] for r in verdicts.where("overridden").collect()} == ({"seen"} if overrides is not None else set())


def test_archives_and_listing(spark, tmp_path):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("a/CML12.pdf", b"one")
        z.writestr("SHP_X.txt", b"two")
        z.writestr("readme.txt", b"no")
    (tmp_path / "x.zip").write_bytes(data.getvalue())
    (tmp_path / "broken.zip").write_bytes(b"not a zip")
    got = sorted((r["member"], bytes(r["content"]) if r["content"] is not None else None, r["error"] is None) for r in filings.read_zips(spark, str(tmp_path)).collect())
    assert got == [("", None, False), ("SHP_X.txt", b"two", True), ("a/CML12.pdf", b"one", True)]


def test_database(spark):
    url = "jdbc:derby:memory:lotloom;create=true"
    rows = spark.createDataFrame([(i, f"r{i}") for i in range(40)], "id long, name string")
    rows.write.format("jdbc").option("url", url).option("dbtable", "records").option("driver", "org.apache.derby.iapi.jdbc.AutoloadedDriver").save()
    whole = filings.read_database(spark, url, "records", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    ranged = filings.read_database(spark, url, "records", "id", (0, 40), 4, driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    assert whole.where("id < 10").count() == 10 and ranged.count() == 40 and ranged.rdd.getNumPartitions() == 4


def test_script_of_tables(spark):
    assert ledger.create_tables(spark, "CREATE TABLE IF NOT EXISTS lotloom_t (id BIGINT);;\n") == 1
    assert spark.table("lotloom_t").columns == ["id"]
    spark.sql("DROP TABLE lotloom_t")
