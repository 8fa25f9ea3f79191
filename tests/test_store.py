"""Commits of the ledger: runs, crashes, rollbacks, conflicts, the feed by changes, work done once, streams."""

import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lotloom.operators import changes, stages
from lotloom.operators.store import Conflict, Store, parts, records, rolled_back, saved
from lotloom.streaming import feed

LOG = "id long, exchange string, file_name string, unique_symbol string, status string, error_message string, finalized_at timestamp_ntz"
LOTS = "processing_log_id long, row_order int, shares long"


def now():
    return F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")


def rows(spark, *ids, status="VALIDATING"):
    return spark.createDataFrame([(i, "NSE", f"f{i}.pdf", f"NSE:{i % 2}", status, None, None) for i in ids], LOG)


def lots(spark, shares, *ids):
    return spark.createDataFrame([(i, k, shares + k) for i in ids for k in range(2)], LOTS)


def state(store, as_of=None):
    found = records(store, as_of)
    own = {} if found is None else {r["id"]: (r["version"], r["status"]) for r in found.collect()}
    held = parts(store, "lots", "processing_log_id", as_of)
    of = {}
    for r in held.collect() if held is not None else ():
        of.setdefault(r["processing_log_id"], []).append(r["shares"])
    return {i: (*own[i], sorted(of.get(i, []))) for i in own}


def test_runs_crash_and_roll_back(spark, tmp_path):
    store = Store(spark, str(tmp_path / "ledger"))
    assert store.head() == 0 and state(store) == {} and rolled_back(store, F.lit(True), 1, now()) == 0
    assert saved(store, rows(spark, 1, 2), lots(spark, 10, 1, 2), None, now()) == 1
    assert saved(store, rows(spark, 2, 3, status="FINALIZED"), lots(spark, 20, 2, 3), None, now()) == 2
    third = {1: (1, "VALIDATING", [10, 11]), 2: (2, "FINALIZED", [20, 21]), 3: (1, "FINALIZED", [20, 21])}
    assert state(store) == third
    # a run that dies between its tables leaves files that nobody sees, and the next one takes its number
    lots(spark, 99, 1).withColumn("version", F.lit(2)).write.parquet(f"{store.path}/lots/commit=3/try=tdead")
    assert state(store) == third
    assert rolled_back(store, F.col("id") > 1, 1, now()) == 2
    back = {1: (1, "VALIDATING", [10, 11]), 2: (3, "VALIDATING", [10, 11]), 3: (2, "NEW", [])}
    assert store.head() == 3 and state(store) == back
    assert state(store, 1) == {1: (1, "VALIDATING", [10, 11]), 2: (1, "VALIDATING", [10, 11])} and state(store, 2) == third
    # the next run follows the rollback's versions, under the ids that are stored
    moved = rows(spark, 3).withColumn("id", F.lit(77).cast("long"))
    assert saved(store, moved, lots(spark, 30, 77), None, now()) == 4
    assert state(store)[3] == (3, "VALIDATING", [30, 31]) and 77 not in state(store)


def test_two_writers(spark, tmp_path):
    a, b = (Store(spark, str(tmp_path / "ledger")) for _ in range(2))
    base = a.head()
    saved(a, rows(spark, 1), lots(spark, 1, 1), None, now(), base=base)
    with pytest.raises(Conflict):
        saved(b, rows(spark, 1), lots(spark, 5, 1), None, now(), base=base)
    assert state(a) == {1: (1, "VALIDATING", [1, 2])} and len(b.commits()) == 1
    assert [saved(b, rows(spark, 1), lots(spark, 5, 1), None, now(), key="batch 7") for _ in range(2)] == [2, 2]
    assert state(a)[1][0] == 2


def test_repeated_rows_and_nulls(spark, tmp_path):
    """Of equal keys in a run one counts; null file names are a key of their own; an empty run is a commit without rows."""
    store = Store(spark, str(tmp_path / "ledger"))
    twice = rows(spark, 1).unionByName(rows(spark, 1)).unionByName(rows(spark, 9).withColumn("file_name", F.lit(None).cast("string")))
    saved(store, twice, lots(spark, 1, 1), None, now())
    assert state(store) == {1: (1, "VALIDATING", [1, 2]), 9: (1, "VALIDATING", [])}
    saved(store, rows(spark, 1).limit(0), lots(spark, 1, 1).limit(0), None, now())
    assert state(store) == {1: (1, "VALIDATING", [1, 2]), 9: (1, "VALIDATING", [])}


def test_work_is_done_once(spark, tmp_path):
    store, asked = Store(spark, str(tmp_path / "stages")), []

    def work(fresh):
        asked.append(sorted(r["text"] or "" for r in fresh.collect()))
        return fresh.withColumn("n", F.length("text"))

    texts = spark.createDataFrame([(1, "one", "x"), (2, "one", "y"), (3, None, "x"), (4, "", "x")], "id long, text string, n_ string")
    get = lambda df, v: {r["id"]: r["n"] for r in stages.once(store, "n", v, df, ("text",), work).collect()}
    assert get(texts, "1") == {1: 3, 2: 3, 3: None, 4: 0} and asked == [["", "", "one"]]
    more = texts.unionByName(spark.createDataFrame([(5, "three", "x")], "id long, text string, n_ string"))
    assert get(texts, "1") == {1: 3, 2: 3, 3: None, 4: 0} and len(asked) == 1
    assert get(more, "1")[5] == 5 and asked[1:] == [["three"]]
    assert get(more, "2")[1] == 3 and asked[2:] == [["", "", "one", "three"]]
    assert stages.once(Store(spark, str(tmp_path / "none")), "n", "1", texts.limit(0), ("text",), lambda f: f.withColumn("n", F.length("text"))).count() == 0


EVENT_LOG = LOG + ", locked_total long, free_total long, shp_promoter_shares long, shp_public_shares long, shp_others_shares long, shp_total_shares long"
EVENT_LOTS = "processing_log_id long, row_order int, shares long, status string, bucket string, lockin_date_from date, lockin_date_to date"


def test_feed_by_changes(spark, tmp_path):
    from lotloom.operators import calendar

    ledger, own = Store(spark, str(tmp_path / "ledger")), Store(spark, str(tmp_path / "feed"))
    master = spark.createDataFrame([("Zero", None, "0", None, 5), ("One", None, "1", None, 6)], "company_name string, bse_script_code string, nse_symbol string, ipo_name string, post_issue_shares bigint")
    day = datetime.date(2026, 5, 1)
    assert changes.update(own, ledger) == 0 and changes.events(own, master) is None and changes.since(own, 0) is None
    for n, (ids, shares) in enumerate([((1, 2, 3), 10), ((2, 4), 20), ((4,), 0), ((1, 2, 3, 4, 5), 30)], 1):
        log = spark.createDataFrame([(i, "NSE", f"f{i}", f"NSE:{i % 2}", "VALIDATING", None, None, 1, 2, 3, 4, 5, i) for i in ids], EVENT_LOG)
        some = spark.createDataFrame([(i, k, shares + i, "LOCKED", "anchor_30", day, day + datetime.timedelta(30 + k)) for i in ids for k in range(2 if shares else 0)], EVENT_LOTS)
        saved(ledger, log, some, None, F.lit(f"2026-01-{n:02d} 00:00:00").cast("timestamp_ntz"))
        before = changes.events(own, master)
        seen = own.head()
        assert changes.update(own, ledger) == n == changes.update(own, ledger)
        want = calendar.unlock_events(records(ledger), parts(ledger, "lots", "processing_log_id"), master)
        got = changes.events(own, master)
        assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect())), n
        delta = changes.since(own, seen)
        names = [c for c in delta.columns if c != "change"]
        applied = delta if before is None else delta.unionByName(before.select(*names).withColumn("change", F.lit(1)))
        kept = applied.groupBy(*names).agg(F.sum("change").alias("c")).where("c > 0").select(*names)
        assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, got.select(*names).collect()))


GOOD = "Annexure I of a company whose lots are all in order\nNo. of Equity Shares   From   To   Lock in upto\n6,000   1   6,000   08-Oct-2026\n4,000   6,001   10,000   Free\n10,000   Total\n"


def test_ingest_upserts(spark, tmp_path):
    """A changed file replaces its lots, a blank one loses them, an equal one adds nothing; a batch that is tried again happens once."""
    inbox, ledger, check = tmp_path / "in", str(tmp_path / "ledger"), str(tmp_path / "check")

    def deliver(folder, **texts):
        for name, content in texts.items():
            where = inbox / folder / "nse" / "lockin" / f"{name}_java.txt"
            where.parent.mkdir(parents=True, exist_ok=True)
            where.write_text(content)
        feed.ingest(spark, str(inbox), ledger, check).awaitTermination()
        out = {}
        named = feed.current(spark, ledger).join(records(Store(spark, ledger)).select(F.col("id").alias("processing_log_id"), "file_name"), "processing_log_id")
        for r in named.collect():
            out.setdefault(r["file_name"][0], []).append(r["shares"])
        return {k: sorted(v) for k, v in out.items()}

    assert deliver("a", A=GOOD, B=GOOD) == {"A": [4000, 6000], "B": [4000, 6000]}
    assert deliver("b", A=GOOD.replace("4,000   6,001   10,000", "5,000   6,001   11,000"), B="\n") == {"A": [5000, 6000]}
    versions = {r["file_name"][0]: (r["version"], r["computed_total"]) for r in records(Store(spark, ledger)).collect()}
    assert versions == {"A": (2, 11000), "B": (2, None)}
    commits = len(Store(spark, ledger).commits())
    assert deliver("c", B="\n") == {"A": [5000, 6000]} and len(Store(spark, ledger).commits()) == commits
    # the stream's own note of its last batch is lost, as when it dies right after the commit
    last = max((p for p in (tmp_path / "check" / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    for p in (last, last.with_name(f".{last.name}.crc")):
        p.unlink(missing_ok=True)
    assert deliver("d", C=GOOD) == {"A": [5000, 6000], "C": [4000, 6000]}
    assert {r["file_name"][0]: r["version"] for r in records(Store(spark, ledger)).collect()} == {"A": 2, "B": 2, "C": 1}


@pytest.mark.parametrize("order", [1, -1])
def test_newest_as_state(spark, tmp_path, order):
    """Whatever the order of arrival, the last row of each symbol is its newest record."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    base = datetime.datetime(2026, 1, 1)
    log = [(f"NSE:{i % 3}", i, "NEW" if i % 2 else "FINALIZED", base + datetime.timedelta(hours=i)) for i in range(30)]
    kind = "unique_symbol string, id long, status string, processed_at timestamp_ntz"
    for n, part in enumerate([log[i : i + 10] for i in range(0, 30, 10)][::order]):
        spark.createDataFrame([*part, (None, 99, "NEW", base)], kind).coalesce(1).write.parquet(str(tmp_path / f"in/{n}"))
    out: dict = {}

    def keep(batch, _):
        for r in batch.collect():
            out[r["unique_symbol"]] = (r["id"], r["status"])

    source = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    feed.newest_state(source, late="60 days").writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "c")).foreachBatch(keep).trigger(availableNow=True).start().awaitTermination()
    assert out == {f"NSE:{k}": (27 + k, "NEW" if (27 + k) % 2 else "FINALIZED") for k in range(3)}


def test_newest_as_state_asks_for_little():
    """A symbol that comes for the first time costs one reading and one writing of its state and no list of timers; of equal ids and times the larger state counts, none being the smallest."""
    calls = []

    class Kept:
        def get(self):
            calls.append("get")

        def update(self, value):
            calls.append("update")

    class Handle:
        def registerTimer(self, at):
            calls.append("timer")

    at = pd.Timestamp("2026-01-01")
    one = feed._Newest(0)
    one.kept, one.handle = Kept(), Handle()
    rows = pd.DataFrame({"id": [1, 2, 2], "status": ["X", "NEW", None], "processed_at": [at, at, at]})
    out = pd.concat(one.handleInputRows(("NSE:1",), iter([rows]), None))
    assert calls == ["get", "update", "timer"] and out[["id", "status", "settled"]].values.tolist() == [[2, "NEW", False]]


def test_newest_of_cells_is_that_of_symbols(spark, tmp_path):
    """Symbols kept together give the changes of symbols kept alone, batch by batch: ties, equal rows again, late rows, quiet ones, and newer ones after those."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    base, kind = datetime.datetime(2026, 1, 1), "unique_symbol string, id long, status string, processed_at timestamp_ntz"
    at = lambda minutes: base + datetime.timedelta(minutes=minutes)
    batches = [
        [("A", 1, "NEW", at(0)), ("A", 1, "OLD", at(5)), ("B", 7, None, at(1)), ("B", 7, "X", at(1)), ("C", 3, None, at(2)), ("D", 9, "NEW", at(400)), (None, 1, "x", at(1)), ("E", None, "x", at(1))],
        [("A", 2, "NEW", at(390)), ("B", 7, "X", at(1)), ("B", 7, "X", at(395)), ("D", 8, "y", at(402))],
        [("F", 1, "z", at(900)), ("C", 2, "w", at(899)), ("C", 4, "LATE", at(3))],
        [("A", 5, "q", at(905)), ("C", 3, None, at(905))],
    ]
    # files are taken by their time of change
    for n, part in enumerate(batches):
        spark.createDataFrame(part, kind).coalesce(1).write.parquet(str(tmp_path / f"in/{n}"))
    source = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))

    def changes_of(cells):
        out = []
        keep = lambda batch, n: out.extend((n, *r) for r in batch.collect())
        stream = feed.newest_state(source, late="1 hour", quiet="2 hours", cells=cells).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / f"c{cells}"))
        stream.foreachBatch(keep).trigger(availableNow=True).start().awaitTermination()
        return sorted(out, key=str)

    alone = changes_of(None)
    assert {r[1] for r in alone if r[-1]} == {"B", "C", "D"} and not any(r[3] == "LATE" for r in alone)
    assert changes_of(2) == alone


def test_newest_of_a_cell_asks_for_little():
    """However many symbols a cell has, its state is read and written once and one timer is set; without anything newer nothing is written."""
    calls, state = [], []

    class Kept:
        def get(self):
            calls.append("get")
            return iter(state)

        def put(self, rows):
            calls.append("put")
            state[:] = rows

    class Handle:
        def listTimers(self):
            return iter([5])

        def deleteTimer(self, at):
            calls.append("delete")

        def registerTimer(self, at):
            calls.append(at)

    cell = feed._NewestOfCell(1000)
    cell.kept, cell.handle = Kept(), Handle()
    rows = pd.DataFrame({"unique_symbol": [f"S{i}" for i in range(500)] * 2, "id": range(1000), "status": [None, "NEW"] * 500, "processed_at": pd.Timestamp("1970-01-01 00:00:02")})
    out = pd.concat(cell.handleInputRows((0,), iter([rows[:600], rows[600:]]), None))
    assert calls == ["get", "put", 3000] and len(out) == 500 and sorted(out["id"]) == list(range(500, 1000))
    assert state[0][0].startswith("S") and list(cell.handleInputRows((0,), iter([rows]), None)) == [] and calls[3:] == ["get"]
