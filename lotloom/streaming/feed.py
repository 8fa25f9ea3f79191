"""Streams: an extension of ours. A folder of filings becomes versions of the ledger, events become windows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from lotloom.functions.text import plain_breaks
from lotloom.operators.ledger import replaced_lots
from lotloom.operators.store import Store, parts, records, saved
from lotloom.plans import lockin
from lotloom.session import Scratch
from lotloom.sources.filings import exchange_of


def filings(spark: SparkSession, path: str, glob: str = "*_java.txt", files_per_trigger: int = 1000) -> DataFrame:
    """New text files below ``path``, each once, as path, exchange, text. Bytes that aren't UTF-8 give a mark. Files of no bytes at all are passed over by Spark's file sources."""
    files = spark.readStream.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_trigger)
    kind = "path string, modificationTime timestamp, length long, content binary"
    rows = files.schema(kind).load(path).select("path", plain_breaks(F.make_valid_utf8(F.col("content").cast("string"))).alias("text"))
    return rows.withColumn("exchange", exchange_of(F.col("path")))


def ingest(spark: SparkSession, path: str, ledger: str, checkpoint: str) -> StreamingQuery:
    """Extract new filings into the ledger, a commit per batch.

    A file is known by its exchange and name, wherever it is delivered. One whose text is the stored one adds
    nothing; a changed one gets a new version with its own lots, and one that yields no lots any more, such as a
    blank one, a version with none, so that its old lots are no longer current. Commits bear the batch's
    number: a batch that is repeated after a failure finds its commit and adds nothing. The file source takes
    each path once; files that are changed in place are for ``lotloom.run``, which goes by content.
    """
    store = Store(spark, ledger)

    def write(batch: DataFrame, batch_id: int) -> None:
        name = F.substring_index("path", "/", -1)
        rows = batch.select(F.xxhash64("path").alias("id"), "exchange", name.alias("file_name"), F.col("path").alias("lockin_txt_java_path"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), "text")
        base, now = store.head(), F.current_timestamp().cast("timestamp_ntz")
        stored = records(store, base)
        if stored is not None:
            rows = rows.join(stored.select("exchange", "file_name", "text_sha256"), ["exchange", "file_name", "text_sha256"], "left_anti")
        read = Scratch(spark, "ingest").write(lockin.extract(rows, skip_blank=True), "read")
        lots = replaced_lots(read.select(F.col("id").alias("processing_log_id"), "lockin"), F.lit(1))
        totals = {"computed_total": "computed_total", "locked_total": "locked_shares", "free_total": "free_shares"}
        log = read.select("id", "exchange", "file_name", "lockin_txt_java_path", "text_sha256", F.lit("NEW").alias("status"), *(F.col(f"lockin.{c}").alias(n) for n, c in totals.items()))
        if not read.isEmpty():
            saved(store, log, lots, None, now, "ingest", f"{checkpoint}/{batch_id}", base)

    stream = filings(spark, path).writeStream.foreachBatch(write)
    return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, ledger: str) -> DataFrame | None:
    """Lots of the newest version of each file; None where nothing was ever ingested."""
    return parts(Store(spark, ledger), "lots", "processing_log_id")


def windowed(events: DataFrame, late: str = "1 hour", width: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Counts and sums by type and window of event time; events later than ``late`` are dropped by the watermark."""
    rows = events.withWatermark("ts", late)
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    return rows.groupBy(window.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value")).select("event_type", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "value")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of each user by gaps in event time."""
    rows = events.withWatermark("ts", late)
    return rows.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def newest_by_symbol(log: DataFrame, late: str = "1 day", width: str = "1 day") -> DataFrame:
    """The record with the largest id of each symbol within each window of processing time; windows that the watermark has passed are forgotten."""
    rows = log.withWatermark("processed_at", late).groupBy(F.window("processed_at", width).alias("w"), "unique_symbol")
    return rows.agg(F.max("id").alias("id"), F.max_by("status", "id").alias("status")).select(F.col("w.start").alias("start"), "unique_symbol", "id", "status")


NEWEST = "unique_symbol string, id long, status string, processed_at timestamp, settled boolean"


class _Newest(StatefulProcessor):
    """The record with the largest id of one symbol, kept as state."""

    def __init__(self, quiet_ms: int) -> None:
        self.quiet_ms = quiet_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("newest", "id long, status string, processed_at timestamp")

    def _row(self, key: tuple, kept: tuple, settled: bool) -> pd.DataFrame:
        id_, status, at = kept
        return pd.DataFrame({"unique_symbol": [key[0]], "id": [id_], "status": [status], "processed_at": [at], "settled": [settled]})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # a symbol has few rows, and each call of the state or of pandas costs more than comparing them
        before = self.kept.get()
        # of equal ids the later one counts, then the larger state, so that order doesn't matter
        order = lambda r: (r[0], pd.Timestamp(r[2]), r[1] or "")
        best = before
        for part in rows:
            last = max(zip(part["id"].tolist(), part["status"].tolist(), part["processed_at"].tolist()), key=order, default=None)
            if last is not None and (best is None or order(last) > order(best)):
                best = last
        if best is not before:
            self.kept.update(best)
            for timer in list(self.handle.listTimers()) if before is not None else ():
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(int(pd.Timestamp(best[2]).tz_localize("UTC").timestamp() * 1000) + self.quiet_ms)
            yield self._row(key, best, False)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """The symbol was quiet for so long that its record counts as settled. It stays in the state, for a late record may have a smaller id."""
        kept = self.kept.get()
        if kept is not None:
            yield self._row(key, kept, True)

    def close(self) -> None:
        pass


class _NewestOfCell(StatefulProcessor):
    """The same for all symbols of a cell at once: their records are one list, which is read and written as a whole, and one timer is set for the first that becomes due.

    Times are microseconds in the state, so that they needn't be converted one by one.
    """

    STATE = "unique_symbol string, id long, status string, at long, settled boolean"
    NAMES = ["unique_symbol", "id", "status", "at", "settled"]

    def __init__(self, quiet_ms: int) -> None:
        self.quiet_us = quiet_ms * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getListState("newest", self.STATE)

    def _read(self) -> pd.DataFrame:
        held = pd.DataFrame(list(self.kept.get()), columns=self.NAMES)
        return held.astype({"unique_symbol": object, "id": "int64", "status": object, "at": "int64", "settled": bool})

    def _write(self, held: pd.DataFrame) -> None:
        self.kept.put(list(zip(*(held[c].tolist() for c in self.NAMES))))
        waiting = held["at"][~held["settled"]]
        if len(waiting):
            self.handle.registerTimer((int(waiting.min()) + self.quiet_us) // 1000)

    @staticmethod
    def _rows(held: pd.DataFrame) -> pd.DataFrame:
        return held[["unique_symbol", "id", "status", "settled"]].assign(processed_at=pd.to_datetime(held["at"], unit="us"))[["unique_symbol", "id", "status", "processed_at", "settled"]]

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self._read()
        best = before.assign(fresh=False)
        for part in rows:
            at = part["processed_at"].astype("datetime64[us]").astype("int64")
            more = pd.DataFrame({"unique_symbol": part["unique_symbol"].astype(object), "id": part["id"], "status": part["status"].astype(object).where(part["status"].notna(), None), "at": at, "settled": False, "fresh": True})
            # what was there comes last, so that of equal rows it stays
            both = pd.concat([more, best], ignore_index=True) if len(best) else more
            rank = both.assign(status=both["status"].fillna("")).sort_values(["id", "at", "status"], kind="stable")
            best = both.loc[rank.drop_duplicates("unique_symbol", keep="last").index]
        fresh = best[best["fresh"]]
        if len(fresh):
            for timer in list(self.handle.listTimers()) if len(before) else ():
                self.handle.deleteTimer(timer)
            self._write(best)
            yield self._rows(fresh)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """All symbols of the cell that were quiet for so long count as settled, and stay in the state."""
        held = self._read()
        due = ~held["settled"] & ((held["at"] + self.quiet_us) // 1000 <= timerValues.getCurrentWatermarkInMs())
        if due.any():
            held.loc[due, "settled"] = True
            self._write(held)
            yield self._rows(held[due])

    def close(self) -> None:
        pass


#: Rows for which a cell is reckoned where a whole table comes at once.
CELL_ROWS = 5_000


def newest_state(log: DataFrame, late: str = "1 day", quiet: str = "7 days", cells: int | None = None) -> DataFrame:
    """The record with the largest id of each symbol (unique_symbol, id, status, processed_at), as a stream of changes.

    Each row replaces the one of its symbol before it. A row comes when a larger id does, and once more, ``settled``,
    when the watermark (``late`` behind the newest time) is ``quiet`` past the record's time. State is one
    record a symbol, in the state store, which must be RocksDB. The last row of each symbol is the same for any
    order of arrival. Rows without symbol, id or time are left out.

    Each symbol is a call of Python and of the state, which suits batches of few symbols. With ``cells`` symbols are dealt by their hash to so
    many groups, each one call; a batch rewrites the records of all cells it touches, which suits batches of many symbols. The number must stay the same for a checkpoint.
    """
    quiet_ms = int(pd.Timedelta(quiet).total_seconds() * 1000)
    rows = log.where("unique_symbol is not null and id is not null and processed_at is not null").select("unique_symbol", F.col("id").cast("long").alias("id"), "status", F.col("processed_at").cast("timestamp").alias("processed_at"))
    keyed = rows.withWatermark("processed_at", late)
    if cells is None:
        return keyed.groupBy("unique_symbol").transformWithStateInPandas(_Newest(quiet_ms), NEWEST, "update", "eventTime")
    dealt = keyed.withColumn("cell", F.pmod(F.xxhash64("unique_symbol"), F.lit(cells)))
    return dealt.groupBy("cell").transformWithStateInPandas(_NewestOfCell(quiet_ms), NEWEST, "update", "eventTime")
