"""Unlock events and groupings of lots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotloom.functions.classify import BUCKETS, bucket_order
from lotloom.operators.ledger import latest_ids
from lotloom.operators.master import with_master

LOCKED_BUCKETS = BUCKETS[:-1]
EXCHANGES, STATES = ("NSE", "BSE"), ("FINALIZED", "ANY")


def _wanted(exchange: str, status: str, since: str) -> tuple[str, str, str]:
    exchange, status, since = exchange.strip().upper(), (status.strip() or "ANY").upper(), since.strip() or "1970-01-01 00:00:00"
    if exchange and exchange not in EXCHANGES:
        raise ValueError(f"exchange must be one of {EXCHANGES}")
    if status not in STATES:
        raise ValueError(f"status must be one of {STATES}")
    return exchange, status, since


def unlock_events(log: DataFrame, lots: DataFrame, master: DataFrame, since: str = "", exchange: str = "", status: str = "ANY") -> DataFrame:
    """Shares that unlock by record, date and bucket, of the newest record of each symbol.

    The newest record is chosen by exchange alone, before status and ``since`` apply: a
    symbol whose newest record fails these is left out and doesn't fall back to an older one.
    """
    exchange, status, since = _wanted(exchange, status, since)
    seen = F.coalesce("updated_at", "processed_at")
    records = log.join(latest_ids(log, exchange or None), ["unique_symbol", "id"], "left_semi").where(seen > F.lit(since).cast("timestamp_ntz"))
    if exchange:
        records = records.where(F.col("exchange") == exchange)
    if status == "FINALIZED":
        records = records.where(F.col("status") == "FINALIZED")
    locked = lots.where((F.col("status") == "LOCKED") & F.col("lockin_date_to").isNotNull() & F.col("bucket").isin(*LOCKED_BUCKETS))
    by_event = locked.groupBy("processing_log_id", "lockin_date_to", "bucket").agg(F.sum("shares").alias("shares_unlocked"), F.min("lockin_date_from").alias("lock_from"))
    out = with_master(records.withColumn("last_updated", seen), master).join(by_event, F.col("id") == F.col("processing_log_id"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    totals = {"locked_shares": "locked_total", "free_shares": "free_total", "promoter_shares": "shp_promoter_shares", "public_shares": "shp_public_shares", "others_shares": "shp_others_shares", "total_shares": "shp_total_shares"}
    return out.select(
        F.col("id").alias("processing_id"), "unique_symbol", "exchange", "file_name", (log["status"] == "FINALIZED").cast("int").alias("finalized"), *(zero(c).alias(n) for n, c in totals.items()),
        F.coalesce("company_name", "ipo_name").alias("company_name"), F.col("lockin_date_to").alias("unlock_date"), "bucket", "shares_unlocked", "lock_from", "last_updated",
    )


def in_feed_order(events: DataFrame) -> DataFrame:
    return events.orderBy("processing_id", "unlock_date", bucket_order(F.col("bucket")))


def nested_events(events: DataFrame) -> DataFrame:
    """One row per record with its events as an array, by date and bucket."""
    own = ("unlock_date", "bucket", "shares_unlocked", "lock_from")
    keys = [c for c in events.columns if c not in own]
    ordered = F.array_sort(F.collect_list(F.struct("unlock_date", bucket_order(F.col("bucket")).alias("place"), "bucket", "shares_unlocked", "lock_from")))
    return events.groupBy(*keys).agg(F.transform(ordered, lambda e: F.struct(*(e[c].alias(c) for c in own))).alias("unlock_events"))


def feed_json(events: DataFrame) -> DataFrame:
    """Each record of the feed as one JSON text."""
    return nested_events(events).select("processing_id", F.to_json(F.struct("*")).alias("json"))


def grouped_lots(lots: DataFrame) -> DataFrame:
    """Lots by record, end, state and bucket with the days from their first start."""
    out = lots.groupBy("processing_log_id", "lockin_date_to", "status", "bucket").agg(F.min("lockin_date_from").alias("lock_from"), F.min("security_type").alias("type_raw"), F.sum("shares").alias("shares"), F.count("*").alias("n"))
    return out.select("processing_log_id", F.col("lockin_date_to").alias("lock_upto"), F.lower("status").alias("row_class"), F.lower("bucket").alias("lock_bucket"), "lock_from", F.date_diff("lockin_date_to", "lock_from").alias("days_locked"), "type_raw", "shares", "n")


def grouped_totals(grouped: DataFrame) -> DataFrame:
    """Locked and free shares of each record from its grouped lots; anchor lots count as locked."""
    part = lambda *kinds: F.coalesce(F.sum(F.when(F.col("row_class").isin(*kinds), F.col("shares"))), F.lit(0))
    return grouped.groupBy("processing_log_id").agg(part("locked", "anchor").alias("locked_shares"), part("free").alias("free_shares"))


def single_lots(lots: DataFrame) -> DataFrame:
    return lots.select("processing_log_id", "row_order", F.col("lockin_date_from").alias("lock_from"), F.col("lockin_date_to").alias("lock_upto"), F.lower("status").alias("row_class"), F.lower("bucket").alias("lock_bucket"), F.date_diff("lockin_date_to", "lockin_date_from").alias("days_locked"), F.col("security_type").alias("type_raw"), "shares", F.lit(1).alias("n"))


def totals(lots: DataFrame) -> DataFrame:
    """Sums and counts of each record's lots, and how many disagree with their distinctive numbers."""
    part = lambda s: F.coalesce(F.sum(F.when(F.col("status") == s, F.col("shares"))), F.lit(0))
    count = lambda c: F.count_if(c)
    out = lots.groupBy("processing_log_id").agg(F.sum("shares").alias("computed_total"), part("LOCKED").alias("locked_total"), part("FREE").alias("free_total"), F.count("*").alias("rows"), count(F.col("status") == "FREE").alias("free_rows"), count(F.col("status") == "LOCKED").alias("locked_rows"))
    return out


def bucket_counts(lots: DataFrame) -> DataFrame:
    return lots.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("shares").alias("shares"))


def bucket_shares(lots: DataFrame) -> DataFrame:
    """Shares of each record by bucket and their permille of the record, rounded down."""
    by = lots.groupBy("processing_log_id", "bucket").agg(F.sum("shares").alias("shares"))
    # at most one row a bucket is left of a record, so its total comes from these
    parts = by.groupBy("processing_log_id").agg(F.sum("shares").alias("total"), F.collect_list(F.struct("bucket", "shares")).alias("parts"))
    rows = parts.select("processing_log_id", "total", F.explode("parts").alias("p")).select("processing_log_id", "total", "p.*")
    return rows.select("processing_log_id", "bucket", "shares", F.when(F.col("total") > 0, F.expr("shares * 1000 div total")).alias("permille"))


def has_bucket(lots: Column, bucket: str) -> Column:
    """Whether any lot of a nested array lies in a bucket."""
    return F.exists(lots, lambda r: r["bucket"] == bucket)


def shown(records: DataFrame, text: str = "", exchange: str = "", finalized: bool | None = None, reviewed: bool | None = None, bucket: str = "", hide_blank: bool = False, status: str = "", within: tuple[str, ...] = ("symbol", "company_name")) -> DataFrame:
    """The dashboard's filters over records with nested lots; ``text`` is looked for in the columns ``within``, whatever its case."""
    if text:
        found = F.lit(False)
        for name in within:
            found = found | F.lower(F.coalesce(F.col(name).cast("string"), F.lit(""))).contains(text.lower())
        records = records.where(found)
    if status:
        records = records.where(F.col("status") == status)
    if exchange:
        records = records.where(F.col("exchange") == exchange)
    if finalized is not None:
        records = records.where((F.col("status") == "FINALIZED") == finalized)
    if reviewed is not None:
        records = records.where(F.col("manual_reviewed").cast("boolean") == reviewed)
    if bucket:
        records = records.where(has_bucket(F.col("lots"), bucket))
    return records.where(F.size("lots") > 0) if hide_blank else records
