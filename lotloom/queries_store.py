"""Queries of the ledger's commits: runs, rollbacks, earlier states, the feed by changes, work done once, state of streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotloom.operators import adapter, changes, ledger, stages
from lotloom.operators.store import Store, parts, records, rolled_back, saved
from lotloom.queries import _events_sql
from lotloom.registry import LOG, LOTS, query
from lotloom.session import Scratch, table, tasks
from lotloom.streaming import feed


def _at(day: int) -> Column:
    return F.lit(f"2020-01-{day:02d} 00:00:00").cast("timestamp_ntz")


def _two_runs(spark: SparkSession, d: str) -> Store:
    """Even records in a first run, every third one in a second with other lots and state; then a run that dies, and a rollback of some records to the first."""
    store = Store(spark, Scratch(spark, "store").path("ledger"))
    log = adapter.log(spark, d).where("exchange = 'NSE'").select("id", "exchange", "file_name", "unique_symbol", "status", "computed_total")
    lots = adapter.lots(spark, d).select("processing_log_id", "row_order", "shares")
    saved(store, log.where("id % 2 = 0"), lots, None, _at(1))
    other = lots.where("row_order % 2 = 1").withColumn("shares", F.col("shares") + 1)
    saved(store, log.where("id % 3 = 0").withColumn("status", F.lit("FINALIZED")), other, None, _at(2))
    lots.withColumn("version", F.lit(9)).write.parquet(f"{store.path}/lots/commit=3/try=tdead")  # its manifest never comes
    rolled_back(store, F.expr("id % 12 = 0 or id % 9 = 0"), 1, _at(3))
    return store


_LOT_SUMS = "SELECT processing_log_id AS id, count(*) AS lots, sum(shares)::BIGINT AS shares, count(*) FILTER (row_order % 2 = 1) AS odd_lots, coalesce(sum(shares + 1) FILTER (row_order % 2 = 1), 0)::BIGINT AS odd_shares FROM lots GROUP BY 1"
_HISTORY = f"""{LOG}, s AS ({_LOT_SUMS}), r AS (SELECT log.id, status, coalesce(lots, 0) AS lots, coalesce(shares, 0) AS shares, coalesce(odd_lots, 0) AS odd_lots, coalesce(odd_shares, 0) AS odd_shares FROM log LEFT JOIN s ON log.id = s.id WHERE exchange = 'NSE'),
first AS (SELECT id, 1 AS version, status, lots, shares FROM r WHERE id % 2 = 0),
second AS (SELECT id, version, status, lots, shares FROM first WHERE id % 3 > 0 UNION ALL SELECT id, CASE WHEN id % 2 = 0 THEN 2 ELSE 1 END, 'FINALIZED', odd_lots, odd_shares FROM r WHERE id % 3 = 0),
third AS (SELECT second.id, CASE WHEN back THEN second.version + 1 ELSE second.version END AS version, CASE WHEN back THEN coalesce(first.status, 'NEW') ELSE second.status END AS status,
    CASE WHEN back THEN coalesce(first.lots, 0) ELSE second.lots END AS lots, CASE WHEN back THEN coalesce(first.shares, 0) ELSE second.shares END AS shares
    FROM (SELECT *, id % 12 = 0 OR id % 9 = 0 AS back FROM second) second LEFT JOIN first ON first.id = second.id)"""


@query(f"{_HISTORY} SELECT id, version, status, lots, shares FROM third")
def ledger_after_runs(spark: SparkSession, d: str) -> DataFrame:
    """Versions, states and lots of all records after two runs, a crash and a rollback."""
    return _with_lots(_two_runs(spark, d), None)


@query(f"{_HISTORY} SELECT 1 AS as_of, * FROM first UNION ALL SELECT 2, * FROM second UNION ALL SELECT 3, * FROM third")
def ledger_as_of(spark: SparkSession, d: str) -> DataFrame:
    """The same records as they were after each commit."""
    store = _two_runs(spark, d)
    return reduce(DataFrame.unionByName, (_with_lots(store, n).withColumn("as_of", F.lit(n)) for n in (1, 2, 3)))


def _with_lots(store: Store, as_of: int | None) -> DataFrame:
    sums = parts(store, "lots", "processing_log_id", as_of).groupBy(F.col("processing_log_id").alias("id")).agg(F.count("*").alias("lots"), F.sum("shares").alias("shares"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return records(store, as_of).join(sums, "id", "left").select("id", "version", "status", zero("lots"), zero("shares"))


_BATCHED = _events_sql("AND p.exchange = 'NSE' AND NOT (p.id % 5 = 0 AND r.row_order % 2 = 0)", "WHERE exchange = 'NSE'")


@query(f"SELECT * EXCLUDE (last_updated) FROM ({_BATCHED})")
def feed_by_changes(spark: SparkSession, d: str) -> DataFrame:
    """The feed after three commits of the ledger, from what each of them changed: two halves, then a fifth again with fewer lots."""
    scratch = Scratch(spark, "feed")
    store, own = Store(spark, scratch.path("ledger")), Store(spark, scratch.path("feed"))
    log, lots = adapter.log(spark, d).where("exchange = 'NSE'").drop("processed_at", "updated_at"), adapter.lots(spark, d)
    for day, (some, held) in enumerate((("id % 2 = 0", "true"), ("id % 2 = 1", "true"), ("id % 5 = 0", "row_order % 2 = 1")), 1):
        saved(store, log.where(some), lots.where(held), None, _at(day))
        changes.update(own, store)
    return changes.events(own, adapter.master(spark, d)).drop("last_updated")


@query("""WITH t AS (SELECT DISTINCT coalesce(text, '') AS t, text IS NULL AS n FROM documents WHERE doc_id % 2 = 0), a AS (SELECT DISTINCT coalesce(text, '') AS t, text IS NULL AS n FROM documents)
SELECT doc_id, len(text)::INT AS chars, (SELECT count(*) FROM t) AS first, (SELECT count(*) FROM a) - (SELECT count(*) FROM t) AS second, 0::BIGINT AS third FROM documents""")
def work_done_once(spark: SparkSession, d: str) -> DataFrame:
    """A stage over half of the documents, over all, and over all again: how many contents each run worked on."""
    store, docs = Store(spark, Scratch(spark, "stages").path("stages")), table(spark, d, "documents").select("doc_id", "text")
    work = lambda fresh: fresh.withColumn("chars", F.length("text"))
    worked, out = [], docs
    for part in (docs.where("doc_id % 2 = 0"), docs, docs):
        before = store.head()
        out = stages.once(store, "chars", "1", part, ("text",), work)
        fresh = store.read("chars", after=before)
        worked.append(0 if fresh is None else fresh.count())
    return out.select("doc_id", "chars", *(F.lit(n).cast("long").alias(c) for n, c in zip(worked, ("first", "second", "third"))))


@query(f"{LOG} SELECT unique_symbol, max(id) AS id, arg_max(status, id) AS status FROM log GROUP BY 1")
def newest_by_state(spark: SparkSession, d: str) -> DataFrame:
    """The newest record of each symbol from a stream of all records, kept as state; the stream's changes, last one a symbol."""
    scratch, provider = Scratch(spark, "newest"), "spark.sql.streaming.stateStore.providerClass"
    log = adapter.log(spark, d).select("unique_symbol", "id", "status", "processed_at")
    cells = tasks(scratch.write(log, "log"), feed.CELL_ROWS)
    source = spark.readStream.schema(log.schema).parquet(scratch.path("log"))
    before = spark.conf.get(provider, None)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        put = lambda batch, n: batch.withColumn("batch", F.lit(n)).write.mode("overwrite").parquet(f"{scratch.path('changes')}/n={n}")
        stream = feed.newest_state(source, late="10000 days", cells=cells).writeStream.outputMode("update").option("checkpointLocation", scratch.path("checkpoint"))
        stream.foreachBatch(put).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset(provider) if before is None else spark.conf.set(provider, before)
    return ledger.latest(spark.read.parquet(scratch.path("changes")), ["unique_symbol"], "batch").select("unique_symbol", "id", "status")


_SHARES = "CASE WHEN k % 7 = 0 THEN shares + 1 ELSE shares END"


@query(f"""{LOTS}, x AS (SELECT processing_log_id AS id, row_order, shares, security_type AS kind, processing_log_id * 7 + row_order AS k FROM lots),
s AS (SELECT id, row_order, shares, kind FROM x WHERE k % 11 > 0),
p AS (SELECT id, row_order, CASE WHEN k % 7 = 0 THEN shares + 1 ELSE shares END AS shares, kind FROM x WHERE k % 13 > 0 UNION ALL SELECT id, row_order + 100, shares, kind FROM x WHERE k % 17 = 0),
c AS (SELECT 'p' AS side, *, row_number() OVER (PARTITION BY id, shares, kind ORDER BY row_order) AS copy FROM p UNION ALL SELECT 's', *, row_number() OVER (PARTITION BY id, shares, kind ORDER BY row_order) FROM s),
n AS (SELECT id, shares, kind, count(*) FILTER (side = 'p') AS np, count(*) FILTER (side = 's') AS ns FROM c GROUP BY 1, 2, 3),
left_ AS (SELECT c.*, row_number() OVER (PARTITION BY id, side, np > 0 AND ns > 0 ORDER BY row_order, shares NULLS FIRST, kind NULLS FIRST) AS place, np > 0 AND ns > 0 AS again FROM c JOIN n USING (id, shares, kind) WHERE copy > least(np, ns)),
o AS (SELECT coalesce(a.id, b.id) AS id, a.row_order AS parsed_row, b.row_order AS stored_row, a.shares AS parsed_shares, b.shares AS stored_shares,
    CASE WHEN coalesce(a.again, b.again) THEN CASE WHEN a.id IS NULL THEN 'repeated in stored' ELSE 'repeated in parsed' END WHEN a.id IS NULL THEN 'lost' WHEN b.id IS NULL THEN 'added' ELSE 'changed' END AS what
    FROM (SELECT * FROM left_ WHERE side = 'p') a FULL JOIN (SELECT * FROM left_ WHERE side = 's') b ON a.id = b.id AND a.place = b.place AND NOT a.again AND NOT b.again)
SELECT *, (SELECT count(*) FROM p WHERE p.id = o.id) AS parsed_rows, (SELECT count(*) FROM s WHERE s.id = o.id) AS stored_rows FROM o""")
def lot_differences(spark: SparkSession, d: str) -> DataFrame:
    """Parsed lots against stored ones, some changed, lost, added and repeated."""
    rows = adapter.lots(spark, d).select(F.col("processing_log_id").alias("id"), "row_order", "shares", F.col("security_type").alias("kind")).withColumn("k", F.col("id") * 7 + F.col("row_order"))
    parsed = rows.where("k % 13 > 0").withColumn("shares", F.expr(_SHARES)).unionByName(rows.where("k % 17 = 0").withColumn("row_order", F.col("row_order") + 100))
    found = ledger.lot_differences(parsed, rows.where("k % 11 > 0"), "id", "row_order", ["shares", "kind"])
    return found.select("id", "what", F.col("parsed.row_order").alias("parsed_row"), F.col("stored.row_order").alias("stored_row"), F.col("parsed.shares").alias("parsed_shares"), F.col("stored.shares").alias("stored_shares"), "parsed_rows", "stored_rows")
