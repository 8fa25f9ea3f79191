"""Queries over the driver tables, one for each operator, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lotloom.functions import classify, dates, numbers, text
from lotloom.operators import adapter, calendar, ledger, reports, rules
from lotloom.operators import master as issuers
from lotloom.plans import lockin, shp
from lotloom.registry import ALL, LOG, LOTS, ORACLES, QUERIES, query
from lotloom.session import table

FINALIZED = "CASE WHEN p.status = 'FINALIZED' THEN 1 ELSE 0 END"


# Lots and the unlock calendar


@query(f"{LOTS} SELECT processing_log_id, row_order, shares, lockin_date_from, lockin_date_to, status, bucket FROM lots")
def bucket_lots(spark: SparkSession, d: str) -> DataFrame:
    return adapter.lots(spark, d).select("processing_log_id", "row_order", "shares", "lockin_date_from", "lockin_date_to", "status", "bucket")


def _events_sql(where: str = "", latest: str = "") -> str:
    return f"""{ALL}, latest AS (SELECT unique_symbol, max(id) AS id FROM log {latest} GROUP BY 1)
SELECT p.id AS processing_id, p.unique_symbol, p.exchange, p.file_name, {FINALIZED} AS finalized, coalesce(p.locked_total, 0)::BIGINT AS locked_shares, coalesce(p.free_total, 0)::BIGINT AS free_shares,
    coalesce(shp_promoter_shares, 0)::BIGINT AS promoter_shares, coalesce(shp_public_shares, 0)::BIGINT AS public_shares, coalesce(shp_others_shares, 0)::BIGINT AS others_shares, coalesce(shp_total_shares, 0)::BIGINT AS total_shares,
    coalesce(m.company_name, m.ipo_name) AS company_name, r.lockin_date_to AS unlock_date, r.bucket, sum(r.shares)::BIGINT AS shares_unlocked, min(r.lockin_date_from) AS lock_from, max(p.processed_at) AS last_updated
FROM log p JOIN latest USING (id) JOIN lots r ON r.processing_log_id = p.id
LEFT JOIN master m ON (p.exchange = 'BSE' AND m.bse_script_code = split_part(p.unique_symbol, ':', 2)) OR (p.exchange = 'NSE' AND upper(m.nse_symbol) = upper(split_part(p.unique_symbol, ':', 2)))
WHERE r.status = 'LOCKED' AND r.lockin_date_to IS NOT NULL AND r.bucket <> 'free' {where}
GROUP BY ALL"""


def _events(spark: SparkSession, d: str, **wanted: str) -> DataFrame:
    return calendar.unlock_events(adapter.log(spark, d), adapter.lots(spark, d), adapter.master(spark, d), **wanted)


@query(_events_sql())
def unlock_calendar(spark: SparkSession, d: str) -> DataFrame:
    return _events(spark, d)


@query(_events_sql("AND p.processed_at > TIMESTAMP '1996-01-01 00:00:00' AND p.exchange = 'NSE' AND p.status = 'FINALIZED'", "WHERE exchange = 'NSE'"))
def since_feed(spark: SparkSession, d: str) -> DataFrame:
    return _events(spark, d, since="1996-01-01 00:00:00", exchange="nse", status="finalized")


@query(f"""SELECT processing_id, list({{'unlock_date': unlock_date, 'bucket': bucket, 'shares_unlocked': shares_unlocked, 'lock_from': lock_from}}
    ORDER BY unlock_date, list_position(['3_year_plus','2_year_plus','1_year_plus','1_year_minus','anchor_90','anchor_30','free'], bucket)) AS unlock_events FROM ({_events_sql()}) GROUP BY processing_id""")
def nested_events(spark: SparkSession, d: str) -> DataFrame:
    return calendar.nested_events(_events(spark, d)).select("processing_id", "unlock_events")


@query(f"""{LOTS} SELECT processing_log_id, lockin_date_to AS lock_upto, lower(status) AS row_class, lower(bucket) AS lock_bucket, min(lockin_date_from) AS lock_from, (lockin_date_to - min(lockin_date_from))::INT AS days_locked,
    min(security_type) AS type_raw, sum(shares)::BIGINT AS shares, count(*) AS n FROM lots GROUP BY processing_log_id, lockin_date_to, status, bucket""")
def grouped_lots(spark: SparkSession, d: str) -> DataFrame:
    return calendar.grouped_lots(adapter.lots(spark, d))


@query(f"""{LOTS} SELECT processing_log_id, row_order, lockin_date_from AS lock_from, lockin_date_to AS lock_upto, lower(status) AS row_class, lower(bucket) AS lock_bucket, (lockin_date_to - lockin_date_from)::INT AS days_locked, security_type AS type_raw, shares, 1 AS n FROM lots""")
def single_lots(spark: SparkSession, d: str) -> DataFrame:
    return calendar.single_lots(adapter.lots(spark, d))


@query(f"{LOTS} SELECT bucket, count(*) AS n, sum(shares)::BIGINT AS shares FROM lots GROUP BY 1")
def bucket_counts(spark: SparkSession, d: str) -> DataFrame:
    return calendar.bucket_counts(adapter.lots(spark, d))


@query(f"""{LOTS}, b AS (SELECT processing_log_id, bucket, sum(shares)::BIGINT AS shares FROM lots GROUP BY 1, 2)
SELECT processing_log_id, bucket, shares, CASE WHEN t > 0 THEN (shares * 1000) // t END AS permille FROM b JOIN (SELECT processing_log_id, sum(shares)::BIGINT AS t FROM lots GROUP BY 1) USING (processing_log_id)""")
def bucket_share_pct(spark: SparkSession, d: str) -> DataFrame:
    return calendar.bucket_shares(adapter.lots(spark, d))


@query(f"""{LOTS} SELECT processing_log_id, sum(shares)::BIGINT AS computed_total, coalesce(sum(shares) FILTER (status = 'LOCKED'), 0)::BIGINT AS locked_total, coalesce(sum(shares) FILTER (status = 'FREE'), 0)::BIGINT AS free_total,
    count(*) AS rows, count(*) FILTER (status = 'FREE') AS free_rows, count(*) FILTER (status = 'LOCKED') AS locked_rows FROM lots GROUP BY 1""")
def lot_totals(spark: SparkSession, d: str) -> DataFrame:
    return calendar.totals(adapter.lots(spark, d))


@query("SELECT CASE WHEN o_custkey % 2 = 0 THEN 'BSE' ELSE 'NSE' END AS exchange, count(*) AS n FROM orders GROUP BY 1")
def exchange_counts(spark: SparkSession, d: str) -> DataFrame:
    return adapter.log(spark, d).groupBy("exchange").agg(F.count("*").alias("n"))


# Latest records, versions and edits


@query(f"{LOG} SELECT id, unique_symbol, exchange, status, processed_at FROM log QUALIFY row_number() OVER (PARTITION BY unique_symbol ORDER BY id DESC) = 1")
def latest_per_symbol(spark: SparkSession, d: str) -> DataFrame:
    return ledger.latest(adapter.log(spark, d).select("id", "unique_symbol", "exchange", "status", "processed_at"), ["unique_symbol"], "id")


@query("""SELECT user_id, event_type, max(version) AS version, arg_max(event_id, (ts, event_id)) AS event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS version FROM events) GROUP BY 1, 2""")
def latest_version(spark: SparkSession, d: str) -> DataFrame:
    order = Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id")
    versions = table(spark, d, "events").select("user_id", "event_type", "event_id", "ts").withColumn("version", F.row_number().over(order).cast("long"))
    return ledger.latest(versions, ["user_id", "event_type"], "version").select("user_id", "event_type", "version", "event_id")


EDITS_SQL = "edits AS (SELECT processing_log_id, row_order, CASE shares % 4 WHEN 0 THEN 'anchor_30' WHEN 1 THEN '3_year_plus' WHEN 2 THEN 'free' ELSE 'nonsense' END AS bucket, shares AS edited_at FROM lots WHERE shares % 5 = 0)"


@query(f"""{LOG}, {EDITS_SQL}, last AS (SELECT processing_log_id, row_order, arg_max(bucket, (edited_at, bucket)) AS b FROM edits WHERE bucket <> 'nonsense' GROUP BY 1, 2)
SELECT l.processing_log_id, l.row_order, l.shares, coalesce(p.status <> 'FINALIZED' AND b <> l.bucket, false) AS edited, CASE WHEN p.status <> 'FINALIZED' AND b <> l.bucket THEN b ELSE l.bucket END AS bucket
FROM lots l LEFT JOIN last USING (processing_log_id, row_order) LEFT JOIN log p ON p.id = l.processing_log_id""")
def edits_overlay(spark: SparkSession, d: str) -> DataFrame:
    lots = adapter.lots(spark, d)
    kind = F.when(F.col("shares") % 4 == 0, "anchor_30").when(F.col("shares") % 4 == 1, "3_year_plus").when(F.col("shares") % 4 == 2, "free").otherwise("nonsense")
    edits = lots.where("shares % 5 = 0").select("processing_log_id", "row_order", kind.alias("bucket"), F.col("shares").alias("edited_at"))
    return ledger.overlaid(lots, edits, adapter.log(spark, d)).select("processing_log_id", "row_order", "shares", "edited", "bucket")


@query(f"""{LOG} SELECT id, lots FROM log LEFT JOIN (SELECT processing_log_id, list({{'row_order': row_order, 'shares': shares, 'bucket': bucket}} ORDER BY row_order, shares, bucket) AS l FROM lots GROUP BY 1) ON processing_log_id = id, (SELECT 1) t, LATERAL (SELECT coalesce(l, []) AS lots)""")
def nested_lots(spark: SparkSession, d: str) -> DataFrame:
    return ledger.nested(adapter.log(spark, d).select("id"), adapter.lots(spark, d).select("processing_log_id", "row_order", "shares", "bucket"))


@query(f"""{LOG} SELECT id, bool_or(r.bucket = 'anchor_30') AS has FROM log JOIN lots r ON r.processing_log_id = id GROUP BY id HAVING bool_or(r.bucket = 'anchor_30')""")
def exists_bucket(spark: SparkSession, d: str) -> DataFrame:
    records = ledger.nested(adapter.log(spark, d).select("id"), adapter.lots(spark, d).select("processing_log_id", "row_order", "bucket"))
    return records.where(calendar.has_bucket(F.col("lots"), "anchor_30")).select("id", F.lit(True).alias("has"))


@query(f"""{LOG}, s AS (SELECT id, computed_total, locked_total, CASE WHEN id % 7 = 0 THEN free_total + 1 WHEN id % 11 = 0 THEN NULL ELSE free_total END AS free_total FROM log WHERE id % 13 <> 0)
SELECT coalesce(p.id, s.id) AS id, list_filter([CASE WHEN p.computed_total IS DISTINCT FROM s.computed_total THEN 'computed_total' END, CASE WHEN p.locked_total IS DISTINCT FROM s.locked_total THEN 'locked_total' END,
    CASE WHEN nullif(p.free_total, 0) IS DISTINCT FROM nullif(s.free_total, 0) THEN 'free_total' END], lambda x: x IS NOT NULL) AS differs FROM log p FULL JOIN s ON p.id = s.id""")
def reconcile_fields(spark: SparkSession, d: str) -> DataFrame:
    log = adapter.log(spark, d).select("id", "computed_total", "locked_total", "free_total")
    other = F.when(F.col("id") % 7 == 0, F.col("free_total") + 1).when(F.col("id") % 11 == 0, None).otherwise(F.col("free_total"))
    return ledger.differences(log, log.where("id % 13 <> 0").withColumn("free_total", other), "id", ["computed_total", "locked_total", "free_total"], ("free_total",))


# Joins with the master list


@query(f"""{ALL} SELECT p.id, p.unique_symbol, m.company_name, m.ipo_name FROM log p LEFT JOIN master m ON (p.exchange = 'BSE' AND m.bse_script_code = split_part(p.unique_symbol, ':', 2)) OR (p.exchange = 'NSE' AND upper(m.nse_symbol) = upper(split_part(p.unique_symbol, ':', 2)))""")
def master_left_join(spark: SparkSession, d: str) -> DataFrame:
    return issuers.with_master(adapter.log(spark, d).select("id", "exchange", "unique_symbol"), adapter.master(spark, d)).select("id", "unique_symbol", "company_name", "ipo_name")


@query("SELECT o_orderkey AS id FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def semi_known_symbols(spark: SparkSession, d: str) -> DataFrame:
    known = issuers.keyed(adapter.master(spark, d).where("ipo_name = 'BUILDING'")).select("master_key")
    return adapter.log(spark, d).withColumn("master_key", issuers.record_key()).join(known, "master_key", "left_semi").select("id")


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def anti_missing_lots(spark: SparkSession, d: str) -> DataFrame:
    records = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"))
    return ledger.not_done(records, table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id")), "id")


@query("""SELECT a.o_orderkey AS id FROM orders a WHERE EXISTS (SELECT 1 FROM orders b WHERE b.o_custkey = a.o_custkey AND b.o_totalprice::BIGINT // 1000 = a.o_totalprice::BIGINT // 1000 AND b.o_orderkey <> a.o_orderkey)""")
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey", F.expr("bigint(round(o_totalprice)) div 1000").alias("file"))
    twice = rows.groupBy("o_custkey", "file").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b")
    return rows.join(twice, ["o_custkey", "file"], "left_semi").select("id")


# Sorting, limits and filters


@query(f"{LOG} SELECT id, processed_at FROM log ORDER BY processed_at DESC, id LIMIT 20")
def topk_recent(spark: SparkSession, d: str) -> DataFrame:
    return adapter.log(spark, d).select("id", "processed_at").orderBy(F.desc("processed_at"), "id").limit(20)


@query(f"""{LOTS}, g AS (SELECT processing_log_id, lockin_date_to AS unlock_date, bucket, sum(shares)::BIGINT AS shares FROM lots WHERE lockin_date_to IS NOT NULL GROUP BY 1, 2, 3),
o AS (SELECT *, row_number() OVER (ORDER BY unlock_date, list_position(['3_year_plus','2_year_plus','1_year_plus','1_year_minus','anchor_90','anchor_30','free'], bucket), processing_log_id) AS place FROM g) SELECT * FROM o WHERE place <= 100""")
def multi_key_sort(spark: SparkSession, d: str) -> DataFrame:
    by = adapter.lots(spark, d).where("lockin_date_to is not null").groupBy("processing_log_id", F.col("lockin_date_to").alias("unlock_date"), "bucket").agg(F.sum("shares").alias("shares"))
    order = ["unlock_date", classify.bucket_order(F.col("bucket")), "processing_log_id"]
    top = by.orderBy(*order).limit(100)
    return top.withColumn("place", F.row_number().over(Window.orderBy(*order)).cast("long"))  # of 100 rows


@query("SELECT c_custkey, c_name FROM customer WHERE c_name ILIKE '%er#0000%1%'")
def like_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").where(F.col("c_name").ilike("%ER#0000%1%")).select("c_custkey", "c_name")


@query(f"""{LOG} SELECT id, status FROM log WHERE (status IS NULL OR status <> 'FINALIZED') AND exchange IN ('BSE') AND computed_total IS NOT NULL AND id NOT IN (SELECT processing_log_id FROM lots WHERE bucket = 'free' AND status = 'LOCKED')""")
def guarded_filter(spark: SparkSession, d: str) -> DataFrame:
    bad = adapter.lots(spark, d).where("bucket = 'free' and status = 'LOCKED'").select(F.col("processing_log_id").alias("id"))
    rows = adapter.log(spark, d).where((F.col("status").isNull() | (F.col("status") != "FINALIZED")) & F.col("exchange").isin("BSE") & F.col("computed_total").isNotNull())
    return ledger.not_done(rows, bad, "id").select("id", "status")


@query(f"""{LOG}, o AS (SELECT *, row_number() OVER (PARTITION BY unique_symbol ORDER BY id DESC) AS k FROM log)
SELECT unique_symbol, count(*) AS candidates, max(processed_at) AS latest, list(id ORDER BY id DESC) FILTER (k <= 2) AS first_two FROM o GROUP BY 1""")
def candidate_summary(spark: SparkSession, d: str) -> DataFrame:
    log = adapter.log(spark, d).select("unique_symbol", "id", "processed_at")
    rank = F.row_number().over(Window.partitionBy("unique_symbol").orderBy(F.desc("id")))
    counted = log.groupBy("unique_symbol").agg(F.count("*").alias("candidates"), F.max("processed_at").alias("latest"))
    two = log.withColumn("k", rank).where("k <= 2").groupBy("unique_symbol").agg(F.reverse(F.sort_array(F.collect_list("id"))).alias("first_two"))
    return counted.join(two, "unique_symbol")


@query("""SELECT line, f.d AS first_doc, f.p::INT AS first_pos FROM (SELECT line, min({'d': doc_id, 'p': pos}) AS f FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents) GROUP BY 1)""")
def distinct_lines(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    first = rows.groupBy("line").agg(F.min(F.struct("doc_id", "pos")).alias("f"))
    return first.select("line", F.col("f.doc_id").alias("first_doc"), F.col("f.pos").alias("first_pos"))


# Running sums and contiguous sums


@query(f"""{LOTS}, r AS (SELECT processing_log_id, shares, row_order, sum(shares) OVER (PARTITION BY processing_log_id ORDER BY row_order DESC, shares DESC, distinctive_from DESC, lockin_date_to DESC NULLS LAST ROWS UNBOUNDED PRECEDING)::BIGINT AS running FROM lots)
SELECT processing_log_id, row_order, shares, running FROM r WHERE running <= 60""")
def running_sum_to_target(spark: SparkSession, d: str) -> DataFrame:
    up = Window.partitionBy("processing_log_id").orderBy(F.desc("row_order"), F.desc("shares"), F.desc("distinctive_from"), F.desc_nulls_last("lockin_date_to")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return adapter.lots(spark, d).withColumn("running", F.sum("shares").over(up)).where("running <= 60").select("processing_log_id", "row_order", "shares", "running")


@query(f"""{LOTS}, r AS (SELECT processing_log_id, row_number() OVER w AS i, sum(shares) OVER (w ROWS UNBOUNDED PRECEDING)::BIGINT AS p, shares FROM lots WINDOW w AS (PARTITION BY processing_log_id ORDER BY row_order, shares, distinctive_from, lockin_date_to NULLS FIRST))
SELECT a.processing_log_id, a.i AS first_row, b.i AS last_row FROM r a JOIN r b ON a.processing_log_id = b.processing_log_id AND b.p - (a.p - a.shares) = 50 AND b.i >= a.i""")
def contiguous_sum(spark: SparkSession, d: str) -> DataFrame:
    order = Window.partitionBy("processing_log_id").orderBy("row_order", "shares", "distinctive_from", F.asc_nulls_first("lockin_date_to"))
    rows = adapter.lots(spark, d).select("processing_log_id", "shares", F.row_number().over(order).cast("long").alias("i"), F.sum("shares").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("p"))
    starts = rows.select("processing_log_id", F.col("i").alias("first_row"), (F.col("p") - F.col("shares") + 50).alias("p"))
    return starts.join(rows.select("processing_log_id", F.col("i").alias("last_row"), "p"), ["processing_log_id", "p"]).where("last_row >= first_row").select("processing_log_id", "first_row", "last_row")


# Rules

RULES_SQL = f"""{LOG}, f AS (SELECT processing_log_id, count(*) FILTER (bucket = 'anchor_30') AS a30, count(*) FILTER (bucket = 'anchor_90') AS a90, count(*) FILTER (status = 'LOCKED' AND lockin_date_to IS NOT NULL AND bucket = 'free') AS lf,
    count(*) FILTER (status = 'LOCKED' AND lockin_date_to < lockin_date_from) AS neg, count(*) FILTER (status = 'LOCKED' AND lockin_date_to IS NULL) AS noend FROM lots GROUP BY 1),
r AS (SELECT p.*, f.*, CASE WHEN id % 3 = 0 THEN computed_total + 1 ELSE computed_total END AS declared_total, CASE WHEN id % 2 = 0 THEN 'url' END AS anchor_letter_url,
    CASE WHEN id % 5 = 0 THEN computed_total END AS text_total, locked_total + (id % 2) AS shp_locked_shares FROM log p JOIN f ON f.processing_log_id = p.id),
v AS (SELECT id, 0 AS place, 'RULE1' AS rule_id, locked_total + free_total = computed_total AS passed, computed_total::BIGINT AS expected, (locked_total + free_total)::BIGINT AS actual FROM r
    UNION ALL SELECT id, 1, 'RULE2', declared_total = computed_total OR coalesce(text_total = computed_total AND text_total = shp_total_shares, false), declared_total, computed_total FROM r
    UNION ALL SELECT id, 2, 'RULE5', shp_promoter_shares + shp_public_shares + shp_others_shares = shp_total_shares, shp_total_shares, shp_promoter_shares + shp_public_shares + shp_others_shares FROM r
    UNION ALL SELECT id, 3, 'RULE3', computed_total = shp_total_shares, computed_total, shp_total_shares FROM r
    UNION ALL SELECT id, 4, 'RULE4', locked_total = shp_locked_shares, locked_total, shp_locked_shares FROM r
    UNION ALL SELECT id, 5, 'RULE6', CASE WHEN anchor_letter_url IS NOT NULL THEN a30 > 0 AND a90 > 0 ELSE a30 + a90 = 0 END OR processed_at::DATE <= DATE '1994-12-31', CASE WHEN anchor_letter_url IS NOT NULL THEN 1 ELSE 0 END, a30 + a90 FROM r
    UNION ALL SELECT id, 6, 'RULE7', lf = 0, 0, lf FROM r UNION ALL SELECT id, 7, 'RULE8', neg = 0, 0, neg FROM r UNION ALL SELECT id, 8, 'RULE10', noend = 0, 0, noend FROM r)"""


def _rule_records(spark: SparkSession, d: str) -> DataFrame:
    log, lots = adapter.log(spark, d), adapter.lots(spark, d)
    found = rules.facts(lots, log.select(F.col("id").alias("processing_log_id"), F.col("processed_at").cast("date").alias("reference_date")))
    # allotments in these tables lie decades before the cutoff, so they are moved next to it
    reference = F.date_add(F.lit(rules.ANCHOR_CUTOFF).cast("date"), F.date_diff(F.col("processed_at").cast("date"), F.lit("1994-12-31").cast("date")))
    return log.join(found, F.col("id") == F.col("processing_log_id")).withColumns({
        "declared_total": F.when(F.col("id") % 3 == 0, F.col("computed_total") + 1).otherwise(F.col("computed_total")), "anchor_letter_url": F.when(F.col("id") % 2 == 0, "url"), "reference_date": reference,
        "text_total": F.when(F.col("id") % 5 == 0, F.col("computed_total")), "shp_locked_shares": F.col("locked_total") + F.col("id") % 2,
    })


def _verdicts(spark: SparkSession, d: str) -> DataFrame:
    return rules.verdicts(_rule_records(spark, d))


@query(f"{RULES_SQL} SELECT id, rule_id, passed, expected::BIGINT AS expected, actual::BIGINT AS actual FROM v")
def rule_verdicts(spark: SparkSession, d: str) -> DataFrame:
    return _verdicts(spark, d).select("id", "rule_id", "passed", "expected", "actual")


def _one_rule(rule: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return _rule_records(spark, d).select("id", rules.one(rule).alias("v")).select("id", "v.passed", "v.expected", "v.actual")

    run.__name__ = rule.lower()
    query(f"{RULES_SQL} SELECT id, passed, expected::BIGINT AS expected, actual::BIGINT AS actual FROM v WHERE rule_id = '{rule}'")(run)


for _rule in rules.ORDER:
    _one_rule(_rule)


@query(f"{RULES_SQL} SELECT id, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed, coalesce(string_agg(rule_id, ',' ORDER BY place) FILTER (NOT passed), '') AS failed_rules FROM v GROUP BY id")
def rule_summary(spark: SparkSession, d: str) -> DataFrame:
    return rules.counted(_rule_records(spark, d))


@query(f"""{RULES_SQL} SELECT id, rule_id, passed OR (rule_id = 'RULE8' AND id % 4 = 0) AS passed FROM v""")
def manual_overrides(spark: SparkSession, d: str) -> DataFrame:
    log = adapter.log(spark, d).where("id % 4 = 0")
    wanted = log.select("id", F.explode(F.array(F.lit("RULE8"), F.lit("RULE10"))).alias("rule_id"), F.lit("checked by hand").alias("reason"))
    return rules.overridden(_verdicts(spark, d), wanted).select("id", "rule_id", "passed")


@query(f"""{LOTS}, b AS (SELECT processing_log_id, status, CASE shares % 6 WHEN 0 THEN '3+YEARS' WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN 'odd' ELSE bucket END AS bucket FROM lots)
SELECT processing_log_id, count(*) AS bad, count(*) FILTER (coalesce(trim(bucket), '') = '') AS blank, count(*) FILTER (bucket = '3+YEARS') AS legacy, count(*) FILTER (bucket IN ('odd', 'free')) AS unknown
FROM b WHERE status = 'LOCKED' AND (bucket IS NULL OR bucket NOT IN ('3_year_plus','2_year_plus','1_year_plus','1_year_minus','anchor_90','anchor_30')) GROUP BY 1""")
def invalid_bucket_domain(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("shares") % 6
    stored = F.when(k == 0, "3+YEARS").when(k == 1, "").when(k == 2, None).when(k == 3, "odd").otherwise(F.col("bucket"))
    return rules.stored_bucket_problems(adapter.lots(spark, d).withColumn("bucket", stored))


@query(f"""{LOG} SELECT id, CASE WHEN computed_total IS NULL THEN 'document is blank' WHEN status = 'FINALIZED' THEN 'already finalized' WHEN free_total > locked_total THEN 'rules failed' END AS reason, CASE WHEN status <> 'FINALIZED' THEN 'not finalized' END AS rollback FROM log""")
def finalise_gate(spark: SparkSession, d: str) -> DataFrame:
    log = adapter.log(spark, d)
    return log.select("id", rules.may_finalize(F.col("status"), F.col("free_total") <= F.col("locked_total"), F.col("computed_total").isNull()).alias("reason"), rules.may_roll_back(F.col("status")).alias("rollback"))


# Classification


@query("""SELECT event_id, CASE v WHEN '3+YEARS' THEN '3_year_plus' WHEN 'FREE' THEN 'free' ELSE v END AS bucket FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN '3+YEARS' WHEN 1 THEN 'FREE' ELSE event_type END AS v FROM events)""")
def legacy_bucket_map(spark: SparkSession, d: str) -> DataFrame:
    old = F.when(F.col("event_id") % 3 == 0, "3+YEARS").when(F.col("event_id") % 3 == 1, "FREE").otherwise(F.col("event_type"))
    return table(spark, d, "events").select("event_id", classify.lookup(old, classify.RENAMED).alias("bucket"))


@query(f"""{LOTS}, x AS (SELECT processing_log_id, row_order, shares, abs(lockin_date_to - lockin_date_from) AS n FROM lots) SELECT processing_log_id, row_order, shares, CASE WHEN n IS NULL THEN 'free' WHEN n BETWEEN 15 AND 45 THEN 'anchor_30' WHEN n BETWEEN 75 AND 105 THEN 'anchor_90'
    WHEN n BETWEEN 330 AND 400 THEN '1_year' WHEN n BETWEEN 690 AND 780 THEN '2_year' WHEN n BETWEEN 1055 AND 1145 THEN '3_year' ELSE 'unknown' END AS band FROM x""")
def legacy_bands(spark: SparkSession, d: str) -> DataFrame:
    return adapter.lots(spark, d).select("processing_log_id", "row_order", "shares", classify.legacy_band(F.date_diff("lockin_date_to", "lockin_date_from")).alias("band"))


# JSON


@query("SELECT event_id, coalesce(try_cast(json_extract_string(props, '$.k') AS INT), 0) AS k FROM events")
def json_path(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.coalesce(F.try_variant_get(F.try_parse_json("props"), "$.k", "int"), F.lit(0)).alias("k"))


@query("SELECT coalesce(try_cast(json_extract_string(props, '$.k') AS INT), 0) % 10 AS k, count(*) AS n FROM events GROUP BY 1")
def json_group_count(spark: SparkSession, d: str) -> DataFrame:
    return json_path(spark, d).groupBy((F.col("k") % 10).alias("k")).agg(F.count("*").alias("n"))


@query("""SELECT strategy, count(*) AS n, (count(*) * 1000) // (SELECT count(*) FROM events) AS permille FROM (SELECT event_type AS strategy FROM events) GROUP BY 1""")
def strategy_freq(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select(F.to_json(F.struct(F.struct(F.col("event_type").alias("lockin")).alias("_strategies"))).alias("v"))
    by = rows.select(F.try_variant_get(F.try_parse_json("v"), "$._strategies.lockin", "string").alias("strategy")).groupBy("strategy").agg(F.count("*").alias("n"))
    total = by.agg(F.sum("n").alias("total"))
    return by.join(F.broadcast(total)).select("strategy", "n", F.expr("n * 1000 div total").alias("permille"))  # one row of totals


_NESTED = """CASE event_id % 3 WHEN 0 THEN props WHEN 1 THEN json_merge_patch(props, '{"o":{"x":[1,"a",null]},"manual_reviewed":7}') END"""


@query(f"""SELECT event_id, meta, CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS reviewed FROM (SELECT event_id, json_merge_patch(json_merge_patch(coalesce({_NESTED}, '{{}}'), '{{"manual_reviewed":null}}'), CASE WHEN event_id % 2 = 0 THEN '{{"manual_reviewed":1}}' ELSE '{{"manual_reviewed":0}}' END)::VARCHAR AS meta FROM events)""")
def json_set(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id") % 3
    richer = F.concat(F.regexp_replace("props", r"\}\s*$", ""), F.lit(', "o": {"x": [1, "a", null]}, "manual_reviewed": 7}'))
    meta = ledger.reviewed(F.when(k == 0, F.col("props")).when(k == 1, richer), F.col("event_id") % 2 == 0)
    return table(spark, d, "events").select("event_id", meta.alias("meta"), ledger.is_reviewed(meta).alias("reviewed"))


# Text


_CONTENT = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '-+\s*PAGE\s+\d+\s*-+', '', 'gi'), '#+', '', 'g'), '[=_\-*]{3,}', '', 'g'), '\s+', '', 'g')"


@query(f"SELECT doc_id, len({_CONTENT}) < 50 AS is_blank FROM documents")
def blank_docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.is_blank(F.col("text")).alias("is_blank"))


@query(rf"SELECT doc_id, len(text)::INT AS total_chars, len(regexp_extract_all(text, '(?i)-+\s*PAGE\s+\d+\s*-+'))::INT AS page_count, len({_CONTENT})::INT AS content_chars, len({_CONTENT}) < 50 AS is_blank FROM documents")
def blank_stats(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.blank_stats(F.col("text")).alias("s")).select("doc_id", "s.*")


@query("SELECT doc_id, unnest(range(len(string_split(text, chr(10)))))::INT AS line_no, trim(unnest(string_split(text, chr(10))), ' ') AS line FROM documents")
def line_explode(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.posexplode(text.lines(F.col("text"))).alias("line_no", "line"))


@query(r"SELECT doc_id, list_transform(regexp_extract_all(text, '[0-9][0-9,]*'), lambda x: try_cast(replace(x, ',', '') AS BIGINT)) AS nums FROM documents WHERE regexp_matches(text, '[0-9]')")
def number_tokens(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where(F.col("text").rlike("[0-9]")).select("doc_id", numbers.number_runs(F.col("text")).alias("nums"))


@query("SELECT doc_id, replace(replace(lower(text), ' ', ''), '-', '') AS bare FROM documents")
def pattern_normalise(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.pattern_text(F.col("text")).alias("bare"))


@query("""SELECT o_orderkey AS id, CASE WHEN a > 12 AND b <= 12 THEN 'dmy' WHEN b > 12 AND a <= 12 THEN 'mdy' END AS date_order FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN day(o_orderdate) ELSE month(o_orderdate) END AS a, CASE WHEN o_orderkey % 2 = 0 THEN month(o_orderdate) ELSE day(o_orderdate) END AS b FROM orders)""")
def date_order_vote(spark: SparkSession, d: str) -> DataFrame:
    shown = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "d/M/yyyy")).otherwise(F.date_format("o_orderdate", "M/d/yyyy"))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), dates.date_order(F.concat(F.lit("on "), shown, F.lit(" at"))).alias("date_order"))


@query("""SELECT o_orderkey AS id, o_orderdate::DATE AS day FROM orders""")
def date_formats(spark: SparkSession, d: str) -> DataFrame:
    patterns = ("dd-MMM-yyyy", "d MMMM yyyy", "MMMM d, yyyy", "dd/MMM/yyyy", "MMM d yyyy")
    k = F.col("o_orderkey") % len(patterns)
    shown = F.coalesce(*(F.when(k == i, F.date_format("o_orderdate", p)) for i, p in enumerate(patterns)))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), dates.date_value(dates.date_text(shown), F.lit(None).cast("string")).alias("day"))


@query("""SELECT c_custkey, list_distinct([s || '-ipo', s2 || '_ipo']) AS slugs FROM (SELECT c_custkey, replace(trim(replace(lower(c_name), '#', ' ')), ' ', '-') AS s, replace(trim(replace(lower(c_name), '#', ' ')), ' ', '_') AS s2 FROM customer)""")
def slug_candidates(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select("c_custkey", text.slugs(F.concat("c_name", F.lit(" Pvt. Ltd."))).alias("slugs"))
    return rows.withColumn("slugs", F.sort_array("slugs"))


ORACLES["slug_candidates"] = ORACLES["slug_candidates"].replace("list_distinct([", "list_sort(list_distinct([").replace("_ipo'])", "_ipo']))")


@query("SELECT o_orderkey AS id, [a, a + 1, a + 2, b] AS pages FROM (SELECT o_orderkey, (o_orderkey % 5 + 1)::INT AS a, (o_orderkey % 5 + 9)::INT AS b FROM orders)")
def page_lists(spark: SparkSession, d: str) -> DataFrame:
    a = F.col("o_orderkey") % 5 + 1
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), text.page_list(F.format_string("%d,%d-%d", a + 8, a, a + 2)).alias("pages"))


@query("SELECT o_orderkey AS id, CASE WHEN o_custkey % 2 = 0 THEN o_custkey::VARCHAR ELSE o_orderkey::VARCHAR END AS code, CASE WHEN o_custkey % 2 = 0 THEN 'CUST' ELSE 'CUST' || o_custkey END AS symbol FROM orders")
def file_identities(spark: SparkSession, d: str) -> DataFrame:
    code, symbol = text.file_identity(F.col("file_name"), F.col("exchange"))
    return adapter.log(spark, d).select("id", code.alias("code"), symbol.alias("symbol"))


@query("SELECT o_orderkey AS id, format('{:,}', (o_totalprice * 100)::BIGINT) AS grouped FROM orders")
def thousands(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), numbers.grouped(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("grouped"))


# Filings rendered from lots, and read back


def _rendered(spark: SparkSession, d: str) -> DataFrame:
    """For each record a text with a line per lot: shares, running distinctive numbers, end or free."""
    lots = adapter.lots(spark, d).where("shares > 0")
    order = Window.partitionBy("processing_log_id").orderBy("row_order", "shares", "distinctive_from", F.asc_nulls_first("lockin_date_to"))
    rows = lots.withColumn("last", F.sum("shares").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) * 1000).withColumn("n", F.row_number().over(order))
    return rows.select("processing_log_id", "n", (F.col("shares") * 1000).alias("shares"), (F.col("last") - F.col("shares") * 1000 + 1).alias("first"), "last", "lockin_date_from", "lockin_date_to")


def _filings(spark: SparkSession, d: str, exchange: str) -> DataFrame:
    day = lambda c: F.date_format(c, "dd-MMM-yyyy")
    end = F.coalesce(day("lockin_date_to"), F.lit("Free"))
    if exchange == "NSE":
        line, head, foot = F.concat_ws("   ", numbers.grouped(F.col("shares")), numbers.grouped(F.col("first")), numbers.grouped(F.col("last")), end), "No. of shares   From   To   Lock in upto", ""
    else:
        own = F.when(F.col("lockin_date_to").isNotNull(), day("lockin_date_from"))
        line, head, foot = F.concat_ws("   ", numbers.grouped(F.col("shares")), numbers.grouped(F.col("first")), numbers.grouped(F.col("last")), F.when(F.col("lockin_date_to").isNotNull(), "Lock-in").otherwise("Fully Paid"), own, end, F.lit("Demat")), "Number of Securities   From   To", "Company Secretary"
    by = _rendered(spark, d).groupBy("processing_log_id").agg(F.array_sort(F.collect_list(F.struct("n", line.alias("line")))).alias("l"), F.sum("shares").alias("t"))
    body = F.array_join(F.transform("l", lambda r: r["line"]), "\n")
    return by.select("processing_log_id", F.lit(exchange).alias("exchange"), F.concat_ws("\n", F.lit(head), body, F.concat(numbers.grouped(F.col("t")), F.lit("   Total")), F.lit(foot)).alias("text"))


_RENDERED_SQL = f"""{LOTS}, x AS (SELECT processing_log_id, shares * 1000 AS shares, (sum(shares) OVER (PARTITION BY processing_log_id ORDER BY row_order, shares, distinctive_from, lockin_date_to NULLS FIRST ROWS UNBOUNDED PRECEDING) * 1000)::BIGINT AS to_no, lockin_date_from, lockin_date_to, status, bucket FROM lots WHERE shares > 0)"""


@query(f"{_RENDERED_SQL} SELECT processing_log_id, shares, to_no - shares + 1 AS from_no, to_no, lockin_date_to, status FROM x")
def filing_roundtrip_nse(spark: SparkSession, d: str) -> DataFrame:
    read = lockin.lots(lockin.extract(_filings(spark, d, "NSE")), "processing_log_id")
    return read.select("processing_log_id", "shares", "from_no", "to_no", "lockin_date_to", "status")


@query(f"{_RENDERED_SQL} SELECT processing_log_id, shares, to_no - shares + 1 AS from_no, to_no, CASE WHEN lockin_date_to IS NOT NULL THEN lockin_date_from END AS lockin_date_from, lockin_date_to, status, bucket FROM x")
def filing_roundtrip_bse(spark: SparkSession, d: str) -> DataFrame:
    read = lockin.lots(lockin.extract(_filings(spark, d, "BSE")), "processing_log_id")
    return read.select("processing_log_id", "shares", "from_no", "to_no", "lockin_date_from", "lockin_date_to", "status", "bucket")


@query(f"{_RENDERED_SQL} SELECT processing_log_id, 'reverse_from_total' AS strategy, sum(shares)::BIGINT AS computed_total, coalesce(sum(shares) FILTER (status = 'LOCKED'), 0)::BIGINT AS locked_shares, count(*)::INT AS rows_count FROM x GROUP BY 1")
def cascade_strategy(spark: SparkSession, d: str) -> DataFrame:
    return lockin.extract(_filings(spark, d, "BSE")).select("processing_log_id", "lockin.strategy", "lockin.computed_total", "lockin.locked_shares", "lockin.rows_count")


@query(f"""{LOG} SELECT id, shp_promoter_shares * 1000 + 20000 AS promoter_shares, shp_public_shares * 1000 + 30000 AS public_shares, shp_others_shares * 1000 + 40000 AS other_shares, shp_total_shares * 1000 + 90000 AS total_shares, 'spatial_columns' AS strategy FROM log WHERE shp_total_shares IS NOT NULL""")
def shp_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    log = adapter.log(spark, d).where("shp_total_shares is not null")
    value = {n: F.col(f"shp_{n}_shares") * 1000 + plus for n, plus in (("promoter", 20000), ("public", 30000), ("others", 40000), ("total", 90000))}
    line = lambda label, n, v: F.concat_ws("     ", F.lit(label), F.lit(n), numbers.grouped(v))
    doc = F.concat_ws("\n", F.lit("Category     Holders     Shares"), line("(A) Promoter & Promoter Group", "3", value["promoter"]), line("(B) Public", "90", value["public"]), line("(C) Non Promoter Non Public", "1", value["others"]), line("Total", "94", value["total"]))
    docs = log.select("id", "exchange", doc.alias("text"), value["total"].alias("known_total"))
    return shp.extract(docs).select("id", "shp.promoter_shares", "shp.public_shares", "shp.other_shares", "shp.total_shares", "shp.strategy")


@query(f"""{LOG} SELECT id, CASE WHEN shp_total_shares > 0 AND NOT (shp_promoter_shares = 0 AND shp_public_shares = 0) THEN shp_total_shares - shp_promoter_shares - shp_public_shares ELSE CASE WHEN id % 2 = 0 THEN 0 ELSE shp_others_shares END END AS other_shares FROM log WHERE shp_total_shares IS NOT NULL""")
def residual_other(spark: SparkSession, d: str) -> DataFrame:
    log = adapter.log(spark, d).where("shp_total_shares is not null")
    known = F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("shp_others_shares"))
    r = F.struct(F.col("shp_promoter_shares").alias("promoter_shares"), F.col("shp_public_shares").alias("public_shares"), known.alias("other_shares"), F.col("shp_total_shares").alias("total_shares"), F.lit(False).alias("all_found"))
    return log.withColumn("r", r).select("id", shp.reconciled(F.col("r"))["other_shares"].alias("other_shares"))


# Reports


@query(f"{LOG} SELECT status = 'FINALIZED' AS finalized, count(*) AS n, list_sort(list_distinct(list(unique_symbol))) AS symbols FROM log GROUP BY 1")
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    return reports.run_summary(adapter.log(spark, d))


@query(f"""{_RENDERED_SQL}, f AS (SELECT processing_log_id, count(*) AS n FROM x GROUP BY 1) SELECT 'NSE' AS exchange, count(*) AS files, count(*) AS passed, 0::BIGINT AS mismatches, 0::BIGINT AS range_errors FROM f""")
def outcome_summary(spark: SparkSession, d: str) -> DataFrame:
    read = lockin.extract(_filings(spark, d, "NSE")).withColumn("name", F.col("processing_log_id"))
    return reports.outcome_summary(reports.outcomes(read))


@query(f"{LOTS} SELECT processing_log_id, count(*) FILTER (distinctive_to - distinctive_from + 1 <> shares) AS range_errors FROM lots GROUP BY 1")
def range_mismatches(spark: SparkSession, d: str) -> DataFrame:
    return rules.facts(adapter.lots(spark, d)).select("processing_log_id", "range_errors")


@query(f"{RULES_SQL} SELECT id, declared_total = computed_total AS passed, declared_total::BIGINT AS expected FROM r")
def strict_rule2(spark: SparkSession, d: str) -> DataFrame:
    return _rule_records(spark, d).select("id", rules.one("RULE2", strict=True).alias("v")).select("id", "v.passed", "v.expected")


@query(f"""{LOG} SELECT id, list_filter([CASE WHEN computed_total <> computed_total + id % 2 THEN 'totals differ' END, CASE WHEN locked_total + id % 3 <> locked_total THEN 'shareholding locked differs' END, CASE WHEN status = 'FINALIZED' THEN 'already finalized' END],
    lambda x: x IS NOT NULL) AS reasons FROM log WHERE computed_total IS NOT NULL""")
def promotable_candidates(spark: SparkSession, d: str) -> DataFrame:
    log = adapter.log(spark, d).where("computed_total is not null")
    snapshot = F.struct(
        F.lit(1).alias("rows_count"), "computed_total", (F.col("computed_total") + F.col("id") % 2).alias("declared_total"), "locked_total", "free_total", "shp_total_shares", (F.col("locked_total") + F.col("id") % 3).alias("shp_locked_shares"),
        "shp_promoter_shares", "shp_public_shares", "shp_others_shares", (F.col("status") == "FINALIZED").alias("finalized"),
    )
    return log.select("id", snapshot.alias("candidate")).select("id", rules.promotable().alias("reasons"))


@query(f"""{LOG} SELECT p.id, p.unique_symbol, locked_total * 100.0 / nullif(computed_total, 0) > 50 AS mostly_locked FROM log p WHERE computed_total IS NOT NULL""")
def locked_share(spark: SparkSession, d: str) -> DataFrame:
    return adapter.log(spark, d).where("computed_total is not null").select("id", "unique_symbol", (reports.percent(F.col("locked_total"), F.col("computed_total")) > 50).alias("mostly_locked"))


@query(f"SELECT processing_id, count(*) AS n, sum(shares_unlocked)::BIGINT AS shares FROM ({_events_sql()}) GROUP BY 1")
def feed_records(spark: SparkSession, d: str) -> DataFrame:
    events = calendar.nested_events(_events(spark, d))
    return events.select("processing_id", F.size("unlock_events").cast("long").alias("n"), F.aggregate("unlock_events", F.lit(0).cast("long"), lambda s, e: s + e["shares_unlocked"]).alias("shares"))


# Our own extension: windows over the stream table, in batch


@query("SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1, 2")
def events_by_hour(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n")).select("event_type", F.col("w.start").alias("hour"), "n")


from lotloom import queries_layouts, queries_ledger, queries_store, queries_values  # noqa: E402,F401  they register more
