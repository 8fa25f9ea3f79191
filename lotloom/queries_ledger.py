"""Queries of the ledger's writes, of the issuer master and of the rules' texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotloom.operators import adapter, calendar, ledger, reports, rules
from lotloom.operators import master as issuers
from lotloom.operators.store import Store, records
from lotloom.queries import RULES_SQL, _events, _events_sql, _rule_records
from lotloom.registry import ALL, LOG, LOTS, query
from lotloom.session import Scratch, table
from lotloom.sources import filings
from lotloom.streaming import feed

#: The time of all writes here; data of these tables lie decades before.
NOW_SQL = "TIMESTAMP '2020-01-01 00:00:00'"


def _now() -> Column:
    return F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")


def _versions(spark: SparkSession, d: str) -> DataFrame:
    """Records of one exchange, whose file names are unique, in their first version."""
    log = adapter.log(spark, d).where("exchange = 'NSE'")
    none = {c: F.lit(None).cast("string") for c in ("error_message",)}
    return log.withColumns({**none, "version": F.lit(1), "finalized_at": F.when(F.col("status") == "FINALIZED", F.col("processed_at")), "lockin_pdf_path": F.concat(F.lit("in/"), "file_name")})


@query(f"""{LOG}, n AS (SELECT * FROM log WHERE exchange = 'NSE')
SELECT file_name, 2 AS version, unique_symbol, 'in/' || file_name AS lockin_pdf_path, computed_total + CASE WHEN id % 2 = 0 THEN 2 ELSE 1 END AS computed_total, NULL::VARCHAR AS error_message, {NOW_SQL} AS processed_at FROM n WHERE id % 3 = 0
UNION ALL SELECT file_name || 'x', 1, 'NSE:new', 'out', computed_total, NULL, {NOW_SQL} FROM n WHERE id % 3 = 1""")
def upserted_records(spark: SparkSession, d: str) -> DataFrame:
    """Incoming records, some twice: known ones keep path and symbol, the last of equal keys counts."""
    now = _versions(spark, d)
    known = now.where("id % 3 = 0").withColumns({"lockin_pdf_path": F.lit("out"), "unique_symbol": F.lit("NSE:new"), "error_message": F.lit("old")})
    once, again = known.withColumns({"computed_total": F.col("computed_total") + 1, "arrived": F.lit(1)}), known.where("id % 2 = 0").withColumns({"computed_total": F.col("computed_total") + 2, "arrived": F.lit(2)})
    new = now.where("id % 3 = 1").withColumns({"file_name": F.concat("file_name", F.lit("x")), "lockin_pdf_path": F.lit("out"), "unique_symbol": F.lit("NSE:new"), "arrived": F.lit(1)})
    incoming = once.unionByName(again).unionByName(new).drop("version")
    return ledger.upserted(now, incoming, _now(), "arrived").select("file_name", "version", "unique_symbol", "lockin_pdf_path", "computed_total", "error_message", "processed_at")


@query(f"""{RULES_SQL}, s AS (SELECT id, string_agg(rule_id, ',' ORDER BY place) FILTER (NOT passed) AS failed_rules, bool_and(passed) AS all_rules_passed, max(actual) FILTER (rule_id = 'RULE8') AS negative, string_agg(rule_id, ',' ORDER BY place) AS rules FROM v GROUP BY id)
SELECT s.id, failed_rules, all_rules_passed, negative::BIGINT AS negative, rules || ',_strategies' AS keys, CASE WHEN s.id % 2 = 0 THEN 'line_by_line' END AS lockin_strategy FROM s""")
def verdict_records(spark: SparkSession, d: str) -> DataFrame:
    """Records with their verdicts and strategies as JSON, keys in the order of the rules."""
    records = _rule_records(spark, d).withColumn("version", F.lit(1))
    strategies = records.where("id % 2 = 0").select("id", F.lit("line_by_line").alias("lockin_strategy"), F.lit(None).cast("string").alias("shp_strategy"))
    out = ledger.with_verdicts_rows(rules.judged(records), _now(), strategies)
    json = F.col("validation_results")
    return out.select("id", "failed_rules", "all_rules_passed", F.get_json_object(json, "$.RULE8.actual").cast("bigint").alias("negative"), F.array_join(F.json_object_keys(json), ",").alias("keys"), F.get_json_object(json, "$._strategies.lockin_strategy").alias("lockin_strategy"))


@query("SELECT strategy, n, n * 1000 // sum(n) OVER () AS permille FROM (SELECT event_type AS strategy, count(*) AS n FROM events WHERE event_id % 3 > 0 GROUP BY 1)")
def strategy_counts(spark: SparkSession, d: str) -> DataFrame:
    """Strategies by the key that records bear; records without one don't count."""
    events = table(spark, d, "events")
    own = F.struct(F.when(F.col("event_id") % 3 > 0, F.col("event_type")).alias("lockin_strategy"))
    return reports.strategy_counts(events.select(F.to_json(F.struct(own.alias("_strategies"))).alias("validation_results")), "lockin_strategy").select("strategy", "n", "permille")


@query(f"{LOG} SELECT id, 2 AS version, 'broken ' || id AS error_message, {NOW_SQL} AS updated_at FROM log WHERE exchange = 'NSE' AND id % 5 = 0")
def records_with_errors(spark: SparkSession, d: str) -> DataFrame:
    now = _versions(spark, d)
    errors = now.where("id % 5 = 0").select("id", F.concat(F.lit("broken "), F.col("id").cast("string")).alias("error_message"))
    return ledger.with_error(now, errors, _now()).select("id", "version", "error_message", "updated_at")


@query(f"""{LOG} SELECT id, 'FINALIZED' AS status, 2 AS version, {NOW_SQL} AS finalized_at FROM log WHERE exchange = 'NSE' AND status = 'VALIDATING' UNION ALL SELECT id, 'VALIDATING', 2, NULL FROM log WHERE exchange = 'NSE' AND status <> 'FAILED' AND id % 2 = 0""")
def moved_records(spark: SparkSession, d: str) -> DataFrame:
    """What may be finalized, and what may go back to be validated."""
    now = _versions(spark, d)
    moved = ledger.moved(now, "FINALIZED", _now()).unionByName(ledger.moved(now, "VALIDATING", _now(), F.col("id") % 2 == 0))
    return moved.select("id", "status", "version", "finalized_at")


@query(f"SELECT 'NSE:7' AS unique_symbol, 'NSE' AS exchange, '' AS file_name, 'FAILED' AS status, 'no file' AS error_message, 1 AS version, {NOW_SQL} AS processed_at")
def failed_record(spark: SparkSession, d: str) -> DataFrame:
    return ledger.failed(_versions(spark, d), "NSE:7", "NSE", "no file", _now()).select("unique_symbol", "exchange", "file_name", "status", "error_message", "version", "processed_at")


@query(f"{LOG} SELECT id, version, status FROM (SELECT id, 1 AS version, status FROM log WHERE exchange = 'NSE' AND NOT (id % 2 = 0 AND status <> 'FAILED') UNION ALL SELECT id, 2, 'VALIDATING' FROM log WHERE exchange = 'NSE' AND id % 2 = 0 AND status <> 'FAILED')")
def appended_versions(spark: SparkSession, d: str) -> DataFrame:
    """A batch of new versions is appended as one commit; readers see the newest of each record."""
    store, now = Store(spark, Scratch(spark, "versions").path("ledger")), _versions(spark, d).select("id", "exchange", "file_name", "status", "version", "finalized_at", "processed_at")
    moved = ledger.moved(now, "VALIDATING", _now(), F.col("id") % 2 == 0).drop("updated_at")
    store.commit({"log": now}, 0, "first")
    store.commit({"log": moved}, 1, "moved")
    return records(store).select("id", "version", "status")


@query(f"{LOG} SELECT processing_log_id, count(*) AS n FROM lots JOIN log ON processing_log_id = id WHERE exchange = 'NSE' GROUP BY 1")
def current_lots(spark: SparkSession, d: str) -> DataFrame:
    """Lots of older versions fall away."""
    log = _versions(spark, d).withColumns({"processing_log_id": F.col("id"), "version": F.lit(2)})
    lots = adapter.lots(spark, d)
    both = lots.withColumn("version", F.lit(1)).unionByName(lots.withColumn("version", F.lit(2)))
    return ledger.current_lots(both, log).groupBy("processing_log_id").agg(F.count("*").alias("n"))


@query(f"""{RULES_SQL}, s AS (SELECT v.id, bool_and(passed) AS ok, string_agg(CASE WHEN NOT passed THEN rule_id END, ',' ORDER BY place) AS failed FROM (SELECT * REPLACE (CASE WHEN rule_id = 'RULE2' THEN r2 ELSE passed END AS passed) FROM v JOIN (SELECT id AS i, coalesce(declared_total = computed_total, false) AS r2 FROM r) ON v.id = i) v GROUP BY v.id)
SELECT s.id, CASE WHEN ok THEN 'FINALIZED' ELSE 'VALIDATING' END AS status, 2 AS version, failed AS failed_rules, CASE WHEN ok THEN {NOW_SQL} END AS finalized_at, NOT ok AS has_error FROM s JOIN log ON log.id = s.id WHERE log.status <> 'FINALIZED'""")
def revalidated_records(spark: SparkSession, d: str) -> DataFrame:
    """Rules in their strict form over stored values: what passes is finalized, the rest says why not."""
    records = _rule_records(spark, d).withColumns({"version": F.lit(1), "error_message": F.lit(None).cast("string"), "finalized_at": F.lit(None).cast("timestamp_ntz")})
    out = ledger.revalidated_rows(rules.judged(records, strict=True), _now())
    return out.select("id", "status", "version", "failed_rules", "finalized_at", F.coalesce(F.col("error_message").startswith("Finalization skipped: Not all validation rules passed | RULE"), F.lit(False)).alias("has_error"))


@query(f"{LOG} SELECT unique_symbol, processed_at AS finalized_at FROM log QUALIFY row_number() OVER (PARTITION BY unique_symbol ORDER BY processed_at DESC, id DESC) = 1 AND status = 'FINALIZED'")
def blocked_symbols(spark: SparkSession, d: str) -> DataFrame:
    """Symbols that must be rolled back before they are processed again."""
    log = adapter.log(spark, d).withColumn("finalized_at", F.when(F.col("status") == "FINALIZED", F.col("processed_at")))
    return ledger.blocked(log, log.select("unique_symbol"))


@query(f"""{LOG}, one AS (SELECT min(id) AS id FROM log WHERE exchange = 'NSE')
SELECT log.id, 'NSE:N''EW' AS unique_symbol, 'N''EW-CML' || log.id || '.pdf' AS file_name, 'in/N''EW-CML' || log.id || '.pdf' AS lockin_pdf_path, 2 AS version FROM log JOIN one USING (id)""")
def renamed_record(spark: SparkSession, d: str) -> DataFrame:
    """A record under another symbol, one with a quote in it, in key, file name and paths."""
    now = _versions(spark, d)
    master = spark.range(1).select(F.lit("n'ew").alias("nse_symbol"))
    return ledger.renamed(now, master, now.agg(F.min("id").alias("id")), "N'EW", _now()).select("id", "unique_symbol", "file_name", "lockin_pdf_path", "version")


@query(f"""{LOG}, x AS (SELECT processing_log_id AS scrip_id, shares, lockin_date_to AS t, CASE WHEN shares % 2 = 0 THEN lockin_date_from END AS f, lockin_date_from + 10 AS a, lower(status) AS c FROM lots),
y AS (SELECT *, CASE WHEN c <> 'free' AND t IS NOT NULL THEN abs(t - coalesce(f, a)) END AS n FROM x),
z AS (SELECT *, CASE WHEN c = 'free' OR t IS NULL THEN 'free' WHEN n BETWEEN 15 AND 45 THEN 'anchor_30' WHEN n BETWEEN 75 AND 105 THEN 'anchor_90' WHEN n BETWEEN 330 AND 400 THEN '1_year' WHEN n BETWEEN 690 AND 780 THEN '2_year' WHEN n BETWEEN 1055 AND 1145 THEN '3_year' ELSE 'unknown' END AS b FROM y)
SELECT scrip_id, 2 AS version, sum(shares)::BIGINT AS computed_total, 'MANUAL_LOCKED' AS status, count(*) FILTER (b = 'unknown') AS unknown, sum(n)::BIGINT AS days, count(*) FILTER (b = 'anchor_90') AS anchor_90 FROM z GROUP BY 1""")
def legacy_saves(spark: SparkSession, d: str) -> DataFrame:
    lots = adapter.lots(spark, d)
    rows = lots.select(F.col("processing_log_id").alias("scrip_id"), "shares", F.when(F.col("shares") % 2 == 0, F.col("lockin_date_from")).alias("lock_from"), F.col("lockin_date_to").alias("lock_upto"), F.lower("status").alias("row_class"), F.col("security_type").alias("type_raw"))
    allotments = lots.groupBy(F.col("processing_log_id").alias("scrip_id")).agg(F.date_add(F.min("lockin_date_from"), 10).alias("allotment_date"))
    details = allotments.select("scrip_id", F.lit(1).alias("version"))
    header, saved = ledger.legacy_saved(details, rows, allotments, _now())
    facts = saved.groupBy("scrip_id").agg(F.count_if(F.col("lock_bucket") == "unknown").alias("unknown"), F.sum("days_locked").alias("days"), F.count_if(F.col("lock_bucket") == "anchor_90").alias("anchor_90"))
    return header.join(facts, "scrip_id").select("scrip_id", "version", "computed_total", "status", "unknown", "days", "anchor_90")


# Masters, files and pairs


_SLUG = "m.allotment IS NULL AND p.id % 50 < 25"


@query(f"""WITH m AS (SELECT c_custkey, c_name AS company_name, CASE WHEN c_custkey % 3 <> 0 THEN DATE '2024-01-01' + (c_custkey % 100)::INT END AS allotment FROM customer)
SELECT p.id, CASE WHEN {_SLUG} THEN 'Issuer ' || (p.id % 50) ELSE m.company_name END AS company_name, CASE WHEN {_SLUG} THEN DATE '2023-01-01' + (p.id % 50)::INT ELSE coalesce(m.allotment, DATE '2022-05-05') END AS reference_date,
    CASE WHEN {_SLUG} THEN p.id ELSE m.c_custkey END AS post_issue_shares FROM (SELECT o_orderkey AS id, o_custkey FROM orders) p JOIN m ON m.c_custkey = p.o_custkey""")
def resolved_issuers(spark: SparkSession, d: str) -> DataFrame:
    """Issuers by key; without a date there by the slug of the notice's company, as a whole; what is still missing from the notice."""
    kind = "company_name string, url_slug string, bse_script_code string, nse_symbol string, allotment_date date, listing_date_actual date, expected_listing_date date, post_issue_shares bigint, anchor_letter_url string"
    even = F.col("c_custkey") % 2 == 0
    none = lambda t: F.lit(None).cast(t)
    own = table(spark, d, "customer").select(
        F.col("c_name").alias("company_name"), none("string").alias("url_slug"), F.when(even, F.col("c_custkey").cast("string")).alias("bse_script_code"), F.when(~even, F.col("c_custkey").cast("string")).alias("nse_symbol"),
        F.when(F.col("c_custkey") % 3 != 0, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 100).cast("int"))).alias("allotment_date"), none("date").alias("listing_date_actual"), none("date").alias("expected_listing_date"),
        F.col("c_custkey").alias("post_issue_shares"), none("string").alias("anchor_letter_url"),
    )
    slugs = spark.range(25).select(
        F.concat(F.lit("Issuer "), F.col("id").cast("string")).alias("company_name"), F.concat(F.lit("slug_"), F.col("id").cast("string"), F.lit("_ipo")).alias("url_slug"), none("string").alias("bse_script_code"), none("string").alias("nse_symbol"),
        F.date_add(F.lit("2023-01-01").cast("date"), F.col("id").cast("int")).alias("allotment_date"), none("date").alias("listing_date_actual"), none("date").alias("expected_listing_date"), none("bigint").alias("post_issue_shares"), none("string").alias("anchor_letter_url"),
    )
    master = own.unionByName(slugs).select(*(c.split()[0] for c in kind.split(", ")))
    records = adapter.log(spark, d).select("id", "exchange", "unique_symbol")
    hints = records.select("id", F.lit("2022-05-05").cast("date").alias("listing_date"), F.col("id").alias("shares"), F.concat(F.lit("Slug "), (F.col("id") % 50).cast("string"), F.lit(" Limited")).alias("company_name"))
    return issuers.resolved(records, master, hints).select("id", "company_name", "reference_date", "post_issue_shares")


@query("""SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'a' || c_custkey END AS shp_path FROM customer""")
def paired_documents(spark: SparkSession, d: str) -> DataFrame:
    """Lock-in documents with the shareholding pattern of the same issuer, the first by path."""
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.lit("NSE").alias("exchange"), F.col("c_custkey").cast("string").alias("symbol"))
    shps = rows.where("id % 3 <> 0").select("exchange", "symbol", F.explode(F.array(F.concat(F.lit("b"), "symbol"), F.concat(F.lit("a"), "symbol"))).alias("path"), F.lit("text").alias("text"))
    return issuers.paired(rows, shps).select("id", "shp_path")


@query("""SELECT doc_id, n = 0 AS needed, n > 0 AND n < 100 AS doubtful FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 OR text IS NULL THEN 0 WHEN doc_id % 5 = 0 THEN least(len(text), 60) WHEN doc_id % 7 = 0 THEN 0 ELSE len(text) END AS n FROM documents)""")
def texts_needed(spark: SparkSession, d: str) -> DataFrame:
    """Which documents still lack a text, and which have next to none: some texts are missing, some empty, some cut short."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    kept = F.when(F.col("doc_id") % 5 == 0, F.substring("text", 1, 60)).when(F.col("doc_id") % 7 == 0, "").otherwise(F.col("text"))
    return filings.text_states(docs.select("doc_id"), docs.where("doc_id % 3 > 0").select("doc_id", kept.alias("text")), "doc_id")


@query("""SELECT c_custkey::VARCHAR AS code, CASE WHEN c_custkey % 4 > 0 THEN 'first ' || c_custkey END AS notice_text FROM customer""")
def first_notices(spark: SparkSession, d: str) -> DataFrame:
    codes = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("code"))
    of = lambda tail, say: codes.where("code % 4 > 0").select(F.concat(F.lit("/n/"), "code", F.lit(tail)).alias("path"), F.concat(F.lit(say), "code").alias("text"))
    return filings.first_notice(codes, of("-b.txt", "second ").unionByName(of("-a.txt", "first ")))


@query("""SELECT '/l/S' || c_custkey || '-CML1_java.txt' AS path, CASE c_custkey % 3 WHEN 0 THEN '/s/SHP-S' || c_custkey || '_java.txt' WHEN 1 THEN '/s/SHP_S' || c_custkey || '_java.txt' END AS shp_path FROM customer""")
def pattern_files(spark: SparkSession, d: str) -> DataFrame:
    """The first of a lock-in file's candidates that exists."""
    key = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("k"))
    lockins = key.select(F.concat(F.lit("/l/S"), "k", F.lit("-CML1_java.txt")).alias("path"))
    of = lambda where, mark: key.where(where).select(F.concat(F.lit(f"/s/SHP{mark}S"), "k", F.lit("_java.txt")).alias("path"))
    return filings.pattern_file(lockins, of("k % 3 = 0", "-").unionByName(of("k % 3 < 2", "_")))


@query("""SELECT CASE WHEN o_custkey % 2 = 0 THEN 'BSE' ELSE 'NSE' END AS exchange, CASE WHEN o_orderkey % 3 = 0 THEN 'passed' ELSE 'failed' END AS outcome, count(*) AS n FROM orders GROUP BY 1, 2""")
def folder_counts(spark: SparkSession, d: str) -> DataFrame:
    return reports.folder_counts(adapter.log(spark, d).select("exchange", F.when(F.col("id") % 3 == 0, "passed").otherwise("failed").alias("outcome")))


@query(f"""{ALL} SELECT p.id, p.shp_promoter_shares AS promoter_shares, p.shp_others_shares AS other_shares, p.status = 'FINALIZED' AS finalized, coalesce(m.company_name, m.ipo_name) AS company_name FROM log p LEFT JOIN master m ON coalesce(m.bse_script_code, m.nse_symbol) = split_part(p.unique_symbol, ':', 2)""")
def record_views(spark: SparkSession, d: str) -> DataFrame:
    records = issuers.with_master(adapter.log(spark, d), adapter.master(spark, d))
    return reports.record_view(records).select("id", "promoter_shares", "other_shares", "finalized", "company_name")


@query(f"{LOG} SELECT id FROM log WHERE exchange = 'BSE' AND status = 'VALIDATING' AND split_part(unique_symbol, ':', 2) LIKE '%1%'")
def filtered_records(spark: SparkSession, d: str) -> DataFrame:
    """A part of the exchange's code, exchange and state."""
    records = adapter.log(spark, d).withColumns({"code": F.substring_index("unique_symbol", ":", -1), "lots": F.array()})
    return calendar.shown(records, text="1", exchange="BSE", status="VALIDATING", within=("code",)).select("id")


@query(f"SELECT processing_id, count(*) AS events, sum(shares_unlocked)::BIGINT AS shares FROM ({_events_sql()}) GROUP BY 1")
def feed_texts(spark: SparkSession, d: str) -> DataFrame:
    """The feed as JSON texts, read back."""
    json = calendar.feed_json(calendar.in_feed_order(_events(spark, d)))
    read = F.from_json("json", "struct<unlock_events:array<struct<shares_unlocked:bigint>>>")["unlock_events"]
    return json.select("processing_id", F.size(read).cast("bigint").alias("events"), F.aggregate(read, F.lit(0).cast("bigint"), lambda s, e: s + e["shares_unlocked"]).alias("shares"))


# What rules say


_N = "format('{{:,}}', {})"


def _sum_said(left: str, right: str, passed: str) -> str:
    return f"{left} || CASE WHEN {passed} THEN ' == ' ELSE ' != ' END || {right}"


def _part(label: str, value: str) -> str:
    return f"'{label} (' || {_N.format(value)} || ')'"


_MESSAGES = f"""{RULES_SQL}, m AS (SELECT id,
    {_sum_said(_part('Locked', 'locked_total') + " || ' + ' || " + _part('Free', 'f1') + " || ' = ' || " + _N.format('locked_total + f1'), _part('Computed Total', 'computed_total'), 'locked_total + f1 = computed_total')} AS rule1,
    {_sum_said(_part('SHP Total', 'shp_total_shares'), _part('Lock-in Total', 'computed_total'), 'computed_total = shp_total_shares')} AS rule3,
    {_sum_said(_part('SHP Locked', 'shp_locked_shares'), _part('Lock-in Locked', 'locked_total'), 'locked_total = shp_locked_shares')} AS rule4,
    CASE WHEN anchor_letter_url IS NOT NULL AND a30 > 0 AND a90 > 0 THEN 'Anchor letter URL exists and both anchor buckets found (anchor_30=' || a30 || ', anchor_90=' || a90 || ')'
        WHEN anchor_letter_url IS NOT NULL THEN 'Anchor letter URL exists but missing required anchor bucket(s): ' || concat_ws(', ', CASE WHEN a30 = 0 THEN 'anchor_30' END, CASE WHEN a90 = 0 THEN 'anchor_90' END) || ' (anchor_30=' || a30 || ', anchor_90=' || a90 || ')'
            || CASE WHEN old THEN legacy ELSE '' END
        WHEN a30 + a90 = 0 THEN 'No anchor letter URL and no anchor rows (correct)' ELSE 'No anchor letter URL but ' || (a30 + a90) || ' anchor row(s) found' || CASE WHEN old THEN legacy ELSE ' (unexpected)' END END AS rule6,
    CASE WHEN lf = 0 THEN 'All locked rows with lock-in dates have non-free buckets' ELSE 'Found ' || lf || ' locked row(s) with lock-in date but bucket=free' END AS rule7,
    CASE WHEN neg = 0 THEN 'No negative lock-period rows found' ELSE 'Found ' || neg || ' row(s) with negative lock period' END AS rule8,
    CASE WHEN noend = 0 THEN 'All locked rows have valid lock-in upto dates' ELSE 'Found ' || noend || ' locked row(s) with missing/invalid lock-in upto date' END AS rule10
    FROM (SELECT *, free_total + CASE WHEN id % 7 = 0 THEN 3 ELSE 0 END AS f1, processed_at::DATE <= DATE '1994-12-31' AS old,
        ' (legacy ' || exchange || ' exception: allotment_date ' || (DATE '2024-12-02' + (processed_at::DATE - DATE '1994-12-31')::INT) || ' <= 2024-12-02)' AS legacy FROM r))"""


@query(f"{_MESSAGES} SELECT * FROM m")
def rule_messages(spark: SparkSession, d: str) -> DataFrame:
    """What the rules say, both when they pass and when they fail; a seventh of the records has free shares that don't add up."""
    records = _rule_records(spark, d).withColumn("free_total", F.col("free_total") + F.when(F.col("id") % 7 == 0, 3).otherwise(0))
    return records.select("id", *(rules.one(r)["message"].alias(r.lower()) for r in ("RULE1", "RULE3", "RULE4", "RULE6", "RULE7", "RULE8", "RULE10")))


@query(f"""{LOG}, p AS (SELECT *, CASE WHEN id % 4 > 0 THEN DATE '2024-12-02' + (processed_at::DATE - DATE '1994-12-31')::INT + CASE WHEN id % 8 = 5 THEN 4000 ELSE 0 END END AS allotment, CASE WHEN id % 3 > 0 THEN 'u' END AS url, CASE WHEN id % 5 > 0 THEN computed_total END AS declared FROM log),
l AS (SELECT processing_log_id AS id, lower(bucket) AS bucket, status, lockin_date_to AS t, CASE WHEN row_order % 2 = 0 THEN lockin_date_from END AS f FROM lots),
c AS (SELECT p.id, count(*) FILTER (bucket = 'anchor_30') AS a, count(*) FILTER (bucket = 'anchor_90') AS b, count(*) FILTER (l.status = 'LOCKED' AND t < coalesce(f, allotment)) AS neg FROM p JOIN l ON l.id = p.id GROUP BY 1)
SELECT id, coalesce(declared, 0) = computed_total AS rule2, CASE WHEN url IS NOT NULL THEN a > 0 AND b > 0 ELSE a + b = 0 END OR coalesce(allotment <= DATE '2024-12-02', false) AS rule6, neg = 0 AS rule8, neg AS negative
FROM (SELECT p.id, url, allotment, declared, coalesce(computed_total, 0) AS computed_total, coalesce(a, 0) AS a, coalesce(b, 0) AS b, coalesce(neg, 0) AS neg FROM p LEFT JOIN c ON c.id = p.id)""")
def strict_rules(spark: SparkSession, d: str) -> DataFrame:
    """The strict form: the stored allotment date, which some records lack, decides lock periods and the anchor rule; a missing declared total is zero."""
    log, lots = adapter.log(spark, d), adapter.lots(spark, d)
    moved = F.date_add(F.lit(rules.ANCHOR_CUTOFF).cast("date"), F.date_diff(F.col("processed_at").cast("date"), F.lit("1994-12-31").cast("date")) + F.when(F.col("id") % 8 == 5, 4000).otherwise(0))
    records = log.withColumns({
        "allotment_date": F.when(F.col("id") % 4 > 0, moved), "anchor_letter_url": F.when(F.col("id") % 3 > 0, "u"), "declared_total": F.when(F.col("id") % 5 > 0, F.col("computed_total")), "text_total": F.col("computed_total"), "shp_locked_shares": F.col("locked_total"),
    })
    own = lots.withColumns({"bucket": F.upper("bucket"), "lockin_date_from": F.when(F.col("row_order") % 2 == 0, F.col("lockin_date_from"))})
    ready = rules.stored(records, own)
    passed = lambda r: rules.one(r, strict=True)["passed"].alias(r.lower())
    return ready.select("id", passed("RULE2"), passed("RULE6"), passed("RULE8"), F.col("negative_periods").alias("negative"))


# Streams, in batch


@query("""SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM (
SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS fresh FROM events)) GROUP BY user_id, session""")
def event_sessions(spark: SparkSession, d: str) -> DataFrame:
    return feed.sessions(table(spark, d, "events"))


@query(f"{LOG} SELECT date_trunc('day', processed_at) AS start, unique_symbol, max(id) AS id, arg_max(status, id) AS status FROM log GROUP BY 1, 2")
def newest_by_day(spark: SparkSession, d: str) -> DataFrame:
    return feed.newest_by_symbol(adapter.log(spark, d))
