"""Queries of the extraction strategies: filings in the layout that only one strategy accepts, and what it must read from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lotloom.functions import numbers, text
from lotloom.operators import adapter, ledger, reports
from lotloom.plans import cells as plan_cells
from lotloom.plans import lockin, shp
from lotloom.registry import LOG, LOTS, query
from lotloom.session import spread, table

#: Lots of positive size by record, numbered from 1, with running distinctive numbers; shares in thousands. The same in SQL.
_ROWS_SQL = f"""{LOTS}, x AS (SELECT processing_log_id AS id, row_number() OVER w AS n, shares * 1000 AS shares, (sum(shares) OVER (w ROWS UNBOUNDED PRECEDING) * 1000)::BIGINT AS last, lockin_date_from, lockin_date_to, status FROM lots WHERE shares > 0
    WINDOW w AS (PARTITION BY processing_log_id ORDER BY row_order, shares, distinctive_from, lockin_date_to NULLS FIRST))"""


def _rows(spark: SparkSession, d: str) -> DataFrame:
    order = Window.partitionBy("processing_log_id").orderBy("row_order", "shares", "distinctive_from", F.asc_nulls_first("lockin_date_to"))
    rows = adapter.lots(spark, d).where("shares > 0").withColumns({"last": F.sum("shares").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) * 1000, "n": F.row_number().over(order)})
    return rows.select(F.col("processing_log_id").alias("id"), "n", (F.col("shares") * 1000).alias("shares"), (F.col("last") - F.col("shares") * 1000 + 1).alias("first"), "last", "lockin_date_from", "lockin_date_to", "status")


def _documents(rows: DataFrame, line: Column, head: str, total: Column | None) -> DataFrame:
    """A document per record: a head, a line per lot, and a line made of the total ``t``."""
    by = rows.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("n", line.alias("line")))).alias("l"), F.sum("shares").alias("t"), F.count_if(F.col("status") == "LOCKED").alias("locked_rows"))
    return by.select("id", F.lit("BSE").alias("exchange"), F.concat_ws("\n", F.lit(head), F.array_join(F.transform("l", lambda r: r["line"]), "\n"), total if total is not None else F.lit(None).cast("string")).alias("text"), "t", "locked_rows")


def _line(sep: str, *, dates: str = "dd-MMM-yyyy", own: bool = True, shares: bool = True, spoilt: int = 0) -> Column:
    n = numbers.grouped
    locked = F.col("status") == "LOCKED"
    parts = [n(F.col("shares"))] if shares else []
    parts += [n(F.col("first")) if shares else F.col("first").cast("string"), n(F.col("last") + spoilt) if shares else F.col("last").cast("string")]
    parts += [F.when(locked, "Lock-in").otherwise("Fully Paid")]
    parts += [F.when(locked, F.date_format("lockin_date_from", dates))] if own else []
    return F.concat_ws(sep, *parts, F.when(locked, F.date_format("lockin_date_to", dates)).otherwise("Free"), F.lit("Demat"))


def _facts(filings: DataFrame) -> DataFrame:
    found = lockin.extract(filings).select("id", "lockin.strategy", "lockin.computed_total", "lockin.locked_shares", "lockin.rows_count", F.transform("lockin.lots", lambda r: r["to_no"]).alias("to_numbers"))
    return found


def _facts_sql(strategy: str, having: str = "", spoilt: int = 0) -> str:
    return f"""{_ROWS_SQL} SELECT id, '{strategy}' AS strategy, sum(shares)::BIGINT AS computed_total, coalesce(sum(shares) FILTER (status = 'LOCKED'), 0)::BIGINT AS locked_shares, count(*)::INT AS rows_count, list(last + {spoilt} ORDER BY n) AS to_numbers FROM x GROUP BY id {having}"""


def _without_total(rows: DataFrame) -> DataFrame:
    """No total in the text, so that nothing can be read from it upward."""
    return _documents(rows, _line("   "), "Number of Securities   From   To", None)


def _close_columns(rows: DataFrame) -> DataFrame:
    """Columns one space apart, which a mender of numbers joins; the known total tells."""
    return _documents(rows, _line(" "), "Number of Securities From To", numbers.grouped(F.col("t"))).withColumn("known_total", F.col("t"))


def _ranges_only(rows: DataFrame) -> DataFrame:
    """Distinctive numbers only; shares follow from them."""
    return _documents(rows, _line("  ", dates="dd/MM/yyyy", own=False, shares=False), "From To Type Date", None)


def _spoilt_ranges(rows: DataFrame) -> DataFrame:
    """Distinctive numbers that disagree with the shares in every row; the shares make up the total."""
    return _documents(rows, _line("  ", spoilt=5), "Securities  From  To", F.concat(F.lit("Total "), numbers.grouped(F.col("t"))))


def _stray_hint(rows: DataFrame) -> DataFrame:
    """A hint that is on the page but is no total: only the strategy that doesn't ask for it accepts, and only where some shares are locked."""
    docs = _documents(rows, _line("   "), "Securities   From   To", F.concat(F.lit("Total "), numbers.grouped(F.col("t"))))
    return docs.where("locked_rows > 0").withColumn("declared_hint", F.lit(1).cast("bigint"))


#: Layouts by the strategy that reads them.
_LAYOUTS = (("line_by_line", _without_total), ("no_malformed_cleanup", _close_columns), ("range_calculation", _ranges_only), ("sum_first_soft_labels", _spoilt_ranges), ("two_dates_fallback", _stray_hint))


@query(_facts_sql("line_by_line"))
def layout_line_by_line(spark: SparkSession, d: str) -> DataFrame:
    return _facts(_without_total(_rows(spark, d)))


@query(_facts_sql("no_malformed_cleanup"))
def layout_close_columns(spark: SparkSession, d: str) -> DataFrame:
    return _facts(_close_columns(_rows(spark, d)))


@query(_facts_sql("range_calculation"))
def layout_ranges(spark: SparkSession, d: str) -> DataFrame:
    return _facts(_ranges_only(_rows(spark, d)))


@query(_facts_sql("sum_first_soft_labels", spoilt=5))
def layout_spoilt_ranges(spark: SparkSession, d: str) -> DataFrame:
    return _facts(_spoilt_ranges(_rows(spark, d)))


@query(_facts_sql("two_dates_fallback", "HAVING count(*) FILTER (status = 'LOCKED') > 0"))
def layout_two_dates(spark: SparkSession, d: str) -> DataFrame:
    return _facts(_stray_hint(_rows(spark, d)))


@query(f"""{_ROWS_SQL} SELECT id, {[name for name, _ in _LAYOUTS]}[1 + id % 5] AS strategy, sum(shares)::BIGINT AS computed_total, coalesce(sum(shares) FILTER (status = 'LOCKED'), 0)::BIGINT AS locked_shares, count(*)::INT AS rows_count,
    list(last + CASE WHEN id % 5 = 3 THEN 5 ELSE 0 END ORDER BY n) AS to_numbers FROM x GROUP BY id HAVING id % 5 < 4 OR count(*) FILTER (status = 'LOCKED') > 0""")
def mixed_layouts(spark: SparkSession, d: str) -> DataFrame:
    """Filings in all layouts in one extraction, each left to the strategy that reads its layout."""
    docs = [make(_rows(spark, d).where(f"id % {len(_LAYOUTS)} = {i}")) for i, (_, make) in enumerate(_LAYOUTS)]
    return _facts(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), docs))


@query("""SELECT o_orderkey AS id, 'sum_first_soft_labels' AS strategy, 12 * (o_orderkey % 90 + 10) AS computed_total, 2 AS rows_count FROM orders""")
def layout_contiguous_part(spark: SparkSession, d: str) -> DataFrame:
    """Three lots of which only the first two, next to each other, make up the total."""
    k = F.col("o_orderkey") % 90 + 10
    line = lambda m: F.concat_ws("  ", (k * m).cast("string"), F.lit("1"), (k * m + 5).cast("string"), F.lit("L"), F.lit("01-Jan-2027"), F.lit("Demat"))
    doc = F.concat_ws("\n", F.lit("Securities  From  To"), line(5), line(7), line(10), F.concat(F.lit("Total "), (k * 12).cast("string")))
    docs = spread(table(spark, d, "orders").select("o_orderkey"), "o_orderkey").select(F.col("o_orderkey").alias("id"), F.lit("BSE").alias("exchange"), doc.alias("text"))
    return lockin.extract(docs).select("id", "lockin.strategy", "lockin.computed_total", "lockin.rows_count")


@query(f"""{_ROWS_SQL}, s AS (SELECT id, list({{'unlock_date': strftime(lockin_date_to, '%d-%b-%Y'), 'shares': shares}} ORDER BY n) FILTER (status = 'LOCKED' AND shares <> year(lockin_date_to)) AS unlock_schedule, coalesce(sum(shares) FILTER (status = 'FREE'), 0) * 100.0 / sum(shares) AS p FROM x GROUP BY id)
SELECT id, coalesce(unlock_schedule, []) AS unlock_schedule, p > 50 AS mostly_free FROM s""")
def unlock_schedules(spark: SparkSession, d: str) -> DataFrame:
    """The schedule after the table of an NSE filing, and the share of what is free. A number that is also part of the line's date isn't taken for shares."""
    rows = _rows(spark, d)
    n = numbers.grouped
    lot = F.concat_ws("   ", n(F.col("shares")), n(F.col("first")), n(F.col("last")), F.coalesce(F.date_format("lockin_date_to", "dd-MMM-yyyy"), F.lit("Free")))
    due = F.when(F.col("status") == "LOCKED", F.concat_ws("   ", F.date_format("lockin_date_to", "dd-MMM-yyyy"), n(F.col("shares"))))
    by = rows.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("n", lot.alias("lot"), due.alias("due")))).alias("l"))
    doc = F.concat_ws("\n", F.lit("Annexure 1"), F.array_join(F.transform("l", lambda r: r["lot"]), "\n"), F.lit("Annexure II: shares that become tradable"), F.array_join(F.array_compact(F.transform("l", lambda r: r["due"])), "\n"), F.lit("Annexure I ends"))
    found = lockin.scheduled(lockin.extract(by.select("id", F.lit("NSE").alias("exchange"), doc.alias("text"))))
    return found.select("id", "unlock_schedule", (F.col("free_percent") > 50).alias("mostly_free"))


@query(f"""{_ROWS_SQL} SELECT id AS processing_log_id, 7 AS version, (n - 1)::INT AS row_order, shares, last - shares + 1 AS distinctive_from, last AS distinctive_to FROM x""")
def replaced_lots(spark: SparkSession, d: str) -> DataFrame:
    """Lots as they are stored under the version that replaces older ones."""
    docs = _documents(_rows(spark, d), F.concat_ws("   ", numbers.grouped(F.col("shares")), numbers.grouped(F.col("first")), numbers.grouped(F.col("last"))), "Shares From To", None)
    read = lockin.extract(docs.withColumn("exchange", F.lit("NSE"))).withColumnRenamed("id", "processing_log_id")
    return ledger.replaced_lots(read, F.lit(7)).select("processing_log_id", "version", "row_order", "shares", "distinctive_from", "distinctive_to")


@query("""SELECT o_orderkey AS id, o_orderkey % 2 = 0 AS skipped, CASE WHEN o_orderkey % 2 = 0 THEN 'Blank lock-in file detected (2 pages, 0 chars of actual content)' END AS error, CASE WHEN o_orderkey % 2 = 1 THEN 1 END AS lots FROM orders""")
def blank_filings(spark: SparkSession, d: str) -> DataFrame:
    """A scan without content isn't parsed and says why."""
    scan = F.lit("--- PAGE 1 ---\n#####\n=====\n--- PAGE 2 ---\n \n")
    full = F.concat(F.lit("No. of Equity Shares as listed   From   To   Lock in upto date\n"), numbers.grouped(F.col("o_orderkey") * 1000), F.lit("   1   "), numbers.grouped(F.col("o_orderkey") * 1000), F.lit("   Free"))
    docs = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.lit("NSE").alias("exchange"), F.when(F.col("o_orderkey") % 2 == 0, scan).otherwise(full).alias("text"))
    read = lockin.extract(docs, skip_blank=True)
    return read.select("id", F.col("lockin").isNull().alias("skipped"), text.blank_error(F.col("text"), "lock-in").alias("error"), F.size("lockin.lots").alias("lots"))


# Shareholding patterns

#: Values of a record: promoter, public, other, their sum, locked.
_SHP_SQL = f"{LOG}, v AS (SELECT id, exchange, shp_promoter_shares * 1000 + 20000 AS p, shp_public_shares * 1000 + 30000 AS q, shp_others_shares * 1000 + 40000 AS o, shp_total_shares * 1000 + 90000 AS t, shp_total_shares * 1000 + 5000 AS l FROM log WHERE shp_total_shares IS NOT NULL)"


def _log(spark: SparkSession, d: str) -> DataFrame:
    """Records with these values as columns p, q, o, t, l."""
    log = adapter.log(spark, d).where("shp_total_shares is not null")
    values = {"p": ("promoter", 20000), "q": ("public", 30000), "o": ("others", 40000), "t": ("total", 90000), "l": ("total", 5000)}
    return log.withColumns({c: F.col(f"shp_{n}_shares") * 1000 + plus for c, (n, plus) in values.items()})


def _words(*parts: str | Column, sep: str = " ") -> Column:
    return F.concat_ws(sep, *(p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts))


def _doc(*lines: Column | str) -> Column:
    return F.concat_ws("\n", *(F.lit(l) if isinstance(l, str) else l for l in lines))


def _split(docs: DataFrame, *more: str) -> DataFrame:
    return shp.extract(docs).select("id", "shp.promoter_shares", "shp.public_shares", "shp.other_shares", "shp.total_shares", "shp.strategy", *more)


def _split_sql(strategy: str, p: str = "p", q: str = "q", o: str = "o", t: str = "t", more: str = "") -> str:
    return f"{_SHP_SQL} SELECT id, {p} AS promoter_shares, {q} AS public_shares, {o} AS other_shares, {t} AS total_shares, '{strategy}' AS strategy{more} FROM v"


@query(_split_sql("position_based"))
def shp_by_position(spark: SparkSession, d: str) -> DataFrame:
    """No known label: first, second and last line of numbers above the total."""
    doc = _doc(_words("Sponsors 3", F.col("p")), _words("Outsiders 90", F.col("q")), _words("Rest 1", F.col("o")), _words("Total 94", F.col("t")))
    return _split(_log(spark, d).select("id", "exchange", doc.alias("text"), F.col("t").alias("known_total")))


@query(_split_sql("sequential", more=", CASE WHEN l >= 1000 AND l < t THEN l END AS locked_shares"))
def shp_by_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels lead to the lines, the total line to the columns of shares and of locked shares; a line before spoils places."""
    doc = _doc("Folio 7 123456789", _words("(A) Promoter & Promoter Group 3", F.col("p")), _words("(B) Public 90", F.col("q")), _words("(C) Non Promoter Non Public 1", F.col("o")), _words("Total 94", F.col("t"), F.col("l")))
    return _split(_log(spark, d).select("id", "exchange", doc.alias("text"), F.col("t").alias("known_total")), "shp.locked_shares")


@query(_split_sql("boundary_detection"))
def shp_by_boundary(spark: SparkSession, d: str) -> DataFrame:
    """No label and no word for the total: lines that look like shares, above the one that holds the known total."""
    doc = _doc("as of today", _words("Sponsors 3", F.col("p"), "10"), _words("Outsiders 90", F.col("q"), "10"), _words("Rest 1", F.col("o"), "10"), _words("Sum 94", F.col("t"), "10"))
    return _split(_log(spark, d).select("id", "exchange", doc.alias("text"), F.col("t").alias("known_total")))


_SMALL_SQL = ("(id % 100 + 200)", "(id % 90 + 300)", "(id % 80 + 400)")


def _small() -> list[Column]:
    return [F.expr(e) for e in _SMALL_SQL]


@query(_split_sql("column_count_validation", *_SMALL_SQL, " + ".join(_SMALL_SQL)))
def shp_by_column_count(spark: SparkSession, d: str) -> DataFrame:
    """Values too small to look like shares, lines of as many numbers as the total's."""
    p, q, o = _small()
    doc = _doc(_words("Sponsors 3", p, "10"), _words("Outsiders 90", q, "10"), _words("Rest 1", o, "10"), _words("Sum 94", p + q + o, "10"))
    return _split(_log(spark, d).select("id", "exchange", doc.alias("text"), (p + q + o).alias("known_total")))


@query(_split_sql("simple_position", *_SMALL_SQL, " + ".join(_SMALL_SQL)))
def shp_by_simple_position(spark: SparkSession, d: str) -> DataFrame:
    """A total line of many more numbers than the lines above it."""
    p, q, o = _small()
    doc = _doc("as of today", _words("Sponsors 3", p, "10"), _words("Outsiders 90", q, "10"), _words("Rest 1", o, "10"), _words("Sum 94", p + q + o, "1 2 3 4 5 6 7"))
    return _split(_log(spark, d).select("id", "exchange", doc.alias("text"), (p + q + o).alias("known_total")))


@query(f"{_SHP_SQL} SELECT id, CASE WHEN exchange = 'BSE' THEN p + 7 ELSE p END AS promoter_shares, CASE WHEN exchange = 'BSE' THEN t + 21 ELSE t END AS total_shares FROM v")
def shp_conflicting_hints(spark: SparkSession, d: str) -> DataFrame:
    """Two columns that both add up: where hints differ, the computed total wins on one exchange."""
    line = lambda label, n, v, more: _words(label, n, v, v + more, sep="     ")
    doc = _doc(line("(A) Promoter & Promoter Group", "3", F.col("p"), 7), line("(B) Public", "90", F.col("q"), 7), line("(C) Non Promoter Non Public", "1", F.col("o"), 7), line("Total", "94", F.col("t"), 21))
    docs = _log(spark, d).select("id", "exchange", doc.alias("text"), F.col("t").alias("known_total"), (F.col("t") + 21).alias("computed_total"))
    return shp.extract(docs).select("id", "shp.promoter_shares", "shp.total_shares")


@query(f"{_SHP_SQL} SELECT id, p AS promoter_shares, q AS public_shares, t - p - q AS other_shares, t AS total_shares, l AS locked_shares, 'sequential+hint_recovery' AS strategy FROM v")
def shp_recovered(spark: SparkSession, d: str) -> DataFrame:
    """No total line: promoter and public by their marks, the rest from the hints that the text holds."""
    doc = _doc(_words("(A) Promoter & Promoter Group 3", F.col("p")), _words("(B) Public 90", F.col("q")), _words("Grand sum", F.col("t"), "locked", F.col("l")))
    docs = _log(spark, d).select("id", "exchange", doc.alias("text"), F.col("t").alias("known_total"), F.col("l").alias("known_locked"))
    return _split(docs, "shp.locked_shares")


@query(_split_sql("spatial_columns", more=", l AS locked_shares"))
def shp_locked_hint(spark: SparkSession, d: str) -> DataFrame:
    """Locked shares that stand elsewhere in the text are taken from the hint."""
    line = lambda *parts: _words(*parts, sep="     ")
    doc = _doc(line("(A) Promoter & Promoter Group", "3", F.col("p")), line("(B) Public", "90", F.col("q")), line("(C) Non Promoter Non Public", "1", F.col("o")), line("Total", "94", F.col("t")), _words("Locked in:", F.col("l")))
    docs = _log(spark, d).select("id", "exchange", doc.alias("text"), F.col("t").alias("known_total"), F.col("l").alias("known_locked"))
    return _split(docs, "shp.locked_shares")


@query(f"""{_SHP_SQL} SELECT id, CASE WHEN id % 5 = 1 THEN ['missing promoter_shares'] WHEN id % 5 = 2 THEN ['missing public_shares', 'missing total_shares'] WHEN id % 5 = 3 THEN ['sum differs from total']
    WHEN id % 3 = 0 AND id % 7 > 0 THEN ['locked differs from lock-in'] ELSE []::VARCHAR[] END AS problems FROM v""")
def shp_problems(spark: SparkSession, d: str) -> DataFrame:
    """Missing values, sums that are off, and locked shares other than the lock-in's, which only some records know."""
    k = F.col("id") % 5
    r = F.struct(
        F.when(k != 1, F.col("p")).alias("promoter_shares"), F.when(k != 2, F.col("q")).alias("public_shares"), F.col("o").alias("other_shares"), F.when(k == 3, F.col("t") + 1).when(k != 2, F.col("t")).alias("total_shares"), F.col("l").alias("locked_shares"),
    )
    lockin = F.when(F.col("id") % 7 > 0, F.col("l") + F.when(F.col("id") % 3 == 0, 1).otherwise(0))
    return _log(spark, d).withColumn("r", r).select("id", shp.problems(F.col("r"), lockin).alias("problems"))


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 1 END AS public_lines, '(b)public' AS label FROM orders""")
def shp_labels(spark: SparkSession, d: str) -> DataFrame:
    """How many lines bear a label, and which label a line bears."""
    doc = F.concat(F.lit("(A) Promoter Group 3 4\n( B ) Pub-lic 5 6\n"), F.when(F.col("o_orderkey") % 2 == 0, "(B) Public total 9\n").otherwise(""))
    rows = F.transform(text.lines(doc), lambda l: F.struct(l.alias("line"), text.pattern_text(l).alias("bare")))
    counts = shp.coverage(rows, shp.PUBLIC)
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), counts["(b)public"].alias("public_lines"), shp.matched_label(F.lit("(B) Public 1"), shp.PUBLIC).alias("label"))


@query(f"""{_SHP_SQL} SELECT count(*) AS documents, count(*) FILTER (id % 3 = 0) AS complete, count(*) FILTER (id % 3 = 1) AS partial, count(*) FILTER (id % 3 = 2) AS failed, (count(*) FILTER (id % 3 < 2) * 1000) // count(*) AS permille FROM v""")
def shp_success(spark: SparkSession, d: str) -> DataFrame:
    line = lambda *parts: _words(*parts, sep="     ")
    whole = _doc(line("(A) Promoter & Promoter Group", "3", F.col("p")), line("(B) Public", "90", F.col("q")), line("(C) Non Promoter Non Public", "1", F.col("o")), line("Total", "94", F.col("t")))
    half = _doc(line("(A) Promoter & Promoter Group", "3", F.col("p")), line("Total", "94", F.col("t")))
    doc = F.when(F.col("id") % 3 == 0, whole).when(F.col("id") % 3 == 1, half).otherwise("nothing here")
    return reports.extraction_success(shp.extract(_log(spark, d).select("id", F.lit("NSE").alias("exchange"), doc.alias("text"))))


@query(f"""SELECT o_orderkey AS id, 'AAAA    BB  CC' AS line, [0, 8, 12] AS starts, [4, 10, 14] AS ends, greatest(7, o_orderkey * 10 + 5) AS largest, CASE WHEN o_orderkey * 10 + 5 <= 1000 THEN greatest(7, o_orderkey * 10 + 5) ELSE 7 END AS limited FROM orders""")
def aligned_columns(spark: SparkSession, d: str) -> DataFrame:
    """Columns by gaps of two spaces, and the largest number within a range of characters."""
    columns = text.column_ranges(F.lit("AAAA    BB  CC"))
    row = F.concat(F.lit("x 7   "), F.col("id").cast("string"), F.lit("5   99"))
    end = F.length(row) - 5
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id")).select(
        "id", F.lit("AAAA    BB  CC").alias("line"), F.transform(columns, lambda c: c["first"]).alias("starts"), F.transform(columns, lambda c: c["last"]).alias("ends"),
        numbers.number_between(row, F.lit(0), end).alias("largest"), numbers.number_between(row, F.lit(0), end, F.lit(1000)).alias("limited"),
    )


@query(f"""{LOTS}, x AS (SELECT processing_log_id AS id, row_order, shares, lockin_date_to FROM lots WHERE shares >= 10)
SELECT id, count(*) AS lots, sum(shares * 10)::BIGINT AS shares, count(*) FILTER (lockin_date_to IS NULL) AS free, count(*) FILTER (lockin_date_to IS NOT NULL) AS locked, max(strftime(lockin_date_to, '%d-%b-%Y')) AS last_text FROM x GROUP BY 1""")
def cell_tables(spark: SparkSession, d: str) -> DataFrame:
    """Lots of tables of cells whose columns stand in four orders, below headers of one or two rows, among blank rows and counts."""
    rows = adapter.lots(spark, d).select(F.col("processing_log_id").alias("id"), "row_order", "shares", "lockin_date_to")
    k, text_of = F.col("id") % 4, lambda c: c.cast("string")
    shares, end = numbers.grouped(F.col("shares") * 10), F.coalesce(F.date_format("lockin_date_to", "dd-MMM-yyyy"), F.lit("Free"))
    other = text_of(F.col("row_order"))

    def ordered(a: Column, b: Column, c: Column, e: Column) -> Column:
        return F.when(k == 0, F.array(a, b, c, e)).when(k == 1, F.array(b, c, a, e)).when(k == 2, F.array(e, c, b, a)).otherwise(F.array(b, e, a, c))

    lit, none = F.lit, F.lit(None).cast("string")
    cells = F.collect_list(F.struct("row_order", "shares", "lockin_date_to", ordered(shares, other, other, end).alias("cells")))
    head = F.when(F.col("id") % 3 == 0, F.array(ordered(lit("No. of equity"), none, lit(""), lit("Lock in")), ordered(lit("shares"), lit("From"), lit("To"), lit("up to")))).otherwise(F.array(ordered(lit("Securities"), lit("FROM"), lit("to"), lit("Date"))))
    tables = rows.groupBy("id").agg(F.concat(F.any_value(head), F.array(ordered(none, lit(""), none, none)), F.transform(F.sort_array(cells), lambda r: r["cells"]), F.array(F.any_value(ordered(lit("99"), lit("1"), lit("1"), lit("Total"))))).alias("table"))
    found = tables.select("id", plan_cells.lots(F.col("table")).alias("lots")).where(F.size("lots") > 0)
    total = F.aggregate("lots", F.lit(0).cast("long"), lambda s, r: s + r["shares"])
    count = lambda c: F.size(F.filter("lots", lambda r: r["row_class"] == c)).cast("long").alias(c)
    return found.select("id", F.size("lots").cast("long").alias("lots"), total.alias("shares"), count("free"), count("locked"), F.array_max(F.transform("lots", lambda r: r["lockin_date"])).alias("last_text"))
