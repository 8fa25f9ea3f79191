"""Summaries of runs, extractions and records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lotloom.sources.filings import exchange_of


def run_summary(records: DataFrame) -> DataFrame:
    """Number and symbols of the finalized and the other records of a run."""
    done = (F.col("status") == "FINALIZED").alias("finalized")
    return records.groupBy(done).agg(F.count("*").alias("n"), F.sort_array(F.collect_set("unique_symbol")).alias("symbols"))


def folder_counts(results: DataFrame) -> DataFrame:
    """Filings of a folder run by exchange and outcome."""
    return results.groupBy("exchange", "outcome").agg(F.count("*").alias("n"))


def extraction_success(shp: DataFrame) -> DataFrame:
    """How many shareholding documents gave all values, some, or none, and the permille that gave any."""
    parts = [F.col("shp")[n].isNotNull() for n in ("promoter_shares", "public_shares", "other_shares")]
    all_, any_ = parts[0] & parts[1] & parts[2], parts[0] | parts[1] | parts[2]
    counts = shp.agg(F.count("*").alias("documents"), F.count_if(all_).alias("complete"), F.count_if(any_ & ~all_).alias("partial"), F.count_if(~any_).alias("failed"))
    return counts.withColumn("permille", F.when(F.col("documents") > 0, F.expr("(complete + partial) * 1000 div documents")))


def outcomes(extracted: DataFrame) -> DataFrame:
    """For each filing: lots, free and locked ones, computed and declared total, whether they match, ranges that don't."""
    lots = F.col("lockin.lots")
    wrong = F.filter(lots, lambda r: (r["from_no"] > 0) & (r["to_no"] > 0) & (r["to_no"] - r["from_no"] + 1 != r["shares"]))
    return extracted.select(
        "exchange", "name", F.size(lots).alias("rows"), F.col("lockin.free_count").alias("free"), F.col("lockin.locked_count").alias("locked"), F.col("lockin.computed_total").alias("computed"),
        F.col("lockin.declared_total").alias("declared"), F.coalesce(F.col("lockin.declared_total") == F.col("lockin.computed_total"), F.lit(False)).alias("match"), F.size(wrong).alias("range_errors"),
    )


def outcome_summary(found: DataFrame) -> DataFrame:
    """Passed and failed filings by exchange: a filing passes if it has lots, its totals match and no range is off."""
    ok = (F.col("rows") > 0) & F.col("match") & (F.col("range_errors") == 0)
    return found.groupBy("exchange").agg(F.count("*").alias("files"), F.count_if(ok).alias("passed"), F.count_if(~F.col("match")).alias("mismatches"), F.sum("range_errors").alias("range_errors"))


def strategy_counts(records: DataFrame, key: str) -> DataFrame:
    """How often each strategy won, by a key (lockin_strategy or shp_strategy) of the verdicts' JSON, with its permille; most frequent first."""
    named = records.select(F.get_json_object("validation_results", f"$._strategies.{key}").alias("strategy")).where("strategy is not null")
    by = named.groupBy("strategy").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # of one row a strategy
    return by.withColumn("permille", F.expr("n * 1000") / total).withColumn("permille", F.floor("permille")).orderBy(F.desc("n"), "strategy")


def preview(rows: DataFrame, key: str, order: list[Column], value: str, most: int) -> DataFrame:
    """The first ``most`` values of each key in order, as the array ``shown``, and how many more there are. Only these reach one row, however many a key has."""
    window = Window.partitionBy(key).orderBy(*order)
    first = rows.withColumn("_place", F.row_number().over(window)).where(F.col("_place") <= most)
    shown = first.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_place", value))).alias("_s"))
    counts = rows.groupBy(key).agg(F.greatest(F.count("*") - most, F.lit(0)).alias("more"))
    return shown.join(counts, key).select(key, F.transform("_s", lambda s: s[value]).alias("shown"), "more")


def typed_order(shown: Column, kind: Column) -> list[Column]:
    """What to sort texts by, by their kind (num, date or str): numbers and dates from large to small and missing ones last, words in any case from small to large."""
    bare = F.when(F.trim(shown) != "-", F.trim(shown))
    number = F.when(kind == "num", F.regexp_replace(bare, r"[^\d.-]", "").try_cast("double"))
    moment = F.when(kind == "date", F.unix_seconds(bare.try_cast("timestamp")).cast("double"))
    return [F.desc_nulls_last(F.coalesce(number, moment)), F.when(kind == "str", F.coalesce(F.lower(bare), F.lit("")))]


def listing(files: DataFrame) -> DataFrame:
    """Text files (path) of both exchanges as one list: exchange, name, and which list each comes from; to be sorted by list and name."""
    rows = files.select(exchange_of(F.col("path")).alias("exchange"), F.substring_index("path", "/", -1).alias("name"))
    one = lambda i, exchange: rows.where(F.col("exchange") == exchange).withColumn("list", F.lit(i))
    return one(0, "NSE").unionByName(one(1, "BSE"))


def percent(part: Column, whole: Column) -> Column:
    """Share in percent; null where there is no whole."""
    return F.try_divide(part * 100, F.nullif(whole, F.lit(0)))


def record_view(records: DataFrame) -> DataFrame:
    """Records as a dashboard shows them: names of old fields, review flag, whether finalized."""
    names = {"promoter_shares": "shp_promoter_shares", "public_shares": "shp_public_shares", "other_shares": "shp_others_shares", "total_shares": "shp_total_shares"}
    return records.withColumns({**{n: F.col(c) for n, c in names.items()}, "finalized": F.col("status") == "FINALIZED", "company_name": F.coalesce("company_name", "ipo_name")})
