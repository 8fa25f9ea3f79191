"""The ledger: records of processed filings, their lots, versions, edits and states.

A record changes by appending a new version; readers take the latest of each key. So a
write is one atomic Parquet append, and no row is updated in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lotloom.functions.classify import BUCKETS, legacy_band

# Rules in the order in which they are judged and named.
ORDER = ("RULE1", "RULE2", "RULE5", "RULE3", "RULE4", "RULE6", "RULE7", "RULE8", "RULE10")
# States of a record, and what each may become.
STATES = ("NEW", "PARSING", "VALIDATING", "FINALIZED", "FAILED")
MOVES = {"FINALIZED": ("VALIDATING",), "VALIDATING": ("NEW", "PARSING", "VALIDATING", "FINALIZED", "FAILED")}


def latest(rows: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The row with the largest ``order`` of each key, whole; equal rows are told apart by all their columns.

    One aggregation with partial results before the shuffle, so a frequent key costs one row a task.
    """
    names = [c for c in rows.columns if c not in keys]
    rank = F.struct(*(F.col(c) for c in order), *(F.col(c) for c in names if c not in order))
    out = rows.groupBy(*keys).agg(F.max(rank).alias("_r"))
    return out.select(*(c if c in keys else F.col("_r")[c].alias(c) for c in rows.columns))


def latest_ids(log: DataFrame, exchange: str | None = None) -> DataFrame:
    """The newest record id of each symbol. Only the exchange is looked at before, as the feed has it."""
    log = log.where(F.col("exchange") == exchange) if exchange else log
    return log.groupBy("unique_symbol").agg(F.max("id").alias("id"))


def record_versions(log: DataFrame) -> DataFrame:
    """The current version of each record: key (exchange, file_name), newest ``version`` wins."""
    return latest(log, ["exchange", "file_name"], "version")


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def upserted(current: DataFrame, incoming: DataFrame, now: Column, order: str | None = None) -> DataFrame:
    """New versions for incoming records: kept id, paths and symbol of an existing one, cleared error and finalization.

    Of incoming rows with one key the last by ``order`` counts (by all columns where none is given),
    so a key gets one new version.
    """
    keys = ["exchange", "file_name"]
    incoming = latest(incoming, keys, *([order] if order else []))
    kept = [c for c in current.columns if c.endswith("_path") or c in ("unique_symbol", "id")]
    old = current.select(*keys, F.col("version").alias("_v"), *(F.col(c).alias(f"_{c}") for c in kept))
    out = incoming.join(old, keys, "left").withColumn("version", F.coalesce(F.col("_v") + 1, F.lit(1)))
    out = out.withColumns({c: F.coalesce(f"_{c}", c) for c in kept if c in incoming.columns})
    return out.withColumns({"error_message": F.lit(None).cast("string"), "finalized_at": F.lit(None).cast("timestamp_ntz"), "processed_at": now, "updated_at": now}).drop("_v", *(f"_{c}" for c in kept))


def current_lots(lots: DataFrame, log: DataFrame) -> DataFrame:
    """Lots of the current version of each record; those of replaced versions fall away."""
    return lots.join(record_versions(log).select("processing_log_id", "version"), ["processing_log_id", "version"], "left_semi")


def moved(log: DataFrame, to: str, now: Column, chosen: Column | None = None) -> DataFrame:
    """New versions of the chosen records in state ``to``; records that may not move stay out."""
    if to not in MOVES:
        raise ValueError(f"no record moves to {to}")
    rows = log.where(F.col("status").isin(*MOVES[to]) & (chosen if chosen is not None else F.lit(True)))
    done = now if to == "FINALIZED" else F.lit(None).cast("timestamp_ntz")
    return rows.withColumns({"status": F.lit(to), "finalized_at": done, "updated_at": now, "version": F.col("version") + 1})


def replaced_lots(extracted: DataFrame, version: Column) -> DataFrame:
    """Lots of newly read records (processing_log_id, lockin), numbered from 0 in the text's order, under the version that replaces all older lots of the record."""
    rows = extracted.select("processing_log_id", version.alias("version"), F.posexplode_outer("lockin.lots").alias("row_order", "lot")).where("row_order is not null")
    names = {"from_no": "distinctive_from", "to_no": "distinctive_to"}
    fields = [f.name for f in extracted.schema["lockin"].dataType["lots"].dataType.elementType]
    return rows.select("processing_log_id", "version", "row_order", *(F.col("lot")[f].alias(names.get(f, f)) for f in fields))


def legacy_saved(details: DataFrame, rows: DataFrame, allotments: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """A save by hand as the old dashboard did it: (details, rows).

    ``details`` (scrip_id, version) get a new version whose computed total is the sum of their rows,
    locked by hand; ``rows`` (scrip_id, shares, lock_from, lock_upto, row_class, type_raw) replace older ones,
    with the days from their start (else the allotment) and the bucket by tolerance bands.
    """
    out = rows.join(allotments.select("scrip_id", "allotment_date"), "scrip_id", "left")
    start, ends = F.coalesce("lock_from", "allotment_date"), F.col("lock_upto").isNotNull() & (F.col("row_class") != "free")
    days = F.when(ends, F.abs(F.date_diff("lock_upto", start)))
    bucket = F.when(~ends, "free").when(days.isNull() | (days > 9999), "unknown").otherwise(legacy_band(days))
    out = out.select("scrip_id", "shares", "lock_from", "lock_upto", days.alias("days_locked"), bucket.alias("lock_bucket"), F.substring("type_raw", 1, 100).alias("type_raw"), "row_class")
    sums = rows.groupBy("scrip_id").agg(F.sum("shares").alias("computed_total"))
    header = details.drop("computed_total").join(sums, "scrip_id").withColumns({"version": F.col("version") + 1, "status": F.lit("MANUAL_LOCKED"), "manual_lock": F.lit(1), "manual_locked_at": now, "processed_at": now})
    return header, out


def blocked(log: DataFrame, wanted: DataFrame) -> DataFrame:
    """Of the wanted symbols (unique_symbol) those whose latest record by time is finalized, with the time it was: they must be rolled back first."""
    newest = latest(log.select("unique_symbol", "processed_at", "id", "status", "finalized_at"), ["unique_symbol"], "processed_at", "id")
    return wanted.select("unique_symbol").distinct().join(newest.where("status = 'FINALIZED'"), "unique_symbol").select("unique_symbol", "finalized_at")


def revalidated(log: DataFrame, verdicts: DataFrame, now: Column) -> DataFrame:
    """New versions of records from the verdicts over their stored values: finalized where all rules pass, else open with the reasons.

    Records that are finalized already stay out.
    """
    return revalidated_rows(log.where(F.col("status") != "FINALIZED").drop("verdicts").join(_by_record(verdicts), "id"), now)


def revalidated_rows(judged: DataFrame, now: Column) -> DataFrame:
    """As ``revalidated``, of records that bear their verdicts as an array (``rules.judged``): within the row, without joins or groups."""
    out = _told(judged.where(F.col("status") != "FINALIZED"), now)
    said = F.transform(F.filter("verdicts", lambda v: ~v["passed"]), lambda v: F.concat_ws(": ", v["rule_id"], v["message"]))
    error = F.when(~F.col("all_rules_passed"), F.concat_ws(" | ", F.lit("Finalization skipped: Not all validation rules passed"), said))
    return out.withColumns({
        "status": F.when(F.col("all_rules_passed"), "FINALIZED").otherwise("VALIDATING"), "finalized_at": F.when(F.col("all_rules_passed"), now), "error_message": error, "processed_at": now,
    }).drop("verdicts")


def failed(log: DataFrame, symbol: str, exchange: str, message: str, now: Column) -> DataFrame:
    """A FAILED version of a symbol's record that has no file."""
    row = log.sparkSession.range(1).select(F.lit(symbol).alias("unique_symbol"), F.lit(exchange).alias("exchange"), F.lit("").alias("file_name"), F.lit("FAILED").alias("status"), F.lit(message).alias("error_message"), now.alias("processed_at"), now.alias("updated_at"))
    old = record_versions(log).where(F.col("file_name") == "").select("exchange", "file_name", F.col("version").alias("_v"))
    return row.join(old, ["exchange", "file_name"], "left").withColumn("version", F.coalesce(F.col("_v") + 1, F.lit(1))).drop("_v")


def with_error(log: DataFrame, errors: DataFrame, now: Column) -> DataFrame:
    """New versions of records that bear an error (id, error_message)."""
    return log.drop("error_message").join(errors.select("id", "error_message"), "id").withColumns({"updated_at": now, "version": F.col("version") + 1})


def _by_record(verdicts: DataFrame) -> DataFrame:
    """Verdicts in long form as one array of each record, in the order of the rules."""
    place = F.array_position(F.array(*map(F.lit, ORDER)), F.col("rule_id"))
    one = F.struct(place.alias("place"), "rule_id", "passed", "message", "expected", "actual")
    return verdicts.groupBy("id").agg(F.sort_array(F.collect_list(one)).alias("verdicts"))


def _told(judged: DataFrame, now: Column, strategies: DataFrame | None = None) -> DataFrame:
    """New versions of records by their array ``verdicts``, which stays."""
    own = lambda v: F.struct(*(v[c].alias(c) for c in ("passed", "message", "expected", "actual")))
    parts = F.transform("verdicts", lambda v: F.concat(F.lit('"'), v["rule_id"], F.lit('":'), F.to_json(own(v))))
    if strategies is not None:
        judged = judged.join(strategies.select("id", F.struct("lockin_strategy", "shp_strategy").alias("_s")), "id", "left")
        parts = F.concat(parts, F.array(F.concat(F.lit('"_strategies":'), F.coalesce(F.to_json("_s"), F.lit("{}")))))
    failed = F.array_join(F.transform(F.filter("verdicts", lambda v: ~v["passed"]), lambda v: v["rule_id"]), ",")
    return judged.withColumns({
        "validation_results": F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}")), "all_rules_passed": F.array_min(F.transform("verdicts", lambda v: v["passed"])), "failed_rules": F.nullif(failed, F.lit("")),
        "updated_at": now, "version": F.col("version") + 1,
    }).drop("_s")


def with_verdicts(log: DataFrame, verdicts: DataFrame, now: Column, strategies: DataFrame | None = None) -> DataFrame:
    """New versions that carry their verdicts as JSON, whether all passed, and the failed rules (null if none), both in the order of the rules.

    ``strategies`` (id, lockin_strategy, shp_strategy) go into the JSON as ``_strategies``.
    """
    return with_verdicts_rows(log.drop("verdicts").join(_by_record(verdicts), "id"), now, strategies)


def with_verdicts_rows(judged: DataFrame, now: Column, strategies: DataFrame | None = None) -> DataFrame:
    """As ``with_verdicts``, of records that bear their verdicts as an array (``rules.judged``): within the row, but for the join of strategies."""
    return _told(judged, now, strategies).drop("verdicts")


def overlaid(lots: DataFrame, edits: DataFrame, log: DataFrame) -> DataFrame:
    """Lots with edited buckets: the last edit of a lot counts if its bucket is one, differs, and the record isn't finalized."""
    last = latest(edits.where(F.col("bucket").isin(*BUCKETS)), ["processing_log_id", "row_order"], "edited_at").select("processing_log_id", "row_order", F.col("bucket").alias("_b"))
    open_ = log.select(F.col("id").alias("processing_log_id"), (F.col("status") != "FINALIZED").alias("_open"))
    out = lots.join(last, ["processing_log_id", "row_order"], "left").join(open_, "processing_log_id", "left")
    ok = F.coalesce(F.col("_open") & F.col("_b").isNotNull() & (F.col("_b") != F.col("bucket")), F.lit(False))
    return out.withColumns({"edited": ok, "bucket": F.when(ok, F.col("_b")).otherwise(F.col("bucket"))}).drop("_b", "_open")


def reviewed(meta: Column, on: Column) -> Column:
    """JSON metadata with the number 1 or 0 as ``manual_reviewed``; all other values keep their kind. What is no JSON object counts as an empty one."""
    known = F.coalesce(F.from_json(meta, "map<string,variant>"), F.create_map().cast("map<string,variant>"))
    return F.to_json(F.map_concat(F.map_filter(known, lambda k, v: k != "manual_reviewed"), F.create_map(F.lit("manual_reviewed"), F.parse_json(on.cast("int").cast("string")))))


def is_reviewed(meta: Column) -> Column:
    return F.coalesce(F.try_variant_get(F.try_parse_json(meta), "$.manual_reviewed", "int"), F.lit(0))


def renamed(log: DataFrame, master: DataFrame, chosen: DataFrame, symbol: str, now: Column) -> DataFrame:
    """Versions of the ``chosen`` records (id) under another NSE symbol: key, file name and paths; none of a record if the master
    lacks the symbol or another record holds the file."""
    row = log.where(F.col("exchange") == "NSE").join(chosen.select("id"), "id", "left_semi")
    old = F.regexp_extract("file_name", r"^(.+)-CML\d+\.pdf$", 1)
    name = F.concat(F.lit(symbol), F.substring(F.col("file_name"), F.length(old) + 1, F.length("file_name")))
    paths = {c: F.replace(F.col(c), old, F.lit(symbol)) for c in log.columns if c.endswith("_path")}
    out = row.where(old != "").withColumns({**paths, "_name": name, "unique_symbol": F.lit(f"NSE:{symbol}"), "updated_at": now, "version": F.col("version") + 1, "_sym": F.lit(symbol.upper())})
    out = out.join(master.select(F.upper("nse_symbol").alias("_sym")), "_sym", "left_semi")
    taken = log.select("exchange", F.col("file_name").alias("_name"), F.col("id").alias("_holder"))
    free = out.alias("o").join(taken.alias("t"), (F.col("o.exchange") == F.col("t.exchange")) & (F.col("o._name") == F.col("t._name")) & (F.col("o.id") != F.col("t._holder")), "left_anti")
    return free.withColumn("file_name", F.col("_name")).drop("_name", "_sym")


def nested(records: DataFrame, lots: DataFrame, key: str = "id") -> DataFrame:
    """Records with their lots as an array in row order; an empty array where there are none."""
    fields = [c for c in lots.columns if c != "processing_log_id"]
    packed = lots.groupBy("processing_log_id").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("lots"))
    kind = packed.schema["lots"].dataType
    return records.join(packed.withColumnRenamed("processing_log_id", key), key, "left").withColumn("lots", F.coalesce("lots", F.array().cast(kind)))


def differences(parsed: DataFrame, stored: DataFrame, key: str, fields: list[str], zero_as_null: tuple[str, ...] = ()) -> DataFrame:
    """Keys and the names of the fields in which both sides differ; a missing side differs in all it has."""
    value = lambda side, f: F.nullif(F.col(f"{side}.{f}"), F.lit(0)) if f in zero_as_null else F.col(f"{side}.{f}")
    joined = parsed.alias("p").join(stored.alias("s"), F.col(f"p.{key}") == F.col(f"s.{key}"), "full")
    names = F.array_compact(F.array(*(F.when(~value("p", f).eqNullSafe(value("s", f)), F.lit(f)) for f in fields)))
    return joined.select(F.coalesce(f"p.{key}", f"s.{key}").alias(key), names.alias("differs"))


def lot_differences(parsed: DataFrame, stored: DataFrame, key: str, order: str, fields: list[str]) -> DataFrame:
    """How the parsed lots of each record differ from its stored ones, as multisets: key, what, parsed, stored, parsed_rows, stored_rows.

    Lots equal in all ``fields`` (null equals null) cancel out, copy by copy. Copies that only one side has more
    of are ``repeated in parsed`` or ``repeated in stored``. What is left is matched in the order of its rows: a
    pair is ``changed``, the rest ``added`` or ``lost``. Each row shows both lots (null where there is
    none) and how many rows each side has. Windows are over the lots of one record.
    """
    side = lambda rows, n: rows.select(key, order, *fields, F.lit(n).alias("_side"))
    both = side(parsed, 0).unionByName(side(stored, 1))
    same, whole = Window.partitionBy(key, *fields), Window.partitionBy(key)
    count = lambda n, over: F.count_if(F.col("_side") == n).over(over)
    both = both.withColumns({
        "_copy": F.row_number().over(Window.partitionBy(key, *fields, "_side").orderBy(order)), "_np": count(0, same), "_ns": count(1, same), "parsed_rows": count(0, whole), "stored_rows": count(1, whole),
    })
    left = both.where(F.col("_copy") > F.least("_np", "_ns")).withColumn("_again", (F.col("_np") > 0) & (F.col("_ns") > 0))
    left = left.withColumn("_place", F.row_number().over(Window.partitionBy(key, "_side", "_again").orderBy(order, *fields)))
    lot = lambda n: F.max(F.when(F.col("_side") == n, F.struct(order, *fields)))
    # repeats stand alone: their side is part of what they are matched by
    out = left.groupBy(key, "_place", "_again", F.when(F.col("_again"), F.col("_side")).alias("_own")).agg(lot(0).alias("parsed"), lot(1).alias("stored"), F.first("parsed_rows").alias("parsed_rows"), F.first("stored_rows").alias("stored_rows"))
    p, s = F.col("parsed").isNotNull(), F.col("stored").isNotNull()
    what = F.when(F.col("_again"), F.when(p, "repeated in parsed").otherwise("repeated in stored")).when(p & s, "changed").when(p, "added").otherwise("lost")
    return out.select(key, what.alias("what"), "parsed", "stored", "parsed_rows", "stored_rows")


def not_done(found: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't among what was done already."""
    return found.join(done.select(key).distinct(), key, "left_anti")


def create_tables(spark: SparkSession, statements: str) -> int:
    """Create the tables of a script of ``CREATE TABLE IF NOT EXISTS`` statements, parted by semicolons; how many there are."""
    parts = [p.strip() for p in statements.split(";") if p.strip()]
    for part in parts:
        spark.sql(part if " using " in part.lower() else f"{part} USING parquet")
    return len(parts)
