"""A run over filings: from the texts of a folder to records, lots and verdicts in a ledger.

``python -m lotloom.run --folder TEXTS --master MASTER.parquet --ledger OUT [--override RULE8=reason] [--rollback SYMBOL [--as-of COMMIT]]``
works on all filings of the folder as one Spark job; ``--symbol`` keeps it to one issuer, ``--dry-run`` writes nothing to the ledger.

Records, lots and verdicts of a run are one commit of the ledger. Texts are extracted once for each different
content (``OUT/stages``); a new EXTRACTOR extracts all again.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotloom.functions import text
from lotloom.functions.text import notice_hints
from lotloom.operators import ledger, reports, rules, stages
from lotloom.operators import master as issuers
from lotloom.operators.store import Store, changed, records, rolled_back, saved
from lotloom.plans import lockin, shp
from lotloom.session import Scratch
from lotloom.sources import filings

Parts = tuple[DataFrame, DataFrame, DataFrame]
#: Results of another extractor aren't used again; to be changed with the plans.
EXTRACTOR = "3"


def processed(lockins: DataFrame, patterns: DataFrame, master: DataFrame, now: Column, overrides: DataFrame | None = None, notices: DataFrame | None = None, known: Store | None = None) -> Parts:
    """(records, lots, verdicts) of lock-in filings with their shareholding patterns; all as ``read_texts`` gives them.

    The first notice of a code fills what the master doesn't say. Blank filings aren't parsed, have no verdicts,
    and their record says why. ``overrides`` (unique_symbol, rule_id, reason) let failed rules pass where
    they may. Records whose rules all pass are FINALIZED, others VALIDATING. ``known`` keeps what was extracted.
    """
    pairs = issuers.paired(lockins, patterns.select("exchange", "symbol", "path", "text"))
    name = F.regexp_replace(F.substring_index("path", "/", -1), r"(_java|_pdfplumber)?\.txt$", ".pdf")
    records = pairs.select(F.col("doc_id").alias("id"), "exchange", text.unique_symbol(F.col("exchange"), F.col("code"), F.col("symbol")).alias("unique_symbol"), name.alias("file_name"), F.col("path").alias("lockin_txt_java_path"), F.col("shp_path").alias("shp_txt_java_path"), "text", "shp_text")
    records = issuers.resolved(records, master, _hints(pairs, notices)).withColumn("known_total", F.col("post_issue_shares"))
    known = known or Store(lockins.sparkSession, Scratch(lockins.sparkSession, "stages").path("stages"))
    read = stages.once(known, "lockin", EXTRACTOR, records, ("exchange", "text", "known_total", "reference_date"), lambda r: lockin.extract(r, skip_blank=True))
    total = lambda field: F.col(f"lockin.{field}")
    read = read.withColumns({
        "is_blank": F.col("lockin").isNull(), "error_message": text.blank_error(F.col("text"), "lock-in"), "computed_total": total("computed_total"), "locked_total": total("locked_shares"), "free_total": total("free_shares"),
        "text_total": total("declared_total"), "declared_total": F.coalesce("post_issue_shares", total("declared_total")), "lockin_strategy": total("strategy"),
    })
    # from here on tables: what follows mentions the extraction several times
    scratch = Scratch(lockins.sparkSession, "run")
    read = scratch.write(read, "read")
    own = read.select("id", "exchange", F.col("shp_text").alias("text"), F.col("declared_total").alias("known_total"), "computed_total", F.col("locked_total").alias("known_locked"))
    splits = stages.once(known, "shp", EXTRACTOR, own, ("exchange", "text", "known_total", "computed_total", "known_locked"), shp.extract)
    splits = splits.select(F.col("id").alias("_id"), "shp").select("_id", *shp.shp_shares(), F.col("shp.strategy").alias("shp_strategy"))
    splits = scratch.write(splits, "splits")
    read = read.join(splits, F.col("id") == F.col("_id"), "left").drop("_id")
    lots = ledger.replaced_lots(read.select(F.col("id").alias("processing_log_id"), "lockin"), F.lit(1))
    facts = rules.facts(lots, read.select(F.col("id").alias("processing_log_id"), "reference_date"))
    judged = read.join(facts.withColumnRenamed("processing_log_id", "id"), "id", "left").fillna(0, list(rules.FACTS))
    verdicts = scratch.write(rules.verdicts(judged), "verdicts")
    if overrides is not None:
        wanted = overrides.join(read.select("id", "unique_symbol"), "unique_symbol").select("id", "rule_id", "reason")
        verdicts = rules.overridden(verdicts, wanted)
    base = read.drop("lockin", "text", "shp_text", "known_total").withColumns({"version": F.lit(0), "processed_at": now})
    judged = ledger.with_verdicts(base, verdicts, now, read.select("id", "lockin_strategy", "shp_strategy"))
    blank = base.where("is_blank").withColumns({"validation_results": F.lit(None).cast("string"), "all_rules_passed": F.lit(False), "failed_rules": F.lit(None).cast("string"), "updated_at": now, "version": F.lit(1)})
    out = judged.unionByName(blank)
    reason = rules.may_finalize(F.lit("VALIDATING"), F.col("all_rules_passed"), F.col("is_blank"))
    return out.withColumns({"status": F.when(reason.isNull(), "FINALIZED").otherwise("VALIDATING"), "finalized_at": F.when(reason.isNull(), now)}), lots, verdicts


def _hints(pairs: DataFrame, notices: DataFrame | None) -> DataFrame | None:
    """What the first notice of each filing's code says, by the filing's id."""
    if notices is None:
        return None
    codes = pairs.select("doc_id", "exchange", "code")
    found = filings.first_notice(codes, notices.select("path", "text")).where("notice_text is not null")
    hint = notice_hints(F.col("notice_text"), F.col("exchange"))
    return found.select(F.col("doc_id").alias("id"), hint.alias("h")).select("id", "h.listing_date", "h.shares", F.col("h.company").alias("company_name"))


def run_folder(spark: SparkSession, folder: str, master: DataFrame, out: str, now: Column, overrides: DataFrame | None = None, symbol: str = "", dry: bool = False) -> DataFrame:
    """Process a folder's filings into the tables log, lots and verdicts below ``out``, as one commit; the run's summary.

    Files that the ledger knows get a new version. Symbols whose latest record is finalized stay out until they
    are rolled back. A ``dry`` run judges all the same but stores nothing, extractions included.
    """
    texts = filings.read_texts(spark, folder)
    lockins, store = texts.where("kind = 'lockin'"), Store(spark, out)
    key = text.unique_symbol(F.col("exchange"), F.col("code"), F.col("symbol"))
    if symbol:
        lockins = lockins.where(key == symbol)
    base = store.head()
    if base:
        done = records(store, base)
        finished = ledger.blocked(done, done.select("unique_symbol")).select(F.col("unique_symbol").alias("_key"))
        lockins = lockins.withColumn("_key", key).join(finished, "_key", "left_anti").drop("_key")
    known = None if dry else Store(spark, f"{out}/stages")
    found, lots, verdicts = processed(lockins, texts.where("kind = 'shp'"), master, now, overrides, texts.where("kind = 'notice'"), known)
    if dry or found.isEmpty():
        return reports.run_summary(found)
    number = saved(store, found, lots, verdicts, now, base=base)
    return reports.run_summary(store.read("log", number, base))


def roll_back(spark: SparkSession, out: str, symbol: str, now: Column, as_of: int | None = None) -> int:
    """Open the finalized record of a symbol again, or put all its records back to an earlier commit; how many there were."""
    store = Store(spark, out)
    if as_of is not None:
        return rolled_back(store, F.col("unique_symbol") == symbol, as_of, now)
    base = store.head()
    if not base:
        return 0
    newest = records(store, base).where(F.col("unique_symbol") == symbol)
    moved = ledger.moved(newest.where("status = 'FINALIZED'"), "VALIDATING", now).withColumn("processed_at", now)
    n = moved.count()
    if n:
        changed(store, moved, "roll back", base)
    return n


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Process the filings of a folder into a ledger.")
    parser.add_argument("--folder", help="folder of text files, by exchange and kind")
    parser.add_argument("--master", help="Parquet table of issuers")
    parser.add_argument("--ledger", required=True, help="folder of the tables that are written")
    parser.add_argument("--symbol", default="", help="only this issuer, as NSE:<symbol> or BSE:<code>")
    parser.add_argument("--override", action="append", default=[], metavar="RULE=REASON", help="let a failed rule of --symbol pass where it may")
    parser.add_argument("--rollback", metavar="SYMBOL", help="open a finalized record again")
    parser.add_argument("--as-of", type=int, metavar="COMMIT", help="with --rollback, put all records of the symbol back to a commit")
    parser.add_argument("--dry-run", action="store_true", help="judge the filings, but store nothing")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("lotloom run").getOrCreate()
    now = F.lit(spark.sql("SELECT current_timestamp()::timestamp_ntz").first()[0]).cast("timestamp_ntz")
    if args.rollback:
        print(f"{roll_back(spark, args.ledger, args.rollback, now, args.as_of)} rolled back")
        return
    if not args.folder or not args.master:
        parser.error("--folder and --master are needed")
    if args.override and not args.symbol:
        parser.error("--override needs --symbol")
    wanted = [(args.symbol, *o.split("=", 1)) for o in args.override]
    overrides = spark.createDataFrame(wanted, "unique_symbol string, rule_id string, reason string") if wanted else None
    for row in run_folder(spark, args.folder, spark.read.parquet(args.master), args.ledger, now, overrides, args.symbol, args.dry_run).collect():
        print("finalized" if row["finalized"] else "open", row["n"], ", ".join(row["symbols"]))


if __name__ == "__main__":
    main()
