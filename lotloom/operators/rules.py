"""Validation rules over a record, its lots and its shareholding pattern.

A rule is a struct of the record's columns: rule_id, passed, message, expected, actual,
can_override, overridden, override_reason. Facts about lots are gathered first, either from
the nested array or by an aggregation, so rules themselves need no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotloom.functions.classify import BUCKETS, RENAMED
from lotloom.operators.ledger import ORDER

#: Allotments up to this day may lack what the anchor rule asks for.
ANCHOR_CUTOFF = "2024-12-02"
FACTS = ("anchor_30_rows", "anchor_90_rows", "locked_free_bucket", "negative_periods", "locked_without_end", "range_errors")


def facts(lots: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """Counts over the lots of each record that the rules ask for."""
    if reference is not None:
        lots = lots.join(reference.select("processing_log_id", "reference_date"), "processing_log_id", "left")
    else:
        lots = lots.withColumn("reference_date", F.lit(None).cast("date"))
    locked = F.col("status") == "LOCKED"
    start = F.coalesce("lockin_date_from", "reference_date")
    tests = {
        "anchor_30_rows": F.col("bucket") == "anchor_30", "anchor_90_rows": F.col("bucket") == "anchor_90", "locked_free_bucket": locked & F.col("lockin_date_to").isNotNull() & (F.col("bucket") == "free"),
        "negative_periods": locked & (F.date_diff("lockin_date_to", start) < 0), "locked_without_end": locked & F.col("lockin_date_to").isNull(),
        "range_errors": F.col("distinctive_to") - F.col("distinctive_from") + 1 != F.col("shares"),
    }
    return lots.groupBy("processing_log_id").agg(*(F.count_if(t).alias(n) for n, t in tests.items()))


def _verdict(rule: str, passed: Column, message: Column, expected: Column, actual: Column, can: Column | None = None, overridden: Column | None = None, reason: Column | None = None) -> Column:
    no = F.lit(False)
    return F.struct(F.lit(rule).alias("rule_id"), F.coalesce(passed, no).alias("passed"), message.alias("message"), expected.cast("bigint").alias("expected"), actual.cast("bigint").alias("actual"), (can if can is not None else no).alias("can_override"), (overridden if overridden is not None else no).alias("overridden"), (reason if reason is not None else F.lit(None).cast("string")).alias("override_reason"))


def _n(column: Column | str) -> Column:
    return F.format_number(F.col(column) if isinstance(column, str) else column, 0)


def _equal(rule: str, expected: Column, actual: Column, left: Column, right: Column) -> Column:
    same = expected == actual
    return _verdict(rule, same, F.concat(left, F.when(same, " == ").otherwise(" != "), right), expected, actual)


def rule1() -> Column:
    total = F.col("locked_total") + F.col("free_total")
    return _equal("RULE1", F.col("computed_total"), total, F.concat(F.lit("Locked ("), _n("locked_total"), F.lit(") + Free ("), _n("free_total"), F.lit(") = "), _n(total)), F.concat(F.lit("Computed Total ("), _n("computed_total"), F.lit(")")))


def rule2(strict: bool = False) -> Column:
    """Computed is the declared total. Unless strict, a document that agrees with itself and the shareholding pattern overrides the master; one of both allows it by hand."""
    expected, actual, text_total = F.coalesce("declared_total", "computed_total"), F.col("computed_total"), F.col("text_total")
    same = expected == actual
    own, shp = F.coalesce(text_total == actual, F.lit(False)), F.coalesce(text_total == F.col("shp_total_shares"), F.lit(False))
    base = F.concat(F.lit("Computed Total ("), _n("computed_total"), F.when(same, F.lit(") == ")).otherwise(F.lit(") != ")), F.lit("Declared Total ("), _n(expected), F.lit(")"))
    if strict:
        return _verdict("RULE2", F.col("declared_total") == actual, base, F.col("declared_total"), actual)
    auto, by_hand = ~same & own & shp, ~same & (own | shp)
    reason = F.when(auto, F.concat(F.lit("Document agrees with itself ("), _n("text_total"), F.lit(") and the shareholding pattern; master ("), _n(expected), F.lit(") is out of date")))
    note = F.when(auto, F.concat(F.lit(" | AUTO-OVERRIDE: "), reason)).when(by_hand, " | CAN_OVERRIDE").otherwise("")
    return _verdict("RULE2", same | auto, F.concat(base, note), expected, actual, by_hand, auto, reason)


def rule3() -> Column:
    return _equal("RULE3", F.col("computed_total"), F.col("shp_total_shares"), F.concat(F.lit("SHP Total ("), _n("shp_total_shares"), F.lit(")")), F.concat(F.lit("Lock-in Total ("), _n("computed_total"), F.lit(")")))


def rule4() -> Column:
    return _equal("RULE4", F.col("locked_total"), F.col("shp_locked_shares"), F.concat(F.lit("SHP Locked ("), _n("shp_locked_shares"), F.lit(")")), F.concat(F.lit("Lock-in Locked ("), _n("locked_total"), F.lit(")")))


def rule5() -> Column:
    parts = F.col("shp_promoter_shares") + F.col("shp_public_shares") + F.col("shp_others_shares")
    left = F.concat(F.lit("Promoter ("), _n("shp_promoter_shares"), F.lit(") + Public ("), _n("shp_public_shares"), F.lit(") + Others ("), _n("shp_others_shares"), F.lit(") = "), _n(parts))
    return _equal("RULE5", F.col("shp_total_shares"), parts, left, F.concat(F.lit("SHP Total ("), _n("shp_total_shares"), F.lit(")")))


# What the rules over lots say.
ANCHOR_BOTH, ANCHOR_MISSING = "Anchor letter URL exists and both anchor buckets found", "Anchor letter URL exists but missing required anchor bucket(s): "
NO_ANCHOR, ANCHOR_ROWS = "No anchor letter URL and no anchor rows (correct)", "No anchor letter URL but %d anchor row(s) found"
LOTS_SAY = {
    "RULE7": ("locked_free_bucket", "All locked rows with lock-in dates have non-free buckets", "Found %d locked row(s) with lock-in date but bucket=free"),
    "RULE8": ("negative_periods", "No negative lock-period rows found", "Found %d row(s) with negative lock period"),
    "RULE10": ("locked_without_end", "All locked rows have valid lock-in upto dates", "Found %d locked row(s) with missing/invalid lock-in upto date"),
}


def rule6() -> Column:
    """An anchor letter asks for lots in both anchor buckets, its absence for none; old allotments are let off."""
    a, b = F.col("anchor_30_rows"), F.col("anchor_90_rows")
    letter = F.trim(F.coalesce("anchor_letter_url", F.lit(""))) != ""
    old = F.coalesce(F.upper("exchange").isin("NSE", "BSE") & (F.col("reference_date") <= F.lit(ANCHOR_CUTOFF).cast("date")), F.lit(False))
    good = F.when(letter, (a > 0) & (b > 0)).otherwise(a + b == 0)
    counts = F.format_string(" (anchor_30=%d, anchor_90=%d)", a, b)
    legacy = F.format_string(f" (legacy %s exception: allotment_date %s <= {ANCHOR_CUTOFF})", F.upper("exchange"), F.col("reference_date").cast("string"))
    missing = F.concat_ws(", ", F.when(a == 0, "anchor_30"), F.when(b == 0, "anchor_90"))
    say = F.when(letter & good, F.concat(F.lit(ANCHOR_BOTH), counts)).when(letter, F.concat(F.lit(ANCHOR_MISSING), missing, counts, F.when(old, legacy).otherwise("")))
    say = say.when(good, NO_ANCHOR).otherwise(F.concat(F.format_string(ANCHOR_ROWS, a + b), F.when(old, legacy).otherwise(" (unexpected)")))
    return _verdict("RULE6", good | old, say, letter.cast("int"), a + b)


def _none_of(rule: str, can: bool = False) -> Column:
    """The lots' fact of a rule must be zero."""
    fact, fine, found = LOTS_SAY[rule]
    n = F.col(fact)
    return _verdict(rule, n == 0, F.when(n == 0, fine).otherwise(F.format_string(found, n)), F.lit(0), n, F.lit(can))


def rule7() -> Column:
    return _none_of("RULE7")


def rule8() -> Column:
    return _none_of("RULE8", can=True)


def rule10() -> Column:
    return _none_of("RULE10")


def stored(records: DataFrame, lots: DataFrame) -> DataFrame:
    """Stored records (id, allotment_date, ...) as the strict form judges them: missing figures count as zero, and the stored
    allotment date alone is what lock periods and the anchor rule go by. Buckets and states count in any case."""
    figures = [c for c in ("computed_total", "locked_total", "free_total", "declared_total", *(f"shp_{n}_shares" for n in ("total", "locked", "promoter", "public", "others"))) if c in records.columns]
    rows = lots.withColumns({"bucket": F.lower(F.coalesce("bucket", F.lit(""))), "status": F.upper(F.coalesce("status", F.lit("")))})
    found = facts(rows, records.select(F.col("id").alias("processing_log_id"), F.col("allotment_date").alias("reference_date")))
    own = records.withColumns({**{c: F.coalesce(c, F.lit(0)) for c in figures}, "reference_date": F.col("allotment_date")}).drop(*FACTS)
    return own.join(found.withColumnRenamed("processing_log_id", "id"), "id", "left").fillna(0, list(FACTS))


def one(rule: str, strict: bool = False) -> Column:
    """The verdict of one rule, as a struct."""
    makers = {"RULE1": rule1, "RULE2": lambda: rule2(strict), "RULE3": rule3, "RULE4": rule4, "RULE5": rule5, "RULE6": rule6, "RULE7": rule7, "RULE8": rule8, "RULE10": rule10}
    return makers[rule]()


def judged(records: DataFrame, strict: bool = False) -> DataFrame:
    """Records with all verdicts as the array ``verdicts``, in order; blank documents have none and stay out."""
    rows = records.where(~F.coalesce("is_blank", F.lit(False))) if "is_blank" in records.columns else records
    return rows.withColumn("verdicts", F.array(*(one(r, strict) for r in ORDER)))


def verdicts(records: DataFrame, strict: bool = False) -> DataFrame:
    """Long form: one row per record and rule. ``records`` has id, totals, shareholding, facts and reference_date; blank documents have none."""
    return judged(records, strict).select("id", F.posexplode("verdicts").alias("place", "v")).select("id", "place", "v.*")


def overridden(long: DataFrame, overrides: DataFrame) -> DataFrame:
    """Verdicts with manual overrides (id, rule_id, reason): only a failed rule that allows it passes by one."""
    by = overrides.groupBy("id", "rule_id").agg(F.min("reason").alias("_reason"))
    out = long.join(by, ["id", "rule_id"], "left")
    use = F.coalesce(F.col("_reason").isNotNull() & ~F.col("passed") & F.col("can_override"), F.lit(False))
    return out.withColumns({"override_reason": F.when(use, F.col("_reason")).otherwise(F.col("override_reason")), "overridden": F.col("overridden") | use, "passed": F.col("passed") | use}).select(*long.columns)


def counted(records: DataFrame, strict: bool = False) -> DataFrame:
    """Passed and failed rules of each record, the failed by name in the order of the rules. Counts within the row, without a shuffle."""
    tests = [(r, one(r, strict)["passed"]) for r in ORDER]
    rows = records.where(~F.coalesce("is_blank", F.lit(False))) if "is_blank" in records.columns else records
    names = F.array_compact(F.array(*(F.when(~F.col("p")[r], F.lit(r)) for r, _ in tests)))
    rows = rows.select("id", F.struct(*(t.alias(r) for r, t in tests)).alias("p")).select("id", names.alias("f"))
    return rows.select("id", (F.lit(len(ORDER)) - F.size("f")).cast("long").alias("passed"), F.size("f").cast("long").alias("failed"), F.array_join("f", ",").alias("failed_rules"))


def summary(long: DataFrame) -> DataFrame:
    """As ``counted``, of verdicts in long form, which may have been overridden."""
    failed = F.array_sort(F.collect_list(F.when(~F.col("passed"), F.struct("place", "rule_id"))))
    return long.groupBy("id").agg(F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"), F.array_join(F.transform(failed, lambda f: f["rule_id"]), ",").alias("failed_rules"))


def stored_bucket_problems(lots: DataFrame) -> DataFrame:
    """Locked lots of each record whose stored bucket isn't one: old names, blanks, unknown ones."""
    b, locked = F.col("bucket"), F.col("status") == "LOCKED"
    bad = locked & (b.isNull() | (F.trim(b) == "") | ~F.lower(b).isin(*BUCKETS[:-1]))
    blank = b.isNull() | (F.trim(F.coalesce(b, F.lit(""))) == "")
    old = b.isin(*RENAMED)
    rows = lots.where(bad).groupBy("processing_log_id").agg(F.count("*").alias("bad"), F.count_if(blank).alias("blank"), F.count_if(~blank & old).alias("legacy"), F.count_if(~blank & ~old).alias("unknown"))
    return rows


def may_finalize(status: Column, all_passed: Column, blank: Column) -> Column:
    """Why a record can't be finalized; null if it can."""
    return F.when(F.coalesce(blank, F.lit(False)), "document is blank").when(status == "FINALIZED", "already finalized").when(~F.coalesce(all_passed, F.lit(False)), "rules failed")


def may_roll_back(status: Column) -> Column:
    return F.when(status != "FINALIZED", "not finalized")


def promotable(c: str = "candidate") -> Column:
    """Reasons against promoting a candidate snapshot, each once; empty if there are none."""
    f = lambda n: F.col(f"{c}.{n}")
    tests = (
        (f("rows_count").isNull() | (f("rows_count") == 0), "no rows"), (f("computed_total").isNull(), "no computed total"), (f("declared_total").isNull(), "no declared total"),
        (f("computed_total") != f("declared_total"), "totals differ"), (f("locked_total") + f("free_total") != f("computed_total"), "locked and free don't add up"), (f("shp_total_shares").isNull(), "no shareholding"),
        (f("shp_total_shares") != f("computed_total"), "shareholding total differs"), (f("shp_locked_shares") != f("locked_total"), "shareholding locked differs"),
        (f("shp_promoter_shares") + f("shp_public_shares") + f("shp_others_shares") != f("shp_total_shares"), "shareholding doesn't add up"), (F.coalesce(f("finalized"), F.lit(False)), "already finalized"),
    )
    return F.array_distinct(F.array_compact(F.array(*(F.when(F.coalesce(t, F.lit(False)), say) for t, say in tests))))
