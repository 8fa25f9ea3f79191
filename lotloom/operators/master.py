"""Records and the master list of issuers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotloom.functions import text
from lotloom.operators.ledger import latest


def keyed(master: DataFrame) -> DataFrame:
    """The master by key: a row ``BSE:<code>`` and a row ``NSE:<symbol>`` for each issuer, one row a key.

    Records then join on equality, where a join on code or symbol would compare all with all.
    """
    keys = F.array_compact(F.array(F.concat(F.lit("BSE:"), F.nullif(F.trim(F.col("bse_script_code").cast("string")), F.lit(""))), F.concat(F.lit("NSE:"), F.upper(F.nullif(F.trim("nse_symbol"), F.lit(""))))))
    rows = master.select(F.explode(keys).alias("master_key"), *master.columns)
    smallest = F.struct(*(F.col(c) for c in sorted(master.columns)))
    return rows.groupBy("master_key").agg(F.min(smallest).alias("_m")).select("master_key", *(F.col("_m")[c].alias(c) for c in master.columns))


def record_key(exchange: str = "exchange", symbol: str = "unique_symbol"):
    return F.concat(F.upper(F.col(exchange)), F.lit(":"), F.upper(text.after_colon(F.col(symbol))))


def with_master(records: DataFrame, master: DataFrame) -> DataFrame:
    """Records with their issuer's columns, null where there is none; no record is repeated."""
    extra = [c for c in master.columns if c not in records.columns]
    side = keyed(master).select("master_key", *extra)
    return records.withColumn("master_key", record_key()).join(side, "master_key", "left").drop("master_key")


def resolved(records: DataFrame, master: DataFrame, hints: DataFrame | None = None) -> DataFrame:
    """Records with the issuer found by key or, without a reference date there, by the company's slug.

    A slug's issuer replaces the key's as a whole. ``hints`` (id, listing_date, shares, company_name)
    from notices then fill what is still missing, field by field; they also give the name for the slug.
    """
    fields = ["company_name", "allotment_date", "listing_date_actual", "expected_listing_date", "post_issue_shares", "anchor_letter_url"]
    base = records.withColumn("master_key", record_key())
    by_key = keyed(master).select("master_key", F.struct(*fields).alias("_k"))
    out = base.join(by_key, "master_key", "left").drop("master_key")
    if hints is not None:
        out = out.join(hints.select("id", F.struct("listing_date", "shares", "company_name").alias("_h")), "id", "left")
        dated = F.coalesce("_k.allotment_date", "_k.listing_date_actual", "_k.expected_listing_date")
        names = out.where(dated.isNull() & F.col("_h.company_name").isNotNull()).select("id", F.posexplode(text.slugs(F.col("_h.company_name"))).alias("place", "url_slug"))
        by_slug = latest(master.select("url_slug", *fields).where("url_slug is not null"), ["url_slug"], "company_name")
        found = names.join(by_slug.select("url_slug", F.struct(*fields).alias("_s")), "url_slug").groupBy("id").agg(F.min_by("_s", "place").alias("_s"))
        out = out.join(found, "id", "left").withColumn("_k", F.coalesce("_s", "_k"))
        out = out.withColumn("_k", F.struct(F.coalesce("_k.company_name", "_h.company_name").alias("company_name"), F.col("_k.allotment_date").alias("allotment_date"), F.coalesce("_k.listing_date_actual", "_h.listing_date").alias("listing_date_actual"), F.col("_k.expected_listing_date").alias("expected_listing_date"), F.coalesce("_k.post_issue_shares", "_h.shares").alias("post_issue_shares"), F.col("_k.anchor_letter_url").alias("anchor_letter_url")))
    out = out.select(*records.columns, *(F.col("_k")[f].alias(f) for f in fields if f not in records.columns))
    return out.withColumn("reference_date", F.coalesce("allotment_date", "listing_date_actual", "expected_listing_date"))


def paired(lockins: DataFrame, shps: DataFrame) -> DataFrame:
    """Each lock-in document with the shareholding pattern of the same issuer."""
    keys = ["exchange", "symbol"]
    return lockins.join(shps.groupBy(*keys).agg(F.min("path").alias("shp_path"), F.min_by("text", "path").alias("shp_text")), keys, "left")
