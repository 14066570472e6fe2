"""Permits: both feeds brought into one shape, classified, and joined to everything known about them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import PERMIT_HASHED, PERMITS, conform
from ..functions import columns as c
from ..region import COUNTY, Region
from .contractors import linked
from .lineage import carry_lineage
from .upsert import latest, stacked


def from_roll(raw: DataFrame, region: Region, fetched_at: str | None = None) -> DataFrame:
    """Permits of the appraiser's roll; of one number and parcel the latest issued."""
    # Dates are parsed once, in a projection of their own, and used many times after it.
    days = ("final", "co", "sign_off", "cancel", "issue", "submit", "key")
    kept = raw.where(c.txt("permit_num").isNotNull() & c.txt("strap").isNotNull())
    raw = kept.withColumns({f"__{n}": c.source_date(f"{n}_dt") for n in days})
    final, co, sign, cancel, issue, submit, keyed = (F.col(f"__{n}") for n in days)
    street = F.nullif(F.concat_ws(" ", *[c.txt(f"site_{n}") for n in ("num", "pfx", "str", "tp", "sfx")]), F.lit(""))
    out = raw.select(
        F.trim("permit_num").alias("permit_number"),
        c.parcel_key("strap").alias("parcel_identifier"),
        c.roll_status("status", F.coalesce(final, co, sign), cancel).alias("improvement_status"),
        c.txt("permit_type").alias("improvement_action"),
        issue.alias("permit_issue_date"),
        submit.alias("application_received_date"),
        final.alias("final_inspection_date"),
        F.coalesce(final, co, sign, cancel).alias("permit_close_date"),
        F.coalesce(co, sign).alias("completion_date"),
        F.lit(None).cast("date").alias("expiration_date"),
        F.coalesce(submit, keyed, issue).alias("opened_date"),
        F.lit(region.appraiser).alias("source_system"),
        c.txt("dscr").alias("description"),
        F.coalesce(c.num("est_val"), c.num("calc_val")).alias("estimated_job_value"),
        c.agency("agency_id").alias("issuing_agency"),
        c.business_part("contractor").alias("contractor_name"),
        c.person_part("contractor").alias("contractor_qualifier"),
        c.phone10("contractor_tel").alias("contractor_phone"),
        F.lit(None).cast("string").alias("contractor_license"),
        street.alias("address_street"),
        F.lit(None).cast("string").alias("address_city"),
        c.txt("site_zip").alias("address_zip"),
        F.lit(region.sources["roll"].url).alias("source_url"),
        F.lit(fetched_at).cast("string").alias("fetched_at"),
    )
    return latest(out, ["permit_number", "parcel_identifier"], [F.desc_nulls_last("permit_issue_date")])


def from_portal(raw: DataFrame, region: Region) -> DataFrame:
    """Permits of the portal; of one number the latest fetched."""
    day = lambda n: F.col(n).try_cast("date")
    opened, finaled = day("opened_date"), day("finaled_date")
    one = latest(raw, ["permit_number"], [F.desc_nulls_last("fetched_at")])
    return one.select(
        "permit_number",
        c.parcel_key("parcel_number").alias("parcel_identifier"),
        c.portal_status("status", F.col("finaled_date"), F.col("closed_date")).alias("improvement_status"),
        F.col("record_type").alias("improvement_action"),
        day("issued_date").alias("permit_issue_date"),
        opened.alias("application_received_date"),
        finaled.alias("final_inspection_date"),
        F.coalesce(day("closed_date"), finaled).alias("permit_close_date"),
        finaled.alias("completion_date"),
        day("expiration_date").alias("expiration_date"),
        opened.alias("opened_date"),
        F.lit(region.portal).alias("source_system"),
        "description",
        F.col("job_value").alias("estimated_job_value"),
        F.lit(f"{region.name} County").alias("issuing_agency"),
        F.coalesce("contractor_business_name", "contractor_name").alias("contractor_name"),
        F.when(F.col("contractor_business_name").isNotNull(), F.col("contractor_name")).alias("contractor_qualifier"),
        c.phone10("contractor_phone").alias("contractor_phone"),
        F.nullif(c.alnum("contractor_license"), F.lit("")).alias("contractor_license"),
        F.col("address").alias("address_street"),
        F.lit(None).cast("string").alias("address_city"),
        F.lit(None).cast("string").alias("address_zip"),
        "source_url",
        F.col("fetched_at").cast("string").alias("fetched_at"),
    )


def open_flag(status: Column, closed: Column) -> Column:
    return (status == "open") & closed.isNull()


def stage(feeds: list[DataFrame], run_date: date, region: Region = COUNTY) -> DataFrame:
    """All feeds by column name, with class, open flag, days open, ids and hash."""
    rows = stacked(feeds)
    run = F.lit(run_date)
    roofing = c.is_roofing("improvement_action", "description")
    is_open = open_flag(F.col("improvement_status"), F.col("permit_close_date"))
    flagged = rows.withColumns({"is_roofing": roofing, "is_open": is_open})
    typed = flagged.withColumn("improvement_type", c.improvement_type(F.col("is_roofing"), "improvement_action"))
    until = F.when(F.col("is_open"), run).otherwise(F.coalesce("permit_close_date", run))
    return typed.withColumns(
        {
            "days_open": F.datediff(until, F.coalesce("permit_issue_date", "opened_date")),
            "contractor_name_norm": c.normalized_name("contractor_name"),
        }
    ).transform(lambda df: with_ids(df, region))


#: Hashes of a permit's other columns: nothing compresses them, so that they are left out of what is stored or shuffled and made anew.
IDS = ["property_improvement_id", "property_id", "row_hash"]


def with_ids(rows: DataFrame, region: Region = COUNTY) -> DataFrame:
    """``rows`` with the columns of ``IDS``."""
    return rows.withColumns(
        {
            "property_improvement_id": c.surrogate_key("source_system", "permit_number", "parcel_identifier"),
            "property_id": c.surrogate_key(F.lit(region.key), "parcel_identifier"),
            "row_hash": c.row_hash(PERMIT_HASHED, {"estimated_job_value"}),
        }
    )


def publish(staged: DataFrame, base: DataFrame, alias: DataFrame, ratings: DataFrame | None, parcels: DataFrame | None, previous: DataFrame | None, run_id: str, region: Region = COUNTY) -> DataFrame:
    """The published permits of ``staged`` (without ``IDS``). ``base``: properties before permits; all other sides have one row a key.

    Both sides by parcel come first and share one shuffle of the permits; aliases and ratings are small and find them where they lie.
    """
    site = base.select(F.col("request_identifier").alias("parcel_identifier"), F.col("address_street").alias("__street"), F.col("address_city").alias("__city"), F.col("address_zip").alias("__zip"), F.lit(True).alias("__known"))
    out = staged.join(site, "parcel_identifier", "left")
    if parcels is not None:
        out = out.join(parcels.select(F.col("parcel_no").alias("parcel_identifier"), "latitude", "longitude"), "parcel_identifier", "left")
    out = linked(out, alias)
    if ratings is not None:
        out = out.join(ratings.select("contractor_id", "bbb_rating", "bbb_accredited", "bbb_profile_url", "bbb_match_method"), "contractor_id", "left")
    out = with_ids(out, region).withColumns(
        {
            "property_id": F.when(F.col("__known"), F.col("property_id")),
            "project_description": F.col("description"),
            "county_name": F.lit(region.name),
            "address_street": F.coalesce("address_street", "__street"),
            "address_city": F.coalesce("address_city", "__city"),
            "address_zip": F.coalesce("address_zip", "__zip"),
        }
    )
    return conform(carry_lineage(out, previous, "property_improvement_id", run_id), PERMITS)
