"""Harvested records as JSON lines, with explicit nested schemas; and which files a load should read."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import by_quality, latest, with_fallback

# The shapes of the harvested records.
PERMIT = (
    "permitNumber string, capId struct<capID1:string,capID2:string,capID3:string>, recordType string, status string, openedDate string, issuedDate string, "
    "expirationDate string, finaledDate string, closedDate string, description string, jobValue double, parcelNumber string, address string, "
    "contractor struct<name:string,businessName:string,licenseNumber:string,licenseType:string,phone:string,address:string>, sourceUrl string, fetchedAt string, "
    "rawHtmlSha256 string, rawHtmlPath string"
)
PARCEL = "objectId long, parcelNo string, displayStrap string, latitude double, longitude double, yearBuilt int, dorCode string, locCity string, locZip string, lastUpdate string, acres double, fetchedAt string"
PROFILE = (
    "bbbId string, name string, rating string, accredited boolean, ratingScore double, reviewCount int, complaintCount int, phone string, address string, city string, "
    "state string, zip string, licenseNumbers array<string>, categories array<string>, profileUrl string, fetchedAt string, rawHtmlSha256 string"
)
LISTING = (
    "bbbId string, bureauId string, businessId string, name string, profileUrl string, city string, state string, postalCode string, rating string, ratingScore double, "
    "accredited boolean, phones array<string>, categories array<string>, primaryCategory string, outOfBusiness boolean, searchCity string, searchCategory string, sort string, page int"
)
SUMMARY = "window struct<since:string,until:string>, recordType string, searchHits int, capped boolean, detailsFetched int, detailsFailed int, startedAt string, finishedAt string, requestCount int, p50LatencyMs double, p95LatencyMs double"


def read_lines(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """JSON lines with a given schema; fields that a line lacks are null, and broken lines all null are dropped."""
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(paths)
    return rows.dropna(how="all")


def files_of(folder: str | Path, stem: str) -> list[str]:
    """The merged file of a harvest if there is one, else its parts in order. Driver-side listing."""
    folder = Path(folder)
    merged = folder / f"{stem}.jsonl"
    return [str(merged)] if merged.exists() else sorted(str(p) for p in folder.glob(f"{stem}-*.jsonl"))


def portal_permits(lines: DataFrame) -> DataFrame:
    """Flat permits, one a number, the latest fetched."""
    flat = lines.select(
        F.col("permitNumber").alias("permit_number"), F.col("recordType").alias("record_type"), "status", F.col("openedDate").alias("opened_date"), F.col("issuedDate").alias("issued_date"),
        F.col("expirationDate").alias("expiration_date"), F.col("finaledDate").alias("finaled_date"), F.col("closedDate").alias("closed_date"), "description", F.col("jobValue").alias("job_value"),
        F.col("parcelNumber").alias("parcel_number"), "address", F.col("contractor.name").alias("contractor_name"), F.col("contractor.businessName").alias("contractor_business_name"),
        F.col("contractor.licenseNumber").alias("contractor_license"), F.col("contractor.phone").alias("contractor_phone"), F.col("sourceUrl").alias("source_url"),
        F.col("fetchedAt").alias("fetched_at"), F.col("rawHtmlSha256").alias("raw_html_sha256"),
    )
    return latest(flat.where("permit_number IS NOT NULL"), ["permit_number"], [F.desc_nulls_last("fetched_at")])


def parcels(lines: DataFrame) -> DataFrame:
    """One feature a parcel, the one of the largest object id."""
    flat = lines.select(
        F.col("objectId").alias("object_id"), F.col("parcelNo").alias("parcel_no"), "latitude", "longitude", F.col("yearBuilt").alias("year_built"), F.col("dorCode").alias("dor_code"),
        F.col("lastUpdate").try_cast("date").alias("last_update"), "acres", F.col("fetchedAt").try_cast("timestamp_ntz").alias("fetched_at"),
    )
    return latest(flat.where("parcel_no IS NOT NULL"), ["parcel_no"], [F.desc("object_id")])


def profiles(full: DataFrame, listings: DataFrame) -> DataFrame:
    """Rated businesses: profiles, and listings of those without one. Listings have one phone and no licences."""
    thin = listings.select(
        "bbbId", "name", "rating", "accredited", "ratingScore", F.get("phones", F.lit(0)).alias("phone"), "city", "state", F.col("postalCode").alias("zip"),
        F.array().cast("array<string>").alias("licenseNumbers"), "categories", "profileUrl",
    )
    best = latest(with_fallback(full, thin, "bbbId").where("bbbId IS NOT NULL"), ["bbbId"], by_quality())
    return best.select(
        F.col("bbbId").alias("bbb_id"), "name", "rating", "accredited", F.col("reviewCount").alias("review_count"), F.col("complaintCount").alias("complaint_count"), "phone",
        F.col("licenseNumbers").alias("license_numbers"), F.col("profileUrl").alias("profile_url"), F.col("rawHtmlSha256").alias("raw_html_sha256"), F.col("fetchedAt").alias("fetched_at"),
    )


def features(raw: DataFrame, run_year: int) -> DataFrame:
    """Feature-service attributes to parcel records; without centroid, id or parcel they are dropped. What ``raw`` lacks of the rest is null."""
    year = F.col("YearBuilt").cast("int")
    told = lambda name, kind: (F.nullif(F.trim(name), F.lit("")) if kind == "string" else F.col(name).cast(kind)) if name in raw.columns else F.lit(None).cast(kind)
    when = F.date_format(F.timestamp_millis("LastUpdate"), "yyyy-MM-dd")
    out = raw.select(
        F.col("OBJECTID").cast("long").alias("objectId"), F.trim("ParcelNo").alias("parcelNo"), F.col("y").cast("double").alias("latitude"), F.col("x").cast("double").alias("longitude"),
        F.when((year > 1700) & (year <= run_year + 1), year).alias("yearBuilt"), when.alias("lastUpdate"), told("DisplayStrap", "string").alias("displayStrap"), told("DORCode", "string").alias("dorCode"),
        told("LocCity", "string").alias("locCity"), told("LocZip", "string").alias("locZip"), told("TotalAcres", "double").alias("acres"),
    )
    return out.where("objectId IS NOT NULL AND parcelNo <> '' AND latitude IS NOT NULL AND longitude IS NOT NULL")
