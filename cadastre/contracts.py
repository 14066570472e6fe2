"""The published tables: fixed columns, types and order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType


@dataclass(frozen=True)
class Contract:
    name: str
    key: str
    schema: StructType

    @property
    def columns(self) -> list[str]:
        return self.schema.names


TYPES = {"string": StringType(), "double": DoubleType(), "long": LongType(), "int": IntegerType(), "boolean": BooleanType()}


def contract(name: str, key: str, columns: str) -> Contract:
    pairs = [c.split() for c in columns.split(",")]
    return Contract(name, key, StructType([StructField(n, TYPES[t]) for n, t in pairs]))


# The contract of each table, in its column order.
PROPERTIES = contract(
    "properties",
    "property_id",
    "property_id string, property_cid string, request_identifier string, parcel_identifier string, source_system string, county_name string, state_code string, "
    "address_street string, address_city string, address_zip string, latitude double, longitude double, lot_size_acre double, lot_area_sqft double, "
    "exterior_wall_material string, roof_covering_material string, property_type string, property_usage_type string, built_year long, livable_floor_area double, "
    "total_area double, assessed_value double, market_value double, land_value double, avm_value double, owner_name string, owners_text string, owner_count long, "
    "owner_occupied boolean, last_sale_date string, last_sale_price double, subdivision string, has_permits boolean, permit_count long, has_sunbiz_tenant boolean, "
    "has_bbb_contractor boolean, has_pa_corp_tenant boolean, hoa_flag boolean, effective_year long, last_roof_permit_date string, roof_age_basis string, "
    "roof_age_years int, open_roof_permit_count int, oldest_open_roof_permit_days int, years_since_sale double, owner_mail_city string, owner_mail_state string, "
    "owner_mail_country string, owner_out_of_county boolean, owner_out_of_state boolean, gis_year_built long, source_urls string, first_seen_run_id string, "
    "last_changed_run_id string, row_hash string",
)
PERMITS = contract(
    "permits",
    "property_improvement_id",
    "property_improvement_id string, property_id string, parcel_identifier string, permit_number string, improvement_type string, improvement_status string, "
    "improvement_action string, permit_issue_date string, application_received_date string, final_inspection_date string, permit_close_date string, "
    "completion_date string, expiration_date string, opened_date string, source_system string, county_name string, project_description string, description string, "
    "estimated_job_value double, fee double, is_roofing boolean, is_open boolean, days_open int, issuing_agency string, contractor_name string, "
    "contractor_qualifier string, contractor_phone string, contractor_license string, contractor_id string, bbb_rating string, bbb_accredited boolean, "
    "bbb_profile_url string, bbb_match_method string, latitude double, longitude double, address_street string, address_city string, address_zip string, "
    "source_url string, fetched_at string, first_seen_run_id string, last_changed_run_id string, row_hash string",
)
CONTRACTORS = contract(
    "contractors",
    "contractor_id",
    "contractor_id string, display_name string, normalized_name string, license_number string, phone string, identity_basis string, permit_count int, "
    "roofing_permit_count int, open_roofing_permit_count int, first_permit_date string, last_permit_date string, bbb_id string, bbb_rating string, "
    "bbb_accredited boolean, bbb_review_count int, bbb_complaint_count int, bbb_profile_url string, bbb_match_method string, source_systems string",
)
PLACES = contract(
    "places",
    "place_id",
    "place_id string, name string, taxonomy_primary string, taxonomy_hierarchy string, basic_category string, is_contractor boolean, operating_status string, "
    "confidence double, phone string, website string, address_street string, address_city string, address_zip string, latitude double, longitude double, "
    "contractor_id string, source_datasets string, overture_release string, source_url string, fetched_at string",
)
TABLES = {c.name: c for c in (PROPERTIES, PERMITS, CONTRACTORS, PLACES)}

PERMIT_HASHED = [
    "parcel_identifier", "improvement_type", "improvement_status", "improvement_action", "permit_issue_date", "application_received_date", "final_inspection_date",
    "permit_close_date", "completion_date", "expiration_date", "opened_date", "description", "estimated_job_value", "contractor_name", "contractor_qualifier",
    "contractor_phone", "contractor_license",
]
PROPERTY_HASHED = [
    "address_street", "address_city", "address_zip", "latitude", "longitude", "lot_size_acre", "property_usage_type", "built_year", "effective_year",
    "livable_floor_area", "total_area", "assessed_value", "market_value", "land_value", "owner_name", "owners_text", "owner_count", "last_sale_date",
    "last_sale_price", "subdivision", "permit_count", "last_roof_permit_date", "open_roof_permit_count", "owner_mail_city", "owner_mail_state", "owner_mail_country",
]


def conform(df: DataFrame, table: Contract) -> DataFrame:
    """The contract's columns in its order and types; a column that ``df`` lacks is null."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema.fields])


def empty(spark: SparkSession, table: Contract) -> DataFrame:
    return spark.createDataFrame([], table.schema)


def describe(table: str) -> list[tuple[str, str]]:
    """(column, type) of a published table; unknown names raise."""
    if table not in TABLES:
        raise ValueError(f"unknown table: {table}")
    return [(f.name, f.dataType.simpleString()) for f in TABLES[table].schema.fields]
