"""Lead search over the published tables. Options become DataFrames; no SQL text is built."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import Ring, box_around, haversine_miles, in_box, in_polygon
from ..region import Box

# The property classes, and the columns that searches return.
PROPERTY_TYPES = ("residential", "commercial", "industrial", "agricultural", "institutional", "government", "other")
PROPERTY_COLUMNS = [
    "property_id", "parcel_identifier", "address_street", "address_city", "address_zip", "latitude", "longitude", "property_type", "property_usage_type", "built_year",
    "effective_year", "roof_age_years", "roof_age_basis", "last_roof_permit_date", "open_roof_permit_count", "oldest_open_roof_permit_days", "permit_count",
    "has_bbb_contractor", "owner_name", "owners_text", "owner_occupied", "owner_mail_city", "owner_mail_state", "owner_out_of_state", "owner_out_of_county",
    "last_sale_date", "last_sale_price", "years_since_sale", "market_value", "livable_floor_area", "source_urls", "first_seen_run_id", "last_changed_run_id",
]
PERMIT_COLUMNS = [
    "property_improvement_id", "property_id", "parcel_identifier", "permit_number", "improvement_type", "improvement_status", "improvement_action", "permit_issue_date",
    "opened_date", "permit_close_date", "final_inspection_date", "completion_date", "expiration_date", "is_roofing", "is_open", "days_open", "issuing_agency",
    "description", "estimated_job_value", "contractor_name", "contractor_qualifier", "contractor_phone", "contractor_license", "contractor_id", "bbb_rating",
    "bbb_accredited", "bbb_profile_url", "bbb_match_method", "latitude", "longitude", "address_street", "address_city", "address_zip", "source_system", "source_url",
    "fetched_at",
]
MOST_ROWS, MOST_PARCELS, MOST_MILES, MOST_TERM = 1000, 1000, 50, 120
SAFE_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9._:-]{0,64}")


def finite(value: float, name: str = "value") -> float:
    value = float(value)
    if value != value or value in (float("inf"), float("-inf")):
        raise ValueError(f"{name} must be a finite number")
    return value


def limit_of(limit: float | None, default: int) -> int:
    """A whole number of rows, ``MOST_ROWS`` at most; ``default`` for none, for one that is not finite, and below one."""
    wanted = float("nan") if limit is None else float(limit)
    return min(int(wanted), MOST_ROWS) if 1 <= wanted < float("inf") else default


def safe_id(value: str) -> str:
    if not SAFE_ID.fullmatch(value):
        raise ValueError(f"unsafe id: {value!r}")
    return value


def contains_term(c: str, term: str) -> Column:
    """Case-insensitive containment; what patterns treat as special is matched as it is written."""
    plain = re.sub(r"[\x00-\x1f\x7f]", "", term)[:MOST_TERM]
    return F.lower(c).contains(plain.lower())


@dataclass(frozen=True)
class Circle:
    lat: float
    lng: float
    miles: float

    def __post_init__(self) -> None:
        finite(self.lat, "lat"), finite(self.lng, "lng")
        if not 0 < finite(self.miles, "radius") <= MOST_MILES:
            raise ValueError(f"radius must be in (0, {MOST_MILES}]")

    def distance(self) -> Column:
        return haversine_miles(self.lat, self.lng)

    def around(self, rows: DataFrame) -> DataFrame:
        """Rows with coordinates in the circle's box: what the scan can filter by its statistics."""
        return rows.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & in_box(box_around(self.lat, self.lng, self.miles)))


@dataclass(frozen=True)
class PropertyFilter:
    min_roof_age: float | None = None
    open_roof_permits: bool = False
    open_min_years: float | None = None
    out_of_state: bool = False
    min_years_since_sale: float | None = None
    types: tuple[str, ...] = ()
    owner_contains: str | None = None
    parcels: tuple[str, ...] | None = None

    def condition(self) -> Column:
        tests = [F.lit(True)]
        if self.min_roof_age is not None:
            tests.append(F.col("roof_age_years") >= finite(self.min_roof_age))
        if self.open_roof_permits:
            tests.append(F.col("open_roof_permit_count") > 0)
        if self.open_min_years is not None:
            tests.append(F.col("oldest_open_roof_permit_days") >= int(finite(self.open_min_years) * 365.25 + 0.5))
        if self.out_of_state:
            tests.append(F.col("owner_out_of_state"))
        if self.min_years_since_sale is not None:
            tests.append(F.col("years_since_sale") >= finite(self.min_years_since_sale))
        if self.types:
            if unknown := set(self.types) - set(PROPERTY_TYPES):
                raise ValueError(f"unknown property types: {sorted(unknown)}")
            tests.append(F.col("property_type").isin(*self.types))
        if self.owner_contains and self.owner_contains.strip():
            tests.append(contains_term("owners_text", self.owner_contains.strip()))
        if self.parcels is not None:
            if not 1 <= len(self.parcels) <= MOST_PARCELS:
                raise ValueError(f"1 to {MOST_PARCELS} parcels")
            tests.append(F.col("parcel_identifier").isin(*map(safe_id, self.parcels)))
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out


@dataclass(frozen=True)
class PermitFilter:
    roofing_only: bool = True
    open_only: bool = True
    min_days_open: float | None = None
    require_contractor: bool = False

    def condition(self) -> Column:
        out = F.lit(True)
        if self.roofing_only:
            out = out & F.col("is_roofing")
        if self.open_only:
            out = out & F.col("is_open")
        if self.min_days_open is not None:
            out = out & (F.col("days_open") >= int(finite(self.min_days_open) // 1))
        if self.require_contractor:
            out = out & F.col("contractor_name").isNotNull()
        return out


def pick(rows: DataFrame, columns: list[str]) -> DataFrame:
    have = set(rows.columns)
    return rows.select(*[n for n in columns if n in have])


def radius_properties(properties: DataFrame, circle: Circle, wanted: PropertyFilter = PropertyFilter(), limit: int | None = None) -> DataFrame:  # noqa: B008
    """Oldest roofs first, then nearest. Distance is rounded to 0.01 mile before it is compared."""
    rows = pick(circle.around(properties).where(wanted.condition()), PROPERTY_COLUMNS).withColumn("distance_miles", F.round(circle.distance(), 2))
    return rows.where(F.col("distance_miles") <= circle.miles).orderBy(F.desc_nulls_last("roof_age_years"), "distance_miles", "parcel_identifier").limit(limit_of(limit, 500))


def radius_count(properties: DataFrame, circle: Circle, wanted: PropertyFilter = PropertyFilter()) -> DataFrame:  # noqa: B008
    """How many match without a limit; distance is compared unrounded."""
    return circle.around(properties).where(wanted.condition() & (circle.distance() <= circle.miles)).agg(F.count("*").alias("total"))


def radius_permits(permits: DataFrame, circle: Circle, wanted: PermitFilter = PermitFilter(), limit: int | None = None) -> DataFrame:  # noqa: B008
    """Longest open first, then nearest."""
    rows = pick(circle.around(permits).where(wanted.condition()), PERMIT_COLUMNS).withColumn("distance_miles", F.round(circle.distance(), 2))
    return rows.where(F.col("distance_miles") <= circle.miles).orderBy(F.desc_nulls_last("days_open"), "distance_miles", "permit_number").limit(limit_of(limit, 200))


def open_permits(permits: DataFrame, wanted: PermitFilter = PermitFilter(), limit: int | None = None) -> DataFrame:  # noqa: B008
    """Anywhere in the region, longest open first."""
    return pick(permits.where(wanted.condition()), PERMIT_COLUMNS).orderBy(F.desc_nulls_last("days_open"), "permit_number").limit(limit_of(limit, 200))


def property_by_parcel(properties: DataFrame, parcel: str) -> DataFrame:
    return properties.where(F.col("parcel_identifier") == safe_id(parcel)).limit(1)


def permits_by_parcel(permits: DataFrame, parcel: str, limit: int | None = None) -> DataFrame:
    """Roofing first, then open, then newest."""
    order = [F.desc("is_roofing"), F.desc("is_open"), F.coalesce("permit_issue_date", "opened_date").desc_nulls_last(), F.asc("permit_number")]
    return pick(permits.where(F.col("parcel_identifier") == safe_id(parcel)), PERMIT_COLUMNS).orderBy(*order).limit(limit_of(limit, 200))


def permits_for_parcels(permits: DataFrame, parcels: list[str], *, roofing_only: bool = True, open_only: bool = False, limit: int | None = None) -> DataFrame:
    if not 1 <= len(parcels) <= 500:
        raise ValueError("1 to 500 parcels")
    wanted = PermitFilter(roofing_only=roofing_only, open_only=open_only)
    rows = permits.where(F.col("parcel_identifier").isin(*map(safe_id, parcels)) & wanted.condition())
    return pick(rows, PERMIT_COLUMNS).orderBy(F.desc_nulls_last("days_open"), "permit_number").limit(limit_of(limit, MOST_ROWS))


def with_permits(found: DataFrame, permits: DataFrame, columns: list[str]) -> DataFrame:
    """Found properties with an array of their permits, longest open first: one join instead of a round trip."""
    order = F.struct(F.coalesce(-F.col("days_open"), F.lit(1)).alias("__order"), *columns)
    own = permits.join(found.select("parcel_identifier"), "parcel_identifier", "left_semi").groupBy("parcel_identifier").agg(F.array_sort(F.collect_list(order)).alias("permits"))
    nested = found.join(own, "parcel_identifier", "left")
    bare = F.transform("permits", lambda p: F.struct(*[p[n].alias(n) for n in columns]))
    return nested.withColumn("permits", F.coalesce(bare, F.array().cast(nested.select(bare.alias("p")).schema["p"].dataType)))


@dataclass(frozen=True)
class Leads:
    """``total`` and ``truncated`` count when they are first read, not before."""

    properties: DataFrame
    counted: DataFrame
    limit: int

    @cached_property
    def total(self) -> int:
        return self.counted.first()["total"]

    @property
    def truncated(self) -> bool:
        return self.total > self.limit


def radius_leads(properties: DataFrame, permits: DataFrame, circle: Circle, wanted: PropertyFilter = PropertyFilter(), *, permit_side: PermitFilter | None = None, include_permits: bool = True, limit: int | None = None) -> Leads:  # noqa: B008
    """The composite search: parcels picked by a permit-side filter, properties, their permits, and the whole count."""
    if permit_side is not None:
        near = circle.around(permits).where(permit_side.condition()).select("parcel_identifier").distinct()
        properties = properties.join(near, "parcel_identifier", "left_semi")
    found = radius_properties(properties, circle, wanted, limit)
    counted = radius_count(properties, circle, wanted)
    if include_permits:
        found = with_permits(found, permits.where("is_roofing"), ["permit_number", "improvement_status", "days_open", "contractor_name", "bbb_rating"])
    return Leads(found, counted, limit_of(limit, 500))


def reordered(rows: DataFrame, column: str, *, descending: bool = True) -> DataFrame:
    """Rows of a result by another of its columns, nulls last either way; equal ones by all columns, so that pages agree."""
    if column not in rows.columns:
        raise ValueError(f"no column {column}")
    first = F.desc_nulls_last(column) if descending else F.asc_nulls_last(column)
    return rows.orderBy(first, *[F.asc_nulls_last(c) for c in rows.columns if c != column])


def resorted(rows: list[dict], column: str, *, descending: bool = True) -> list[dict]:
    """Rows a client has already, by another column: nulls last either way, equals as they were."""
    known = [r for r in rows if r.get(column) is not None]
    return [*sorted(known, key=lambda r: r[column], reverse=descending), *(r for r in rows if r.get(column) is None)]


def in_area(rows: DataFrame, *, box: Box | None = None, ring: Ring | None = None, limit: int | None = None) -> DataFrame:
    """Rows in a box or a polygon; one of the two."""
    if (box is None) == (ring is None):
        raise ValueError("give a box or a ring")
    test = in_box(box) if box else in_polygon(ring)
    return rows.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & test).orderBy("parcel_identifier").limit(limit_of(limit, 200))
