"""Requests as the search service takes them: checked bodies in, rows and what was asked out."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..contracts import describe
from ..functions.gazetteer import locate
from ..region import COUNTY, Box, Region
from . import guard, kpi, leads
from . import verify as verification

Body = dict[str, object]
# What an answer's rows are cited by, and the most rows of one.
CITED, MOST_ASKED = {"properties": ("request_identifier", "source_urls"), "permits": ("parcel_identifier", "source_url")}, 200


class BadRequest(ValueError):
    """A body that breaks a rule: status 400."""


def number(body: Body, name: str, low: float, high: float, *, required: bool = False, whole: bool = False) -> float | None:
    value = body.get(name)
    if value is None:
        if required:
            raise BadRequest(f"{name}: required")
        return None
    if isinstance(value, bool) or not isinstance(value, int | float) or (whole and int(value) != value) or not low <= value <= high:
        raise BadRequest(f"{name}: {'whole ' if whole else ''}number from {low} to {high}")
    return value


def flag(body: Body, name: str, default: bool = False) -> bool:
    value = body.get(name, default)
    if not isinstance(value, bool):
        raise BadRequest(f"{name}: true or false")
    return value


def circle_of(body: Body, region: Region = COUNTY) -> leads.Circle:
    """A circle of 0.1 to 15 miles around a point at most half a degree outside the region's box."""
    b = region.box
    lat = number(body, "lat", b.min_lat - 0.5, b.max_lat + 0.5, required=True)
    lng = number(body, "lng", b.min_lng - 0.5, b.max_lng + 0.5, required=True)
    return leads.Circle(lat, lng, number(body, "radiusMiles", 0.1, 15, required=True))


@dataclass
class Service:
    spark: SparkSession
    properties: DataFrame
    permits: DataFrame
    region: Region = COUNTY
    manifest: dict | None = None
    #: Gateways by the names that callers may use; nothing else is fetched from.
    gateways: dict[str, str] = field(default_factory=dict)
    open_url: verification.Open = verification.from_stores
    pace: dict[str, float] = field(default_factory=dict)

    def rows(self, df: DataFrame) -> list[dict]:
        """Rows of a limited result: every caller has put a limit of at most 1000 on it."""
        return [r.asDict(recursive=True) for r in df.collect()]

    def leads(self, body: Body) -> dict:
        types = body.get("propertyTypes") or []
        if not isinstance(types, list) or set(types) - set(leads.PROPERTY_TYPES):
            raise BadRequest("propertyTypes: known types")
        owner = body.get("ownerContains")
        if owner is not None and (not isinstance(owner, str) or len(owner) > leads.MOST_TERM):
            raise BadRequest(f"ownerContains: text of at most {leads.MOST_TERM} characters")
        wanted = leads.PropertyFilter(
            number(body, "minRoofAgeYears", 0, 150, whole=True), flag(body, "openRoofPermits"), number(body, "openRoofPermitMinYears", 0, 60), flag(body, "ownerOutOfState"),
            number(body, "minYearsSinceSale", 0, 120), tuple(types), owner,
        )
        limit = number(body, "limit", 1, 1000, whole=True)
        found = leads.radius_leads(self.properties, self.permits, circle_of(body, self.region), wanted, limit=limit)
        return {"properties": self.rows(found.properties), "total": found.total, "truncated": found.truncated}

    def open_permits(self, body: Body) -> dict:
        wanted = leads.PermitFilter(min_days_open=number(body, "minDaysOpen", 0, 10**6), require_contractor=flag(body, "requireContractor"))
        found = leads.radius_permits(self.permits, circle_of(body, self.region), wanted, number(body, "limit", 1, 1000, whole=True))
        return {"permits": self.rows(found), "ratings": kpi.rating_summary(found).first().asDict()}

    def property(self, body: Body) -> dict:
        try:
            parcel = leads.safe_id(str(body.get("parcelIdentifier", "")))
        except ValueError as e:
            raise BadRequest(str(e)) from None
        found = self.rows(leads.property_by_parcel(self.properties, parcel))
        return {"property": found[0] if found else None, "permits": self.rows(leads.permits_by_parcel(self.permits, parcel))}

    def query(self, body: Body) -> dict:
        if body.get("table") not in ("properties", "permits"):
            raise BadRequest("table: properties or permits")
        limit = int(number(body, "limit", 1, 1000, whole=True) or 100)
        try:
            found = guard.run_select(self.spark, str(body.get("sql", "")), {"properties": self.properties, "permits": self.permits}, limit)
        except ValueError as e:
            raise BadRequest(str(e)) from None
        rows = self.rows(found)
        return {"columns": found.columns, "rows": rows, "rowCount": len(rows), "truncated": len(rows) >= limit}

    def ask(self, body: Body) -> dict:
        """A statement over one table as the assistant puts it: at most ``MOST_ASKED`` rows, and which columns are missing to cite them by."""
        table = body.get("table")
        if table not in CITED:
            raise BadRequest(f"table: {' or '.join(CITED)}")
        limit = int(number(body, "limit", 1, MOST_ASKED, whole=True) or 100)
        try:
            found = guard.run_select(self.spark, str(body.get("sql", "")), {table: self.properties if table == "properties" else self.permits}, limit)
        except ValueError as e:
            raise BadRequest(str(e)) from None
        rows = self.rows(found)
        told = {"view": table, "rowCount": len(rows), "limit": limit, "truncated": len(rows) >= limit, "rows": rows, "missingCitationColumns": [c for c in CITED[table] if rows and c not in found.columns]}
        if table == "permits" and {"contractor_id", "contractor_name", "bbb_rating", "bbb_match_method"} <= set(found.columns):
            told["bbbSummary"] = kpi.rating_summary(self.spark.createDataFrame(rows, found.schema)).first()["sentence"]
        return told

    def verify(self, body: Body) -> dict:
        """Fetch the run's files from the gateways the service knows, all or those named in ``gateways``, and compare them with its manifest."""
        wanted = body.get("gateways") or list(self.gateways)
        if self.manifest is None or not isinstance(wanted, list) or set(wanted) - set(self.gateways) or not wanted:
            raise BadRequest(f"gateways: some of {', '.join(self.gateways) or 'none'}")
        only = body.get("only")
        if only is not None and not isinstance(only, list):
            raise BadRequest("only: a list of names")
        report = verification.verify(self.spark, self.manifest, [self.gateways[g] for g in wanted], self.open_url, only=only, **self.pace)
        return {"allMatched": report.all_matched, "minGateways": report.least, "probe": report.probe, "checks": self.rows(report.checks.drop("want_size", "want_digest"))}

    def schema(self, body: Body) -> dict:
        try:
            return {"columns": describe(str(body.get("table", "")))}
        except ValueError as e:
            raise BadRequest(str(e)) from None

    def geocode(self, body: Body) -> dict:
        found = locate(str(body.get("query", "")))
        return {"place": None if found is None else dict(zip(("name", "lat", "lng"), found, strict=True))}

    def area(self, body: Body) -> dict:
        limit = number(body, "limit", 1, 200, whole=True)
        if ring := body.get("polygon"):
            return {"properties": self.rows(leads.in_area(self.properties, ring=[(float(x), float(y)) for x, y in ring], limit=limit))}
        low, high = ((number(body, f"{m}Lat", -90, 90, required=True), number(body, f"{m}Lng", -180, 180, required=True)) for m in ("min", "max"))
        return {"properties": self.rows(leads.in_area(self.properties, box=Box(low[0], high[0], low[1], high[1]), limit=limit))}

    def handle(self, endpoint: str, body: Body) -> tuple[int, dict]:
        """(status, answer): 200, 400 for a bad body, 404 for no such endpoint, 500 for what Spark refuses."""
        calls: dict[str, Callable[[Body], dict]] = {n: getattr(self, n) for n in ("leads", "open_permits", "property", "query", "ask", "schema", "geocode", "area", "verify")}
        if endpoint not in calls:
            return 404, {"error": f"no endpoint {endpoint}"}
        began = time.monotonic()
        try:
            return 200, calls[endpoint](body) | {"ms": int(1000 * (time.monotonic() - began))}
        except BadRequest as e:
            return 400, {"error": str(e)}
        except Exception as e:
            return 500, {"error": str(e).split("\n")[0][:500]}
