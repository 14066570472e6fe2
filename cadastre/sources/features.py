"""The county's feature service over HTTP: counts and pages of parcels, and their sweep into raw records."""

from __future__ import annotations

import json
from urllib.parse import urlencode
from urllib.request import Request, urlopen

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming import pages
from . import harvests

# Fields that are asked for, the order they are asked in, and what they are called here.
FIELDS = {
    "OBJECTID_1": "OBJECTID long", "PARCELNO": "ParcelNo string", "Dsp_strap": "DisplayStrap string", "YearBuilt": "YearBuilt int", "DORCode": "DORCode string",
    "LocCity": "LocCity string", "LocZip": "LocZip string", "LastUpdate": "LastUpdate long", "TotalAcres": "TotalAcres double",
}
SCHEMA = ", ".join([*FIELDS.values(), "x double", "y double"])
TIMEOUT_S = 60


def typed(value: object, kind: str) -> object:
    """A value of a field's type, null for anything else."""
    if value is None or isinstance(value, bool | list | dict):
        return None
    if kind == "string":
        return str(value)
    if isinstance(value, str):
        return None
    return float(value) if kind == "double" else int(value)


class Service:
    """``url``: of the layer, without the query. An answer with an error in it is a failed request, which the source tries again."""

    def __init__(self, url: str):
        self.url = url.rstrip("/")

    def ask(self, **wanted: object) -> dict:
        with urlopen(Request(f"{self.url}/query?{urlencode(wanted | {'f': 'json'})}"), timeout=TIMEOUT_S) as answer:
            body = json.loads(answer.read())
        if body.get("error"):
            raise OSError(f"the service says {body['error']}")
        return body

    def condition(self, since: object) -> str:
        return f"LastUpdate >= DATE '{since}'" if since else "1=1"

    def total(self, since: object) -> int:
        return int(self.ask(where=self.condition(since), returnCountOnly="true").get("count") or 0)

    def fetch(self, offset: int, size: int, since: object) -> list[tuple]:
        body = self.ask(
            where=self.condition(since), outFields=",".join(FIELDS), returnGeometry="false", returnCentroid="true", outSR="4326", orderByFields="OBJECTID_1", resultOffset=offset, resultRecordCount=size
        )
        kinds = [k.split()[1] for k in FIELDS.values()]
        out = []
        for feature in body.get("features") or []:
            at = feature.get("centroid") or {}
            out.append((*(typed(feature["attributes"].get(n), k) for n, k in zip(FIELDS, kinds, strict=True)), typed(at.get("x"), "double"), typed(at.get("y"), "double")))
        return out


def sweep(spark: SparkSession, url: str, out: str, *, run_id: str, run_year: int, fetched_at: str, since: str | None = None, **how) -> DataFrame:
    """Raw parcels of the service, all or those changed since a day. A sweep of the same run goes on where it stopped."""
    service, name = Service(url), f"features_{abs(hash((url, run_id)))}"
    spark.dataSource.register(pages.page_stream(name, SCHEMA, service.fetch, service.total, **how))
    found = pages.sweep(spark, name, f"{out}/sweeps/{run_id}/rows", f"{out}/sweeps/{run_id}/log", since=since)
    return harvests.parcels(harvests.features(found, run_year).withColumn("fetchedAt", F.lit(fetched_at)))
