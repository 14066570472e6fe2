"""Places: businesses with coordinates, linked to contractors by phone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import PLACES, conform
from ..functions import columns as c
from ..functions.geo import Ring, clip
from ..storage import Folder

#: Datasets whose licence keeps them out.
EXCLUDED_DATASETS = ("openstreetmap", "osm")


def licensed(places: DataFrame) -> DataFrame:
    """Rows none of whose datasets is excluded; a null dataset name excludes nothing."""
    names = F.transform(F.coalesce("source_datasets", F.array().cast("array<string>")), F.lower)
    return places.where(~F.coalesce(F.arrays_overlap(names, F.array(*map(F.lit, EXCLUDED_DATASETS))), F.lit(False)))


def extract(raw: DataFrame, ring: Ring, release: str, fips: str) -> DataFrame:
    """Rows of the upstream schema inside a polygon, in the extract's own."""
    lat, lng = F.col("bbox.ymin").cast("double"), F.col("bbox.xmin").cast("double")
    inside = clip(raw.withColumns({"latitude": lat, "longitude": lng}), ring)
    address = F.get("addresses", F.lit(0))
    return inside.select(
        F.col("id").alias("gers_id"),
        F.lit(release).alias("overture_version"),
        F.col("names.primary").alias("name_primary"),
        F.col("taxonomy.primary").alias("taxonomy_primary"),
        F.array_join("taxonomy.hierarchy", "/").alias("taxonomy_hierarchy"),
        F.col("taxonomy.alternates").alias("taxonomy_alternates"),
        "basic_category",
        "operating_status",
        "confidence",
        "websites",
        "phones",
        "emails",
        F.col("brand.names.primary").alias("brand_name"),
        address["freeform"].alias("address_freeform"),
        address["locality"].alias("address_locality"),
        address["postcode"].alias("address_postcode"),
        address["region"].alias("address_region"),
        F.transform("sources", lambda s: s["dataset"]).alias("source_datasets"),
        "longitude",
        "latitude",
        F.lit(release).alias("overture_release"),
        F.lit(fips).alias("county_fips"),
        "in_bbox",
    )


def read_release(spark: SparkSession, root: str, release: str, ring: Ring) -> DataFrame:
    """Places of a release in ``root/release=R/theme=places/type=place``, those in the polygon's box alone.

    Theme and type are folders, and the box is four comparisons with columns that row groups have
    statistics of, so other themes are not listed and other row groups not read.
    """
    lats, lngs = [lat for _, lat in ring], [lng for lng, _ in ring]
    x, y = F.col("bbox.xmin"), F.col("bbox.ymin")
    rows = spark.read.option("basePath", f"{root}/release={release}").parquet(f"{root}/release={release}/theme=places/type=place")
    return rows.where((x >= float(min(lngs))) & (x <= float(max(lngs))) & (y >= float(min(lats))) & (y <= float(max(lats))))


def cached_extract(spark: SparkSession, root: str, release: str, ring: Ring, fips: str, cache: str) -> DataFrame:
    """The extract of a release, read from ``cache/R`` if it is complete there, else made and written first."""
    folder = Folder(spark, cache)
    if not folder.exists(release, "_SUCCESS"):
        found = extract(read_release(spark, root, release, ring), ring, release, fips)
        found.write.mode("overwrite").option("compression", "zstd").parquet(folder.at(release))
    return spark.read.parquet(folder.at(release))


def publish(raw: DataFrame, contractors: DataFrame | None) -> DataFrame:
    """The published places. Only places of the trade link, to the smallest contractor id of their phone."""
    rows = raw.withColumns(
        {
            "place_id": F.col("gers_id"),
            "name": F.col("name_primary"),
            "is_contractor": c.is_trade("taxonomy_hierarchy"),
            "phone": c.phone10(F.get("phones", F.lit(0))),
            "website": F.get("websites", F.lit(0)),
            "address_street": F.col("address_freeform"),
            "address_city": F.col("address_locality"),
            "address_zip": F.col("address_postcode"),
            "source_datasets": F.array_join("source_datasets", "|"),
            "source_url": F.concat(F.lit("https://stac.overturemaps.org/"), "overture_release", F.lit("/catalog.json")),
            "fetched_at": F.col("fetched_at").cast("string"),
        }
    )
    if contractors is not None:
        by_phone = contractors.where("phone IS NOT NULL").groupBy(F.col("phone").alias("__phone")).agg(F.min("contractor_id").alias("contractor_id"))
        rows = rows.join(by_phone, (F.col("phone") == F.col("__phone")) & F.col("is_contractor"), "left").drop("__phone")
    return conform(rows, PLACES)
