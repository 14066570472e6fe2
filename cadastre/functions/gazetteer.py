"""Place names to coordinates."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..region import COUNTY

# Places of the county beyond its anchors, and other names for them.
MORE = {
    "Buenaventura Lakes": (28.3358, -81.3531),
    "Four Corners": (28.3328, -81.6473),
    "Campbell": (28.2589, -81.4562),
    "Intercession City": (28.2617, -81.5081),
    "Narcoossee": (28.2908, -81.2047),
    "Holopaw": (28.1364, -81.0778),
    "Kenansville": (27.8778, -81.0417),
    "Yeehaw Junction": (27.7003, -80.9042),
    "Reunion": (28.2725, -81.6086),
    "Osceola County (centroid)": (28.06, -81.15),
}
ALIASES = {"saint cloud": "St. Cloud", "st cloud": "St. Cloud", "bvl": "Buenaventura Lakes", "campbell city": "Campbell", "osceola": "Osceola County (centroid)", "osceola county": "Osceola County (centroid)"}
PLACES = COUNTY.anchors | MORE


def plain(name: str) -> str:
    return " ".join(re.sub(r"[^a-z0-9 ]+", " ", re.sub(r"\bsaint\b", "st", name.lower())).split())


def locate(query: str) -> tuple[str, float, float] | None:
    """(name, latitude, longitude): exact or other name, else the first place that either begins the other."""
    wanted = plain(re.sub(r",?\s*(fl|florida)\b", "", query, flags=re.IGNORECASE))
    if not wanted:
        return None
    other = {plain(a): n for a, n in ALIASES.items()} | {plain(n): n for n in PLACES}
    name = other.get(wanted) or next((n for n in PLACES if plain(n).startswith(wanted) or wanted.startswith(plain(n))), None)
    return None if name is None else (name, *PLACES[name])


def locate_all(spark: SparkSession, rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with place, place_lat and place_lng by the same rules, as one join with the small gazetteer."""
    names = [(rank, n, plain(k), *PLACES[n]) for rank, (k, n) in enumerate([*((n, n) for n in PLACES), *ALIASES.items()])]
    known = F.broadcast(spark.createDataFrame(names, "rank int, place string, known string, place_lat double, place_lng double"))
    text = F.regexp_replace(F.lower(F.regexp_replace(column, r"(?i),?\s*(fl|florida)\b", "")), r"\bsaint\b", "st")
    wanted = F.trim(F.regexp_replace(F.regexp_replace(text, "[^a-z0-9 ]+", " "), " +", " "))
    keyed = rows.withColumns({"__id": F.monotonically_increasing_id(), "__wanted": wanted})
    prefix = (F.col("rank") < len(PLACES)) & (F.startswith("known", "__wanted") | F.startswith("__wanted", "known"))
    joined = keyed.join(known, (F.col("__wanted") != "") & ((F.col("known") == F.col("__wanted")) | prefix), "left")
    first = F.row_number().over(Window.partitionBy("__id").orderBy((F.col("known") == F.col("__wanted")).desc_nulls_last(), "rank"))
    return joined.withColumn("__n", first).where("__n = 1").drop("__id", "__wanted", "__n", "rank", "known")
