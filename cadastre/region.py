"""What is specific to one region: names, box, anchors, thresholds, sources."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Box:
    min_lat: float
    max_lat: float
    min_lng: float
    max_lng: float


@dataclass(frozen=True)
class Source:
    key: str
    url: str
    cadence: str
    required: bool = False


@dataclass(frozen=True)
class Region:
    key: str
    name: str
    state: str
    fips: str
    box: Box
    anchors: dict[str, tuple[float, float]]
    sources: dict[str, Source] = field(default_factory=dict)
    roof_age_years: int = 15
    long_open_years: int = 5
    tenure_years: int = 10

    @property
    def appraiser(self) -> str:
        return f"{self.key}_appraiser"

    @property
    def portal(self) -> str:
        return f"{self.key}_accela"


# The county's published facts, which ids and labels in the results are made of.
COUNTY = Region(
    key="osceola",
    name="Osceola",
    state="FL",
    fips="12097",
    box=Box(27.55, 28.40, -81.70, -80.85),
    anchors={
        "Kissimmee": (28.2919, -81.4076),
        "St. Cloud": (28.2489, -81.2812),
        "Celebration": (28.3253, -81.5331),
        "Poinciana": (28.1403, -81.4587),
        "Harmony": (28.1922, -81.1503),
    },
    sources={
        "roll": Source("ocpa_certified", "https://www.property-appraiser.org/data/", "annual", required=True),
        "parcels": Source("osceola_gis_parcels", "https://services6.arcgis.com/9zKHLCgIwu2HFA5O/arcgis/rest/services/Parcels/FeatureServer/0", "weekly"),
        "portal": Source("osceola_accela", "https://permits.osceola.org/CitizenAccess/", "continuous"),
        "ratings": Source("bbb_roofing", "https://www.bbb.org/us/fl/kissimmee/category/roofing-contractors", "weekly"),
    },
)
