"""The walk over the ratings site: cities by categories by orders by pages, then profiles."""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from . import html


@dataclass
class Walk:
    listings: list[dict] = field(default_factory=list)
    profiles: list[dict] = field(default_factory=list)
    failures: list[dict] = field(default_factory=list)
    summary: dict = field(default_factory=dict)


def walk(page: Callable[[str], str], cities: Iterable[str], categories: Iterable[str], *, sorts: Iterable[str] = ("relevance",), url: Callable[[str, str, str, int], str], state: str | None = None, done: Iterable[str] = (), most_pages: int = 50) -> Walk:
    """Listings of every search (with where they were found), and profiles of businesses met for the first time.

    ``page(url)`` gives a page or raises OSError, which is recorded. Businesses in ``done``, or of
    another state, are listed and not fetched.
    """
    out, first, skipped = Walk(), {}, Counter()
    pages = 0
    for city, category, sort in itertools.product(cities, categories, sorts):
        for number in range(1, most_pages + 1):
            address = url(city, category, sort, number)
            try:
                listing = html.parse_listing(page(address))
            except OSError as e:
                out.failures.append({"kind": "listing", "url": address, "message": str(e)})
                break
            pages += 1
            for row in listing["results"]:
                out.listings.append({"searchCity": city, "searchCategory": category, "sort": sort, "page": number, **row})
                first.setdefault(row["bbbId"], row)
            if not listing["hasNext"]:
                break
    known = set(done)
    for key, row in first.items():
        if key in known:
            skipped["existing"] += 1
        elif state and row.get("state") and row["state"] != state:
            skipped["state"] += 1
        else:
            try:
                profile = html.parse_profile(page(row["profileUrl"]), row["profileUrl"])
            except (OSError, ValueError) as e:
                out.failures.append({"kind": "profile", "bbbId": key, "url": row["profileUrl"], "message": str(e)})
                continue
            # The numeric score is shown on listings only.
            out.profiles.append(profile | {"ratingScore": row.get("ratingScore")})
    out.summary = {
        "pagesFetched": pages, "profilesListed": len(first), "profilesFetched": len(out.profiles), "profilesFailed": sum(f["kind"] == "profile" for f in out.failures),
        "listingFailures": sum(f["kind"] == "listing" for f in out.failures), "profilesSkippedExisting": skipped["existing"], "profilesSkippedState": skipped["state"],
        "ratingDistribution": dict(Counter(p["rating"] or "none" for p in out.profiles)), "withLicense": sum(bool(p["licenseNumbers"]) for p in out.profiles), "withPhone": sum(bool(p["phone"]) for p in out.profiles),
    }
    return out
