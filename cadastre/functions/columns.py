"""Cleaning and classifying functions over columns. All are built-in expressions; none runs Python a row.

Every function takes a Column or a column's name and gives a Column. Nulls give nulls
unless stated otherwise.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

Col = Column | str


def col(c: Col) -> Column:
    return F.col(c) if isinstance(c, str) else c


def regex(c: Col, pattern: str, to: str) -> Column:
    return F.regexp_replace(col(c), pattern, to)


# Text


def txt(c: Col) -> Column:
    """Trimmed of spaces; blank is null."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def clean_text(c: Col) -> Column:
    """White space of any kind collapsed to single spaces and trimmed; empty is null."""
    return F.nullif(F.trim(regex(c, r"[\s\x{00A0}]+", " ")), F.lit(""))


def strip_tags(c: Col) -> Column:
    """Text of an HTML fragment: tags dropped, the common entities decoded, white space collapsed."""
    out = F.replace(regex(c, r"<[^>]*>", ""), F.lit("&amp;"), F.lit("&"))
    out = F.regexp_replace(out, "&#39;|&apos;", "'")
    for entity, char in (("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return clean_text(out)


def label_key(c: Col) -> Column:
    """A label without its trailing colon."""
    return clean_text(regex(clean_text(c), r"\s*:\s*$", ""))


def slug_title(c: Col) -> Column:
    """``roof-repair`` to ``Roof Repair``; only first letters change."""
    words = F.filter(F.split(col(c), "[-_]+"), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), " ")


# Numbers and dates

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def num(c: Col) -> Column:
    """A double, or null where the trimmed text is not one."""
    t = txt(c)
    return F.when(t.rlike(_NUMBER), t.try_cast("double"))


def lenient_int(c: Col) -> Column:
    """A long from text, fractions rounded half away from zero."""
    return F.round(num(c)).try_cast("bigint")


def year_of(c: Col, run_date: date) -> Column:
    """A year between 1700 and the run's next one, else null."""
    y = lenient_int(c)
    return F.when(y.between(1700, run_date.year + 1), y)


def source_date(c: Col) -> Column:
    """Date in the first ten characters; placeholders up to 1900-01-01 are null."""
    head = F.substring(txt(c), 1, 10)
    d = F.when(head.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), head.try_cast("date"))
    return F.when(d > F.lit(date(1900, 1, 1)), d)


def iso_date(c: Col) -> Column:
    """``M/D/YYYY`` at the start of a text as ``YYYY-MM-DD``, unchecked; else null."""
    t = clean_text(c)
    part = lambda k: F.regexp_extract(t, r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})", k)
    return F.when(part(3) != "", F.concat_ws("-", part(3), F.lpad(part(1), 2, "0"), F.lpad(part(2), 2, "0")))


def portal_date(c: Col) -> Column:
    """``YYYY-MM-DD`` as ``MM/DD/YYYY``; any other text is null."""
    c = col(c)
    return F.when(c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.regexp_replace(c, r"^(\d{4})-(\d{2})-(\d{2})$", "$2/$3/$1"))


def money(c: Col) -> Column:
    return num(regex(c, r"[$,\s]", ""))


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("long")


def years_since(day: Column, run_date: date, digits: int = 2) -> Column:
    return F.round(days_between(day, F.lit(run_date)).cast("double") / F.lit(365.25), digits)


def epoch_date(c: Col) -> Column:
    """Milliseconds since 1970 as an ISO date text, in UTC."""
    return F.date_format(F.timestamp_millis(col(c)), "yyyy-MM-dd")


def run_id_to_iso(c: Col) -> Column:
    """``2026-09-07T12-33-03Z-full`` as ``2026-09-07T12:33:03Z``; other texts are null."""
    c = col(c)
    pattern = r"^(\d{4}-\d{2}-\d{2}T\d{2})-(\d{2})-(\d{2})Z.*$"
    return F.when(c.rlike(pattern), F.regexp_replace(c, pattern, "$1:$2:$3Z"))


# Keys and identities


def alnum(c: Col) -> Column:
    """Upper case, letters and digits only; null is empty."""
    return F.upper(F.regexp_replace(F.coalesce(col(c), F.lit("")), "[^A-Za-z0-9]", ""))


parcel_key = alnum


def parcel_number(c: Col) -> Column:
    return F.nullif(alnum(c), F.lit(""))


def phone10(c: Col) -> Column:
    """Ten digits, without a leading country code 1; else null."""
    d = F.regexp_replace(F.coalesce(col(c), F.lit("")), "[^0-9]", "")
    return F.when(F.length(d) == 10, d).when((F.length(d) == 11) & d.startswith("1"), F.right(d, F.lit(10)))


# Corporate words that say nothing about which business it is.
CORPORATE = "LLC|L L C|INC|INCORPORATED|CORP|CORPORATION|CO|COMPANY|LTD|LP|PLLC|PA|SERVICES?|CONSTRUCTION|CONTRACTORS?|CONTRACTING|ROOFING|ENTERPRISES?|GROUP|OF FLORIDA|FL|FLORIDA|THE|AND"


def normalized_name(c: Col) -> Column:
    plain = F.regexp_replace(F.upper(F.coalesce(col(c), F.lit(""))), "[^A-Z0-9 ]", " ")
    return F.nullif(F.trim(F.regexp_replace(F.regexp_replace(plain, rf"\b({CORPORATE})\b", " "), " +", " ")), F.lit(""))


def business_part(c: Col) -> Column:
    """Of ``PERSON - BUSINESS`` the business; else the whole text."""
    c = col(c)
    at = F.locate(" - ", c)
    return F.when(at > 0, txt(F.substr(c, at + 3))).otherwise(txt(c))


def person_part(c: Col) -> Column:
    c = col(c)
    at = F.locate(" - ", c)
    return F.when(at > 0, txt(F.substr(c, F.lit(1), at - 1)))


def license_number(c: Col) -> Column:
    """Upper case without label and separators; four to twenty characters with a digit, else null."""
    bare = F.regexp_replace(F.trim(F.upper(col(c))), r"^(?:LICENSE|LIC|NO|NUMBER|#|\.|:|\s)+", "")
    key = F.regexp_replace(bare, r"[\s\-.#/]", "")
    return F.when(key.rlike("^[A-Z0-9]{4,20}$") & key.rlike("[0-9]"), key)


def license_numbers(c: Col) -> Column:
    """All numbers of two to four letters and five to eight digits in a text, first mentions in order."""
    found = F.regexp_extract_all(F.upper(F.coalesce(col(c), F.lit(""))), F.lit(r"\b([A-Z]{2,4})\s?[-.]?\s?(\d{5,8})\b"), F.lit(0))
    return F.array_distinct(F.filter(F.transform(found, license_number), lambda x: x.isNotNull()))


def merged_unique(*arrays: Col) -> Column:
    """Elements of all arrays, first mentions in order; nulls and null arrays are left out."""
    empty = F.array().cast("array<string>")
    return F.array_distinct(F.filter(F.flatten(F.array(*[F.coalesce(col(a), empty) for a in arrays])), lambda x: x.isNotNull()))


# The grades that exist.
GRADES = ("A+", "A", "A-", "B+", "B", "B-", "C+", "C", "C-", "D+", "D", "D-", "F")


def rating(c: Col) -> Column:
    r = F.upper(F.regexp_replace(F.coalesce(col(c), F.lit("")), r"\s", ""))
    return F.when(r.isin(*GRADES), r)


def profile_id(c: Col) -> Column:
    """``bureau-business`` from the last part of a profile URL; else null."""
    segment = F.regexp_extract(col(c), r"/profile/[^/?#]+/([^/?#]+)", 1)
    return F.nullif(F.regexp_extract(segment, r"-([0-9]{3,4}-[0-9]{4,})$", 1), F.lit(""))


def canonical_url(c: Col) -> Column:
    """Without query, fragment and trailing slash."""
    return F.regexp_replace(F.regexp_replace(col(c), r"[?#].*$", ""), r"/+$", "")


def split_urls(c: Col) -> Column:
    """Distinct trimmed parts of a ``|`` separated text, in order."""
    parts = F.transform(F.split(F.coalesce(col(c), F.lit("")), r"\|"), lambda x: F.trim(x))
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def surrogate_key(*parts: Col) -> Column:
    """First 32 hex digits of the sha256 of the parts joined by ``:``; null parts are empty."""
    return F.substring(F.sha2(F.concat_ws(":", *[F.coalesce(col(p).cast("string"), F.lit("")) for p in parts]), 256), 1, 32)


def row_hash(columns: list[str], doubles: frozenset[str] | set[str] = frozenset()) -> Column:
    """sha256 over columns joined by ``|``, nulls empty. Doubles are written with six decimals, alike in any engine."""
    texts = [F.format_string("%.6f", F.col(c)) if c in doubles else F.col(c).cast("string") for c in columns]
    texts = [F.when(F.col(c).isNotNull(), t).otherwise("") for c, t in zip(columns, texts, strict=True)]
    return F.sha2(F.concat_ws("|", *texts), 256)


# Classifiers. Codes and words of the permit feeds.

ROOF_CODES = ("RR", "RF", "ROOF", "REROOF", "RE-ROOF", "ROOFING")
ROOF_WORDS = r"(re-?\s?roof|\broof(ing)?\b|shingle|tile roof|metal roof)"
NOT_ROOF_WORDS = r"(screen|enclosure|lanai|pergola|carport|solar|\bpv\b|roof[- ]?mount|antenna|awning|\bsign\b|hvac|a/c|rooftop unit|\brtu\b)"
BUCKETS = {
    "Screen enclosure": ("SCRR", "SE", "SR"),
    "Pool": ("PO", "SPA"),
    "Fence": ("FE", "FEC"),
    "New construction": ("SF", "SFR", "TH", "CND", "DPLX", "BP", "CMNC", "MHBD", "MBHD"),
    "Addition / alteration": ("RADD", "RALT", "CMAL", "CMAD", "CALT", "TBO", "NA", "REPR"),
    "Demolition": ("DM",),
}
AGENCIES = {"C": "Osceola County", "K": "City of Kissimmee", "S": "City of St. Cloud"}
FINAL_WORDS = "(final|closed|complete|c/o issued|co issued)"
VOID_WORDS = "(void|cancel|withdrawn|denied|revoked)"
TRADE_WORDS = "(roof|contractor|construction|home_improvement|remodel|building_supply|handyman|siding|gutter|solar)"
USE_CLASSES = (("residential", "RES", "00", "09"), ("commercial", "COM", "10", "39"), ("industrial", "IND", "40", "49"), ("agricultural", "AGR", "50", "69"), ("institutional", None, "70", "79"), ("government", None, "80", "89"))


def lowered(c: Col) -> Column:
    return F.lower(F.coalesce(col(c), F.lit("")))


def is_roofing(kind: Col, description: Col) -> Column:
    text = lowered(description)
    by_text = text.rlike(ROOF_WORDS) & ~text.rlike(NOT_ROOF_WORDS)
    return F.upper(F.trim(F.coalesce(col(kind), F.lit("")))).isin(*ROOF_CODES) | lowered(kind).contains("roof") | by_text


def improvement_type(roofing: Column, kind: Col) -> Column:
    code = F.upper(F.coalesce(col(kind), F.lit("")))
    out = F.when(roofing, "Roofing")
    for bucket, codes in BUCKETS.items():
        out = out.when(code.isin(*codes), bucket)
    return out.otherwise("Other")


def agency(c: Col) -> Column:
    code, out = F.upper(F.trim(F.coalesce(col(c), F.lit("")))), F.lit(None).cast("string")
    for k, label in AGENCIES.items():
        out = F.when(code == k, label).otherwise(out)
    return out


def roll_status(code: Col, done: Column, cancelled: Column) -> Column:
    """Status of a permit of the roll: by its code, else by which dates it has."""
    k = F.upper(F.trim(F.coalesce(col(code), F.lit(""))))
    return F.when(k == "C", "finaled").when(k == "V", "voided").when(k.isin("P", "A", "O"), "open").when(done.isNotNull(), "finaled").when(cancelled.isNotNull(), "voided").otherwise("open")


def portal_status(status: Col, finaled: Column, closed: Column) -> Column:
    """Status of a permit of the portal: by words, else by which dates it has."""
    s = lowered(status)
    return F.when(s.rlike(FINAL_WORDS), "finaled").when(s.rlike(VOID_WORDS), "voided").when(s.rlike("expired"), "expired").when(finaled.isNotNull() | closed.isNotNull(), "finaled").otherwise("open")


def use_class(department: Col, code: Col) -> Column:
    head, out = F.substring(col(code), 1, 2), None
    for name, dept, low, high in USE_CLASSES:
        test = F.coalesce(head.between(low, high), F.lit(False))
        if dept:
            test = test | F.coalesce(col(department) == dept, F.lit(False))
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise("other")


def is_trade(taxonomy: Col) -> Column:
    return lowered(taxonomy).rlike(TRADE_WORDS)


def http_class(status: Col) -> Column:
    s = col(status)
    return F.when(s.between(200, 299), "ok").when((s >= 500) | s.isin(429, 408), "transient").otherwise("permanent")


def media_type(name: Col) -> Column:
    n, out = lowered(name), F.lit("application/octet-stream")
    for end, kind in (("json", "application/json"), ("jsonl", "application/x-ndjson"), ("csv", "text/csv"), ("parquet", "application/vnd.apache.parquet"), ("md", "text/markdown")):
        out = F.when(n.endswith(f".{end}"), kind).otherwise(out)
    return out


def is_cid(c: Col) -> Column:
    """Whether a text has the form of a base32 version-1 content id."""
    return F.coalesce(col(c).rlike("^baf[a-z2-7]{50,}$"), F.lit(False))


# Results of other engines, and addresses


def coerced_number(c: Col) -> Column:
    """A finite number, or a text that is a plain decimal one; null for anything else."""
    c = F.col(c) if isinstance(c, str) else c
    text = c.cast("string")
    return F.when(text.rlike(r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"), text.try_cast("double"))


def coerced_flag(c: Col) -> Column:
    """True or false from themselves or from their small-letter names; null for anything else."""
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.when(text == "true", True).when(text == "false", False)


def coerced_text(c: Col) -> Column:
    """The text of any value, whole numbers without loss."""
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def json_text(c: Col, path: str) -> Column:
    """A text or number in JSON as trimmed text; null where the path leads nowhere, to null, or to an object or list."""
    found = F.get_json_object(c, path)
    return F.when(~found.rlike(r"^\s*[\[{]"), F.nullif(F.trim(found), F.lit("")))


def json_number(c: Col, path: str) -> Column:
    return coerced_number(json_text(c, path))


def url_host(c: Col) -> Column:
    """The host of an address, null if it has none."""
    return F.try_parse_url(c, F.lit("HOST"))


def url_value(c: Col, name: str) -> Column:
    """The value of one name in an address's query, null without one."""
    return F.nullif(F.try_parse_url(c, F.lit("QUERY"), F.lit(name)), F.lit(""))
