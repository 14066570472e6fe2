"""Contractors: one entity for the many ways permits name them, and their ratings.

A permit is identified by its licence, else its phone, else its normalised name. A phone or
name that belongs to exactly one licence stands for it, and a name of unlicensed permits that
belongs to exactly one phone for that phone. That is one step and no more, so that
``identity_basis`` always says why two permits are one contractor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..contracts import CONTRACTORS, conform
from ..functions import columns as c
from ..storage import stored

#: What of a permit names its contractor, and what else the roll-up tells apart.
NAMED = ["contractor_license", "contractor_phone", "contractor_name_norm"]
TOLD = [*NAMED, "contractor_name", "source_system"]


def ways(staged: DataFrame) -> DataFrame:
    """Stored: each distinct way in which permits name a contractor (``TOLD``), and what its permits add up to.

    Ways are few beside permits, and counts, days and keys alone are hashed where they lie, so no permit is
    sorted or shuffled for its contractor.
    """
    roof, day = F.col("is_roofing"), F.coalesce("permit_issue_date", "opened_date")
    found = staged.where(F.coalesce(*NAMED).isNotNull()).groupBy(*TOLD).agg(
        F.count("*").alias("n"), F.count_if(roof).alias("roofing"), F.count_if(roof & F.col("is_open")).alias("open_roofing"), F.min(day).alias("first_day"), F.max(day).alias("last_day")
    )
    return stored(found, "ways")


def unambiguous(pairs: DataFrame) -> DataFrame:
    """(alias_key, canonical_key) of aliases with one canonical key."""
    grouped = pairs.where("alias_key IS NOT NULL").groupBy("alias_key")
    return grouped.agg(F.min("canonical_key").alias("canonical_key"), F.max("canonical_key").alias("__max")).where("canonical_key = __max").drop("__max")


def aliases(rows: DataFrame) -> DataFrame:
    """(alias_key, canonical_key) that ``rows`` (permits or their ways) show. Distinct names decide, so these are stored once and read four times."""
    staged = stored(rows.select(*NAMED).distinct(), "named")
    license_key, phone_key, name_key = F.concat(F.lit("lic:"), "contractor_license"), F.concat(F.lit("tel:"), "contractor_phone"), F.concat(F.lit("name:"), "contractor_name_norm")
    licensed = staged.where("contractor_license IS NOT NULL")
    by_phone = unambiguous(licensed.select(phone_key.alias("alias_key"), license_key.alias("canonical_key")))
    by_name = unambiguous(licensed.select(name_key.alias("alias_key"), license_key.alias("canonical_key")))
    unlicensed = staged.where("contractor_license IS NULL AND contractor_phone IS NOT NULL")
    to_phone = unambiguous(unlicensed.select(name_key.alias("alias_key"), phone_key.alias("canonical_key")))
    return by_phone.union(by_name).union(to_phone.join(by_name, "alias_key", "left_anti"))


LINK = ["property_improvement_id", "identity_basis", "identity_key", "canonical_key", "contractor_id"]


def linked(rows: DataFrame, alias: DataFrame) -> DataFrame:
    """``rows`` with identity_basis, identity_key, canonical_key and contractor_id, null where no contractor is named.

    A stored ``alias`` has a known size, so that a small one is broadcast and rows stay where they are.
    """
    basis = F.when(F.col("contractor_license").isNotNull(), "license").when(F.col("contractor_phone").isNotNull(), "phone").when(F.col("contractor_name_norm").isNotNull(), "name")
    key = F.coalesce(F.concat(F.lit("lic:"), "contractor_license"), F.concat(F.lit("tel:"), "contractor_phone"), F.concat(F.lit("name:"), "contractor_name_norm"))
    folded = rows.withColumns({"identity_basis": basis, "identity_key": key}).join(alias.withColumnRenamed("alias_key", "identity_key"), "identity_key", "left")
    own = F.coalesce("canonical_key", "identity_key")
    return folded.withColumns({"canonical_key": own, "contractor_id": F.substring(F.sha2(own, 256), 1, 32)})


def links(rows: DataFrame) -> DataFrame:
    """``rows`` (permits or their ways) that name a contractor at all, the columns of ``LINK`` first."""
    found = linked(rows, stored(aliases(rows), "aliases")).where("identity_key IS NOT NULL")
    return found.select(*[n for n in LINK if n in found.columns], *[n for n in found.columns if n not in LINK])


def most_frequent(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value): the value of most rows, the smallest among equals. Counts are combined before they are ranked."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("__n"))
    first = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("__n"), value))
    return counts.withColumn("__rank", first).where("__rank = 1").select(key, value)


def roll_up(rows: DataFrame) -> DataFrame:
    """One row an entity of ``rows`` (links of ``ways``), before ratings. Its name is the one of most permits, the smallest among equals."""
    basis = F.when(F.col("canonical_key").startswith("lic:"), "license").when(F.col("canonical_key").startswith("tel:"), "phone").otherwise("name")
    key = ["contractor_id", "canonical_key"]
    by_name = rows.groupBy(*key, "contractor_name").agg(
        F.max("contractor_license").alias("license_number"),
        F.max("contractor_phone").alias("phone"),
        F.sum("n").alias("n"),
        F.sum("roofing").alias("roofing"),
        F.sum("open_roofing").alias("open_roofing"),
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
        F.collect_set("source_system").alias("sources"),
    )
    out = by_name.groupBy(*key).agg(
        F.max("license_number").alias("license_number"),
        F.max("phone").alias("phone"),
        F.sum("n").cast("int").alias("permit_count"),
        F.sum("roofing").cast("int").alias("roofing_permit_count"),
        F.sum("open_roofing").cast("int").alias("open_roofing_permit_count"),
        F.min("first_day").cast("string").alias("first_permit_date"),
        F.max("last_day").cast("string").alias("last_permit_date"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("sources")))), " | ").alias("source_systems"),
        F.min(F.when(F.col("contractor_name").isNotNull(), F.struct((-F.col("n")).alias("less"), F.col("contractor_name").alias("name"))))["name"].alias("display_name"),
    )
    return out.withColumns({"normalized_name": c.normalized_name("display_name"), "identity_basis": basis}).drop("canonical_key")


def match_ratings(entities: DataFrame, profiles: DataFrame, *, match_unlicensed: bool = False) -> DataFrame:
    """(contractor_id, bbb_id, ..., bbb_match_method): by licence, else phone, else unique name.

    Profiles are exploded by licence number, so that one without any cannot match at all;
    ``match_unlicensed`` lets it match by phone and name.
    """
    unnest = F.explode_outer if match_unlicensed else F.explode
    listed = profiles.select("bbb_id", c.phone10("phone").alias("phone"), c.normalized_name("name").alias("normalized_name"), unnest("license_numbers").alias("license_number"))
    best = F.min("bbb_id")
    number = F.upper(F.regexp_replace("license_number", "[^A-Za-z0-9]", ""))
    by_license = listed.where("license_number IS NOT NULL").groupBy(number.alias("license_number")).agg(best.alias("__l"))
    by_phone = listed.where("phone IS NOT NULL").groupBy("phone").agg(best.alias("__t"))
    by_name = listed.where("normalized_name IS NOT NULL").groupBy("normalized_name").agg(best.alias("__n"), F.max("bbb_id").alias("__x")).where("__n = __x").drop("__x")
    found = entities.select("contractor_id", "license_number", "phone", "normalized_name").join(by_license, "license_number", "left").join(by_phone, "phone", "left").join(by_name, "normalized_name", "left")
    method = F.when(F.col("__l").isNotNull(), "license").when(F.col("__t").isNotNull(), "phone").when(F.col("__n").isNotNull(), "name")
    chosen = found.select("contractor_id", F.coalesce("__l", "__t", "__n").alias("bbb_id"), method.alias("bbb_match_method")).where("bbb_id IS NOT NULL")
    facts = profiles.select("bbb_id", *[F.col(n).alias(f"bbb_{n}") for n in ("rating", "accredited", "review_count", "complaint_count", "profile_url")])
    return chosen.join(facts, "bbb_id")


def publish(entities: DataFrame, ratings: DataFrame | None) -> DataFrame:
    return conform(entities if ratings is None else entities.join(ratings, "contractor_id", "left"), CONTRACTORS)
