"""Properties: the roll's many files in one row a parcel, then what permits say about each."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import PROPERTIES, PROPERTY_HASHED, conform
from ..functions import columns as c
from ..region import COUNTY, Region
from .lineage import carry_lineage
from .upsert import latest, marked

SQFT_PER_ACRE = 43560.0


def in_order(value: Column, key: Column) -> Column:
    """Values joined by `` | `` in ascending ``key``, nulls last, equals by value."""
    rows = F.array_sort(F.collect_list(F.struct(key.isNull().alias("n"), key.alias("k"), value.alias("v"))))
    return F.array_join(F.transform(rows, lambda r: r["v"]), " | ")


def latest_known(value: Column, key: Column) -> Column:
    """The value at the largest key among rows that have both; the larger value among equals."""
    both = value.isNotNull() & key.isNotNull()
    return F.max(F.when(both, F.struct(key.alias("k"), value.alias("v"))))["v"]


def first_known(value: Column, key: Column) -> Column:
    both = value.isNotNull() & key.isNotNull()
    return F.min(F.when(both, F.struct(key.alias("k"), value.alias("v"))))["v"]


def base(raw: dict[str, DataFrame], run_date: date, parcels: DataFrame | None = None, region: Region = COUNTY) -> DataFrame:
    """One row a parcel of the roll. ``raw``: parcel, site, owner, mail, building, detail, sales, lu_dor, lu_sub.

    Every side is brought to one row a parcel before it is joined. Lookups keep their duplicates.
    """
    strap, line = c.parcel_key("strap").alias("strap"), c.lenient_int("ln_num")
    zip5 = F.substring(c.txt("zip"), 1, 5)
    parcel = latest(
        raw["parcel"].where(c.txt("strap").isNotNull()).select(F.col("strap").alias("__raw"), strap, c.txt("dor_cd").alias("dor_cd"), c.num("jst_val").alias("market_value"), c.num("asd_val").alias("assessed_value"), c.num("tot_lnd_val").alias("land_value"), c.source_date("own_dt").alias("ownership_date")),
        ["strap"],
        [F.asc("__raw")],
    ).drop("__raw")
    unit = F.when(c.txt("str_unit").isNotNull(), F.concat(F.lit("#"), F.trim("str_unit")))
    street = F.nullif(F.concat_ws(" ", *[c.txt(n) for n in ("str_num", "str_pfx", "str", "str_sfx", "str_sfx_dir")], unit), F.lit(""))
    site = latest(
        raw["site"].select(strap, street.alias("address_street"), c.txt("city").alias("address_city"), zip5.alias("address_zip"), c.lenient_int("bld_num").alias("__b"), line.alias("__l")),
        ["strap"],
        [F.asc_nulls_last("__b"), F.asc_nulls_last("__l")],
    ).drop("__b", "__l")
    name = c.txt("Name")
    owners = raw["owner"].where(name.isNotNull()).groupBy(strap).agg(first_known(name, line).alias("owner_name"), in_order(name, line).alias("owners_text"), F.count("*").alias("owner_count"))
    mail = latest(
        raw["mail"].select(strap, c.txt("addr_1").alias("mail_addr"), c.txt("city").alias("owner_mail_city"), c.txt("state").alias("owner_mail_state"), zip5.alias("owner_mail_zip"), F.coalesce(c.txt("country_cd"), c.txt("country")).alias("owner_mail_country"), line.alias("__l")),
        ["strap"],
        [F.asc_nulls_last("__l")],
    ).drop("__l")
    building = raw["building"].groupBy(strap).agg(F.min(c.year_of("act", run_date)).alias("__built"), F.max(c.year_of("eff", run_date)).alias("effective_year"), F.sum(c.num("heat_ar")).alias("livable_floor_area"), F.sum(c.num("gross_ar")).alias("total_area"))
    detail = latest(raw["detail"].select(F.col("strap").alias("__raw"), strap, c.num("acreage").alias("__acre"), c.num("sqft").alias("__sqft"), c.txt("sub").alias("sub_id")), ["strap"], [F.asc("__raw")]).drop("__raw")
    sold = c.source_date("dos")
    sale = raw["sales"].where(sold.isNotNull()).groupBy(strap).agg(F.max(sold).alias("__sold"), latest_known(c.num("price"), sold).alias("last_sale_price"))
    dor = raw["lu_dor"].select(c.txt("dor_cd").alias("dor_cd"), c.txt("dscr").alias("property_usage_type"), c.txt("dept").alias("__dept"))
    sub = raw["lu_sub"].select(c.txt("id").alias("sub_id"), c.txt("dscr").alias("subdivision"))

    out = parcel
    for side in (site, owners, mail, building, detail, sale):
        out = out.join(side, "strap", "left")
    out = marked(out.join(dor, "dor_cd", "left").join(sub, "sub_id", "left"), "owner_mail_zip", site.select("address_zip"), "__local")
    if parcels is not None:
        out = out.join(parcels.select(F.col("parcel_no").alias("strap"), "latitude", "longitude", F.col("year_built").cast("long").alias("gis_year_built")), "strap", "left")
    else:
        out = out.withColumns({"latitude": F.lit(None).cast("double"), "longitude": F.lit(None).cast("double"), "gis_year_built": F.lit(None).cast("long")})
    lives_there = F.coalesce(c.alnum("mail_addr") == c.alnum("address_street"), F.lit(False)) & F.col("mail_addr").isNotNull() & F.col("address_street").isNotNull()
    return out.withColumns(
        {
            "property_id": c.surrogate_key(F.lit(region.key), "strap"),
            "request_identifier": F.col("strap"),
            "parcel_identifier": F.col("strap"),
            "source_system": F.lit(region.appraiser),
            "county_name": F.lit(region.name),
            "state_code": F.lit(region.state),
            "lot_size_acre": F.coalesce("__acre", F.col("__sqft") / SQFT_PER_ACRE),
            "lot_area_sqft": F.coalesce("__sqft", F.col("__acre") * SQFT_PER_ACRE),
            "property_type": c.use_class("__dept", "dor_cd"),
            "built_year": F.coalesce("__built", "gis_year_built"),
            "owner_occupied": lives_there,
            "last_sale_date": F.coalesce("__sold", "ownership_date").cast("string"),
            "owner_out_of_county": ~F.col("__local"),
            "owner_out_of_state": F.when(F.col("owner_mail_state").isNotNull(), F.upper("owner_mail_state") != region.state),
        }
    ).drop("__built", "__acre", "__sqft", "__sold", "__dept", "__local", "strap", "sub_id", "dor_cd", "mail_addr", "owner_mail_zip", "ownership_date")


def permit_summary(permits: DataFrame) -> DataFrame:
    """What the permits of a parcel add up to. Dates are ISO texts and compare as such.

    Rows are dealt by parcel once, so that distinct numbers and all else are summed up where they lie.
    """
    permits = permits.select("parcel_identifier", "permit_number", "is_roofing", "is_open", "improvement_status", "permit_close_date", "permit_issue_date", "opened_date", "days_open", "bbb_rating", "source_url").repartition("parcel_identifier")
    roof, is_open = F.col("is_roofing"), F.col("is_open")
    done = roof & (F.col("improvement_status") == "finaled")
    closed = F.coalesce("permit_close_date", "permit_issue_date", "opened_date")
    return permits.groupBy("parcel_identifier").agg(
        F.count_distinct("permit_number").alias("permit_count"),
        F.max(F.when(done, closed)).alias("last_roof_permit_date"),
        latest_known(F.when(done, F.col("permit_number")), F.when(done, closed)).alias("last_roof_permit_number"),
        latest_known(F.when(roof, F.col("improvement_status")), F.when(roof, F.coalesce("permit_issue_date", "opened_date", "permit_close_date"))).alias("last_roof_permit_status"),
        F.count_if(roof & is_open).cast("int").alias("open_roof_permit_count"),
        F.max(F.when(roof & is_open, F.col("days_open"))).cast("int").alias("oldest_open_roof_permit_days"),
        F.bool_or(F.col("bbb_rating").isNotNull()).alias("has_bbb_contractor"),
        F.array_join(F.array_sort(F.collect_set("source_url")), " | ").alias("__urls"),
    )


def roof_age(permit_date: Column, built_year: Column, run_year: int) -> tuple[Column, Column]:
    """Basis and years: calendar years since the last finished roofing permit, else since the house was built."""
    basis = F.when(permit_date.isNotNull(), "roof_permit").when(built_year.isNotNull(), "built_year").otherwise("unknown")
    years = F.when(permit_date.isNotNull(), run_year - F.year(permit_date.try_cast("date"))).when(built_year.isNotNull(), run_year - built_year).cast("int")
    return basis, years


def enrich(base_rows: DataFrame, permits: DataFrame, run_date: date, region: Region = COUNTY) -> DataFrame:
    """Base rows with permit summary, roof age, tenure, sources and hash."""
    summary = permit_summary(permits).withColumnRenamed("parcel_identifier", "request_identifier")
    out = base_rows.join(summary, "request_identifier", "left")
    basis, years = roof_age(F.col("last_roof_permit_date"), F.col("built_year"), run_date.year)
    urls = F.concat_ws(" | ", F.lit(region.sources["roll"].url), F.lit(region.sources["parcels"].url), F.nullif("__urls", F.lit("")))
    out = out.withColumns(
        {
            "has_permits": F.col("permit_count").isNotNull(),
            "open_roof_permit_count": F.coalesce("open_roof_permit_count", F.lit(0)),
            "has_bbb_contractor": F.coalesce("has_bbb_contractor", F.lit(False)),
            "roof_age_basis": basis,
            "roof_age_years": years,
            "years_since_sale": c.years_since(F.col("last_sale_date").try_cast("date"), run_date),
            "source_urls": urls,
        }
    ).withColumn("permit_count", F.coalesce("permit_count", F.lit(0).cast("long")))
    doubles = {f.name for f in out.schema.fields if f.dataType.typeName() == "double"}
    return out.withColumn("row_hash", c.row_hash(PROPERTY_HASHED, doubles))


def publish(base_rows: DataFrame, permits: DataFrame, previous: DataFrame | None, run_id: str, run_date: date, region: Region = COUNTY) -> DataFrame:
    return conform(carry_lineage(enrich(base_rows, permits, run_date, region), previous, "property_id", run_id), PROPERTIES)
