"""What the build must give for the tables of ``roll``, in SQL over the star schema.

Nothing here reads a raw text. Each raw column was made of an order, a customer or a supplier by a
known rule, so its meaning after parsing, cleaning and classifying can be told from that row
directly: a permit whose raw status is ``c`` because its order is ``F`` is finaled, whatever way the
build finds that out. Only resolving contractors is relational, and it is said as one relation of
(permit, rank, tag) joined with itself.
"""

from __future__ import annotations

PERMIT_KINDS = """
kinds(remainder, code, bucket) AS (VALUES (0, 'RR', 'Roofing'), (1, 'PO', 'Pool'), (2, 'FE', 'Fence'), (3, 'SF', 'New construction'), (4, 'XX', 'Other'), (5, NULL, 'Other')),
offices(remainder, office) AS (VALUES (0, 'Osceola County'), (1, 'City of Kissimmee'), (2, 'City of St. Cloud'), (3, NULL)),
works(remainder, work, is_roof) AS (VALUES (0, 'Re-roof shingle', true), (1, 'roof mount solar', false), (2, NULL, false), (3, 'work ', false), (4, 'work ', false), (5, 'work ', false), (6, 'work ', false)),
reviews(remainder, verdict) AS (VALUES (0, 'finaled'), (1, 'voided'), (2, 'expired'), (3, NULL), (4, NULL)),
o AS (SELECT o_orderkey AS k, CAST(o_custkey AS VARCHAR) AS cust, o_custkey % 2 = 0 AS even, CAST(o_orderdate AS DATE) AS d, o_orderstatus AS s, o_orderpriority AS priority, CAST(floor(o_totalprice) AS DOUBLE) AS price,
  CAST(o_orderkey % 1000 AS VARCHAR) AS who, '407555' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 4, '0') AS tel FROM orders)"""


def permits_sql(fetched_at: str | None = None) -> str:
    """CTEs up to ``stage``: one row a permit, classified."""
    at = "CAST(NULL AS VARCHAR)" if fetched_at is None else f"'{fetched_at}'"
    return f"""{PERMIT_KINDS},
appraiser AS (
  SELECT 'osceola_appraiser' AS source_system, 'B' || k AS permit_number, 'P' || cust AS parcel_identifier, code AS improvement_action, (k % 6 = 0 OR is_roof) AS is_roofing, bucket,
    CASE s WHEN 'F' THEN 'finaled' WHEN 'O' THEN 'open' ELSE CASE WHEN k % 2 = 0 THEN 'voided' ELSE 'open' END END AS improvement_status,
    CASE WHEN k % 11 > 0 THEN d END AS permit_issue_date, d - 10 AS application_received_date, d - 10 AS opened_date, CASE WHEN s = 'F' AND k % 2 = 0 THEN d + 90 END AS final_inspection_date,
    CASE WHEN s = 'F' AND k % 4 = 1 THEN d + 120 END AS completion_date, CAST(NULL AS DATE) AS expiration_date,
    CASE WHEN s = 'F' AND k % 2 = 0 THEN d + 90 WHEN s = 'F' AND k % 4 = 1 THEN d + 120 WHEN s = 'P' AND k % 2 = 0 THEN d + 20 END AS permit_close_date,
    CASE WHEN work = 'work ' THEN work || priority ELSE work END AS description, CASE WHEN k % 13 = 0 THEN 100.0 ELSE price END AS estimated_job_value, office AS issuing_agency,
    CASE WHEN k % 9 > 0 THEN 'Supplier Roofing ' || who || CASE WHEN k % 3 > 0 THEN ' LLC' ELSE '' END END AS contractor_name, CASE WHEN k % 3 > 0 THEN 'LAST, FIRST' END AS contractor_qualifier,
    CASE WHEN k % 4 = 0 THEN tel END AS contractor_phone, CAST(NULL AS VARCHAR) AS contractor_license, CASE WHEN k % 9 > 0 THEN 'SUPPLIER ' || who END AS contractor_name_norm,
    cust || ' MAIN' || CASE WHEN even THEN ' ST' ELSE '' END AS address_street, CAST(NULL AS VARCHAR) AS address_city, '34741' AS address_zip, 'https://www.property-appraiser.org/data/' AS source_url, {at} AS fetched_at
  FROM o JOIN kinds ON kinds.remainder = k % 6 JOIN offices ON offices.remainder = k % 4 JOIN works ON works.remainder = k % 7),
portal AS (
  SELECT 'osceola_accela' AS source_system, 'AC' || k AS permit_number, 'P' || cust AS parcel_identifier, CASE WHEN k % 4 = 1 THEN 'Residential Roof' ELSE 'PO' END AS improvement_action, k % 4 = 1 AS is_roofing, 'Pool' AS bucket,
    coalesce(verdict, CASE WHEN k % 8 = 3 THEN 'finaled' ELSE 'open' END) AS improvement_status, CAST(NULL AS DATE) AS permit_issue_date, d AS application_received_date, d AS opened_date,
    CASE WHEN k % 8 = 3 THEN d + 40 END AS final_inspection_date, CASE WHEN k % 8 = 3 THEN d + 40 END AS completion_date, d + 180 AS expiration_date, CASE WHEN k % 8 = 3 THEN d + 40 END AS permit_close_date,
    'portal 1-URGENT' AS description, price AS estimated_job_value, 'Osceola County' AS issuing_agency, CASE WHEN k % 20 < 10 THEN 'Supplier Roofing ' || who ELSE 'JOE' END AS contractor_name,
    CASE WHEN k % 20 < 10 THEN 'JOE' END AS contractor_qualifier, CASE WHEN k % 20 < 15 THEN tel END AS contractor_phone, CASE WHEN k % 30 < 20 THEN 'CCC13' || lpad(who, 5, '0') END AS contractor_license,
    CASE WHEN k % 20 < 10 THEN 'SUPPLIER ' || who ELSE 'JOE' END AS contractor_name_norm, '1 PORTAL WAY' AS address_street, CAST(NULL AS VARCHAR) AS address_city, CAST(NULL AS VARCHAR) AS address_zip,
    'https://example.org/' || k AS source_url, '2001-12-31' AS fetched_at
  FROM o JOIN reviews ON reviews.remainder = k % 5 WHERE priority = '1-URGENT'),
told AS (SELECT *, CASE WHEN is_roofing THEN 'Roofing' ELSE bucket END AS improvement_type, improvement_status = 'open' AND permit_close_date IS NULL AS is_open FROM (SELECT * FROM appraiser UNION ALL BY NAME SELECT * FROM portal) u),
stage AS (
  SELECT * EXCLUDE (bucket), left(sha256(source_system || ':' || permit_number || ':' || parcel_identifier), 32) AS property_improvement_id, left(sha256('osceola:' || parcel_identifier), 32) AS property_id,
    CAST((CASE WHEN is_open THEN DATE '2002-01-01' ELSE coalesce(permit_close_date, DATE '2002-01-01') END) - coalesce(permit_issue_date, opened_date) AS INTEGER) AS days_open,
    sha256(array_to_string([coalesce(x, '') FOR x IN [parcel_identifier, improvement_type, improvement_status, improvement_action, CAST(permit_issue_date AS VARCHAR), CAST(application_received_date AS VARCHAR), CAST(final_inspection_date AS VARCHAR),
      CAST(permit_close_date AS VARCHAR), CAST(completion_date AS VARCHAR), CAST(expiration_date AS VARCHAR), CAST(opened_date AS VARCHAR), description, printf('%.6f', estimated_job_value), contractor_name, contractor_qualifier,
      contractor_phone, contractor_license]], '|')) AS row_hash
  FROM told)"""


#: A tag's rank: 1 licence, 2 phone, 3 name. A permit is its tag of the lowest rank. A tag stands for the
#: one tag of lower rank that permits show beside it; a phone counts as that on permits without a licence alone.
LINKS = """
tags AS (
  SELECT property_improvement_id AS id, contractor_license IS NOT NULL AS licensed, t.rank, t.tag
  FROM stage, LATERAL (VALUES (1, 'lic:' || contractor_license), (2, 'tel:' || contractor_phone), (3, 'name:' || contractor_name_norm)) t(rank, tag) WHERE t.tag IS NOT NULL),
beside AS (SELECT high.tag AS alias_key, low.rank, min(low.tag) AS target FROM tags low JOIN tags high ON high.id = low.id AND high.rank > low.rank AND low.licensed = (low.rank = 1) GROUP BY 1, 2 HAVING min(low.tag) = max(low.tag)),
alias AS (SELECT alias_key, arg_min(target, rank) AS canonical_key FROM beside GROUP BY 1),
own AS (SELECT id, min(rank) AS rank, arg_min(tag, rank) AS identity_key FROM tags GROUP BY 1),
links AS (
  SELECT id AS property_improvement_id, ['license', 'phone', 'name'][rank] AS identity_basis, identity_key, coalesce(canonical_key, identity_key) AS canonical_key, left(sha256(coalesce(canonical_key, identity_key)), 32) AS contractor_id
  FROM own LEFT JOIN alias ON alias_key = identity_key)"""

#: One row an entity; its name is the one of most permits, the first in order among equals.
ENTITIES = """
held AS (SELECT contractor_id, canonical_key, coalesce(permit_issue_date, opened_date) AS seen, s.* FROM links JOIN stage s USING (property_improvement_id)),
spelt AS (SELECT contractor_id, min(contractor_name) FILTER (WHERE n = most) AS display_name FROM (SELECT *, max(n) OVER (PARTITION BY contractor_id) AS most FROM (SELECT contractor_id, contractor_name, count(*) AS n FROM held WHERE contractor_name IS NOT NULL GROUP BY 1, 2) a) b GROUP BY 1),
entities AS (
  SELECT h.contractor_id, any_value(display_name) AS display_name, CASE WHEN any_value(display_name) = 'JOE' THEN 'JOE' ELSE 'SUPPLIER ' || regexp_extract(any_value(display_name), '[0-9]+') END AS normalized_name,
    max(contractor_license) AS license_number, max(contractor_phone) AS phone, CASE split_part(any_value(canonical_key), ':', 1) WHEN 'lic' THEN 'license' WHEN 'tel' THEN 'phone' ELSE 'name' END AS identity_basis,
    CAST(count(*) AS INTEGER) AS permit_count, CAST(sum(CAST(is_roofing AS INTEGER)) AS INTEGER) AS roofing_permit_count, CAST(sum(CAST(is_roofing AND is_open AS INTEGER)) AS INTEGER) AS open_roofing_permit_count,
    CAST(min(seen) AS VARCHAR) AS first_permit_date, CAST(max(seen) AS VARCHAR) AS last_permit_date, array_to_string(list_sort(list(DISTINCT source_system)), ' | ') AS source_systems
  FROM held h LEFT JOIN spelt USING (contractor_id) GROUP BY 1)"""


def matches_sql(unlicensed: bool = False) -> str:
    """``offers``: every way a profile can meet an entity, by priority; ``matched``: the best of each entity."""
    return f"""
shown AS (
  SELECT '0733-' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS bbb_id, '407555' || lpad(CAST(s_suppkey AS VARCHAR), 4, '0') AS tel, CASE WHEN s_suppkey % 2 = 0 THEN 'SUPPLIER ' ELSE 'OTHER ' END || s_suppkey AS nm,
    CASE WHEN s_suppkey % 3 = 0 THEN 'CCC13' || lpad(CAST(s_suppkey AS VARCHAR), 5, '0') END AS lic, CASE WHEN s_acctbal > 5000 THEN 'A+' ELSE 'B' END AS bbb_rating, s_acctbal > 0 AS bbb_accredited,
    CAST(s_suppkey AS INTEGER) AS bbb_review_count, CAST(0 AS INTEGER) AS bbb_complaint_count, 'https://example.org/p/' || s_suppkey AS bbb_profile_url FROM supplier),
listed AS (SELECT * FROM shown WHERE lic IS NOT NULL OR {str(unlicensed).lower()}),
offers AS (
  SELECT contractor_id, 1 AS priority, bbb_id FROM entities JOIN listed ON lic = license_number UNION ALL SELECT contractor_id, 2, bbb_id FROM entities JOIN listed ON tel = phone
  UNION ALL SELECT contractor_id, 3, bbb_id FROM entities JOIN (SELECT nm, min(bbb_id) AS bbb_id FROM listed GROUP BY 1 HAVING count(*) = 1) one ON nm = normalized_name),
matched AS (SELECT contractor_id, bbb_id, ['license', 'phone', 'name'][priority] AS bbb_match_method, shown.* EXCLUDE (bbb_id, tel, nm, lic) FROM (SELECT contractor_id, min(priority) AS priority, arg_min(bbb_id, (priority, bbb_id)) AS bbb_id FROM offers GROUP BY 1) q JOIN shown USING (bbb_id))"""


#: A street ends in ST for even customers and has a unit for every fifth; mail goes to the street of every fourth.
BASE = """
uses(low, high, use) AS (VALUES (0, 9, 'residential'), (10, 39, 'commercial'), (40, 49, 'industrial'), (50, 69, 'agricultural'), (70, 79, 'institutional'), (80, 89, 'government'), (90, 99, 'other')),
parts AS (SELECT p_partkey - 1 AS head, 'use ' || p_partkey AS use_text, CASE p_partkey % 10 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 4 ELSE 9 END AS dept_place, CASE p_partkey % 10 WHEN 0 THEN 'residential' WHEN 1 THEN 'commercial' WHEN 2 THEN 'agricultural' END AS dept_use FROM part WHERE p_partkey BETWEEN 1 AND 100),
placed AS (SELECT *, row_number() OVER (ORDER BY low) AS place FROM uses),
bought AS (SELECT o_custkey AS c, CAST(o_orderdate AS DATE) AS d, CASE WHEN o_orderkey % 5 > 0 THEN floor(o_totalprice) END AS price FROM orders),
sold AS (SELECT c, max(d) AS last_day, arg_max(price, (d, price)) FILTER (WHERE price IS NOT NULL) AS last_sale_price FROM bought GROUP BY 1),
geo AS (SELECT c_custkey AS c, 27.55::DOUBLE + ((c_custkey * 7919) % 8500)::DOUBLE / 10000 AS latitude, -81.70::DOUBLE + ((c_custkey * 104729) % 8500)::DOUBLE / 10000 AS longitude, 1980::BIGINT AS gis_year_built FROM customer WHERE c_custkey % 7 > 0),
base AS (
  SELECT left(sha256('osceola:P' || x.c_custkey), 32) AS property_id, 'P' || x.c_custkey AS request_identifier, 'P' || x.c_custkey AS parcel_identifier, 'osceola_appraiser' AS source_system, 'Osceola' AS county_name, 'FL' AS state_code,
    x.c_custkey || ' MAIN' || CASE WHEN x.c_custkey % 2 = 0 THEN ' ST' ELSE '' END || CASE WHEN x.c_custkey % 5 = 0 THEN ' #7' ELSE '' END AS address_street, 'KISSIMMEE' AS address_city, CASE WHEN x.c_custkey % 3 = 0 THEN '34741' ELSE '34744' END AS address_zip,
    latitude, longitude, gis_year_built, CASE WHEN x.c_custkey % 2 = 0 THEN 0.5 WHEN x.c_custkey % 3 = 0 THEN 8712 / 43560.0::DOUBLE END AS lot_size_acre, CASE WHEN x.c_custkey % 3 = 0 THEN 8712.0 WHEN x.c_custkey % 2 = 0 THEN 21780.0 END AS lot_area_sqft,
    CASE WHEN dept_place < place THEN dept_use ELSE use END AS property_type, use_text AS property_usage_type, CASE WHEN x.c_custkey % 6 > 0 THEN 1941 + x.c_custkey % 60 ELSE gis_year_built END AS built_year, 1962 + x.c_custkey % 40 AS effective_year,
    2.0 * (1000 + x.c_custkey % 500) AS livable_floor_area, 1500.0::DOUBLE AS total_area, floor(c_acctbal / 2) AS assessed_value, floor(c_acctbal) AS market_value, CAST(NULL AS DOUBLE) AS land_value,
    c_name || ' 1' AS owner_name, c_name || ' 1 | ' || c_name || ' 2' AS owners_text, CAST(2 AS BIGINT) AS owner_count, x.c_custkey % 4 = 0 AND x.c_custkey % 5 > 0 AS owner_occupied,
    CAST(coalesce(last_day, DATE '1985-01-01' + CAST(x.c_custkey % 5000 AS INTEGER)) AS VARCHAR) AS last_sale_date, last_sale_price, n_name AS subdivision, 'ORLANDO' AS owner_mail_city,
    CASE x.c_nationkey % 3 WHEN 0 THEN 'fl' WHEN 1 THEN 'GA' END AS owner_mail_state, 'US' AS owner_mail_country, CASE WHEN x.c_custkey % 2 = 0 THEN false WHEN x.c_custkey % 7 > 0 THEN true END AS owner_out_of_county,
    CASE x.c_nationkey % 3 WHEN 0 THEN false WHEN 1 THEN true END AS owner_out_of_state
  FROM customer x JOIN placed ON x.c_custkey % 100 BETWEEN low AND high LEFT JOIN parts ON head = x.c_custkey % 100 LEFT JOIN sold ON sold.c = x.c_custkey LEFT JOIN geo ON geo.c = x.c_custkey LEFT JOIN nation ON n_nationkey = x.c_nationkey)"""

FINAL = """
final_permits AS (
  SELECT s.property_improvement_id, b.property_id, s.parcel_identifier, permit_number, improvement_type, improvement_status, improvement_action, CAST(permit_issue_date AS VARCHAR) AS permit_issue_date,
    CAST(application_received_date AS VARCHAR) AS application_received_date, CAST(final_inspection_date AS VARCHAR) AS final_inspection_date, CAST(permit_close_date AS VARCHAR) AS permit_close_date,
    CAST(completion_date AS VARCHAR) AS completion_date, CAST(expiration_date AS VARCHAR) AS expiration_date, CAST(opened_date AS VARCHAR) AS opened_date, s.source_system, 'Osceola' AS county_name, description AS project_description, description,
    estimated_job_value, CAST(NULL AS DOUBLE) AS fee, is_roofing, is_open, days_open, issuing_agency, contractor_name, contractor_qualifier, contractor_phone, contractor_license, l.contractor_id, bbb_rating, bbb_accredited, bbb_profile_url,
    bbb_match_method, latitude, longitude, s.address_street, coalesce(s.address_city, b.address_city) AS address_city, coalesce(s.address_zip, b.address_zip) AS address_zip, source_url, fetched_at,
    'run-1' AS first_seen_run_id, 'run-1' AS last_changed_run_id, row_hash
  FROM stage s LEFT JOIN base b ON b.request_identifier = s.parcel_identifier LEFT JOIN links l USING (property_improvement_id) LEFT JOIN matched m ON m.contractor_id = l.contractor_id),
roofs AS (SELECT parcel_identifier, max(coalesce(permit_close_date, permit_issue_date, opened_date)) AS done FROM final_permits WHERE is_roofing AND improvement_status = 'finaled' GROUP BY 1),
waiting AS (SELECT parcel_identifier, CAST(count(*) AS INTEGER) AS n, max(days_open) AS longest FROM final_permits WHERE is_roofing AND is_open GROUP BY 1),
seen AS (SELECT parcel_identifier, count(DISTINCT permit_number) AS n, bool_or(bbb_rating IS NOT NULL) AS rated, array_to_string(list_sort(list(DISTINCT source_url)), ' | ') AS urls FROM final_permits GROUP BY 1),
joined AS (
  SELECT b.* EXCLUDE (parcel_identifier), b.parcel_identifier, CAST(NULL AS VARCHAR) AS property_cid, CAST(NULL AS VARCHAR) AS exterior_wall_material, CAST(NULL AS VARCHAR) AS roof_covering_material, CAST(NULL AS DOUBLE) AS avm_value,
    seen.n IS NOT NULL AS has_permits, coalesce(seen.n, 0) AS permit_count, CAST(NULL AS BOOLEAN) AS has_sunbiz_tenant, coalesce(rated, false) AS has_bbb_contractor, CAST(NULL AS BOOLEAN) AS has_pa_corp_tenant, CAST(NULL AS BOOLEAN) AS hoa_flag,
    done AS last_roof_permit_date, CASE WHEN done IS NOT NULL THEN 'roof_permit' WHEN built_year IS NOT NULL THEN 'built_year' ELSE 'unknown' END AS roof_age_basis,
    CAST(2002 - coalesce(CAST(left(done, 4) AS BIGINT), built_year) AS INTEGER) AS roof_age_years, coalesce(waiting.n, 0) AS open_roof_permit_count, longest AS oldest_open_roof_permit_days,
    round((DATE '2002-01-01' - CAST(last_sale_date AS DATE)) / 365.25, 2) AS years_since_sale, 'run-1' AS first_seen_run_id, 'run-1' AS last_changed_run_id,
    concat_ws(' | ', 'https://www.property-appraiser.org/data/', 'https://services6.arcgis.com/9zKHLCgIwu2HFA5O/arcgis/rest/services/Parcels/FeatureServer/0', urls) AS source_urls
  FROM base b LEFT JOIN seen USING (parcel_identifier) LEFT JOIN roofs USING (parcel_identifier) LEFT JOIN waiting USING (parcel_identifier)),
final_properties AS (
  SELECT *, sha256(array_to_string([coalesce(x, '') FOR x IN [address_street, address_city, address_zip, printf('%.6f', latitude), printf('%.6f', longitude), printf('%.6f', lot_size_acre), property_usage_type, CAST(built_year AS VARCHAR), CAST(effective_year AS VARCHAR),
    printf('%.6f', livable_floor_area), printf('%.6f', total_area), printf('%.6f', assessed_value), printf('%.6f', market_value), printf('%.6f', land_value), owner_name, owners_text, CAST(owner_count AS VARCHAR), last_sale_date,
    printf('%.6f', last_sale_price), subdivision, CAST(permit_count AS VARCHAR), last_roof_permit_date, CAST(open_roof_permit_count AS VARCHAR), owner_mail_city, owner_mail_state, owner_mail_country]], '|')) AS row_hash
  FROM joined)"""

#: Every fourth customer's place is under a licence that keeps it out; even ones are of the trade.
PLACES = """
final_places AS (
  SELECT 'g' || c_custkey AS place_id, c_name AS name, 'x' AS taxonomy_primary, CASE WHEN c_custkey % 2 = 0 THEN 'services/Roofing_contractor' ELSE 'food' END AS taxonomy_hierarchy, 'x' AS basic_category, c_custkey % 2 = 0 AS is_contractor, 'open' AS operating_status,
    0.5::DOUBLE AS confidence, '407555' || lpad(CAST(c_custkey % 60 AS VARCHAR), 4, '0') AS phone, CAST(NULL AS VARCHAR) AS website, 'x' AS address_street, 'x' AS address_city, 'x' AS address_zip, 2::DOUBLE AS latitude, 1::DOUBLE AS longitude,
    CASE WHEN c_custkey % 2 = 0 THEN t.contractor_id END AS contractor_id, CASE WHEN c_custkey % 4 > 1 THEN 'meta' ELSE '' END AS source_datasets, '2026-08' AS overture_release, 'https://stac.overturemaps.org/2026-08/catalog.json' AS source_url, '2026-09-01' AS fetched_at
  FROM customer LEFT JOIN (SELECT phone, min(contractor_id) AS contractor_id FROM entities GROUP BY 1) t ON t.phone = '407555' || lpad(CAST(c_custkey % 60 AS VARCHAR), 4, '0') WHERE c_custkey % 4 > 0)"""


def sql(result: str, columns: list[str], *, fetched_at: str | None = None, unlicensed: bool = False) -> str:
    """One statement for ``result``, one of the relations above."""
    parts = [permits_sql(fetched_at), LINKS, ENTITIES, matches_sql(unlicensed), BASE, FINAL, PLACES]
    return f"WITH {', '.join(parts)} SELECT {', '.join(columns)} FROM {result}"
