"""Registered queries: dashboard filters, searches, geocoding, density, model inputs."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from devigil.operators import geo, marts
from devigil.operators.filters import (
    contains_text,
    drop_incomplete,
    equals_ignoring_case,
    restrict_to,
    search,
    trailing_days,
    valid_coordinates,
    within_last_year,
)
from devigil.operators.models import (
    candidate_devices,
    device_features,
    event_facts,
    prediction_summary,
    recall_features,
)
from devigil.plans import bindings as B
from devigil.plans.check_text import company_sql
from devigil.plans.dashboards import filtered_events, filtered_recalls
from devigil.plans.registry import query

# --- filters ------------------------------------------------------------------------------------


@query(
    "flt1_flt2_flt3_events_filter",
    f"""WITH {B.EVENTS_SQL}
SELECT manufacturer_d_name, openfda_device_name, event_type, count(*) AS row_count,
  CAST(min(date_of_event) AS VARCHAR) AS first_event
FROM events_a e JOIN devices_a d ON e.event_id = d.event_id
WHERE openfda_device_name ILIKE '%R_D%' AND manufacturer_d_name ILIKE '%supplier%'
  AND event_type ILIKE '%INJ%' AND date_of_event BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
GROUP BY 1, 2, 3""",
)
def _(t):
    extra = [
        "adverse_event_flag", "date_facility_aware", "date_report_to_fda", "product_problems",
        "date_report_to_manufacturer", "health_professional", "number_devices_in_event",
        "number_patients_in_event",
    ]
    events = B.events_of_orders(t).withColumns({c: F.lit(None).cast("string") for c in extra})
    filters = {
        "device_name": "R_D",
        "manufacturer_d_name": "supplier",
        "event_type": "INJ",
        "date_from": "1996-01-01",
        "date_to": "1999-12-31",
        "unknown": "ignored",
    }
    rows = filtered_events(events, B.devices_of_lines(t), filters)
    return rows.groupBy("manufacturer_d_name", "openfda_device_name", "event_type").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("date_of_event").cast("string").alias("first_event"),
    )


@query(
    "flt3_half_open_range_ignored",
    f"""WITH {B.EVENTS_SQL} SELECT recalling_firm, count(*) AS row_count FROM recalls_a
WHERE recalling_firm ILIKE '%Customer#%9%' GROUP BY 1""",
)
def _(t):
    filters = {"recalling_firm": "Customer#%9", "date_from": "1996-01-01", "device_name": ""}
    rows = filtered_recalls(B.recalls_of_orders(t), filters)
    return rows.groupBy("recalling_firm").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "flt4_flt5_recalls_filter",
    f"""WITH {B.EVENTS_SQL} SELECT id, recalling_firm, root_cause_description FROM recalls_a
WHERE openfda_device_name ILIKE '%mach%' AND lower(root_cause_description) = '1-urgent'
  AND event_date_posted BETWEEN DATE '1995-06-01' AND DATE '2000-06-30'""",
)
def _(t):
    filters = {
        "device_name": "mach",
        "root_cause_description": "1-Urgent",
        "date_from": "1995-06-01",
        "date_to": "2000-06-30",
    }
    rows = filtered_recalls(B.recalls_of_orders(t), filters)
    return rows.select("id", "recalling_firm", "root_cause_description")


@query(
    "flt2_substring",
    "SELECT doc_id FROM documents WHERE text ILIKE '%tion%' AND source ILIKE '%C1_'",
)
def _(t):
    return t.documents.filter(
        contains_text(F.col("text"), "tion") & F.col("source").ilike("%C1_")
    ).select("doc_id")


@query(
    "flt6_regex_search",
    "SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)an[a-z]+ the\\b')",
)
def _(t):
    return search(t.documents, "text", r"an[a-z]+ the\b").select("doc_id")


@query(
    "flt7_trailing_days",
    """SELECT o_orderstatus, count(*) FILTER (CAST(o_orderdate AS DATE) >=
  (SELECT CAST(max(o_orderdate) AS DATE) FROM orders) - 30) AS recent FROM orders GROUP BY 1""",
)
def _(t):
    newest = t.orders.agg(F.max(F.col("o_orderdate").cast("date")).alias("d")).scalar()
    marked = t.orders.withColumn("recent", trailing_days(F.col("o_orderdate"), newest))
    return marked.groupBy("o_orderstatus").agg(F.count_if("recent").alias("recent"))


@query(
    "flt8_last_year",
    """SELECT o_orderkey FROM orders
WHERE CAST(o_orderdate AS DATE) >= CAST(DATE '2001-02-28' - INTERVAL 12 MONTH AS DATE)""",
)
def _(t):
    as_of = F.lit("2001-02-28").cast("date")
    return t.orders.filter(within_last_year(F.col("o_orderdate"), as_of)).select("o_orderkey")


@query(
    "flt9_not_null",
    """SELECT d.doc_id, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE quality IS NOT NULL""",
)
def _(t):
    joined = t.documents.join(t.labels, "doc_id", "left")
    return joined.filter(F.col("quality").isNotNull()).select("doc_id", "quality")


@query(
    "flt10_device_lookup",
    """SELECT p_partkey, CAST(p_name = 'red widget' AS INTEGER) AS exact FROM part
WHERE lower(p_name) = 'red widget'""",
)
def _(t):
    return t.part.filter(equals_ignoring_case(F.col("p_name"), "Red Widget")).select(
        "p_partkey", (F.col("p_name") == "red widget").cast("int").alias("exact")
    )


@query(
    "flt12_non_empty_names",
    f"SELECT doc_id FROM documents WHERE {company_sql('text')} <> ''",
)
def _(t):
    from devigil.functions.text import company_key

    return t.documents.filter(company_key(F.col("text")) != "").select("doc_id")


@query(
    "flt14_complete_rows",
    """SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d
LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE d.lang IS NOT NULL AND l.quality IS NOT NULL AND l.toxic IS NOT NULL""",
)
def _(t):
    joined = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return drop_incomplete(joined)


@query(
    "jn9_cross_filter_search",
    f"""{B.INTEGRATED_SQL}, found AS (SELECT DISTINCT manufacturer_name FROM integrated
  WHERE regexp_matches(coalesce(manufacturer_name, ''), '(?i)ER 0*1?7$'))
SELECT DISTINCT manufacturer_name, device_name, device_class FROM integrated
WHERE manufacturer_name IN (SELECT manufacturer_name FROM found)""",
)
def _(t):
    integrated = B.integrated(t)
    makers = search(
        integrated.select("manufacturer_name").distinct(), "manufacturer_name", "ER 0*1?7$"
    )
    devices = integrated.select("manufacturer_name", "device_name", "device_class").distinct()
    return restrict_to(devices, makers, "manufacturer_name")


@query(
    "jn9_cross_filter_null_matches_null",
    f"""{B.INTEGRATED_SQL} SELECT DISTINCT manufacturer_state, source FROM integrated""",
)
def _(t):
    rows = B.integrated(t).select("manufacturer_state", "source").distinct()
    return restrict_to(rows, rows.select("manufacturer_state").distinct(), "manufacturer_state")


# --- geography ----------------------------------------------------------------------------------

GAZETTEER_SQL = """
gazetteer AS (
  SELECT n_name AS country_code,
    trim(CAST(CAST(floor(s_acctbal / 1000) AS INTEGER) AS VARCHAR) || ' ') AS postal_code,
    s_acctbal / 100 AS latitude, (s_suppkey * 91.7::DOUBLE) % 400 - 200 AS longitude
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
located AS (
  SELECT * FROM gazetteer WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180),
places AS (
  SELECT o_orderkey, upper(lower(n_name)) AS country_code,
    trim(' ' || CAST(CAST(floor(c_acctbal / 1000) AS INTEGER) AS VARCHAR)) AS postal_code
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
"""


def _gazetteer(t):
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("country_code"),
        F.floor(F.col("s_acctbal") / 1000).cast("int").cast("string").alias("postal_code"),
        (F.col("s_acctbal") / 100).alias("latitude"),
        ((F.col("s_suppkey") * 91.7) % 400 - 200).alias("longitude"),
    )


def _places(t):
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "o_orderkey",
            F.lower("n_name").alias("country"),
            F.concat(
                F.lit(" "), F.floor(F.col("c_acctbal") / 1000).cast("int").cast("string")
            ).alias("postal"),
        )
    )


@query(
    "jn6_flt11_geocode",
    f"""WITH {GAZETTEER_SQL}
SELECT o_orderkey, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude
FROM places p JOIN located g ON p.country_code = g.country_code
  AND p.postal_code = g.postal_code""",
)
def _(t):
    # an order meets many places, so these are checked and rounded once each before
    places = geo.located(_gazetteer(t)).withColumns(
        {c: F.round(c, 6) for c in ("latitude", "longitude")}
    )
    found = geo.geocode(_places(t), "country", "postal", places)
    return found.select("o_orderkey", "latitude", "longitude")


@query(
    "jn6_geocode_one_place",
    f"""WITH {GAZETTEER_SQL}, one AS (
  SELECT country_code, postal_code, min(row(latitude, longitude)) AS place FROM gazetteer GROUP BY 1, 2)
SELECT o_orderkey, round(place[1], 6) AS latitude, round(place[2], 6) AS longitude FROM places p
JOIN one g ON p.country_code = g.country_code AND p.postal_code = g.postal_code""",
)
def _(t):
    found = geo.geocode(_places(t), "country", "postal", _gazetteer(t), dedupe=True)
    return found.select(
        "o_orderkey",
        F.round("latitude", 6).alias("latitude"),
        F.round("longitude", 6).alias("longitude"),
    )


@query(
    "flt11_valid_coordinates",
    f"""WITH {GAZETTEER_SQL} SELECT country_code, count(*) AS n FROM located GROUP BY 1""",
)
def _(t):
    valid = valid_coordinates(F.col("latitude"), F.col("longitude"))
    return _gazetteer(t).filter(valid).groupBy("country_code").agg(F.count(F.lit(1)).alias("n"))


@query(
    "agg17_centroid",
    f"""WITH {GAZETTEER_SQL}
SELECT round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude
FROM places p JOIN located g ON p.country_code = g.country_code
  AND p.postal_code = g.postal_code""",
)
def _(t):
    points = geo.counted_points(_places(t), "country", "postal", _gazetteer(t))
    return geo.centroid(points).select(
        F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude")
    )


ZOOM = 6
#: Bytes (as JSON) of the names of manufacturers that go to every worker.
MAKERS_BYTES = 64 << 20


@query(
    "agg18_hexbin",
    f"""WITH {GAZETTEER_SQL}, xy AS (
  SELECT {geo.EARTH_RADIUS} * radians(longitude) AS x,
    {geo.EARTH_RADIUS} * ln(tan(pi() / 4 + radians(latitude) / 2)) AS y
  FROM places p JOIN located g ON p.country_code = g.country_code
    AND p.postal_code = g.postal_code),
axial AS (
  SELECT (x * {math.sqrt(3) / 3!r} - y / 3) / {geo.zoom_to_radius(ZOOM)}.0 AS q,
    y * {2.0 / 3.0!r} / {geo.zoom_to_radius(ZOOM)}.0 AS r FROM xy),
rounded AS (
  SELECT q, r, floor(q + 0.5) AS rq, floor(r + 0.5) AS rr, floor((-q - r) + 0.5) AS rs FROM axial),
errors AS (
  SELECT *, abs(rq - q) AS dq, abs(rr - r) AS dr, abs(rs - (-q - r)) AS ds FROM rounded)
SELECT CAST(CASE WHEN dq > dr AND dq > ds THEN -rr - rs ELSE rq END AS BIGINT) AS hex_q,
  CAST(CASE WHEN NOT (dq > dr AND dq > ds) AND dr > ds THEN -rq - rs ELSE rr END AS BIGINT)
    AS hex_r, count(*) AS points FROM errors GROUP BY 1, 2""",
)
def _(t):
    points = geo.counted_points(_places(t), "country", "postal", _gazetteer(t))
    return geo.hexbin(points, ZOOM)


# --- model inputs -------------------------------------------------------------------------------

CLASSES_SQL = """
classes AS (
  SELECT p_name AS device_name, p_brand AS product_code, CAST(p_size % 3 + 1 AS VARCHAR)
    AS device_class, CAST(p_size AS VARCHAR) AS regulation_number,
    CASE p_type WHEN 'PROMO' THEN '2' WHEN 'ECONOMY' THEN '1' ELSE '3' END AS submission_type_id
  FROM part)
"""


def _classes(t):
    return t.part.select(
        F.upper("p_name").alias("device_name"),
        F.col("p_brand").alias("product_code"),
        (F.col("p_size") % 3 + 1).cast("string").alias("device_class"),
        F.col("p_size").cast("string").alias("regulation_number"),
        F.when(F.col("p_type") == "PROMO", "2")
        .when(F.col("p_type") == "ECONOMY", "1")
        .otherwise("3")
        .alias("submission_type_id"),
    )


def _event_side(t):
    devices = B.devices_of_lines(t)
    events = B.events_of_orders(t).select("event_id")
    return events, devices.withColumns(
        {
            "device_report_product_code": F.col("brand_name"),
            "model_number": F.col("generic_name"),
        }
    )


SEGMENT_TYPE_SQL = """CASE o_orderpriority WHEN '1-URGENT' THEN 'death' WHEN '2-HIGH' THEN 'injury'
    WHEN '3-MEDIUM' THEN 'malfunction' WHEN '5-LOW' THEN 'not provided' ELSE 'other' END"""

FEATURES_SQL = f"""
facts AS (SELECT DISTINCT manufacturer_d_name, event_type, brand_name, openfda_regulation_number,
    generic_name, openfda_device_name FROM devices_a WHERE event_type IS NOT NULL
  UNION SELECT c_name, {SEGMENT_TYPE_SQL}, n_name, CAST(c_nationkey AS VARCHAR), o_orderstatus,
    c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey),
keyed AS (SELECT {company_sql('openfda_device_name')} AS key, event_type FROM facts),
recalled AS (SELECT {company_sql('openfda_device_name')} AS key, count(*) AS recall_count
  FROM recalls_a GROUP BY 1),
known AS (SELECT upper(device_name) AS device_name, product_code, device_class, regulation_number,
    submission_type_id FROM classes UNION ALL
  SELECT DISTINCT c_mktsegment, 'S' || substr(c_mktsegment, 1, 1), CAST(c_nationkey % 3 + 1 AS VARCHAR),
    CAST(c_nationkey AS VARCHAR), CAST(c_nationkey % 2 + 1 AS VARCHAR) FROM customer),
features AS (
  SELECT device_name, product_code, event_type, device_class,
    regulation_number, CASE WHEN submission_type_id = '2' THEN 1 ELSE 0 END AS pma_approval,
    CASE WHEN submission_type_id = '1' THEN 1 ELSE 0 END AS "510k_approval",
    CASE WHEN coalesce(recall_count, 0) > 0 THEN 1 ELSE 0 END AS recall, count(*) AS num_events
  FROM keyed k LEFT JOIN known c ON k.key = {company_sql('device_name')}
    LEFT JOIN recalled r ON k.key = r.key
  WHERE k.key <> '' AND device_name IS NOT NULL GROUP BY ALL)
"""


def _segment_side(t):
    """Devices that recalls name: one event per order, about the segment of its customer."""
    customers = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    kind = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "death")
        .when(F.col("o_orderpriority") == "2-HIGH", "injury")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "malfunction")
        .when(F.col("o_orderpriority") == "5-LOW", "not provided")
        .otherwise("other")
    )
    return t.orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_name").alias("manufacturer_d_name"),
        kind.alias("event_type"),
        F.col("n_name").alias("device_report_product_code"),
        F.col("c_nationkey").cast("string").alias("openfda_regulation_number"),
        F.col("o_orderstatus").alias("model_number"),
        F.col("c_mktsegment").alias("openfda_device_name"),
    )


def recall_training_rows(t):
    """Facts about parts and about market segments; recalls of all orders name the segments."""
    facts = event_facts(*_event_side(t)).unionByName(_segment_side(t)).distinct()
    segments = t.customer.select(
        F.col("c_mktsegment").alias("device_name"),
        F.concat(F.lit("S"), F.substring("c_mktsegment", 1, 1)).alias("product_code"),
        (F.col("c_nationkey") % 3 + 1).cast("string").alias("device_class"),
        F.col("c_nationkey").cast("string").alias("regulation_number"),
        (F.col("c_nationkey") % 2 + 1).cast("string").alias("submission_type_id"),
    ).distinct()
    return recall_features(facts, _classes(t).unionByName(segments), B.recalls_of_orders(t))


@query(
    "jn2_agg13_recall_features",
    f"WITH {B.EVENTS_SQL}, {CLASSES_SQL}, {FEATURES_SQL} SELECT * FROM features",
)
def _(t):
    return recall_training_rows(t)


DEVICE_FEATURES_SQL = """
device_features AS (
  SELECT openfda_device_name AS device_name, c.product_code, event_type, c.device_class,
    openfda_regulation_number AS regulation_number,
    CASE WHEN c.submission_type_id = '2' THEN 1 ELSE 0 END AS pma_approval,
    CASE WHEN c.submission_type_id = '1' THEN 1 ELSE 0 END AS "510k_approval",
    count(e.event_id) AS num_events
  FROM devices_a d JOIN events_a e ON e.event_id = d.event_id
    LEFT JOIN classes c ON lower(c.device_name) = lower(d.openfda_device_name) GROUP BY ALL)
"""


@query(
    "jn4_prediction_features",
    f"WITH {B.EVENTS_SQL}, {CLASSES_SQL}, {DEVICE_FEATURES_SQL} SELECT * FROM device_features",
)
def _(t):
    return device_features(*_event_side(t), _classes(t))


@query(
    "agg14_prediction_summary",
    f"""WITH {B.EVENTS_SQL}, {CLASSES_SQL}, {DEVICE_FEATURES_SQL}
SELECT product_code, device_class, regulation_number, pma_approval, "510k_approval",
  CAST(sum(num_events) AS BIGINT) AS total_events FROM device_features
WHERE product_code IS NOT NULL AND device_class IS NOT NULL AND regulation_number IS NOT NULL
GROUP BY ALL""",
)
def _(t):
    return prediction_summary(device_features(*_event_side(t), _classes(t)))


@query(
    "ml15_candidate_devices",
    f"""WITH {B.EVENTS_SQL} SELECT DISTINCT openfda_device_name AS device_name
FROM devices_a d JOIN events_a e ON d.event_id = e.event_id
WHERE openfda_medical_specialty_description <> '5-low'""",
)
def _(t):
    typed = B.events_of_orders(t).withColumn(
        "event_type", F.nullif("openfda_medical_specialty_description", F.lit("5-low"))
    )
    return candidate_devices(typed, B.devices_of_lines(t).drop("event_type"))


@query(
    "home_page_top_devices",
    f"""{B.INTEGRATED_SQL}, found AS (
  SELECT device_name, manufacturer_name, device_class, regulation_number,
    medical_specialty_description, CAST(sum(injury) AS BIGINT) AS injuries,
    count(device_name) AS records
  FROM integrated WHERE regexp_matches(coalesce(manufacturer_name, ''), '(?i)supplier 0*[1-9]')
  GROUP BY ALL)
SELECT * FROM found ORDER BY injuries DESC NULLS LAST, device_name NULLS LAST,
  manufacturer_name NULLS LAST, device_class NULLS LAST, regulation_number NULLS LAST,
  medical_specialty_description NULLS LAST, records LIMIT 20""",
)
def _(t):
    from devigil.landing import Landing
    from devigil.operators.reports import top_entities
    from devigil.session import broadcast_if_small

    # both views read what is integrated once, and what either shuffles goes before the next
    store = Landing(t.spark, "home-page", release=True)
    columns = [f"`{c}`" for c in marts.mart_columns()]
    integrated = store.land(B.integrated(t).select(*columns), "integrated")
    parts = B.mart_parts(t)
    found = marts.manufacturer_view(integrated, parts)
    makers = store.land(search(found, "manufacturer_name", "supplier 0*[1-9]"), "makers")
    makers = broadcast_if_small(makers.select("manufacturer_name"), MAKERS_BYTES)
    devices = restrict_to(marts.device_view(integrated, parts), makers, "manufacturer_name")
    shown = devices.select(*marts.DEVICE_KEYS, "injuries", "records")
    return top_entities(shown, "device_name", "injuries", 20)
