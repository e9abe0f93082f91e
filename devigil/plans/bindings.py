"""The given tables seen as medical-device sources, for Spark and for the SQL checks.

Orders with their lines play events with their devices, orders with their customers recalls, parts
premarket approvals and suppliers 510(k) submissions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devigil.operators.harmonize import CANONICALS, MAPPINGS, PIVOTS, integrate
from devigil.plans.registry import Tables
from devigil.session import parts_for

# integrated rows that a task of a mart sums up
FACTS_PER_PART = 250_000


def device_class_of(status):
    return F.when(status == "F", "1").when(status == "O", "2").otherwise("3")


def events_of_orders(t: Tables) -> DataFrame:
    """The event side: one row per order."""
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("event_id"),
        device_class_of(F.col("o_orderstatus")).alias("openfda_device_class"),
        F.lower("o_orderpriority").alias("openfda_medical_specialty_description"),
        F.col("o_orderdate").cast("date").alias("date_received"),
    )


def devices_of_lines(t: Tables) -> DataFrame:
    """The device side: one row per order line."""
    event_type = (
        F.when(F.col("l_returnflag") == "R", "death")
        .when(F.col("l_returnflag") == "A", "injury (in)")
        .when(F.col("l_linestatus") == "O", "malfunction")
        .when(F.col("l_tax") == 0, "not provided")
        .otherwise("other")
    )
    makers = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(makers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("l_orderkey").cast("string").alias("event_id"),
            F.col("p_name").alias("openfda_device_name"),
            F.col("p_brand").alias("brand_name"),
            F.col("p_type").alias("generic_name"),
            event_type.alias("event_type"),
            F.col("l_shipdate").cast("date").alias("date_of_event"),
            F.array("l_returnflag", "l_linestatus").alias("remedial_action"),
            F.col("s_name").alias("manufacturer_d_name"),
            F.concat(F.col("s_suppkey").cast("string"), F.lit(" Main St.")).alias(
                "manufacturer_d_address_1"
            ),
            F.col("n_name").alias("manufacturer_d_city"),
            F.col("n_regionkey").cast("string").alias("manufacturer_d_state"),
            F.lpad(F.col("s_suppkey").cast("string"), 5, "0").alias("manufacturer_d_postal_code"),
            F.col("n_name").alias("manufacturer_d_country"),
            F.col("p_size").cast("string").alias("openfda_regulation_number"),
        )
    )


def recalls_of_orders(t: Tables) -> DataFrame:
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").cast("string").alias("id"),
            F.col("c_mktsegment").alias("openfda_device_name"),
            F.substring("o_orderpriority", 1, 1).alias("openfda_device_class"),
            F.col("c_name").alias("recalling_firm"),
            F.col("c_custkey").cast("string").alias("firm_fei_number"),
            F.array(
                F.concat(F.lit("k"), F.col("c_custkey")), F.concat(F.lit("k"), F.col("c_nationkey"))
            ).alias("openfda_k_number"),
            F.col("o_orderstatus").alias("recall_status"),
            F.col("o_orderdate").cast("date").alias("event_date_initiated"),
            F.col("o_orderdate").cast("date").alias("event_date_posted"),
            F.lit(None).cast("string").alias("address_1"),
            F.col("n_name").alias("city"),
            F.lit("").alias("state"),
            F.col("c_nationkey").cast("string").alias("postal_code"),
            F.col("n_name").alias("country"),
            F.col("c_nationkey").cast("string").alias("openfda_regulation_number"),
            F.col("c_custkey").cast("string").alias("product_quantity"),
            F.col("o_orderpriority").alias("root_cause_description"),
            F.lower("o_orderpriority").alias("openfda_medical_specialty_description"),
        )
    )


def approvals_of_parts(t: Tables) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return t.part.select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("openfda_device_name"),
        F.col("p_brand").alias("trade_name"),
        F.col("p_type").alias("generic_name"),
        F.lit("3").alias("openfda_device_class"),
        F.col("p_brand").alias("applicant"),
        F.concat(F.lit("P"), F.col("p_partkey")).alias("pma_number"),
        F.col("p_type").alias("decision_code"),
        nothing.alias("decision_date"),
        nothing.alias("street_1"),
        nothing.alias("city"),
        nothing.alias("state"),
        nothing.alias("zip"),
        F.col("p_size").cast("string").alias("openfda_regulation_number"),
        nothing.alias("openfda_medical_specialty_description"),
    )


def submissions_of_suppliers(t: Tables) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").cast("string").alias("id"),
        F.col("n_name").alias("openfda_device_name"),
        F.lit("2").alias("openfda_device_class"),
        F.col("s_name").alias("applicant"),
        F.concat(F.lit("K"), F.col("s_suppkey")).alias("k_number"),
        F.lit("SESE").alias("decision_code"),
        nothing.alias("decision_date"),
        nothing.alias("address_1"),
        F.col("n_name").alias("city"),
        nothing.alias("state"),
        F.col("s_nationkey").cast("string").alias("postal_code"),
        F.col("n_name").alias("country_code"),
        nothing.alias("openfda_regulation_number"),
        nothing.alias("openfda_medical_specialty_description"),
    )


def device_events(t: Tables) -> DataFrame:
    return events_of_orders(t).drop("date_received").join(devices_of_lines(t), "event_id")


def sources(t: Tables) -> dict[str, DataFrame]:
    return {
        "device_events": device_events(t),
        "recall": recalls_of_orders(t),
        "pma_submission": approvals_of_parts(t),
        "submission": submissions_of_suppliers(t),
    }


def integrated(t: Tables) -> DataFrame:
    return integrate(sources(t))


def mart_parts(t: Tables) -> int:
    """Parts of the integrated rows for a mart; the tables are counted from their footers."""
    facts = (t.lineitem, t.orders, t.part, t.supplier)
    return sum(parts_for(table, FACTS_PER_PART) for table in facts)


# --- the same in SQL ----------------------------------------------------------------------------


def clean(expression: str) -> str:
    return (
        f"nullif(trim(lower(regexp_replace({expression}, '[^a-zA-Z0-9]+', ' ', 'g'))), '')"
    )


EVENTS_SQL = """
events_a AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS event_id,
    CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' ELSE '3' END AS openfda_device_class,
    lower(o_orderpriority) AS openfda_medical_specialty_description,
    CAST(o_orderdate AS DATE) AS date_received
  FROM orders),
devices_a AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS event_id, p_name AS openfda_device_name,
    p_brand AS brand_name, p_type AS generic_name,
    CASE WHEN l_returnflag = 'R' THEN 'death' WHEN l_returnflag = 'A' THEN 'injury (in)'
      WHEN l_linestatus = 'O' THEN 'malfunction' WHEN l_tax = 0 THEN 'not provided'
      ELSE 'other' END AS event_type,
    CAST(l_shipdate AS DATE) AS date_of_event,
    l_returnflag || ',' || l_linestatus AS remedial_action, s_name AS manufacturer_d_name,
    CAST(s_suppkey AS VARCHAR) || ' Main St.' AS manufacturer_d_address_1,
    n_name AS manufacturer_d_city, CAST(n_regionkey AS VARCHAR) AS manufacturer_d_state,
    lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS manufacturer_d_postal_code,
    n_name AS manufacturer_d_country, CAST(p_size AS VARCHAR) AS openfda_regulation_number
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey),
recalls_a AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, c_mktsegment AS openfda_device_name,
    substr(o_orderpriority, 1, 1) AS openfda_device_class, c_name AS recalling_firm,
    CAST(c_custkey AS VARCHAR) AS firm_fei_number,
    'k' || c_custkey || ',k' || c_nationkey AS openfda_k_number, o_orderstatus AS recall_status,
    CAST(o_orderdate AS DATE) AS event_date_posted, n_name AS city,
    CAST(c_nationkey AS VARCHAR) AS postal_code, n_name AS country,
    CAST(c_nationkey AS VARCHAR) AS openfda_regulation_number,
    CAST(c_custkey AS VARCHAR) AS product_quantity, o_orderpriority AS root_cause_description,
    lower(o_orderpriority) AS openfda_medical_specialty_description
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
"""


def _canonical_select(values: dict[str, str], source: str, rows: str) -> str:
    out = []
    for name, cleaned in CANONICALS.items():
        if name == "source":
            value = f"'{source}'"
        else:
            value = values.get(name, "CAST(NULL AS VARCHAR)")
            value = clean(value) if cleaned and name in values else f"nullif({value}, '')"
        out.append(f"{value} AS {name}")
    return f"SELECT {', '.join(out)} FROM {rows}"


def _integrated_sql() -> str:
    def mapped(source: str, known: dict[str, str]) -> dict[str, str]:
        return {
            canonical: known[raw] for raw, canonical in MAPPINGS[source].items() if raw in known
        }

    event_columns = {
        raw: raw for raw in MAPPINGS["device_events"] if raw not in ("event_id", "date_of_event")
    }
    event_columns["event_id"] = "d.event_id"
    event_columns["date_of_event"] = "CAST(date_of_event AS VARCHAR)"
    event_columns["event_type"] = (
        "CASE WHEN event_type LIKE 'injury%' THEN 'injury' ELSE event_type END"
    )
    recall_columns = {
        raw: raw
        for raw in MAPPINGS["recall"]
        if raw not in ("source", "event_date_initiated", "address_1", "state")
    }
    recall_columns["event_date_initiated"] = "CAST(event_date_posted AS VARCHAR)"
    recall_columns["source"] = "'recall'"
    approval_columns = {
        "id": "CAST(p_partkey AS VARCHAR)",
        "openfda_device_name": "p_name",
        "trade_name": "p_brand",
        "generic_name": "p_type",
        "openfda_device_class": "'3'",
        "applicant": "p_brand",
        "pma_number": "'P' || p_partkey",
        "decision_code": "p_type",
        "openfda_regulation_number": "CAST(p_size AS VARCHAR)",
    }
    submission_columns = {
        "id": "CAST(s_suppkey AS VARCHAR)",
        "openfda_device_name": "n_name",
        "openfda_device_class": "'2'",
        "applicant": "s_name",
        "k_number": "'K' || s_suppkey",
        "decision_code": "'SESE'",
        "city": "n_name",
        "postal_code": "CAST(s_nationkey AS VARCHAR)",
        "country_code": "n_name",
    }
    parts = [
        _canonical_select(
            mapped("device_events", event_columns),
            "device_events",
            "events_a e JOIN devices_a d ON e.event_id = d.event_id",
        ),
        _canonical_select(mapped("recall", recall_columns), "recall", "recalls_a"),
        _canonical_select(mapped("pma_submission", approval_columns), "pma_submission", "part"),
        _canonical_select(
            mapped("submission", submission_columns),
            "submission",
            "supplier JOIN nation ON s_nationkey = n_nationkey",
        ),
    ]
    flags = ", ".join(
        f"CASE WHEN {column} = '{value}' THEN 1 ELSE 0 END AS \"{value}\""
        for column, values in PIVOTS.items()
        for value in values
    )
    flags += "".join(
        f", CASE WHEN {column} NOT IN {values} THEN 1 ELSE 0 END AS {column}_undeclared"
        for column, values in PIVOTS.items()
    )
    union = " UNION ALL ".join(parts)
    return f"united AS ({union}), integrated AS (SELECT *, {flags} FROM united)"


INTEGRATED_SQL = f"WITH {EVENTS_SQL}, {_integrated_sql()}"
