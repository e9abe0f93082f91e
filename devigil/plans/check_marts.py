"""Registered queries: harmonization, marts, counts, rankings and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from devigil.operators import marts
from devigil.operators.harmonize import display_types, one_hot, one_hot_rows, union_sources
from devigil.operators.reports import (
    count_by,
    distinct_union,
    joined_counts,
    latest,
    newest_first,
    summarize_by,
    top_categories,
    top_entities,
)
from devigil.plans import bindings as B
from devigil.plans.registry import query

SUMS_SQL = """
  CAST(sum(death) AS BIGINT) AS deaths, CAST(sum(injury) AS BIGINT) AS injuries,
  CAST(sum(malfunction) AS BIGINT) AS malfunctions, CAST(sum(other) AS BIGINT) AS other,
  CAST(sum(recall) AS BIGINT) AS recalls
"""
DEVICE_SQL = f"""
device_mart AS (
  SELECT device_name, manufacturer_name, device_class, regulation_number,
    medical_specialty_description, {SUMS_SQL},
    CAST(least(sum("1"), 1) AS BIGINT) AS class_1,
    CAST(least(sum("2"), 1) AS BIGINT) AS class_2,
    CAST(least(sum("3"), 1) AS BIGINT) AS class_3,
    count(device_name) AS records, count(DISTINCT pma_number) AS pma_submissions,
    count(DISTINCT k_number) AS k_submissions
  FROM integrated GROUP BY ALL)
"""
ADDRESS = ", ".join(marts.ADDRESS)


@query(
    "agg6_integrated_sources",
    B.INTEGRATED_SQL
    + """
SELECT source, event_type, device_class, count(*) AS row_count,
  count(DISTINCT device_name) AS devices, count(DISTINCT manufacturer_name) AS manufacturers,
  count(manufacturer_postal_code) AS postal_codes, count(manufacturer_street) AS streets,
  count(manufacturer_state) AS states, count(event_status) AS statuses,
  min(event_status) AS first_status, max(granular_name) AS last_granular,
  count(event_date) AS dates, max(k_number) AS last_k
FROM integrated GROUP BY source, event_type, device_class""",
)
def _(t):
    return (
        B.integrated(t)
        .groupBy("source", "event_type", "device_class")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct("device_name").alias("devices"),
            F.count_distinct("manufacturer_name").alias("manufacturers"),
            F.count("manufacturer_postal_code").alias("postal_codes"),
            F.count("manufacturer_street").alias("streets"),
            F.count("manufacturer_state").alias("states"),
            F.count("event_status").alias("statuses"),
            F.min("event_status").alias("first_status"),
            F.max("granular_name").alias("last_granular"),
            F.count("event_date").alias("dates"),
            F.max("k_number").alias("last_k"),
        )
    )


@query(
    "agg5_one_hot",
    """
SELECT user_id, CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS BIGINT) AS signup,
  CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchase,
  CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS error,
  CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS "view",
  CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS click
FROM events GROUP BY user_id""",
)
def _(t):
    values = ("signup", "purchase", "error", "view", "click")
    flags = one_hot(t.events, {"event_type": values})
    return flags.groupBy("user_id").agg(*[F.sum(v).alias(v) for v in values])


THREE_PIVOTS = {
    "event_type": ("death", "injury", "not provided"),
    "device_class": ("1", "2"),
    "medical_specialty_description": ("1 urgent", "2 high", "3 medium"),
}
_PIVOT_SUMS = ", ".join(
    [
        f"CAST(sum(CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END) AS BIGINT) AS \"{c}_{v}\""
        for c, values in THREE_PIVOTS.items()
        for v in values
    ]
    + [
        f"CAST(sum(CASE WHEN {c} NOT IN {values} THEN 1 ELSE 0 END) AS BIGINT) AS {c}_undeclared"
        for c, values in THREE_PIVOTS.items()
    ]
)


@query(
    "agg5_three_pivots",
    f"{B.INTEGRATED_SQL} SELECT source, {_PIVOT_SUMS} FROM united GROUP BY source",
)
def _(t):
    flags = one_hot(union_sources(B.sources(t)), THREE_PIVOTS, prefix=True)
    names = [f"{c}_{v}" for c, values in THREE_PIVOTS.items() for v in values]
    names += [f"{c}_undeclared" for c in THREE_PIVOTS]
    return flags.groupBy("source").agg(*[F.sum(f"`{n}`").alias(n) for n in names])


@query(
    "agg5_open_domains",
    f"""{B.INTEGRATED_SQL}, long AS (
  SELECT source, 'event_type' AS "column", event_type AS value FROM united UNION ALL
  SELECT source, 'medical_specialty_description', medical_specialty_description FROM united)
SELECT source, "column", value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY ALL""",
)
def _(t):
    columns = ("event_type", "medical_specialty_description")
    long = one_hot_rows(union_sources(B.sources(t)), "source", columns)
    return long.groupBy("source", "column", "value").agg(F.count(F.lit(1)).alias("n"))


@query("agg1_device_mart", f"{B.INTEGRATED_SQL}, {DEVICE_SQL} SELECT * FROM device_mart")
def _(t):
    return marts.device_mart(B.integrated(t), B.mart_parts(t))


@query(
    "agg2_manufacturer_mart",
    f"""{B.INTEGRATED_SQL}, {DEVICE_SQL}, numbers AS (
  SELECT manufacturer_name, count(DISTINCT pma_number) AS pma_submissions,
    count(DISTINCT k_number) AS k_submissions FROM integrated GROUP BY 1),
summed AS (
  SELECT manufacturer_name, CAST(sum(deaths) AS BIGINT) AS deaths,
    CAST(sum(injuries) AS BIGINT) AS injuries, CAST(sum(malfunctions) AS BIGINT) AS malfunctions,
    CAST(sum(other) AS BIGINT) AS other, CAST(sum(recalls) AS BIGINT) AS recalls,
    CAST(sum(class_1) AS BIGINT) AS num_class_1_devices,
    CAST(sum(class_2) AS BIGINT) AS num_class_2_devices,
    CAST(sum(class_3) AS BIGINT) AS num_class_3_devices,
    count(DISTINCT device_name) AS unique_devices
  FROM device_mart GROUP BY 1)
SELECT s.*, n.pma_submissions, n.k_submissions FROM summed s JOIN numbers n
  ON s.manufacturer_name IS NOT DISTINCT FROM n.manufacturer_name""",
)
def _(t):
    return marts.manufacturer_mart(B.integrated(t), parts=B.mart_parts(t))


@query(
    "agg2_manufacturer_mart_compat",
    f"""{B.INTEGRATED_SQL}, {DEVICE_SQL}
SELECT manufacturer_name, CAST(sum(deaths) AS BIGINT) AS deaths,
  CAST(sum(injuries) AS BIGINT) AS injuries, CAST(sum(malfunctions) AS BIGINT) AS malfunctions,
  CAST(sum(other) AS BIGINT) AS other, CAST(sum(recalls) AS BIGINT) AS recalls,
  CAST(sum(class_1) AS BIGINT) AS num_class_1_devices,
  CAST(sum(class_2) AS BIGINT) AS num_class_2_devices,
  CAST(sum(class_3) AS BIGINT) AS num_class_3_devices,
  count(DISTINCT device_name) AS unique_devices,
  count(DISTINCT pma_submissions) AS pma_submissions,
  count(DISTINCT k_submissions) AS k_submissions
FROM device_mart GROUP BY 1""",
)
def _(t):
    return marts.manufacturer_mart(B.integrated(t), compat=True, parts=B.mart_parts(t))


FLAGS_SQL = """
  CAST(sum(DISTINCT "1") AS BIGINT) AS class_1, CAST(sum(DISTINCT "2") AS BIGINT) AS class_2,
  CAST(sum(DISTINCT "3") AS BIGINT) AS class_3
"""


@query(
    "agg3_device_view",
    f"""{B.INTEGRATED_SQL}
SELECT device_name, manufacturer_name, device_class, regulation_number,
  medical_specialty_description, {SUMS_SQL}, {FLAGS_SQL}, count(device_name) AS records,
  count(DISTINCT pma_number) AS pma_submissions, count(DISTINCT k_number) AS k_submissions
FROM integrated GROUP BY ALL""",
)
def _(t):
    marts.create_views(B.integrated(t), B.mart_parts(t))
    return t.spark.table("integrated_device_view")


@query(
    "agg3_manufacturer_view",
    f"""{B.INTEGRATED_SQL}
SELECT manufacturer_name, {SUMS_SQL}, {FLAGS_SQL}, count(DISTINCT device_name) AS unique_devices,
  count(DISTINCT pma_number) AS pma_submissions, count(DISTINCT k_number) AS k_submissions
FROM integrated GROUP BY ALL""",
)
def _(t):
    marts.create_views(B.integrated(t), B.mart_parts(t))
    return t.spark.table("integrated_manufacturer_view")


@query("agg4_address_mart", f"{B.INTEGRATED_SQL} SELECT DISTINCT {ADDRESS} FROM integrated")
def _(t):
    return marts.address_mart(B.integrated(t))


@query(
    "prj1_harmonized_submissions",
    B.INTEGRATED_SQL + " SELECT * FROM united",
)
def _(t):
    return union_sources(B.sources(t)).withColumn("event_date", F.col("event_date").cast("string"))


@query(
    "prj2_pruned_columns",
    f"WITH {B.EVENTS_SQL} SELECT openfda_device_name, event_type, manufacturer_d_country, "
    "CAST(date_of_event AS VARCHAR) AS date_of_event FROM devices_a",
)
def _(t):
    return B.devices_of_lines(t).select(
        "openfda_device_name",
        "event_type",
        "manufacturer_d_country",
        F.col("date_of_event").cast("string").alias("date_of_event"),
    )


@query(
    "prj3_display_types",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
    "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority FROM orders",
)
def _(t):
    return display_types(t.orders)


@query(
    "prj4_derived_flags",
    f"""WITH {B.EVENTS_SQL},
r AS (SELECT openfda_regulation_number AS number, count(*) AS n FROM recalls_a GROUP BY 1)
SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 1 ELSE 0 END AS pma_approval,
  CASE WHEN p_type = 'ECONOMY' THEN 1 ELSE 0 END AS "510k_approval",
  CASE WHEN coalesce(n, 0) > 0 THEN 1 ELSE 0 END AS recall
FROM part LEFT JOIN r ON CAST(p_size AS VARCHAR) = number""",
)
def _(t):
    from devigil.operators.harmonize import approval_flags
    from devigil.operators.models import recall_counts

    kind = F.when(F.col("p_type") == "PROMO", "2").when(F.col("p_type") == "ECONOMY", "1")
    recalls = recall_counts(B.recalls_of_orders(t), "openfda_regulation_number")
    number = F.col("p_size").cast("string")
    return (
        t.part.join(recalls, number == F.col("openfda_regulation_number"), "left")
        .withColumns(approval_flags(kind))
        .select(
            "p_partkey",
            "pma_approval",
            "510k_approval",
            (F.coalesce("recall_count", F.lit(0)) > 0).cast("int").alias("recall"),
        )
    )


# --- joins --------------------------------------------------------------------------------------


@query(
    "jn1_events_devices",
    f"""WITH {B.EVENTS_SQL}
SELECT openfda_device_class, event_type, manufacturer_d_country, count(*) AS row_count,
  CAST(min(date_received) AS VARCHAR) AS first_received,
  CAST(max(date_of_event) AS VARCHAR) AS last_event
FROM events_a e JOIN devices_a d ON e.event_id = d.event_id GROUP BY 1, 2, 3""",
)
def _(t):
    from devigil.operators.harmonize import join_events

    return (
        join_events(B.events_of_orders(t), B.devices_of_lines(t))
        .groupBy("openfda_device_class", "event_type", "manufacturer_d_country")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min("date_received").cast("string").alias("first_received"),
            F.max("date_of_event").cast("string").alias("last_event"),
        )
    )


@query(
    "jn3_recall_counts_left",
    f"""WITH {B.EVENTS_SQL},
r AS (SELECT lower(country) AS name, count(*) AS recall_count FROM recalls_a GROUP BY 1)
SELECT s_suppkey, n_name, coalesce(recall_count, 0) AS recall_count,
  CASE WHEN coalesce(recall_count, 0) > 0 THEN 1 ELSE 0 END AS recall
FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN r ON lower(n_name) = name""",
)
def _(t):
    from devigil.operators.models import recall_counts

    recalls = B.recalls_of_orders(t).select(F.lower("country").alias("name"))
    makers = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return makers.join(
        recall_counts(recalls, "name"), F.lower("n_name") == F.col("name"), "left"
    ).select(
        "s_suppkey",
        "n_name",
        F.coalesce("recall_count", F.lit(0)).alias("recall_count"),
        (F.coalesce("recall_count", F.lit(0)) > 0).cast("int").alias("recall"),
    )


@query(
    "jn5_manufacturer_counts",
    f"""WITH {B.EVENTS_SQL},
a AS (SELECT lower(manufacturer_d_country) AS name, count(*) AS event_counts
  FROM devices_a GROUP BY 1),
b AS (SELECT lower(country) AS name, count(*) AS recall_counts FROM recalls_a GROUP BY 1)
SELECT a.name, event_counts, recall_counts FROM a JOIN b ON a.name = b.name""",
)
def _(t):
    return joined_counts(
        B.devices_of_lines(t), "manufacturer_d_country", B.recalls_of_orders(t), "country"
    )


# --- counts, rankings, sorting ------------------------------------------------------------------


@query(
    "agg7_count_by_category",
    "SELECT o_orderpriority, o_orderstatus, count(*) AS \"count\" FROM orders GROUP BY 1, 2",
)
def _(t):
    return count_by(t.orders, "o_orderpriority", "o_orderstatus", ordered=True)


@query(
    "agg7_summary_by_category",
    """SELECT event_type, count(*) AS "count", round(sum(value), 2) AS total,
  round(avg(value), 6) AS average FROM events GROUP BY 1""",
)
def _(t):
    rows = summarize_by(t.events, "event_type", "value")
    return rows.withColumns({"total": F.round("total", 2), "average": F.round("average", 6)})


@query(
    "agg8_top_firms",
    """SELECT c_name, count(*) AS "count" FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def _(t):
    firms = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return top_categories(firms, "c_name")


@query(
    "agg8_top_firms_keep_null",
    """SELECT nullif(n_name, 'NATION_3') AS firm, count(*) AS "count"
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY 1 ORDER BY 2 DESC, 1 NULLS LAST LIMIT 10""",
)
def _(t):
    firms = B.recalls_of_orders(t).select(
        F.nullif(F.col("country"), F.lit("NATION_3")).alias("firm")
    )
    return top_categories(firms, "firm", keep_null=True)


@query(
    "agg12_recalls_per_device",
    f"WITH {B.EVENTS_SQL} SELECT openfda_device_name, count(*) AS recall_count FROM recalls_a "
    "GROUP BY 1",
)
def _(t):
    from devigil.operators.models import recall_counts

    return recall_counts(B.recalls_of_orders(t))


@query(
    "srt1_newest_first",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders
ORDER BY orders.o_orderdate DESC NULLS FIRST""",
)
def _(t):
    rows = newest_first(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", True)
    return rows.withColumn("o_orderdate", F.col("o_orderdate").cast("date").cast("string"))


@query(
    "srt2_top_entities",
    f"""{B.INTEGRATED_SQL}, {DEVICE_SQL}
SELECT manufacturer_name, CAST(sum(deaths) AS BIGINT) AS deaths FROM device_mart
GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 NULLS LAST LIMIT 20""",
)
def _(t):
    makers = marts.manufacturer_view(B.integrated(t)).select("manufacturer_name", "deaths")
    return top_entities(makers, "manufacturer_name", "deaths", 20)


@query(
    "srt3_latest_records",
    """SELECT o_custkey, o_orderstatus, o_totalprice,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate
FROM orders ORDER BY orders.o_orderdate DESC, o_orderkey LIMIT 100""",
)
def _(t):
    rows = latest(
        t.orders, "o_orderdate", tie_break=["o_orderkey"], drop=["o_orderkey", "o_orderpriority"]
    )
    return rows.withColumn("o_orderdate", F.col("o_orderdate").cast("date").cast("string"))


@query(
    "set1_distinct_pairs",
    f"""WITH {B.EVENTS_SQL}
SELECT manufacturer_d_name AS manufacturer_name, openfda_device_name AS device_name FROM devices_a
UNION SELECT recalling_firm, openfda_device_name FROM recalls_a""",
)
def _(t):
    a = B.devices_of_lines(t).select(
        F.col("manufacturer_d_name").alias("manufacturer_name"),
        F.col("openfda_device_name").alias("device_name"),
    )
    b = B.recalls_of_orders(t).select(
        F.col("recalling_firm").alias("manufacturer_name"),
        F.col("openfda_device_name").alias("device_name"),
    )
    return distinct_union(a, b)


@query(
    "set2_union_all",
    """SELECT kind, count(*) AS n, round(sum(balance), 2) AS balance FROM (
  SELECT 'customer' AS kind, c_acctbal AS balance FROM customer
  UNION ALL SELECT 'supplier', s_acctbal FROM supplier) GROUP BY 1""",
)
def _(t):
    both = t.customer.select(
        F.lit("customer").alias("kind"), F.col("c_acctbal").alias("balance")
    ).unionByName(
        t.supplier.select(F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("kind"))
    )
    return both.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("balance"), 2).alias("balance")
    )


@query(
    "set3_distinct_facts",
    f"""WITH {B.EVENTS_SQL}
SELECT DISTINCT event_type, openfda_device_name, openfda_regulation_number FROM devices_a
WHERE event_type IS NOT NULL""",
)
def _(t):
    facts = B.devices_of_lines(t).filter(F.col("event_type").isNotNull())
    return facts.select(
        "event_type", "openfda_device_name", "openfda_regulation_number"
    ).distinct()


@query(
    "set4_name_union",
    "SELECT lower(c_name) AS name FROM customer UNION SELECT lower(s_name) FROM supplier",
)
def _(t):
    return distinct_union(
        t.customer.select(F.lower("c_name").alias("name")),
        t.supplier.select(F.lower("s_name").alias("name")),
    )
