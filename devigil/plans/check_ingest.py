"""Registered queries: routing, flattening, unnesting, normalization, rules, keys, sampling."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devigil.functions import text as X
from devigil.operators.quality import (
    REASONS,
    split_by_parent,
    split_by_rules,
    split_first_per_key,
)
from devigil.operators.sampling import (
    sample_percent_column,
    sample_to_target,
    sample_with_children,
)
from devigil.plans.registry import query
from devigil.session import ensure_checkpoint_dir
from devigil.sources.envelopes import record_texts, split_records
from devigil.sources.exports import (
    FILE,
    POSITION,
    explode_child,
    flatten,
    load_flat,
    records_of_lines,
    records_of_text,
    route,
    surrogate_key,
    wanted_name,
)
from devigil.sources.increments import StoredTable
from devigil.sources.parquet_blocks import sample_blocks
from devigil.sources.reference_files import (
    RULES_DDL,
    flatten_rules,
    gazetteer_of_text,
    medical_specialties,
)
from devigil.sources.schemas import MEDICAL_SPECIALTIES, TableSpec, flat_record

# --- routing and reading ------------------------------------------------------------------------

MARKERS = (("://m.", "mobile"), ("page=", "paged"), ("example.org", "organisation"))


@query(
    "ing1_ing2_route_paths",
    """SELECT CASE WHEN contains(url, '://m.') THEN 'mobile' WHEN contains(url, 'page=') THEN 'paged'
  WHEN contains(url, 'example.org') THEN 'organisation' ELSE 'unrecognized' END AS feed,
  count(*) AS files, min(page_id) AS first_page
FROM pages WHERE NOT contains(regexp_extract(url, '[^/]*$'), 'zip')
  AND NOT contains(regexp_extract(url, '[^/]*$'), 'top') GROUP BY 1""",
)
def _(t):
    name = F.element_at(F.split("url", "/"), -1)
    kept = t.pages.filter(wanted_name(name, ("zip", "top")))
    return kept.groupBy(route(F.col("url"), MARKERS).alias("feed")).agg(
        F.count(F.lit(1)).alias("files"), F.min("page_id").alias("first_page")
    )


#: Orders as exported records: a date in either spelling, one bad date, a status out of its domain.
ORDER_SPEC = TableSpec(
    "orders",
    """o_orderkey bigint, placed date, total double, priority varchar(8), status string,
    flags array<string>, openfda_device_class string, absent string""",
    "order_id",
    "o_orderkey",
    unique=("o_orderkey",),
    domains={"status": ("f", "o")},
    renamed={"placed": "date_placed"},
)


def _order_files(t):
    """``source_file, text``: an envelope with the orders of each customer, some of them twice."""
    flags = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sort_array(F.collect_list("l_returnflag")).alias("flags")
    )
    day = F.date_format("o_orderdate", "yyyyMMdd")
    record = F.struct(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(F.col("o_orderkey") % 11 == 0, "20241301")
        .when(F.col("o_orderkey") % 2 == 0, day)
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("date_placed"),
        F.when(F.col("o_orderkey") % 13 == 0, "NULL")
        .when(F.col("o_orderkey") % 17 == 0, "many")
        .otherwise(F.round("o_totalprice", 2).cast("string"))
        .alias("total"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        "flags",
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(None))
        .otherwise(F.struct(F.col("o_orderstatus").alias("device_class")))
        .alias("openfda"),
    )
    orders = t.orders.join(flags, "o_orderkey", "left")
    twice = F.when(F.col("o_orderkey") % 19 == 0, F.array(record, record)).otherwise(F.array(record))
    files = orders.groupBy("o_custkey").agg(F.flatten(F.sort_array(F.collect_list(twice))).alias("results"))
    return files.select(
        F.col("o_custkey").cast("string").alias(FILE), F.to_json(F.struct("results")).alias("text")
    )


ORDER_RULES_SQL = """
flags AS (SELECT l_orderkey, list_sort(list(l_returnflag)) AS flags FROM lineitem GROUP BY 1),
raw AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS placed,
    CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 THEN NULL ELSE round(o_totalprice, 2) END AS total,
    lower(o_orderpriority) AS priority, lower(o_orderstatus) AS status, flags,
    CASE WHEN o_orderkey % 3 <> 0 THEN lower(o_orderstatus) END AS openfda_device_class,
    list_filter(['too long: priority', 'bad date: placed', 'bad double: total', 'outside domain: status'],
      lambda r: (r = 'bad date: placed' AND o_orderkey % 11 = 0)
        OR (r = 'bad double: total' AND o_orderkey % 17 = 0 AND o_orderkey % 13 <> 0)
        OR (r = 'too long: priority' AND length(o_orderpriority) > 8)
        OR (r = 'outside domain: status' AND o_orderstatus NOT IN ('F', 'O'))) AS reasons
  FROM orders LEFT JOIN flags ON l_orderkey = o_orderkey),
copies AS (SELECT raw.*, unnest(range(CASE WHEN o_orderkey % 19 = 0 THEN 2 ELSE 1 END)) AS n FROM raw)
"""


@query(
    "ing3_ing4_nested_json",
    f"""WITH {ORDER_RULES_SQL} SELECT o_orderkey, placed, total, priority, status,
  array_to_string(flags, ',') AS flags, openfda_device_class, CAST(NULL AS VARCHAR) AS absent
FROM copies WHERE len(reasons) = 0 AND n = 0""",
)
def _(t):
    records = records_of_text(_order_files(t), "text", flat_record(ORDER_SPEC))
    accepted = load_flat(records, ORDER_SPEC).accepted
    names = [c.name for c in ORDER_SPEC.columns]
    return accepted.select(*names).withColumn("flags", F.array_join("flags", ","))


@query(
    "ing3_lines_layout",
    """SELECT lower(o_orderstatus) AS status, count(*) AS records, count(DISTINCT o_orderkey) AS orders,
  CAST(count(*) AS BIGINT) AS positions FROM (
    SELECT *, unnest(range(CASE WHEN o_orderkey % 19 = 0 THEN 2 ELSE 1 END)) FROM orders) GROUP BY 1""",
)
def _(t):
    lines = _order_files(t).select(
        FILE, F.explode(F.from_json("text", "results array<string>")["results"]).alias("line")
    )
    records = records_of_lines(lines, "line", flat_record(ORDER_SPEC))
    rows = records.select(FILE, POSITION, *flatten(ORDER_SPEC))
    return rows.groupBy("status").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("o_orderkey").alias("orders"),
        F.count_distinct(FILE, POSITION).alias("positions"),
    )


def _shared_folder(t, name: str) -> str:
    """A new folder that all executors share, for files that a query derives from the tables."""
    return f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: What stands around the records of an envelope: brackets, quotes and backslashes in strings as well.
ENVELOPE_START = '{"meta": {"results": {"total": 1}, "note": "a \\" [ { \\\\"}, "other": [{"x": 1}], "results": ['


def _write_envelopes(documents: DataFrame, folder: str) -> None:
    """``documents`` as envelopes, a file for every partition that Spark balances them into, so that files
    and tasks are as many as the rows need."""
    record = F.to_json(F.struct("doc_id", "text", F.struct("lang", "source", "n_chars").alias("openfda")))

    def enclosed(batches):
        yield pd.DataFrame({"value": [ENVELOPE_START]})
        comma = ""
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"value": [comma + batch["value"].iloc[0], *(", " + batch["value"].iloc[1:])]})
                comma = ", "
        yield pd.DataFrame({"value": ['], "end": "]}"}']})

    lines = documents.hint("rebalance").select(record.alias("value"))
    lines.mapInPandas(enclosed, "value string").write.text(folder)


@query(
    "ing3_split_envelopes",
    "SELECT doc_id, text, lang, source, n_chars FROM documents",
)
def _(t):
    folder = _shared_folder(t, "envelopes")
    _write_envelopes(t.documents, folder)
    kind = T.StructType.fromDDL(
        "doc_id bigint, text string, openfda struct<lang: string, source: string, n_chars: bigint>"
    )
    records = split_records(record_texts(t.spark, folder, "part-*", 256 << 10), kind, FILE, POSITION)
    return records.select("r.doc_id", "r.text", "r.openfda.*")


@query(
    "ing9_ing11_two_loads",
    """SELECT o_orderkey, k, CAST(o_orderkey % 2 AS INTEGER) AS load FROM (
  SELECT o_orderkey, k, row_number() OVER (PARTITION BY k ORDER BY o_orderkey % 2, o_orderdate, o_orderkey) AS n
  FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS k FROM orders))
WHERE k IS NULL OR n = 1""",
)
def _(t):
    keyed = t.orders.select(
        "o_orderkey",
        "o_orderdate",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k"),
        F.pmod("o_orderkey", F.lit(2)).cast("int").alias("load"),
    )
    store = StoredTable(t.spark, _shared_folder(t, "stored-orders"), ["k"], ["o_orderdate", "o_orderkey"])
    # the last load is a second run of the one before
    for number in (0, 1, 1):
        store.load(keyed.filter(F.col("load") == number), f"load {number}")
    return store.read().select("o_orderkey", "k", "load")


@query(
    "ing8_typed_load_rejects",
    f"""WITH {ORDER_RULES_SQL}, told AS (
  SELECT CASE WHEN len(reasons) > 0 THEN array_to_string(list_sort(reasons), '; ')
    WHEN n > 0 THEN 'duplicate o_orderkey' ELSE '' END AS reasons FROM copies)
SELECT reasons, count(*) AS row_count FROM told GROUP BY 1""",
)
def _(t):
    records = records_of_text(_order_files(t), "text", flat_record(ORDER_SPEC))
    accepted, rejected = load_flat(records, ORDER_SPEC)
    both = rejected.select(REASONS).unionByName(
        accepted.select(F.array().cast("array<string>").alias(REASONS))
    )
    told = F.array_join(F.sort_array(REASONS), "; ").alias("reasons")
    return both.groupBy(told).agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "ing14_rewrite_rules",
    """SELECT p_name AS original_name, p_brand AS normalized_name FROM (
  SELECT DISTINCT p_name, p_brand FROM part)""",
)
def _(t):
    edits = t.part.groupBy("p_brand").agg(F.sort_array(F.collect_set("p_name")).alias("from"))
    operations = edits.groupBy(F.substring("p_brand", 1, 7).alias("part")).agg(
        F.collect_list(F.struct("from", F.col("p_brand").alias("to"))).alias("edits")
    )
    text = operations.select(F.to_json(F.struct("edits")).alias("text"))
    return flatten_rules(text.select(F.from_json("text", RULES_DDL).alias("o")).select("o.*"))


@query(
    "ing13_gazetteer_rows",
    """SELECT 'US' AS country_code, lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS postal_code,
  s_name AS place_name, s_nationkey + 0.5 AS latitude, CAST(-s_suppkey AS DOUBLE) AS longitude
FROM supplier""",
)
def _(t):
    nothing = [F.lit("")] * 6
    fields = [
        F.lit(" US"),
        F.concat(F.lpad(F.col("s_suppkey").cast("string"), 5, "0"), F.lit(" ")),
        F.col("s_name"),
        *nothing,
        (F.col("s_nationkey") + 0.5).cast("string"),
        (-F.col("s_suppkey")).cast("string"),
        F.lit("4"),
    ]
    places = gazetteer_of_text(t.supplier.select(F.concat_ws("\t", *fields).alias("line")), "line")
    return places.select("country_code", "postal_code", "place_name", "latitude", "longitude")


@query(
    "ing5_ing6_unnest_children",
    r"""SELECT sha256(doc_id || chr(31) || source || chr(31) || (i - 1)) AS child_id,
  sha256(doc_id || chr(31) || source) AS parent_id, i - 1 AS position, line
FROM (SELECT doc_id, source, unnest(lines) AS line, generate_subscripts(lines, 1) AS i
  FROM (SELECT doc_id, source, string_split(text, chr(10)) AS lines FROM documents))""",
)
def _(t):
    parents = t.documents.select(
        "doc_id",
        "source",
        surrogate_key(F.col("doc_id"), F.col("source")).alias("parent_id"),
        F.split("text", "\n").alias("lines"),
    )
    children = parents.select(
        "doc_id", "source", "parent_id", F.posexplode("lines").alias("position", "line")
    )
    child = surrogate_key(F.col("doc_id"), F.col("source"), F.col("position"))
    return children.select(
        child.alias("child_id"),
        "parent_id",
        F.col("position").cast("bigint").alias("position"),
        "line",
    )


@query(
    "ing7_normalize_values",
    """SELECT conv_id, turn, nullif(lower(role), 'system') AS role,
  CASE WHEN text IN ('', '\\', 'NULL') THEN NULL
    ELSE lower(regexp_replace(regexp_replace(text, '^[\\s\\x1c-\\x1f\\x{85}\\x{a0}]+', ''),
      '[\\s\\x1c-\\x1f\\x{85}\\x{a0}]+$', '')) END AS normalized,
  array_to_string(list_transform(list_filter(string_split(text, ' '), lambda w: w <> ''),
    lambda w: trim(w, chr(10) || chr(13) || chr(9) || ' ')), '|') AS items
FROM conversations""".replace("\\\\", "\\"),
)
def _(t):
    return t.conversations.select(
        "conv_id",
        "turn",
        F.nullif(X.normalize_scalar(F.col("role")), F.lit("system")).alias("role"),
        X.normalize_scalar(F.col("text")).alias("normalized"),
        F.array_join(X.normalize_array(F.split("text", " ")), "|").alias("items"),
    )


@query(
    "ing7b_normalize_for_copy",
    r"""SELECT page_id, CASE WHEN html IN ('', '\') THEN NULL
  ELSE replace(replace(replace(replace(html, '\', '\\'), chr(9), ' '), chr(10), ' '),
    chr(13), '') END AS flat FROM pages""",
)
def _(t):
    return t.pages.select("page_id", X.normalize_for_copy(F.col("html")).alias("flat"))


@query(
    "ing7c_trailing_backslashes",
    r"""SELECT doc_id, rtrim(text || CASE WHEN lang = 'en' THEN '\\' ELSE '' END, '\') AS narrative
FROM documents""",
)
def _(t):
    narrative = F.concat("text", F.when(F.col("lang") == "en", "\\\\").otherwise(""))
    return t.documents.select(
        "doc_id", X.drop_trailing_backslashes(narrative).alias("narrative")
    )


# --- rules, keys, references --------------------------------------------------------------------


def _line_rules():
    return {
        "bad discount": ~F.col("l_discount").between(0.0, 0.08),
        "too long: l_returnflag": F.length("l_returnflag") > 1,
        "outside domain: l_returnflag": ~F.lower("l_returnflag").isin("a", "r"),
        "bad bigint: l_quantity": F.col("l_quantity").cast("string").try_cast("date").isNotNull(),
    }


@query(
    "ing8_rule_rejects",
    """WITH checked AS (
  SELECT list_filter([CASE WHEN NOT l_discount BETWEEN 0 AND 0.08 THEN 'bad discount' END,
    CASE WHEN lower(l_returnflag) NOT IN ('a', 'r') THEN 'outside domain: l_returnflag' END],
    lambda r: r IS NOT NULL) AS reasons, l_quantity FROM lineitem)
SELECT array_to_string(reasons, '; ') AS reasons, count(*) AS row_count,
  round(sum(l_quantity), 2) AS quantity FROM checked GROUP BY 1""",
)
def _(t):
    accepted, rejected = split_by_rules(t.lineitem, _line_rules())
    both = accepted.withColumn(REASONS, F.array().cast("array<string>")).unionByName(rejected)
    return both.groupBy(F.array_join(REASONS, "; ").alias("reasons")).agg(
        F.count(F.lit(1)).alias("row_count"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )


@query(
    "ing9_first_row_per_text",
    """SELECT doc_id, CAST(row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1 AS INTEGER)
  AS duplicate FROM documents""",
)
def _(t):
    kept, dropped = split_first_per_key(t.documents, ["text"], ["doc_id"])
    return kept.select("doc_id", F.lit(0).alias("duplicate")).unionByName(
        dropped.select("doc_id", F.lit(1).alias("duplicate"))
    )


@query(
    "ing9_first_row_null_keys_pass",
    """SELECT count(*) AS kept, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM (
  SELECT o_orderkey, k, row_number() OVER (PARTITION BY k ORDER BY o_orderdate, o_orderkey) AS n
  FROM (SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS k FROM orders))
WHERE k IS NULL OR n = 1""",
)
def _(t):
    keyed = t.orders.withColumn("k", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")))
    kept = split_first_per_key(keyed, ["k"], ["o_orderdate", "o_orderkey"]).accepted
    return kept.agg(
        F.count(F.lit(1)).alias("kept"), F.sum("o_orderkey").alias("keys")
    )


@query(
    "ing10_children_of_rejected_parents",
    """SELECT l_returnflag, CASE WHEN o_totalprice <= 300000 THEN 'accepted' ELSE 'parent rejected'
  END AS verdict, count(*) AS row_count
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
)
def _(t):
    parents = split_by_rules(t.orders, {"price": F.col("o_totalprice") > 300000}).accepted
    children = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    accepted, rejected = split_by_parent(children, parents, "o_orderkey")
    both = accepted.select("l_returnflag", F.lit("accepted").alias("verdict")).unionByName(
        rejected.select("l_returnflag", F.array_join(REASONS, ";").alias("verdict"))
    )
    return both.groupBy("l_returnflag", "verdict").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "ing12_repeated_fields",
    """WITH links AS (SELECT page_id, url, regexp_extract_all(html, 'href="([^"]*)"', 1) AS hrefs
  FROM pages), meta AS (SELECT max(page_id) AS last_page, count(*) AS total FROM pages)
SELECT page_id, upper(regexp_extract(url, '/([a-z]{2})/', 1)) AS device_class, i - 1 AS position,
  href, last_page, total
FROM (SELECT page_id, url, unnest(hrefs) AS href, generate_subscripts(hrefs, 1) AS i FROM links),
  meta""",
)
def _(t):
    links = explode_child(
        t.pages,
        "page_id",
        F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1)),
        "href",
    )
    heads = t.pages.select(
        "page_id", F.upper(F.regexp_extract("url", "/([a-z]{2})/", 1)).alias("device_class")
    )
    meta = t.pages.agg(F.max("page_id"), F.count(F.lit(1)))
    last_page, total = meta.columns
    return heads.join(links, "page_id").select(
        "page_id",
        "device_class",
        F.col("position").cast("bigint").alias("position"),
        "href",
        meta.select(last_page).scalar().alias("last_page"),
        meta.select(total).scalar().alias("total"),
    )


@query(
    "ing15_seed_dimension",
    "SELECT c_mktsegment, description, count(*) AS customers FROM customer LEFT JOIN (VALUES "
    + ", ".join(f"('{code}', '{text}')" for code, text in MEDICAL_SPECIALTIES)
    + ") s(code, description) ON substr(c_mktsegment, 1, 2) = code GROUP BY 1, 2",
)
def _(t):
    coded = t.customer.withColumn("code", F.substring("c_mktsegment", 1, 2))
    return (
        coded.join(medical_specialties(t.spark), "code", "left")
        .groupBy("c_mktsegment", "description")
        .agg(F.count(F.lit(1)).alias("customers"))
    )


# --- samples ------------------------------------------------------------------------------------


@query(
    "smp1_sample_percent",
    """SELECT 'lineitem' AS name, count(*) AS total,
  round(least(100.0, greatest(0.01, 5000.0 / count(*) * 100)), 2) AS percent FROM lineitem
UNION ALL SELECT 'orders', count(*), round(least(100.0, greatest(0.01, 5000.0 / count(*) * 100)), 2)
FROM orders UNION ALL
SELECT 'nation', count(*), round(least(100.0, greatest(0.01, 5000.0 / count(*) * 100)), 2)
FROM nation""",
)
def _(t):
    rows = [
        getattr(t, name)
        .agg(F.count(F.lit(1)).alias("total"))
        .select(
            F.lit(name).alias("name"),
            "total",
            sample_percent_column(F.col("total"), 5000).alias("percent"),
        )
        for name in ("lineitem", "orders", "nation")
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


SHARE_SQL = "('0x' || substr(sha256('{seed}:' || {key}), 1, 8))::BIGINT / 4294967296.0"
LINE_SHARE = SHARE_SQL.format(seed=200, key="(l_orderkey || '|' || l_linenumber)")


@query(
    "smp1_sampled_lines",
    f"""SELECT * FROM lineitem WHERE {LINE_SHARE} <
  (SELECT round(least(100.0, greatest(0.01, 5000.0 / count(*) * 100)), 2) FROM lineitem) / 100""",
)
def _(t):
    return sample_to_target(t.lineitem, t.lineitem.count(), ("l_orderkey", "l_linenumber"), 5000)


BLOCK_SHARE = SHARE_SQL.format(seed=200, key="(l_orderkey % 64 || ':0')")


@query(
    "smp1_block_sample",
    f"""SELECT * FROM lineitem WHERE {BLOCK_SHARE} <
  (SELECT round(least(100.0, greatest(0.01, 5000.0 / count(*) * 100)), 2) FROM lineitem) / 100""",
)
def _(t):
    folder = _shared_folder(t, "blocks")
    parts = t.lineitem.withColumn("part", F.pmod("l_orderkey", F.lit(64)))
    parts.repartition("part").write.partitionBy("part").parquet(folder)
    part = r"part=([0-9]+)/"
    return sample_blocks(
        t.spark, folder, 5000, columns=t.lineitem.columns, name=lambda path: F.regexp_extract(path, part, 1)
    )


@query(
    "smp2_sampled_orders_with_lines",
    f"""WITH o AS (SELECT o_orderkey AS key FROM orders
  WHERE {SHARE_SQL.format(seed=12345, key="o_orderkey")} < 0.1)
SELECT key, 'order' AS kind FROM o UNION ALL
SELECT l_orderkey, 'line' FROM lineitem WHERE l_orderkey IN (SELECT key FROM o)""",
)
def _(t):
    orders, lines = sample_with_children(
        t.orders.withColumnRenamed("o_orderkey", "key"),
        t.lineitem.withColumnRenamed("l_orderkey", "key"),
        "key",
        0.1,
        12345,
    )
    return orders.select("key", F.lit("order").alias("kind")).unionByName(
        lines.select("key", F.lit("line").alias("kind"))
    )
