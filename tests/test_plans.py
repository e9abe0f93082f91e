import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from devigil.plans import bindings as B
from devigil.plans import dashboards, registry

DATA = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SAMPLED = (
    "agg1_device_mart", "agg4_address_mart", "agg10_monthly_gap_filled", "agg18_hexbin",
    "ing9_first_row_per_text", "jn7_fuzzy_join", "jn8_top_matches", "er4_resolved_with_cycles",
    "er5_text_clusters", "ts2_forecast_fixed_parameters", "jn4_prediction_features",
)


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return connection


def test_every_check_belongs_to_a_query():
    registry.load_all()
    assert set(registry.CHECKS) <= set(registry.QUERIES)
    assert len(registry.QUERIES) > 100


@pytest.mark.parametrize("name", SAMPLED)
def test_query_equals_sql(spark, con, name):
    registry.load_all()
    df = registry.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()), key=repr)
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = con.execute(f"SELECT {quoted} FROM ({registry.CHECKS[name]})").fetchall()
    assert got == sorted(want, key=repr)


def test_home_page_is_cross_filtered(spark):
    tables = B.sources(registry.Tables(spark, DATA))
    page = dashboards.home(tables, "supplier 0*1$", "recalls", "records", 3)
    names = {r.manufacturer_name for r in page["manufacturers"].collect()}
    assert names == {"supplier 000000001"}
    assert {r.manufacturer_name for r in page["devices"].collect()} == names
    assert {r.manufacturer_name for r in page["addresses"].collect()} == names
    assert page["top_devices"].count() == 3


def test_recalls_page(spark):
    recalls = B.recalls_of_orders(registry.Tables(spark, DATA))
    gazetteer = spark.createDataFrame(
        [("NATION_1", "1", 50.0, 8.0)],
        "country_code string, postal_code string, latitude double, longitude double",
    )
    page = dashboards.recalls_page(
        recalls,
        {"date_from": dt.date(1996, 1, 1), "date_to": dt.date(2000, 12, 31)},
        dt.date(2000, 12, 31),
        gazetteer,
    )
    figures = page["figures"].first()
    assert figures.total == page["records"].count() >= figures.recent > 0
    assert page["by_category"].agg(F.sum("count")).first()[0] == figures.total
    assert page["latest"].count() == 100 and "id" not in page["latest"].columns
    assert {r.type for r in page["forecast"].select("type").distinct().collect()} >= {"Actual"}
    located = recalls.filter("country = 'NATION_1'").filter(
        "event_date_posted between '1996-01-01' and '2000-12-31'"
    )
    assert (page["density"].agg(F.sum("points")).first()[0] or 0) == located.count()
    labels = [r.label for r in page["policies"].orderBy("date").collect()]
    assert "FDA Modernization Act" in labels


def test_supplier_mapping_is_counted_in_bounded_parts(spark, monkeypatch):
    from types import SimpleNamespace

    from devigil.plans import check_names

    monkeypatch.setattr(check_names, "LINES_PER_PART", 20)
    lines = [(i % 37, (i * i + i // 7) % 11) for i in range(200)] + [(None, 1), (3, None)]
    names = [(s, f"s{s}") for s in range(11)]
    t = SimpleNamespace(
        lineitem=spark.createDataFrame(lines, "l_orderkey long, l_suppkey long"),
        supplier=spark.createDataFrame(names, "s_suppkey long, s_name string"),
    )
    shared = {}
    for order, a in lines:
        for other, b in lines:
            if order is not None and order == other and None not in (a, b) and a != b:
                shared.setdefault(a, {}).setdefault(b, 0)
                shared[a][b] += 1
    want = {f"s{a}": f"s{min(n, key=lambda b: (-n[b], b))}" for a, n in shared.items()}
    assert dict(map(tuple, check_names._supplier_mapping(t).collect())) == want


def test_device_mart_is_summed_up_in_given_parts(spark):
    from devigil.operators import marts

    integrated = B.integrated(registry.Tables(spark, DATA)).limit(500).localCheckpoint()
    for build in (marts.device_view, marts.manufacturer_view):
        dealt = build(integrated, 7)
        assert sorted(dealt.collect(), key=repr) == sorted(build(integrated).collect(), key=repr)
    devices = marts.device_view(integrated, 7)
    # one exchange serves both sums, and is not merged into fewer parts
    assert devices.rdd.getNumPartitions() == 7


def test_manufacturers_are_summed_up_before_they_are_shuffled(spark):
    from devigil.operators import marts

    integrated = B.integrated(registry.Tables(spark, DATA))
    narrow = integrated.select(*[f"`{c}`" for c in marts.mart_columns()]).limit(500).localCheckpoint()
    view = marts.manufacturer_view(narrow, 7)
    assert "Repartition" not in view._jdf.queryExecution().optimizedPlan().toString()
    sums = narrow.groupBy("manufacturer_name").agg(
        F.sum("death").alias("deaths"), F.max("1").alias("class_1"),
        F.count_distinct("device_name").alias("unique_devices"), F.count_distinct("k_number").alias("k_submissions"),
    )
    assert sorted(view.select(*sums.columns).collect(), key=repr) == sorted(sums.collect(), key=repr)
