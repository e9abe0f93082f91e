"""Registered queries: name matching, rewriting, graphs and clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from devigil.operators.clusters import cluster_count, cluster_sizes, cluster_texts, similar_pairs
from devigil.operators.names import (
    best_scores,
    candidate_pairs,
    distinct_names,
    fuzzy_join,
    match_names,
    nearest_by_grams,
)
from devigil.operators.rewrites import (
    apply_mapping,
    changed_rows,
    cycle_members,
    longest_chain,
    resolve,
    rewrite_edges,
)
from devigil.operators.vectors import tfidf
from devigil.plans.check_text import TOKENS_SQL, company_sql
from devigil.plans.registry import query
from devigil.session import parts_for

# order lines whose pairs of suppliers are the work of a task
LINES_PER_PART = 500_000

# --- fuzzy joins --------------------------------------------------------------------------------

LABELS_SQL = """
lefts AS (SELECT DISTINCT lower(p_name || ' ' || p_brand || ' ' || p_type) AS a FROM part),
rights AS (SELECT DISTINCT lower(p_name || ' ' || p_brand || ' ' || p_type) AS b
  FROM lineitem JOIN part ON l_partkey = p_partkey)
"""
CLOSE_SQL = """
close AS (SELECT a, b, total FROM (SELECT a, b, length(a) + length(b) AS total,
    CAST(floor(0.05 * (length(a) + length(b)) + 1e-9) AS INTEGER) AS most FROM lefts, rights)
  WHERE abs(length(a) - length(b)) <= most AND levenshtein(a, b) <= most - (most + total) % 2)
"""
# One row of the longest-common-subsequence table per step; a cell is a running maximum.
RATIO_SQL = """
lcs AS (
  SELECT a, b, total, 0 AS i, list_transform(range(0, length(b)), lambda k: 0) AS cells FROM close
  UNION ALL
  SELECT a, b, total, i + 1, list_transform(range(1, length(b) + 1), lambda j:
    list_max(list_transform(range(1, j + 1), lambda k: CASE WHEN substr(b, k, 1) =
      substr(a, i + 1, 1) THEN (CASE WHEN k = 1 THEN 0 ELSE cells[k - 1] END) + 1
      ELSE cells[k] END)))
  FROM lcs WHERE i < length(a)),
scored AS (SELECT a, b, 2.0 * cells[length(b)] / total AS score FROM lcs WHERE i = length(a))
"""


def _labels(t):
    label = F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("label")
    reported = t.lineitem.select(F.col("l_partkey").alias("p_partkey"))
    return t.part.select(label), t.part.join(reported, "p_partkey", "left_semi").select(label)


@query(
    "jn7_candidates_by_edit_distance",
    f"WITH {LABELS_SQL}, {CLOSE_SQL} SELECT a, b FROM close",
)
def _(t):
    left, right = _labels(t)
    return candidate_pairs(distinct_names(left, "label"), distinct_names(right, "label"))


@query(
    "jn7_fuzzy_join",
    f"""WITH RECURSIVE {LABELS_SQL}, {CLOSE_SQL}, {RATIO_SQL}
SELECT a, b, round(score, 9) AS score FROM scored WHERE score >= 0.95""",
)
def _(t):
    left, right = _labels(t)
    return fuzzy_join(left, "label", right, "label").withColumn("score", F.round("score", 9))


@query(
    "agg15_best_score_per_pair",
    """SELECT user_id AS a, event_type AS b, max(value) AS score FROM events GROUP BY 1, 2""",
)
def _(t):
    return best_scores(
        t.events.select(
            F.col("user_id").alias("a"),
            F.col("event_type").alias("b"),
            F.col("value").alias("score"),
        )
    )


def _nearest_sql(left: str, right: str) -> str:
    return f"""
lefts AS (SELECT DISTINCT {company_sql(left)} AS name FROM part),
rights AS (SELECT DISTINCT {company_sql(right)} AS name FROM part),
right_grams AS (SELECT name, substr(name, i, n) AS g FROM rights, (VALUES (2), (3)) s(n),
    LATERAL (SELECT unnest(range(1, length(name) - n + 2)) AS i)),
left_grams AS (SELECT name, substr(name, i, n) AS g FROM lefts, (VALUES (2), (3)) s(n),
    LATERAL (SELECT unnest(range(1, length(name) - n + 2)) AS i)),
rtf AS (SELECT name, g, count(*) AS tf FROM right_grams GROUP BY 1, 2),
idf AS (SELECT g, ln((1 + (SELECT count(*) FROM rights)) / (1 + count(*))) + 1 AS idf
  FROM rtf GROUP BY 1),
rv AS (SELECT name, r.g, tf * idf / sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY name)) AS w
  FROM rtf r JOIN idf i ON r.g = i.g),
ltf AS (SELECT name, g, count(*) AS tf FROM left_grams GROUP BY 1, 2),
lv AS (SELECT name, l.g, tf * idf / sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY name)) AS w
  FROM ltf l JOIN idf i ON l.g = i.g),
cosines AS (SELECT l.name AS a, r.name AS b, round(sum(l.w * r.w), 9) AS cosine
  FROM lv l JOIN rv r ON l.g = r.g GROUP BY 1, 2),
nearest AS (SELECT a, b, cosine FROM cosines
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY cosine DESC, b) <= 3)
"""


NEAREST_SQL = _nearest_sql("p_name || ' ' || p_brand", "p_name || ' ' || p_type")
SAME_KIND_SQL = _nearest_sql("p_name || ' ' || p_brand", "p_name || ' ' || p_brand || ' Inc.'")
TOKEN_SORT_SQL = "array_to_string(list_sort(string_split({0}, ' ')), ' ')"
EDIT_SQL = "(1.0 - levenshtein({0}, {1}) / CAST(greatest(length({0}), length({1})) AS DOUBLE))"
# Weights of all subsequences of two characters per name; a kernel is the product of two names' weights.
SCORED_SQL = f"""
spelled AS (SELECT name, unnest(range(1, length(name) + 1)) AS i
  FROM (SELECT a AS name FROM nearest UNION SELECT b FROM nearest)),
skips AS (SELECT x.name, substr(x.name, x.i, 1) || substr(x.name, y.i, 1) AS u,
    sum(0.9::DOUBLE ** (y.i - x.i + 1)) AS w
  FROM spelled x JOIN spelled y ON x.name = y.name AND x.i < y.i GROUP BY 1, 2),
unit AS (SELECT name, u, w / sqrt(sum(w * w) OVER (PARTITION BY name)) AS w FROM skips),
kernels AS (SELECT a, b, sum(l.w * r.w) AS kernel FROM nearest
  JOIN unit l ON l.name = a JOIN unit r ON r.name = b AND r.u = l.u GROUP BY 1, 2),
scored AS (SELECT a, b, round(100 * ({EDIT_SQL.format('a', 'b')} +
  {EDIT_SQL.format(TOKEN_SORT_SQL.format('a'), TOKEN_SORT_SQL.format('b'))} +
  coalesce(kernel, CASE WHEN a = b THEN 1 ELSE 0 END)) / 3, 6)
  AS score FROM nearest LEFT JOIN kernels USING (a, b))
"""


def _sides(t):
    return (
        t.part.select(F.concat_ws(" ", "p_name", "p_brand").alias("name")),
        t.part.select(F.concat_ws(" ", "p_name", "p_type").alias("name")),
    )


@query("jn8_nearest_by_grams", f"WITH {NEAREST_SQL} SELECT a, b, cosine FROM nearest")
def _(t):
    from devigil.functions.text import company_key

    a, b = (side.select(company_key(F.col("name")).alias("name")).distinct() for side in _sides(t))
    return nearest_by_grams(a, b).drop("rank")


@query(
    "jn8_subsequence_similarity",
    f"""WITH {NEAREST_SQL}, {SCORED_SQL}
SELECT a, b, round(coalesce(kernel, 0), 9) AS similarity FROM nearest LEFT JOIN kernels USING (a, b)""",
)
def _(t):
    from devigil.functions.similarity import subsequence_similarity
    from devigil.functions.text import company_key

    a, b = (side.select(company_key(F.col("name")).alias("name")).distinct() for side in _sides(t))
    similarity = subsequence_similarity(F.col("a"), F.col("b"))
    return nearest_by_grams(a, b).select("a", "b", F.round(similarity, 9).alias("similarity"))


@query(
    "jn8_top_matches",
    f"""WITH {NEAREST_SQL}, {SCORED_SQL} SELECT a, b, score,
  row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS rank FROM scored""",
)
def _(t):
    a, b = _sides(t)
    return match_names(a, "name", b, "name").select(
        "a", "b", "score", F.col("rank").cast("bigint").alias("rank")
    )


@query(
    "flt13_confident_matches",
    f"""WITH {SAME_KIND_SQL}, {SCORED_SQL} SELECT a, b, score FROM scored WHERE score > 80""",
)
def _(t):
    a, _ = _sides(t)
    b = t.part.select(F.concat_ws(" ", "p_name", "p_brand", F.lit("Inc.")).alias("name"))
    return match_names(a, "name", b, "name").filter("score > 80").select("a", "b", "score")


# --- rewriting ----------------------------------------------------------------------------------

# A supplier is renamed to the one it most often shares an order with; a turn to the next turn.
SUPPLIER_MAP_SQL = """
shared AS (SELECT a.l_suppkey AS s1, b.l_suppkey AS s2, count(*) AS n
  FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey <> b.l_suppkey
  GROUP BY 1, 2),
mapping AS (SELECT x.s_name AS original_name, y.s_name AS normalized_name
  FROM (SELECT s1, s2 FROM shared QUALIFY row_number() OVER (PARTITION BY s1 ORDER BY n DESC, s2)
    = 1) JOIN supplier x ON s1 = x.s_suppkey JOIN supplier y ON s2 = y.s_suppkey)
"""
TURN_MAP_SQL = """
turns AS (SELECT a.text AS original_name, b.text AS normalized_name FROM conversations a
  JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)
"""


def _supplier_mapping(t):
    lines = t.lineitem.select("l_orderkey", "l_suppkey")
    # counted from the file footers: the parts get no larger with the table
    parts = parts_for(lines, LINES_PER_PART)
    lines = lines.repartition(parts, "l_orderkey")
    other = lines.select("l_orderkey", F.col("l_suppkey").alias("partner"))
    # every pair once, counted for both sides
    shared = (
        lines.join(other, "l_orderkey")
        .filter("l_suppkey < partner")
        .select("l_suppkey", "partner")
        .repartition(parts, "l_suppkey", "partner")
        .groupBy("l_suppkey", "partner")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    sides = F.array(
        F.struct(F.col("l_suppkey"), F.col("partner")),
        F.struct(F.col("partner").alias("l_suppkey"), F.col("l_suppkey").alias("partner")),
    )
    shared = shared.select("n", F.inline(sides))
    best = shared.groupBy("l_suppkey").agg(
        F.max_by("partner", F.struct(F.col("n"), -F.col("partner"))).alias("partner")
    )
    names = t.supplier.select("s_suppkey", "s_name")
    first = names.toDF("l_suppkey", "original_name")
    second = names.toDF("partner", "normalized_name")
    return best.join(first, "l_suppkey").join(second, "partner").select(
        "original_name", "normalized_name"
    )


def _turn_mapping(t):
    a = t.conversations.select("conv_id", "turn", F.col("text").alias("original_name"))
    b = t.conversations.select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("normalized_name")
    )
    return a.join(b, ["conv_id", "turn"]).select("original_name", "normalized_name")


@query(
    "jn10_apply_mapping",
    f"""WITH {SUPPLIER_MAP_SQL}
SELECT s_suppkey, coalesce(m.normalized_name, s_name) AS s_name, s_name AS s_name_original
FROM supplier LEFT JOIN mapping m ON s_name = m.original_name""",
)
def _(t):
    renamed = apply_mapping(t.supplier.select("s_suppkey", "s_name"), "s_name", _supplier_mapping(t))
    return renamed


@query(
    "jn10_changed_rows",
    f"""WITH {SUPPLIER_MAP_SQL} SELECT count(*) AS changed FROM lineitem
JOIN supplier ON l_suppkey = s_suppkey JOIN mapping m ON s_name = m.original_name
WHERE s_name IS DISTINCT FROM m.normalized_name""",
)
def _(t):
    lines = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select("s_name")
    return changed_rows(apply_mapping(lines, "s_name", _supplier_mapping(t)), "s_name")


@query(
    "er1_rewrite_edges",
    f"""WITH {TURN_MAP_SQL} SELECT DISTINCT lower(trim(original_name)) AS src,
  lower(trim(normalized_name)) AS dst FROM turns
WHERE lower(trim(original_name)) <> lower(trim(normalized_name))""",
)
def _(t):
    return rewrite_edges(_turn_mapping(t))


@query(
    "er2_cycles",
    f"""WITH RECURSIVE {SUPPLIER_MAP_SQL}, edges AS (
  SELECT lower(original_name) AS src, lower(normalized_name) AS dst FROM mapping),
reach AS (SELECT src, dst FROM edges UNION
  SELECT r.src, e.dst FROM reach r JOIN edges e ON r.dst = e.src),
members AS (SELECT src AS node FROM reach WHERE src = dst)
SELECT m.node, min(r.dst) AS cycle FROM members m JOIN reach r ON r.src = m.node
WHERE r.dst IN (SELECT node FROM members) GROUP BY 1""",
)
def _(t):
    return cycle_members(rewrite_edges(_supplier_mapping(t)))


@query(
    "er3_longest_chain",
    f"""WITH RECURSIVE {TURN_MAP_SQL}, edges AS (
  SELECT DISTINCT lower(trim(original_name)) AS src, lower(trim(normalized_name)) AS dst
  FROM turns WHERE lower(trim(original_name)) <> lower(trim(normalized_name))),
walk AS (SELECT src, dst, 2 AS nodes FROM edges UNION
  SELECT w.src, e.dst, nodes + 1 FROM walk w JOIN edges e ON w.dst = e.src)
SELECT max(nodes) AS nodes FROM walk""",
)
def _(t):
    nodes = longest_chain(rewrite_edges(_turn_mapping(t)))
    return t.spark.createDataFrame([(nodes,)], "nodes int")


@query(
    "er4_resolved_turns",
    f"""WITH RECURSIVE {TURN_MAP_SQL}, walk AS (
  SELECT original_name, normalized_name AS target FROM turns UNION ALL
  SELECT w.original_name, t.normalized_name FROM walk w JOIN turns t ON w.target = t.original_name)
SELECT original_name, target AS resolved_name, 'resolved' AS status FROM walk
WHERE target NOT IN (SELECT original_name FROM turns)""",
)
def _(t):
    return resolve(_turn_mapping(t))


@query(
    "er4_resolved_with_cycles",
    f"""WITH RECURSIVE {SUPPLIER_MAP_SQL}, reach AS (
  SELECT original_name, normalized_name AS target FROM mapping UNION
  SELECT r.original_name, m.normalized_name FROM reach r JOIN mapping m
    ON r.target = m.original_name)
SELECT m.original_name, min(r.target) AS resolved_name,
  CASE WHEN min(r.target) IS NULL THEN 'cycle' ELSE 'resolved' END AS status
FROM mapping m LEFT JOIN (SELECT * FROM reach WHERE target NOT IN
  (SELECT original_name FROM mapping)) r ON m.original_name = r.original_name GROUP BY 1""",
)
def _(t):
    return resolve(_supplier_mapping(t))


# --- clusters -----------------------------------------------------------------------------------

EDGES_SQL = f"""{TOKENS_SQL},
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(a.weight * b.weight) AS cosine
  FROM vectors a JOIN vectors b ON a.term = b.term AND a.doc_id < b.doc_id GROUP BY 1, 2)
"""
CLUSTERS_SQL = f"""{EDGES_SQL},
links AS (SELECT a, b FROM pairs WHERE cosine >= 0.995 UNION ALL
  SELECT b, a FROM pairs WHERE cosine >= 0.995),
reach AS (SELECT doc_id, doc_id AS seen FROM documents UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.seen = l.a),
clusters AS (SELECT doc_id, min(seen) AS cluster FROM reach GROUP BY 1)
"""


@query(
    "er5_similar_pairs",
    f"WITH {EDGES_SQL} SELECT a, b, round(cosine, 8) AS cosine FROM pairs WHERE cosine >= 0.8",
)
def _(t):
    vectors = tfidf(t.documents, "doc_id", "text")
    return similar_pairs(vectors, "doc_id", 0.8).withColumn("cosine", F.round("cosine", 8))


@query("er5_text_clusters", f"WITH RECURSIVE {CLUSTERS_SQL} SELECT * FROM clusters")
def _(t):
    return cluster_texts(t.documents, "doc_id", "text")


@query(
    "er5_name_clusters",
    f"""WITH named AS (SELECT DISTINCT p_name AS device_name, s_name AS manufacturer_name
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)
SELECT device_name || '|' || manufacturer_name AS name,
  min(device_name || '|' || manufacturer_name) OVER (PARTITION BY list_sort(regexp_extract_all(
    {company_sql('device_name')} || {company_sql('manufacturer_name')}, '[a-z0-9_]{{2,}}')))
    AS cluster FROM named""",
)
def _(t):
    from devigil.functions.text import company_key

    named = (
        t.lineitem.select("l_partkey", "l_suppkey")
        .distinct()
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(F.col("p_name").alias("device_name"), F.col("s_name").alias("manufacturer_name"))
        .distinct()
    )
    rows = named.select(
        F.concat_ws("|", "device_name", "manufacturer_name").alias("name"),
        F.concat(
            company_key(F.col("device_name")), company_key(F.col("manufacturer_name"))
        ).alias("text"),
    )
    return cluster_texts(rows, "name", "text")


PARTS_SQL = "SELECT DISTINCT p_name || ' ' || p_brand || ' ' || p_type AS name FROM part"


@query(
    "er5_profile_clusters",
    rf"""WITH RECURSIVE names AS ({PARTS_SQL}),
counts AS (SELECT name, term, count(*) AS tf FROM (SELECT name,
  unnest(regexp_extract_all(lower(name), '[\p{{L}}\p{{N}}_]{{2,}}')) AS term FROM names) GROUP BY 1, 2),
raw AS (SELECT name, c.term, tf * (ln((1 + (SELECT count(*) FROM names)) / (1 + df)) + 1) AS w
  FROM counts c JOIN (SELECT term, count(*) AS df FROM counts GROUP BY 1) f ON c.term = f.term),
vectors AS (SELECT name, term, w / sqrt(sum(w * w) OVER (PARTITION BY name)) AS weight FROM raw),
gram AS (SELECT a.term, b.term AS other, sum(a.weight * b.weight) AS g
  FROM vectors a JOIN vectors b ON a.name = b.name GROUP BY 1, 2),
turned AS (SELECT name, gram.term, sum(weight * g) AS y
  FROM vectors JOIN gram ON vectors.term = other GROUP BY 1, 2),
norms AS (SELECT t.name, sqrt(sum(weight * y)) AS norm
  FROM turned t JOIN vectors v ON t.name = v.name AND t.term = v.term GROUP BY 1),
products AS (SELECT t.name AS a, v.name AS b, sum(weight * y) AS product
  FROM turned t JOIN vectors v ON t.term = v.term AND t.name <> v.name GROUP BY 1, 2),
links AS (SELECT a, b FROM products JOIN norms l ON a = l.name JOIN norms r ON b = r.name
  WHERE product >= 0.9 * l.norm * r.norm),
reach AS (SELECT name, name AS seen FROM names UNION
  SELECT r.name, l.b FROM reach r JOIN links l ON r.seen = l.a)
SELECT name, min(seen) AS cluster FROM reach GROUP BY 1""",
)
def _(t):
    label = F.concat("p_name", F.lit(" "), "p_brand", F.lit(" "), "p_type")
    names = t.part.select(label.alias("name")).distinct()
    return cluster_texts(names, "name", "name", eps=0.1, profile=True)


@query(
    "agg16_cluster_sizes",
    f"""WITH RECURSIVE {CLUSTERS_SQL} SELECT cluster, count(*) AS size FROM clusters GROUP BY 1""",
)
def _(t):
    return cluster_sizes(cluster_texts(t.documents, "doc_id", "text"))


@query(
    "agg16_cluster_count",
    f"""WITH RECURSIVE {CLUSTERS_SQL} SELECT count(DISTINCT cluster) AS clusters FROM clusters""",
)
def _(t):
    return cluster_count(cluster_texts(t.documents, "doc_id", "text"))


@query(
    "flt13_largest_cluster_members",
    f"""WITH RECURSIVE {CLUSTERS_SQL}, biggest AS (SELECT cluster FROM clusters GROUP BY 1
  ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT c.cluster, d.doc_id, d.source FROM clusters c JOIN biggest b ON c.cluster = b.cluster
JOIN documents d ON d.doc_id = c.doc_id""",
)
def _(t):
    from devigil.session import cut_lineage

    labels = cut_lineage(cluster_texts(t.documents, "doc_id", "text"))
    biggest = cluster_sizes(labels).orderBy(F.desc("size"), "cluster").limit(1).select("cluster")
    members = labels.join(biggest, "cluster", "left_semi")
    return members.join(t.documents, "doc_id").select("cluster", "doc_id", "source")
