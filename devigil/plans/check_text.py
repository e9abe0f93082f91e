"""Registered queries: scalar clean-up, tokens, TF-IDF, encodings, splits, metrics."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from devigil.functions import temporal as D
from devigil.functions import text as X
from devigil.operators.features import hash_share, one_hot_stages, ordinal_codes, split_by_hash
from devigil.operators.metrics import (
    binary_metrics,
    confusion_matrix,
    flatten_labels,
    multilabel_metrics,
)
from devigil.operators.vectors import term_counts, tfidf
from devigil.plans.bindings import clean
from devigil.plans.registry import query


def company_sql(expression: str) -> str:
    endings = "|".join(sorted(X.LEGAL_SUFFIXES, key=len, reverse=True))
    folded = (
        f"regexp_replace(regexp_replace(strip_accents(lower({expression})), "
        "'[^A-Za-z0-9_\\s]', '', 'g'), '\\s+', ' ', 'g')"
    )
    return f"trim(regexp_replace(trim({folded}), '(?:(?:^| )(?:{endings}))+$', ''))"


@query(
    "sc1_canonical_text",
    f"SELECT doc_id, {clean('text')} AS canonical, {clean('source')} AS source FROM documents",
)
def _(t):
    return t.documents.select(
        "doc_id",
        X.canonical_text(F.col("text")).alias("canonical"),
        X.canonical_text(F.col("source")).alias("source"),
    )


@query("sc2_company_key_names", f"SELECT c_custkey, {company_sql('c_name')} AS key FROM customer")
def _(t):
    return t.customer.select("c_custkey", X.company_key(F.col("c_name")).alias("key"))


@query("sc2_company_key_texts", f"SELECT doc_id, {company_sql('text')} AS key FROM documents")
def _(t):
    return t.documents.select("doc_id", X.company_key(F.col("text")).alias("key"))


STOP_SQL = ", ".join(f"'{word}'" for word in X.STOP_WORDS)


@query(
    "sc3_content_words",
    rf"""SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(
  regexp_replace(regexp_replace(regexp_replace(lower(text),
    '(n''t|''(?:s|re|ve|ll|d|m))(\s|$)', ' ', 'g'), '[,:]([^0-9]|$)', ' \1', 'g'),
    '[;@#$%&?!"()\[\]{{}}<>]|\.(\s|$)', ' ', 'g'), '\s+'),
  lambda w: regexp_full_match(w, '[\p{{L}}\p{{N}}]+') AND w NOT IN ({STOP_SQL})), ' ') AS words
FROM documents""",
)
def _(t):
    return t.documents.select("doc_id", X.content_words(F.col("text")).alias("words"))


@query(
    "sc4_first_number",
    """SELECT page_id, TRY_CAST(regexp_extract(replace(html, ',', ''), '([0-9]+)', 1) AS BIGINT)
  AS in_html, TRY_CAST(regexp_extract(replace(url, ',', ''), '([0-9]+)', 1) AS BIGINT) AS in_url
FROM pages""",
)
def _(t):
    return t.pages.select(
        "page_id",
        X.first_number(F.col("html")).alias("in_html"),
        X.first_number(F.col("url")).alias("in_url"),
    )


@query(
    "sc5_string_functions",
    """SELECT c_custkey, upper(c_mktsegment) AS upper_name, lower(c_mktsegment) AS lower_name,
  CASE WHEN c_acctbal < 0 THEN 'debt' ELSE 'credit' END AS kind,
  coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') AS segment,
  c_name || ',' || c_mktsegment AS csv FROM customer""",
)
def _(t):
    return t.customer.select(
        "c_custkey",
        F.upper("c_mktsegment").alias("upper_name"),
        F.lower("c_mktsegment").alias("lower_name"),
        F.when(F.col("c_acctbal") < 0, "debt").otherwise("credit").alias("kind"),
        F.coalesce(F.nullif("c_mktsegment", F.lit("BUILDING")), F.lit("none")).alias("segment"),
        X.array_to_csv(F.array("c_name", "c_mktsegment")).alias("csv"),
    )


@query(
    "sc6_date_functions",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS compact,
  CAST(NULL AS VARCHAR) AS broken,
  strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month,
  CAST(last_day(o_orderdate) AS VARCHAR) AS month_end,
  strftime(o_orderdate - INTERVAL 30 DAY, '%Y-%m-%d') AS before,
  strftime(o_orderdate + INTERVAL 2 MONTH, '%Y-%m-%d') AS later FROM orders""",
)
def _(t):
    day = F.col("o_orderdate").cast("date")
    return t.orders.select(
        "o_orderkey",
        D.parse_date(F.date_format(day, "yyyyMMdd")).cast("string").alias("compact"),
        D.parse_date(F.concat(F.date_format(day, "yyyy"), F.lit("1399"))).cast("string").alias(
            "broken"
        ),
        D.month_start(day).cast("string").alias("month"),
        F.last_day(day).cast("string").alias("month_end"),
        F.date_sub(day, 30).cast("string").alias("before"),
        F.add_months(day, 2).cast("string").alias("later"),
    )


@query(
    "sc7_numeric_functions",
    """SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0) AS k,
  0.0::DOUBLE AS text_number, least(value, 10.0) AS clipped, round(sqrt(value), 6) AS root,
  round(pow(value, 2), 4) AS square FROM events""",
)
def _(t):
    return t.events.select(
        "event_id",
        X.number_or_zero(F.get_json_object("props", "$.k")).alias("k"),
        X.number_or_zero(F.col("event_type")).alias("text_number"),
        F.least("value", F.lit(10.0)).alias("clipped"),
        F.round(F.sqrt("value"), 6).alias("root"),
        F.round(F.pow("value", F.lit(2.0)), 4).alias("square"),
    )


# --- vectors ------------------------------------------------------------------------------------

TOKENS_SQL = r"""
tokens AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term
  FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY 1, 2),
frequency AS (SELECT term, count(*) AS df FROM counts GROUP BY 1),
raw AS (SELECT doc_id, c.term, tf, df,
    tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w
  FROM counts c JOIN frequency f ON c.term = f.term),
vectors AS (SELECT doc_id, term, tf, df, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight
  FROM raw)
"""


@query(
    "ml2_tfidf",
    f"""WITH {TOKENS_SQL} SELECT doc_id, term, tf, df, round(weight, 8) AS weight FROM vectors""",
)
def _(t):
    return tfidf(t.documents, "doc_id", "text").withColumn("weight", F.round("weight", 8))


@query("ml3_bag_of_words", f"WITH {TOKENS_SQL} SELECT doc_id, term, tf FROM counts")
def _(t):
    return term_counts(t.documents, "doc_id", X.tokens(F.col("text")))


@query(
    "ml1_one_hot_encoder",
    """WITH ranked AS (SELECT o_orderpriority, row_number() OVER (ORDER BY count(*) DESC,
  o_orderpriority) - 1 AS slot FROM orders GROUP BY 1)
SELECT o_orderkey, CAST(slot AS INTEGER) AS slot, CAST(1.0 AS DOUBLE) AS total
FROM orders JOIN ranked USING (o_orderpriority)""",
)
def _(t):
    df = t.orders.select("o_orderkey", "o_orderpriority")
    for stage in one_hot_stages(["o_orderpriority"]):
        df = stage.fit(df).transform(df)
    flags = vector_to_array("o_orderpriority_onehot")
    return df.select(
        "o_orderkey",
        (F.array_position(flags, 1.0) - 1).cast("int").alias("slot"),
        F.aggregate(flags, F.lit(0.0), lambda a, b: a + b).alias("total"),
    )


@query(
    "ml5_numeric_impute",
    """SELECT doc_id, CAST(coalesce(quality, 0) AS DOUBLE) AS quality,
  CAST(coalesce(toxic, 0) AS DOUBLE) AS toxic, CAST(n_chars AS DOUBLE) AS n_chars
FROM documents LEFT JOIN labels USING (doc_id)""",
)
def _(t):
    from devigil.operators.features import FeatureSpec, prepare

    spec = FeatureSpec(numeric=("quality", "toxic", "n_chars"))
    joined = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id", "left")
    return prepare(joined, spec).select("doc_id", *spec.numeric)


@query(
    "ml6_ordinal_codes",
    """SELECT doc_id, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS DOUBLE) AS num_lang,
  CAST(dense_rank() OVER (ORDER BY source) - 1 AS DOUBLE) AS num_source FROM documents""",
)
def _(t):
    coded = ordinal_codes(t.documents.select("doc_id", "lang", "source"), ["lang", "source"])
    return coded.select("doc_id", "num_lang", "num_source")


SHARE_SQL = "CAST(('0x' || substr(sha256('62:' || doc_id), 1, 8)) AS BIGINT) / 4294967296.0"


@query(
    "ml7_hash_split",
    f"""SELECT doc_id, CASE WHEN {SHARE_SQL} < 0.8 THEN 'train' ELSE 'test' END AS part,
  round({SHARE_SQL}, 9) AS share FROM labels""",
)
def _(t):
    train, test = split_by_hash(t.labels, "doc_id", 0.8, 62)
    return (
        train.withColumn("part", F.lit("train"))
        .unionByName(test.withColumn("part", F.lit("test")))
        .select(
            "doc_id", "part", F.round(hash_share(F.col("doc_id"), 62), 9).alias("share")
        )
    )


# --- metrics ------------------------------------------------------------------------------------


@query(
    "ml11_binary_metrics",
    """SELECT round(avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END), 9) AS accuracy,
  round(2.0 * count(*) FILTER (quality = 1 AND toxic = 1) /
    (count(*) FILTER (quality = 1) + count(*) FILTER (toxic = 1)), 9) AS f1 FROM labels""",
)
def _(t):
    return binary_metrics(t.labels, "quality", "toxic").select(
        F.round("accuracy", 9).alias("accuracy"), F.round("f1", 9).alias("f1")
    )


@query(
    "ml11_confusion_matrix",
    """SELECT quality AS label, toxic AS prediction, count(*) AS n,
  round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY quality) AS DOUBLE), 9) AS share
FROM labels GROUP BY 1, 2""",
)
def _(t):
    matrix = confusion_matrix(t.labels, "quality", "toxic")
    return matrix.withColumn("share", F.round("share", 9))


TARGETS = {"high": ("quality", "toxic"), "same": ("toxic", "toxic"), "low": ("toxic", "quality")}
STACKED_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS target, {label} AS label, {prediction} AS prediction FROM labels"
    for name, (label, prediction) in TARGETS.items()
)


@query(
    "ml11_multilabel_metrics",
    f"""WITH stacked AS ({STACKED_SQL}), per_target AS (
  SELECT target, avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS accuracy,
    2.0 * count(*) FILTER (label = 1 AND prediction = 1) /
      (count(*) FILTER (label = 1) + count(*) FILTER (prediction = 1)) AS f1,
    count(*) FILTER (label = 1) AS support FROM stacked GROUP BY 1)
SELECT target, round(accuracy, 9) AS accuracy, round(f1, 9) AS f1, support,
  round((SELECT sum(f1 * support) / sum(support) FROM per_target), 9) AS weighted_f1
FROM per_target""",
)
def _(t):
    rows = multilabel_metrics(t.labels, TARGETS)
    return rows.withColumns({c: F.round(c, 9) for c in ("accuracy", "f1", "weighted_f1")})


@query(
    "ml11_flattened_confusion",
    f"""SELECT label, prediction, count(*) AS n,
  round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY label) AS DOUBLE), 9) AS share
FROM ({STACKED_SQL}) GROUP BY 1, 2""",
)
def _(t):
    flat = flatten_labels(t.labels, TARGETS)
    matrix = confusion_matrix(flat, "label", "prediction")
    return matrix.withColumn("share", F.round("share", 9))
