"""Registered queries: monthly series, trends, holdouts, forecasts, policies."""

from __future__ import annotations

from pyspark.sql import functions as F

from devigil.operators.forecast import COARSE, FORECAST, HELD_OUT, REFINEMENTS, forecast
from devigil.operators.reports import key_figures, monthly_trend
from devigil.operators.series import POLICIES, monthly_counts, policy_overlay, split_holdout
from devigil.plans.registry import query

SERIES_SQL = """
counted AS (
  SELECT o_orderpriority AS series, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
    count(*) AS n FROM orders GROUP BY 1, 2),
spans AS (SELECT series, min(month) AS first, max(month) AS last FROM counted GROUP BY 1),
months AS (
  SELECT series, CAST(unnest(generate_series(first, last, INTERVAL 1 MONTH)) AS DATE) AS month
  FROM spans),
monthly AS (
  SELECT m.series, last_day(m.month) AS month_end, coalesce(n, 0) AS n
  FROM months m LEFT JOIN counted c ON c.series = m.series AND c.month = m.month),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY month_end) AS i,
    count(*) OVER (PARTITION BY series) AS total FROM monthly),
split AS (
  SELECT *, CAST(round_even(total * 0.1, 0) AS INTEGER) AS held,
    i > total - CAST(round_even(total * 0.1, 0) AS INTEGER) AS held_out FROM numbered)
"""

# One series is additive as soon as a month has no count; state starts from the first two seasons.
STATE_SQL = """
train AS (SELECT series, i, CAST(n AS DOUBLE) AS y, total, held FROM split WHERE NOT held_out),
kinds AS (SELECT series, min(n) >= 1 AS mul, any_value(held) AS held, count(*) - any_value(held)
  AS size FROM split GROUP BY series),
starts AS (
  SELECT t.series, any_value(k.mul) AS mul, avg(y) FILTER (i <= 12) AS level,
    (avg(y) FILTER (i BETWEEN 13 AND 24) - avg(y) FILTER (i <= 12)) / 12 AS trend,
    list(y ORDER BY i) AS ys
  FROM train t JOIN kinds k ON k.series = t.series GROUP BY t.series)
"""


def _run_sql(name: str, parameters: str) -> str:
    """The recursion over ``parameters(series, alpha, beta, gamma)``, one row per month."""
    return f"""
{name} AS (
  SELECT s.series, p.alpha, p.beta, p.gamma, mul, 0 AS i, level, trend,
    CASE WHEN mul THEN list_transform(ys[1:12], lambda y: y / level)
      ELSE list_transform(ys[1:12], lambda y: y - level) END AS season,
    CAST(0 AS DOUBLE) AS error, ys
  FROM starts s JOIN {parameters} p ON p.series = s.series
  UNION ALL
  SELECT series, alpha, beta, gamma, mul, i + 1,
    alpha * base + (1 - alpha) * (level + trend),
    beta * ((alpha * base + (1 - alpha) * (level + trend)) - level) + (1 - beta) * trend,
    list_append(season[2:], gamma * (CASE WHEN mul THEN y / (level + trend)
      ELSE y - (level + trend) END) + (1 - gamma) * season[1]),
    error + (y - ahead) * (y - ahead), ys
  FROM (SELECT *, ys[i + 1] AS y,
      CASE WHEN mul THEN ys[i + 1] / season[1] ELSE ys[i + 1] - season[1] END AS base,
      CASE WHEN mul THEN (level + trend) * season[1] ELSE (level + trend) + season[1] END AS ahead
    FROM {name} WHERE i < len(ys)))"""


def _output_sql(fitted: str) -> str:
    """Held-out and future months from the last state of each series."""
    return f"""
ends AS (SELECT * FROM {fitted} WHERE i = len(ys)),
steps AS (
  SELECT e.series, alpha, beta, gamma, h, k.held,
    CASE WHEN e.mul THEN (level + h * trend) * season[(h - 1) % 12 + 1]
      ELSE (level + h * trend) + season[(h - 1) % 12 + 1] END AS value
  FROM ends e JOIN kinds k ON k.series = e.series,
    LATERAL (SELECT CAST(unnest(generate_series(1, k.held + 24)) AS INTEGER) AS h)),
anchors AS (SELECT series, max(month_end) AS last FROM split WHERE NOT held_out GROUP BY 1),
dated AS (
  SELECT s.*, CAST(last_day(CAST(a.last + to_months(h) AS DATE)) AS VARCHAR) AS month_end
  FROM steps s JOIN anchors a ON a.series = s.series),
errors AS (
  SELECT d.series, round_even(sqrt(avg((n - value) ** 2)), 0) AS rmse
  FROM dated d JOIN split p ON p.series = d.series
    AND CAST(p.month_end AS VARCHAR) = d.month_end WHERE h <= d.held GROUP BY 1),
labelled AS (
  SELECT series, month_end, value, '{HELD_OUT}' AS type FROM dated WHERE h <= held
  UNION ALL SELECT series, month_end, value, '{FORECAST}' FROM dated
  UNION ALL SELECT series, CAST(month_end AS VARCHAR), n, 'Actual' FROM split)
SELECT l.series, l.month_end, round(l.value, 4) AS "count", l.type, rmse,
  e.alpha, e.beta, e.gamma
FROM labelled l JOIN errors r ON r.series = l.series JOIN ends e ON e.series = l.series"""


FIXED = (0.3, 0.1, 0.2)
FIXED_SQL = f"""WITH RECURSIVE {SERIES_SQL}, {STATE_SQL},
fixed AS (SELECT series, {FIXED[0]}::DOUBLE AS alpha, {FIXED[1]}::DOUBLE AS beta,
  {FIXED[2]}::DOUBLE AS gamma FROM starts),
{_run_sql('run', 'fixed')}, {_output_sql('run')}"""


def _fitted_sql() -> str:
    coarse = ", ".join(f"({value}::DOUBLE)" for value in COARSE)
    best = (
        "SELECT series, alpha, beta, gamma FROM {run} WHERE i = len(ys) QUALIFY row_number() "
        "OVER (PARTITION BY series ORDER BY error, alpha, beta, gamma) = 1"
    )
    near = (
        "list_distinct([least(1.0, greatest(0.0, round({p} - {s}, 10))), {p}, "
        "least(1.0, greatest(0.0, round({p} + {s}, 10)))])"
    )
    parts = [
        f"axis AS (SELECT * FROM (VALUES {coarse}) v(p))",
        "grid0 AS (SELECT s.series, a.p AS alpha, b.p AS beta, c.p AS gamma "
        "FROM starts s, axis a, axis b, axis c)",
        _run_sql("run0", "grid0"),
        f"best0 AS ({best.format(run='run0')})",
    ]
    for number, step in enumerate(REFINEMENTS, 1):
        lists = ", ".join(
            near.format(p=p, s=step) + f" AS {p}s" for p in ("alpha", "beta", "gamma")
        )
        parts += [
            f"near{number} AS (SELECT series, {lists} FROM best{number - 1})",
            f"grid{number}a AS (SELECT series, unnest(alphas) AS alpha, betas, gammas "
            f"FROM near{number})",
            f"grid{number}b AS (SELECT series, alpha, unnest(betas) AS beta, gammas "
            f"FROM grid{number}a)",
            f"grid{number} AS (SELECT series, alpha, beta, unnest(gammas) AS gamma "
            f"FROM grid{number}b)",
            _run_sql(f"run{number}", f"grid{number}"),
            f"best{number} AS ({best.format(run=f'run{number}')})",
        ]
    last = len(REFINEMENTS)
    chosen = (
        f"chosen AS (SELECT r.* FROM run{last} r JOIN best{last} b ON r.series = b.series AND "
        "r.alpha = b.alpha AND r.beta = b.beta AND r.gamma = b.gamma)"
    )
    return (
        f"WITH RECURSIVE {SERIES_SQL}, {STATE_SQL}, {', '.join(parts)}, {chosen}, "
        f"{_output_sql('chosen')}"
    )


def _orders(t):
    return t.orders.select(F.col("o_orderpriority").alias("series"), "o_orderdate")


def _shown(df):
    return df.select(
        "series",
        F.col("month_end").cast("string").alias("month_end"),
        F.round("count", 4).alias("count"),
        "type",
        "rmse",
        "alpha",
        "beta",
        "gamma",
    )


@query(
    "agg10_monthly_gap_filled",
    f"""WITH {SERIES_SQL} SELECT series, CAST(month_end AS VARCHAR) AS month_end, n AS "count"
FROM monthly""",
)
def _(t):
    series = monthly_counts(_orders(t), "o_orderdate", ["series"])
    return series.withColumn("month_end", F.col("month_end").cast("string"))


@query(
    "agg10_monthly_sparse_customers",
    """WITH counted AS (
  SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n
  FROM orders GROUP BY 1, 2),
spans AS (SELECT o_custkey, min(month) AS first, max(month) AS last FROM counted GROUP BY 1),
months AS (SELECT o_custkey, CAST(unnest(generate_series(first, last, INTERVAL 1 MONTH)) AS DATE)
  AS month FROM spans)
SELECT m.o_custkey, CAST(last_day(m.month) AS VARCHAR) AS month_end, coalesce(n, 0) AS "count"
FROM months m LEFT JOIN counted c ON c.o_custkey = m.o_custkey AND c.month = m.month""",
)
def _(t):
    series = monthly_counts(t.orders, "o_orderdate", ["o_custkey"])
    return series.withColumn("month_end", F.col("month_end").cast("string"))


@query(
    "agg9_monthly_trend",
    """SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, count(*) AS "count"
FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '2001-01-31' - INTERVAL 1 YEAR GROUP BY 1""",
)
def _(t):
    trend = monthly_trend(t.orders, "o_orderdate", F.lit("2001-01-31").cast("date"))
    return trend.withColumn("month", F.col("month").cast("string"))


@query(
    "agg11_key_figures",
    """SELECT count(*) AS total,
  count(*) FILTER (CAST(o_orderdate AS DATE) >= DATE '2001-07-31' - INTERVAL 30 DAY) AS recent
FROM orders""",
)
def _(t):
    return key_figures(t.orders, "o_orderdate", F.lit("2001-07-31").cast("date"))


@query(
    "ts1_holdout_split",
    f"""WITH {SERIES_SQL} SELECT series, CAST(month_end AS VARCHAR) AS month_end, n AS "count",
  CAST(held_out AS INTEGER) AS held_out FROM split""",
)
def _(t):
    series = monthly_counts(_orders(t), "o_orderdate", ["series"])
    return split_holdout(series, ["series"]).withColumns(
        {
            "month_end": F.col("month_end").cast("string"),
            "held_out": F.col("held_out").cast("int"),
        }
    )


@query("ts2_forecast_fixed_parameters", FIXED_SQL)
def _(t):
    series = monthly_counts(_orders(t), "o_orderdate", ["series"])
    return _shown(forecast(series, ["series"], FIXED))


@query("ts2_forecast_fitted", _fitted_sql())
def _(t):
    series = monthly_counts(_orders(t), "o_orderdate", ["series"])
    return _shown(forecast(series, ["series"]))


@query("ts2_forecast_fitted_states")
def _(t):
    series = monthly_counts(_orders(t), "o_orderdate", ["series"])
    return _shown(forecast(series, ["series"], fit_states=True))


@query(
    "ts6_forecast_fallback",
    """WITH counted AS (
  SELECT c_nationkey, c_mktsegment, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
    count(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate < TIMESTAMP '1996-06-01'
  GROUP BY 1, 2, 3),
spans AS (SELECT c_nationkey, c_mktsegment, min(month) AS first, max(month) AS last
  FROM counted GROUP BY 1, 2),
months AS (SELECT c_nationkey, c_mktsegment,
  CAST(unnest(generate_series(first, last, INTERVAL 1 MONTH)) AS DATE) AS month FROM spans)
SELECT m.c_nationkey, m.c_mktsegment, CAST(last_day(m.month) AS VARCHAR) AS month_end,
  CAST(coalesce(n, 0) AS DOUBLE) AS "count", 'Actual' AS type, 0 AS forecasted
FROM months m LEFT JOIN counted c ON c.c_nationkey = m.c_nationkey
  AND c.c_mktsegment = m.c_mktsegment AND c.month = m.month""",
)
def _(t):
    keys = ["c_nationkey", "c_mktsegment"]
    early = t.orders.filter(F.col("o_orderdate") < F.lit("1996-06-01").cast("timestamp_ntz"))
    rows = early.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return forecast(monthly_counts(rows, "o_orderdate", keys), keys).select(
        *keys,
        F.col("month_end").cast("string").alias("month_end"),
        "count",
        "type",
        F.col("forecasted").cast("int").alias("forecasted"),
    )


@query("ts5_forecast_per_manufacturer")
def _(t):
    rows = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return forecast(monthly_counts(rows, "l_shipdate", ["s_name"]), ["s_name"])


@query(
    "jn11_policy_overlay",
    """SELECT CAST(d AS VARCHAR) AS date, label FROM (VALUES """
    + ", ".join("(DATE '{}', '{}')".format(d, label) for d, label in POLICIES)
    + """) p(d, label), (SELECT last_day(CAST(min(o_orderdate) AS DATE)) AS a,
  last_day(CAST(max(o_orderdate) AS DATE)) AS b FROM orders) WHERE d BETWEEN a AND b""",
)
def _(t):
    overlay = policy_overlay(monthly_counts(t.orders, "o_orderdate"))
    return overlay.withColumn("date", F.col("date").cast("string"))
