"""What every order of a set of filters removes, from decision diagrams of failure masks.

A document's failures are a mask of one bit a filter. The masks of a part are counted on the cluster, so
that a part is at most 32 rows whatever its size. From them a diagram is built per part: a level for each
filter in turn, a pass and a fail branch at each node, counts at the bottom, equal nodes shared, and in
every node the counts below it. Following the pass branches from the top gives the steps of that order.
Swapping two neighbouring levels only rebuilds the nodes of these two; all orders are reached by such
swaps, one each.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
SPACES = r"[ \t\n\x0B\f\r]+"
OUT = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
    "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
)


class Diagram:
    """A reduced diagram over all levels; a node is ``(pass child, fail child, counts below)``.

    ``counts`` maps a tuple with one 0 or 1 for each variable to the counts of that mask.
    """

    def __init__(self, counts: dict[tuple, tuple], variables: str):
        self.order = list(variables)
        width = len(next(iter(counts.values())))
        self.nodes: list[tuple] = []
        self.shared: dict[tuple, int] = {}
        self.leaf = {}
        self.zero = (0,) * width

        def build(prefix: tuple) -> int:
            if len(prefix) == len(variables):
                return self._leaf(counts.get(prefix, self.zero))
            return self._node(len(prefix), build((*prefix, 0)), build((*prefix, 1)))

        self.top = build(())

    def _leaf(self, counts: tuple) -> int:
        return self._shared(("leaf", counts), (None, None, counts))

    def _node(self, level: int, passed: int, failed: int) -> int:
        below = tuple(a + b for a, b in zip(self.nodes[passed][2], self.nodes[failed][2]))
        return self._shared((level, passed, failed), (passed, failed, below))

    def _shared(self, key: tuple, node: tuple) -> int:
        if key not in self.shared:
            self.shared[key] = len(self.nodes)
            self.nodes.append(node)
        return self.shared[key]

    def swap(self, level: int) -> None:
        """Exchange the variables of ``level`` and ``level + 1``; nodes further down stay as they are."""
        done: dict[tuple, int] = {}

        def renewed(node: int, at: int) -> int:
            if (node, at) not in done:
                passed, failed, _ = self.nodes[node]
                if at < level:
                    passed, failed = renewed(passed, at + 1), renewed(failed, at + 1)
                else:
                    (pp, pf, _), (fp, ff, _) = self.nodes[passed], self.nodes[failed]
                    passed, failed = self._node(level + 1, pp, fp), self._node(level + 1, pf, ff)
                done[node, at] = self._node(at, passed, failed)
            return done[node, at]

        self.top = renewed(self.top, 0)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def passing(self) -> list[tuple[tuple, tuple]]:
        """Counts kept and counts removed at each level of the path on which everything passes."""
        out, node = [], self.top
        for _ in self.order:
            passed, failed, _ = self.nodes[node]
            out.append((self.nodes[passed][2], self.nodes[failed][2]))
            node = passed
        return out

    def only(self, variable: str) -> tuple:
        """Counts of the mask in which nothing but ``variable`` fails."""
        node = self.top
        for name in self.order:
            node = self.nodes[node][name == variable]
        return self.nodes[node][2]


def adjacent_swaps(n: int) -> list[int]:
    """Levels to swap one after the other so that every order of ``n`` variables comes up once."""
    if n < 2:
        return []
    inner = adjacent_swaps(n - 1)
    down, up = list(range(n - 2, -1, -1)), list(range(n - 1))
    out = list(down)
    for k, at in enumerate(inner):
        # the last variable stands at the front after each run down, at the end after each run up
        out += [at + 1 if k % 2 == 0 else at, *(up if k % 2 == 0 else down)]
    return out


def steps(counts: dict[tuple, tuple], variables: str = FILTERS) -> list[tuple]:
    """``order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley`` of all orders;
    ``counts`` holds documents, good and toxic ones per mask."""
    diagram = Diagram(counts, variables)
    fails = {v: sum(c[0] for m, c in counts.items() if m[i]) for i, v in enumerate(variables)}
    alone = {v: diagram.only(v)[0] for v in variables}
    shares, paths = dict.fromkeys(variables, 0), []
    for level in [None, *adjacent_swaps(len(variables))]:
        if level is not None:
            diagram.swap(level)
        path = diagram.passing()
        paths.append((list(diagram.order), path))
        for v, (_, removed) in zip(diagram.order, path):
            shares[v] += removed[0]
    return [
        ("".join(order), step, kept[0], gone[0], fails[v] - gone[0], alone[v], gone[1], gone[2], shares[v])
        for order, path in paths
        for step, (v, (kept, gone)) in enumerate(zip(order, path), 1)
    ]


def text_failures(text: Column) -> dict[str, Column]:
    """The failure conditions that a text alone decides; null reads as empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)).cast("bigint") < 50 * F.size(words).cast("bigint"),
        "C": 100 * capitals.cast("bigint") > 3 * F.length(text).cast("bigint"),
        "D": text.rlike("[#$%&*|]"),
    }


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, a, b, c, d, e, n, good, toxic``: documents of every mask of failures in every part.

    Only the failures, hash and id of a text leave the scan. Copies of a text are counted before the
    text's smallest id decides which of them fail E, so a text that a third of all documents share is a
    few rows by then.
    """
    flags = [failed.cast("int").alias(name.lower()) for name, failed in text_failures(F.col("text")).items()]
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("text_key"),
        *flags,
    )
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    none = F.lit(None).cast("int")
    # rows without id have no labels; they stay out of the join, where they would be one key
    marked = rows.filter("id is not null").join(known, "id", "left")
    marked = marked.unionByName(rows.filter("id is null").select("*", none.alias("good"), none.alias("toxic")))
    kinds = ["text_key", "part", "a", "b", "c", "d", "good", "toxic"]
    same = marked.fillna(0, ["good", "toxic"]).groupBy(*kinds, "id").agg(F.count(F.lit(1)).alias("same"))
    named = F.col("id").isNotNull()
    counted = same.groupBy(*kinds).agg(
        F.sum("same").alias("n"),
        F.sum(F.when(named, F.col("same")).otherwise(0)).alias("named"),
        F.min(F.when(named, F.struct("id", "same"))).alias("lowest"),
    )
    # a few rows a text by now: its kinds, not its copies
    first = F.min("lowest.id").over(Window.partitionBy("text_key"))
    stays = F.when(F.col("lowest.id") == first, F.col("lowest.same")).otherwise(0)
    copied = counted.withColumn("copies", F.when(F.col("named") > 0, F.col("named") - stays).otherwise(0))
    verdicts = F.array(
        F.struct(F.lit(0).alias("e"), (F.col("n") - F.col("copies")).alias("n")),
        F.struct(F.lit(1).alias("e"), F.col("copies").alias("n")),
    )
    told = copied.withColumn("v", F.explode(verdicts)).filter("v.n > 0")
    return told.groupBy("part", "a", "b", "c", "d", F.col("v.e").alias("e")).agg(
        F.sum("v.n").alias("n"),
        F.sum(F.col("v.n") * F.col("good")).alias("good"),
        F.sum(F.col("v.n") * F.col("toxic")).alias("toxic"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step of that order (``docs``: ``doc_id, text, lang``;
    ``labels``: ``doc_id, quality, toxic``).

    A null lang is the part of the empty string, a null text is empty. Of rows with equal texts those
    with the smallest doc_id pass E, all of them if it is repeated; rows without doc_id pass E and make
    no other row fail. A document is good (toxic) if any row of its labels says so. An empty table has
    no parts.
    """

    def orders(counts: pd.DataFrame) -> pd.DataFrame:
        found = {tuple(r[:5]): tuple(r[5:]) for r in counts[["a", "b", "c", "d", "e", "n", "good", "toxic"]].to_numpy().tolist()}
        rows = [(counts["part"].iloc[0], *r) for r in steps(found)]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in OUT.split(", ")])

    return masks(docs, labels).groupBy("part").applyInPandas(orders, OUT)


#: The same from sums over masks: order, failures of the filters before a step, and failures at it.
CHECK = r"""
WITH told AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[ 	

]+'), lambda w: w <> '') AS words FROM documents),
flagged AS (
  SELECT doc_id, part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM told),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
  max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
masks AS (SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, count(*) AS n,
    sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM flagged LEFT JOIN marks USING (doc_id) GROUP BY 1, 2),
letters(f, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (SELECT p.f || q.f || r.f || s.f || t.f AS o
  FROM letters p, letters q, letters r, letters s, letters t
  WHERE p.bit + q.bit + r.bit + s.bit + t.bit = 31 AND p.f <> q.f AND p.f <> r.f AND p.f <> s.f AND p.f <> t.f
    AND q.f <> r.f AND q.f <> s.f AND q.f <> t.f AND r.f <> s.f AND r.f <> t.f AND s.f <> t.f),
placed AS (SELECT o, step, l.bit, coalesce((SELECT sum(b.bit) FROM letters b WHERE strpos(o, b.f) < step), 0)::INT AS earlier
  FROM orders, range(1, 6) x(step), letters l WHERE substr(o, step::INT, 1) = l.f),
summed AS (SELECT part, o, step, bit,
    sum(CASE WHEN mask & (earlier | bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & earlier = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & earlier > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & earlier = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & earlier = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM masks, placed GROUP BY 1, 2, 3, 4)
SELECT part, o AS filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
  toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM summed
"""
