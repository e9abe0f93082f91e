"""Filter audit and whitening against plain counting and dense linear algebra."""

import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from devigil.llm import audit, queries, whitening

DATA = "/root/testdata/sf0.001"


def plain_audit(docs, labels):
    """Every order applied to every document, one after the other."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    parts = {}
    for i, text, lang in docs:
        text = text or ""
        words = [w for w in re.split("[ \t\n\x0b\f\r]+", text) if w]
        failed = set()
        failed |= {"A"} if len(words) < 200 else set()
        failed |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        failed |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else set()
        failed |= {"D"} if re.search("[#$%&*|]", text) else set()
        failed |= {"E"} if i is not None and i > first[text] else set()
        parts.setdefault(lang or "", []).append((i, failed))
    rows = []
    for part, held in parts.items():
        removed, orders = {}, list(itertools.permutations("ABCDE"))
        for order in orders:
            left = held
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                removed[f] = removed.get(f, 0) + len(gone)
                fails = sum(f in d[1] for d in held)
                rows.append([part, "".join(order), step, len(left), len(gone), fails - len(gone),
                             sum(d[1] == {f} for d in held), sum(d[0] in good for d in gone),
                             sum(d[0] in toxic for d in gone), f])
        for r in rows:
            if r[0] == part:
                r[-1] = removed[r[-1]]
    return sorted(map(tuple, rows))


def test_every_order_equals_plain_filtering(spark):
    long = " ".join(f"w{i}" for i in range(250))
    docs = [
        (1, long, "en"), (2, long, "en"), (3, long, "de"), (3, long, "de"), (None, long, "en"), (None, long, None), (1, long, "fr"),
        (4, None, "en"), (5, "", None), (6, "", "en"), (7, "A B C # $", "de"), (8, "a " * 300, "de"), (9, long + " |", None),
        (10, "word " * 20000, "en"), (11, long.upper(), "en"), (12, long.upper(), ""), (13, "é" * 100, "en"), (14, "x y", "en"),
    ]
    labels = [(1, 1, 0), (2, 1, 1), (3, 0, 1), (3, 1, None), (7, None, 1), (None, 1, 1), (99, 1, 1), (8, 0, 0)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, lang string").withColumns({"part": F.lit(1), "N": F.lit("x")})
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").withColumn("good", F.lit(5))
    found = sorted(tuple(r) for r in audit.audit(frame, marks).collect())
    assert found == plain_audit(docs, labels)
    assert audit.audit(frame.limit(0), marks).count() == 0
    assert audit.audit(frame, marks.limit(0)).count() == len(found)


def test_swaps_reach_every_order_and_nodes_are_shared():
    for n in range(1, 6):
        order = list(range(n))
        seen = {tuple(order)}
        for at in audit.adjacent_swaps(n):
            order[at], order[at + 1] = order[at + 1], order[at]
            seen.add(tuple(order))
        assert len(seen) == len(list(itertools.permutations(range(n)))) == len(audit.adjacent_swaps(n)) + 1
    same = audit.Diagram({m: (1, 0, 0) for m in itertools.product((0, 1), repeat=5)}, "ABCDE")
    assert len(same.nodes) == 6


def dense(rows):
    x = np.array([[int(np.floor(256 * float(np.float32(c)))) for c in v] for v in rows], object)
    unique = np.unique(x.astype(np.int64), axis=0)
    n, sums = len(unique), unique.sum(0)
    centred = unique - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    deviation = [sum((n * a - int(s)) ** 2 for a, s in zip(r, sums)) for r in x]
    return x.astype(np.int64), n, sums, values[::-1], vectors[:, ::-1], deviation


def test_whitening_equals_dense_eigenvectors(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.standard_normal((300, 12)) * np.linspace(2, 0.1, 12)).astype(np.float32)
    vectors[150:] = vectors[:150]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    nan, inf = float("nan"), float("inf")
    odd = [(900, None), (901, [nan] * 12), (902, [inf] * 12), (903, [None] + [0.0] * 11), (904, []), (905, [1.0] * 3), (None, rows[0][1]), (0, rows[0][1])]
    frame = spark.createDataFrame([*rows, *odd], "vec_id bigint, embedding array<float>").withColumns({"x": F.lit(1), "component": F.lit("c")})
    out = whitening.whiten(frame).toPandas()
    x, n, sums, values, basis, deviation = dense(vectors)
    assert len(out) == 4 * 302 and (out.n == n).all() and out.identity_error.max() < 1e-9
    for c in range(4):
        one = out[(out.component == c + 1) & out.vec_id.between(1, 299)].sort_values("vec_id")
        want = ((x - sums / n) @ basis[:, c] / np.sqrt(values[c]))[1:]
        assert min(np.abs(one.whitened - want).max(), np.abs(one.whitened + want).max()) < 1e-10
        assert one.deviation.tolist() == deviation[1:]
        assert abs(one.explained.iloc[0] / (values[c] / values.sum()) - 1) < 1e-12
    assert whitening.whiten(frame.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("rows", "expected"),
    [
        ([[1.0, 0, 0], [0, 1.0, 0], [0, 0, 1.0]], [0.5, 0.5]),  # equal deviations, found by a second start
        ([[1.0, 2.0], [1.0, 2.0]], []),
        ([[3.0]], []),
        ([[0.0], [1.0]], [1.0]),
        ([[0.0, 0, 1], [1.0, 0, 1], [3.0, 0, 1]], [1.0]),
    ],
)
def test_few_dimensions(spark, rows, expected):
    frame = spark.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(rows)], "vec_id bigint, embedding array<double>")
    out = whitening.whiten(frame).toPandas()
    assert np.allclose(out.drop_duplicates("component").sort_values("component").explained, expected)
    assert len(out) == len(rows) * len(expected)


def test_equal_leading_deviations_are_all_found(spark):
    # a cross in ten dimensions: two arms of length 3, eight of length 1
    arms = np.diag([3.0, 3.0] + [1.0] * 8)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate([*arms, *-arms])], "vec_id bigint, embedding array<double>")
    shares = whitening.whiten(frame).toPandas().drop_duplicates("component").sort_values("component").explained
    assert np.allclose(shares, np.array([9, 9, 1, 1]) / 26)


def test_huge_entries_have_no_deviation(spark):
    frame = spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 1.0])], "vec_id bigint, embedding array<double>")
    assert all(r["deviation"] is None for r in whitening.whiten(frame).collect())


def test_whitening_query(spark):
    out = queries.op11_embedding_whitening(spark, DATA)
    assert out.count() == 4 * spark.read.parquet(f"{DATA}/embeddings.parquet").count()
