"""Embedding near-dedup by int8 tile products with error bounds.

Vectors are scaled to length 1 and quantised to int8 with a scale of their own; the length of what
quantising leaves out bounds how far an approximate cosine can be from the exact one. Products of int8
codes are exact in float32 (in runs of 1,024 dimensions), so only pairs whose approximate cosine plus
bound reaches the threshold are computed again, in double precision from the original components.

Equal vectors are one class. Classes are dealt to blocks by a hash and every pair of blocks is one
group; a group returns counts of links and a spanning forest, never the links themselves.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devigil.llm.shared import Landing
from devigil.operators.components import connected_components

EXACT_DIMENSIONS = 1024
#: Covers the rounding of the bound and of the scaled products in float32.
SLACK = 1e-5
CLASS = ("hash_a", "hash_b", "size")


@dataclass(frozen=True)
class VectorParams:
    """Vectors are linked from cosine ``threshold`` on. A block holds about ``block`` classes; there
    are ``least_blocks`` at least. ``tile`` rows are multiplied at a time."""

    threshold: float = 0.9
    block: int = 4096
    least_blocks: int = 8
    tile: int = 512


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales and lengths of the error of vectors of length 1."""
    scale = np.abs(unit).max(1) / 127
    codes = np.rint(unit / scale[:, None])
    error = np.sqrt(((unit - codes * scale[:, None]) ** 2).sum(1))
    return codes.astype(np.int8), scale, error * (1 + 1e-9) + 1e-12


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of int8 codes; every run of dimensions is exact in float32."""
    out = 0
    for at in range(0, a.shape[1], EXACT_DIMENSIONS):
        run = slice(at, at + EXACT_DIMENSIONS)
        part = a[:, run].astype(np.float32) @ b[:, run].astype(np.float32).T
        out = part if a.shape[1] <= EXACT_DIMENSIONS else out + part.astype(np.float64)
    return out


def possible_pairs(a, b, threshold: float):
    """Positions of pairs whose cosine can reach the threshold; ``a, b`` are results of quantise."""
    (code_a, scale_a, error_a), (code_b, scale_b, error_b) = a, b
    # every pair of a column is at least this far from the threshold if its product is below; a bound
    # below 0 is lowest for the smallest scale
    reach = threshold - SLACK - error_a.max() * (1 + error_b) - error_b
    low = reach / (np.where(reach < 0, scale_a.min(), scale_a.max()) * scale_b)
    product = _product(code_a, code_b)
    i, j = np.nonzero(product >= (low - 1e-6 * np.abs(low) - 1).astype(product.dtype))
    about = product[i, j].astype(np.float64) * scale_a[i] * scale_b[j]
    good = about + error_a[i] * (1 + error_b[j]) + error_b[j] + SLACK >= threshold
    return i[good], j[good]


def _join(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the groups of i and j in ``label``, where every label is the smallest position."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(shorter := label[label], label):
            label[:] = shorter


def compare_blocks(own, vectors, copies, low, high, params: VectorParams):
    """Links of every vector and its smallest linked position; ``own`` is the block of each."""
    unit = vectors / np.sqrt((vectors**2).sum(1))[:, None]
    links, label = np.zeros(len(own), np.int64), np.arange(len(own))
    left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
    if not len(left) or not len(right):
        return links, label
    coded = quantise(unit)
    other = tuple(x[right] for x in coded)
    for at in range(0, len(left), params.tile):
        rows = left[at : at + params.tile]
        i, j = possible_pairs(tuple(x[rows] for x in coded), other, params.threshold)
        i, j = rows[i], right[j]
        if low == high:
            i, j = i[i < j], j[i < j]
        for part in range(0, len(i), 1 << 17):
            a, b = i[part : part + (1 << 17)], j[part : part + (1 << 17)]
            good = np.einsum("ij,ij->i", unit[a], unit[b]) >= params.threshold
            a, b = a[good], b[good]
            links += np.bincount(a, copies[b], len(own)).astype(np.int64)
            links += np.bincount(b, copies[a], len(own)).astype(np.int64)
            _join(label, a, b)
    return links, label


def near_vectors(rows: DataFrame, params: VectorParams = VectorParams()) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``rows`` (``vec_id, embedding``).

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and
    so do vectors of different lengths with each other. ``n_links`` counts rows, copies included. A
    row without vec_id links with nothing, stays and gets no component. Rows with the same vec_id are
    one vector for the components.
    """
    spark = rows.sparkSession
    store = Landing(spark, "vectors")
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")),
    )
    usable = finite & F.exists("embedding", lambda x: x != 0) & F.col("vec_id").isNotNull()
    vector = F.transform("embedding", lambda x: x.cast("double") + 0.0)
    keyed = rows.select(
        F.col("vec_id").cast("bigint"),
        F.when(F.coalesce(usable, F.lit(False)), vector).alias("vector"),
    )
    keyed = keyed.withColumns(
        {"hash_a": F.xxhash64("vector"), "hash_b": F.xxhash64("vector", F.lit(1)), "size": F.size("vector")}
    )
    usable_rows = keyed.filter("vector is not null")
    classes = usable_rows.groupBy(*CLASS).agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector")
    )
    classes = store.land(classes, "classes")
    n_blocks = max(params.least_blocks, -(-classes.count() // params.block))
    dealt = classes.select(
        "id", "size", "copies", "vector",
        F.pmod(F.xxhash64("hash_a", "hash_b"), F.lit(n_blocks)).alias("own"),
        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("other"),
    )
    dealt = dealt.select(
        "size", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        "own", "id", "copies", "vector",
    )

    def compare(group: pa.Table) -> pa.Table:
        size, low, high = (group.column(c)[0].as_py() for c in ("size", "low", "high"))
        flat = group.column("vector").combine_chunks().flatten()
        vectors = flat.to_numpy(zero_copy_only=False).reshape(-1, size)
        ids, own, copies = (group.column(c).to_numpy() for c in ("id", "own", "copies"))
        # a block with itself has its rows once; the others meet across only
        links, label = compare_blocks(own, vectors, copies, low, high, params)
        some = np.flatnonzero(links)
        return pa.table({"id": ids[some], "links": links[some], "root": ids[label[some]]})

    found = dealt.groupBy("size", "low", "high").applyInArrow(compare, "id bigint, links bigint, root bigint")
    found = store.land(found, "found")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    edges = found.filter("id <> root").select(F.col("id").alias("u"), F.col("root").alias("v"))
    component = connected_components(edges).select(F.col("node").alias("id"), "component")
    judged = classes.select(*CLASS, "id", "copies").join(links, "id", "left").join(component, "id", "left")
    judged = judged.select(
        *CLASS, F.coalesce("component", "id").alias("component_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    out = keyed.select("vec_id", *CLASS, F.col("vector").isNotNull().alias("usable")).join(judged, list(CLASS), "left")
    named = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id",
        F.when(F.col("usable"), F.col("n_links")).otherwise(0).cast("bigint").alias("n_links"),
        named.alias("component_id"),
        F.coalesce(F.col("vec_id") == named, F.lit(True)).alias("kept"),
    )
