"""MinHash near-dedup with a multi-index Hamming join of b-bit signatures.

A signature has 64 items of 16 bits. Two documents with a similarity of 0.75 differ in a quarter of
them on average, and in more than 31 once in some ten thousand cases. Signatures that differ in at
most 31 of 64 items differ in at most one item of some chunk of four: of 16 chunks with two errors
each there would be 32. So each chunk is indexed four times, each time without one of its items, and
every pair within the distance meets in at least one of 64 buckets.

Only the groups count, not the links in them. First every member of a bucket is compared with the
bucket's smallest id, then all pairs of a bucket that are still in different groups. The documents
left for that get a second, longer signature of single bits, which decides far more sharply which
pairs can be similar. Every link is judged on full sets.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devigil.llm.shared import Landing, arrow_rows, likely_among, slices
from devigil.llm.tokens import NOT_SPACE, mix, shingles, word_hashes, words
from devigil.operators.components import connected_components

ITEMS, CHUNK = 64, 4
CHUNKS = ITEMS // CHUNK
FARTHEST = 2 * CHUNKS - 1
#: Bits of the long signature, and how many differ at most (mean and 4.7 standard deviations at 0.75).
LONG = 4096
LONG_FARTHEST = 612


@dataclass(frozen=True)
class NearParams:
    """Documents are linked if ``100 * intersection >= percent * union`` of their shingles of
    ``shingle`` words. Buckets of more than ``block`` members are compared in pairs of blocks. Python
    gets ``batch`` rows at once, or ``pair_batch`` pairs of texts."""

    percent: int = 75
    shingle: int = 5
    block: int = 1024
    batch: int = 2000
    pair_batch: int = 128


def _sets(data, offsets, size):
    """Distinct shingles of every text, sorted, and the bounds of each text's."""
    starts, first = words(data, offsets, NOT_SPACE)
    hashes, bounds = shingles(word_hashes(data, starts, NOT_SPACE), first, size)
    own = [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    edges = np.concatenate([[0], np.cumsum([len(s) for s in own])]).astype(np.int64)
    return own, edges


def _minhash(own: list, edges: np.ndarray) -> np.ndarray:
    """Signatures of the texts that have shingles."""
    some = [s for s in own if len(s)]
    if not some:
        return np.zeros((0, ITEMS), np.uint16)
    flat = np.concatenate(some)
    low, high = flat.astype(np.uint32), (flat >> np.uint64(32)).astype(np.uint32)
    starts = edges[:-1][np.diff(edges) > 0]
    numbers = mix(np.arange(1, 2 * ITEMS + 1, dtype=np.uint64)).astype(np.uint32) | np.uint32(1)
    out = np.empty((len(some), ITEMS), np.uint16)
    for i in range(ITEMS):
        least = np.minimum.reduceat(low * numbers[2 * i] + high * numbers[2 * i + 1], starts)
        out[:, i] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return out


def long_signatures(docs: DataFrame, ids: DataFrame, params: NearParams) -> DataFrame:
    """``id, bits`` for the documents in ``ids``: one bit of each of 4,096 minima."""
    size = params.shingle

    def sign(batches):
        numbers = mix(np.arange(1000, 1000 + 2 * LONG, dtype=np.uint64)).astype(np.uint32) | np.uint32(1)
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(1), 1 << 18):
                own, edges = _sets(data, offsets, size)
                flat = np.concatenate(own)
                low, high = flat.astype(np.uint32), (flat >> np.uint64(32)).astype(np.uint32)
                bits = np.empty((len(own), LONG), np.uint8)
                for i in range(LONG):
                    least = np.minimum.reduceat(low * numbers[2 * i] + high * numbers[2 * i + 1], edges[:-1])
                    bits[:, i] = (least * np.uint32(0x9E3779B1)) >> np.uint32(31)
                packed = np.packbits(bits, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array([p.tobytes() for p in packed], pa.binary())],
                    names=["id", "bits"],
                )

    rows = docs.filter("text is not null").select(F.col("doc_id").cast("bigint").alias("id"), "text")
    # a document without words is in no bucket, unless another row has its id
    rows = rows.filter(F.col("text").rlike(r"[^ \t\n\x0B\f\r]"))
    rows = rows.filter(likely_among("id", ids)).join(ids, "id", "left_semi")
    return rows.mapInArrow(sign, "id bigint, bits binary")


def signatures(docs: DataFrame, params: NearParams) -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b, signature``; equal sets have equal ``set_a, set_b``."""
    size = params.shingle

    def sign(batches):
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(1)):
                own, edges = _sets(data, offsets, size)
                counts = np.diff(edges)
                sums = np.zeros((2, len(own)), np.uint64)
                held = counts > 0
                if held.any():
                    flat = np.concatenate([s for s in own if len(s)])
                    sums[0, held] = np.add.reduceat(flat, edges[:-1][held])
                    sums[1, held] = np.add.reduceat(mix(flat ^ np.uint64(0x5BD1E995)), edges[:-1][held])
                packed = iter(_minhash(own, edges))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(counts),
                        pa.array(sums[0].view(np.int64)),
                        pa.array(sums[1].view(np.int64)),
                        pa.array([next(packed).tobytes() if h else None for h in held], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "signature"],
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        sign, "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, signature binary"
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, ITEMS)


def index_keys(classes: DataFrame) -> DataFrame:
    """``key, id``: the 64 buckets of every signature. A key names its chunk and the item left out."""

    def keys(batches):
        for batch in batches:
            items = _matrix(batch.column(1)).astype(np.int64).reshape(-1, CHUNKS, CHUNK)
            out = np.empty((len(items), CHUNKS, CHUNK), np.int64)
            for left_out in range(CHUNK):
                a, b, c = (items[:, :, i] for i in range(CHUNK) if i != left_out)
                out[:, :, left_out] = (a << 32) | (b << 16) | c
            out |= np.arange(ITEMS).reshape(CHUNKS, CHUNK) << 48
            yield pa.RecordBatch.from_arrays(
                [pa.array(out.ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), ITEMS))], names=["key", "id"]
            )

    return classes.select("id", "signature").mapInArrow(keys, "key bigint, id bigint")


def within_distance(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose signatures differ in at most ``FARTHEST`` items."""
    signed = pairs.join(classes.select(F.col("id").alias("a"), F.col("signature").alias("sig_a")), "a")
    signed = signed.join(classes.select(F.col("id").alias("b"), F.col("signature").alias("sig_b")), "b")

    def near(batches):
        for batch in batches:
            apart = (_matrix(batch.column(2)) != _matrix(batch.column(3))).sum(1)
            kept = np.flatnonzero(apart <= FARTHEST)
            yield batch.select(["a", "b"]).take(pa.array(kept))

    return signed.select("a", "b", "sig_a", "sig_b").mapInArrow(near, "a bigint, b bigint")


def confirm(pairs: DataFrame, docs: DataFrame, params: NearParams) -> DataFrame:
    """The pairs ``a, b`` that are linked, judged on the full sets of their texts."""
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    rows = docs.filter("text is not null").select(F.col("doc_id").cast("bigint").alias("id"), "text")
    texts = rows.filter(likely_among("id", wanted)).join(wanted, "id", "left_semi")
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    percent, size = params.percent, params.shingle

    def linked(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                held = []
                for column in (2, 3):
                    coded = part.column(column).dictionary_encode()
                    own = [s for _, _, data, offsets in slices(coded.dictionary) for s in _sets(data, offsets, size)[0]]
                    held.append([own[i] for i in coded.indices.to_pylist()])
                good = []
                for i, (a, b) in enumerate(zip(*held)):
                    fewer, more = sorted((len(a), len(b)))
                    if fewer and 100 * fewer >= percent * more:
                        common = len(np.intersect1d(a, b, assume_unique=True))
                        if 100 * common >= percent * (fewer + more - common):
                            good.append(i)
                yield part.select(["a", "b"]).take(pa.array(good, pa.int64()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(linked, "a bigint, b bigint")


def _bucket_pairs(ids, groups, blocks, key, component, signature, bits):
    """Pairs of a bucket in different components within both distances, each in its first common
    bucket. Rows are sorted by group."""
    n = len(ids)
    ends = np.searchsorted(groups, groups, "right")
    tag = key >> 48
    out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    rows = np.arange(n)
    for step in range(1, n):
        rows = rows[ends[rows] > rows + step]
        if not len(rows):
            break
        other = rows + step
        use = component[rows] != component[other]
        use &= (blocks[rows] < 0) | (blocks[rows] != blocks[other])
        i, j = rows[use], other[use]
        for part in range(0, len(i), 1 << 15):
            a, b = i[part : part + (1 << 15)], j[part : part + (1 << 15)]
            differ = (signature[a] != signature[b]).reshape(-1, CHUNKS, CHUNK)
            errors = differ.sum(2)
            chunk = (errors <= 1).argmax(1)
            left_out = differ[np.arange(len(a)), chunk].argmax(1)
            good = (errors.sum(1) <= FARTHEST) & (chunk * CHUNK + left_out == tag[a])
            a, b = a[good], b[good]
            good = np.bitwise_count(bits[a] ^ bits[b]).sum(1, dtype=np.int64) <= LONG_FARTHEST
            out_a.append(ids[a[good]])
            out_b.append(ids[b[good]])
    return np.concatenate(out_a), np.concatenate(out_b)


def mixed_buckets(members: DataFrame, component: DataFrame, params: NearParams) -> DataFrame:
    """``key, id, component, blocks`` of the buckets that hold more than one component."""
    placed = members.join(component, "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("component")
    )
    mixed = placed.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi")
    )
    mixed = mixed.filter("lo < hi").select("key", F.ceil(F.col("n") / params.block).alias("blocks"))
    return placed.join(mixed, "key")


def cross_pairs(mixed: DataFrame, signed: DataFrame) -> DataFrame:
    """``a, b`` (a < b) within the distances that share a bucket but not yet a component.

    A crowded bucket is dealt out as pairs of blocks, so a task holds two blocks at a time.
    """
    rows = mixed.join(signed, "id")
    own = F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("id"), "blocks")).otherwise(-1)
    rows = rows.withColumn("own", own)
    other = F.when(F.col("blocks") > 1, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(
        F.array(F.lit(-1).cast("bigint"))
    )
    rows = rows.withColumn("other", F.explode(other)).select(
        "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own",
        "id", "component", "signature", "bits",
    )
    rows = rows.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "id")

    def search(batches):
        held = None
        for batch in _with_end(batches):
            if batch is not None:
                held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if held is None or not held.num_rows:
                continue
            held = held.combine_chunks()
            key, low, high, own, ids, comp = (held.column(i).to_numpy() for i in range(6))
            fresh = np.ones(len(key), bool)
            fresh[1:] = (np.diff(key) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0)
            cut = len(key) if batch is None else int(np.flatnonzero(fresh)[-1])
            if not cut:
                continue
            groups = np.cumsum(fresh)[:cut]
            # two blocks meet only across; a block meets itself in the group of its own
            blocks = np.where(low == high, -1, own)[:cut]
            sig = _matrix(held.column(6).slice(0, cut).combine_chunks())
            packed = b"".join(held.column(7).slice(0, cut).to_pylist())
            bits = np.frombuffer(packed, np.uint64).reshape(-1, LONG // 64)
            a, b = _bucket_pairs(ids[:cut], groups, blocks, key[:cut], comp[:cut], sig, bits)
            held = held.slice(cut)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"]
            )

    return rows.mapInArrow(search, "a bigint, b bigint").distinct()


def _with_end(batches):
    yield from batches
    yield None


def near_duplicates(docs: DataFrame, params: NearParams = NearParams()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (``doc_id, text``).

    A null or blank text has no shingles and links with nothing. Rows with the same doc_id count as
    one document that links if one of them does. Rows without doc_id link with nothing, stay and get
    no component.
    """
    spark = docs.sparkSession
    store = Landing(spark, "near")
    with arrow_rows(spark, params.batch):
        rows = store.land(signatures(docs, params), "rows")
        named = rows.filter("n_shingles > 0 and doc_id is not null")
        classes = named.groupBy("set_a", "set_b", "n_shingles").agg(
            F.min("doc_id").alias("id"), F.first("signature").alias("signature")
        )
        classes = store.land(classes, "classes")
        keys = index_keys(classes)
        hubs = keys.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("most"))
        members = store.land(keys.join(hubs.filter("hub < most").select("key", "hub"), "key"), "members")

        star = members.filter("hub < id").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
        tested = store.land(within_distance(star, classes), "star")
        with arrow_rows(spark, params.pair_batch):
            edges = store.land(confirm(tested, docs, params), "links")
        # equal sets under several ids of one document are links too
        same = named.join(classes.select("set_a", "set_b", "n_shingles", "id"), ["set_a", "set_b", "n_shingles"])
        twice = named.groupBy("doc_id").agg(F.min("set_a").alias("lo"), F.max("set_a").alias("hi")).filter("lo < hi")
        shared = same.join(twice, "doc_id", "left_semi").select(F.col("id").alias("u"), F.col("doc_id").alias("v"))
        links = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(shared)
        component = store.land(_components(links), "components")
        mixed = store.land(mixed_buckets(members, component, params), "mixed")
        left = mixed.select("id").distinct()
        signed = long_signatures(docs, left, params).distinct().join(classes.select("id", "signature"), "id")
        signed = store.land(signed, "signed")
        pairs = cross_pairs(mixed, signed).join(tested, ["a", "b"], "left_anti")
        pairs = store.land(pairs, "pairs")
        with arrow_rows(spark, params.pair_batch):
            more = store.land(confirm(pairs, docs, params), "more-links")
        if not more.isEmpty():
            stars = component.select(F.col("id").alias("u"), F.col("component").alias("v"))
            component = _components(stars.union(more.select(F.col("a").alias("u"), F.col("b").alias("v"))))
        store.drop("members")
    ids = classes.join(component, "id", "left").select(
        "set_a", "set_b", "n_shingles", F.coalesce("component", "id").alias("component_id")
    )
    out = rows.join(ids, ["set_a", "set_b", "n_shingles"], "left")
    named_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id", "n_shingles", named_id.alias("component_id"),
        F.coalesce(F.col("doc_id") == named_id, F.lit(True)).alias("kept"),
    )


def _components(links: DataFrame) -> DataFrame:
    found = connected_components(links.select("u", "v"))
    return found.select(F.col("node").alias("id"), "component")
