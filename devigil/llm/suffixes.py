"""Long repeats across documents with a family of sorted suffix indexes of geometric sizes.

Of the suffixes of a text those are indexed that start where the smallest 16-byte hash of some 50-byte
window stands; equal windows choose equal places, so every repeat of 50 bytes is found at one of them.
A batch of documents gets its suffix array: for each range of hashes one row with the sorted hashes and
the document of each. It is merge-scanned with the arrays of the levels there are, then becomes a level
itself, and levels of equal size merge, so a batch meets few levels however many came before.

The scans say which suffixes of which documents repeat elsewhere. Their windows are then compared with
each other on all 50 bytes, and bytes of windows that a smaller doc_id has too are removed.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devigil.llm.shared import Landing, partitions_of, slices, total
from devigil.llm.tokens import mix

#: Bytes that a window has, and bytes of the hash that places a suffix.
WINDOW, GRAM = 50, 16
SPAN = WINDOW - GRAM + 1
FACTOR = np.uint64(0x9E3779B97F4A7C15)
HEAD = np.dtype([("doc", "<i8"), ("text", "<i4"), ("start", "<u4"), ("n", "<u4")])
MANY = -(2**63)


@dataclass(frozen=True)
class SuffixParams:
    """A range of hashes has about ``range_bytes`` of text. ``batches`` is how many batches the
    documents are cut into, by doc_id; from the third on levels merge. Repeats are compared in ``rounds``
    shares of the hashes, one after the other; the texts sent for one share are gone before the next, so
    more rounds need less disk and more time.
    A worker packs ``chunk_bytes`` of text at a time."""

    range_bytes: int = 4 << 20
    batches: int = 4
    rounds: int = 1
    chunk_bytes: int = 4 << 20


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * FACTOR + b
    return x ^ (x >> np.uint64(29))


def rolling(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the 16 and of the 50 bytes from every place on (fewer places near the end)."""
    one = mix(np.arange(1, 257, dtype=np.uint64))[data]
    two = _joined(one[:-1], one[1:])
    four = _joined(two[:-2], two[2:])
    eight = _joined(four[:-4], four[4:])
    gram = _joined(eight[:-8], eight[8:])
    double = _joined(gram[:-16], gram[16:])
    most = _joined(double[:-16], gram[32:])
    return gram, _joined(most[:-2], two[48:])


def runs(data: np.ndarray, offsets: np.ndarray):
    """Runs of windows that share their smallest hash: ``key, text, start, number of windows``, and the
    hash of every window."""
    empty = np.zeros(0, np.int64)
    if len(data) < WINDOW:
        return empty.astype(np.uint64), empty, empty, empty, empty.astype(np.uint64)
    gram, window = rolling(data)
    least, reach = mix(gram), 1
    while 2 * reach <= SPAN:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    least = np.minimum(least[: len(least) - (SPAN - reach)], least[SPAN - reach :])
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(least)]
    inside = np.arange(len(least)) + WINDOW <= offsets[1:][text]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    start = np.flatnonzero(begins)
    # a run ends where the next begins or where windows would leave the text
    following = np.append(start[1:], len(least))
    last = offsets[1:][text[start]] - WINDOW + 1
    return mix(least[start] ^ FACTOR), text[start], start, np.minimum(following, last) - start, window


def _ranges(key: np.ndarray, count: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)


def _pieces(sorted_ranges: np.ndarray):
    """``range, first, last + 1`` of runs of equal ranges."""
    if not len(sorted_ranges):
        return
    cut = np.flatnonzero(np.diff(sorted_ranges)) + 1
    for a, b in zip(np.concatenate([[0], cut]), np.concatenate([cut, [len(sorted_ranges)]])):
        yield int(sorted_ranges[a]), int(a), int(b)


def _chunked(batches, column: int, most: int):
    """Runs of rows of about ``most`` bytes: the batch, its first row, and the texts as slices."""
    for batch in batches:
        for first, last, data, offsets in slices(batch.column(column), most):
            yield batch, first, last, data, offsets


def _contents(window: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A hash of all windows of each run and of their places in it."""
    if not len(n):
        return np.zeros(0, np.uint64)
    edges = np.cumsum(n) - n
    place = np.arange(n.sum()) - np.repeat(edges, n)
    return np.add.reduceat(mix(window[np.repeat(start, n) + place] ^ mix(place.astype(np.uint64))), edges)


INDEX = "kind int, range bigint, keys binary, docs binary"


def _rows(kinds, ranges, keys, docs) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(kinds, pa.int32()), pa.array(ranges, pa.int64()), pa.array(keys, pa.binary()), pa.array(docs, pa.binary())],
        names=["kind", "range", "keys", "docs"],
    )


def _own(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, sorted by key."""
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    return key[fresh], doc[fresh]


def _combined(key: np.ndarray, doc: np.ndarray):
    """One entry per key, and the pairs whose key has more than one document: those are known to
    repeat, and their entry is marked so that it names none of them."""
    key, doc = _own(key, doc)
    single, first, n = np.unique(key, return_index=True, return_counts=True)
    many = np.repeat(n > 1, n) & (doc != MANY)
    return single, np.where(n > 1, MANY, doc[first]), key[many], doc[many]


def suffix_array(docs: DataFrame, n_ranges: int, params: SuffixParams) -> DataFrame:
    """Rows of ``INDEX`` of ``doc_id, text``: kind 0 has the sorted array of a range, one entry per
    key; kind 1 has pairs that are known to repeat within the batch."""

    def pack(batches):
        for batch, first, last, data, offsets in _chunked(batches, 1, params.chunk_bytes):
            keys, owners = [], []
            ids = batch.column(0).slice(first, last - first).to_numpy(zero_copy_only=False)
            # hashes are made for parts that stay in the processor's cache
            at = 0
            while at < len(ids):
                end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + (1 << 18), "right")) - 1)
                end = min(end, len(ids))
                key, text, _, _, _ = runs(data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at])
                keys.append(key)
                owners.append(ids[at:end][text])
                at = end
            key, doc, many_key, many_doc = _combined(np.concatenate(keys), np.concatenate(owners))
            cuts = list(_pieces(_ranges(key, n_ranges)))
            yield _rows(
                [0] * len(cuts) + [1], [c[0] for c in cuts] + [int(many_key[0] % np.uint64(n_ranges)) if len(many_key) else 0],
                [key[a:b].tobytes() for _, a, b in cuts] + [many_key.tobytes()],
                [doc[a:b].tobytes() for _, a, b in cuts] + [many_doc.tobytes()],
            )

    def build(batches):
        held: list[tuple] = []
        now = None

        def done():
            key = np.concatenate([np.frombuffer(k, np.uint64) for k, _ in held])
            doc = np.concatenate([np.frombuffer(d, np.int64) for _, d in held])
            single, owner, many_key, many_doc = _combined(key, doc)
            return _rows([0, 1], [now, now], [single.tobytes(), many_key.tobytes()], [owner.tobytes(), many_doc.tobytes()])

        for batch in batches:
            for kind, at, keys, docs_ in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == 1:
                    yield _rows([1], [at], [keys], [docs_])
                    continue
                if at != now and held:
                    yield done()
                    held.clear()
                now = at
                held.append((keys, docs_))
        if held:
            yield done()

    packed = docs.mapInArrow(pack, INDEX).repartition("range").sortWithinPartitions("range")
    return packed.mapInArrow(build, INDEX)


def merge_scan(batch: DataFrame, level: DataFrame) -> DataFrame:
    """Pairs ``keys, docs`` of both sides whose key the other side has too."""
    other = level.select("range", F.col("keys").alias("level_keys"), F.col("docs").alias("level_docs"))
    both = batch.select("range", "keys", "docs").join(other, "range").drop("range")

    def scan(batches):
        for rows in batches:
            for i in range(rows.num_rows):
                key, doc, level_key, level_doc = (
                    np.frombuffer(c[i].as_buffer(), t) for c, t in zip(rows.columns, (np.uint64, np.int64) * 2)
                )
                _, a, b = np.intersect1d(key, level_key, assume_unique=True, return_indices=True)
                found = np.concatenate([key[a], level_key[b]]), np.concatenate([doc[a], level_doc[b]])
                named = found[1] != MANY
                yield _rows([1], [0], [found[0][named].tobytes()], [found[1][named].tobytes()])

    return both.mapInArrow(scan, INDEX)


def merge_levels(first: DataFrame, second: DataFrame) -> DataFrame:
    """One level of two. Keys that both have are known to repeat by now and name no document."""
    a, b = (x.select("range", F.col("keys").alias(f"keys_{n}"), F.col("docs").alias(f"docs_{n}")) for n, x in enumerate((first, second)))
    both = a.join(b, "range", "full").select("range", "keys_0", "docs_0", "keys_1", "docs_1")

    def merge(batches):
        for rows in batches:
            for at, *parts in zip(*(c.to_pylist() for c in rows.columns)):
                key = np.concatenate([np.frombuffer(x or b"", np.uint64) for x in parts[::2]])
                doc = np.concatenate([np.frombuffer(x or b"", np.int64) for x in parts[1::2]])
                single, owner, _, _ = _combined(key, doc)
                yield _rows([0], [at], [single.tobytes()], [owner.tobytes()])

    return both.mapInArrow(merge, INDEX)


@dataclass
class SuffixLevels:
    """The index family: ``levels`` are (number of batches, table) from the oldest to the newest, and
    ``repeats`` tables of pairs known to repeat."""

    spark: SparkSession
    n_ranges: int
    params: SuffixParams = field(default_factory=SuffixParams)

    def __post_init__(self):
        self.store = Landing(self.spark, "suffixes", release=True)
        self.levels: list[tuple[int, str, DataFrame]] = []
        self.repeats: list[DataFrame] = []
        self.repeat_names: list[str] = []
        self.count = 0

    def add(self, docs: DataFrame) -> None:
        """Index a batch of ``doc_id, text`` and record what repeats in it or in a level."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, old, a), (_, new, b) = self.levels[-2:]
            merged = self.store.land(merge_levels(a, b), name := f"level-{self.count}-{size}")
            self.store.drop(old, new)
            self.levels[-2:] = [(2 * size, name, merged)]
        name = f"batch-{self.count}"
        built = suffix_array(docs, self.n_ranges, self.params)
        array, own = self.store.land_parts(built, name, "kind", (0, 1))
        self.repeats.append(own.select("keys", "docs"))
        self.repeat_names.append(f"{name}/kind=1")
        for i, (_, _, level) in enumerate(self.levels):
            found = self.store.land(merge_scan(array, level), scanned := f"repeats-{self.count}-{i}")
            self.repeats.append(found.select("keys", "docs"))
            self.repeat_names.append(scanned)
        self.levels.append((1, f"{name}/kind=0", array))
        self.count += 1

    def pairs(self) -> DataFrame:
        """``doc_id, key`` of the suffixes that repeat in another document."""
        found = self.repeats[0]
        for more in self.repeats[1:]:
            found = found.unionByName(more)

        def unpack(batches):
            for rows in batches:
                for keys, docs in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.frombuffer(docs, np.int64)), pa.array(np.frombuffer(keys, np.int64))],
                        names=["doc_id", "key"],
                    )

        return found.select("keys", "docs").mapInArrow(unpack, "doc_id bigint, key bigint")

    def drop(self) -> None:
        self.store.drop(*[name for _, name, _ in self.levels])


PACKED = "range bigint, heads binary, data binary"


def _packed(ranges, heads, data) -> pa.RecordBatch:
    columns = [pa.array(ranges, pa.int64()), pa.array(heads, pa.binary()), pa.array(data, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["range", "heads", "data"])


def segments(docs: DataFrame, n_ranges: int, params: SuffixParams) -> DataFrame:
    """From ``doc_id, text_hash, text, keys`` the runs of windows with one of the keys, packed by
    range. Of equal runs in a chunk only those of the smallest doc_id are sent; the others are known to
    be covered, and a row without heads has their ``doc_id, text_hash, first, last``."""

    def cut(batches):
        for batch, at, end, data, offsets in _chunked(batches, 2, 1 << 19):
            ids, hashes = (batch.column(i).slice(at, end - at).to_numpy(zero_copy_only=False) for i in (0, 1))
            wanted = batch.column(3).slice(at, end - at)
            lengths = wanted.value_lengths().to_numpy(zero_copy_only=False)
            salt = mix(np.arange(1, end - at + 1, dtype=np.uint64))
            known = wanted.flatten().to_numpy(zero_copy_only=False).view(np.uint64) ^ np.repeat(salt, lengths)
            key, text, start, n, window = runs(data, offsets)
            held = np.isin(key ^ salt[text], known)
            key, text, start, n = key[held], text[held], start[held], n[held]
            if not len(key):
                continue
            doc = ids[text]
            alike = mix(key ^ mix(window[start]) ^ (window[start + n - 1] * FACTOR)) + n.astype(np.uint64)
            # the first and the last window have all bytes of a run up to this length only
            long = n > WINDOW + 1
            alike[long] ^= _contents(window, start[long], n[long])
            order = np.lexsort((doc, alike))
            alike, doc_ = alike[order], doc[order]
            group = np.ones(len(order), bool)
            group[1:] = alike[1:] != alike[:-1]
            smallest = doc_[group][np.cumsum(group) - 1]
            over = order[doc_ > smallest]
            local = start[over] - offsets[text[over]]
            known_ = np.stack([doc[over], hashes[text[over]], local, local + n[over] - 1 + WINDOW])
            yield _packed([int(ids[0]) % n_ranges], [None], [known_.astype(np.int64).tobytes()])
            sent = order[doc_ == smallest]
            place = _ranges(key[sent], n_ranges)
            sent = sent[np.argsort(place, kind="stable")]
            heads = np.empty(len(sent), HEAD)
            heads["doc"], heads["text"] = doc[sent], hashes[text[sent]]
            heads["start"], heads["n"] = start[sent] - offsets[text[sent]], n[sent]
            rows: list[list] = [[], [], []]
            for where, a, b in _pieces(_ranges(key[sent], n_ranges)):
                rows[0].append(where)
                rows[1].append(heads[a:b].tobytes())
                size = n[sent[a:b]] - 1 + WINDOW
                begin = np.repeat(start[sent[a:b]] - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
                rows[2].append(data[begin + np.arange(len(begin))].tobytes())
            yield _packed(*rows)

    return docs.mapInArrow(cut, PACKED)


def covered(packed: DataFrame) -> DataFrame:
    """``doc_id, text_hash, first, last``: bytes under windows that a smaller doc_id has too."""

    def compare(batches):
        held: list[tuple] = []
        now = None

        def done():
            heads = np.concatenate([np.frombuffer(h, HEAD) for h, _ in held])
            data = np.frombuffer(b"".join(d for _, d in held), np.uint8)
            n = heads["n"].astype(np.int64)
            begins = np.concatenate([[0], np.cumsum(n - 1 + WINDOW)[:-1]])
            run = np.repeat(np.arange(len(n)), n)
            place = np.arange(len(run)) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n)
            window = np.empty(len(run), np.uint64)
            # hashes part by part: at most some MB of text at a time
            most = 1 << 15
            for a in range(0, len(n), most):
                b = min(a + most, len(n))
                end = begins[b] if b < len(n) else len(data)
                part = (run >= a) & (run < b)
                window[part] = rolling(data[begins[a] : end])[1][begins[run[part]] + place[part] - begins[a]]
            doc = heads["doc"][run]
            order = np.argsort(window)
            sorted_ = window[order]
            fresh = np.ones(len(order), bool)
            fresh[1:] = sorted_[1:] != sorted_[:-1]
            least = np.minimum.reduceat(doc[order], np.flatnonzero(fresh))[np.cumsum(fresh) - 1]
            over = np.empty(len(order), bool)
            over[order] = doc[order] > least
            begin = over.copy()
            begin[1:] &= ~over[:-1] | (run[1:] != run[:-1])
            end = over.copy()
            end[:-1] &= ~over[1:] | (run[1:] != run[:-1])
            a, b = np.flatnonzero(begin), np.flatnonzero(end)
            own = heads[run[a]]
            start = own["start"].astype(np.int64)
            return own["doc"], own["text"].astype(np.int64), start + place[a], start + place[b] + WINDOW

        def batch_of(columns) -> pa.RecordBatch:
            names = ["doc_id", "text_hash", "first", "last"]
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in columns], names=names)

        for batch in batches:
            for where, heads, data in zip(*(c.to_pylist() for c in batch.columns)):
                if heads is None:
                    yield batch_of(np.frombuffer(data, np.int64).reshape(4, -1))
                    continue
                if where != now and held:
                    yield batch_of(done())
                    held.clear()
                now = where
                held.append((heads, data))
        if held:
            yield batch_of(done())

    rows = packed.repartition("range").sortWithinPartitions("range")
    return rows.mapInArrow(compare, "doc_id bigint, text_hash bigint, first bigint, last bigint")


REMOVED = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string"


def _cut_out(rows: DataFrame, texts: bool) -> DataFrame:
    """Apply the byte ranges in ``spans`` to the texts."""

    def cut(batches):
        for batch, at, end, data, offsets in _chunked(batches, 1, 1 << 20):
            spans = batch.column(2).slice(at, end - at)
            n = np.array([0 if x is None else len(x) for x in spans.to_pylist()]) if spans.null_count else spans.value_lengths().to_numpy()
            flat = spans.flatten()
            first, last = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            base = np.repeat(offsets[:-1], n)
            change = np.zeros(len(data) + 1, np.int64)
            np.add.at(change, first + base, 1)
            np.add.at(change, last + base, -1)
            gone = np.cumsum(change[:-1]) > 0
            begin = gone.copy()
            begin[1:] &= ~gone[:-1]
            edges = offsets[:-1][offsets[:-1] < len(data)]
            begin[edges] |= gone[edges]
            count = np.concatenate([[0], np.cumsum(gone)])
            starts = np.concatenate([[0], np.cumsum(begin)])
            kept, digest = [], []
            for a, b in zip(offsets[:-1], offsets[1:]):
                left = data[a:b] if count[a] == count[b] else data[a:b][~gone[a:b]]
                raw = left.tobytes()
                digest.append(hashlib.sha256(raw).hexdigest())
                kept.append(raw.decode("utf-8", "replace") if texts else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(at, end - at),
                    pa.array(np.diff(offsets)),
                    pa.array(count[offsets[1:]] - count[offsets[:-1]]),
                    pa.array(starts[offsets[1:]] - starts[offsets[:-1]]),
                    pa.array(digest, pa.string()),
                    pa.array(kept, pa.string()),
                ],
                names=[part.split()[0] for part in REMOVED.split(", ")],
            )

    return rows.select("doc_id", "text", "spans").mapInArrow(cut, REMOVED)


def text_hash(text):
    """Tells the texts of rows with the same doc_id apart."""
    return F.hash(text).cast("bigint")


def whole_copies(docs: DataFrame, store: Landing) -> DataFrame:
    """``doc_id, text_hash, first, last`` over the whole of texts that a smaller doc_id has too."""
    size = F.octet_length("text").cast("bigint")
    same = ["a", "b", "last"]
    texts = docs.select(
        "doc_id", text_hash(F.col("text")).alias("text_hash"), F.xxhash64("text").alias("a"),
        F.xxhash64("text", F.lit(1)).alias("b"), size.alias("last"),
    )
    texts = store.land(texts, "texts")
    firsts = texts.groupBy(*same).agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("most"))
    firsts = store.land(firsts.filter("owner < most").drop("most"), "firsts")
    found = texts.join(firsts, same).filter("doc_id > owner")
    return found.select("doc_id", "text_hash", F.lit(0).cast("bigint").alias("first"), "last")


def remove_repeats(docs: DataFrame, params: SuffixParams = SuffixParams(), texts: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text`` for every row of ``docs``.

    A null text is empty. Rows without doc_id keep all bytes and take none from others; rows with the
    same doc_id take none from each other. Cut ends of characters in ``kept_text`` are replaced
    (without ``texts`` it is null); the hash is that of the exact bytes.
    """
    spark = docs.sparkSession
    store = Landing(spark, "repeats", release=True)
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    usable = rows.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= WINDOW))
    n_ranges = partitions_of(total(usable, F.octet_length("text")), params.range_bytes)
    family = SuffixLevels(spark, n_ranges, params)
    shares = [i / params.batches for i in range(1, params.batches)]
    cuts = usable.approxQuantile("doc_id", shares, 0.01) if shares else []
    edges = [None, *sorted(set(cuts)), None]
    for low, high in zip(edges, edges[1:]):
        own = usable
        own = own if low is None else own.filter(F.col("doc_id") > low)
        own = own if high is None else own.filter(F.col("doc_id") <= high)
        family.add(own)
    copies = store.land(whole_copies(usable, store), "copies")
    # a row whose id no other row has needs no closer look if it is a copy
    single = usable.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n = 1").select("doc_id")
    done = copies.join(single, "doc_id", "left_semi").select("doc_id")
    pairs = family.pairs().join(done, "doc_id", "left_anti")
    family.drop()
    hashed = usable.withColumn("text_hash", text_hash(F.col("text")))
    found = copies
    # equal windows have equal hashes, so each share of them is complete in itself
    for share in range(params.rounds):
        own = pairs.filter(F.pmod("key", F.lit(params.rounds)) == share)
        keyed = hashed.join(own.groupBy("doc_id").agg(F.collect_list("key").alias("keys")), "doc_id")
        sent = segments(keyed.select("doc_id", "text_hash", "text", "keys"), -(-n_ranges // params.rounds), params)
        found = found.unionByName(store.land(covered(sent), f"covered-{share}"))
    spans = found.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    spans = store.land(spans, "spans")
    family.store.drop(*family.repeat_names)
    store.drop("texts", "firsts", "copies", *[f"covered-{share}" for share in range(params.rounds)])
    hashed = rows.withColumn("text_hash", text_hash(F.col("text")))
    out = _cut_out(hashed.join(spans, ["doc_id", "text_hash"], "left"), texts)
    return out
