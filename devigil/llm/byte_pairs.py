"""Byte-level BPE: ranked merges folded over the bytes of distinct words, and decoding.

A text is split into words by the pattern of the vocabulary, in the JVM. Words repeat, so the frequent
ones, a dictionary of bounded size, are folded once and go to the workers, which put the ids of a text
together; the rare words that are left are folded there, each once in a run of texts. The fold starts
from the ids of the bytes and merges the pair of lowest rank until no pair has one, for many words of
equal length at a time. Ranks are an array in which every pair of ids has a place of its own (a perfect
hash), so that a look-up is a few operations on numbers.
"""

from __future__ import annotations

import base64
import heapq
import json
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devigil.llm.shared import Landing

# --- fixed values: letters and numbers that Unicode 14 to 16 added, which older JVMs do not know --
NEW_LETTERS = """870-887 889-88E 8B5 8C8-8C9 C5D CDD 170D 171F 1B4C 1C89-1C8A 2C2F 2C5F 9FFD-9FFF
A7C0-A7C1 A7CB-A7CD A7D0-A7D1 A7D3 A7D5-A7DC A7F2-A7F4 10570-1057A 1057C-1058A 1058C-10592 10594-10595
10597-105A1 105A3-105B1 105B3-105B9 105BB-105BC 105C0-105F3 10780-10785 10787-107B0 107B2-107BA
10D4A-10D65 10D6F-10D85 10EC2-10EC4 10F70-10F81 11071-11072 11075 1123F-11240 11380-11389 1138B 1138E
11390-113B5 113B7 113D1 113D3 11740-11746 11AB0-11ABF 11BC0-11BE0 11F02 11F04-11F10 11F12-11F33
12F90-12FF0 1342F 13441-13446 13460-143FA 16100-1611D 16A70-16ABE 16D40-16D6C 18CFF 1AFF0-1AFF3
1AFF5-1AFFB 1AFFD-1AFFE 1B11F-1B122 1B132 1B155 1DF00-1DF1E 1DF25-1DF2A 1E030-1E06D 1E290-1E2AD
1E4D0-1E4EB 1E5D0-1E5ED 1E5F0 1E7E0-1E7E6 1E7E8-1E7EB 1E7ED-1E7EE 1E7F0-1E7FE 2A6DE-2A6DF
2B735-2B739 2EBF0-2EE5D 31350-323AF"""
NEW_NUMBERS = """10D40-10D49 116D0-116E3 11BF0-11BF9 11F50-11F59 16130-16139 16AC0-16AC9 16D70-16D79
1CCF0-1CCF9 1D2C0-1D2D3 1E4F0-1E4F9 1E5F1-1E5FA"""
OTHER_SPACE = "85 A0 1680 2000-200A 2028-2029 202F 205F 3000"
# --- end of fixed values ------------------------------------------------------------------------

#: Ids are below this.
SPAN = 1 << 20
#: Bytes of words of equal length that are folded at a time.
FOLD_CELLS = 1 << 20
#: Fewer words of equal length are merged one by one.
FEW = 16
LARGEST = (1 << 63) - 1


@dataclass(frozen=True)
class BytePairParams:
    """At most ``dictionary`` words of at most ``frequent_bytes`` bytes are folded once and sent to the workers.
    Words of more than ``long_bytes`` bytes are merged by a heap, as a fold is quadratic in a word.
    About ``slice_words`` words are looked up at a time."""

    dictionary: int = 1 << 20
    frequent_bytes: int = 64
    long_bytes: int = 256
    slice_words: int = 1 << 19


def _ranges(text: str) -> str:
    """A class of the code points in ``text``; one test of the whole range keeps most characters out."""
    parts = [[rf"\x{{{end}}}" for end in part.split("-")] for part in text.split()]
    return f"[{parts[0][0]}-{parts[-1][-1]}&&[{''.join('-'.join(ends) for ends in parts)}]]"


def java_pattern(pattern: str) -> str:
    """The pattern with its classes of letters, numbers and white space written out for Java."""
    letters, numbers = r"\p{L}" + _ranges(NEW_LETTERS), r"\p{N}" + _ranges(NEW_NUMBERS)
    space = r"\t-\r\x{20}" + _ranges(OTHER_SPACE)
    marks = {r"[^\s\p{L}\p{N}]": "\0", r"\p{L}": "\1", r"\p{N}": "\2", r"\s": "\3", r"\S": "\4"}
    classes = [f"[^{letters}{numbers}{space}]", f"[{letters}]", f"[{numbers}]", f"[{space}]", f"[^{space}]"]
    for sign, mark in marks.items():
        pattern = pattern.replace(sign, mark)
    return "".join(classes[ord(c)] if ord(c) < len(classes) else c for c in pattern)


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a token in base64 and its rank in every line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@dataclass(frozen=True)
class Vocabulary:
    """Ranks of tokens, ids of the bytes, ranks of pairs of bytes, and the ranks of pairs of ids by a
    perfect hash. Numbers are unsigned."""

    ranks: dict[bytes, int]
    bytes: np.ndarray
    byte_pairs: np.ndarray
    shift: np.ndarray
    place: np.ndarray

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of every pair, ``SPAN`` for a pair without one."""
        span, groups, size = (np.uint64(n) for n in (SPAN, len(self.shift), len(self.place)))
        key = left * span + right
        # of a pair that is none of the keys, the difference is too large, or would be negative and wraps round
        return np.minimum(self.place[(key + self.shift[key % groups]) % size] - key * span, span)


@cache
def _vocabulary(path: str) -> Vocabulary:
    ranks = read_ranks(path)
    pairs, merged = [], []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pairs.append(left * SPAN + right)
                merged.append(rank)
    keys = np.array(pairs, np.int64)
    groups, size, shift = _perfect_hash(keys)
    place = np.full(size, LARGEST // 2 + 1, np.int64)
    place[(keys + shift[keys % groups]) % size] = keys * SPAN + np.array(merged, np.int64)
    of_bytes = np.array([ranks[bytes([b])] for b in range(256)], np.uint64)
    of_pairs = np.array([[ranks.get(bytes([a, b]), SPAN) for b in range(256)] for a in range(256)], np.uint64)
    return Vocabulary(ranks, of_bytes, of_pairs, shift.astype(np.uint64), place.astype(np.uint64))


def _perfect_hash(keys: np.ndarray) -> tuple[int, int, np.ndarray]:
    """``groups, size, shift``: ``(key + shift[key % groups]) % size`` differs for all keys."""
    groups, size = len(keys) // 3 | 1, 2 * len(keys) | 1
    while True:
        group = keys % groups
        order = np.argsort(group, kind="stable")
        parts = np.split(keys[order], np.flatnonzero(np.diff(group[order])) + 1)
        shift, used = np.zeros(groups, np.int64), np.zeros(size, bool)
        for part in sorted(parts, key=len, reverse=True):
            if len(np.unique(part % size)) < len(part):
                break
            moved = 0
            while used[at := (part + moved) % size].any():
                moved += 1
            used[at], shift[part[0] % groups] = True, moved
        else:
            return groups, size, shift
        groups += 2


def _literal(values: list, kind: str) -> Column:
    """A constant of the plan; the optimizer parses it once."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


def _fold_equal(words: np.ndarray, vocabulary: Vocabulary):
    """``rows, their ids`` again and again, for words of equal length given as rows of bytes. In every
    turn the pair of lowest rank, the first of equal ones, is merged in each row; rows without such a
    pair are done."""
    rows, ids = np.arange(len(words)), vocabulary.bytes[words]
    ranks = vocabulary.byte_pairs[words[:, :-1], words[:, 1:]]
    while ids.shape[1] > 1 and len(ids):
        at = ranks.argmin(1)
        least = ranks[np.arange(len(ids)), at]
        going = least < SPAN
        if not going.all():
            yield rows[~going], ids[~going]
            rows, ids, ranks, at, least = (x[going] for x in (rows, ids, ranks, at, least))
        n, width = ids.shape
        each = np.arange(n)
        kept = np.ones((n, width), bool)
        kept[each, at + 1] = False
        ids[each, at] = least
        ids = ids[kept].reshape(n, width - 1)
        # one of the two pairs that held the right piece goes, the pairs beside the merged piece are new
        kept = np.ones((n, width - 1), bool)
        kept[each, np.minimum(at + 1, width - 2)] = False
        ranks = ranks[kept].reshape(n, width - 2)
        for first in (at - 1, at):
            there = np.flatnonzero((first >= 0) & (first < width - 2))
            pair = first[there]
            ranks[there, pair] = vocabulary.pair_ranks(ids[there, pair], ids[there, pair + 1])
    yield rows, ids


def fold(words: pa.Array, vocabulary: Vocabulary, long_bytes: int) -> pa.Array:
    """The ids of every one of ``words``, joined by commas."""
    if not len(words):
        return pa.array([], pa.string())
    words = words.cast(pa.large_binary())
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    starts = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    sizes = np.diff(starts)
    order, folded, alone = [], [], []

    def add(rows, ids: np.ndarray, ends: np.ndarray) -> None:
        told = pa.array(ids).cast(pa.string())
        order.append(rows)
        folded.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), told), ","))

    by_size = np.argsort(sizes, kind="stable")
    ordered = sizes[by_size]
    at, stop = (int(np.searchsorted(ordered, n, "right")) for n in (0, long_bytes))
    alone.extend(by_size[:at])
    while at < stop:
        size = int(ordered[at])
        last = min(int(np.searchsorted(ordered, size, "right")), at + max(1, FOLD_CELLS // size))
        rows = by_size[at:last]
        if len(rows) < FEW:
            alone.extend(rows)
        else:
            for done, merged in _fold_equal(data[starts[rows][:, None] + np.arange(size)], vocabulary):
                add(rows[done], merged.ravel(), np.arange(len(done) + 1) * merged.shape[1])
        at = last
    alone.extend(by_size[stop:])
    merged = [merge_by_heap(data[starts[i] : starts[i + 1]].tobytes(), vocabulary.ranks) for i in alone]
    ends = np.cumsum([0, *map(len, merged)])
    add(np.array(alone, np.int64), np.array(list(chain.from_iterable(merged)), np.uint64), ends)
    return pa.concat_arrays(folded).take(pa.array(np.argsort(np.concatenate(order))))


def merge_by_heap(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word in time n log n: pairs wait in a heap by rank and place."""
    n = len(word)
    ends, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    waiting: list[tuple[int, int, int]] = []

    def offer(at: int) -> None:
        if at >= 0 and after[at] < n:
            end = ends[after[at]]
            rank = ranks.get(word[at:end])
            if rank is not None:
                heapq.heappush(waiting, (rank, at, end))

    for at in range(n - 1):
        offer(at)
    while waiting:
        _, at, end = heapq.heappop(waiting)
        # a pair that has changed since it was offered ends elsewhere, or its left piece is gone
        if ends[at] < 0 or after[at] >= n or ends[after[at]] != end or ends[at] == end:
            continue
        gone = after[at]
        ends[at], after[at], ends[gone] = end, after[gone], -1
        if after[at] < n:
            before[after[at]] = at
        offer(at)
        offer(before[at])
    out, at = [], 0
    while at < n:
        out.append(ranks[word[at : ends[at]]])
        at = after[at]
    return out


def split_words(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(java_pattern(pattern)), F.lit(0))


def frequent_words(words: DataFrame, vocabulary: Broadcast, params: BytePairParams) -> pa.Table:
    """``word, ids``: at most ``dictionary`` of the words that are most frequent in ``words``
    (``word, n``); ids are joined by commas. Words that occur once stay out."""
    size = F.floor(F.log2("n") * 8).cast("int")
    bins = words.filter("n > 1").groupBy(size.alias("b")).agg(F.count(F.lit(1)).alias("held"))
    least, held = 1 << 30, 0
    for b, count in sorted(bins.collect(), reverse=True):
        held += count
        if held > params.dictionary:
            break
        least = b
    kept = words.filter((F.col("n") > 1) & (size >= least))
    long_bytes = params.long_bytes

    def folded(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), fold(batch.column(0), vocabulary.value, long_bytes)], names=["word", "ids"]
            )

    return kept.select("word").mapInArrow(folded, "word string, ids string").toArrow()


def encode(
    docs: DataFrame, path: str, pattern: str, params: BytePairParams = BytePairParams(), keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (with ``text``), or all, and ``ids_text``: the ids of the text joined
    by commas.

    A null text is empty and has no ids. Documents are not shuffled: only counts of distinct words are.
    """
    spark = docs.sparkSession
    store = Landing(spark, "byte-pairs")
    text = F.coalesce(F.col("text"), F.lit(""))
    word = F.explode(split_words(text, pattern)).alias("word")
    counts = docs.select(word).filter(F.octet_length("word") <= params.frequent_bytes)
    counts = store.land(counts.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "words")
    vocabulary = spark.sparkContext.broadcast(_vocabulary(path))
    frequent = frequent_words(counts, vocabulary, params)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, frequent.schema) as out:
        out.write_table(frequent)
    shared = spark.sparkContext.broadcast(sink.getvalue().to_pybytes())
    most, long_bytes = params.slice_words, params.long_bytes
    held: dict[int, tuple] = {}

    def known() -> tuple[dict[str, int], pa.Array]:
        # places of the frequent words, and their ids
        if 0 not in held:
            table = pa.ipc.open_stream(shared.value).read_all()
            places = {word: i for i, word in enumerate(table.column("word").to_numpy())}
            held[0] = places, pa.array(table.column("ids").combine_chunks(), pa.string())
        return held[0]

    def ids_of(words: pa.Array) -> pa.Array:
        """The ids of distinct words."""
        places, ids = known()
        place = np.array([places.get(word, -1) for word in words.to_numpy(zero_copy_only=False)], np.int64)
        rare = np.flatnonzero(place < 0)
        place[rare] = len(ids) + np.arange(len(rare))
        return pa.chunked_array([ids, fold(words.take(pa.array(rare)), vocabulary.value, long_bytes)]).take(
            pa.array(place)
        ).combine_chunks()

    def look_up(batches):
        for batch in batches:
            words = batch.column(batch.num_columns - 1)
            ends = np.asarray(words.offsets)
            first = 0
            while first < len(words):
                # runs of whole texts with a bounded number of words, a longer text alone
                last = int(np.searchsorted(ends, ends[first] + most, "right")) - 1
                last = min(max(last, first + 1), len(words))
                coded = words.values.slice(ends[first], ends[last] - ends[first]).dictionary_encode()
                ids = ids_of(coded.dictionary).take(coded.indices)
                each = pa.ListArray.from_arrays(pa.array(ends[first : last + 1] - ends[first]), ids)
                own = [c.slice(first, last - first) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [*own, pc.binary_join(each, ",")], names=[*batch.schema.names[:-1], "ids"]
                )
                first = last

    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    words = split_words(F.coalesce(F.col(names[docs.columns.index("text")]), F.lit("")), pattern)
    # texts that nobody asked for do not go to Python and back
    kept = [(n, c, t) for n, (c, t) in zip(names, docs.dtypes) if keep is None or c in keep]
    schema = ", ".join([f"{n} {t}" for n, _, t in kept] + ["ids string"])
    out = plain.select(*[n for n, _, _ in kept], words.alias("words")).mapInArrow(look_up, schema)
    return out.toDF(*[c for _, c, _ in kept], "ids_text")


def decode(ids_text: Column, path: str) -> Column:
    """The bytes of ids joined by commas: their pieces one after the other."""
    ranks = _vocabulary(path).ranks
    pieces = [""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token.decode("iso-8859-1")
    known = _literal(pieces, "string")
    ids = F.split(ids_text, ",").cast("array<int>")
    joined = F.array_join(F.transform(ids, lambda i: known[i]), "")
    return F.encode(F.when(ids_text == "", "").otherwise(joined), "ISO-8859-1")


def round_trip(docs: DataFrame, path: str, pattern: str, params: BytePairParams = BytePairParams()) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row of ``docs`` (``doc_id, text``)."""
    encoded = encode(docs.select(F.col("doc_id").cast("bigint"), "text"), path, pattern, params, keep=["doc_id"])
    commas = F.length("ids_text") - F.length(F.replace("ids_text", F.lit(",")))
    return encoded.select(
        "doc_id",
        F.when(F.col("ids_text") == "", 0).otherwise(commas + 1).cast("bigint").alias("n_tokens"),
        F.sha2("ids_text", 256).alias("ids_sha256"),
        F.sha2(decode(F.col("ids_text"), path), 256).alias("decoded_sha256"),
    )
