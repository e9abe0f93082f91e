"""Benchmark decontamination with one Aho-Corasick automaton over word windows of the test items.

Items and texts are normalised to words: A-Z in lower case; digits, letters and everything beyond
ASCII belong to words, all else separates them. A window is a run of 13 words of an item, or the
whole item if it has fewer. The automaton reads each text once, word by word; where a window ends, its
words are hit. Offsets of hit runs are mapped back to characters of the original text.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devigil.llm.shared import partitions_of, total

RESULT = (
    ("n_words", "bigint"),
    ("n_hit", "bigint"),
    ("n_items", "bigint"),
    ("items_sha256", "string"),
    ("contaminated", "boolean"),
    ("spans", "array<struct<first_char:bigint,end_char:bigint>>"),
)
HIT, FOUND = "words hit so far", "items found so far"
#: Words before A-Z are put in lower case.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Bytes: A-Z in lower case, bytes that separate words as spaces.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@dataclass(frozen=True)
class ContaminationParams:
    """A text is contaminated if at least ``percent`` of its words are hit. Items are sent to the
    workers in shares of at most ``share_bytes``, each with an automaton of its own."""

    window: int = 13
    percent: int = 5
    share_bytes: int = 1 << 20


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(NORMAL).split()


def windows(items: list[tuple[str, str]], size: int) -> dict:
    """``vocabulary`` numbers the words of the items, ``items`` are the item ids of every window."""
    vocabulary: dict[bytes, int] = {}
    found: dict[tuple, set] = {}
    for item, text in items:
        ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in _words(text)]
        for i in range(max(1, len(ids) - size + 1) if ids else 0):
            found.setdefault(tuple(ids[i : i + size]), set()).add(item)
    return {"vocabulary": vocabulary, "items": found}


def find(held: dict, words: list[bytes]) -> tuple[np.ndarray, set]:
    """Which words are hit, and the items whose windows occur. A worker builds the automaton once."""
    hit, found = np.zeros(len(words), bool), set()
    if not held["items"]:
        return hit, found
    if "automaton" not in held:
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for window, items in held["items"].items():
            automaton.add_word(window, (len(window), items))
        automaton.make_automaton()
        held["automaton"] = automaton
    known = held["vocabulary"].get
    for last, (length, items) in held["automaton"].iter(tuple([known(w, 0) for w in words])):
        hit[last - length + 1 : last + 1] = True
        found |= items
    return hit, found


def _runs(hit: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def scan(docs: DataFrame, items: DataFrame, params: ContaminationParams = ContaminationParams(), prefix: str = "") -> DataFrame:
    """``docs`` with ``n_words, n_hit, n_items, items_sha256, contaminated, spans``, named with
    ``prefix``; columns of the input with these names are replaced.

    ``items`` has ``item_id, text``. A null or empty text has no words, no hits and is clean; a null
    or empty item has no windows; equal items all count. ``items_sha256`` is the SHA-256 of the ids of
    the occurring items, as strings, sorted and joined with commas. ``spans`` are the characters of
    the original text, end excluded, of every run of hit words.
    """
    new = [prefix + name for name, _ in RESULT]
    added = ", ".join(f"{prefix}{name} {kind}" for name, kind in RESULT)
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in [*new, HIT, FOUND]])
    spark = docs.sparkSession
    usable = items.filter("text is not null and item_id is not null")
    # ids of any type: the result has them as strings
    usable = usable.select(F.col("item_id").cast("string"), "text")
    shares = partitions_of(total(usable, F.octet_length("text")), params.share_bytes)
    size, percent, at = params.window, params.percent, docs.columns.index("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    state, names = f"`{HIT}` binary, `{FOUND}` array<string>", docs.columns
    out = docs
    for share in range(shares):
        own = usable.filter(F.pmod(F.xxhash64("item_id"), F.lit(shares)) == share)
        held = spark.sparkContext.broadcast(windows([tuple(r) for r in own.collect()], size))

        def search(batches, held=held, first=share == 0):
            for batch in batches:
                hits, found = [], []
                for i, text in enumerate(batch.column(at).to_pylist()):
                    hit, seen = find(held.value, _words(text))
                    if not first:
                        hit |= np.frombuffer(batch.column(HIT)[i].as_py(), bool)
                        seen = seen | set(batch.column(FOUND)[i].as_py())
                    hits.append(hit.tobytes())
                    found.append(sorted(seen))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[: len(names)], pa.array(hits, pa.binary()), pa.array(found, pa.list_(pa.string()))],
                    names=[*names, HIT, FOUND],
                )

        def judge(batches, held=held):
            for batch in batches:
                rows: list[list] = [[] for _ in range(6)]
                for i, text in enumerate(batch.column(at).to_pylist()):
                    hit, seen = find(held.value, _words(text))
                    if shares > 1:
                        hit |= np.frombuffer(batch.column(HIT)[i].as_py(), bool)
                        seen = seen | set(batch.column(FOUND)[i].as_py())
                    n_hit, spans = int(hit.sum()), []
                    if n_hit:
                        places = [m.span() for m in WORD.finditer(text)]
                        spans = [
                            {"first_char": places[a][0], "end_char": places[b - 1][1]} for a, b in _runs(hit)
                        ]
                    named = ",".join(sorted(seen))
                    rows[0].append(len(hit))
                    rows[1].append(n_hit)
                    rows[2].append(len(seen))
                    rows[3].append(hashlib.sha256(named.encode()).hexdigest())
                    rows[4].append(n_hit > 0 and 100 * n_hit >= percent * len(hit))
                    rows[5].append(spans)
                place = pa.list_(pa.struct([("first_char", pa.int64()), ("end_char", pa.int64())]))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), place]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[: len(names)], *[pa.array(r, k) for r, k in zip(rows, kinds)]],
                    names=[*names, *new],
                )

        if share < shares - 1:
            out = out.mapInArrow(search, f"{schema}, {state}")
        else:
            out = out.mapInArrow(judge, f"{schema}, {added}")
    return out


#: Brute force in SQL: every window of every item against every run of words of every text.
CHECK = r"""
WITH cut AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS grams
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM cut WHERE len(w) > 0)
), doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), sizes AS (SELECT DISTINCT size FROM windows),
runs AS (
  SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS grams
  FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM doc), sizes WHERE i + size - 1 <= len(w)
), found AS (SELECT r, i, size, item_id FROM runs JOIN windows USING (size, grams)),
hits AS (
  SELECT r, count(DISTINCT j) AS n_hit
  FROM (SELECT r, unnest(range(i, i + size)) AS j FROM found) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM found) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""
