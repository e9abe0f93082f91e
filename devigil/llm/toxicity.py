"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

A term is a word or word beginning of 4 to 8 letters at a density: it counts from so many occurrences
per 1,000 words on. The terms that the labels depend on are the vocabulary. Labelled examples are
vectors of weights ``tf * idf`` of length 1 in an inverted index with blocks of examples; each term
keeps its largest weight in every block. A text sums these maxima over its terms, opens the blocks by
falling sum and stops when no block left can hold a nearer example, so the nearest are exact.
The neighbours vote with weights that fall with distance; the votes are calibrated on labelled texts
outside the index.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devigil.llm.language import chunks, fold

WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = range(4, 9)
#: Occurrences per 1,000 words; 0 is any.
DENSITIES = (0, 4, 8, 16)
#: Words or counts that a worker holds before it starts anew.
HELD = 200_000
EVIDENCE = "array<struct<doc_id:bigint,similarity:double,toxic:int>>"


@dataclass(frozen=True)
class ToxicityParams:
    """``examples`` bounds the labelled texts per class that are learned from (in expectation: they
    are drawn by a hash); a quarter of them calibrates, the others are the index. A term is kept if
    its log-likelihood ratio against the label is at least ``least_ratio`` and it is in ``least_df``
    examples. ``neighbours`` vote; ``evidence`` of them are returned."""

    examples: int = 2000
    least_ratio: float = 24.0
    least_df: int = 4
    neighbours: int = 15
    evidence: int = 3
    block: int = 64


def stems(word: str) -> list[str]:
    """The word and its beginnings, each marked as what it is."""
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) > n)]


def densities(count: int, n_words: int) -> list[int]:
    """Positions in ``DENSITIES`` that a term with so many occurrences reaches."""
    rate = 1000 * count / n_words
    return [i for i, d in enumerate(DENSITIES) if rate >= d]


def counted(text: str | None) -> tuple[Counter, int]:
    found = WORD.findall((text or "").lower())
    return Counter(found), len(found)


def weigh(words: Counter, n_words: int, known: dict, memo: dict) -> dict[int, float]:
    """Term frequencies of a text over the vocabulary; ``memo`` keeps the known stems of words."""
    per_stem: Counter = Counter()
    for word, n in words.items():
        own = memo.get(word)
        if own is None:
            own = memo[word] = [s for s in stems(word) if s in known]
        for stem in own:
            per_stem[stem] += n
    out = {}
    for stem, n in per_stem.items():
        for level in densities(n, n_words):
            if (term := known[stem][level]) >= 0:
                out[term] = 1 + np.log(n)
    return out


def sample(docs: DataFrame, labels: DataFrame, params: ToxicityParams) -> tuple[DataFrame, dict]:
    """``doc_id, text, toxic, calibrates`` of the texts to learn from: labelled rows outside the
    held-out fold, drawn by class; and how many there are of each class. A doc_id that is labelled more
    than once has its largest label."""
    usable = labels.filter("toxic is not null and doc_id is not null").filter(fold(5) != 0)
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0)
    for value, n in counts.items():
        share = F.when(F.col("toxic") == value, int(1e6 * min(1, params.examples / n))).otherwise(share)
    drawn = usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share)
    other = F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(4)) == 0
    # the drawn labels are bounded by ``examples``
    rows = docs.filter("text is not null").select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    return rows.select("doc_id", "text", F.col("toxic").cast("int"), other.alias("calibrates")), counts


def vocabulary(rows: DataFrame, params: ToxicityParams) -> tuple[dict, np.ndarray]:
    """``{stem: term of each density or -1}`` and the idf of the terms."""

    def counts_of(found: Counter) -> pa.RecordBatch:
        keys = list(found)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.string()),
                pa.array([k[1] for k in keys], pa.int32()),
                pa.array([k[2] for k in keys], pa.int32()),
                pa.array([found[k] for k in keys], pa.int64()),
            ],
            names=["stem", "level", "toxic", "n"],
        )

    def count(batches):
        found: Counter = Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                words, n = counted(text.as_py())
                own: Counter = Counter()
                for word, times in words.items():
                    for stem in stems(word):
                        own[stem] += times
                for stem, times in own.items():
                    for level in densities(times, n):
                        found[stem, level, toxic] += 1
                if len(found) > HELD:
                    yield counts_of(found)
                    found = Counter()
        if found:
            yield counts_of(found)

    index = rows.filter(~F.col("calibrates"))
    sizes = {r["toxic"]: r["count"] for r in index.groupBy("toxic").count().collect()}
    clean, toxic = float(sizes.get(0, 0)), float(sizes.get(1, 0))
    whole = clean + toxic
    parts = index.select("text", "toxic").mapInArrow(count, "stem string, level int, toxic int, n bigint")
    n = parts.groupBy("stem", "level").agg(
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("b"),
    )
    df = F.col("a") + F.col("b")

    def part(seen, rows_, terms):
        expected = terms * rows_ / whole
        return F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(0.0)

    if not clean or not toxic:
        return {}, np.zeros(0)
    ratio = (
        part(F.col("a"), clean, df) + part(F.col("b"), toxic, df)
        + part(clean - F.col("a"), clean, whole - df) + part(toxic - F.col("b"), toxic, whole - df)
    )
    kept = n.filter(df >= params.least_df).filter(df < whole).filter(ratio >= params.least_ratio)
    found = kept.select("stem", "level", df.alias("df")).orderBy("stem", "level").collect()
    known: dict[str, list[int]] = {}
    for i, row in enumerate(found):
        known.setdefault(row["stem"], [-1] * len(DENSITIES))[row["level"]] = i
    return known, np.array([np.log(1 + whole / r["df"]) for r in found])


def build_index(vectors: list[dict[int, float]], idf: np.ndarray, block: int) -> dict:
    """Postings by block, and the largest weight of each term in each block.

    Examples are ordered by their heaviest terms, so that blocks hold alike ones.
    """
    units = []
    for v in vectors:
        own = {t: w * idf[t] for t, w in v.items()}
        length = np.sqrt(sum(w * w for w in own.values()))
        units.append({t: w / length for t, w in own.items()} if own else {})
    order = sorted((i for i, u in enumerate(units) if u), key=lambda i: sorted(units[i], key=lambda t: -units[i][t])[:4])
    n_blocks = -(-len(order) // block)
    highest = np.zeros((len(idf), n_blocks), np.float64)
    postings: list[dict] = []
    for b in range(n_blocks):
        held: dict[int, list] = {}
        for place, i in enumerate(order[b * block : (b + 1) * block]):
            for t, w in units[i].items():
                held.setdefault(t, []).append((place, w))
                highest[t, b] = max(highest[t, b], w)
        postings.append({t: (np.array([p for p, _ in x]), np.array([w for _, w in x])) for t, x in held.items()})
    return {"order": np.array(order, np.int64), "highest": highest, "postings": postings, "block": block}


def nearest(index: dict, vector: dict[int, float], idf: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and cosines of the ``k`` nearest examples with a cosine above 0, nearest first."""
    none = np.zeros(0, np.int64), np.zeros(0)
    if not vector or not len(index["order"]):
        return none
    terms = np.fromiter(vector, np.int64, len(vector))
    weights = np.array([vector[t] * idf[t] for t in terms])
    weights /= np.sqrt((weights**2).sum())
    bounds = weights @ index["highest"][terms]
    where, scores, worst = none[0], none[1], 0.0
    for b in np.argsort(-bounds, kind="stable"):
        if bounds[b] <= 0 or (len(scores) >= k and bounds[b] < worst - 1e-12):
            break
        own = np.zeros(index["block"])
        held = index["postings"][b]
        for t, w in zip(terms.tolist(), weights):
            if t in held:
                places, impact = held[t]
                own[places] += w * impact
        some = np.flatnonzero(own > 0)
        where = np.concatenate([where, some + b * index["block"]])
        scores = np.concatenate([scores, own[some]])
        # on a tie the example that stands first
        best = np.lexsort((where, -scores))[:k]
        where, scores = where[best], scores[best]
        worst = scores[-1] if len(scores) == k else 0.0
    return index["order"][where], np.minimum(scores, 1.0)


def vote(cosines: np.ndarray, toxic: np.ndarray) -> float:
    """Votes weighted by closeness: the share of toxic ones."""
    weight = 1 / (1.05 - cosines)
    return float((weight * toxic).sum() / weight.sum())


def _rising(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The closest rising steps to ``y`` over ``x`` (pool adjacent violators), as points."""
    order = np.argsort(x, kind="stable")
    steps: list[list[float]] = []
    for i in order:
        steps.append([x[i] * weight[i], y[i] * weight[i], weight[i]])
        while len(steps) > 1 and steps[-2][1] / steps[-2][2] >= steps[-1][1] / steps[-1][2]:
            last = steps.pop()
            steps[-1] = [a + b for a, b in zip(steps[-1], last)]
    return np.array([s[0] / s[2] for s in steps]), np.array([s[1] / s[2] for s in steps])


def train(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> dict:
    """Vocabulary, index and calibration from a bounded sample of labelled texts.

    Without labels of both classes the model is empty and scores the share of label 1 (0 if none).
    """
    rows, counts = sample(docs, labels, params)
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    known, idf = vocabulary(rows, params)
    if not known:
        return {"known": {}, "idf": idf, "index": None, "prior": prior}

    def encode(batches):
        memo: dict = {}
        for batch in batches:
            vectors = []
            for text in batch.column(1).to_pylist():
                own = weigh(*counted(text), known, memo)
                vectors.append([{"t": int(t), "w": float(w)} for t, w in own.items()])
            kind = pa.list_(pa.struct([("t", pa.int64()), ("w", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), pa.array(vectors, kind)],
                names=["doc_id", "toxic", "calibrates", "vector"],
            )

    source = rows.select(F.col("doc_id").cast("bigint"), "text", "toxic", "calibrates")
    found = source.mapInArrow(
        encode, "doc_id bigint, toxic int, calibrates boolean, vector array<struct<t:bigint,w:double>>"
    ).collect()
    found = sorted(found, key=lambda r: r["doc_id"])
    learned = [r for r in found if not r["calibrates"]]
    vectors = [{x["t"]: x["w"] for x in r["vector"]} for r in learned]
    index = build_index(vectors, idf, params.block)
    ids, toxic = np.array([r["doc_id"] for r in learned]), np.array([r["toxic"] for r in learned])
    # what one drawn row of a class stands for
    drawn = Counter(r["toxic"] for r in found)
    stands = {c: counts[c] / drawn[c] for c in drawn}
    model = {"known": known, "idf": idf, "index": index, "ids": ids, "toxic": toxic, "prior": prior}
    raw, truth, weight, empty = [], [], [], [0.5 * prior, 0.5]
    for r in (r for r in found if r["calibrates"]):
        own = {x["t"]: x["w"] for x in r["vector"]}
        at, cosines = nearest(index, own, idf, params.neighbours)
        if len(at):
            raw.append(vote(cosines, toxic[at]))
            truth.append(r["toxic"])
            weight.append(stands[r["toxic"]])
        else:
            empty[0] += r["toxic"] * stands[r["toxic"]]
            empty[1] += stands[r["toxic"]]
    model["without"] = empty[0] / empty[1]
    # two rows of prior belief keep the ends inside (0, 1)
    light = min(stands.values())
    x, y = _rising(
        np.array([*raw, 0.0, 1.0]), np.array([*truth, 0.0, 1.0]), np.array([*weight, light, light])
    )
    model["calibration"] = (x, y)
    return model


def score(docs: DataFrame, model: dict, params: ToxicityParams = ToxicityParams(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``score, predicted, evidence`` for every row.

    Texts without known terms, null and empty ones among them, have the score of such texts and no
    evidence. Columns of the input with the added names are replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    keep = tuple(c for c in keep if c.lower() not in ("score", "predicted", "evidence"))
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias("text to score"))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema.fields[:-1])

    def judge(batches):
        m = held.value
        memo: dict = {}
        for batch in batches:
            scores, evidence = [], []
            for _, texts in chunks(batch.column(len(keep))):
                if len(memo) > HELD:
                    memo.clear()
                for text in texts:
                    if m["index"] is None:
                        scores.append(m["prior"])
                        evidence.append([])
                        continue
                    own = weigh(*counted(text), m["known"], memo)
                    at, cosines = nearest(m["index"], own, m["idf"], params.neighbours)
                    if not len(at):
                        scores.append(m["without"])
                        evidence.append([])
                        continue
                    value = np.interp(vote(cosines, m["toxic"][at]), *m["calibration"])
                    scores.append(float(min(1.0, max(0.0, value))))
                    top = zip(at[: params.evidence], cosines)
                    evidence.append(
                        [{"doc_id": int(m["ids"][i]), "similarity": float(c), "toxic": int(m["toxic"][i])} for i, c in top]
                    )
            seen = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(keep)],
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                    pa.array(evidence, seen),
                ],
                names=[*keep, "score", "predicted", "evidence"],
            )

    return source.mapInArrow(judge, f"{schema}score double, predicted int, evidence {EVIDENCE}")


def scores(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence`` for every row of ``docs``."""
    model = train(docs, labels, params)
    rows = docs.select("doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"), "text")
    return score(rows, model, params, keep=("doc_id", "held_out"))
