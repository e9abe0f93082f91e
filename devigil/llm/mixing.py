"""Mixing to target weights by soft membership.

A classifier trained on the labelled table predicts how likely a document belongs to each domain.
Nonnegative document rates then solve a least-squares problem: the expected tokens of every domain,
rate times tokens times posterior summed over all documents, shall match the targets. Projected
gradient solves it: from rate 1 everywhere, every round takes a step against the gradient and cuts the
rate of each document at 0. The gradient of a document is its posterior times the residuals of the
domains, so its rate after any round is a function of the few residuals before: every round is one pass
over ``tokens, posterior`` that replays those rounds and sums up the next residuals.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devigil.llm.shared import Landing, slices
from devigil.llm.tokens import LETTERS_DIGITS, NOT_SPACE, word_hashes, words

BITS = 16
#: Rounds of projected gradient over which the residual has to fall.
STALL = 10


@dataclass(frozen=True)
class MixParams:
    """``targets`` are the shares of tokens by domain, scaled to a sum of 1; ``tokens`` is their total
    (None: the tokens that the documents have). ``train_rows`` bounds the labelled rows per domain
    that the classifier is fitted on (in expectation: they are drawn by a hash). At most ``rounds`` of
    projected gradient are made; they end at residuals of ``tolerance`` of all tokens, or once the squared
    residual falls by less than the share ``progress`` a round."""

    targets: Mapping[str, float] = field(default_factory=lambda: {"good": 0.9, "poor": 0.08, "toxic": 0.02})
    tokens: float | None = None
    train_rows: int = 2000
    epochs: int = 80
    stride: float = 4.0
    ridge: float = 1e-5
    rounds: int = 200
    tolerance: float = 1e-4
    progress: float = 1e-4


def domain_of_labels():
    """The domain of a labelled row: toxic, good or poor; null without labels."""
    return (
        F.when(F.col("toxic") == 1, "toxic")
        .when(F.col("quality") == 1, "good")
        .when(F.coalesce("toxic", "quality").isNotNull(), "poor")
    )


def _features(data, offsets):
    """Token counts, and for every text hashed words with damped, normalised weights."""
    tokens = np.diff(words(data, offsets, NOT_SPACE)[1])
    starts, first = words(data, offsets, LETTERS_DIGITS)
    buckets = (word_hashes(data, starts, LETTERS_DIGITS) >> np.uint64(64 - BITS)).astype(np.int64)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        own, n = np.unique(buckets[a:b], return_counts=True)
        weight = np.log1p(n)
        out.append((own, weight / max(1e-9, np.sqrt((weight**2).sum()))))
    return tokens, out


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train(docs: DataFrame, labels: DataFrame, params: MixParams = MixParams()) -> dict:
    """A multinomial logistic regression on hashed words of the ``doc_id, text`` whose ``domain`` is in
    ``labels`` (``doc_id, domain``; the first by name if there are several).

    Only the drawn sample reaches the driver. Its classes are balanced; the shares of all labels enter
    as priors. Domains without labelled texts get posterior 0; without any all domains are equally
    likely.
    """
    domains = sorted(params.targets)
    rows = labels.filter(F.col("domain").isin(domains)).groupBy("doc_id").agg(F.min("domain").alias("domain"))
    counts = {r["domain"]: r["n"] for r in rows.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    even = {"domains": domains, "weights": np.zeros((1 << BITS, len(domains)), np.float32), "bias": np.zeros(len(domains))}
    if not counts:
        return even
    share = F.lit(0)
    for name, n in counts.items():
        share = F.when(F.col("domain") == name, int(1e6 * min(1, params.train_rows / n))).otherwise(share)
    drawn = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share)
    # the drawn labels are bounded by ``train_rows`` for each domain, so they go to the texts
    labelled = docs.filter("text is not null").select("doc_id", "text").join(F.broadcast(drawn), "doc_id")

    def encode(batches):
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(1)):
                _, found = _features(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array([b.astype(np.int32).tobytes() for b, _ in found], pa.binary()),
                        pa.array([w.astype(np.float32).tobytes() for _, w in found], pa.binary()),
                    ],
                    names=["domain", "buckets", "weights"],
                )

    sample = labelled.select("domain", "text").mapInArrow(encode, "domain string, buckets binary, weights binary").collect()
    buckets = [np.frombuffer(r["buckets"], np.int32) for r in sample]
    text = np.repeat(np.arange(len(sample)), [len(b) for b in buckets])
    bucket = np.concatenate([np.zeros(0, np.int32), *buckets])
    weight = np.concatenate([np.zeros(0, np.float32), *[np.frombuffer(r["weights"], np.float32) for r in sample]])
    known = [d for d in domains if any(r["domain"] == d for r in sample)]
    if not known:
        return even
    truth = np.array([known.index(r["domain"]) for r in sample])
    onehot = np.eye(len(known))[truth]
    coef, bias = np.zeros((1 << BITS, len(known))), np.zeros(len(known))
    scale = np.full((1 << BITS, len(known)), 1e-8)
    for _ in range(params.epochs):
        logits = np.stack([np.bincount(text, coef[bucket, k] * weight, len(sample)) for k in range(len(known))], 1) + bias
        wrong = (_softmax(logits) - onehot) / max(1, len(sample))
        slope = np.stack([np.bincount(bucket, wrong[text, k] * weight, 1 << BITS) for k in range(len(known))], 1)
        slope += params.ridge * coef
        scale += slope**2
        coef -= params.stride * slope / np.sqrt(scale)
        bias -= wrong.sum(0)
    drawn_share = np.bincount(truth, minlength=len(known)) / max(1, len(truth))
    prior = np.array([counts[d] for d in known], float) / sum(counts.values())
    bias = bias + np.log(prior) - np.log(np.maximum(drawn_share, 1e-9))
    full = np.zeros((1 << BITS, len(domains)), np.float32)
    rest = np.full(len(domains), -1e9)
    at = [domains.index(d) for d in known]
    full[:, at], rest[at] = coef, bias
    return {"domains": domains, "weights": full, "bias": rest}


def posteriors(docs: DataFrame, model: dict, keep: tuple[str, ...]) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``n_tokens`` (words between white space) and ``posterior``,
    a probability for each domain in order of its name. A null or empty text has no tokens."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in keep if c.lower() not in ("n_tokens", "posterior")]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col("text").alias("text to classify"))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema.fields[:-1])

    def predict(batches):
        coef, bias = held.value["weights"], held.value["bias"]
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(len(kept))):
                tokens, found = _features(data, offsets)
                logits = np.stack([w @ coef[b] if len(b) else np.zeros(len(bias)) for b, w in found]) + bias
                yield pa.RecordBatch.from_arrays(
                    [
                        *[c.slice(first, last - first) for c in batch.columns[: len(kept)]],
                        pa.array(tokens, pa.int64()),
                        pa.array(list(_softmax(logits)), pa.list_(pa.float64())),
                    ],
                    names=[*kept, "n_tokens", "posterior"],
                )

    return source.mapInArrow(predict, f"{schema}n_tokens bigint, posterior array<double>")


@dataclass(frozen=True)
class Round:
    """A round of projected gradient: both arrays by domain. ``step`` is the residual times the step size;
    ``momentum`` is how far the rates go on in the direction of the round."""

    scale: np.ndarray
    step: np.ndarray
    momentum: float


def replay(posterior: np.ndarray, rounds: list[Round]) -> np.ndarray:
    """The rates after some rounds: from 1, each a step against the gradient, cut at 0."""
    rate = last = np.ones(len(posterior))
    for r in rounds:
        moved = np.maximum(0, rate - (posterior @ r.scale) * (posterior @ r.step))
        rate, last = np.maximum(0, moved + r.momentum * (moved - last)), moved
    return rate


def _posterior(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def fit_rates(rows: DataFrame, domains: list[str], params: MixParams = MixParams()) -> list[Round]:
    """The rounds whose replay gives the rates; ``rows`` has ``n_tokens, posterior``.

    A document's gradient is scaled by its posterior over the tokens of the domains, so that rare domains
    move as fast as frequent ones; cutting at 0 is the projection under this diagonal scaling as well. The
    step is the inverse of the largest curvature. Rounds gain momentum until the squared residual rises,
    then start to gain it again. They end when the residuals are within ``tolerance`` or the best of them
    does not fall any more, which is the least-squares solution of targets that cannot be reached. The
    rounds up to the best residual are returned. Without tokens there are none and all rates are 1.
    """
    width = len(domains)

    def gathered(measure, size):
        def sums(batches):
            for batch in batches:
                tokens = batch.column(0).to_numpy(zero_copy_only=False).astype(float)
                found = measure(tokens, _posterior(batch.column(1), width))
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(found)], names=["i", "x"])

        part = rows.select("n_tokens", "posterior").mapInArrow(sums, "i bigint, x double")
        found = dict(part.groupBy("i").agg(F.sum("x")).collect())
        return np.array([found.get(i, 0.0) for i in range(size)])

    tokens = gathered(lambda tokens, posterior: tokens @ posterior, width)
    whole = tokens.sum()
    if whole <= 0:
        return []
    scale = np.divide(whole, tokens, out=np.zeros(width), where=tokens > 0)

    def curvature(tokens, posterior):
        return ((posterior * (tokens * (posterior @ scale))[:, None]).T @ posterior).ravel()

    moments = gathered(curvature, width * width).reshape(width, width) / whole
    step = 1 / np.linalg.eigvalsh(moments)[-1]
    goal = np.array([params.targets[d] for d in domains], float)
    goal /= goal.sum()
    if params.tokens is not None:
        goal *= params.tokens / whole
    made: list[Round] = []
    best: list[tuple[float, int]] = []
    residual, before, gained = tokens / whole - goal, np.inf, 0
    while True:
        square = float(residual @ residual)
        best.append(min([*best[-1:], (square, len(made))]))
        stalls = len(best) > STALL and best[-1][0] > (1 - params.progress * STALL) * best[-1 - STALL][0]
        if np.abs(residual).max() <= params.tolerance * goal.sum() or stalls or len(made) >= params.rounds:
            return made[: best[-1][1]]
        gained = 0 if square > before else gained + 1
        before = square
        made.append(Round(scale, step * residual, max(0, (gained - 1) / (gained + 2))))
        done = list(made)
        residual = gathered(lambda tokens, posterior: (tokens * replay(posterior, done)) @ posterior, width) / whole - goal


def mix(docs: DataFrame, labels: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """``docs`` with ``n_tokens, posterior, rate, copies``.

    ``rate`` is how often a document is to be seen on average. ``copies`` is the whole number of times:
    the rate rounded up or down by a hash of doc_id and text, so that it matches on average. Columns
    of these names in the input are replaced. A null or empty text has no tokens, the posterior of the
    priors, and the rate that follows from it. Equal rows get equal rates.
    """
    model = train(docs, labels, params)
    store = Landing(docs.sparkSession, "mixing")
    domains = model["domains"]
    keep = tuple(c for c in docs.columns if c.lower() not in ("rate", "copies"))
    scored = store.land(posteriors(docs, model, keep), "scored")
    rounds = fit_rates(scored, domains, params)
    width = len(domains)

    @F.pandas_udf("double")
    def rate(posterior):
        return pd.Series(replay(np.array(posterior.tolist()).reshape(-1, width), rounds))

    rated = scored.withColumn("rate", rate("posterior"))
    chance = F.pmod(F.xxhash64("doc_id", "text", F.lit("copies")), F.lit(1_000_000)) / 1e6
    whole = F.floor("rate")
    return rated.withColumn("copies", whole + F.when(chance < F.col("rate") - whole, 1).otherwise(0))
