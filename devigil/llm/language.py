"""Language identification by inferring the mixture of languages of a document.

Every learned language is a distribution over hashed letter trigrams. A word's likelihood under a
language is the product over its trigrams; expectation-maximisation finds the shares of the languages
in a document's words, next to a noise component that spreads evenly over all trigrams. Starting from
all languages, the one with the smallest share leaves as long as the penalised likelihood gains.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
NOISE = -np.log(BUCKETS)
UNDETERMINED = "und"
RESULT = (
    "lang_pred string, score double, languages array<string>, shares array<double>, "
    "noise_share double, n_words bigint"
)


@dataclass(frozen=True)
class LanguageParams:
    """``train_docs`` bounds the labelled rows per language that the models are fitted on (in
    expectation: rows are drawn by a hash). Words longer than ``longest`` letters count as several.
    ``penalty`` is what a further language must gain in log-likelihood, times the logarithm of the
    number of words. A document is rejected without letters or when noise explains more than
    ``most_noise`` of its words."""

    train_docs: int = 2000
    smoothing: float = 0.5
    longest: int = 32
    penalty: float = 1.0
    most_noise: float = 0.8
    rounds: int = 10
    warm_rounds: int = 4


def letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def trigrams(texts: list, is_letter: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram buckets, the first trigram of every word, the first word of every text (and the end)."""
    folded = [(t or "").lower() for t in texts]
    code = np.frombuffer("".join(folded).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([0, *map(len, folded)])
    at = np.flatnonzero(is_letter[code])
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(ends), np.int64)
    text = np.searchsorted(ends, at, "right")
    begins = np.ones(len(at), bool)
    begins[1:] = (np.diff(at) > 1) | (np.diff(text) > 0)
    runs = np.flatnonzero(begins)
    place = np.arange(len(at)) - np.repeat(runs, np.diff(np.append(runs, len(at))))
    begins |= place % longest == 0
    now = code[at].astype(np.uint32)
    before, after = np.roll(now, 1), np.roll(now, -1)
    before[begins] = 0
    after[np.roll(begins, -1)] = 0
    mixed = before * np.uint32(0x9E3779B1) + now * np.uint32(0x85EBCA77) + after * np.uint32(0xC2B2AE3D)
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    starts = np.flatnonzero(begins)
    return (mixed >> np.uint32(16)).astype(np.int64), starts, np.searchsorted(at[starts], ends)


def chunks(column: pa.Array, most: int = 1 << 19):
    """Lists of whole texts with about ``most`` characters, and the index of the first of each."""
    held, size, first = [], 0, 0
    for text in column:
        held.append(text.as_py())
        size += len(held[-1] or "")
        if size >= most:
            yield first, held
            first, held, size = first + len(held), [], 0
    if held:
        yield first, held


def train(labelled: DataFrame, params: LanguageParams = LanguageParams()) -> dict:
    """Trigram models from the ``text`` and ``lang`` of labelled rows; ``key`` draws the sample.

    The counts are summed by Spark; the driver gets at most 65,536 numbers per language.
    """
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    drawn = F.pmod(F.xxhash64("key"), F.lit(1_000_000))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, int(1e6 * min(1, params.train_docs / n))).otherwise(share)
    table, longest = letters(), params.longest

    def count(batches):
        for batch in batches:
            names = np.array(batch.column("lang").to_pylist(), object)
            for first, texts in chunks(batch.column("text")):
                grams, starts, bounds = trigrams(texts, table, longest)
                edges = np.append(starts, len(grams))[bounds]
                for lang in set(names[first : first + len(texts)]):
                    own = np.zeros(BUCKETS, np.int64)
                    for i in np.flatnonzero(names[first : first + len(texts)] == lang):
                        own += np.bincount(grams[edges[i] : edges[i + 1]], minlength=BUCKETS)
                    some = np.flatnonzero(own)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(some), pa.string()), pa.array(some), pa.array(own[some])],
                        names=["lang", "bucket", "n"],
                    )

    sample = rows.filter(drawn < share).select("lang", "text")
    summed = sample.mapInArrow(count, "lang string, bucket bigint, n bigint")
    summed = summed.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(summed["lang"].unique())
    logp = np.zeros((len(langs), BUCKETS), np.float32)
    for i, lang in enumerate(langs):
        own = summed[summed["lang"] == lang]
        seen = np.full(BUCKETS, params.smoothing)
        seen[own["bucket"].to_numpy()] += own["n"].to_numpy()
        logp[i] = np.log(seen / seen.sum())
    return {"langs": langs, "logp": logp, "letters": table}


def mixtures(grams, starts, bounds, logp, params) -> tuple[np.ndarray, np.ndarray]:
    """Shares of languages and noise for every text, and which languages stay in its set."""
    n_lang, n_text = len(logp), len(bounds) - 1
    shares = np.zeros((n_lang + 1, n_text))
    alive = np.zeros((n_lang + 1, n_text), bool)
    some = np.flatnonzero(np.diff(bounds))
    if not len(some):
        return shares, alive
    lengths = np.diff(np.append(starts, len(grams)))
    fit = np.empty((n_lang + 1, len(starts)), np.float32)
    for i in range(n_lang):
        fit[i] = np.add.reduceat(logp[i][grams], starts)
    fit[n_lang] = NOISE * lengths
    top = fit.max(0)
    fit = np.exp(fit - top)
    sizes = np.diff(bounds)[some]

    def refine(fit, top, sizes, share, rounds):
        edges = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        for _ in range(rounds):
            weighed = fit * np.repeat(share, sizes, axis=1)
            weighed /= weighed.sum(0) + np.float32(1e-30)
            share = np.add.reduceat(weighed, edges, axis=1) / sizes
            share = share.astype(np.float32)
        likely = np.log((fit * np.repeat(share, sizes, axis=1)).sum(0) + 1e-30) + top
        return share, np.add.reduceat(likely.astype(np.float64), edges)

    active = np.arange(len(some))
    share = np.full((n_lang + 1, len(some)), 1 / (n_lang + 1), np.float32)
    share, likely = refine(fit, top, sizes, share, params.rounds)
    inside = np.ones((n_lang + 1, len(some)), bool)
    while len(active) and n_lang > 1:
        ranked = np.where(inside[:n_lang, active], share[:n_lang, active], np.inf)
        least = ranked.argmin(0)
        fewer = share[:, active].copy()
        fewer[least, np.arange(len(active))] = 0
        fewer[:, fewer.sum(0) == 0] = 1e-3
        fewer = np.where(inside[:, active], fewer, 0)
        fewer[least, np.arange(len(active))] = 0
        fewer /= fewer.sum(0)
        words = np.repeat(np.isin(np.arange(len(some)), active), sizes)
        after, now = refine(fit[:, words], top[words], sizes[active], fewer, params.warm_rounds)
        gains = now + params.penalty * np.log1p(sizes[active]) >= likely[active]
        gone = active[gains]
        inside[least[gains], gone] = False
        share[:, gone], likely[gone] = after[:, gains], now[gains]
        active = gone[inside[:n_lang, gone].sum(0) > 1]
    shares[:, some], alive[:, some] = share, inside
    return shares, alive


def identify(docs: DataFrame, model: dict, params: LanguageParams = LanguageParams(), text: str = "text",
             keep: tuple[str, ...] | None = None, prefix: str = "") -> DataFrame:
    """The rows of ``docs`` (columns ``keep``, all by default) with the columns of ``RESULT`` added,
    named with ``prefix``; columns of the input with these names are replaced.

    A null text, or one without letters, is ``und`` with score 0. ``lang_pred`` is the language of
    the selected set with the largest share, on a tie the first by name; ``score`` is its share.
    Without any learned language every text is ``und``.
    """
    added = ", ".join(prefix + part for part in RESULT.split(", "))
    new = [part.split()[0] for part in added.split(", ")]
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() not in new]
    held = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(*[F.col(f"`{n}`") for n in dict.fromkeys([*names, text])])
    at, kept = source.columns.index(text), len(names)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:kept])

    def label(batches):
        langs, logp, table = held.value["langs"], held.value["logp"], held.value["letters"]
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for _, texts in chunks(batch.column(at)):
                grams, starts, bounds = trigrams(texts, table, params.longest)
                shares, alive = mixtures(grams, starts, bounds, logp, params)
                for i in range(len(texts)):
                    own = [(float(shares[j, i]), langs[j]) for j in range(len(langs)) if alive[j, i]]
                    whole = sum(s for s, _ in own)
                    own = sorted(((s / whole if whole > 0 else 1 / len(own), n) for s, n in own), key=lambda x: (-x[0], x[1]))
                    out[0].append(own[0][1] if own else UNDETERMINED)
                    out[1].append(min(1.0, own[0][0]) if own else 0.0)
                    out[2].append([n for _, n in own])
                    out[3].append([s for s, _ in own])
                    out[4].append(float(shares[-1, i]))
                    out[5].append(int(bounds[i + 1] - bounds[i]))
            kinds = [pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.float64()), pa.float64(), pa.int64()]
            columns = [pa.array(v, k) for v, k in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], *columns], names=[*names, *new])

    return source.mapInArrow(label, f"{schema}, {added}" if schema else added)


def accepted(params: LanguageParams = LanguageParams(), prefix: str = ""):
    """The condition for documents whose language is known."""
    known = F.col(f"{prefix}lang_pred") != UNDETERMINED
    return known & (F.col(f"{prefix}noise_share") <= params.most_noise)


def fold(count: int):
    """crc32 of the id as text, modulo ``count``; a null id is in no fold."""
    return F.crc32(F.col("doc_id").cast("string")) % count


def labelled(docs: DataFrame) -> DataFrame:
    """Rows to learn from: those outside the held-out fold, with a key for the sample."""
    learn = F.coalesce(fold(4) != 2, F.lit(True))
    return docs.filter(learn).select("text", "lang", F.col("doc_id").alias("key"))


def predictions(docs: DataFrame, params: LanguageParams = LanguageParams()) -> DataFrame:
    """``doc_id, held_out`` and the columns of ``RESULT`` for every row of ``docs``."""
    model = train(labelled(docs), params)
    rows = docs.select("doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "text")
    return identify(rows, model, params, keep=("doc_id", "held_out"))
