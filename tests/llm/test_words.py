"""Language, lines, decontamination and mixing against plain Python."""

import re

import numpy as np
from pyspark.sql import functions as F

from devigil.llm import contamination, language, lines, mixing

ENGLISH = ["the house of the old man was on the hill", "and there were the things that they had said"]
GERMAN = ["das haus des alten mannes war auf dem hügel", "und dort waren die dinge die sie gesagt hatten"]


def corpus():
    rows = []
    for i in range(40):
        rows.append((2 * i, f"{ENGLISH[i % 2]} {ENGLISH[(i + 1) % 2]}", "en"))
        rows.append((2 * i + 1, f"{GERMAN[i % 2]} {GERMAN[(i + 1) % 2]}", "de"))
    return rows


def test_language_of_held_out_texts_and_edge_cases(documents):
    rows = corpus() + [
        (900, None, "en"), (901, "", "en"), (902, "12 345 %% !!", "de"), (903, ENGLISH[0] * 2000, None),
        (904, " ".join([ENGLISH[0]] * 3 + [GERMAN[0]] * 3), "en"), (None, GERMAN[1], "de"),
        (905, GERMAN[1], "de"), (905, GERMAN[1], "de"),
    ]
    out = [r.asDict() for r in language.predictions(documents(rows)).collect()]
    assert len(out) == len(rows)
    by_id = {r["doc_id"]: r for r in out}
    for doc, _, lang in rows[:80]:
        assert by_id[doc]["lang_pred"] == lang and 0.9 < by_id[doc]["score"] <= 1
    for doc in (900, 901, 902):
        assert (by_id[doc]["lang_pred"], by_id[doc]["score"], by_id[doc]["n_words"]) == ("und", 0.0, 0)
    assert by_id[903]["lang_pred"] == "en" and by_id[None]["lang_pred"] == by_id[905]["lang_pred"] == "de"
    assert sorted(by_id[904]["languages"]) == ["de", "en"]
    assert np.allclose(sorted(by_id[904]["shares"]), [0.47, 0.53], atol=0.07)


def test_language_without_rows_or_labels_and_with_clashing_columns(documents):
    docs = documents(corpus())
    assert language.predictions(docs.limit(0)).count() == 0
    unlabelled = language.predictions(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in unlabelled.collect()} == {"und"}
    model = language.train(language.labelled(docs))
    clash = docs.withColumn("score", F.lit("mine")).withColumn("lang_pred", F.lit(1))
    assert dict(language.identify(clash, model).dtypes)["score"] == "double"
    kept = language.identify(clash, model, prefix="x_").first()
    assert kept["score"] == "mine" and kept["x_lang_pred"] in ("en", "de")
    noise = documents([(1, "ქართული ენა არის " * 20)])
    assert language.identify(noise, model).filter(language.accepted()).count() == 0


def test_lines_on_many_sites(documents, rows):
    common, rare = "this line stands on a great many sites", "this line stands on a few sites only"
    docs = [(i, f"own line number {i} of this page\n{common}\n{rare if i < 7 else 'short'}", "en", f"s{i}") for i in range(12)]
    copies = [(100 + i, "a page that was copied to many sites\nall of it", "en", f"s{i}") for i in range(12)]
    edge = [(200, None), (201, ""), (202, f"  {common}  ", "en", None), (202, f"  {common}  ", "en", None), (None, common)]
    out = lines.remove_boilerplate(documents(docs + copies + edge).withColumn("n_removed", F.lit("x")))
    found = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == len(docs + copies + edge)
    assert found[3]["text"] == f"own line number 3 of this page\n{rare}" and found[3]["n_removed"] == 1
    assert found[105]["n_removed"] == 0, "a copied page is one page"
    assert found[200]["text"] is None and found[200]["n_lines"] == 0
    assert (found[201]["text"], found[201]["n_lines"]) == ("", 1)
    assert found[202]["text"] == "" and found[None]["text"] == ""
    assert lines.remove_boilerplate(documents([]).select("*")).count() == 0


def test_lines_near_the_threshold_are_exact(documents):
    params = lines.LineParams(min_sites=60, min_chars=5)
    docs = [(100 * n + i, f"line of {n} sites\nown {n} {i}", "en", f"s{i}") for n in (58, 59, 60, 61) for i in range(n)]
    out = lines.remove_boilerplate(documents(docs), params)
    removed = {r["doc_id"] // 100: r["n_removed"] for r in out.select("doc_id", "n_removed").collect() if r["doc_id"] % 100 == 0}
    assert removed == {58: 0, 59: 0, 60: 1, 61: 1}


def test_lines_of_copied_texts_count_all_their_sites(documents):
    mirrored, copied, few = ("this line stands in texts that others mirror", "this line stands in a single copied text", "this line is on a few sites in many texts")
    docs = [(i, f"own line {i}\n{mirrored}", "en", f"s{i}") for i in range(20)]
    docs += [(100 + i, f"own line {i}\n{mirrored}", "en", "a hot aggregator") for i in range(20)]
    docs += [(200 + i, copied, "en", f"s{i}") for i in range(20)]
    docs += [(300 + i, f"other line {i}\n{few}", "en", f"s{i % 7}") for i in range(20)]
    docs += [(400 + i, "two texts\nwith this line on eight sites in all" + f"\n{i % 2}", "en", f"s{i}") for i in range(8)]
    found = {r["doc_id"]: r["n_removed"] for r in lines.remove_boilerplate(documents(docs)).collect()}
    assert len(found) == len(docs)
    assert all(n == (1 if i < 200 or i >= 400 else 0) for i, n in found.items())


def plain_scan(text, items, size=13):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hit, found = set(), set()
    for item, source in items:
        own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), source or ""))
        k = min(size, len(own))
        for i in range(len(own) - k + 1 if own else 0):
            for j in range(len(words) - k + 1):
                if words[j : j + k] == own[i : i + k]:
                    hit |= set(range(j, j + k))
                    found.add(item)
    return len(words), len(hit), len(found)


def test_contamination_against_brute_force(spark, documents):
    item = "One two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    items = [(1, item), (2, "Ünï code"), (3, ""), (4, None), (5, "ünï CODE"), (6, "a a a"), (None, "nothing")]
    texts = [
        f"Before {item.upper()}! after", "before ünï-code", "ÜNÏ code", None, "", "a A a a b a a", item + " x" * 300,
        "one two three four five six seven eight nine ten eleven twelve", "nothing", "x " * 5000 + item, item,
    ]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = documents([*texts, (0, texts[0])]).withColumn("spans", F.lit(1))
    named = [i for i in items if i[0] is not None]
    for share in (1 << 20, 40):  # one automaton, then several
        out = contamination.scan(docs, bench, contamination.ContaminationParams(share_bytes=share)).collect()
        assert len(out) == len(texts) + 1
        for row in out:
            words, hit, found = plain_scan(row["text"], named)
            assert (row["n_words"], row["n_hit"], row["n_items"]) == (words, hit, found)
            assert row["contaminated"] == (hit > 0 and 20 * hit >= words)
        first = [r for r in out if r["doc_id"] == 0]
        assert all(r["text"][s["first_char"] : s["end_char"]] == item.upper() for r in first for s in r["spans"])
    named = bench.withColumn("item_id", F.concat(F.lit("item-"), F.col("item_id").cast("string")))
    one, several = (
        {tuple(r) for r in contamination.scan(docs, named, contamination.ContaminationParams(share_bytes=share)).select("n_hit", "n_items", "items_sha256").collect()}
        for share in (1 << 20, 40)
    )
    assert one == several
    assert contamination.scan(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert contamination.scan(docs.limit(0), bench).count() == 0


def test_rates_reach_the_targets(spark):
    rng = np.random.default_rng(3)
    posterior = rng.dirichlet([2, 0.5, 0.2], 500)
    tokens = rng.integers(0, 1000, 500)
    rows = spark.createDataFrame(
        [(int(n), [float(x) for x in p]) for n, p in zip(tokens, posterior)], "n_tokens bigint, posterior array<double>"
    )
    params = mixing.MixParams(targets={"a": 0.3, "b": 0.1, "c": 0.6})
    steps = mixing.fit_rates(rows, ["a", "b", "c"], params)
    rates = mixing.replay(posterior, steps)
    assert (rates >= 0).all() and (rates == 0).any()
    assert np.allclose((tokens * rates) @ posterior / tokens.sum(), [0.3, 0.1, 0.6], atol=2e-3)
    assert mixing.fit_rates(rows.limit(0), ["a", "b", "c"], params) == []


def _nonnegative_least_squares(columns, goal, sweeps):
    """Coordinate descent: every rate in turn takes its best value of 0 and more."""
    rate, residual = np.ones(columns.shape[1]), columns.sum(1) - goal
    squares = (columns**2).sum(0)
    for _ in range(sweeps):
        for d in np.flatnonzero(squares):
            new = max(0.0, rate[d] - columns[:, d] @ residual / squares[d])
            residual += (new - rate[d]) * columns[:, d]
            rate[d] = new
    return rate, residual


def test_rates_are_the_nonnegative_least_squares_solution(spark):
    rng = np.random.default_rng(5)
    # nobody is more than half in c, so 0.9 of c cannot be reached whatever the rates are
    posterior = rng.dirichlet([1, 1, 1], 40)
    posterior[:, 2] = np.minimum(posterior[:, 2], 0.4)
    posterior /= posterior.sum(1, keepdims=True)
    tokens = rng.integers(0, 50, 40)
    rows = spark.createDataFrame(
        [(int(n), [float(x) for x in p]) for n, p in zip(tokens, posterior)], "n_tokens bigint, posterior array<double>"
    )
    goals = {"reached": [0.5, 0.3, 0.2], "not reached": [0.05, 0.05, 0.9]}
    columns = (posterior * tokens[:, None] / tokens.sum()).T
    for name, goal in goals.items():
        params = mixing.MixParams(targets=dict(zip("abc", goal)), tolerance=1e-6, progress=1e-7)
        steps = mixing.fit_rates(rows, list("abc"), params)
        rate = mixing.replay(posterior, steps)
        residual = columns @ rate - goal
        _, best = _nonnegative_least_squares(columns, np.array(goal), 3000)
        assert (rate >= 0).all()
        assert residual @ residual <= best @ best * (1 + 1e-3) + 1e-11, name
        assert (np.abs(residual).max() <= 1e-6) == (name == "reached")


def test_mixing_of_labelled_and_odd_documents(documents):
    good, bad = "clear useful words about science and history", "junk spam noise buy click now"
    docs = documents([f"{good} {i}" for i in range(30)] + [f"{bad} {i}" for i in range(30)] + [None, "", (0, f"{good} 0")])
    docs = docs.withColumn("rate", F.lit("mine"))
    labelled = docs.filter("doc_id < 60").select("doc_id", F.when(F.col("doc_id") < 30, "good").otherwise("poor").alias("domain"))
    params = mixing.MixParams(targets={"good": 0.8, "poor": 0.2})
    out = mixing.mix(docs, labelled, params).toPandas()
    assert len(out) == 63 and (out.rate >= 0).all() and (abs(out.copies - out.rate) < 1).all()
    posterior = np.array(out.posterior.tolist())
    assert np.allclose((out.n_tokens * out.rate) @ posterior / out.n_tokens.sum(), [0.8, 0.2], atol=2e-3)
    assert posterior[out.doc_id < 30, 0].min() > 0.5 > posterior[(out.doc_id >= 30) & (out.doc_id < 60), 0].max()
    assert set(mixing.mix(docs, labelled.limit(0), params).toPandas().posterior.map(tuple)) == {(0.5, 0.5)}
    assert mixing.mix(docs.limit(0), labelled, params).count() == 0
