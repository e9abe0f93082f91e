"""WARC, licences, toxicity and the pipeline."""

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from devigil.llm import licences, mixing, queries, toxicity, warc
from devigil.llm.shared import Landing

DATA = "/root/testdata/sf0.001"


def captures(spark, pages, **options):
    store = Landing(spark, "warc-test")
    warc.write_archives(pages, f"{store.folder}/archives", **options)
    records = warc.read_records(spark, f"{store.folder}/archives")
    found = warc.assemble(records)
    return records, found.withColumn("page_id", F.element_at("metadata.fields", "pageId").cast("bigint"))


def test_archives_round_trip(spark):
    html = ["<p>ü</p>\r\n\r\nWARC/1.1\r\n\r\n", "", None, "<p>ü</p>\r\n\r\nWARC/1.1\r\n\r\n", "x" * 300_000, "a\rb\n\n", ""]
    rows = [(i, f"http://h/{i}", h) for i, h in enumerate(html)] + [(8, None, "n"), (9, "http://h/\r\nX: y", "o"), (4, "http://h/4", html[4])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit("mine"))
    records, found = captures(spark, pages)
    kinds = {r["type"]: r["count"] for r in records.groupBy("type").count().collect()}
    assert kinds == {"request": 10, "metadata": 10, "response": 7, "revisit": 3}
    got = sorted(tuple(r) for r in warc.digest(found).collect())
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        first = min(j for j, _, g in rows if (g or "") == (h or ""))
        sha = base64.b32encode(hashlib.sha1(b).digest()).decode()
        want.append((i, len(b), sha, "response", None, True) if i == first else (i, len(b), sha, "revisit", first, True))
    assert got == sorted(want, key=lambda r: tuple((x is None, x) for x in r)) or got == sorted(want)
    stored = {r["page_id"]: bytes(r["main"]["payload"]) for r in found.filter("main.type = 'response'").collect()}
    assert stored[0] == html[0].encode() and stored[4] == html[4].encode() and stored[5] == html[5].encode()
    assert all(r["request"]["type"] == "request" for r in found.collect())


def test_small_payloads_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id bigint, url string, html string")
    _, found = captures(spark, pages, least_bytes=3)
    kinds = {r["page_id"]: r["record_type"] for r in warc.digest(found).collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    _, none = captures(spark, pages.limit(0))
    assert none.count() == 0


def test_licences_and_odd_rows(documents):
    prose = [f"the work of number {i} is in the house of the old man and the dog" for i in range(60)]
    rows = prose + [
        "Licensed under the MIT License.", "text\nThis work is licensed under the GNU General Public License, version 3.\nmore",
        "Dedicated to the public domain under CC0 1.0 Universal.", "He was licensed under the old law.", None, "", " \n ",
        "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.", "license", "word " * 20000 + "\nAll rights reserved.",
    ]
    docs = documents([*rows, (60, rows[60]), (None, rows[62])]).withColumn("hash_a", F.lit("x"))
    found = [tuple(r) for r in licences.licences(docs).collect()]
    by_id = {r[0]: r[1:] for r in found}
    assert len(found) == len(rows) + 2 and found.count((60, "MIT", 1, "MIT")) == 2
    assert all(by_id[i] == ("unknown", 0, "") for i in [*range(60), 63, 64, 65, 66, 68])
    assert by_id[61] == ("GPL", 1, "GPL") and by_id[62] == by_id[None] == ("CC0", 1, "CC0")
    assert by_id[67][1:] == (2, "CC-BY-NC,MIT") and by_id[69] == ("proprietary", 1, "proprietary")
    assert licences.licences(docs.limit(0)).count() == 0


def test_licences_wrapped_over_lines(documents):
    import textwrap

    prose = [f"the work of number {i} is in the house of the old man and the dog" for i in range(60)]
    long = {f: max((t for family, t in licences.NOTICES if family == f), key=len) for f in ("GPL", "MIT", "BSD", "Apache-2.0")}
    wrapped = {f: "\n".join(textwrap.wrap(t, 40 if f == "BSD" else 72)) for f, t in long.items()}
    rows = prose + [
        f"some words\n\n{wrapped['GPL']}\n\nother words", textwrap.indent(wrapped["MIT"], "# "), wrapped["BSD"],
        f"{wrapped['GPL']}\n \n{wrapped['BSD']}", wrapped["MIT"].replace("\n", "\n\n"),
        f"Licensed under CC BY-NC 4.0.\n{wrapped['GPL']}",
    ]
    found = {r[0]: tuple(r[1:]) for r in licences.licences(documents(rows)).collect()}
    assert [found[i] for i in range(60, 63)] == [(f, 1, f) for f in ("GPL", "MIT", "BSD")]
    assert found[63][1:] == (2, "BSD,GPL") and found[64] == ("unknown", 0, "")
    assert found[65][1:] == (2, "CC-BY-NC,GPL")
    assert all(found[i] == ("unknown", 0, "") for i in range(60))


def test_nearest_examples_are_exact():
    import numpy as np

    rng = np.random.default_rng(4)
    idf = rng.uniform(0.5, 3, 40)
    draw = lambda: {int(t): float(rng.integers(1, 4)) for t in rng.choice(40, rng.integers(0, 8), replace=False)}
    examples = [draw() for _ in range(500)]
    index = toxicity.build_index(examples, idf, 16)
    dense = np.zeros((500, 40))
    for i, v in enumerate(examples):
        for t, w in v.items():
            dense[i, t] = w * idf[t]
    length = np.sqrt((dense**2).sum(1))
    for _ in range(100):
        query = draw()
        at, cosines = toxicity.nearest(index, query, idf, 10)
        q = np.zeros(40)
        for t, w in query.items():
            q[t] = w * idf[t]
        exact = np.divide(dense @ q, length * np.sqrt((q**2).sum()), out=np.zeros(500), where=length > 0) if query else np.zeros(500)
        want = np.sort(exact[exact > 0])[::-1][:10]
        assert np.allclose(cosines, want) and np.allclose(exact[at], cosines)


def test_toxicity_learns_and_takes_odd_rows(spark, documents):
    import random

    rng = random.Random(2)
    texts, labels = [], []
    for i in range(600):
        words = ["abcdefgh"[rng.randrange(8)] * 3 + "xyz"[rng.randrange(3)] for _ in range(60)]
        if i % 5 == 0:
            words[::12] = [rng.choice(["nasty", "vileness"]) for _ in words[::12]]
        texts.append(" ".join(words))
        labels.append((i, int(i % 5 == 0)))
    docs = documents([*texts, (900, None), (901, ""), (902, "nasty " * 9000), (None, texts[0]), (0, texts[0])]).withColumn("score", F.lit("x"))
    frame = spark.createDataFrame([*labels, (1, None), (None, 1)], "doc_id bigint, toxic int")
    out = toxicity.scores(docs, frame).toPandas()
    assert len(out) == 605 and out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.5)).all()
    known = out[out.doc_id < 600]
    truth = (known.doc_id % 5 == 0).astype(int)
    assert (known.predicted == truth).mean() > 0.98
    odd = out.set_index("doc_id").predicted
    assert odd[900] == odd[901] == 0 and odd[902] == 1
    toxic = out[out.predicted == 1]
    assert toxic.evidence.map(lambda e: e[0]["toxic"]).mean() > 0.95
    assert set(toxicity.scores(docs, frame.limit(0)).toPandas().score) == {0.0}
    assert toxicity.scores(docs.limit(0), frame).count() == 0


def test_domains_of_labels(spark, rows):
    frame = spark.createDataFrame([(1, 0, 0), (2, 1, 0), (3, 1, 1), (4, None, None), (5, None, 1)], "doc_id int, quality int, toxic int")
    found = {r["doc_id"]: r["d"] for r in frame.select("doc_id", mixing.domain_of_labels().alias("d")).collect()}
    assert found == {1: "poor", 2: "good", 3: "toxic", 4: None, 5: "toxic"}


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "lines", "near duplicates", "benchmark", "mixing"]
    dirty = docs.unionByName(
        docs.limit(1).select(F.lit(9001).cast("bigint").alias("doc_id"), F.lit("12 34 %%").alias("text"), "lang", "source", "n_chars")
    )
    step = corpus_pipeline.language_stage(spark, dirty, DATA)
    assert step.count() == docs.count() and step.columns == docs.columns
    single = corpus_pipeline.near_stage(spark, docs.unionByName(docs.limit(5)), DATA)
    component = queries.op4_minhash_near_duplicates(spark, DATA)
    assert {r[0] for r in single.select("doc_id").collect()} == {r[0] for r in component.filter("kept").select("doc_id").collect()}
    assert single.count() == single.select("doc_id").distinct().count()
    clean = corpus_pipeline.benchmark_stage(spark, docs, DATA)
    found = queries.op2_benchmark_windows(spark, DATA)
    assert {r[0] for r in clean.select("doc_id").collect()} == {r[0] for r in found.filter("not contaminated").select("doc_id").collect()}
    whole = corpus_pipeline.run(spark, DATA)
    assert whole.columns[: len(docs.columns)] == docs.columns and {"rate", "copies"} <= set(whole.columns)
    assert 0 < whole.count() <= docs.count()


@pytest.mark.parametrize("name", [*sorted(queries.QUERIES), "pipeline"])
def test_queries_on_empty_tables(spark, tmp_path, name):
    build = queries.QUERIES.get(name, corpus_pipeline.run)
    for table in ("documents", "benchmark", "labels", "pages", "embeddings"):
        spark.read.parquet(f"{DATA}/{table}.parquet").limit(0).write.parquet(str(tmp_path / f"{table}.parquet"))
    assert build(spark, str(tmp_path)).count() == 0


def test_licences_are_learnt_from_all_paragraphs(documents):
    lines = [f"word{i} of the line{i}" if i % 50 == 0 else f"word{i} and line{i}" for i in range(2000)]
    docs = documents([(i, "\n".join(lines[20 * i : 20 * i + 20])) for i in range(100)]).select("doc_id", "text")
    model = licences.train(docs, licences.LicenceParams(negatives=10))
    # 40 of 2000 paragraphs have this word pair, of ten drawn ones hardly any would
    assert model.weights.filter("gram = 'of the'").isEmpty()
    assert not model.weights.filter("gram = 'gnu general'").isEmpty()
