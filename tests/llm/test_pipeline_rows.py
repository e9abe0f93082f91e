"""The pipeline's stages on repeated ids and on columns with any names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

DATA = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def words(start, n=40):
    return " ".join(f"w{start}x{i}" for i in range(n))


def test_near_stage_keeps_every_text_of_a_repeated_id(spark, documents):
    docs = documents([(1, words(1)), (1, words(2)), (2, words(3)), (3, words(3) + " end"), (None, words(1)), (4, None), (4, None), (1, words(1))])
    out = STAGES["near duplicates"](spark, docs, DATA)
    assert out.columns == docs.columns
    found = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    assert found == sorted([(1, words(1)), (1, words(2)), (2, words(3)), (None, words(1)), (4, None)], key=repr)


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_keep_columns_of_any_name(spark, name):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(120)
    odd = docs.withColumns({"stage_score": F.lit("mine"), "N_LINES": F.lit("lines"), "Line_A": F.lit(1)})
    odd = odd.withColumn("a.b", F.col("doc_id") * 2).withColumn("a b`c", F.lit("q")).withColumn("GONE", F.create_map(F.lit("k"), F.lit(1)))
    odd = odd.select("source", "stage_score", F.col("`a.b`"), F.col("`a b``c`"), "doc_id", "N_LINES", "Line_A", "GONE", "text", "n_chars", "lang")
    plain = {r["doc_id"]: r["text"] for r in STAGES[name](spark, docs, DATA).collect()}
    out = STAGES[name](spark, odd, DATA)
    assert out.columns[: len(odd.columns)] == odd.columns
    found = out.collect()
    assert {r["doc_id"]: r["text"] for r in found} == plain
    assert all((r["stage_score"], r["N_LINES"], r["a.b"], r["GONE"]) == ("mine", "lines", 2 * r["doc_id"], {"k": 1}) for r in found)


def test_added_columns_win(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(60).withColumn("Rate", F.lit("mine"))
    out = STAGES["mixing"](spark, docs, DATA)
    assert [c for c in out.columns if c.lower() == "rate"] == ["rate"] and dict(out.dtypes)["rate"] == "double"
