"""Byte-level BPE against the tiktoken library."""

import base64
import hashlib

import numpy as np
import pytest

tiktoken = pytest.importorskip("tiktoken")
public_tokenizers = pytest.importorskip("public_tokenizers")

from devigil.llm import byte_pairs, queries  # noqa: E402

DATA = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [
    "He's  here,\n\n  it'll do 12345 ½²!!! ", None, "", " ", "\t\r\n x", "ünïcödé ﬁ 漢字かな交じり文 สวัสดี", "a" * 5000,
    "ab" * 700, "x y  z　w\x1c\x85q", "👩‍👩‍👧 é", "ࡰࡱᲉ \U00016ac3\U0001e4f1 \U00032000",
    "word " * 20000, "don't DON'T 's'S 'll", "$#%&*|()", "\x00\x01\x7f�", "qz" * 3, "<|endoftext|>",
]


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(text, library):
    ids = library.encode_ordinary(text or "")
    told = ",".join(map(str, ids)).encode()
    return len(ids), hashlib.sha256(told).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_odd_texts(documents, library):
    docs = documents([*TEXTS, (None, TEXTS[0]), (0, TEXTS[0])])
    out = byte_pairs.round_trip(docs, PATH, public_tokenizers.PATTERN)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    found = sorted((tuple(r) for r in out.collect()), key=repr)
    want = [(i, *expected(t, library)) for i, t in enumerate(TEXTS)]
    want += [(None, *expected(TEXTS[0], library)), (0, *expected(TEXTS[0], library))]
    assert found == sorted(want, key=repr)
    assert byte_pairs.round_trip(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_without_a_dictionary_and_clashing_columns(documents, library):
    from pyspark.sql import functions as F

    docs = documents(["some words and some more", None, "Straße und Größe"])
    docs = docs.withColumns({"ids_text": F.lit(1), "word": F.lit("w"), "C0": F.lit(2)})
    out = byte_pairs.round_trip(docs, PATH, public_tokenizers.PATTERN, byte_pairs.BytePairParams(dictionary=0, long_bytes=3))
    assert {r[0]: tuple(r[1:]) for r in out.collect()} == {
        i: expected(t, library) for i, t in enumerate(["some words and some more", None, "Straße und Größe"])
    }


def test_query_on_whole_table(spark, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    found = {r[0]: tuple(r[1:]) for r in queries.op13_byte_pairs(spark, DATA).collect()}
    assert found == {i: expected(t, library) for i, t in docs.items()}


def test_heap_equals_library(library):
    ranks, rng = byte_pairs.read_ranks(PATH), np.random.default_rng(3)
    for n in (1, 2, 3, 10, 300, 2000):
        word = bytes(rng.choice(list(b"abcde tion"), n))
        assert byte_pairs.merge_by_heap(word, ranks) == library._encode_single_piece(word)


def test_many_words_fold_as_in_library(library):
    import pyarrow as pa

    rng = np.random.default_rng(5)
    letters = list("abcde tion漢ü\x00😀")
    words = {"".join(letters[i] for i in rng.integers(0, len(letters), n)) for n in (1, 2, 3, 5, 8, 9) for _ in range(400)}
    words = sorted(words | {"a" * n for n in range(1, 300)} | {"ab" * 150, "ü" * 200})
    want = [",".join(map(str, library._encode_single_piece(w.encode()))) for w in words]
    vocabulary = byte_pairs._vocabulary(PATH)
    for long_bytes in (3, 256):
        assert byte_pairs.fold(pa.array(words), vocabulary, long_bytes).to_pylist() == want
    assert byte_pairs.fold(pa.array(words).slice(7, 50), vocabulary, 256).to_pylist() == want[7:57]
    assert byte_pairs.fold(pa.array([], pa.string()), vocabulary, 256).to_pylist() == []


def test_rare_words_are_not_folded_by_the_plan(documents, library):
    """A word outside the dictionary took some 90 microseconds in a lambda of the plan."""
    docs = documents(["some words and some more", None, "Straße"])
    out = byte_pairs.encode(docs, PATH, public_tokenizers.PATTERN, keep=["doc_id"])
    assert out.columns == ["doc_id", "ids_text"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "aggregate(" not in plan
    found = {r["doc_id"]: r["ids_text"] for r in out.collect()}
    assert found == {i: ",".join(map(str, library.encode_ordinary(t or ""))) for i, t in enumerate(["some words and some more", None, "Straße"])}
