"""Near copies, vectors and long repeats against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from devigil.llm import near, shared, suffixes, vectors


def words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def edited(rng, base, n):
    out = list(base)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return out


def groups_of(texts, percent=75):
    """``{id: (set size, smallest reachable id)}`` of (id, text) pairs."""
    sets = {}
    for i, t in texts:
        w = [x for x in (t or "").lower().split() if x]
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in ids:
                a, b = sets[i], sets[j]
                if i < j and a and b and label[i] != label[j] and 100 * len(a & b) >= percent * len(a | b):
                    low = min(label[i], label[j])
                    label[i] = label[j] = low
                    changed = True
    return {i: (len(sets[i]), label[i]) for i in ids}


@pytest.mark.parametrize("block", [1024, 4])
def test_near_copies_against_brute_force(documents, rows, block):
    rng = random.Random(7)
    base = words(rng, 120)
    texts = [" ".join(edited(rng, base, k % 9)) for k in range(60)]
    texts += [" ".join(words(rng, rng.randrange(1, 60))) for _ in range(20)]
    texts += [texts[3].upper(), texts[70], "a b", "A  b"]
    chain = base
    for _ in range(12):
        chain = edited(rng, chain, 3)
        texts.append(" ".join(chain))
    texts += [None, "", " \n "]
    want = groups_of(list(enumerate(texts)))
    found = near.near_duplicates(documents(texts).withColumn("kept", F.lit("x")), near.NearParams(block=block)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_near_copies_of_odd_rows(documents):
    text = " ".join(f"w{i}" for i in range(40))
    found = near.near_duplicates(documents([(5, text), (5, text), (None, text), (7, text), (8, "x")])).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in found) == [
        (-1, -1, True), (5, 5, True), (5, 5, True), (7, 5, False), (8, 8, True),
    ]
    assert near.near_duplicates(documents([])).count() == 0


def test_every_pair_within_the_distance_shares_a_bucket():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a = rng.integers(0, 1 << 16, near.ITEMS, dtype=np.uint16)
        b = a.copy()
        b[rng.choice(near.ITEMS, near.FARTHEST, replace=False)] ^= 1
        errors = (a != b).reshape(near.CHUNKS, near.CHUNK).sum(1)
        assert errors.min() <= 1


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(12, 16))
    x = np.concatenate([centers[i % 12] + rng.normal(size=16) * rng.choice([0.05, 0.2, 0.4]) for i in range(300)]).reshape(-1, 16)
    x = x.astype(np.float32)
    x[7] = x[3]
    x[8] = 2 * x[3]
    rows = [(i, [float(v) for v in x[i]]) for i in range(300)]
    odd = [(900, None), (901, []), (902, [0.0] * 16), (903, [1.0, None] * 8), (904, [float("nan")] * 16), (905, [float("inf")] + [0.0] * 15), (906, [1.0, 2.0]), (907, [2.0, 4.0]), (None, rows[3][1]), (908, rows[3][1])]
    frame = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>").withColumn("links", F.lit("x"))
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    unit = np.concatenate([unit, unit[3:4]])
    near_ = unit @ unit.T >= 0.9
    label = np.array([*range(300), 908])
    for _ in range(50):
        label = np.array([label[row].min() for row in near_])
    for params in (vectors.VectorParams(), vectors.VectorParams(least_blocks=3, tile=16)):
        found = {r["vec_id"]: r for r in vectors.near_vectors(frame, params).collect()}
        assert len(found) == 310
        for at, i in enumerate([*range(300), 908]):
            assert (found[i]["n_links"], found[i]["component_id"]) == (near_[at].sum() - 1, label[at]), i
            assert found[i]["kept"] == (i == label[at])
        for i in (900, 901, 902, 903, 904, 905):
            assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (0, i, True)
        assert found[907]["component_id"] == 906 and found[906]["n_links"] == 1
        assert (found[None]["n_links"], found[None]["component_id"], found[None]["kept"]) == (0, None, True)
    assert vectors.near_vectors(frame.limit(0)).count() == 0


def test_quantised_products_miss_no_pair():
    rng = np.random.default_rng(2)
    unit = rng.normal(size=(400, 24))
    unit[200:] = unit[:200] + rng.normal(size=(200, 24)) * 0.45
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    coded = vectors.quantise(unit)
    i, j = vectors.possible_pairs(coded, coded, 0.9)
    assert set(zip(*np.nonzero(unit @ unit.T >= 0.9))) <= set(zip(i, j)) and len(i) < 2000
    # mostly error: one dimension sets the scale, all others are below half a step, at scales far apart
    spiky = np.full((40, 20000), 0.0035)
    spiky[:20, 0], spiky[20:, 0] = 0.995, 0.9
    spiky[20:] *= rng.choice([-1, 1], size=(20, 20000))
    spiky /= np.linalg.norm(spiky, axis=1)[:, None]
    coded = vectors.quantise(spiky)
    for threshold in (0.1, 0.5, 0.9):
        i, j = vectors.possible_pairs(coded, coded, threshold)
        assert set(zip(*np.nonzero(spiky @ spiky.T >= threshold))) <= set(zip(i, j))
    wide = rng.normal(size=(6, 3000))
    wide /= np.linalg.norm(wide, axis=1)[:, None]
    codes = vectors.quantise(wide)[0]
    assert (vectors._product(codes, codes) == codes.astype(int) @ codes.astype(int).T).all()


def cut_out(texts, size=50):
    """What must be left of (id, text) pairs in order of id."""
    first, out = {}, {}
    for i, t in texts:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - size + 1):
            if first.setdefault(b[j : j + size], i) < i:
                gone[j : j + size] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out[i] = (len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())
    return out


@pytest.mark.parametrize("batches, rounds, range_bytes", [(4, 2, 4 << 20), (1, 1, 3000), (9, 3, 2000)])
def test_long_repeats_against_brute_force(documents, batches, rounds, range_bytes):
    rng = random.Random(11)
    passage = " ".join(words(rng, 60))
    texts = []
    for i in range(60):
        own = " ".join(words(rng, rng.randrange(5, 80)))
        cut = rng.randrange(len(passage))
        texts.append(own + passage[cut : cut + rng.choice([30, 49, 50, 51, 90, 300])] + own[::-1] if i % 3 else own)
    texts += [texts[4], texts[4][10:], "é" * 200, "é" * 90, "ab" * 300, "x" * 49, "x" * 49, None, "", texts[1] + texts[2], "ab" * 25]
    params = suffixes.SuffixParams(batches=batches, rounds=rounds, range_bytes=range_bytes, chunk_bytes=4000)
    docs = documents([(10 * i, t) for i, t in enumerate(texts)]).withColumn("keys", F.lit(0))
    found = suffixes.remove_repeats(docs, params).collect()
    want = cut_out([(10 * i, t) for i, t in enumerate(texts)])
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found} == want


def test_periodic_repeats_with_different_middles_against_brute_force(documents):
    rng = random.Random(13)
    # the smallest hash recurs in the pair, so the whole text is one run
    pair = "| 0.1 | | 0.2 | "
    texts = []
    for _ in range(60):
        middle = "".join(pair + "".join(f"| 0.{rng.randrange(10)} | " for _ in range(2)) for _ in range(6))
        texts.append(pair * 4 + middle + pair * 4)
    docs = [(7 * i, t) for i, t in enumerate(texts)]
    found = suffixes.remove_repeats(documents(docs)).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found} == cut_out(docs)


def test_released_landings_leave_no_shuffle_files(spark):
    rows = spark.range(1000).selectExpr("id % 7 as k", "id").groupBy("k").count()
    store = shared.Landing(spark, "release", release=True)
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffle_files():
        blocks = manager.getAllFiles()
        return {blocks.apply(i).getName() for i in range(blocks.size()) if "shuffle" in blocks.apply(i).getName()}

    before = shuffle_files()
    landed = store.land(rows, "rows")
    assert not shuffle_files() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert landed.count() == 7 and rows.count() == 7
    store.drop("rows")


def test_long_repeats_of_odd_rows(documents):
    text = "a passage of more than fifty bytes that stands in every one of these rows"
    found = suffixes.remove_repeats(documents([(3, text), (3, text + "!"), (None, text), (9, text)])).collect()
    assert sorted((r["doc_id"] or -1, r["n_removed"]) for r in found) == [(-1, 0), (3, 0), (3, 0), (9, len(text))]
    assert found[0]["kept_text"] is not None
    assert suffixes.remove_repeats(documents([])).count() == 0


def test_levels_grow_geometrically(spark, documents):
    family = suffixes.SuffixLevels(spark, 3)
    text = "the same fifty bytes and more in each of all these many batches of one"
    for i in range(8):
        family.add(documents([(i, f"{text} {i}")]).select("doc_id", "text"))
    assert [size for size, _, _ in family.levels] == [4, 2, 1, 1]
    assert {r["doc_id"] for r in family.pairs().collect()} == set(range(8))
