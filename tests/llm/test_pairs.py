"""Operators on pairs against brute force: top-k search, embedding and MinHash near-dedup, components."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from recurra.llm import embedding_dedup, exact_topk, minhash_dedup
from recurra.llm.shared import components
from tests.compare import difference, duck

VECTORS = "vec_id long, vector array<double>"


def least_reachable(nodes, linked):
    """The smallest node that each node reaches."""
    found = {}
    for node in sorted(nodes):
        if node not in found:
            todo, found[node] = [node], node
            while todo:
                here = todo.pop()
                for other in nodes:
                    if other not in found and linked(here, other):
                        found[other] = node
                        todo.append(other)
    return found


def test_components_of_chains_stars_and_repeats(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (100, 101), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 140)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("shard_rows, block", [(10_000, 10_000), (40, 7)])
def test_top_k_equals_brute_force(spark, shard_rows, block):
    draw = np.random.default_rng(3)
    points = draw.integers(-9, 9, (300, 6))
    points[100:200] = points[0]  # a third of all rows: one vector
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    vectors = spark.createDataFrame(rows, VECTORS)
    got = {}
    found = exact_topk.top_k(vectors, vectors.where("vec_id % 10 = 0"), 5, shard_rows, block, 16)
    for r in found.collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(got) == set(range(0, 300, 10))
    for q, best in got.items():
        scores = points @ points[q]
        order = [i for i in np.lexsort((np.arange(300), -scores)) if i != q][:5]
        assert best == {k + 1: (i, scores[i]) for k, i in enumerate(order)}


@pytest.mark.parametrize("size", [300, 2**27, 2**31, 2**62])
@pytest.mark.parametrize("shard_rows", [10_000, 40])
def test_top_k_of_integers_is_exact(spark, size, shard_rows):
    draw = np.random.default_rng(5)
    points = [[int(x) for x in p] for p in draw.integers(-size, size, (200, 3))]
    points[:60] = [[size - 1 - i % 4, size, i % 3] for i in range(60)]  # scores that differ in the last digit only
    vectors = spark.createDataFrame(list(enumerate(points)), "vec_id long, vector array<long>")
    got = {}
    for r in exact_topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), 5, shard_rows, 7, 8).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, int(r.score))
    assert len(got) == 10
    for q, best in got.items():
        scores = sorted((-sum(a * b for a, b in zip(points[q], p)), i) for i, p in enumerate(points) if i != q)[:5]
        assert best == {k + 1: (i, min(10**38 - 1, -less)) for k, (less, i) in enumerate(scores)}


def test_scaled_components_round_down(spark):
    vectors = spark.createDataFrame([(1, [0.5, -0.001, 0.0, 1 / 256])], VECTORS)
    assert vectors.select(exact_topk.scaled("vector", 256).alias("v")).first().v == [128, -1, 0, 1]


@pytest.mark.parametrize("name", ["op1_exact_topk", "op3_embedding_dedup", "op10_minhash_dedup"])
def test_queries_equal_their_sql(spark, name):
    path = "/root/testdata/sf0.01"
    assert difference(spark, duck(path), name, path) == ""


def test_top_k_edges(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, []), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, [2.0, 0.0]),
            (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (8, [float("inf"), 1.0])]
    vectors = spark.createDataFrame(rows, VECTORS).withColumn("rank", F.lit("clash"))
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in exact_topk.top_k(vectors, vectors, 5).collect()]
    assert sorted(got) == [(1, 1, 6, 2.0), (6, 1, 1, 2.0)]
    none = vectors.limit(0)
    assert exact_topk.top_k(none, none).count() == 0 and exact_topk.top_k(vectors, none).count() == 0
    with pytest.raises(ValueError):
        exact_topk.top_k(vectors, vectors, 0)


def test_code_estimates_are_unbiased_and_bounded():
    draw = np.random.default_rng(1)
    x, y = (v / np.linalg.norm(v) for v in draw.standard_normal((2, 64)))
    y = 0.9 * x + np.sqrt(1 - 0.81) * (y - (x @ y) * x) / np.linalg.norm(y - (x @ y) * x)
    guesses, inside = [], 0
    for seed in range(400):
        packed, factor = embedding_dedup.codes(x[None], seed)
        guess, error = embedding_dedup.estimates(packed, factor, y[None], 3.5, seed)
        guesses.append(guess[0, 0])
        inside += abs(guess[0, 0] - 0.9) <= error[0]
    assert abs(np.mean(guesses) - 0.9) < 0.015 and inside >= 398


def test_embedding_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", 50)
    draw = np.random.default_rng(5)
    base = draw.standard_normal((60, 32))
    near = np.repeat(base[:20], 8, axis=0) + 0.08 * draw.standard_normal((160, 32))
    hot = base[30] + 0.02 * draw.standard_normal((120, 32))
    points = np.concatenate([base, near, hot, base[:15]])
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(
        spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], VECTORS)).collect()}
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    least = least_reachable(range(len(points)), lambda a, b: linked[a, b])
    found = sum(r.n_links for r in got.values())
    assert len(got) == len(points) and 0.9 * linked.sum() <= found <= linked.sum()
    assert all(got[i].n_links <= linked[i].sum() for i in got)
    assert np.mean([got[i].component_id == least[i] for i in got]) > 0.95
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_embedding_edges(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, []),
            (8, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (2, [2.0, 0.0]), (9, [1.0, 0.0])]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(
        spark.createDataFrame(rows, VECTORS)).collect()}
    alone = {i: (0, i, True) for i in (3, 4, 5, 6, 7, 8)}
    assert got == alone | {1: (2, 1, True), 2: (2, 1, False), 9: (2, 1, False), None: (0, None, True)}
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def test_embeddings_of_extreme_size_link_by_direction(spark):
    rows = [(1, [1e-200, 0.0]), (2, [2e-200, 0.0]), (3, [1e200, 1e200]), (4, [2e200, 1.9e200]), (5, [0.0, 5e-324]), (6, [0.0, -1.7e308]),
            (7, [1e-310, 1e308]), (8, [-3e-320, 0.0]), (9, [-1.0, 1e-300])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 3), 5: (1, 5), 6: (0, 6), 7: (1, 5), 8: (1, 8), 9: (1, 8)}
    plain = np.random.default_rng(1).standard_normal((40, 7))
    assert (embedding_dedup.unit_rows(plain) == plain / np.linalg.norm(plain, axis=1, keepdims=True)).all()


def shingles(text):
    words = text.encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def close(a, b):
    return bool(a and b) and 100 * len(a & b) >= 75 * len(a | b)


@pytest.mark.parametrize("short, block", [(48, 64_000), (3, 900)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, short, block):
    monkeypatch.setattr(minhash_dedup, "SHORT_LIST", short)
    monkeypatch.setattr(minhash_dedup, "BLOCK_SHINGLES", block)
    draw = np.random.default_rng(11)
    word = lambda: f"w{draw.integers(0, 4000)}"
    base = [[word() for _ in range(draw.integers(6, 160))] for _ in range(40)]
    boilerplate = [word() for _ in range(30)]
    docs = [list(b) for b in base] + [list(b) for b in base[:10]]
    for rate in (0.0, 0.01, 0.03, 0.06):
        docs += [[word() if draw.random() < rate else w for w in base[k % 12]] for k in range(40)]
    docs += [[*base[k], *boilerplate] for k in range(20)]
    docs += [["Same", "Three", "words"], ["same", "three", "WORDS"], ["other"], []]
    texts = [" ".join(d) for d in docs]
    got = {r.doc_id: r for r in minhash_dedup.near_duplicates(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    sets = [shingles(t) for t in texts]
    least = least_reachable(range(len(sets)), lambda a, b: close(sets[a], sets[b]))
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (len(s), least[i], least[i] == i) for i, s in enumerate(sets)
    }


def test_texts_that_share_a_doc_id_keep_their_own_links(spark):
    a, b, c = (" ".join(f"{name}{i}" for i in range(60)) for name in "abc")
    rows = [(7, a), (7, b), (9, a + " more"), (3, b + " more"), (12, c), (12, c.upper()), (12, c + " x"), (5, "one two"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(docs).collect())
    assert got == [
        (3, 57, 3, True), (5, 0, 5, True), (5, 1, 5, True), (7, 56, 3, False), (7, 56, 7, True), (9, 57, 7, False),
        (12, 56, 12, True), (12, 56, 12, True), (12, 57, 12, True),
    ]
    assert {r.text for r in minhash_dedup.keep_one(docs).where("doc_id = 5").collect()} == {"one two", None}


def test_near_duplicate_edges(spark):
    same = "one two three four five six"
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, same), (5, f"  {same.upper()}\n"), (None, same), (5, same), (6, "é " * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("clash")).withColumn("digest", F.lit(1))
    got = sorted(
        ((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(docs).collect()), key=repr
    )
    assert got == sorted(
        [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 2, 4, True), (5, 2, 4, False), (5, 2, 4, False), (6, 1, 6, True),
         (None, 2, None, True)], key=repr)
    kept = minhash_dedup.keep_one(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "6", "None"]
    assert minhash_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_shingles_keep_word_order(spark):
    orders = [" ".join(p) for p in itertools.permutations(("a", "b", "c", "d"))]
    rows = spark.createDataFrame(list(enumerate(orders)), "doc_id long, text string")
    assert minhash_dedup.near_duplicates(rows).where("kept").count() == 24
