import math

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import topk


def plain(rows, k, scale=1024):
    fine = [
        (i, [math.floor(scale * x) for x in v])
        for i, v, *_ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q in sorted({i for i, _ in fine if i % 100 == 0}):
        vector = min(v for i, v in fine if i == q)
        scored = sorted((-sum(a * b for a, b in zip(vector, v, strict=False)), i) for i, v in fine if i != q)
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return out


def found(df, k, shard=topk.SHARD):
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 100 == 0, k, shard=shard).collect())


def test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [tuple(r) for r in df.select("vec_id", "embedding").collect()]
    want = plain(rows, 10)
    assert found(df, 10) == want and found(df, 10, shard=37) == want


ODD = [
    (0, [1.0, -2.0]), (100, [0.5]), (1, [1.0, -2.0]), (2, [1.0, -2.0]), (3, None), (4, [None, 1.0]), (5, [float("nan")]),
    (6, [float("inf"), 1.0]), (None, [1.0]), (7, []), (200, []), (8, [3.0, 1.0, 5.0]), (8, [3.0, 1.0, 5.0]), (300, None),
    (9, [1e9, 1e6]), (400, [-0.0004, 1e6]), (400, [7.0]),
]


def test_odd_vectors(spark):
    df = spark.createDataFrame(ODD, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "2 as v", "3 as score")
    for k in (1, 3, 50):
        assert found(df, k) == plain(ODD, k)
    assert found(df.limit(0), 10) == []
    assert found(df.where("vec_id % 100 <> 0"), 10) == []


def test_shards_have_the_stated_size(spark):
    """Batches to Python hold 1,000 rows; a shard gathers over them."""
    df = spark.range(0, 20_000, 1, 1).selectExpr("id", "array(id, -id) as v")
    topk.ship(spark)
    packs = topk.packed(df, 16_384).collect()
    assert [len(p.ids) // 8 for p in packs] == [16_384, 3_616]
    ids, vectors = topk.unpacked(*packs[1])
    assert ids.tolist() == list(range(16_384, 20_000)) and (vectors == np.stack([ids, -ids], axis=1)).all()
    uneven = [len(p.ids) // 8 for p in topk.packed(df, 1_500).collect()]
    assert uneven == [1_500] * 13 + [500]


def test_blocks_are_left_out_and_results_are_exact(spark, monkeypatch):
    """40,000 vectors whose length falls with the id: the best are in the first blocks, and the bounds of the others tell."""
    rng = np.random.default_rng(1)
    ids, scale = np.arange(40_000), np.exp(-np.arange(40_000) / 4_000)
    vectors = np.floor(1024 * rng.normal(size=(40_000, 8)) * scale[:, None]).astype(np.int64)
    scored, products = [], topk._products
    monkeypatch.setattr(topk, "_products", lambda q, v: scored.append(len(v) if len(q) == 1 else 0) or products(q, v))
    queries = ids[::1000]
    place, names, score = topk.best_of_shard(queries, vectors[queries], ids, vectors, 10)
    assert sum(scored) < len(queries) * 40_000 / 2  # most blocks are left out
    for i, q in enumerate(queries):
        every = vectors @ vectors[q]
        best = [j for j in np.lexsort((ids, -every)) if j != q][:10]
        assert names[place == i].tolist() == best and score[place == i].tolist() == every[best].tolist()
    df = spark.createDataFrame([(int(i), (v / 1024).tolist()) for i, v in zip(ids[:20_000], vectors[:20_000])], "vec_id long, embedding array<double>")
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 1000 == 0, 10, shard=4_096).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q in queries[:20]:
        every = vectors[:20_000] @ vectors[q]
        best = [j for j in np.lexsort((ids[:20_000], -every)) if j != q][:10]
        assert sorted(got[q]) == [(n, int(j), int(every[j])) for n, j in enumerate(best, 1)]


def test_neither_side_is_copied_or_sent_through_the_driver(spark):
    """Every group of queries was copied for every shard, and Spark, which did not count the copies, broadcast them all."""
    rows = [(i, [float(i % 7), float(-i % 5)]) for i in range(600)]
    df = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 100 == 0, 3, shard=10)
    assert sorted(tuple(r) for r in df.collect()) == plain(rows, 3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan
    assert not [step for step in ("Broadcast", "Generate", "SortMergeJoin", "ShuffledHashJoin") if step in plan]


def test_values_take_the_bits_they_need(spark):
    for most, width in ((32_767, 2), (-32_769, 4), (1 << 40, 8)):
        df = spark.createDataFrame([(1, [1, most]), (2, [3])], "id long, v array<long>").coalesce(1)
        row = topk.packed(df, 10).collect()[0]
        assert len(row["values"]) == 3 * width
        assert topk.unpacked(*row)[1].tolist() == [[1, most], [3, 0]]
    empty = topk.packed(spark.createDataFrame([(1, [])], "id long, v array<long>"), 10).collect()[0]
    assert topk.unpacked(*empty)[1].shape == (1, 0)


def best_of_shards(queries, vectors, ids, k, size, block):
    best = topk.nothing_yet(len(queries), k)
    for start in range(0, len(ids), size):
        shard = topk.shard_of(ids[start : start + size], vectors[start : start + size], block)
        topk.search_shard(ids[queries], vectors[queries], shard, *best)
    return best


def test_scores_of_any_size_and_ties_are_exact_over_many_shards():
    """Products that fit 24 bits, 53 and 63, bounds that fit no longer, and rows that are equal many times."""
    rng = np.random.default_rng(2)
    for most in (2, 400, 1 << 14, 1 << 22, 1 << 30):
        vectors, ids = rng.integers(-most, most, (700, 8)), rng.permutation(900)[:700]
        vectors[rng.integers(0, 700, 300)] = vectors[:3].repeat(100, axis=0)
        ids[-20:] = ids[:20]  # rows repeated with one id
        queries = np.unique(ids, return_index=True)[1][::9]
        names, scores = best_of_shards(queries, vectors, ids, 12, 150, 16)
        for i, q in enumerate(queries):
            exact = [(-sum(int(a) * int(b) for a, b in zip(vectors[q], v)), int(j)) for v, j in zip(vectors, ids) if j != ids[q]]
            assert list(zip((-scores[i]).tolist(), names[i].tolist())) == sorted(exact)[:12]


def test_the_k_best_carry_over_to_the_next_shard(monkeypatch):
    """Once the first shard holds the longest vectors, the bounds of later blocks leave them out for all queries."""
    rng = np.random.default_rng(1)
    vectors = np.floor(1024 * rng.normal(size=(40_000, 8)) * np.exp(-np.arange(40_000) / 4_000)[:, None]).astype(np.int64)
    queries, pairs, products = np.arange(0, 40_000, 1_000), [], topk._products
    monkeypatch.setattr(topk, "_products", lambda q, v: pairs.append(len(q) * len(v) if len(v) == 50 else 0) or products(q, v))
    names, scores = best_of_shards(queries, vectors, np.arange(40_000), 10, 4_000, 50)
    carried, pairs[:] = sum(pairs), []
    for start in range(0, 40_000, 4_000):
        topk.best_of_shard(queries, vectors[queries], np.arange(start, start + 4_000), vectors[start : start + 4_000], 10, 50)
    assert carried < sum(pairs) / 2 and carried < 40 * 40_000 / 4
    for i, q in enumerate(queries):
        every = vectors @ vectors[q]
        best = [j for j in np.lexsort((np.arange(40_000), -every)) if j != q][:10]
        assert names[i].tolist() == best and scores[i].tolist() == every[best].tolist()
