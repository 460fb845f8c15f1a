import zlib

import numpy as np
import pyarrow as pa

from tidemark.llm import queries, ranking


def test_held_out_documents_are_ranked_and_cut_well(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op7_quality_classifier(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert len(rows) == docs
    good = {r.doc_id: r.quality == 1 for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [(r.score, r.predicted, good[r.doc_id]) for r in rows if r.held_out and r.doc_id in good]
    above = [a > b for a, _, x in held for b, _, y in held if x and not y]
    assert np.mean(above) > 0.95
    assert np.mean([p == y for _, p, y in held]) > 0.95


def test_features_of_odd_texts():
    texts = [None, "", " \n", "ÄÖ!!", "a " * 50_000, "x" * 100_000, "###"]
    x = ranking.features(pa.array(texts, pa.string()))
    assert np.isfinite(x).all() and (x[:2] == x[0]).all()
    assert (ranking.features(pa.array([], pa.string())).shape) == (0, ranking.FEATURES)


DOCS = "doc_id long, text string, score double, x string"
ROWS = [(1, "Good text here", 1.0, "a"), (None, None, None, None), (3, "", 2.0, None), (1, "Good text here", 1.0, "a")]


def test_odd_rows_and_no_labels(spark):
    docs = spark.createDataFrame(ROWS, DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = ranking.quality(docs, none).collect()
    assert len(rows) == 4 and all(r.predicted == 1 for r in rows)
    assert ranking.keep_good(docs, none).columns == docs.columns and ranking.keep_good(docs, none).count() == 4
    some = spark.createDataFrame([(1, 1, None), (None, 0, 1), (3, None, 1)], "doc_id long, quality int, toxic int")
    assert all(r.predicted == 1 for r in ranking.quality(docs, some).collect())
    assert ranking.quality(docs.limit(0), none).collect() == []


def test_only_pairs_of_both_kinds_teach():
    x = np.zeros((10, ranking.FEATURES))
    x[:5, 8] = 1
    x[:, ranking.KINDS] = 9
    model = ranking.fit(x, np.arange(10) < 5)
    assert (model.score(x[:5]) >= ranking.CUT).all() and (model.score(x[5:]) < ranking.CUT).all()
    assert (ranking.fit(x, np.zeros(10, bool)).score(x) < ranking.CUT).all()


def test_weights_equal_those_of_plain_descent():
    """The same pairs, taken down the same loss by small steps; the loss has one minimum."""
    rng = np.random.default_rng(4)
    x = np.zeros((60, ranking.FEATURES))
    x[:, 8:12], x[:, ranking.KINDS] = rng.normal(size=(60, 4)), 9
    good = x[:, 8] + 0.7 * rng.normal(size=60) > 0
    model = ranking.fit(x, good, pairs=300, ridge=1e-2)
    rng = np.random.default_rng(7)
    z = model.standard(x)
    difference = z[rng.choice(np.flatnonzero(good), 300)] - z[rng.choice(np.flatnonzero(~good), 300)]
    weights = np.zeros(ranking.FEATURES)
    for _ in range(20_000):
        p = 1 / (1 + np.exp(-difference @ weights))
        weights -= 0.2 * (difference.T @ (p - 1) / 300 + 1e-2 * weights)
    assert np.allclose(model.weights, weights, atol=1e-5)
    raw = z @ weights
    assert (raw > model.threshold).sum() == good.sum()


def _stored(spark, x, good, tmp_path, parts):
    rows = [(int(g), bytearray(np.ascontiguousarray(v).tobytes())) for v, g in zip(x, good, strict=True)]
    spark.createDataFrame(rows, "quality int, x binary").repartition(parts).write.parquet(str(tmp_path / str(parts)))
    return spark.read.parquet(str(tmp_path / str(parts)))


def test_all_pairs_teach_without_being_formed(spark, tmp_path):
    """The weights of the distributed passes are those of all pairs, one by one; the threshold is an exact quantile."""
    rng = np.random.default_rng(5)
    x = np.zeros((400, ranking.FEATURES))
    x[:, 8:14], x[:, ranking.KINDS] = rng.normal(size=(400, 6)), rng.uniform(4, 9, 400)
    x[0, 13] = 400  # far out
    good = x[:, 8] - 0.5 * x[:, 9] + 0.7 * rng.normal(size=400) > -0.8
    plain = ranking.fit(x, good)
    for parts in (1, 5):
        model = ranking.fit_all(_stored(spark, x, good, tmp_path, parts))
        assert np.allclose(model.mean, plain.mean) and np.allclose(model.scale, plain.scale)
        assert np.allclose(model.weights, plain.weights, atol=2e-3)
        raw = np.sort(model.raw(x))
        at = int((~good).sum())
        assert model.threshold == (raw[at - 1] + raw[at]) / 2
    assert (ranking.fit_all(_stored(spark, x[:2] * 0, [False, False], tmp_path, 2)).score(x) < ranking.CUT).all()


def test_every_labelled_document_teaches(spark):
    """The only bad documents are the last 500 by a hash of their ids: they count beyond any 20,000 labels."""
    n, last = 20_500, queries.F.xxhash64("doc_id")
    labels = spark.range(4 * n).select(queries.F.col("id").alias("doc_id")).where(ranking.usable()).limit(n)
    bad = [r.doc_id for r in labels.orderBy(last.desc(), queries.F.desc("doc_id")).limit(500).collect()]
    labels = labels.withColumn("quality", (~queries.F.col("doc_id").isin(bad)).cast("int"))
    text = queries.F.expr("if(quality = 1, 'Plain words, number ', '### @@ ') || doc_id")
    rows = ranking.quality(labels.select("doc_id", text.alias("text")), labels).collect()
    assert len(rows) == n and {r.doc_id for r in rows if not r.predicted} == set(bad)
